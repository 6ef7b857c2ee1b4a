"""The registered queries of this package and their SQL."""

from orderlake.llm import (
    alignment, ann, chat, cuckoo, jaccard, kneser, language, licenses, mixing, packing, suffixes, trie, urls,
)

QUERIES = {
    "op1_ann": ann.op1_ann,
    "op2_cuckoo_dedup": cuckoo.op2_dedup,
    "op3_mixing": mixing.op3_mix,
    "op4_language": language.op4_language,
    "op5_repeats": suffixes.op5_repeats,
    "op6_url_filter": urls.op6_urls,
    "op7_packing": packing.op7_packing,
    "op8_jaccard_join": jaccard.op8_jaccard,
    "op9_quality": kneser.op9_quality,
    "op10_chat": chat.op10_chat,
    "op11_alignment": alignment.op11_alignment,
    "op12_licenses": licenses.op12_licenses,
    "op13_prefix_trie": trie.op13_prefix_trie,
}

#: The others are tested against brute force: their methods are not SQL.
SQL = {
    "op2_cuckoo_dedup": cuckoo.OP2_SQL,
    "op6_url_filter": urls.OP6_SQL,
    "op10_chat": chat.OP10_SQL,
    "op13_prefix_trie": trie.OP13_SQL,
}
