"""Token alignment against whole texts coded at once and compared byte by byte."""

import hashlib
import re
from collections import Counter
from functools import lru_cache

import oracle
import pytest

from orderlake.llm import alignment

TEXTS = [
    "plain words, and more words.", "héllo\nwörld  x", "日本𝄞 a", " lead", "  ", " ", "a\tb  ", "</s> <|endoftext|> [INST]",
    "﷽ﬁ é", "\x00a b", "it's 'quoted' don't", "x  y   z\n\n q", "a▁b c", "٣٤ नमस्ते 123 45", "a b　c d",
    "no-spaces-" * 300, "😀 😀😀 👩‍👩‍👧", "a\x1c b\x85 c", None, "", "plain words, and more words.",
]


@lru_cache(None)
def tokenizers_used():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(alignment.tokenizer_path(alignment.TOKENIZER_A))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.tokenizer_path(alignment.TOKENIZER_B))
    return a, b


def coded_whole(text):
    """Ids of A and B over the whole text and the groups by decoded bytes."""
    a, b = tokenizers_used()
    letters = alignment.byte_alphabet()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return None

    def ends(parts):
        found, at = [], 0
        for p in parts:
            at += len(p)
            found.append(at)
        return found

    ends_a, ends_b = ends(bytes_a), ends(bytes_b)
    groups, links, low_a, low_b = [], [], 0, 0
    at_a, at_b = ({end: k for k, end in enumerate(ends)} for ends in (ends_a, ends_b))
    for cut in sorted(set(ends_a) & set(ends_b)):
        i, j = at_a[cut], at_b[cut]
        groups.append(f"{','.join(map(str, ids_a[low_a:i + 1]))}|{','.join(map(str, ids_b[low_b:j + 1]))}")
        links.append((ids_a[i], ids_b[j]))
        low_a, low_b = i + 1, j + 1
    return len(ids_a), len(ids_b), groups, links


@pytest.fixture(scope="module")
def expected():
    return [coded_whole(t) if t else None for t in TEXTS]


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(None if i == 3 else i % 17, t, "x", 1) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, pair string, row int").repartition(3)


def plain(expected):
    counts = Counter(link for e in expected if e for link in e[3])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    rows = Counter()
    for i, e in enumerate(expected):
        doc_id = None if i == 3 else i % 17
        if e is None:
            rows[(doc_id, 0, 0, 0, 0, "", 0, 0)] += 1
            continue
        n_a, n_b, groups, links = e
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        best = sum(counts[link] == most[link[1]] for link in links)
        rows[(doc_id, n_a, n_b, len(groups), len(links), digest, best, sum(counts[x] for x in links))] += 1
    return rows


@pytest.mark.parametrize("sent", [alignment.MAX_SENT_PAIRS, 0])
def test_equals_whole_texts(frame, expected, sent):
    out = alignment.agreement(alignment.aligned(frame), sent).drop("groups")
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    assert Counter(map(tuple, out.collect())) == plain(expected)


def test_groups_and_ends(frame, expected):
    found = alignment.aligned(frame, keep_groups=True).select("n_a", "groups").collect()
    assert Counter(map(tuple, found)) == Counter(((e[0], ";".join(e[2])) if e else (0, "")) for e in expected)


def test_units_are_forgotten_and_learned_again(monkeypatch):
    aligner = alignment.Aligner(*map(alignment.tokenizer_path, (alignment.TOKENIZER_A, alignment.TOKENIZER_B)))
    once = [list(map(str, c)) for c in aligner.code(TEXTS[:6], True)[:6]]
    monkeypatch.setattr(alignment, "MAX_HELD", 0)
    assert [list(map(str, c)) for c in aligner.code(TEXTS[:6], True)[:6]] == once


def test_no_vocabulary_entry_crosses_a_unit():
    """What lets a text be coded by units: no piece goes on behind an inner space, a
    line end, or a comma or full stop behind a Latin letter."""
    aligner = alignment.Aligner(*map(alignment.tokenizer_path, (alignment.TOKENIZER_A, alignment.TOKENIZER_B)))
    assert not [p for p in aligner.b_bytes if b" " in p.lstrip(b" ") or len(p) > 1 and b"\n" in p]
    inner = re.compile(rf"[{alignment._LATIN}][,.]")
    assert not [p for p in aligner.b_bytes if inner.search(p.decode(errors="replace"))]


def test_real_texts(spark):
    """Whole documents of the test tables."""
    rows = spark.read.parquet(f"{oracle.TESTDATA}/sf0.001/documents.parquet").select("text").collect()
    texts = [r.text for r in rows]
    aligner = alignment.Aligner(*map(alignment.tokenizer_path, (alignment.TOKENIZER_A, alignment.TOKENIZER_B)))
    found = aligner.code(texts, True)
    want = [coded_whole(t) for t in texts]
    assert list(found[5]) == [";".join(w[2]) for w in want] and list(found[0]) == [w[0] for w in want]


def test_empty_table(frame):
    assert alignment.agreement(alignment.aligned(frame.limit(0))).collect() == []
