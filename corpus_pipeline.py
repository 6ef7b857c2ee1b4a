"""From raw documents to packed training sequences.

Each stage works on all that the one before kept, and its decisions take effect:
rejected documents, copies and near copies go, the mix repeats, cuts or leaves
out documents, and what is left is packed. All but the last return documents.
"""

from __future__ import annotations

from orderlake.llm import cuckoo, jaccard, kneser, mixing, packing
from orderlake.sources.staging import stage


def quality_classifier(spark, docs, sf_dir):
    return kneser.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark, docs, sf_dir):
    return cuckoo.deduped(docs)


def near_dedup(spark, docs, sf_dir):
    return jaccard.one_of_each(docs)


def mix_sources(spark, docs, sf_dir):
    return mixing.mix(docs)


def pack_sequences(spark, docs, sf_dir):
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Perplexity, shingle sets and token ids are not SQL; the tests hold each stage
#: against its operator, and the operators against plain versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *filters, (_, last) = STAGES
    for name, step in filters:
        docs = stage(step(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
