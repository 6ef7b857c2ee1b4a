"""Quality classifier: an interpolated modified Kneser-Ney model of characters.

N-grams of unfolded characters are counted over all trusted text. Joins of the
documents' n-grams with counts, contexts and lower orders give the probabilities
(:mod:`orderlake.llm.ngrams`); a document is rejected when its perplexity is
beyond a limit of the trusted documents in its language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from orderlake.llm import ngrams
from orderlake.llm.characters import chunks, flatten
from orderlake.llm.common import MAX_SENT_IDS, unused, with_ids
from orderlake.llm.ngrams import LEAST_DISCOUNT
from orderlake.sources.staging import stage

#: Of :func:`fit` only: characters fold into 256 symbols (ASCII as it is, the
#: others by a hash into the upper half).
SYMBOLS = 256
QUANTILE = 0.999
#: How far beyond the quantile, in nats per character, a document may be.
SLACK = 0.02
#: Characters of average text a document's perplexity is smoothed with.
PRIOR = 200
#: Trusted documents of all languages that a language's own limit is weighed
#: against; its mean is weighed against ``PRIOR`` characters of all.
PRIOR_TRUSTED = 100
#: One in so many trusted texts is kept from the model, to set the limits.
HELD_OUT = 4
CHUNK = 2_000_000


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents labelled good and not toxic, by every label they have."""
    return (
        labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
        .agg(F.min(F.coalesce("quality", F.lit(0))).alias("good"), F.max(F.coalesce("toxic", F.lit(0))).alias("bad"))
        .where("good = 1 AND bad = 0").select(F.col("doc_id").alias("trusted_id"))
    )


def symbol_table() -> np.ndarray:
    points = np.arange(0x110000, dtype=np.uint32)
    folded = 128 + (points * np.uint32(2654435761) >> np.uint32(25)) % np.uint32(128)
    return np.where(points < 128, points, folded).astype(np.uint8)


def _trigrams(texts: list[str], table: np.ndarray):
    """Codes of all trigrams, the last one of a text ending it, and where texts start."""
    flat, starts, lengths = flatten(texts, 2, 1)
    symbols = table[flat].astype(np.uint32)
    codes = symbols[2:] | symbols[1:-1] << np.uint32(8) | symbols[:-2] << np.uint32(16)
    place = np.zeros(len(flat) - 2, bool)
    at = starts - 2
    steps = np.repeat(at - np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]), lengths + 1)
    place = np.arange((lengths + 1).sum()) + steps
    return codes[place], np.cumsum(lengths + 1) - lengths - 1, lengths + 1


def count_trigrams(texts: DataFrame) -> DataFrame:
    """``gram, n`` over a text column; missing and empty texts have none."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = symbol_table()
        for batch in batches:
            rows = batch.column(0).to_pylist()
            for a, b in chunks(rows, CHUNK):
                grams, n = np.unique(_trigrams(rows[a:b], table)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams.astype(np.int32)), pa.array(n.astype(np.int64))], names=["gram", "n"]
                )

    filled = texts.where(F.length("text") > 0).select("text")
    parts = filled.mapInArrow(count, "gram int, n bigint")
    return parts.groupBy("gram").agg(F.sum("n").alias("n"))


def _order(counts: DataFrame, lower: DataFrame | None, bits: int) -> tuple[DataFrame, DataFrame]:
    """Probabilities of one order from its counts, their contexts and the order
    below: ``gram, p`` and, per context, the weight ``rest`` of the lower order."""
    exact = [F.count_if(F.col("n") == i).alias(f"t{i}") for i in range(1, 5)]
    t1, t2, t3, t4 = (float(v or 0) for v in counts.agg(*exact).first())
    y = t1 / (t1 + 2 * t2) if t1 else 0.0
    off = [
        min(max(i - (i + 1) * y * more / have, LEAST_DISCOUNT), i) if have and y else 0.5
        for i, have, more in ((1, t1, t2), (2, t2, t3), (3, t3, t4))
    ]
    discount = F.when(F.col("n") == 1, off[0]).when(F.col("n") == 2, off[1]).otherwise(off[2])
    rows = counts.select("*", discount.alias("d"), F.shiftright("gram", 8).alias("context"))
    contexts = rows.groupBy("context").agg(
        F.sum("n").alias("total"), (F.sum("d") / F.sum("n")).alias("rest")
    )
    joined = rows.join(contexts, "context")
    own = (F.col("n") - F.col("d")) / F.col("total")
    if lower is None:
        return joined.select("gram", (own + F.col("rest") / SYMBOLS).alias("p")), contexts
    below = lower.select(F.col("gram").alias("suffix"), F.col("p").alias("p_lower"))
    mixed = joined.join(below, F.col("gram").bitwiseAND((1 << bits) - 1) == F.col("suffix"))
    return mixed.select("gram", (own + F.col("rest") * F.col("p_lower")).alias("p")), contexts


def fit(texts: DataFrame) -> np.ndarray | None:
    """Log probabilities of all folded trigrams (context by symbol), None without
    text: a dense table to look at small texts with. No query uses it."""
    three = stage(count_trigrams(texts), "trigrams")
    two = stage(three.groupBy(F.col("gram").bitwiseAND(0xFFFF).alias("gram")).agg(F.count(F.lit(1)).alias("n")), "bigrams")
    one = stage(two.groupBy(F.col("gram").bitwiseAND(0xFF).alias("gram")).agg(F.count(F.lit(1)).alias("n")), "unigrams")
    if one.isEmpty():
        return None
    p1, c1 = _order(one, None, 0)
    p2, c2 = _order(two, p1, 8)
    p3, c3 = _order(three, stage(p2, "bigram-model"), 16)

    def column(df: DataFrame, key: str, value: str, size: int, other: float) -> np.ndarray:
        out, held = np.full(size, other), df.select(key, value).toArrow()
        out[held.column(0).to_numpy()] = held.column(1).to_numpy()
        return out

    rest = column(c1, "context", "rest", 1, 1.0)[0]
    first = column(p1, "gram", "p", SYMBOLS, rest / SYMBOLS)
    second = column(c2, "context", "rest", SYMBOLS, 1.0)[:, None] * first[None, :]
    known = p2.toArrow()
    second.reshape(-1)[known.column(0).to_numpy()] = known.column(1).to_numpy()
    weights = column(c3, "context", "rest", SYMBOLS**2, 1.0).astype(np.float32)
    third = weights.reshape(SYMBOLS, SYMBOLS)[:, :, None] * second.astype(np.float32)[None, :, :]
    known = p3.toArrow()
    third.reshape(-1)[known.column(0).to_numpy()] = known.column(1).to_numpy()
    return np.log(third.reshape(-1))


def thresholds(scored: DataFrame, trusted: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """``language, mean, most`` per language of the documents: the mean of the
    trusted ones and the most smoothed nats per character allowed, from
    ``doc_id, lang, nats, chars``. The language NULL is one of its own.

    One rule at every size: a language's mean is that of its trusted documents
    and ``PRIOR`` characters of the overall mean; how far its limit lies above
    is the quantile over its n trusted documents and over those of all
    languages, weighed n to ``PRIOR_TRUSTED``. Without trusted text a language
    has no limit."""
    good = scored.join(trusted, F.col("doc_id") == F.col("trusted_id"), "left_semi").where("nats IS NOT NULL")
    overall = good.agg(F.sum("nats") / F.sum("chars")).first()[0]
    all_nats = F.lit(PRIOR) * F.lit(overall)
    means = stage(
        good.groupBy(F.col("lang").alias("language")).agg(
            ((F.sum("nats") + all_nats) / (F.sum("chars") + F.lit(PRIOR))).cast("double").alias("mean"),
            F.count(F.lit(1)).alias("n"),
        ),
        "language-means",
    )
    above = good.join(means, F.col("lang").eqNullSafe(F.col("language"))).select(
        "language", "mean", "n", (smoothed(F.col("nats"), F.col("chars"), F.col("mean")) - F.col("mean")).alias("above")
    )
    beyond = F.percentile_approx("above", quantile, 10_000)
    every = above.agg(beyond).first()[0]
    own = above.groupBy("language", "mean", "n").agg(beyond.alias("above"))
    shrunk = (F.col("n") * F.col("above") + F.lit(PRIOR_TRUSTED) * F.lit(every)) / (F.col("n") + F.lit(PRIOR_TRUSTED))
    return stage(
        own.select("language", "mean", (F.col("mean") + shrunk + F.lit(SLACK)).cast("double").alias("most")),
        "language-limits",
    )


def smoothed(nats: Column, chars: Column, mean: Column) -> Column:
    return (nats + F.lit(PRIOR) * mean) / (chars + F.lit(PRIOR))


def _judged(scored: DataFrame, limits: DataFrame) -> DataFrame:
    held = limits.select(*(F.col(c).alias(f"kn_{c}") for c in limits.columns))
    joined = scored.join(held, F.col("lang").eqNullSafe(F.col("kn_language")), "left")
    bad = smoothed(F.col("nats"), F.col("chars"), F.col("kn_mean")) > F.col("kn_most")
    return joined.withColumn("kn_kept", ~F.coalesce(bad, F.lit(False)))


def judge(documents: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """``doc_id, lang, chars, perplexity, smoothed, threshold, kept`` per row.

    A document goes when its perplexity, smoothed with ``PRIOR`` characters of
    its language's average, is beyond the language's limit (:func:`thresholds`).
    A missing or empty text has no perplexity and stays; so does every document
    of a language without trusted text. Repeated rows are judged alike, other
    columns ignored, an empty table gives no rows.
    """
    small, limits = _fitted(documents, labels, quantile)
    return _judged(small, limits).select(
        "doc_id", "lang", "chars",
        F.exp(F.col("nats") / F.col("chars")).alias("perplexity"),
        F.exp(smoothed(F.col("nats"), F.col("chars"), F.col("kn_mean"))).alias("smoothed"),
        F.exp("kn_most").alias("threshold"), F.col("kn_kept").alias("kept"),
    )


def _tie(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _fitted(documents: DataFrame, labels: DataFrame, quantile: float) -> tuple[DataFrame, DataFrame]:
    """``doc_id, lang, tie, nats, chars`` of every row, NULL and 0 without a text
    or any trusted one, and the limits."""
    trusted = stage(trusted_ids(labels), "trusted-ids")
    own = documents.select("doc_id", "lang", "text", _tie(F.col("text")).alias("tie"))
    good = with_ids(own, "doc_id", trusted, "trusted_id")
    # A model knows its own documents too well to tell what others may have.
    unseen = F.pmod(F.xxhash64("tie"), F.lit(HELD_OUT)) == 0
    model = ngrams.Model(good.where(~unseen))
    small = stage(
        _scored(own, model if model.symbols else ngrams.Model(good)), "perplexities", ngrams.BATCH_BYTES
    )
    held = small.where(unseen)
    if with_ids(held.where("nats IS NOT NULL"), "doc_id", trusted, "trusted_id").isEmpty():
        held = small
    return small, thresholds(held, trusted, quantile)


def _scored(own: DataFrame, model: ngrams.Model) -> DataFrame:
    rows = own.select("doc_id", "lang", "tie")
    if model.symbols:
        scored = ngrams.score(own.withColumn("doc_id", F.col("doc_id").cast("bigint")), model)
        held = scored.select(F.col("doc_id").alias("d"), F.col("tie").alias("t"), "nats", "chars")
        rows = rows.join(held, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tie") == F.col("t")), "left")
    else:
        rows = rows.withColumns({"nats": F.lit(None).cast("double"), "chars": F.lit(0).cast("bigint")})
    return rows.select("doc_id", "lang", "tie", "nats", F.coalesce("chars", F.lit(0)).cast("bigint").alias("chars"))


def keep_good(documents: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """The rows :func:`judge` keeps, with their columns. The keys of the others
    are sent to them while they are few; beyond that, both are shuffled."""
    small, limits = _fitted(documents, labels, quantile)
    doc, lang, tie = (unused(documents, f"kn_{c}") for c in ("doc", "lang", "tie"))
    bad = _judged(small, limits).where("NOT kn_kept").select(
        F.col("doc_id").alias(doc), F.col("lang").alias(lang), F.col("tie").alias(tie)
    )
    bad = stage(bad.distinct(), "rejected")
    here = (
        F.col("doc_id").eqNullSafe(F.col(doc)) & F.col("lang").eqNullSafe(F.col(lang))
        & (_tie(F.col("text")) == F.col(tie))
    )
    return documents.join(bad.hint("broadcast" if bad.count() <= MAX_SENT_IDS else "merge"), here, "left_anti")


def op9_quality(spark, sf_dir: str) -> DataFrame:
    return judge(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    )
