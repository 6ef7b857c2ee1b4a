"""Mixing sources to target weights by hash-random keys and prefix sums."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from orderlake.llm.common import BLANK, WORD, blocks_for, local_table, unit_interval, unused
from orderlake.sources.staging import stage

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = 20_240_601


def shares(sizes: list[int], weights: list[float], most: int = MAX_EPOCHS) -> list[float]:
    """Targets by weight for the sum of all sizes; a source stops at ``most``
    times its size and the excess is shared again by weight."""
    targets, open_ = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0]
    left = float(sum(sizes))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] >= most * sizes[i]]
        if not full:
            for i in open_:
                targets[i] = unit * weights[i]
            break
        for i in full:
            targets[i] = float(most * sizes[i])
            left -= targets[i]
        open_ = [i for i in open_ if i not in set(full)]
    return targets


def keyed(documents: DataFrame, seed: int = SEED) -> DataFrame:
    """Each row with its word count and its random key, added as ``size`` and
    ``key`` under free names; returns frame and names."""
    size, key = unused(documents, "size"), unused(documents, "key")
    return documents.withColumns({
        size: F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint"),
        key: F.xxhash64(F.lit(seed), "doc_id", "text"),
    }), size, key


def _source() -> tuple:
    return F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("name")


def plan_mix(rows: DataFrame, weights=None, most: int = MAX_EPOCHS) -> DataFrame:
    """Where each source is cut, from staged ``doc_id, source, size, key``.

    One row per source: ``no_source, name, source_size, target, epochs, cut,
    rest``. Every document counts ``epochs`` times, once more if its key is
    below ``cut``, and the documents at ``cut`` (one, but for equal rows) give
    ``rest`` words together, one after the other.

    A source's key range is dealt into blocks; sums per block and their prefix
    sums find the block a budget ends in, and only that block is sorted. The
    mix names its sources, so their sums (one row each) are held by the driver;
    ``weights`` maps names to weights, by default 1, 2, 3 repeating by name.
    """
    spark = rows.sparkSession
    rows = rows.select(*_source(), "size", "key")
    total = rows.groupBy("no_source", "name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size")
    ).orderBy("no_source", "name").collect()
    if weights is None:
        given = [float(WEIGHTS[i % len(WEIGHTS)]) for i in range(len(total))]
    else:
        given = [float(weights[None if r.no_source else r.name]) for r in total]
    targets = shares([r.source_size for r in total], given, most)
    width = blocks_for(sum(r.n for r in total))
    budgets = []
    for row, target in zip(total, targets):
        epochs = int(target // row.source_size) if row.source_size else 0
        left = int(round(target - epochs * row.source_size))
        budgets.append((
            row.no_source, row.name, row.source_size, target, epochs, left,
            math.ceil(row.n / width),
        ))
    sources = local_table(
        spark, budgets,
        "no_source boolean, name string, source_size bigint, target double, epochs int, "
        "left bigint, n_blocks int",
    )
    place = ["no_source", "name"]
    dealt = rows.join(sources.select(*place, "left", "n_blocks"), place).where("left > 0").withColumn(
        "block", F.floor(unit_interval(F.col("key")) * F.col("n_blocks"))
    )
    sums = dealt.groupBy(*place, "left", "block").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy(*place).orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    ends = (
        sums.withColumn("end", F.sum("words").over(upto))
        .where((F.col("end") >= F.col("left")) & (F.col("end") - F.col("words") < F.col("left")))
        .select(*place, "block", (F.col("left") - F.col("end") + F.col("words")).alias("rest"))
    )
    last = dealt.select(*place, "block", "size", order_key().alias("order")).join(
        ends, [*place, "block"]
    )
    same = last.groupBy(*place, "rest", "order").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy(*place).orderBy("order").rowsBetween(Window.unboundedPreceding, 0)
    cuts = (
        same.withColumn("end", F.sum("words").over(upto))
        .where((F.col("end") >= F.col("rest")) & (F.col("end") - F.col("words") < F.col("rest")))
        .select(
            *place, F.col("order").alias("cut"),
            (F.col("rest") - F.col("end") + F.col("words")).alias("rest"),
        )
    )
    # One row per source again: as a local table its size is known to the joins.
    plan = sources.drop("n_blocks", "left").join(cuts, place, "left")
    return local_table(spark, plan.collect(), plan.schema)


def order_key(key: str = "key"):
    """The key in the order of :func:`unit_interval`: unsigned."""
    return F.col(key).bitwiseXOR(F.lit(-(2**63)))


def _given_at_cut(rows: DataFrame, place: list[str], size: str, rest: str, given: str) -> DataFrame:
    """Rows at their source's cut with the words each gives, as column ``given``:
    all of it while ``rest`` lasts, so at most one row gives a part. Equal rows may
    be many, so they are numbered where they lie and only sums per part meet."""
    order, part, words, before = (unused(rows, c) for c in ("order_", "part_", "words_", "before_"))
    at = stage(rows.withColumn(order, F.monotonically_increasing_id()), "at-cut").withColumn(
        part, F.shiftright(order, 33)
    )
    sums = at.groupBy(*place, part).agg(F.sum(size).alias(words))
    earlier = Window.partitionBy(*place).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn(before, F.coalesce(F.sum(words).over(earlier), F.lit(0))).drop(words)
    inside = Window.partitionBy(*place, part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col(before) + F.coalesce(F.sum(size).over(inside), F.lit(0))
    left = F.greatest(F.least(F.col(rest) - ahead, F.col(size)), F.lit(0))
    return at.join(sums, [*place, part]).withColumn(given, left.cast("bigint"))


def mix_sizes(documents: DataFrame, weights=None, seed: int = SEED) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for each row.

    ``taken`` is how many words the mix takes of a document, repeats counted.
    A missing text has no words, a missing source is a source of its own, last
    in the order; of equal rows at a budget's end the first ones give all their
    words and one gives a part. Sources without words have target 0. Other columns
    are ignored; an empty table gives no rows.
    """
    rows, size, key = keyed(documents.select("doc_id", "text", "source"), seed)
    rows = stage(rows.select("doc_id", "source", F.col(size).alias("size"), F.col(key).alias("key")), "mix-sizes")
    plan = plan_mix(rows, weights)
    flags = rows.select("doc_id", "source", "size", "key", *_source())
    joined = flags.join(plan, ["no_source", "name"]).withColumn("at", order_key())
    at_cut = F.coalesce(F.col("at") == F.col("cut"), F.lit(False))
    others = joined.where(~at_cut).withColumn(
        "given", F.when(F.col("at") < F.col("cut"), F.col("size")).otherwise(0)
    )
    last = _given_at_cut(joined.where(at_cut), ["no_source", "name"], "size", "rest", "given")
    return others.unionByName(last.select(others.columns)).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + F.col("given")).cast("bigint").alias("taken"),
    )


def mix(documents: DataFrame, weights=None, seed: int = SEED) -> DataFrame:
    """The mixed documents, with the columns they came with.

    A document stands as many times as it is taken whole; where a source's
    budget ends, one stands with its first words only, and ``n_chars``, if
    there is such a column, follows. Documents without words stand once.
    The rest as in :func:`mix_sizes`.
    """
    rows, size, key = keyed(documents, seed)
    small = stage(rows.select("source", F.col(size).alias("size"), F.col(key).alias("key")), "mix-keys")
    plan = plan_mix(small, weights)
    kept = {c: unused(rows, c) for c in plan.columns}
    plan = plan.withColumnsRenamed(kept)
    joined = rows.join(
        plan,
        (rows["source"].isNull() == plan[kept["no_source"]])
        & (F.coalesce(rows["source"], F.lit("")) == plan[kept["name"]]),
    )
    words, at = F.col(size), order_key(key)
    at_cut = F.coalesce(at == F.col(kept["cut"]), F.lit(False))
    given = unused(joined, "given")
    others = joined.where(~at_cut).withColumn(given, F.lit(0).cast("bigint"))
    last = _given_at_cut(joined.where(at_cut), [kept["no_source"], kept["name"]], size, kept["rest"], given)
    joined = others.unionByName(last.select(others.columns))
    whole = F.col(kept["epochs"]) + F.when(at < F.col(kept["cut"]), 1).otherwise(0)
    part = F.col(given)
    pieces = F.split("text", rf"(?<=[^{BLANK}])(?=[{BLANK}])")
    head = F.array_join(F.slice(pieces, F.lit(1), part.cast("int")), "")
    copies = F.when(words == 0, F.array(F.col("text"))).otherwise(F.concat(
        F.array_repeat(F.col("text"), whole.cast("int")),
        F.when(part > 0, F.array(F.when(part >= words, F.col("text")).otherwise(head)))
        .otherwise(F.array().cast("array<string>")),
    ))
    text = unused(joined, "taken_text")
    out = joined.withColumn(text, F.explode(copies))
    changed = {"text": F.col(text)}
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        changed["n_chars"] = F.when(
            F.length(text) < F.length("text"), F.length(text).cast(kind)
        ).otherwise(F.col("n_chars"))
    return out.select([changed.get(c, F.col(c)).alias(c) for c in documents.columns])


def op3_mix(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sizes(documents).select("doc_id", "size", "source_size", "target", "taken")
