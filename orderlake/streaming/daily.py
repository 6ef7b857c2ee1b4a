"""New order files, landed exactly once and cleaned run by run.

A file stream lands what is new in the drop folder as Parquet, with the time of
its micro-batch; the strict recipe then takes the micro-batches no published
run holds yet. An order seen in an earlier run is a repeat in this one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from orderlake.contracts import DUPLICATE, ORDER_COLUMNS, ORDER_NUMBERS, POSITION, ContractError
from orderlake.operators import known
from orderlake.operators.dedupe import repeated_keys
from orderlake.operators.marts import merged_sales, sales_parts
from orderlake.operators.sketches import distinct_parts, merged_distinct
from orderlake.plans import strict
from orderlake.sources.positions import fixed_width
from orderlake.sources.quarantine import UNREADABLE, parse_lines, sort_out
from orderlake.sources.readers import csv_split
from orderlake.sources.sinks import (
    attempt, missing_path, published, published_batches, published_runs, runs_without,
)
from orderlake.sources.staging import stage, stage_counted, staged_run

LANDED = "landed_at"
#: Tasks that write the known keys; each part's keys come from one of them.
KEY_FILES = 32
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_ZONE = "spark.sql.session.timeZone"


def order_stream(
    spark: SparkSession, source: str, columns: list[str] = ORDER_COLUMNS,
    files_per_batch: int | None = None,
) -> DataFrame:
    """The drop folder as a stream of parsed lines. Lines that are no full rows, and
    files with another header, are told apart when a run takes the batch."""
    reader = spark.readStream.schema("value string")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.text(source).select("value", csv_split().alias(POSITION))
    # Constant within a micro-batch, kept on a replay, and growing.
    landed = F.date_format(F.current_timestamp(), "yyyyMMddHHmmssSSS")
    return parse_lines(lines, columns).withColumn(LANDED, landed)


def land(
    spark: SparkSession, source: str, landing: str, checkpoint: str,
    files_per_batch: int | None = None,
) -> None:
    """Land every file that is new since the last call, then stop.

    An open writer per folder keeps the rows of a split in file order; the
    default would sort by folder first, which may reorder rows when it spills.
    The setting is made in a session of the stream's own.
    """
    own = spark.newSession()
    own.conf.set(_WRITERS, 8)
    own.conf.set(_ZONE, spark.conf.get(_ZONE))
    query = (
        order_stream(own, source, files_per_batch=files_per_batch)
        .writeStream.format("parquet")
        .partitionBy(LANDED)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(landing)
    )
    query.awaitTermination()


def landed_except(spark: SparkSession, landing: str, taken: set[str]) -> DataFrame:
    """Rows of the micro-batches not taken yet; folders of the others are not
    read. Which are new does not depend on the clock that named them.

    A row's place is its micro-batch, source file and split, then its place in
    the landed file, which holds a split's rows together and in order.
    """
    schema = spark.read.parquet(landing).drop(LANDED).schema.add(LANDED, StringType())
    rows = spark.read.schema(schema).parquet(landing)
    if taken:
        rows = rows.where(~F.col(LANDED).isin(sorted(taken)))
    place = F.struct(LANDED, F.col(POSITION).alias("split"), F.col("_metadata.row_index").alias("row"))
    return rows.withColumn(POSITION, place)


def known_orders(spark: SparkSession, root: str, runs: list[str] | None = None) -> DataFrame:
    """Each order of published runs once: clean, or rejected for another reason than
    being a repeat or unreadable."""
    clean = published(spark, root, "clean", every_run=True, runs=runs).select("order_id")
    rejected = published(spark, root, "rejected", every_run=True, runs=runs)
    first = ~F.col("reject_reason").isin(DUPLICATE, *UNREADABLE)
    return clean.unionByName(rejected.where(first).select("order_id"))


def key_store(spark: SparkSession, root: str) -> tuple[DataFrame | None, DataFrame | None]:
    """Keys of all published runs, dealt by hash, and the newest filter over them. Runs
    published without keys are read for theirs."""
    bare = runs_without(spark, root, "keys")
    if not published_runs(spark, root):
        return None, None
    try:
        store, filters = published(spark, root, "keys", every_run=True), published(spark, root, "key_filter")
    except ContractError:
        store = filters = None
    if not bare:
        return store, filters
    older = stage(known.with_part(known_orders(spark, root, bare).distinct()), "keys-of-older-runs")
    store = older if store is None else store.unionByName(older)
    n = store.count()
    return store, stage(known.filter_of(store, known.buckets_for(n)), "filter-of-older-runs")


def summary_parts(spark: SparkSession, root: str) -> DataFrame | None:
    """Parts of the sales summary of all published runs; the clean rows are read of runs
    published without them only."""
    if not published_runs(spark, root):
        return None
    bare, found = runs_without(spark, root, "summary_parts"), []
    if set(published_runs(spark, root)) - set(bare):
        found.append(published(spark, root, "summary_parts", every_run=True))
    if bare:
        found.append(sales_parts(published(spark, root, "clean", every_run=True, runs=bare)))
    return reduce(DataFrame.unionByName, found)


def distinct_of_runs(spark: SparkSession, root: str) -> DataFrame | None:
    """Sketches of the columns of all published runs that hold them."""
    if not set(published_runs(spark, root)) - set(runs_without(spark, root, "distinct_parts")):
        return None
    return published(spark, root, "distinct_parts", every_run=True)


def clean_new(spark: SparkSession, landing: str, products: DataFrame, root: str) -> str | None:
    """Publish one run over all landed micro-batches without one; its name is
    that of the last of them, or None if nothing was new.

    Of earlier runs, the parts of the known keys that today's may be among and the
    parts of the summary are read, no order rows.
    """
    try:
        fresh = landed_except(spark, landing, published_batches(spark, root))
    except AnalysisException as error:
        if missing_path(error):
            return None
        raise
    batches = sorted(row[0] for row in fresh.select(LANDED).distinct().collect())
    if not batches:
        return None
    run_id = batches[-1]
    with staged_run(spark), attempt(spark, root, run_id) as now:
        place = F.col(POSITION)
        lines = stage(fresh.drop(LANDED).withColumns({
            "_file": place["split"]["file"], "_block": place["split"]["block"], "_row": place["row"],
        }), "landed-lines")
        found = sort_out(lines, ORDER_COLUMNS, ORDER_NUMBERS)
        staged, size = stage_counted(found.rows, "landed-orders")
        raw = fixed_width(staged)
        repeated = stage(repeated_keys(raw, "order_id"), "repeated-orders")
        keys = stage(known.with_part(raw.select("order_id").distinct()), "new-orders")
        store, filters = key_store(spark, root)
        seen, new = None, keys
        if store is not None:
            seen = stage(known.known_among(keys, store, filters), "known-orders")
            same = F.col("order_id").eqNullSafe(F.col("_seen"))
            new = stage(keys.join(seen.select(F.col("order_id").alias("_seen")), same, "left_anti"), "new-keys")
        classified, counted = stage_counted(
            strict.classify(raw, repeated, seen), "classified-orders", **strict.row_counters()
        )
        strict.write_outputs(now, classified, counted, products, found.unreadable)
        parts, _ = now.write("summary_parts", sales_parts(strict.accepted(classified)))
        earlier = summary_parts(spark, root)
        now.write("summary", merged_sales(parts if earlier is None else parts.unionByName(earlier)))
        sketched, _ = now.write("distinct_parts", distinct_parts(raw, ORDER_COLUMNS))
        before = distinct_of_runs(spark, root)
        now.write("distinct", merged_distinct(sketched if before is None else sketched.unionByName(before)))
        now.write("size", strict.size_rows(spark, {"orders": size}))
        # Keys of runs before the store came are not written again.
        now.write("keys", new.repartition(KEY_FILES, known.PART).sortWithinPartitions(known.PART, "order_id"), by=known.PART)
        grown = known.filter_of(new, known.buckets_for(new.count())) if store is None else known.grown_filter(store, new, filters)
        now.write("key_filter", grown)
        now.commit(batches)
    return run_id
