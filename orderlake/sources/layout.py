"""Time ranges kept with a table: later runs write along the cuts of earlier ones, and
a read of some time opens only the folders of its ranges.

Ranges are made of whole days and fill whole months. Months without ranges get theirs
from a count of rows per day; nothing is sampled, and the cuts of a month never change,
so a month's folders hold the same days in every run.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from orderlake.contracts import ContractError
from orderlake.sources.sinks import Attempt, published, published_runs, runs_without

#: The column that names a row's range by its first day; rows without a time have
#: the range ``none``.
RANGE = "time_range"
RANGES = "time_ranges"
NO_TIME = "none"
ROWS_PER_RANGE = 10_000_000


def learnt(df: DataFrame, time: str = "tanggal_order", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``month, first_day, end_day`` (exclusive) of ranges of some ``rows_per_range``
    rows, one a day at most. The window sees a month's days, not its rows."""
    day = F.to_date(time)
    days = df.where(F.col(time).isNotNull()).groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))
    month = days.withColumn("month", F.trunc("day", "month"))
    before = F.sum("n").over(Window.partitionBy("month").orderBy("day")) - F.col("n")
    cut = month.withColumn("number", F.floor(before / rows_per_range))
    first = cut.groupBy("month", "number").agg(F.min("day").alias("first_day"))
    within = Window.partitionBy("month").orderBy("number")
    return first.select(
        "month",
        F.when(F.row_number().over(within) == 1, F.col("month")).otherwise(F.col("first_day")).alias("first_day"),
        F.coalesce(F.lead("first_day").over(within), F.add_months("month", 1)).alias("end_day"),
    )


def missing_ranges(
    df: DataFrame, kept: DataFrame | None, time: str = "tanggal_order", rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Ranges of the months that ``kept`` has none of."""
    if kept is None:
        return learnt(df, time, rows_per_range)
    months = kept.select(F.col("month").alias("_month")).distinct()
    new = df.select(time).join(months, F.trunc(F.to_date(time), "month") == F.col("_month"), "left_anti")
    return learnt(new, time, rows_per_range)


def ranged(df: DataFrame, ranges: DataFrame, time: str = "tanggal_order") -> DataFrame:
    """Rows with their range, those of a range together and in time order. The table
    they are joined with has a row per day; a hot range is split into several files."""
    days = ranges.select(
        F.explode(F.sequence("first_day", F.date_sub("end_day", 1))).alias("_day"),
        F.date_format("first_day", "yyyy-MM-dd").alias(RANGE),
    )
    # Two runs published at once may both have cut a month.
    of_day = days.groupBy("_day").agg(F.min(RANGE).alias(RANGE))
    found = df.join(of_day, F.to_date(time) == F.col("_day"), "left").drop("_day")
    named = found.withColumn(RANGE, F.coalesce(RANGE, F.lit(NO_TIME)))
    return named.hint("rebalance", F.col(RANGE)).sortWithinPartitions(RANGE, time)


def kept_ranges(spark: SparkSession, root: str) -> DataFrame | None:
    """The ranges all published runs have made."""
    if not set(published_runs(spark, root)) - set(runs_without(spark, root, RANGES)):
        return None
    return published(spark, root, RANGES, every_run=True)


def write_by_time(
    now: Attempt, name: str, df: DataFrame, time: str = "tanggal_order", rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Write an output of an attempt in folders by range, with the ranges it adds."""
    kept = kept_ranges(now.spark, now.root)
    new, _ = now.write(RANGES, missing_ranges(df, kept, time, rows_per_range).coalesce(1))
    ranges = new if kept is None else kept.unionByName(new)
    return now.write(name, ranged(df, ranges, time), by=RANGE)[0]


def within(ranges: DataFrame, start: date | datetime, end: date | datetime) -> Column:
    """Whether a row's folder may hold times from ``start`` to before ``end``."""
    lies = (F.col("first_day") < F.lit(end)) & (F.col("end_day") > F.lit(start))
    names = ranges.where(lies).select(F.date_format("first_day", "yyyy-MM-dd")).distinct().collect()
    return F.col(RANGE).isin([n[0] for n in names])


def read_between(
    spark: SparkSession, root: str, name: str, start: date | datetime, end: date | datetime,
    time: str = "tanggal_order", every_run: bool = True,
) -> DataFrame:
    """Rows of a published output from ``start`` to before ``end``; folders of other
    ranges are not opened."""
    ranges = kept_ranges(spark, root)
    if ranges is None:
        raise ContractError("no published run holds time ranges")
    rows = published(spark, root, name, every_run=every_run).where(within(ranges, start, end))
    return rows.where((F.col(time) >= F.lit(start)) & (F.col(time) < F.lit(end))).drop(RANGE)
