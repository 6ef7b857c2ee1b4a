"""Duplicate handling that keeps a hot key out of any single task.

Rows can only repeat where their key repeats. ``repeated_keys`` finds those keys
from the key and position columns alone; a run stages that small table and hands
it to the operators below, which then leave all other rows where they are
instead of shuffling them. Without it each operator works in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderlake.contracts import POSITION


def content(df: DataFrame, position: str = POSITION) -> list[str]:
    """The columns a row consists of, without its position."""
    return [c for c in df.columns if c != position]


def repeated_keys(df: DataFrame, key: str, position: str = POSITION) -> DataFrame:
    """Keys that occur more than once, each with the position of its first row;
    rows without a key share one key. Counts are combined before the shuffle."""
    return (
        df.groupBy(F.col(key).alias("_key"))
        .agg(F.min(position).alias("_first"), F.count(F.lit(1)).alias("_copies"))
        .where("_copies > 1")
        .drop("_copies")
    )


def _same_key(key: str) -> Column:
    return F.col(key).eqNullSafe(F.col("_key"))


def copies(
    df: DataFrame,
    key: str | None = None,
    repeated: DataFrame | None = None,
    position: str = POSITION,
) -> DataFrame:
    """Each different row once, NULLs equal, with ``n``, how often it occurs.

    The hash aggregate folds copies before the shuffle, so a row repeated any
    number of times leaves each map task once. With ``repeated`` only the rows
    of repeated keys are grouped.
    """
    columns = content(df, position)
    rows = df.select(columns)
    count = F.count(F.lit(1)).alias("n")
    if repeated is None:
        return rows.groupBy(*columns).agg(count)
    keys = repeated.select("_key")
    alone = rows.join(keys, _same_key(key), "left_anti").withColumn("n", F.lit(1).cast("bigint"))
    again = rows.join(keys, _same_key(key), "left_semi").groupBy(*columns).agg(count)
    return alone.unionByName(again)


def distinct_rows(
    df: DataFrame,
    key: str | None = None,
    repeated: DataFrame | None = None,
    position: str = POSITION,
) -> DataFrame:
    """One copy of each row; the position does not count as content."""
    return copies(df, key, repeated, position).drop("n")


def flag_repeats(
    df: DataFrame,
    key: str,
    position: str = POSITION,
    flag: str = "is_repeat",
    repeated: DataFrame | None = None,
) -> DataFrame:
    """Mark every row but the first of its key; all rows stay.

    A window over the key would sort a whole hot key in one task. Instead the
    first position of each repeated key is joined back: by broadcast while the
    repeated keys are few, otherwise by a shuffle join whose hot partitions AQE
    splits, which it cannot do for a window.
    """
    firsts = repeated_keys(df, key, position) if repeated is None else repeated
    joined = df.join(firsts, _same_key(key), "left")
    later = F.coalesce(F.col(position) > F.col("_first"), F.lit(False))
    return joined.withColumn(flag, later).drop("_key", "_first")


def flag_known(
    df: DataFrame, key: str, known: DataFrame, flag: str = "is_repeat"
) -> DataFrame:
    """Also mark rows whose key is in ``known``, which holds each key once."""
    keys = known.select(F.col(key).alias("_key"), F.lit(True).alias("_known"))
    joined = df.join(keys, _same_key(key), "left")
    marked = F.col(flag) | F.coalesce(F.col("_known"), F.lit(False))
    return joined.withColumn(flag, marked).drop("_key", "_known")


def keep_first(
    df: DataFrame, key: str, position: str = POSITION, repeated: DataFrame | None = None
) -> DataFrame:
    """The first row of each key.

    Filtering ``row_number`` on 1 lets Spark put a group limit below the
    shuffle: each map task sends at most one row per key.
    """
    if repeated is not None:
        return flag_repeats(df, key, position, "_later", repeated).where("NOT _later").drop("_later")
    order = Window.partitionBy(key).orderBy(position)
    return df.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth")
