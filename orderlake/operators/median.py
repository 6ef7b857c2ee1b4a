"""Exact median without gathering the values anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderlake.sources.staging import stage, staged_run

ACCURACY = 10_000


def kth_value(values: DataFrame, k: int, rows: int, accuracy: int = ACCURACY) -> float:
    """The k-th smallest (from 0) of the non-NULL column ``v``.

    Each round brackets the rank between two approximate percentiles and counts
    below, on and between the ends. The sketch's rank error is bounded, so a
    round narrows the bracket by a factor of about ``accuracy / 4`` over what
    lies between its ends, and is exact on a bracket of fewer values than that;
    the ends themselves are settled by their counts, whatever their share of the
    rows. A round drops at least the values of one end, so the last bracket is
    settled like the first, and tasks and driver only handle sketches and counts.
    """
    below, inside, bracket = 0, rows, values
    margin = 2 / accuracy
    while True:
        share = (k - below + 0.5) / inside
        low, high = bracket.agg(
            F.percentile_approx("v", [max(share - margin, 0.0), min(share + margin, 1.0)], accuracy)
        ).first()[0]
        v = F.col("v")
        n = bracket.agg(
            F.count_if(v < low).alias("under"),
            F.count_if(v == low).alias("low"),
            F.count_if((v > low) & (v < high)).alias("between"),
            F.count_if((v == high) & (v > low)).alias("high"),
        ).first()
        rank = k - below - n.under
        if 0 <= rank < n.low:
            return low
        if rank < 0:
            bracket, inside = bracket.where(v < low), n.under
            continue
        rank -= n.low
        below += n.under + n.low
        if rank < n.between:
            bracket, inside = bracket.where((v > low) & (v < high)), n.between
            continue
        if rank < n.between + n.high:
            return high
        below += n.between + n.high
        bracket = bracket.where(v > high)
        inside -= n.under + n.low + n.between + n.high


def exact_median(df: DataFrame, column: str, accuracy: int = ACCURACY) -> float | None:
    """Median of the non-NULL values, the mean of the middle two for an even count.
    The source is read once, for its one column."""
    with staged_run(df.sparkSession):
        column_only = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL")
        values = stage(column_only, "median-values")
        rows = values.count()
        if rows == 0:
            return None
        lower = kth_value(values, (rows - 1) // 2, rows, accuracy)
        if rows % 2:
            return lower
        v = F.col("v")
        upto, following = values.agg(F.count_if(v <= lower), F.min(F.when(v > lower, v))).first()
        upper = lower if upto > rows // 2 else following
        return (lower + upper) / 2


def fill_median(df: DataFrame, column: str, accuracy: int = ACCURACY) -> DataFrame:
    """Missing values replaced by the exact median of the others."""
    median = exact_median(df, column, accuracy)
    return df.withColumn(column, F.coalesce(column, F.lit(median).cast("double")))
