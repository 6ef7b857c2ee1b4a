"""Reports and marts. All aggregate partially before they shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderlake.functions.money import whole
from orderlake.operators.rules import only_completed


def category_report(df: DataFrame) -> DataFrame:
    """Orders, revenue and mean revenue per category, whatever the status."""
    return (
        df.where(F.col("kategori").isNotNull())
        .groupBy("kategori")
        .agg(
            F.count("order_id").alias("total_orders"),
            whole(F.coalesce(F.sum("total_harga"), F.lit(0.0))).alias("total_revenue"),
            whole(F.avg("total_harga")).alias("avg_revenue"),
        )
        .orderBy("kategori")
    )


def by_dimension(df: DataFrame, dimensions: list[str], aggregates: list) -> DataFrame:
    """Group by each dimension on its own, in one pass, as rows of
    ``dimension, segment, …``; NULL segments are kept."""
    spread = df.groupingSets([[d] for d in dimensions], *dimensions)
    grouped = spread.agg(
        *[F.grouping(d).alias(f"_no_{d}") for d in dimensions], *aggregates
    )
    dimension = F.coalesce(*[F.when(F.col(f"_no_{d}") == 0, d) for d in dimensions])
    names = [c for c in grouped.columns if c not in dimensions and not c.startswith("_no_")]
    return grouped.select(
        dimension.alias("dimension"), F.coalesce(*dimensions).alias("segment"), *names
    )


DIMENSIONS = ("kategori", "channel", "order_month")


def sales_parts(clean: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """Completed sales per category, per channel and per month, stacked; revenue is not
    rounded yet, so the parts of several runs can be merged."""
    totals = [
        F.count("order_id").alias("total_orders"),
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("total_qty"),
        F.coalesce(F.sum("total_harga"), F.lit(0.0)).alias("revenue"),
    ]
    return by_dimension(only_completed(clean), list(dimensions), totals).where(F.col("segment").isNotNull())


def merged_sales(parts: DataFrame) -> DataFrame:
    """The summary over all runs whose parts are given."""
    return parts.groupBy("dimension", "segment").agg(
        F.sum("total_orders").alias("total_orders"), F.sum("total_qty").alias("total_qty"),
        whole(F.sum("revenue")).alias("total_revenue"),
    ).orderBy("dimension", "segment")


def sales_summary(clean: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """Completed sales per category, per channel and per month, stacked."""
    parts = sales_parts(clean, dimensions)
    return parts.select(
        "dimension", "segment", "total_orders", "total_qty", whole(F.col("revenue")).alias("total_revenue")
    ).orderBy("dimension", "segment")


def sales_by_category_city(df: DataFrame) -> DataFrame:
    """Completed orders by category and city, best revenue first."""
    return (
        only_completed(df)
        .groupBy("kategori", "kota")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum("quantity").alias("total_quantity"),
            F.sum("total_harga").alias("total_revenue"),
        )
        .orderBy(F.desc_nulls_last("total_revenue"), "kategori", "kota")
    )


def sales_by_channel_status(df: DataFrame) -> DataFrame:
    """All orders by channel and status."""
    return (
        df.groupBy("channel", "status")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum("total_harga").alias("total_revenue"),
        )
        .orderBy(F.asc_nulls_last("channel"), F.asc_nulls_last("status"))
    )


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """How often each value occurs, most frequent first."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), column)
    )


def run_totals(report: DataFrame) -> DataFrame:
    """Orders and revenue over a category report."""
    return report.agg(
        F.coalesce(F.sum("total_orders"), F.lit(0)).alias("total_orders"),
        F.coalesce(F.sum("total_revenue"), F.lit(0.0)).alias("total_revenue"),
    )
