"""Row rules: filters, the reject cascade and price repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orderlake.contracts import (
    BAD_DATE, BAD_PRICE, BAD_STATUS, COMPLETED, DUPLICATE, STATUSES,
)
from orderlake.functions.money import expected_total


def drop_negative_price(df: DataFrame, price: str = "total_harga") -> DataFrame:
    """Keep prices of 0 and more; a missing price does not pass."""
    return df.where(F.col(price) >= 0)


def only_completed(df: DataFrame, status: str = "status") -> DataFrame:
    return df.where(F.col(status) == COMPLETED)


def bad_price(price: Column) -> Column:
    return price.isNull() | (price <= 0)


def bad_status(status: Column, allowed: list[str] = STATUSES) -> Column:
    return ~F.coalesce(status.isin(allowed), F.lit(False))


def reject_reason(is_repeat: Column, price: Column, date: Column, status: Column) -> Column:
    """The first rule a row breaks, or NULL for a clean row."""
    return (
        F.when(is_repeat, DUPLICATE)
        .when(bad_price(price), BAD_PRICE)
        .when(date.isNull(), BAD_DATE)
        .when(bad_status(status), BAD_STATUS)
    )


def needs_repair(price: Column) -> Column:
    return price.isNull() | (price < 0)


def repair_price(df: DataFrame, unit: str = "harga_satuan") -> DataFrame:
    """Recompute missing or negative totals from the catalog's unit price."""
    total = F.col("total_harga")
    expected = expected_total(F.col(unit), F.col("quantity"))
    return df.withColumn("total_harga", F.when(needs_repair(total), expected).otherwise(total))
