"""Quality checks as rows of ``check, passed, n_bad``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from orderlake.contracts import COMPLETED, MAX_CHANNELS, GateFailed
from orderlake.operators.dedupe import content, copies
from orderlake.operators.profile import long_form, row_repeats, weighted


def as_checks(one_row: DataFrame) -> DataFrame:
    """Counts of bad rows per check, one row each; a check passes at 0."""
    rows = long_form(one_row, "check", "n_bad")
    return rows.select("check", (F.col("n_bad") == 0).alias("passed"), "n_bad")


def nulls_in_row(columns: list[str]) -> Column:
    flags = [F.col(c).isNull().cast("bigint") for c in columns]
    return reduce(lambda left, right: left + right, flags)


def quality_checks(
    df: DataFrame,
    max_channels: int | None = None,
    channels: list[str] | None = None,
    repeated: DataFrame | None = None,
) -> DataFrame:
    """The gate's four checks, in one aggregation; optionally also the number of
    channels (a missing one counts) and an allow-list for them. ``repeated`` may
    hold more orders than repeat here."""
    is_date = dict(df.dtypes)["tanggal_order"].startswith("timestamp")
    counts = {
        "zero_duplicates": row_repeats(),
        "zero_nulls": F.coalesce(F.sum(F.col("n") * nulls_in_row(content(df))), F.lit(0)),
        "zero_negative_price": weighted(F.col("total_harga") < 0),
        "datetime_type": F.lit(0 if is_date else 1).cast("bigint"),
    }
    if max_channels is not None:
        different = F.count_distinct(F.struct("channel"))
        counts["channel_count"] = F.greatest(different - max_channels, F.lit(0)).cast("bigint")
    if channels is not None:
        known = F.coalesce(F.col("channel").isin(channels), F.lit(False))
        counts["channel_allowed"] = weighted(~known)
    return as_checks(copies(df, "order_id", repeated).agg(*[c.alias(name) for name, c in counts.items()]))


def row_checks(df: DataFrame) -> dict[str, Column]:
    """The gate's checks that look at one row at a time, as counts of what is bad: for
    an observation while rows are written. NULL counts on no rows."""
    is_date = dict(df.dtypes)["tanggal_order"].startswith("timestamp")
    return {
        "zero_nulls": F.sum(nulls_in_row(content(df))),
        "zero_negative_price": F.count_if(F.col("total_harga") < 0),
        "datetime_type": F.max(F.lit(0 if is_date else 1)),
    }


def require_none(counts: dict[str, int], checks: list[str]) -> None:
    """Raise with the names of the checks that counted something."""
    failed = [name for name in checks if counts[name]]
    if failed:
        raise GateFailed(sorted(failed))


def tutorial_checks(df: DataFrame, channels: list[str] | None = None) -> DataFrame:
    """The gate's checks plus at most three channels."""
    return quality_checks(df, MAX_CHANNELS, channels)


def all_passed(checks: DataFrame) -> bool:
    return checks.where(~F.col("passed")).isEmpty()


def require(checks: DataFrame) -> None:
    """Raise with the names of the failed checks, if any."""
    failed = [row["check"] for row in checks.where(~F.col("passed")).select("check").collect()]
    if failed:
        raise GateFailed(sorted(failed))


def clean_price_check(clean: DataFrame) -> DataFrame:
    """No negative price is left in a cleaned table."""
    bad = F.count_if(F.col("total_harga") < 0)
    return as_checks(clean.agg(bad.alias("no_negative_price")))


def catalog_checks(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Catalog keys are unique, and every order's product is in the catalog.

    Both sides are counted per product before they meet, so neither a popular
    product nor a missing key makes a large group.
    """
    listed = products.groupBy("product_id").agg(F.count(F.lit(1)).alias("listed"))
    named = orders.groupBy("product_id").agg(F.count(F.lit(1)).alias("named"))
    both = listed.join(named, "product_id", "full_outer")
    extra = F.col("listed") - 1
    return as_checks(both.agg(
        F.coalesce(F.sum(extra), F.lit(0)).alias("catalog_key_unique"),
        F.coalesce(F.sum(F.when(F.col("listed").isNull(), F.col("named"))), F.lit(0))
        .alias("product_known"),
    ))


def mart_checks(clean: DataFrame, by_city: DataFrame, by_status: DataFrame) -> DataFrame:
    """The order counts of the marts add up to the clean table's rows."""
    completed = F.count_if(F.col("status") == COMPLETED)
    rows = clean.agg(
        completed.alias("category_city_total"), F.count(F.lit(1)).alias("channel_status_total")
    )
    missing = -F.coalesce(F.sum("order_count"), F.lit(0))
    parts = [
        long_form(rows, "check", "n"),
        long_form(by_city.agg(missing.alias("category_city_total")), "check", "n"),
        long_form(by_status.agg(missing.alias("channel_status_total")), "check", "n"),
    ]
    off = reduce(DataFrame.unionByName, parts).groupBy("check").agg(F.abs(F.sum("n")).alias("n_bad"))
    return off.select("check", (F.col("n_bad") == 0).alias("passed"), "n_bad")
