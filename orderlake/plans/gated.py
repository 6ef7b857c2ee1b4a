"""Gated recipe: drop what is bad, then publish only if every check passes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderlake.functions.dates import month_name, parse_date
from orderlake.functions.money import price_bucket
from orderlake.functions.text import clean_title, fill_email, snake
from orderlake.operators.checks import require_none, row_checks
from orderlake.operators.dedupe import copies, distinct_rows, repeated_keys
from orderlake.operators.marts import category_report, run_totals
from orderlake.operators.profile import long_form, row_repeats
from orderlake.operators.rules import drop_negative_price
from orderlake.plans.strict import counter_rows, size_rows
from orderlake.sources.positions import fixed_width
from orderlake.sources.sinks import attempt
from orderlake.sources.staging import observed, stage, stage_counted, staged_run


def transform(orders: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """Distinct rows with a price of 0 or more, dates read month first. A date
    that cannot be read is NULL here and stops the run at the gate."""
    return finished(distinct_rows(orders, "order_id", repeated))


def finished(distinct: DataFrame) -> DataFrame:
    return (
        drop_negative_price(distinct)
        .withColumns({
            "customer_email": fill_email(F.col("customer_email")),
            "tanggal_order": parse_date(F.col("tanggal_order"), month_first=True),
            "kota": clean_title(F.col("kota")),
            "channel": snake(F.col("channel")),
        })
        .withColumns({
            "bulan": month_name(F.col("tanggal_order")),
            "kategori_harga": price_bucket(F.col("total_harga")),
        })
    )


def metrics(orders: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """Row counters as ``metric, value``."""
    price = F.col("total_harga")
    one_row = copies(orders, "order_id", repeated).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in"),
        row_repeats().alias("duplicate_rows"),
        F.count_if(price < 0).alias("negative_price"),
        F.count_if(price >= 0).alias("clean_rows"),
    )
    return long_form(one_row, "metric", "value")


def run(orders: DataFrame, root: str, run_id: str) -> None:
    """Transform, write, check, publish. ``GateFailed`` leaves the previous run in place.

    Size, counters and checks are collected while rows are staged and written. Only
    the check for duplicates reads rows again: those of orders that repeat in the
    raw rows, as no others can repeat in the clean ones.
    """
    spark = orders.sparkSession
    with staged_run(spark), attempt(spark, root, run_id) as now:
        staged, size = stage_counted(orders, "raw-orders")
        raw = fixed_width(staged)
        repeated = stage(repeated_keys(raw, "order_id"), "repeated-orders")
        price = F.col("total_harga")
        distinct, found = observed(distinct_rows(raw, "order_id", repeated), {
            "negative_price": F.count_if(price < 0), "clean_rows": F.count_if(price >= 0),
        })
        clean = finished(distinct)
        written, bad = now.write("clean", clean, **row_checks(clean))
        again = written.join(repeated.select("_key"), F.col("order_id").eqNullSafe(F.col("_key")), "left_semi")
        bad["zero_duplicates"] = copies(again).agg(row_repeats()).first()[0]
        require_none(bad, ["zero_duplicates", *row_checks(clean)])
        report, _ = now.write("report", category_report(written))
        now.write("totals", run_totals(report))
        seen = {k: v or 0 for k, v in found.get.items()}
        now.write("metrics", counter_rows(spark, {
            "rows_in": size["rows"], "duplicate_rows": size["rows"] - seen["rows"],
            "negative_price": seen["negative_price"], "clean_rows": seen["clean_rows"],
        }))
        now.write("size", size_rows(spark, {"orders": size}))
        now.commit()
