"""Repair recipe: keep one row per order and recompute bad prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderlake.contracts import COMPLETED, POSITION, ContractError
from orderlake.functions.dates import parse_date
from orderlake.functions.text import clean_lower, clean_title, strip
from orderlake.operators.checks import catalog_checks, require_none
from orderlake.operators.dedupe import keep_first, repeated_keys
from orderlake.operators.enrich import unique_unit_price
from orderlake.operators.marts import sales_by_category_city, sales_by_channel_status
from orderlake.operators.profile import long_form
from orderlake.operators.rules import needs_repair, repair_price
from orderlake.plans.strict import counter_rows
from orderlake.sources.positions import fixed_width
from orderlake.sources.sinks import replace_tables
from orderlake.sources.staging import stage, stage_counted, staged_run


def clean_products(products: DataFrame) -> DataFrame:
    return products.withColumns({
        "product_name": strip(F.col("product_name")),
        "kategori": clean_title(F.col("kategori")),
    })


def transform(
    orders: DataFrame, products: DataFrame, repeated: DataFrame | None = None
) -> DataFrame:
    """One row per order with a repaired price; unreadable dates are NULL."""
    return marked(orders, products, repeated).drop("_repaired")


def marked(orders: DataFrame, products: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """The same with ``_repaired``, whether the price was recomputed."""
    first = keep_first(orders, "order_id", repeated=repeated)
    first = first.withColumn("_repaired", needs_repair(F.col("total_harga")))
    repaired = repair_price(unique_unit_price(first, products)).drop("harga_satuan")
    return repaired.withColumns({
        "tanggal_order": parse_date(F.col("tanggal_order")),
        "kota": clean_title(F.col("kota")),
        "channel": clean_lower(F.col("channel")),
        "status": clean_lower(F.col("status")),
        "customer_email": clean_lower(F.col("customer_email")),
    }).select(*orders.columns, "_repaired")


def metrics(orders: DataFrame) -> DataFrame:
    """Row counters as ``metric, value``, in one pass: copies and first row per
    order are combined before the shuffle."""
    first = F.min_by(F.struct("total_harga", "tanggal_order"), POSITION)
    kept = orders.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"), first.alias("row"))
    one_row = kept.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_order_id"),
        F.count_if(parse_date(F.col("row.tanggal_order")).isNull()).alias("unparsable_dates"),
        F.count_if(needs_repair(F.col("row.total_harga"))).alias("repaired_prices"),
        F.count(F.lit(1)).alias("clean_rows"),
    )
    return long_form(one_row, "metric", "value")


def require_unique(products: DataFrame) -> None:
    """Raise with the first few repeated keys of a catalog, if any."""
    repeated = products.groupBy("product_id").count().where("count > 1").select("product_id")
    keys = [str(row[0]) for row in repeated.orderBy("product_id").take(10)]
    if keys:
        raise ContractError(f"the catalog lists a product more than once: {', '.join(keys)}")


def run(orders: DataFrame, products: DataFrame, database: str = "default") -> DataFrame:
    """Replace the clean table, its two marts and the counters; returns the checks.

    Everything is staged and checked first: a repeated catalog key, a negative
    price left or a mart that does not add up stops the run with all tables as
    they were. Products missing from the catalog are only reported. Size, counters
    and checks of the clean rows are collected while they are staged; then all
    tables change with one commit.
    """
    spark = orders.sparkSession
    with staged_run(spark):
        catalog = stage(clean_products(products), "catalog")
        require_unique(catalog)
        staged, size = stage_counted(orders, "raw-orders")
        raw = fixed_width(staged)
        repeated = stage(repeated_keys(raw, "order_id"), "repeated-orders")
        clean, seen = stage_counted(
            marked(raw, catalog, repeated).drop(POSITION), "repaired-orders",
            unparsable_dates=F.count_if(F.col("tanggal_order").isNull()),
            repaired_prices=F.count_if("_repaired"),
            negative_prices=F.count_if(F.col("total_harga") < 0),
            completed_rows=F.count_if(F.col("status") == COMPLETED),
        )
        by_city = stage(sales_by_category_city(clean), "category-city")
        by_status = stage(sales_by_channel_status(clean), "channel-status")
        counters = {
            "rows_in": size["rows"], "duplicate_order_id": size["rows"] - seen["rows"],
            "unparsable_dates": seen["unparsable_dates"], "repaired_prices": seen["repaired_prices"],
            "clean_rows": seen["rows"],
        }
        in_marts = [mart.agg(F.coalesce(F.sum("order_count"), F.lit(0))).first()[0] for mart in (by_city, by_status)]
        gate = {
            "no_negative_price": seen["negative_prices"],
            "category_city_total": abs(seen["completed_rows"] - in_marts[0]),
            "channel_status_total": abs(seen["rows"] - in_marts[1]),
        }
        reports = catalog_checks(clean, catalog).collect()
        found = [(name, n == 0, n) for name, n in gate.items()] + [tuple(r) for r in reports]
        checks = spark.createDataFrame(found, "check string, passed boolean, n_bad bigint")
        require_none(gate, list(gate))
        replace_tables({
            "cleaned_orders": clean, "sales_by_category_city": by_city,
            "sales_by_channel_status": by_status, "repair_metrics": counter_rows(spark, counters),
        }, database)
    return checks
