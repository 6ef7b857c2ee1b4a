"""Strict recipe: every row is either clean or rejected with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderlake.contracts import POSITION, REASONS, STRICT_COLUMNS
from orderlake.functions.dates import month_period, parse_date
from orderlake.functions.money import unit_price
from orderlake.functions.text import clean_email, clean_lower, clean_title, strip
from orderlake.operators.dedupe import flag_known, flag_repeats, repeated_keys
from orderlake.operators.enrich import add_unit_price
from orderlake.operators.marts import sales_summary
from orderlake.operators.profile import date_shapes, long_form
from orderlake.operators.rules import only_completed, reject_reason
from orderlake.sources.layout import write_by_time
from orderlake.sources.positions import fixed_width
from orderlake.sources.quarantine import UNREADABLE, with_unreadable
from orderlake.sources.sinks import Attempt, attempt
from orderlake.sources.staging import stage, stage_counted, staged_run


def standardize_text(orders: DataFrame) -> DataFrame:
    """Uniform spelling; a missing text stays missing."""
    return orders.withColumns({
        "channel": clean_lower(F.col("channel")),
        "kota": clean_title(F.col("kota")),
        "status": clean_lower(F.col("status")),
        "product_name": strip(F.col("product_name")),
        "kategori": clean_title(F.col("kategori")),
        "customer_email": clean_email(F.col("customer_email")),
    })


def standardize_dates(orders: DataFrame) -> DataFrame:
    return orders.withColumn("tanggal_order", parse_date(F.col("tanggal_order")))


def classify(
    orders: DataFrame, repeated: DataFrame | None = None, known: DataFrame | None = None
) -> DataFrame:
    """Standardized rows with ``reject_reason``, NULL for clean ones. Repeats are
    judged over all rows, before any other rule removes one; an order in
    ``known`` (each once) is a repeat from its first row on.

    Dates are parsed below the joins: eight bytes are shuffled instead of the
    text, and a filter on the reason, pushed down, does not parse them again.
    """
    if repeated is None:
        repeated = repeated_keys(orders, "order_id")
    flagged = flag_repeats(standardize_dates(orders), "order_id", repeated=repeated)
    if known is not None:
        flagged = flag_known(flagged, "order_id", known)
    reason = reject_reason(
        F.col("is_repeat"), F.col("total_harga"), F.col("tanggal_order"), F.col("status")
    )
    return standardize_text(flagged).withColumn("reject_reason", reason).drop("is_repeat")


def rejected(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reject_reason").isNotNull()).drop(POSITION)


def accepted(classified: DataFrame) -> DataFrame:
    """Clean rows with the columns derived from the order alone."""
    return (
        classified.where(F.col("reject_reason").isNull())
        .drop("reject_reason")
        .withColumn("order_month", month_period(F.col("tanggal_order")))
        .withColumn("unit_price_check", unit_price(F.col("total_harga"), F.col("quantity")))
    )


def clean(classified: DataFrame, products: DataFrame) -> DataFrame:
    """The clean table: accepted rows with the catalog's unit price."""
    return add_unit_price(accepted(classified), products).select(STRICT_COLUMNS)


def summary(classified: DataFrame) -> DataFrame:
    """Completed sales per category, channel and month. The unit price is not
    part of it, so the catalog is not read."""
    return sales_summary(accepted(classified))


def row_counters() -> dict[str, Column]:
    """Counters over classified rows. The reason and the counter of unparsable dates
    differ: the latter counts all rows, whatever other rule rejects them."""
    reason = F.col("reject_reason")
    return {
        "rows_in": F.count(F.lit(1)),
        "unparsable_dates": F.count_if(F.col("tanggal_order").isNull()),
        **{name: F.count_if(reason == name) for name in REASONS},
        "rejected_rows": F.count(reason),
        "clean_rows": F.count_if(reason.isNull()),
        "completed_rows": F.count_if(reason.isNull() & (F.col("status") == "completed")),
    }


def metrics(classified: DataFrame, products: DataFrame) -> DataFrame:
    """Row counters as ``metric, value``; counted per product before the catalog
    is joined, so the join sees each product once."""
    counters = row_counters()
    per_product = classified.groupBy("product_id").agg(
        *[c.alias(name) for name, c in counters.items()]
    )
    unmatched = F.when(F.col("harga_satuan").isNull(), F.col("clean_rows"))
    one_row = add_unit_price(per_product, products).agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counters],
        F.coalesce(F.sum(unmatched), F.lit(0)).alias("unmatched_products"),
    )
    return long_form(one_row, "metric", "value")


def write_outputs(
    now: Attempt, classified: DataFrame, counted: dict, products: DataFrame,
    unreadable: DataFrame | None = None,
) -> DataFrame:
    """Write the clean, rejected and metrics tables; returns the clean one. The
    counters come from staging the classified rows and from writing the clean ones."""
    unmatched = F.count_if(F.col("harga_satuan").isNull())
    written, seen = now.write("clean", clean(classified, products), True, unmatched_products=unmatched)
    lost = F.count_if(F.col("reject_reason").isin(UNREADABLE))
    _, bad = now.write("rejected", with_unreadable(rejected(classified), unreadable), unreadable_rows=lost)
    told = {name: counted[name] for name in row_counters()} | {"unmatched_products": seen["unmatched_products"]}
    if unreadable is not None:
        told["unreadable_rows"] = bad["unreadable_rows"]
    now.write("metrics", counter_rows(now.spark, told))
    return written


def counter_rows(spark: SparkSession, counters: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(list(counters.items()), "metric string, value bigint").coalesce(1)


def size_rows(spark: SparkSession, sizes: dict[str, dict]) -> DataFrame:
    """Rows and columns of what was read, as the write that staged it saw them."""
    rows = [(name, size["rows"], size["columns"]) for name, size in sizes.items()]
    return spark.createDataFrame(rows, "source string, rows bigint, columns bigint").coalesce(1)


def run(
    orders: DataFrame, products: DataFrame, root: str, run_id: str,
    unreadable: DataFrame | None = None, by_time: bool = False,
) -> None:
    """Classify once, then publish the clean, rejected, summary, metrics, size and
    date shape tables together, and ``by_time`` the clean rows along the time ranges
    kept between runs (``layout.read_between``).

    The raw rows, the repeated keys and the classified rows are staged: the
    first fixes row positions, the second gives the join its real size, and
    the third is read by four outputs. ``unreadable`` lines, as a quarantining
    reader gives them, are rejected with their file and text.
    """
    spark = orders.sparkSession
    with staged_run(spark):
        staged, size = stage_counted(orders, "raw-orders")
        raw = fixed_width(staged)
        repeated = stage(repeated_keys(raw, "order_id"), "repeated-orders")
        classified, counted = stage_counted(classify(raw, repeated), "classified-orders", **row_counters())
        with attempt(spark, root, run_id) as now:
            written = write_outputs(now, classified, counted, products, unreadable)
            if by_time:
                write_by_time(now, "clean_by_time", written)
            now.write("summary", summary(classified))
            now.write("date_shapes", date_shapes(raw))
            now.write("size", size_rows(spark, {"orders": size}))
            now.commit()
