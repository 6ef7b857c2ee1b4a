"""First look at raw tables: sizes, duplicates, gaps, raw values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orderlake.contracts import POSITION
from orderlake.operators.dedupe import content, copies
from orderlake.functions.dates import parse_date
from orderlake.functions.text import strip
from orderlake.operators.marts import by_dimension
from orderlake.sources.readers import null_tokens, number


def weighted(condition: Column, n: str = "n") -> Column:
    """Number of raw rows that meet the condition, over ``copies``."""
    return F.coalesce(F.sum(F.when(condition, F.col(n))), F.lit(0))


def row_repeats(n: str = "n") -> Column:
    """Number of rows that repeat an earlier row, over ``copies``."""
    return F.coalesce(F.sum(F.col(n)) - F.count(F.lit(1)), F.lit(0))


def key_repeats(key: str, n: str = "n") -> Column:
    """Number of rows that repeat an earlier key; the struct makes a missing
    key a value of its own."""
    return F.coalesce(F.sum(F.col(n)) - F.count_distinct(F.struct(key)), F.lit(0))


def long_form(one_row: DataFrame, name: str, value: str) -> DataFrame:
    """One row per column of a one-row result."""
    return one_row.unpivot([], one_row.columns, name, value)


def summary(orders: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """Row and column counts, duplicates and price problems as ``metric, value``.

    Counts over raw rows are sums weighted by ``n`` over ``copies``, so the
    shuffle that finds duplicate rows serves everything else too.
    """
    price = F.col("total_harga")
    one_row = copies(orders, "order_id", repeated).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.lit(len(content(orders))).cast("bigint").alias("columns"),
        row_repeats().alias("duplicate_rows"),
        key_repeats("order_id").alias("duplicate_order_id"),
        weighted(price <= 0).alias("price_not_positive"),
        weighted(price.isNull()).alias("price_missing"),
    )
    return long_form(one_row, "metric", "value")


def catalog_summary(products: DataFrame) -> DataFrame:
    """Row count and duplicate keys of the catalog as ``metric, value``."""
    keys = products.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    one_row = keys.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        row_repeats().alias("duplicate_product_id"),
    )
    return long_form(one_row, "metric", "value")


def gaps(df: DataFrame) -> DataFrame:
    """Missing and present values per column: ``column, type, missing, present``."""
    types = dict(df.dtypes)
    columns = content(df)
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in columns]
    )
    tagged = F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            F.lit(types[c]).alias("type"),
            (F.col("_rows") - F.col(c)).alias("missing"),
            F.col(c).alias("present"),
        )
        for c in columns
    ])
    return counts.select(F.inline(tagged))


def raw_values(
    df: DataFrame,
    columns: tuple[str, ...] = ("channel", "kota", "status"),
    position: str = POSITION,
) -> DataFrame:
    """Every raw value of each column with its count, in order of first sight."""
    first_seen = [F.count(F.lit(1)).alias("rows"), F.min(position).alias("_first")]
    return (
        by_dimension(df, list(columns), first_seen)
        .withColumnsRenamed({"dimension": "column", "segment": "value"})
        .orderBy("column", "_first")
        .drop("_first")
    )


def sample_dates(
    df: DataFrame, n: int = 5, seed: int = 42, position: str = POSITION
) -> DataFrame:
    """``n`` raw dates, the same ones on each run: rows in the order of a seeded
    digest, cut by a top-n that keeps n rows per task."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(position).cast("string")))
    return df.orderBy(digest, position).limit(n).select("tanggal_order")


_WHOLE, _FRACTION, _DATE, _TEXT = "whole", "fraction", "date", "text"


def _kind(c: Column) -> Column:
    """What one text value can be read as, NULL for a missing one."""
    value = null_tokens(c)
    plain = value.rlike(r"^\s*[+-]?\d{1,18}\s*$")
    return (
        F.when(value.isNull(), None)
        .when(plain, _WHOLE)
        .when(number(value, "double").isNotNull(), _FRACTION)
        .when(parse_date(value).isNotNull(), _DATE)
        .otherwise(_TEXT)
    )


def type_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """How many values of each text column can be read as what: ``column, missing, whole,
    fraction, date, text``, in one pass. Rows of several runs add up."""
    columns = columns or [c for c, kind in df.dtypes if kind == "string" and c != POSITION]
    kinds = df.select(*[_kind(F.col(c)).alias(c) for c in columns])
    counts = kinds.agg(*[
        F.struct(
            F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("missing"),
            *[F.count_if(F.col(c) == kind).alias(kind) for kind in (_WHOLE, _FRACTION, _DATE, _TEXT)],
        ).alias(f"c{i}")
        for i, c in enumerate(columns)
    ])
    return counts.select(F.inline(F.array(*[f"c{i}" for i in range(len(columns))])))


def inferred_types(counts: DataFrame) -> DataFrame:
    """The narrowest type that holds all values of a column: whole numbers widen to
    doubles, dates and numbers meet in text, and a column without values is empty."""
    total = counts.groupBy("column").agg(*[
        F.sum(c).alias(c) for c in ("missing", _WHOLE, _FRACTION, _DATE, _TEXT)
    ])
    numbers = F.col(_WHOLE) + F.col(_FRACTION)
    kind = (
        F.when((F.col(_TEXT) > 0) | ((F.col(_DATE) > 0) & (numbers > 0)), "string")
        .when(F.col(_DATE) > 0, "timestamp").when(F.col(_FRACTION) > 0, "double")
        .when(F.col(_WHOLE) > 0, "bigint").otherwise("empty")
    )
    return total.withColumn("type", kind)


def date_shapes(df: DataFrame, column: str = "tanggal_order") -> DataFrame:
    """Shapes of raw dates, digits as 9 and words as a: ``shape, rows, unread`` (no date
    can be read), ``ambiguous`` (day first and month first differ), and an example."""
    raw = F.col(column)
    shape = F.regexp_replace(F.regexp_replace(strip(raw), r"\p{L}+", "a"), r"\d", "9")
    day, month = parse_date(raw), parse_date(raw, month_first=True)
    return df.where(raw.isNotNull()).groupBy(shape.alias("shape")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(day.isNull()).alias("unread"),
        F.count_if(day != month).alias("ambiguous"), F.min(raw).alias("example"),
    )
