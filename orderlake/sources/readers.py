"""CSV and Parquet sources with a column contract and a row position."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderlake.contracts import (
    NULL_TOKENS, ORDER_COLUMNS, ORDER_NUMBERS, POSITION, PRODUCT_COLUMNS,
    PRODUCT_NUMBERS, ContractError,
)


_MALFORMED = "_malformed_row"


def require_columns(df: DataFrame, required: list[str], name: str) -> DataFrame:
    """Check that the columns are there; their order is free, extras may follow."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ContractError(f"{name} is missing expected columns: {', '.join(missing)}")
    return df


def null_tokens(c: Column) -> Column:
    """Texts that stand for a missing value become NULL; others stay as they are."""
    return F.when(~c.isin(NULL_TOKENS), c)


def number(c: Column, kind: str) -> Column:
    """Read a number; text that is none, a fraction in a whole-number column and
    NaN become NULL."""
    # Java would also read type suffixes and hexadecimal numbers.
    c = F.when(~c.rlike(r"(?i)\d\.?[df]\s*$|x"), c)
    value = c.try_cast("double")
    if kind == "bigint":
        whole = F.when(value == F.floor(value), value.try_cast("bigint"))
        return F.coalesce(c.try_cast("bigint"), whole)
    return F.when(~F.isnan(value), value)


def typed(df: DataFrame, numbers: dict[str, str]) -> DataFrame:
    """Text columns as read from CSV, with missing values and numbers resolved."""
    texts = [c for c, kind in df.dtypes if kind == "string"]
    cleaned = {c: null_tokens(F.col(c)) for c in texts}
    for c, kind in numbers.items():
        if c in cleaned:
            cleaned[c] = number(cleaned[c], kind)
    return df.withColumns(cleaned)


def open_source(read, name: str) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        raise ContractError(f"cannot read {name}: {error}") from error


def csv_split() -> Column:
    """The file and split a row comes from."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def csv_position() -> Column:
    """Split and row order within the split: a row's place in the input, however
    the splits are packed into tasks."""
    return F.struct(csv_split().alias("split"), F.monotonically_increasing_id().alias("row"))


def read_csv(
    spark: SparkSession,
    path: str,
    required: list[str] | None = None,
    numbers: dict[str, str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header and doubled quotes, bound by column name.

    All files of one path must share a header; one that differs fails the read
    rather than shifting columns. ``multi_line`` allows line breaks inside
    quotes, at the cost of one task per file. Short rows are filled up; a row
    with more fields than the header, or torn by a line break inside quotes,
    fails the read when it is reached.
    """
    reader = spark.read.options(
        header=True, escape='"', enforceSchema=False, multiLine=multi_line
    )
    schema = open_source(lambda: reader.csv(path).schema, path)
    raw = open_source(
        lambda: reader.schema(schema.add(_MALFORMED, "string")).csv(
            path, columnNameOfCorruptRecord=_MALFORMED
        ),
        path,
    )
    require_columns(raw, required or [], path)
    whole = raw.where(_readable(schema.names[:-1], path)).drop(_MALFORMED)
    return typed(whole.select("*", csv_position().alias(POSITION)), numbers or {})


def _readable(columns: list[str], path: str) -> Column:
    """True, or an error for a row with surplus fields or an unpaired quote. Spark
    hands over rows whose number of fields differs. It sees that only where it
    reads every column, so all go into the message."""
    bare = F.regexp_replace(_MALFORMED, r'"([^"]|"")*"', "")
    surplus = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) >= len(columns)
    message = F.concat(
        F.lit(f"ContractError: a row of {path} has surplus fields or a quote that is not closed, "
              "near "), F.concat_ws(",", *[F.col(f"`{c}`") for c in columns]),
    )
    return F.when(surplus | bare.contains('"'), F.raise_error(message).cast("boolean")).otherwise(True)


def read_parquet(
    spark: SparkSession, path: str, required: list[str] | None = None
) -> DataFrame:
    """Parquet with file and row number as position."""
    raw = open_source(lambda: spark.read.parquet(path), path)
    require_columns(raw, required or [], path)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    return raw.select("*", place.alias(POSITION))


def read_orders(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_csv(spark, path, ORDER_COLUMNS, ORDER_NUMBERS, multi_line)


def read_products(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_csv(spark, path, PRODUCT_COLUMNS, PRODUCT_NUMBERS, multi_line)

