"""CSV lines that cannot be read as rows are set apart with a reason.

Files are read as lines, so one bad line or file neither stops a run nor passes
as something else. A line is set apart when it has more fields than the header,
when a quote in it is not closed, when it belongs to the rest of such a row, or
when its file does not carry the expected header. Batch and stream share the
rules; ``readers.read_csv`` refuses the whole read instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from orderlake.contracts import ORDER_COLUMNS, ORDER_NUMBERS, POSITION, PRODUCT_COLUMNS, PRODUCT_NUMBERS
from orderlake.sources.readers import csv_position, open_source, typed
from orderlake.sources.staging import stage

SURPLUS, UNCLOSED, FOREIGN = "surplus_fields", "unclosed_quote", "foreign_header"
UNREADABLE = [SURPLUS, UNCLOSED, FOREIGN]
#: What is known of a line: NULL for a full row, else one of these or a reason.
_HEADER, _SHORT = "header", "short"
STATE, LINE, FILE = "line_state", "source_line", "source_file"


@dataclass(frozen=True)
class Sorted:
    """Rows that can be read, typed, and the lines that cannot: ``source_file,
    source_line, reject_reason``."""

    rows: DataFrame
    unreadable: DataFrame


def parse_lines(lines: DataFrame, columns: list[str], value: str = "value") -> DataFrame:
    """Lines as text columns, with ``line_state`` and, where a line is no full row, the
    line itself; other columns pass. Blank lines are no rows."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    fields = F.from_csv(F.col(value), schema, {"escape": '"'})
    passed = [c for c in lines.columns if c != value]
    rows = lines.where(F.col(value).rlike(r"[^\x00-\x20]")).select(*passed, fields.alias("_fields"), value)
    bare = F.regexp_replace(value, r'"([^"]|"")*"', "")
    commas = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit("")))
    header = F.lit(True)
    for i, name in enumerate(columns):
        have = F.col("_fields")[name]
        header &= F.coalesce((F.ltrim(have, F.lit("\ufeff")) if not i else have) == name, F.lit(False))
    state = (
        F.when(bare.contains('"'), UNCLOSED)
        .when(commas >= len(columns), SURPLUS)
        .when(commas < len(columns) - 1, _SHORT)
        .when(header, _HEADER)
    )
    return rows.select(
        *passed, *[F.col("_fields")[c].alias(c) for c in columns], state.alias(STATE),
        F.when(state.isNotNull() & (state != _HEADER), F.col(value)).alias(LINE),
    )


def _torn(parsed: DataFrame, split: list[str], row: str) -> DataFrame:
    """Short lines behind an unclosed quote, before the next full row, are parts of the
    torn row: ``_tail``. Read per split; what a split begins with comes from the
    splits of its file before it."""
    # A row that ends a tear, or begins one; short lines do neither.
    anchor = F.when(F.col(STATE) == UNCLOSED, True).when(F.col(STATE).isNull() | (F.col(STATE) != _SHORT), False)
    marked = parsed.withColumn("_open", anchor)
    ends = marked.groupBy(*split).agg(F.max_by("_open", F.when(F.col("_open").isNotNull(), F.col(row))).alias("_left"))
    file, block = split
    earlier = Window.partitionBy(file).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    begins = ends.select(*split, F.last("_left", True).over(earlier).alias("_begun"))
    within = Window.partitionBy(*split).orderBy(row)
    inside = F.coalesce(F.last("_open", True).over(within), F.col("_begun"), F.lit(False))
    return marked.join(begins, split).withColumn("_tail", (F.col(STATE) == _SHORT) & inside).drop("_open", "_begun")


def sort_out(
    parsed: DataFrame, columns: list[str], numbers: dict[str, str],
    file: str = "_file", block: str = "_block", row: str = "_row",
) -> Sorted:
    """Split parsed lines, best staged before, into rows and unreadable lines.

    Which files lack the header, and which hold a torn row, is read from the file
    and state columns alone. Lines are only ordered in files with a torn row.
    """
    state = F.col(STATE)
    files = parsed.groupBy(file).agg(
        F.coalesce(F.bool_or(state == _HEADER), F.lit(False)).alias("_named"),
        F.coalesce(F.bool_or(state == UNCLOSED), F.lit(False)).alias("_tears"),
    )
    foreign = files.where("NOT _named").select(file)
    known = parsed.join(foreign, file, "left_anti")
    tears = files.where("_named AND _tears").select(file)
    whole = known.join(tears, file, "left_anti").withColumn("_tail", F.lit(False))
    torn = _torn(known.join(tears, file, "left_semi"), [file, block], row)
    judged = whole.unionByName(torn.select(whole.columns))
    reason = F.when(F.col("_tail"), UNCLOSED).when(state.isin(UNCLOSED, SURPLUS), state)
    judged = judged.withColumn("reject_reason", reason)
    rows = judged.where(F.col("reject_reason").isNull() & F.coalesce(state != _HEADER, F.lit(True)))
    bad = judged.where(F.col("reject_reason").isNotNull())
    strange = parsed.join(foreign, file, "left_semi").withColumns({
        "reject_reason": F.lit(FOREIGN),
        # Full rows keep no line; the same fields written again say as much.
        LINE: F.coalesce(F.col(LINE), F.to_csv(F.struct(*columns), {"escape": '"'})),
    })
    told = [F.col(file).alias(FILE), F.col(LINE), F.col("reject_reason")]
    drop = [STATE, LINE, "_tail", "reject_reason"]
    return Sorted(typed(rows.drop(*drop), numbers), bad.select(told).unionByName(strange.select(told)))


def read_lines(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Parsed lines of CSV files with their file, split and place there."""
    lines = open_source(lambda: spark.read.text(path), path).select(
        "value", F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"), csv_position().alias(POSITION),
    )
    return parse_lines(lines.withColumn("_row", F.col(POSITION)["row"]), columns)


def read_sorted(spark: SparkSession, path: str, columns: list[str], numbers: dict[str, str]) -> Sorted:
    """A batch source whose unreadable lines are set apart. The header is the given
    columns in their order. Lines are parsed once and staged, as they are read for
    their files, for rows and for what is left."""
    found = sort_out(stage(read_lines(spark, path, columns), "parsed-lines"), columns, numbers)
    return Sorted(found.rows.drop("_file", "_block", "_row"), found.unreadable)


def read_orders(spark: SparkSession, path: str) -> Sorted:
    return read_sorted(spark, path, ORDER_COLUMNS, ORDER_NUMBERS)


def read_products(spark: SparkSession, path: str) -> Sorted:
    return read_sorted(spark, path, PRODUCT_COLUMNS, PRODUCT_NUMBERS)


def with_unreadable(rejected: DataFrame, unreadable: DataFrame | None) -> DataFrame:
    """Rows rejected by rules and lines rejected by the reader as one table; a line has
    its file and text in place of order columns."""
    if unreadable is None:
        return rejected
    return rejected.unionByName(unreadable, allowMissingColumns=True)
