"""Inputs with planted cases for rules that the derived orders alone do not reach."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlake.contracts import ORDER_COLUMNS, POSITION
from orderlake.plans.dirty_orders import dirty_orders, dirty_products


def raw_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a CSV source hands them over: numbers as texts, some of them
    missing-value tokens, suffixed, fractional, in another notation or no numbers."""
    return dirty_orders(spark, sf_dir).selectExpr(
        "order_id",
        """CASE pos % 8 WHEN 0 THEN 'NA' WHEN 1 THEN concat(quantity, '.0') WHEN 2 THEN concat(quantity, '.5')
                WHEN 3 THEN concat(quantity, 'd') WHEN 4 THEN 'many' ELSE string(quantity) END AS quantity""",
        """CASE pos % 7 WHEN 0 THEN 'null' WHEN 1 THEN concat(quantity, '5f') WHEN 2 THEN '0x1p3'
                WHEN 3 THEN concat(quantity, 'e3') WHEN 4 THEN concat('-', quantity, '.25')
                ELSE string(quantity) END AS total_harga""",
        "CASE pos % 5 WHEN 0 THEN '#N/A' WHEN 1 THEN 'none' WHEN 2 THEN '' ELSE 'Solo' END AS kota",
        "pos",
    )


def guessed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates in the shapes that are only guessed at."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("o_orderkey", "o_orderdate AS d")
    shapes = [
        "yyyy/MM/dd", "yyyyMMdd", "MM-dd-yyyy", "d MMM yyyy", "MMMM d, yyyy", "dd-MMM-yyyy", "MMMM d yyyy",
    ]
    cases = " ".join(f"WHEN {i} THEN date_format(d, '{shape}')" for i, shape in enumerate(shapes))
    return orders.selectExpr(
        "o_orderkey", f"CASE o_orderkey % 9 {cases} WHEN 7 THEN "
        "concat(date_format(d, 'yyyy-MM-dd'), ' 07:08:09.123456789') ELSE date_format(d, 'dd/MM/yy') END AS raw",
    )


def blank_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with blank-like addresses, tabs and line breaks at the ends, and
    cities of several words."""
    return dirty_orders(spark, sf_dir).selectExpr(
        "order_id", "pos", "product_name", "kategori", "channel", "status",
        """CASE pos % 6 WHEN 0 THEN ' NaN ' WHEN 1 THEN 'none' WHEN 2 THEN '\\t' WHEN 3 THEN 'None.'
                ELSE customer_email END AS customer_email""",
        """CASE pos % 4 WHEN 0 THEN concat('\\t', kota, '\\n') WHEN 1 THEN 'sungai-o\\'neil BARU'
                ELSE kota END AS kota""",
    )


def repeated_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog with a later row of another price for every third product."""
    products = dirty_products(spark, sf_dir)
    again = products.where(f"{POSITION} % 3 = 0").selectExpr(
        "product_id", "product_name", "kategori", "harga_satuan + 1 AS harga_satuan", "pos + 1000000000000 AS pos"
    )
    return products.unionByName(again)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as lines of ten CSV files in splits, each with its header: some lines with
    a field too many, some torn by a line break inside quotes, and one file whose
    header names the columns in another order."""
    fields = ", ".join(
        f"coalesce(concat('\"', replace(CAST({c} AS STRING), '\"', '\"\"'), '\"'), '')" for c in ORDER_COLUMNS
    )
    rows = dirty_orders(spark, sf_dir).selectExpr(
        "concat('file-', pos % 10) AS _file", "pos DIV 5000 * 5000 AS _block", "pos", f"concat_ws(',', {fields}) AS line",
    )
    lines = rows.selectExpr(
        "_file", "_block", """inline(CASE
            WHEN pos % 37 = 0 THEN array(named_struct('_row', 2 * pos, 'value', concat(line, ',more')))
            WHEN pos % 41 = 0 THEN array(
              named_struct('_row', 2 * pos, 'value', concat('"torn ', substr(line, 2, 4))),
              named_struct('_row', 2 * pos + 1, 'value', 'off'))
            ELSE array(named_struct('_row', 2 * pos, 'value', line)) END)""",
    )
    names, turned = ",".join(ORDER_COLUMNS), ",".join(ORDER_COLUMNS[::-1])
    headers = spark.range(10).selectExpr(
        "concat('file-', id) AS _file", "0L AS _block", "-1L AS _row", f"IF(id = 7, '{turned}', '{names}') AS value"
    )
    return lines.unionByName(headers)
