"""Dirty orders and a product catalog derived from the star-schema tables.

The derivation is deterministic and row-wise, so any engine can repeat it: it
plants repeats, odd spellings, mixed dates, bad prices, unknown products and
unknown states at fixed residues of the order key.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


@lru_cache(maxsize=64)
def _schema(path: str) -> StructType:
    return SparkSession.active().read.parquet(path).schema


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(path)).parquet(path)


_CENTS = "CAST(round(p_retailprice * 100) AS BIGINT)"


def dirty_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").selectExpr(
        "concat('P', p_partkey) AS product_id",
        "concat(' ', p_name) AS product_name",
        "p_type AS kategori",
        f"{_CENTS} AS harga_satuan",
        "p_partkey AS pos",
    )


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts meet the joined dimensions once, on one key, so a hot customer is
    one skewed join side that AQE can split. Copies come from an inline array
    rather than from further scans."""
    nation = _table(spark, sf_dir, "nation").selectExpr("n_nationkey AS c_nationkey", "n_name")
    customer = _table(spark, sf_dir, "customer").selectExpr("c_custkey AS o_custkey", "c_nationkey")
    part = _table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS o_custkey", "p_name", "p_type", f"{_CENTS} AS price"
    )
    dimension = part.join(customer, "o_custkey").join(nation, "c_nationkey")
    facts = _table(spark, sf_dir, "orders").join(dimension, "o_custkey")

    named = facts.selectExpr(
        "o_orderkey AS k", "o_custkey", "o_orderstatus", "o_orderdate AS day", "n_name", "p_name",
        "p_type", "price * (1 + o_orderkey % 5) AS total",
        """CASE WHEN o_orderkey % 7 < 3 THEN 'website' WHEN o_orderkey % 7 < 5 THEN 'marketplace'
                ELSE 'mobile app' END AS channel""",
        """explode(filter(array(0, IF(o_orderkey % 11 = 0, 1, NULL), IF(o_orderkey % 29 = 0, 2, NULL)),
                   c -> c IS NOT NULL)) AS copy""",
    )
    return named.selectExpr(
        "concat('ORD-', k) AS order_id",
        "IF(k % 97 = 0, 'P-none', concat('P', o_custkey)) AS product_id",
        "concat(' ', p_name) AS product_name",
        "p_type AS kategori",
        "1 + k % 5 AS quantity",
        """CAST(CASE WHEN k % 13 = 0 THEN NULL WHEN k % 17 = 0 THEN -total
                     WHEN k % 19 = 0 THEN 0 ELSE total END AS DOUBLE) AS total_harga""",
        """CASE WHEN k % 101 = 0 THEN 'not a date'
                WHEN k % 4 = 0 THEN date_format(day, 'yyyy-MM-dd HH:mm:ss')
                WHEN k % 4 = 1 THEN date_format(day, 'yyyy-MM-dd')
                WHEN k % 4 = 2 THEN date_format(day, 'dd/MM/yyyy')
                ELSE date_format(day, 'MMM dd, yyyy') END AS tanggal_order""",
        """concat(IF(k % 3 = 1, ' ', ''), CASE WHEN copy = 2 OR k % 3 = 1 THEN lower(n_name)
                WHEN k % 3 = 0 THEN upper(n_name) ELSE n_name END) AS kota""",
        "IF(k % 2 = 0, upper(channel), channel) AS channel",
        """CASE WHEN k % 103 = 0 THEN 'Returned' WHEN k % 23 = 0 THEN 'CANCELLED'
                WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'O' THEN 'Shipped'
                WHEN o_orderstatus = 'P' THEN 'pending' END AS status""",
        "IF(k % 6 = 0, NULL, concat('Customer', o_custkey, '@Email.com')) AS customer_email",
        "3 * k + copy AS pos",
    )
