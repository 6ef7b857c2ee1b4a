"""Catalog lookups.

No join here carries a broadcast hint: Spark broadcasts the catalog while its
size is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles,
where AQE splits the partition of a hot product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderlake.contracts import POSITION
from orderlake.operators.dedupe import keep_first


def add_unit_price(
    orders: DataFrame,
    products: DataFrame,
    key: str = "product_id",
    value: str = "harga_satuan",
    position: str = POSITION,
) -> DataFrame:
    """Left join of one catalog value. The first row of a catalog key counts,
    and a missing key matches nothing."""
    prices = keep_first(products.where(F.col(key).isNotNull()), key, position)
    return orders.join(prices.select(key, value), key, "left")


def unique_unit_price(
    orders: DataFrame,
    products: DataFrame,
    key: str = "product_id",
    value: str = "harga_satuan",
) -> DataFrame:
    """Left join of one catalog value that fails on a repeated catalog key, as a
    lookup with two answers would either guess or multiply the orders."""
    repeated = F.raise_error(F.concat(F.lit("duplicate catalog key: "), F.col(key)))
    kind = products.schema[value].dataType
    only = F.when(F.count(F.lit(1)) > 1, repeated.cast(kind)).otherwise(F.max(value))
    prices = products.where(F.col(key).isNotNull()).groupBy(key).agg(only.alias(value))
    return orders.join(prices, key, "left")


def unmatched_products(orders: DataFrame, products: DataFrame, key: str = "product_id") -> DataFrame:
    """Products that orders name and the catalog lacks, with their order count.

    Orders are counted per product first, so the anti join sees each product once.
    """
    named = orders.groupBy(key).agg(F.count(F.lit(1)).alias("order_count"))
    return named.join(products.select(key).distinct(), key, "left_anti")
