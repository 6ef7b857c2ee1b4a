"""Price arithmetic and buckets."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from orderlake.contracts import MEDIUM_UP_TO, SMALL_BELOW


def whole(c: Column) -> Column:
    """Round to a whole number, halves to the even neighbour."""
    return F.bround(c, 0)


def unit_price(total: Column, quantity: Column) -> Column:
    """Price per piece, whole; NULL for a quantity of 0."""
    return whole(F.try_divide(total, quantity))


def expected_total(price: Column, quantity: Column) -> Column:
    return (price * quantity).cast("double")


def price_bucket(total: Column) -> Column:
    """``kecil``, ``sedang`` or ``besar``; a missing price counts as ``besar``."""
    return (
        F.when(total < SMALL_BELOW, "kecil")
        .when(total <= MEDIUM_UP_TO, "sedang")
        .otherwise("besar")
    )
