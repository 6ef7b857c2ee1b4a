"""Whole recipes on the committed example files, read as data from the folder in
``ORDERLAKE_GOLDEN`` (with ``raw`` and ``processed``); skipped without one."""

import os

import pytest
from pyspark.sql import functions as F

from orderlake.operators import marts
from orderlake.plans import gated, repair, strict
from orderlake.sources import readers

FOLDER = os.environ.get("ORDERLAKE_GOLDEN", "")
pytestmark = pytest.mark.skipif(not FOLDER, reason="ORDERLAKE_GOLDEN is not set")


@pytest.fixture(scope="module")
def orders(spark):
    return readers.read_orders(spark, f"{FOLDER}/raw/raw_orders.csv")


@pytest.fixture(scope="module")
def products(spark):
    return readers.read_products(spark, f"{FOLDER}/raw/raw_products.csv")


def test_gated_equals_the_committed_rows(spark, orders):
    clean = gated.transform(orders)
    clean = clean.select([c for c in clean.columns if c != "pos"])
    wanted = readers.typed(
        spark.read.options(header=True, escape='"').csv(f"{FOLDER}/processed/orders_clean.csv"),
        {"quantity": "bigint", "total_harga": "double"},
    ).withColumn("tanggal_order", F.col("tanggal_order").cast("timestamp_ntz")).select(clean.columns)
    assert clean.count() == 110
    assert clean.exceptAll(wanted).isEmpty() and wanted.exceptAll(clean).isEmpty()
    report = marts.category_report(clean)
    lines = spark.read.options(header=True).csv(f"{FOLDER}/processed/summary_report.csv").collect()
    have = {r.kategori: (r.total_orders, r.total_revenue, r.avg_revenue) for r in report.collect()}
    assert have == {
        r.kategori: (int(r.total_orders), float(r.total_revenue), float(r.avg_revenue)) for r in lines
    }


def test_strict_and_repair_counts(orders, products):
    classified = strict.classify(orders)
    assert strict.clean(classified, products).count() == 110
    reasons = strict.rejected(classified).groupBy("reject_reason").count().collect()
    assert {r[0]: r[1] for r in reasons} == {
        "duplicate_order_id": 10, "missing_or_non_positive_total_harga": 10,
    }
    repaired = repair.transform(orders, repair.clean_products(products))
    assert tuple(repaired.agg(F.count("*"), F.sum("total_harga")).first()) == (120, 618360000.0)
