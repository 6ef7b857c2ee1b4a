import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderlake.contracts import GATED_COLUMNS, ORDER_COLUMNS, ContractError, GateFailed
from orderlake.operators import checks, dedupe
from orderlake.plans import gated, repair, strict
from orderlake.sources import readers, sinks

from rows import LINES, PRODUCTS, orders_csv


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("orders")
    (folder / "orders.csv").write_text(orders_csv())
    (folder / "products.csv").write_text(PRODUCTS)
    return folder


@pytest.fixture(scope="module")
def orders(spark, files):
    return readers.read_orders(spark, str(files / "orders.csv"))


@pytest.fixture(scope="module")
def products(spark, files):
    return readers.read_products(spark, str(files / "products.csv"))


PRICE = "missing_or_non_positive_total_harga"


def values(metrics):
    return {r.metric: r.value for r in metrics.collect()}


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_strict(orders, products):
    classified = strict.classify(orders)
    reasons = [(r.order_id, r.reject_reason) for r in classified.orderBy("pos").collect()]
    assert reasons == [
        ("A1", None), ("A1", "duplicate_order_id"), ("A2", None), ("A2", "duplicate_order_id"),
        ("A3", PRICE), ("A3", "duplicate_order_id"), ("A4", PRICE), ("A5", PRICE),
        ("A6", "unparsable_date"), ("A7", "invalid_status"), ("A8", None), ("A9", "invalid_status"),
    ]
    clean = {r.order_id: r for r in strict.clean(classified, products).collect()}
    first = clean["A1"]
    assert first.asDict() == {
        "order_id": "A1", "product_id": "P1", "product_name": 'Screen 24"', "kategori": "Elektronik",
        "quantity": 2, "harga_satuan": 200000, "total_harga": 400000.0,
        "unit_price_check": 200000.0, "tanggal_order": dt.datetime(2024, 6, 3),
        "order_month": "2024-06", "kota": "Surabaya", "channel": "website", "status": "completed",
        "customer_email": "ann@mail.com",
    }
    assert clean["A2"].kota == "O'Neil Town" and clean["A2"].channel == "mobile app"
    assert clean["A8"].harga_satuan is None and clean["A8"].customer_email is None
    rejected = strict.rejected(classified)
    assert rejected.columns == ORDER_COLUMNS + ["reject_reason"] and rejected.count() == 9
    assert [tuple(r) for r in strict.summary(classified).collect()] == [
        ("channel", "marketplace", 1, 4, 2600000.0), ("channel", "website", 1, 2, 400000.0),
        ("kategori", "Elektronik", 1, 2, 400000.0), ("kategori", "Furniture", 1, 4, 2600000.0),
        ("order_month", "2024-05", 1, 4, 2600000.0), ("order_month", "2024-06", 1, 2, 400000.0),
    ]
    assert values(strict.metrics(classified, products)) == {
        "rows_in": 12, "unparsable_dates": 1, "duplicate_order_id": 3, PRICE: 3,
        "unparsable_date": 1, "invalid_status": 2, "rejected_rows": 9, "clean_rows": 3,
        "completed_rows": 2, "unmatched_products": 1,
    }


def test_strict_run_publishes_what_the_operators_give(spark, orders, products, tmp_path):
    root = str(tmp_path / "lake")
    strict.run(orders, products, root, "r1")
    classified = strict.classify(orders)
    clean = sinks.published(spark, root, "clean")
    expected = strict.clean(classified, products)
    assert same(clean.select(expected.columns), expected)
    for name, df in {
        "rejected": strict.rejected(classified),
        "summary": strict.summary(classified),
        "metrics": strict.metrics(classified, products),
    }.items():
        assert same(sinks.published(spark, root, name), df)


def test_strict_without_rejects(orders):
    assert strict.rejected(strict.classify(orders.limit(1))).collect() == []


def test_gated(spark, orders):
    clean = gated.transform(orders)
    assert clean.columns == GATED_COLUMNS
    by_id = {r.order_id: r for r in clean.collect()}
    # One whole-row copy of A2 goes, the unpriced A3 and the negative A4 go.
    assert clean.count() == 9 and "A4" not in by_id
    assert (by_id["A1"].tanggal_order, by_id["A1"].bulan) == (dt.datetime(2024, 3, 6), "March")
    assert by_id["A2"].tanggal_order == dt.datetime(2024, 7, 15)
    assert by_id["A2"].channel == "mobile_app" and by_id["A2"].kota == "O'Neil Town"
    assert by_id["A2"].customer_email == "unknown@placeholder.com"
    assert [by_id[k].kategori_harga for k in ("A1", "A2", "A5", "A8")] == [
        "kecil", "sedang", "kecil", "besar",
    ]
    states = {r.status for r in clean.where("order_id = 'A1'").collect()}
    assert states == {"Completed", "completed"} and by_id["A6"].tanggal_order is None
    assert values(gated.metrics(orders)) == {
        "rows_in": 12, "duplicate_rows": 1, "negative_price": 1, "clean_rows": 9,
    }
    repeated = dedupe.repeated_keys(orders, "order_id")
    assert same(gated.transform(orders, repeated), clean)
    assert values(gated.metrics(orders, repeated)) == values(gated.metrics(orders))


def test_rows_that_differ_in_spelling_only_stop_the_gate(orders):
    """They are different rows when copies are dropped and equal afterwards."""
    twins = orders.where("order_id = 'A2'").limit(1)
    both = twins.unionByName(twins.withColumn("kota", F.upper("kota")))
    found = checks.quality_checks(gated.transform(both))
    assert {r["check"] for r in found.where("NOT passed").collect()} == {"zero_duplicates"}


def test_gated_run_publishes_only_clean_data(spark, files, tmp_path):
    root = str(tmp_path / "lake")
    good = tmp_path / "good.csv"
    good.write_text(orders_csv([LINES[0], LINES[2], LINES[3], LINES[6], LINES[10]]))
    gated.run(readers.read_orders(spark, str(good)), root, "r1")
    assert [tuple(r) for r in sinks.published(spark, root, "totals").collect()] == [(3, 3600000.0)]
    report = sinks.published(spark, root, "report").orderBy("kategori").collect()
    # Categories are not standardized by this recipe.
    assert [r.kategori for r in report] == [" elektronik", "Furniture"]
    with pytest.raises(GateFailed) as error:
        gated.run(readers.read_orders(spark, str(files / "orders.csv")), root, "r2")
    assert error.value.failed == ["zero_nulls"]
    assert sinks.published_runs(spark, root) == ["r1"]
    assert sinks.published(spark, root, "clean").count() == 3


def test_repair(orders, products):
    clean = {r.order_id: r for r in repair.transform(orders, repair.clean_products(products)).collect()}
    assert len(clean) == 9
    assert {k: clean[k].total_harga for k in ("A1", "A3", "A4", "A5")} == {
        "A1": 400000.0, "A3": 600000.0, "A4": 1200000.0, "A5": 0.0,
    }
    assert clean["A1"].tanggal_order == dt.datetime(2024, 6, 3) and clean["A6"].tanggal_order is None
    assert clean["A8"].customer_email == "none" and clean["A1"].kategori == " elektronik"
    assert clean["A9"].status is None and clean["A2"].channel == "mobile app"
    assert values(repair.metrics(orders)) == {
        "rows_in": 12, "duplicate_order_id": 3, "unparsable_dates": 1, "repaired_prices": 2,
        "clean_rows": 9,
    }
    names = [tuple(r) for r in repair.clean_products(products).orderBy("product_id")
             .select("product_name", "kategori").collect()]
    assert names == [("Screen", "Elektronik"), ("Desk", "Furniture")]


def test_repair_run_replaces_its_tables(spark, orders, products):
    for part in (orders.limit(3), orders):
        found = repair.run(part, products)
    assert spark.table("cleaned_orders").count() == 9
    by_city = spark.table("sales_by_category_city")
    assert by_city.selectExpr("sum(order_count)").first()[0] == 4
    assert spark.table("sales_by_channel_status").selectExpr("sum(order_count)").first()[0] == 9
    assert {r["check"]: r.n_bad for r in found.collect()} == {
        "no_negative_price": 0, "catalog_key_unique": 0, "product_known": 1,
        "category_city_total": 0, "channel_status_total": 0,
    }
    counters = {r.metric: r.value for r in spark.table("repair_metrics").collect()}
    assert counters["clean_rows"] == 9 and counters["rows_in"] == orders.count()

    # A catalog that cannot be used leaves all tables as they were.
    with pytest.raises(ContractError, match="more than once"):
        repair.run(orders, products.unionByName(products))
    with pytest.raises(GateFailed, match="no_negative_price"):
        repair.run(orders, products.withColumn("harga_satuan", -F.abs("harga_satuan")))
    assert spark.table("cleaned_orders").count() == 9
    assert spark.table("cleaned_orders").where("total_harga < 0").isEmpty()


def test_results_do_not_depend_on_partitions_or_splits(spark, files, orders, products):
    expected_strict = strict.classify(orders).drop("pos")
    expected_repair = repair.transform(orders, products).drop("pos")
    for n in (1, 8):
        spread = orders.repartition(n, "kota")
        assert same(strict.classify(spread).drop("pos"), expected_strict)
        assert same(repair.transform(spread, products).drop("pos"), expected_repair)
        assert same(gated.transform(spread), gated.transform(orders))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 256)
    try:
        split = readers.read_orders(spark, str(files / "orders.csv"))
        assert split.rdd.getNumPartitions() > 2
        assert same(strict.classify(split).drop("pos"), expected_strict)
        assert same(repair.transform(split, products).drop("pos"), expected_repair)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
