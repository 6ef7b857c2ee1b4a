from pyspark.sql import functions as F

from orderlake.contracts import STRICT_COLUMNS
from orderlake.plans import strict
from orderlake.sources import readers, sinks
from orderlake.streaming import daily

from rows import LINES, PRODUCTS, orders_csv


def reasons(df):
    return sorted((r.order_id, r.reject_reason) for r in df.collect())


def test_runs_over_arriving_files_equal_one_run_over_all(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    landing, root = str(tmp_path / "landing"), str(tmp_path / "lake")
    checkpoint = str(tmp_path / "checkpoint")
    (tmp_path / "products.csv").write_text(PRODUCTS)
    products = readers.read_products(spark, str(tmp_path / "products.csv"))

    assert daily.clean_new(spark, landing, products, root) is None
    for day, lines in enumerate([LINES[:1], LINES[1:5], LINES[5:]]):
        (drop / f"day{day}.csv").write_text(orders_csv(lines))
        daily.land(spark, str(drop), landing, checkpoint)
        assert daily.clean_new(spark, landing, products, root)
    daily.land(spark, str(drop), landing, checkpoint)
    assert daily.clean_new(spark, landing, products, root) is None
    assert len(sinks.published_runs(spark, root)) == 3

    (tmp_path / "all.csv").write_text(orders_csv())
    whole = strict.classify(readers.read_orders(spark, str(tmp_path / "all.csv")))
    rejected = sinks.published(spark, root, "rejected", every_run=True)
    assert reasons(rejected) == reasons(strict.rejected(whole))
    clean = sinks.published(spark, root, "clean", every_run=True)
    expected = strict.clean(whole, products)
    assert clean.exceptAll(expected).isEmpty() and expected.exceptAll(clean).isEmpty()
    assert clean.select(F.count_distinct("order_id")).first()[0] == clean.count()
    assert clean.columns == STRICT_COLUMNS

    distinct = {r.column: r for r in sinks.published(spark, root, "distinct").collect()}
    assert distinct["order_id"].distinct_values == len({line.split(",")[0] for line in LINES})
    assert distinct["order_id"].rows == len(LINES)
    summary, wanted = sinks.published(spark, root, "summary"), strict.summary(whole)
    assert summary.exceptAll(wanted).isEmpty() and wanted.exceptAll(summary).isEmpty()


def test_several_batches_landed_before_one_run(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    for day, lines in enumerate([LINES[:5], LINES[5:]]):
        (drop / f"day{day}.csv").write_text(orders_csv(lines))
    (tmp_path / "products.csv").write_text(PRODUCTS)
    products = readers.read_products(spark, str(tmp_path / "products.csv"))
    landing, root = str(tmp_path / "landing"), str(tmp_path / "lake")
    daily.land(spark, str(drop), landing, str(tmp_path / "checkpoint"), files_per_batch=1)
    run_id = daily.clean_new(spark, landing, products, root)
    assert sinks.published_runs(spark, root) == [run_id]
    rows = sinks.published(spark, root, "clean").count()
    assert rows + sinks.published(spark, root, "rejected").count() == len(LINES)


def test_a_batch_named_by_an_earlier_clock_is_read(spark, tmp_path):
    from orderlake.sources.sinks import publish

    root = str(tmp_path / "out")
    frame = spark.createDataFrame([("o1",)], "order_id string")
    publish({"clean": frame}, root, "20300101000000000", batches=["20300101000000000"])
    landing = str(tmp_path / "landing")
    for batch in ("20291231000000000", "20300101000000000"):
        frame.selectExpr("order_id", "named_struct('file', 'f', 'block', 0) AS pos").write.parquet(
            f"{landing}/{daily.LANDED}={batch}"
        )
    left = daily.landed_except(spark, landing, daily.published_batches(spark, root))
    assert [r[0] for r in left.select(daily.LANDED).distinct().collect()] == ["20291231000000000"]
