"""Time ranges kept between runs, and distinct counts that add up over them."""

from datetime import date, datetime

from pyspark.sql import functions as F

from orderlake.operators import sketches
from orderlake.plans import strict
from orderlake.sources import layout, readers, sinks

from rows import PRODUCTS, orders_csv


def days(spark, rows):
    return spark.createDataFrame(
        [(f"A{i}", None if t is None else datetime.fromisoformat(t)) for i, t in enumerate(rows)],
        "order_id string, tanggal_order timestamp_ntz",
    )


def test_ranges_fill_their_month(spark):
    df = days(spark, ["2024-02-03"] * 6 + ["2024-02-10 09:00"] * 2 + ["2024-02-20"] * 4 + ["2024-03-31 23:59:59"] + [None])
    found = sorted(tuple(r) for r in layout.learnt(df, rows_per_range=4).collect())
    feb = date(2024, 2, 1)
    assert found == [
        (feb, feb, date(2024, 2, 10)), (feb, date(2024, 2, 10), date(2024, 2, 20)),
        (feb, date(2024, 2, 20), date(2024, 3, 1)), (date(2024, 3, 1), date(2024, 3, 1), date(2024, 4, 1)),
    ]
    assert layout.learnt(df.limit(0)).count() == 0
    more = days(spark, ["2024-02-28", "2024-05-01"])
    new = layout.missing_ranges(more, layout.learnt(df, rows_per_range=4), rows_per_range=4).collect()
    assert [tuple(r) for r in new] == [(date(2024, 5, 1), date(2024, 5, 1), date(2024, 6, 1))]


def test_a_range_read_opens_its_folders_only(spark, tmp_path):
    root = str(tmp_path / "lake")
    runs = [["2024-02-03", "2024-02-10", "2024-02-20 10:00", None], ["2024-02-09", "2024-02-29", "2024-06-01"]]
    for i, rows in enumerate(runs):
        with sinks.attempt(spark, root, f"run{i}") as now:
            layout.write_by_time(now, "orders", days(spark, rows), rows_per_range=1)
            now.commit()
    found = layout.read_between(spark, root, "orders", datetime(2024, 2, 5), datetime(2024, 2, 11))
    assert sorted(str(r.tanggal_order) for r in found.collect()) == ["2024-02-09 00:00:00", "2024-02-10 00:00:00"]
    opened = {f.split("time_range=")[1].split("/")[0] for f in found.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    assert opened == {"2024-02-01", "2024-02-10"}
    scanned = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [time_range" in scanned
    # A month's cuts stay: the second run adds those of June alone.
    assert layout.kept_ranges(spark, root).count() == 4
    whole = sinks.published(spark, root, "orders", every_run=True)
    assert whole.count() == 7 and whole.where(F.col(layout.RANGE) == layout.NO_TIME).count() == 1


def test_strict_run_publishes_by_time(spark, tmp_path):
    (tmp_path / "orders.csv").write_text(orders_csv())
    (tmp_path / "products.csv").write_text(PRODUCTS)
    orders = readers.read_orders(spark, str(tmp_path / "orders.csv"))
    products = readers.read_products(spark, str(tmp_path / "products.csv"))
    root = str(tmp_path / "lake")
    strict.run(orders, products, root, "one", by_time=True)
    found = layout.read_between(spark, root, "clean_by_time", date(1900, 1, 1), date(2100, 1, 1))
    clean = sinks.published(spark, root, "clean")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, clean.collect())) and clean.count()


def test_merged_sketches_are_those_of_the_whole(spark):
    df = spark.range(60000).selectExpr("id % 20000 AS a", "IF(id % 3 = 0, NULL, id % 7) AS b", "CAST(NULL AS string) AS c")
    parts = [sketches.distinct_parts(df.where(F.col("a") % 3 == i)) for i in range(3)]
    merged = sketches.merged_distinct(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    whole = sketches.merged_distinct(sketches.distinct_parts(df))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    found = {r.column: r for r in merged.collect()}
    assert abs(found["a"].distinct_values - 20000) <= sketches.ERROR * 20000
    assert (found["b"].distinct_values, found["b"].present, found["b"].rows) == (7, 40000, 60000)
    assert (found["c"].distinct_values, found["c"].present) == (0, 0)
    empty = sketches.merged_distinct(sketches.distinct_parts(df.limit(0))).collect()
    assert {(r.column, r.rows, r.distinct_values) for r in empty} == {("a", 0, 0), ("b", 0, 0), ("c", 0, 0)}
