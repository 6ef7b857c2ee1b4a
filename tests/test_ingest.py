"""Unreadable lines, fixed-width positions, known keys, and what a day's run reads."""

import pytest
from pyspark.sql import functions as F

from orderlake.contracts import ORDER_COLUMNS, ORDER_NUMBERS
from orderlake.operators import dedupe, known, marts, profile
from orderlake.plans import repair, strict
from orderlake.sources import positions, quarantine, readers, sinks, staging
from orderlake.streaming import daily

from rows import HEADER, LINES, PRODUCTS, orders_csv

GOOD = "B1,P1,Desk,Home,2,5.0,2024-01-01,Solo,web,pending,x@mail.com"
BAD = {
    "surplus.csv": orders_csv([GOOD, GOOD.replace("B1", "B2") + ",EXTRA", GOOD.replace("B1", "B3")]),
    "torn.csv": orders_csv([
        GOOD.replace("B1", "C1"), 'C2,P1,"Desk', "of oak", 'and ash",Home,2,5.0,2024-01-01,Solo,web,pending,x',
        GOOD.replace("B1", "C3"), "C4,P1,Desk", GOOD.replace("Desk", '15" screen').replace("B1", "C5"), GOOD.replace("B1", "C6"),
    ]),
    "foreign.csv": ",".join(HEADER.split(",")[::-1]) + "\n" + ",".join(GOOD.split(",")[::-1]) + "\nshort,row\n",
    "mark.csv": "﻿" + orders_csv([GOOD.replace("B1", "D1"), "", " \t"]),
}
READ = ["B1", "B3", "C1", "C3", "C4", "C6", "D1"]
REASONS = {
    ("surplus.csv", "surplus_fields", GOOD.replace("B1", "B2") + ",EXTRA"),
    ("torn.csv", "unclosed_quote", 'C2,P1,"Desk'), ("torn.csv", "unclosed_quote", "of oak"),
    ("torn.csv", "unclosed_quote", 'and ash",Home,2,5.0,2024-01-01,Solo,web,pending,x'),
    ("torn.csv", "unclosed_quote", GOOD.replace("Desk", '15" screen').replace("B1", "C5")),
    ("foreign.csv", "foreign_header", ",".join(HEADER.split(",")[::-1])),
    ("foreign.csv", "foreign_header", ",".join(GOOD.split(",")[::-1])),
    ("foreign.csv", "foreign_header", "short,row"),
}


def told(unreadable):
    return {(r.source_file.rpartition("/")[2], r.reject_reason, r.source_line) for r in unreadable.collect()}


@pytest.fixture
def drop(tmp_path):
    folder = tmp_path / "drop"
    folder.mkdir()
    for name, text in BAD.items():
        (folder / name).write_text(text)
    return folder


@pytest.fixture
def products(spark, tmp_path):
    (tmp_path / "products.csv").write_text(PRODUCTS)
    return readers.read_products(spark, str(tmp_path / "products.csv"))


@pytest.mark.parametrize("split", [None, 64])
def test_batch_sets_unreadable_lines_apart(spark, drop, split):
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        found = quarantine.read_orders(spark, str(drop))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    rows = found.rows.collect()
    assert sorted(r.order_id for r in rows) == READ
    assert {r.quantity for r in rows if r.order_id != "C4"} == {2} and set(ORDER_COLUMNS) < set(found.rows.columns)
    assert told(found.unreadable) == REASONS


def test_full_rows_read_as_the_strict_reader_reads_them(spark, tmp_path):
    (tmp_path / "o.csv").write_text(orders_csv())
    found, plain = quarantine.read_orders(spark, str(tmp_path / "o.csv")), readers.read_orders(spark, str(tmp_path / "o.csv"))
    assert found.unreadable.isEmpty()
    left, right = (df.orderBy("pos").drop("pos").collect() for df in (found.rows, plain))
    assert left == right and dict(found.rows.dtypes) == dict(plain.dtypes)


def test_stream_rejects_what_batch_rejects(spark, drop, products, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "lake")
    daily.land(spark, str(drop), landing, str(tmp_path / "checkpoint"))
    assert daily.clean_new(spark, landing, products, root)
    rejected = sinks.published(spark, root, "rejected")
    assert told(rejected.where(F.col("source_line").isNotNull())) == REASONS
    clean = sinks.published(spark, root, "clean")
    kept = [r[0] for r in clean.select("order_id").collect()] + [r.order_id for r in rejected.collect() if r.order_id]
    assert sorted(kept) == READ
    counters = {r.metric: r.value for r in sinks.published(spark, root, "metrics").collect()}
    assert counters["unreadable_rows"] == len(REASONS) and counters["rows_in"] == len(READ)
    # Lines without an order do not make later orders without a number repeats.
    (drop / "later.csv").write_text(orders_csv([GOOD.replace("B1,", ",", 1), GOOD]))
    daily.land(spark, str(drop), landing, str(tmp_path / "checkpoint"))
    daily.clean_new(spark, landing, products, root)
    again = sinks.published(spark, root, "rejected").collect()
    assert [(r.order_id, r.reject_reason) for r in again] == [("B1", "duplicate_order_id")]

    found = quarantine.read_orders(spark, str(drop))
    strict.run(found.rows, products, str(tmp_path / "batch"), "r", found.unreadable)
    assert told(sinks.published(spark, str(tmp_path / "batch"), "rejected").where(F.col("source_line").isNotNull())) == REASONS
    size = sinks.published(spark, str(tmp_path / "batch"), "size").first()
    assert (size.source, size.rows) == ("orders", len(READ) + 2)


def test_positions_of_one_long(spark, tmp_path):
    for name, n in (("b", 3000), ("a", 2000)):
        (tmp_path / f"{name}.csv").write_text("v,w\n" + "".join(f"{name}{i},{i % 7}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4096)
    try:
        staged = staging.stage(readers.read_csv(spark, str(tmp_path)), "positioned")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    packed = positions.fixed_width(staged)
    assert packed.columns == staged.columns and dict(packed.dtypes)["pos"] == "bigint"
    order = [r.v for r in packed.orderBy("pos").collect()]
    assert order == [r.v for r in staged.orderBy("pos").collect()]
    assert order == [f"a{i}" for i in range(2000)] + [f"b{i}" for i in range(3000)]
    assert packed.select("pos").distinct().count() == 5000
    assert positions.fixed_width(packed) is packed


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_sort_aggregates_over_sources(spark, tmp_path):
    (tmp_path / "drop").mkdir()
    (tmp_path / "drop" / "o.csv").write_text(orders_csv())
    orders = readers.read_orders(spark, str(tmp_path / "drop"))
    daily.land(spark, str(tmp_path / "drop"), str(tmp_path / "landing"), str(tmp_path / "checkpoint"))
    landed = daily.landed_except(spark, str(tmp_path / "landing"), set()).drop(daily.LANDED)
    lines = staging.stage(landed.selectExpr("*", "pos.split.file AS _file", "pos.split.block AS _block", "pos.row AS _row"), "lines")
    from_stream = quarantine.sort_out(lines, ORDER_COLUMNS, ORDER_NUMBERS).rows.drop("_file", "_block", "_row")
    for source in (orders, from_stream):
        rows = positions.fixed_width(staging.stage(source, "rows"))
        for df in (dedupe.repeated_keys(rows, "order_id"), profile.raw_values(rows)):
            assert "SortAggregate" not in plan(df) and "HashAggregate" in plan(df)
        assert sorted(tuple(r) for r in repair.metrics(rows).collect()) == sorted(tuple(r) for r in repair.metrics(orders).collect())
        assert [r.order_id for r in rows.orderBy("pos").collect()] == [line[:2] for line in LINES]


def test_a_day_reads_only_touched_parts(spark, tmp_path):
    root = str(tmp_path / "lake")
    past = known.with_part(spark.range(20_000).selectExpr("concat('o', id) AS order_id"))
    past = past.unionByName(known.with_part(spark.sql("SELECT CAST(NULL AS STRING) AS order_id")))
    filters = staging.stage(known.filter_of(past, known.buckets_for(20_001)), "filter")
    with sinks.attempt(spark, root, "r1") as now:
        store, _ = now.write("keys", past.repartition(8, known.PART), by=known.PART)
        now.commit()
    today = [f"o{i}" for i in (5, 77, 19_999)] + [f"n{i}" for i in range(2000)]
    keys = known.with_part(spark.createDataFrame([(k,) for k in today + [None]], "order_id string"))
    found = known.known_among(keys, store, filters)
    assert sorted(str(r[0]) for r in found.collect()) == ["None", "o19999", "o5", "o77"]
    touched = {r[0] for r in known.may_hold(keys, filters, known.buckets_for(20_001)).select(known.PART).distinct().collect()}
    hits = known.may_hold(keys, filters, known.buckets_for(20_001)).count()
    assert 4 <= hits < 4 + 2000 * 0.03 and len(touched) < known.PARTS / 2
    text = plan(found)
    pruned = text[text.index("PartitionFilters"):]
    assert "part#" in pruned[:pruned.index("]")] and len(touched) <= hits
    scanned = store.where(F.col(known.PART).isin(sorted(touched)))
    assert 0 < scanned.select(F.input_file_name()).distinct().count() <= len(touched)


def test_filters_grow_with_the_store(spark):
    old = staging.stage(known.with_part(spark.range(2500).selectExpr("concat('o', id) AS order_id")), "old")
    new = staging.stage(known.with_part(spark.range(10_000).selectExpr("concat('n', id) AS order_id")), "new")
    filters = known.filter_of(old, known.buckets_for(2500))
    grown = staging.stage(known.grown_filter(old, new, filters), "grown")
    assert grown.selectExpr("max(buckets)", "sum(n)").first() == (8, 12_500)
    merged = known.grown_filter(old.limit(100), new.limit(100), known.filter_of(old.limit(100), 4))
    assert merged.selectExpr("max(buckets)", "sum(n)").first() == (4, 200)
    both = old.unionByName(new)
    assert known.may_hold(both, grown, 8).count() == 12_500
    other = known.with_part(spark.range(10_000).selectExpr("concat('x', id) AS order_id"))
    assert known.may_hold(other, grown, 8).count() < 300


def test_daily_reads_no_order_rows_of_earlier_runs(spark, tmp_path, products, monkeypatch):
    (tmp_path / "drop").mkdir()
    landing, root, checkpoint = (str(tmp_path / name) for name in ("landing", "lake", "checkpoint"))
    read = []
    publishes = daily.published
    monkeypatch.setattr(daily, "published", lambda s, r, name, *a, **k: read.append(name) or publishes(s, r, name, *a, **k))
    for day, lines in enumerate([LINES[:1], LINES[1:5], LINES[5:]]):
        (tmp_path / "drop" / f"day{day}.csv").write_text(orders_csv(lines))
        daily.land(spark, str(tmp_path / "drop"), landing, checkpoint)
        assert daily.clean_new(spark, landing, products, root)
    assert set(read) == {"keys", "key_filter", "summary_parts"}
    assert not [f for f in daily.summary_parts(spark, root).inputFiles() if "/clean/" in f]


def test_runs_of_an_older_layout_are_taken_over(spark, tmp_path, products):
    landing, root, checkpoint = (str(tmp_path / name) for name in ("landing", "lake", "checkpoint"))
    (tmp_path / "o.csv").write_text(orders_csv(LINES[:5]))
    strict.run(readers.read_orders(spark, str(tmp_path / "o.csv")), products, root, "old")
    (tmp_path / "drop").mkdir()
    for day, lines in enumerate([LINES[5:9], LINES[9:]]):
        (tmp_path / "drop" / f"day{day}.csv").write_text(orders_csv(lines))
        daily.land(spark, str(tmp_path / "drop"), landing, checkpoint)
        assert daily.clean_new(spark, landing, products, root)
    (tmp_path / "all.csv").write_text(orders_csv())
    whole = strict.classify(readers.read_orders(spark, str(tmp_path / "all.csv")))
    summary, wanted = sinks.published(spark, root, "summary"), strict.summary(whole)
    assert summary.exceptAll(wanted).isEmpty() and wanted.exceptAll(summary).isEmpty()
    rejected = sinks.published(spark, root, "rejected", every_run=True)
    assert sorted((r.order_id, r.reject_reason) for r in rejected.select("order_id", "reject_reason").collect()) == sorted(
        (r.order_id, r.reject_reason) for r in strict.rejected(whole).collect())


def test_merged_parts_equal_one_pass(spark):
    rows = spark.range(300).selectExpr(
        "concat('o', id) AS order_id", "concat('k', id % 3) AS kategori", "IF(id % 5 = 0, NULL, 'web') AS channel",
        "'2024-01' AS order_month", "'completed' AS status", "id % 4 AS quantity", "id * 1.25D AS total_harga", "id % 7 AS run",
    )
    parts = [marts.sales_parts(rows.where(f"run = {i}")) for i in range(7)]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    assert marts.merged_sales(merged).collect() == marts.sales_summary(rows).collect()


def test_inferred_types(spark):
    rows = [("1", "1", "2024-01-01", "1", None, "x"), ("NA", "2.5", "03/06/2024", "2024-01-01", "", "1"), (" 7 ", "1e3", None, "2", "null", "2024-01-01")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string")
    found = {r.column: r.type for r in profile.inferred_types(profile.type_counts(df).unionByName(profile.type_counts(df))).collect()}
    assert found == {"a": "bigint", "b": "double", "c": "timestamp", "d": "string", "e": "empty", "f": "string"}
