import random
import statistics

import pytest
from pyspark.sql import functions as F

from orderlake.contracts import GateFailed
from orderlake.operators import checks, dedupe, enrich, marts, median, profile, rules
from orderlake.plans import strict


def hot_rows(n=3000, seed=7):
    """A third of the rows without a key, a third with one key, in random order."""
    rng = random.Random(seed)
    keys = [rng.choice([None, "hot", f"k{rng.randrange(n)}"]) for _ in range(n)]
    return [(k, rng.randrange(2), i) for i, k in enumerate(keys)]


@pytest.fixture(scope="module")
def hot(spark):
    rows = hot_rows()
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "order_id string, v int, pos bigint").repartition(8)


def firsts(rows):
    seen = {}
    for key, _, pos in rows:
        seen.setdefault(key, pos)
    return seen


def test_keep_first(spark, hot):
    expected = set(firsts(hot_rows()).values())
    assert {r.pos for r in dedupe.keep_first(hot, "order_id").collect()} == expected
    repeated = dedupe.repeated_keys(hot, "order_id")
    assert {r.pos for r in dedupe.keep_first(hot, "order_id", repeated=repeated).collect()} == expected


def test_flag_repeats(spark, hot):
    first = set(firsts(hot_rows()).values())
    for repeated in (None, dedupe.repeated_keys(hot, "order_id")):
        out = dedupe.flag_repeats(hot, "order_id", repeated=repeated).collect()
        assert len(out) == 3000
        assert all(r.is_repeat == (r.pos not in first) for r in out)


def test_flag_repeats_by_shuffle_join(spark, hot):
    """The same without broadcasts, with skew splitting forced on small data."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = dedupe.flag_repeats(hot, "order_id")
        kept = {r.pos for r in out.where("NOT is_repeat").collect()}
        assert kept == set(firsts(hot_rows()).values())
        out.collect()
        assert "SortMergeJoin(skew=true)" in plan(out)
    finally:
        for k in settings:
            spark.conf.unset(k)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_known_keys_are_repeats(spark, hot):
    known = spark.createDataFrame([("hot",), (None,)], "order_id string")
    out = dedupe.flag_known(dedupe.flag_repeats(hot, "order_id"), "order_id", known)
    kept = {r.pos for r in out.where("NOT is_repeat").collect()}
    assert kept == {p for k, p in firsts(hot_rows()).items() if k not in (None, "hot")}


def test_distinct_rows(spark, hot):
    expected = {(k, v) for k, v, _ in hot_rows()}
    for repeated in (None, dedupe.repeated_keys(hot, "order_id")):
        out = dedupe.distinct_rows(hot, "order_id", repeated).collect()
        assert len(out) == len(expected) and {tuple(r) for r in out} == expected
        counted = dedupe.copies(hot, "order_id", repeated)
        assert counted.agg(F.sum("n")).first()[0] == 3000


def test_keep_first_prunes_before_the_shuffle(spark, hot):
    assert plan(dedupe.keep_first(hot, "order_id")).count("WindowGroupLimit") == 2


def test_first_failed_rule_wins_and_a_lost_first_copy_loses_the_order(spark):
    rows = [
        ("a", None, "2024-01-01", "completed", 0),
        ("a", 5.0, "2024-01-01", "completed", 1),
        ("b", 0.0, "bad", "odd", 2),
        ("c", 1.0, "bad", "odd", 3),
        ("d", 1.0, "2024-01-01", "odd", 4),
        ("e", 1.0, "2024-01-01", None, 5),
        ("f", 1.0, "2024-01-01", " Shipped", 6),
        (None, 1.0, "2024-01-01", "pending", 7),
        (None, 1.0, "2024-01-01", "pending", 8),
    ]
    df = spark.createDataFrame(
        rows, "order_id string, total_harga double, tanggal_order string, status string, pos int"
    )
    texts = ["product_id", "product_name", "kategori", "kota", "channel", "customer_email"]
    df = df.withColumns({c: F.lit(None).cast("string") for c in texts})
    out = strict.classify(df.withColumn("quantity", F.lit(1)))
    assert [r.reject_reason for r in out.orderBy("pos").collect()] == [
        "missing_or_non_positive_total_harga", "duplicate_order_id",
        "missing_or_non_positive_total_harga", "unparsable_date", "invalid_status",
        "invalid_status", None, None, "duplicate_order_id",
    ]


CATALOG = "product_id string, harga_satuan bigint, pos int"


def test_lookups(spark):
    orders = spark.createDataFrame(
        [("P1", 2, None), ("P1", 2, -1.0), ("P1", 2, 0.0), ("P1", 2, 7.0), ("P9", 2, -1.0), (None, 2, None)],
        "product_id string, quantity bigint, total_harga double",
    )
    twice = spark.createDataFrame([("P1", 10, 0), ("P1", 99, 1), (None, 5, 2), ("P2", 1, 3)], CATALOG)
    prices = sorted(r.harga_satuan or 0 for r in enrich.add_unit_price(orders, twice).collect())
    assert prices == [0, 0, 10, 10, 10, 10]
    with pytest.raises(Exception, match="duplicate catalog key: P1"):
        enrich.unique_unit_price(orders, twice).collect()

    once = twice.where("harga_satuan <> 99")
    fixed = rules.repair_price(enrich.unique_unit_price(orders, once)).collect()
    totals = sorted((r.product_id or "", r.total_harga is None, r.total_harga or 0) for r in fixed)
    assert totals == [
        ("", True, 0), ("P1", False, 0.0), ("P1", False, 7.0), ("P1", False, 20.0),
        ("P1", False, 20.0), ("P9", True, 0),
    ]
    missing = enrich.unmatched_products(orders, twice).collect()
    assert {(r.product_id, r.order_count) for r in missing} == {("P9", 1), (None, 1)}
    bad = {r["check"]: (r.passed, r.n_bad) for r in checks.catalog_checks(orders, twice).collect()}
    assert bad == {"catalog_key_unique": (False, 1), "product_known": (False, 2)}


SALES = (
    "order_id string, kategori string, channel string, order_month string, kota string, "
    "status string, quantity bigint, total_harga double"
)


def test_reports_treat_missing_groups_and_sums_as_specified(spark):
    df = spark.createDataFrame(
        [
            ("1", "A", "web", "2024-01", "Solo", "completed", 1, 2.5),
            ("2", "A", "web", "2024-02", None, "completed", 2, None),
            ("3", "B", None, "2024-02", "Solo", "completed", 3, None),
            (None, None, "app", "2024-02", "Solo", "completed", 4, 1.0),
            ("5", "A", "app", "2024-02", "Solo", None, 5, 4.0),
        ],
        SALES,
    )
    report = [tuple(r) for r in marts.category_report(df).collect()]
    assert report == [("A", 3, 6.0, 3.0), ("B", 1, 0.0, None)]
    assert [tuple(r) for r in marts.run_totals(marts.category_report(df)).collect()] == [(4, 6.0)]
    assert [tuple(r) for r in marts.sales_summary(df).collect()] == [
        ("channel", "app", 0, 4, 1.0), ("channel", "web", 2, 3, 2.0),
        ("kategori", "A", 2, 3, 2.0), ("kategori", "B", 1, 3, 0.0),
        ("order_month", "2024-01", 1, 1, 2.0), ("order_month", "2024-02", 2, 9, 1.0),
    ]
    by_city = marts.sales_by_category_city(df)
    assert [tuple(r) for r in by_city.collect()] == [
        ("A", "Solo", 1, 1, 2.5), (None, "Solo", 1, 4, 1.0),
        ("A", None, 1, 2, None), ("B", "Solo", 1, 3, None),
    ]
    by_status = marts.sales_by_channel_status(df)
    assert [tuple(r) for r in by_status.collect()] == [
        ("app", "completed", 1, 1.0), ("app", None, 1, 4.0), ("web", "completed", 2, 2.5),
        (None, "completed", 1, None),
    ]
    assert checks.all_passed(checks.mart_checks(df, by_city, by_status))
    off = checks.mart_checks(df, by_city.limit(1), by_status)
    assert {r["check"]: r.n_bad for r in off.collect()} == {
        "category_city_total": 3, "channel_status_total": 0,
    }
    assert [tuple(r) for r in marts.frequencies(df, "channel").collect()] == [("app", 2), ("web", 2)]


def test_reports_of_nothing(spark):
    nothing = spark.createDataFrame([], SALES)
    assert marts.category_report(nothing).collect() == []
    assert marts.sales_summary(nothing).collect() == []
    assert [tuple(r) for r in marts.run_totals(marts.category_report(nothing)).collect()] == [(0, 0.0)]


def gate_rows(spark, rows):
    return spark.createDataFrame(
        rows, "order_id string, channel string, total_harga double, tanggal_order timestamp_ntz"
    )


def test_gate(spark):
    import datetime as dt

    now = dt.datetime(2024, 1, 1)
    good = gate_rows(spark, [("1", "web", 1.0, now), ("2", "app", 0.0, now)])
    checks.require(checks.quality_checks(good))
    assert checks.all_passed(checks.tutorial_checks(good, ["web", "app"]))

    bad = gate_rows(spark, [
        ("1", "a", 1.0, now), ("1", "a", 1.0, now), ("1", "a", 1.0, now), ("2", "b", -1.0, None),
        ("3", "c", 1.0, now), ("4", None, None, now),
    ])
    for repeated in (None, dedupe.repeated_keys(bad.withColumn("pos", F.lit(0)), "order_id")):
        found = checks.quality_checks(bad, 3, ["a", "b"], repeated)
        assert {r["check"]: r.n_bad for r in found.collect()} == {
            "zero_duplicates": 2, "zero_nulls": 3, "zero_negative_price": 1, "datetime_type": 0,
            "channel_count": 1, "channel_allowed": 2,
        }
    with pytest.raises(GateFailed) as error:
        checks.require(checks.quality_checks(bad.withColumn("tanggal_order", F.lit("x"))))
    assert error.value.failed == [
        "datetime_type", "zero_duplicates", "zero_negative_price", "zero_nulls",
    ]
    empty = checks.quality_checks(good.limit(0))
    assert [r.n_bad for r in empty.collect()] == [0, 0, 0, 0]


def test_profile(spark):
    df = spark.createDataFrame(
        [("1", "b", "x", None, 5.0, 0), ("1", "b", "x", None, 5.0, 1), (None, "a", "y", "s", 0.0, 2),
         (None, None, "x", "s", None, 3)],
        "order_id string, channel string, kota string, status string, total_harga double, pos int",
    )
    assert {r.metric: r.value for r in profile.summary(df).collect()} == {
        "rows": 4, "columns": 5, "duplicate_rows": 1, "duplicate_order_id": 2,
        "price_not_positive": 1, "price_missing": 1,
    }
    gaps = {r.column: (r.type, r.missing, r.present) for r in profile.gaps(df).collect()}
    assert gaps["order_id"] == ("string", 2, 2) and gaps["total_harga"] == ("double", 1, 3)
    assert [tuple(r) for r in profile.raw_values(df).collect()] == [
        ("channel", "b", 2), ("channel", "a", 1), ("channel", None, 1),
        ("kota", "x", 3), ("kota", "y", 1), ("status", None, 2), ("status", "s", 2),
    ]
    dates = spark.range(100).selectExpr("CAST(id AS string) AS tanggal_order", "id AS pos")
    once = [r[0] for r in profile.sample_dates(dates).collect()]
    again = [r[0] for r in profile.sample_dates(dates.repartition(5)).collect()]
    assert len(set(once)) == 5 and once == again
    assert profile.sample_dates(dates.limit(2)).count() == 2


def median_inputs():
    rng = random.Random(3)
    spread = [float(rng.randrange(10**9)) for _ in range(4001)]
    hot = [7.0] * 2000
    return {
        "odd": spread,
        "even": spread[:4000],
        "hot below": hot + [x + 10 for x in spread[:2001]],
        "hot middle": hot + [x - 10**9 for x in spread[:1500]] + spread[:1500],
        "hot upper": hot + [x - 10**9 for x in spread[:2000]],
        "negative": [-x for x in spread[:1000]],
        "two": [1.0, 2.0],
        "same": [3.0] * 1000,
        "one": [5.0],
    }


@pytest.mark.parametrize("name", list(median_inputs()))
def test_median_is_exact(spark, name):
    values = median_inputs()[name]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 3, "x double").repartition(4)
    assert median.exact_median(df, "x", accuracy=50) == statistics.median(values)


def test_median_gathers_no_values():
    with open(median.__file__) as code:
        assert "collect_list" not in code.read()


def test_median_fill(spark):
    df = spark.createDataFrame([(1.0,), (None,), (4.0,)], "x double")
    assert sorted(r.x for r in median.fill_median(df, "x").collect()) == [1.0, 2.5, 4.0]
    nothing = df.where("x IS NULL")
    assert median.exact_median(nothing, "x") is None
    assert [r.x for r in median.fill_median(nothing, "x").collect()] == [None]


def test_price_filter(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (-1.0,), (None,)], "total_harga double")
    assert sorted(r[0] for r in rules.drop_negative_price(df).collect()) == [0.0, 1.0]
