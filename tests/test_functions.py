import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from orderlake.functions import dates, money, text


def mapped(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    out = df.select("i", expression(F.col("v")).alias("o")).collect()
    return [r.o for r in sorted(out, key=lambda r: r.i)]


def test_white_space_is_what_python_strips():
    assert text.WHITESPACE == "".join(chr(i) for i in range(0x110000) if chr(i).isspace())


def test_strip(spark):
    assert mapped(spark, ["\t a \n", " x y\xa0", "", None], text.strip) == ["a", "x y", "", None]


def test_title_literals(spark):
    given_ = ["o'neil", "kota-baru", "24inch", "jakarta  selatan", "SURABAYA", "a\tb", "中a", "ßa", None]
    assert mapped(spark, given_, text.title) == [
        "O'Neil", "Kota-Baru", "24Inch", "Jakarta  Selatan", "Surabaya", "A\tB", "中A", "Ssa", None,
    ]


# Letters of several scripts up to U+024F and Cyrillic, digits, marks, spaces.
WORDS = st.text(
    st.one_of(
        st.characters(max_codepoint=0x17F, categories=["L", "N", "P", "Z", "S"]),
        st.characters(min_codepoint=0x400, max_codepoint=0x45F),
        st.sampled_from(" \t'-_’\xa0"),
    ),
    max_size=12,
)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(WORDS, min_size=150, max_size=200))
def test_text_equals_python(spark, values):
    assert mapped(spark, values, text.strip) == [v.strip() for v in values]
    assert mapped(spark, values, text.title) == [v.title() for v in values]
    assert mapped(spark, values, text.clean_lower) == [v.strip().lower() for v in values]


def test_snake_and_emails(spark):
    assert mapped(spark, [" Mobile App ", "WEBSITE"], text.snake) == ["mobile_app", "website"]
    emails = [" Ann@Mail.com ", "NaN", " none", "", None]
    assert mapped(spark, emails, text.clean_email) == ["ann@mail.com", None, None, None, None]
    assert mapped(spark, ["a", None], text.fill_email) == ["a", "unknown@placeholder.com"]


def day(y, m, d, *time):
    return dt.datetime(y, m, d, *time)


EITHER_WAY = [
    ("2024-06-13 17:20:00", day(2024, 6, 13, 17, 20)),
    (" 2024-05-18 ", day(2024, 5, 18)),
    ("2024-5-8", day(2024, 5, 8)),
    ("2024-05-08  7:08:09", day(2024, 5, 8, 7, 8, 9)),
    ("15/07/2024", day(2024, 7, 15)),
    ("07/15/2024", day(2024, 7, 15)),
    ("Jun 03, 2024", day(2024, 6, 3)),
    ("jun 3, 2024", day(2024, 6, 3)),
    ("JUNE 3, 2024", day(2024, 6, 3)),
    ("Jul 15 2024", day(2024, 7, 15)),
    ("15 July 2024", day(2024, 7, 15)),
    ("15 Jul 2024", day(2024, 7, 15)),
    ("15-Jul-2024", day(2024, 7, 15)),
    ("May 5, 2024", day(2024, 5, 5)),
    ("2024/07/15", day(2024, 7, 15)),
    ("2024/07/15 10:11", day(2024, 7, 15, 10, 11)),
    ("20240715", day(2024, 7, 15)),
    ("07-15-2024", day(2024, 7, 15)),
    ("13-07-2024", day(2024, 7, 13)),
    ("11-07-2024", day(2024, 11, 7)),
    ("13/06/2024 17:20", day(2024, 6, 13, 17, 20)),
    ("11/07/2024 10:00:00", day(2024, 11, 7, 10)),
    ("2024-05-18T10:00:00", day(2024, 5, 18, 10)),
    ("2024-06-13 17:20", day(2024, 6, 13, 17, 20)),
    ("2024-06-13 17:20:00.5", day(2024, 6, 13, 17, 20, 0, 500000)),
    ("2024-06-13 17:20:00.123456789", day(2024, 6, 13, 17, 20, 0, 123456)),
    ("2024-06-13T17:20:00.1234567", day(2024, 6, 13, 17, 20, 0, 123456)),
] + [
    (v, None)
    for v in (
        "31/02/2024", "02/30/2024", "13/13/2024", "2024-02-30", "2024-13-01", "abc", "",
        "1718000000", "05/06/24", "Junk 3, 2024", "Jun 03,2024", "2024-06-13 25:00:00",
        "20241301", "2024715", "2024/0715", "1/2/2024x", "3/6-2024", None,
    )
]


def test_dates_both_policies_agree_on(spark):
    values, expected = zip(*EITHER_WAY)
    assert mapped(spark, values, dates.parse_date) == list(expected)
    assert mapped(spark, values, lambda c: dates.parse_date(c, True)) == list(expected)


@pytest.mark.parametrize(
    "month_first, expected", [(False, [day(2024, 6, 3), day(2024, 7, 11)]),
                              (True, [day(2024, 3, 6), day(2024, 11, 7)])]
)
def test_ambiguous_dates_follow_the_policy(spark, month_first, expected):
    values = ["3/6/2024", "11/07/2024"]
    assert mapped(spark, values, lambda c: dates.parse_date(c, month_first)) == expected


def test_dates_do_not_depend_on_the_session_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    # Midnight and 02:30 of these days do not exist in the zones below.
    values = ["2018-11-04", "04/11/2018", "Nov 4, 2018", "2024-03-31 02:30:00"]
    expected = [day(2018, 11, 4)] * 3 + [day(2024, 3, 31, 2, 30)]
    try:
        for name in ("America/Sao_Paulo", "Europe/Berlin"):
            spark.conf.set("spark.sql.session.timeZone", name)
            assert mapped(spark, values, dates.parse_date) == expected
            months = mapped(spark, values, lambda c: dates.month_period(dates.parse_date(c)))
            assert months == ["2018-11"] * 3 + ["2024-03"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_month_names(spark):
    days = [day(2024, m, 1) for m in range(1, 13)]
    assert mapped(spark, days, dates.month_name, "timestamp_ntz") == dates.MONTHS
    assert mapped(spark, days[:2], dates.month_period, "timestamp_ntz") == ["2024-01", "2024-02"]


def test_money(spark):
    halves = [0.5, 1.5, 2.5, -0.5, None]
    assert mapped(spark, halves, money.whole, "double") == [0.0, 2.0, 2.0, 0.0, None]
    totals = [499999.0, 500000.0, 2000000.0, 2000001.0, None]
    assert mapped(spark, totals, money.price_bucket, "double") == [
        "kecil", "sedang", "sedang", "besar", "besar",
    ]
    by_zero = mapped(spark, [5.0], lambda c: money.unit_price(c, F.lit(0)), "double")
    by_two = mapped(spark, [5.0], lambda c: money.unit_price(c, F.lit(2)), "double")
    assert by_zero + by_two == [None, 2.0]
