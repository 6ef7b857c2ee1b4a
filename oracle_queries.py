"""DuckDB SQL for the driver queries, over the same derived orders."""

from __future__ import annotations

VIEWS = r"""
WITH base AS (
  SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_orderdate, n_name, p_name, p_type,
         CAST(round(p_retailprice * 100) AS BIGINT) AS price,
         1 + o_orderkey % 5 AS quantity,
         CASE WHEN o_orderkey % 7 < 3 THEN 'website' WHEN o_orderkey % 7 < 5 THEN 'marketplace'
              ELSE 'mobile app' END AS channel
  FROM orders JOIN part ON p_partkey = o_custkey
       JOIN customer ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey
),
originals AS (
  SELECT k, 'ORD-' || k AS order_id,
         CASE WHEN k % 97 = 0 THEN 'P-none' ELSE 'P' || o_custkey END AS product_id,
         ' ' || p_name AS product_name, p_type AS kategori, quantity,
         CAST(CASE WHEN k % 13 = 0 THEN NULL WHEN k % 17 = 0 THEN -price * quantity
                   WHEN k % 19 = 0 THEN 0 ELSE price * quantity END AS DOUBLE) AS total_harga,
         CASE WHEN k % 101 = 0 THEN 'not a date'
              WHEN k % 4 = 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
              WHEN k % 4 = 1 THEN strftime(o_orderdate, '%Y-%m-%d')
              WHEN k % 4 = 2 THEN strftime(o_orderdate, '%d/%m/%Y')
              ELSE strftime(o_orderdate, '%b %d, %Y') END AS tanggal_order,
         CASE k % 3 WHEN 0 THEN upper(n_name) WHEN 1 THEN ' ' || lower(n_name) ELSE n_name END AS kota,
         CASE WHEN k % 2 = 0 THEN upper(channel) ELSE channel END AS channel,
         CASE WHEN k % 103 = 0 THEN 'Returned' WHEN k % 23 = 0 THEN 'CANCELLED'
              WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'O' THEN 'Shipped'
              WHEN o_orderstatus = 'P' THEN 'pending' END AS status,
         CASE WHEN k % 6 = 0 THEN NULL ELSE 'Customer' || o_custkey || '@Email.com' END AS customer_email
  FROM base
),
dirty AS (
  SELECT * EXCLUDE (k), 3 * k AS pos FROM originals
  UNION ALL SELECT * EXCLUDE (k), 3 * k + 1 FROM originals WHERE k % 11 = 0
  UNION ALL SELECT * EXCLUDE (k) REPLACE (lower(kota) AS kota), 3 * k + 2 FROM originals WHERE k % 29 = 0
),
products AS (
  SELECT 'P' || p_partkey AS product_id, ' ' || p_name AS product_name, p_type AS kategori,
         CAST(round(p_retailprice * 100) AS BIGINT) AS harga_satuan, p_partkey AS pos
  FROM part
)
"""


def title(c: str) -> str:
    words = f"regexp_extract_all(lower({c}), '[\\p{{L}}]+|[^\\p{{L}}]+')"
    return f"array_to_string([upper(w[1]) || w[2:] for w in {words}], '')"


def day_first(c: str) -> str:
    return f"try_strptime(trim({c}), ['%Y-%m-%d %H:%M:%S', '%Y-%m-%d', '%d/%m/%Y', '%b %d, %Y'])"


def month_first(c: str) -> str:
    return (
        f"try_strptime(trim({c}), "
        "['%Y-%m-%d %H:%M:%S', '%Y-%m-%d', '%m/%d/%Y', '%d/%m/%Y', '%b %d, %Y'])"
    )


def bucket(c: str) -> str:
    return (
        f"CASE WHEN {c} < 500000 THEN 'kecil' WHEN {c} <= 2000000 THEN 'sedang' ELSE 'besar' END"
    )


STANDARD = f""", standard AS (
  SELECT order_id, product_id, trim(product_name) AS product_name,
         {title('trim(kategori)')} AS kategori, quantity, total_harga,
         {day_first('tanggal_order')} AS tanggal_order,
         {title('trim(kota)')} AS kota, lower(trim(channel)) AS channel,
         lower(trim(status)) AS status,
         CASE WHEN lower(trim(customer_email)) NOT IN ('nan', 'none', '')
              THEN lower(trim(customer_email)) END AS customer_email,
         row_number() OVER (PARTITION BY order_id ORDER BY pos) > 1 AS is_repeat, pos
  FROM dirty
)"""

CLASSIFIED = STANDARD + """, classified AS (
  SELECT * EXCLUDE (is_repeat),
         CASE WHEN is_repeat THEN 'duplicate_order_id'
              WHEN total_harga IS NULL OR total_harga <= 0 THEN 'missing_or_non_positive_total_harga'
              WHEN tanggal_order IS NULL THEN 'unparsable_date'
              WHEN status IS NULL OR status NOT IN ('pending', 'shipped', 'completed', 'cancelled')
                THEN 'invalid_status' END AS reject_reason
  FROM standard
)"""

CLEAN = CLASSIFIED + """, clean AS (
  SELECT order_id, product_id, c.product_name, c.kategori, quantity, harga_satuan, total_harga,
         round_even(total_harga / nullif(quantity, 0), 0) AS unit_price_check, tanggal_order,
         strftime(tanggal_order, '%Y-%m') AS order_month, kota, channel, status, customer_email
  FROM classified c LEFT JOIN products USING (product_id)
  WHERE reject_reason IS NULL
)"""

GATED = f""", gated AS (
  SELECT order_id, product_id, product_name, kategori, quantity, total_harga,
         {month_first('tanggal_order')} AS tanggal_order, {title('trim(kota)')} AS kota,
         replace(lower(trim(channel)), ' ', '_') AS channel, status,
         coalesce(customer_email, 'unknown@placeholder.com') AS customer_email,
         strftime({month_first('tanggal_order')}, '%B') AS bulan,
         {bucket('total_harga')} AS kategori_harga
  FROM (SELECT DISTINCT * EXCLUDE (pos) FROM dirty) WHERE total_harga >= 0
)"""

REPAIRED = f""", first_rows AS (
  SELECT * EXCLUDE (nth) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY pos) AS nth FROM dirty)
  WHERE nth = 1
), repaired AS (
  SELECT order_id, product_id, o.product_name, o.kategori, quantity,
         CASE WHEN total_harga IS NULL OR total_harga < 0
              THEN CAST(harga_satuan * quantity AS DOUBLE) ELSE total_harga END AS total_harga,
         {day_first('tanggal_order')} AS tanggal_order, {title('trim(kota)')} AS kota,
         lower(trim(channel)) AS channel, lower(trim(status)) AS status,
         lower(trim(customer_email)) AS customer_email, o.pos
  FROM first_rows o LEFT JOIN products USING (product_id)
)"""

BY_CITY = """SELECT kategori, kota, count(*) AS order_count,
  CAST(sum(quantity) AS BIGINT) AS total_quantity, sum(total_harga) AS total_revenue
FROM repaired WHERE status = 'completed' GROUP BY kategori, kota"""

BY_STATUS = """SELECT channel, status, count(*) AS order_count, sum(total_harga) AS total_revenue
FROM repaired GROUP BY channel, status"""

REPORT = """SELECT kategori, count(order_id) AS total_orders,
  round_even(sum(total_harga), 0) AS total_revenue, round_even(avg(total_harga), 0) AS avg_revenue
FROM gated WHERE kategori IS NOT NULL GROUP BY kategori"""

ROW = (
    "order_id, product_id, product_name, kategori, quantity, total_harga, tanggal_order, "
    "kota, channel, status, customer_email"
)
REPEATS = "(SELECT count(*) FROM {t}) - (SELECT count(*) FROM (SELECT DISTINCT {cols} FROM {t}))"


def _summary(source: str) -> str:
    return f"""SELECT CASE WHEN grouping(kategori) = 0 THEN 'kategori'
            WHEN grouping(channel) = 0 THEN 'channel' ELSE 'order_month' END AS dimension,
       coalesce(kategori, channel, order_month) AS segment, count(order_id) AS total_orders,
       CAST(sum(quantity) AS BIGINT) AS total_qty, round_even(sum(total_harga), 0) AS total_revenue
FROM {source} WHERE status = 'completed'
GROUP BY GROUPING SETS ((kategori), (channel), (order_month))"""


def _long(counts: dict[str, str], name: str = "metric", value: str = "value") -> str:
    return " UNION ALL ".join(
        f"SELECT '{k}' AS {name}, CAST(({v}) AS BIGINT) AS {value}" for k, v in counts.items()
    )


def _checks(counts: dict[str, str]) -> str:
    return f'SELECT "check", n_bad = 0 AS passed, n_bad FROM ({_long(counts, chr(34) + "check" + chr(34), "n_bad")})'


def _gaps() -> str:
    types = {"quantity": "bigint", "total_harga": "double"}
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{types.get(c, 'string')}' AS type, "
        f"count(*) - count({c}) AS missing, count({c}) AS present FROM dirty"
        for c in ROW.split(", ")
    )


def _values() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS rows FROM dirty GROUP BY {c}"
        for c in ("channel", "kota", "status")
    )


def _nulls(table: str, columns: str) -> str:
    parts = " + ".join(f"count(*) - count({c})" for c in columns.split(", "))
    return f"SELECT {parts} FROM {table}"


def _strict_metrics() -> str:
    n = "SELECT count(*) FROM classified WHERE "
    return _long({
        "rows_in": "SELECT count(*) FROM classified",
        "unparsable_dates": n + "tanggal_order IS NULL",
        **{
            r: n + f"reject_reason = '{r}'"
            for r in (
                "duplicate_order_id", "missing_or_non_positive_total_harga",
                "unparsable_date", "invalid_status",
            )
        },
        "rejected_rows": n + "reject_reason IS NOT NULL",
        "clean_rows": n + "reject_reason IS NULL",
        "completed_rows": n + "reject_reason IS NULL AND status = 'completed'",
        "unmatched_products": "SELECT count(*) FROM clean WHERE harga_satuan IS NULL",
    })


GATED_ROW = ROW + ", bulan, kategori_harga"

SQL = {
    "profile_summary": _long({
        "rows": "SELECT count(*) FROM dirty",
        "columns": "SELECT 11",
        "duplicate_rows": "SELECT " + REPEATS.format(t="dirty", cols=ROW),
        "duplicate_order_id": "SELECT " + REPEATS.format(t="dirty", cols="order_id"),
        "price_not_positive": "SELECT count(*) FROM dirty WHERE total_harga <= 0",
        "price_missing": "SELECT count(*) FROM dirty WHERE total_harga IS NULL",
    }),
    "profile_products": _long({
        "rows": "SELECT count(*) FROM products",
        "duplicate_product_id": "SELECT " + REPEATS.format(t="products", cols="product_id"),
    }),
    "profile_nulls": _gaps(),
    "profile_values": _values(),
    "sample": "SELECT tanggal_order FROM dirty "
    "ORDER BY md5('42|' || CAST(pos AS VARCHAR)), pos LIMIT 5",
    "std_text": STANDARD + """SELECT order_id, pos, product_name, kategori, kota, channel, status,
       customer_email, replace(channel, ' ', '_') AS channel_snake FROM standard""",
    "products_clean": f"""SELECT product_id, trim(product_name) AS product_name,
       {title('trim(kategori)')} AS kategori, harga_satuan FROM products""",
    "email_fill": "SELECT order_id, pos, "
    "coalesce(customer_email, 'unknown@placeholder.com') AS customer_email FROM dirty",
    "dates_dayfirst": f"SELECT order_id, pos, tanggal_order AS raw, "
    f"{day_first('tanggal_order')} AS tanggal_order FROM dirty",
    "dates_monthfirst": f"SELECT order_id, pos, tanggal_order AS raw, "
    f"{month_first('tanggal_order')} AS tanggal_order FROM dirty",
    "month_columns": f"""SELECT order_id, pos, strftime(ts, '%B') AS bulan,
       strftime(ts, '%Y-%m') AS order_month
       FROM (SELECT *, {day_first('tanggal_order')} AS ts FROM dirty)""",
    "unit_price": "SELECT order_id, pos, "
    "round_even(total_harga / nullif(quantity, 0), 0) AS unit_price_check FROM dirty",
    "price_bucket": f"SELECT order_id, pos, {bucket('total_harga')} AS kategori_harga FROM dirty",
    "dedupe_key": "SELECT * EXCLUDE (nth) FROM (SELECT *, row_number() OVER "
    "(PARTITION BY order_id ORDER BY pos) AS nth FROM dirty) WHERE nth = 1",
    "dedupe_flag": "SELECT order_id, pos, row_number() OVER "
    "(PARTITION BY order_id ORDER BY pos) > 1 AS is_repeat FROM dirty",
    "dedupe_row": f"SELECT DISTINCT {ROW} FROM dirty",
    "reject_cascade": CLASSIFIED + "SELECT * FROM classified",
    "reject_counts": CLASSIFIED
    + "SELECT reject_reason, count(*) AS rows FROM classified GROUP BY reject_reason",
    "rejected_strict": CLASSIFIED
    + "SELECT * EXCLUDE (pos) FROM classified WHERE reject_reason IS NOT NULL",
    "clean_strict": CLEAN + "SELECT * FROM clean",
    "clean_sorted": CLEAN + "SELECT * FROM clean ORDER BY tanggal_order, order_id",
    "summary_dims": CLEAN + _summary("clean"),
    "clean_gated": GATED + "SELECT * FROM gated",
    "clean_repair": REPAIRED + "SELECT * FROM repaired",
    "price_drop": "SELECT * FROM dirty WHERE total_harga >= 0",
    "price_repair": """SELECT order_id, o.pos, CASE WHEN total_harga IS NULL OR total_harga < 0
       THEN CAST(harga_satuan * quantity AS DOUBLE) ELSE total_harga END AS total_harga
       FROM dirty o LEFT JOIN products USING (product_id)""",
    "median_fill": "SELECT order_id, pos, "
    "coalesce(total_harga, (SELECT median(total_harga) FROM dirty)) AS total_harga FROM dirty",
    "enrich_left": """SELECT order_id, o.pos, product_id, harga_satuan
       FROM dirty o LEFT JOIN products USING (product_id)""",
    "unmatched_products": """SELECT product_id, count(*) AS order_count FROM dirty
       WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.product_id = dirty.product_id)
       GROUP BY product_id""",
    "report_kategori": GATED + REPORT,
    "run_totals": GATED + f"""SELECT CAST(sum(total_orders) AS BIGINT) AS total_orders,
       sum(total_revenue) AS total_revenue FROM ({REPORT})""",
    "bucket_freq": GATED
    + 'SELECT kategori_harga, count(*) AS "count" FROM gated GROUP BY kategori_harga',
    "mart_cat_city": REPAIRED + BY_CITY,
    "mart_channel_status": REPAIRED + BY_STATUS,
    "metrics_strict": CLEAN + _strict_metrics(),
    "metrics_gated": _long({
        "rows_in": "SELECT count(*) FROM dirty",
        "duplicate_rows": "SELECT " + REPEATS.format(t="dirty", cols=ROW),
        "negative_price": f"SELECT count(*) FROM (SELECT DISTINCT {ROW} FROM dirty) WHERE total_harga < 0",
        "clean_rows": f"SELECT count(*) FROM (SELECT DISTINCT {ROW} FROM dirty) WHERE total_harga >= 0",
    }),
    "metrics_repair": REPAIRED + _long({
        "rows_in": "SELECT count(*) FROM dirty",
        "duplicate_order_id": "SELECT (SELECT count(*) FROM dirty) - (SELECT count(*) FROM first_rows)",
        "unparsable_dates": "SELECT count(*) FROM repaired WHERE tanggal_order IS NULL",
        "repaired_prices": "SELECT count(*) FROM first_rows WHERE total_harga IS NULL OR total_harga < 0",
        "clean_rows": "SELECT count(*) FROM repaired",
    }),
    "gate_checks": GATED + _checks({
        "zero_duplicates": "SELECT " + REPEATS.format(t="gated", cols=GATED_ROW),
        "zero_nulls": _nulls("gated", GATED_ROW),
        "zero_negative_price": "SELECT count(*) FROM gated WHERE total_harga < 0",
        "datetime_type": "SELECT count(*) FROM (SELECT typeof(tanggal_order) AS t FROM gated LIMIT 1) "
        "WHERE t NOT LIKE 'TIMESTAMP%'",
    }),
    "gate_tutorial": GATED + _checks({
        "zero_duplicates": "SELECT " + REPEATS.format(t="gated", cols=GATED_ROW),
        "zero_nulls": _nulls("gated", GATED_ROW),
        "zero_negative_price": "SELECT count(*) FROM gated WHERE total_harga < 0",
        "datetime_type": "SELECT 0",
        "channel_count": "SELECT greatest(count(*) - 3, 0) FROM (SELECT DISTINCT channel FROM gated)",
        "channel_allowed": "SELECT count(*) FROM gated WHERE channel IS NULL "
        "OR channel NOT IN ('website', 'marketplace', 'mobile_app')",
    }),
    "price_check": REPAIRED + _checks({
        "no_negative_price": "SELECT count(*) FROM repaired WHERE total_harga < 0",
    }),
    "catalog_checks": _checks({
        "catalog_key_unique": "SELECT " + REPEATS.format(t="products", cols="product_id"),
        "product_known": "SELECT count(*) FROM dirty WHERE product_id IS NULL "
        "OR product_id NOT IN (SELECT product_id FROM products)",
    }),
    "mart_reconcile": REPAIRED + _checks({
        "category_city_total": f"""SELECT abs((SELECT sum(order_count) FROM ({BY_CITY}))
           - (SELECT count(*) FROM repaired WHERE status = 'completed'))""",
        "channel_status_total": f"""SELECT abs((SELECT sum(order_count) FROM ({BY_STATUS}))
           - (SELECT count(*) FROM repaired))""",
    }),
    "typed_values": """SELECT order_id,
       CASE WHEN pos % 8 IN (0, 2, 3, 4) THEN NULL ELSE quantity END AS quantity,
       CASE pos % 7 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN quantity * 1000.0::DOUBLE
            WHEN 4 THEN -(quantity + 0.25::DOUBLE) ELSE quantity::DOUBLE END AS total_harga,
       CASE pos % 5 WHEN 0 THEN NULL WHEN 1 THEN 'none' WHEN 2 THEN NULL ELSE 'Solo' END AS kota, pos
       FROM dirty""",
    "dates_guessed": """, shaped AS (
       SELECT o_orderkey, o_orderkey % 9 AS shape, date_trunc('day', o_orderdate)::TIMESTAMP AS d FROM orders),
     read AS (SELECT *, CASE WHEN shape < 7 THEN d
         WHEN shape = 7 THEN d + INTERVAL 7 HOUR + INTERVAL 8 MINUTE + INTERVAL 9123456 MICROSECOND END AS t FROM shaped)
     SELECT o_orderkey, CASE shape WHEN 0 THEN strftime(d, '%Y/%m/%d') WHEN 1 THEN strftime(d, '%Y%m%d')
         WHEN 2 THEN strftime(d, '%m-%d-%Y') WHEN 3 THEN strftime(d, '%-d %b %Y') WHEN 4 THEN strftime(d, '%B %-d, %Y')
         WHEN 5 THEN strftime(d, '%d-%b-%Y') WHEN 6 THEN strftime(d, '%B %-d %Y')
         WHEN 7 THEN strftime(d, '%Y-%m-%d') || ' 07:08:09.123456789' ELSE strftime(d, '%d/%m/%y') END AS raw,
       t AS day_first, t AS month_first FROM read""",
    "text_blank": f"""SELECT order_id, pos,
       CASE WHEN pos % 6 < 3 THEN NULL WHEN pos % 6 = 3 THEN 'none.' ELSE lower(trim(customer_email)) END AS customer_email,
       CASE WHEN pos % 4 = 1 THEN 'Sungai-O''Neil Baru' ELSE {title('trim(kota)')} END AS kota FROM dirty""",
    "enrich_first": """SELECT order_id, o.pos, product_id, harga_satuan
       FROM dirty o LEFT JOIN products USING (product_id)""",
    "catalog_repeats": _checks({
        "catalog_key_unique": "SELECT count(*) FROM products WHERE pos % 3 = 0",
        "product_known": "SELECT count(*) FROM dirty WHERE product_id IS NULL "
        "OR product_id NOT IN (SELECT product_id FROM products)",
    }),
    "quarantine_rows": """SELECT order_id, product_id, product_name, kategori, quantity, total_harga,
       tanggal_order, kota, channel, status, customer_email, 2 * pos AS _row
       FROM dirty WHERE pos % 10 <> 7 AND pos % 37 <> 0 AND pos % 41 <> 0""",
    "quarantine_lines": """, lines AS (
       SELECT pos % 10 AS f, CASE WHEN pos % 37 = 0 THEN 'surplus_fields' WHEN pos % 41 = 0 THEN 'unclosed_quote' END AS reason,
         CASE WHEN pos % 37 <> 0 AND pos % 41 = 0 THEN 2 ELSE 1 END AS n FROM dirty)
     SELECT 'file-' || f AS source_file, CASE WHEN f = 7 THEN 'foreign_header' ELSE reason END AS reject_reason,
       CAST(sum(n) + any_value(CASE WHEN f = 7 THEN 1 ELSE 0 END) AS BIGINT) AS rows
       FROM lines WHERE f = 7 OR reason IS NOT NULL GROUP BY 1, 2""",
    "known_keys": """SELECT DISTINCT order_id FROM dirty WHERE pos % 5 >= 3
       AND order_id IN (SELECT order_id FROM dirty WHERE pos % 5 < 3)""",
    "summary_merged": CLEAN + _summary("clean"),
    "profile_types": """, counts AS (
       SELECT 'order_id' AS "column", 0::BIGINT AS missing, 0::BIGINT AS whole, 0::BIGINT AS fraction, 0::BIGINT AS date, count(*) AS text FROM dirty
       UNION ALL SELECT 'quantity', count(*) FILTER (pos % 8 = 0), count(*) FILTER (pos % 8 > 4),
         count(*) FILTER (pos % 8 IN (1, 2)), 0, count(*) FILTER (pos % 8 IN (3, 4)) FROM dirty
       UNION ALL SELECT 'total_harga', count(*) FILTER (pos % 7 = 0), count(*) FILTER (pos % 7 > 4),
         count(*) FILTER (pos % 7 IN (3, 4)), 0, count(*) FILTER (pos % 7 IN (1, 2)) FROM dirty
       UNION ALL SELECT 'kota', count(*) FILTER (pos % 5 IN (0, 2)), 0, 0, 0, count(*) FILTER (pos % 5 NOT IN (0, 2)) FROM dirty)
     SELECT *, CASE WHEN text > 0 THEN 'string' WHEN fraction > 0 THEN 'double' ELSE 'bigint' END AS type FROM counts""",
    "date_shapes": f"""SELECT regexp_replace(regexp_replace(trim(tanggal_order), '\\p{{L}}+', 'a', 'g'), '\\d', '9', 'g') AS shape,
       count(*) AS rows, count(*) FILTER ({day_first('tanggal_order')} IS NULL) AS unread,
       count(*) FILTER ({day_first('tanggal_order')} <> {month_first('tanggal_order')}) AS ambiguous,
       min(tanggal_order) AS example FROM dirty GROUP BY 1""",
    "distinct_merged": " " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS rows, count({c}) AS present, count(DISTINCT {c}) AS exact,
        true AS near, true AS same_as_whole FROM dirty"""
        for c in ("order_id", "product_id", "kota", "status")
    ),
    "range_read": CLEAN + """SELECT order_id, tanggal_order FROM clean
       WHERE tanggal_order >= TIMESTAMP '1995-11-08' AND tanggal_order < TIMESTAMP '1996-02-20'""",
}


def oracle(name: str) -> str:
    return VIEWS + SQL[name]
