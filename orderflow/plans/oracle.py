"""The catalog's queries as SQL for another engine, over the same tables."""

from __future__ import annotations

from orderflow.operators import synth
from orderflow.sources.retail import LINE_STATUSES


def _list(items: list[str]) -> str:
    return "[" + ", ".join("'" + item.replace("'", "''") + "'" for item in items) + "]"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


RAW = f"""raw AS (
  SELECT CASE WHEN (l_orderkey * 7 + l_linenumber) % 100 = 0 THEN NULL
              ELSE 'o' || l_orderkey || '-' || l_linenumber END AS order_id,
         'c' || o_custkey AS customer_id,
         'p' || l_partkey AS product_id,
         l_shipdate + to_seconds((l_partkey * 37 + l_linenumber * 6101 + l_orderkey * 13) % 86400)
           AS order_timestamp,
         CAST(CASE WHEN l_partkey % 20 = 3 THEN -l_quantity ELSE l_quantity END AS INTEGER)
           AS quantity,
         CASE WHEN l_suppkey % 20 = 7 THEN -l_extendedprice ELSE l_extendedprice END AS price,
         ({_list(LINE_STATUSES)})[(l_orderkey + l_linenumber) % 13 + 1] AS status
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)"""

EVENTS = """raw AS (
  SELECT CASE WHEN event_id % 101 = 0 THEN NULL ELSE 'o' || event_id END AS order_id,
         'c' || user_id AS customer_id,
         'p' || json_extract_string(props, '$.k') AS product_id,
         ts AS order_timestamp,
         CAST(CASE WHEN event_id % 37 = 5 THEN -(1 + event_id % 10) ELSE 1 + event_id % 10 END
           AS INTEGER) AS quantity,
         value AS price,
         CASE event_type WHEN 'purchase' THEN 'Done' WHEN 'error' THEN 'canceled'
              ELSE event_type END AS status
  FROM events, unnest(range(CASE WHEN event_id % 50 = 0 THEN 2 ELSE 1 END)) AS copies(copy))"""

TAGGED = """tagged AS (
  SELECT *, CASE WHEN order_id IS NULL THEN 'missing_order_id'
                 WHEN quantity <= 0 OR price < 0 THEN 'invalid_values'
                 WHEN quantity > 0 AND price >= 0 THEN NULL
                 ELSE 'indeterminate_values' END AS reject_reason
  FROM raw)"""

NORMAL = """normal AS (
  SELECT order_id, customer_id, product_id, order_timestamp, quantity, price,
         CASE WHEN lower(trim(status, ' ')) IN ('complete', 'done') THEN 'completed'
              WHEN lower(trim(status, ' ')) = 'canceled' THEN 'cancelled'
              ELSE lower(trim(status, ' ')) END AS status
  FROM tagged WHERE reject_reason IS NULL)"""

KEPT = """kept AS (
  SELECT order_id, customer_id, product_id, order_timestamp, quantity, price, status
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_timestamp, product_id,
                                     customer_id, quantity, price, status) AS rn FROM normal)
  WHERE rn = 1)"""

DERIVED = """derived AS (
  SELECT *, CAST(order_timestamp AS DATE) AS order_date,
         CAST(dayofweek(order_timestamp) + 1 AS INTEGER) AS order_day_of_week,
         CAST(hour(order_timestamp) AS INTEGER) AS hour_of_day,
         quantity * price AS total_amount
  FROM kept)"""

CANCELLED = "SELECT * FROM derived WHERE status = 'cancelled'"
ACTIVE = "active AS (SELECT * FROM derived WHERE status <> 'cancelled')"

CUSTOMERS = """customers AS (
  SELECT 'c' || c_custkey AS customer_id, c_name AS customer_name,
         CAST(NULL AS VARCHAR) AS customer_email, c_mktsegment AS customer_segment,
         CAST(NULL AS VARCHAR) AS registration_date
  FROM customer)"""

PRODUCTS = """products AS (
  SELECT 'p' || p_partkey AS product_id, p_name AS product_name, p_type AS category,
         p_brand AS brand, p_retailprice AS list_price
  FROM part)"""

LINES = (RAW, TAGGED, NORMAL, KEPT, DERIVED, ACTIVE)
STREAM = (EVENTS, TAGGED, NORMAL, KEPT, DERIVED, ACTIVE)
ORDER = "order_id, customer_id, product_id, order_timestamp, quantity, price, status"
CUSTOMER = "customer_name, customer_email, customer_segment, registration_date"
PRODUCT = "product_name, category, brand, list_price"
FULL = f"active.*, {CUSTOMER}, {PRODUCT}"
LOOKUPS = "LEFT JOIN customers USING (customer_id) LEFT JOIN products USING (product_id)"
REVENUE = "count(order_id) AS total_orders, round(sum(total_amount), 2) AS total_revenue"


def _revenue(key: str) -> str:
    return f"SELECT {key}, {REVENUE} FROM active GROUP BY {key}"


WINDOWS = """SELECT time_bucket(INTERVAL '10 minutes', order_timestamp) AS window_start,
  time_bucket(INTERVAL '10 minutes', order_timestamp) + INTERVAL '10 minutes' AS window_end,
  product_id, count(order_id) AS orders_count, round(sum(total_amount), 2) AS total_revenue
FROM active WHERE order_timestamp IS NOT NULL GROUP BY 1, 2, 3"""
# Append mode emits a window once it ends at or before the last watermark.
CLOSED_WINDOWS = f"""SELECT * FROM ({WINDOWS}) WHERE window_end
  <= (SELECT max(order_timestamp) FROM normal) - INTERVAL '30 minutes'"""

STAGES = [
    ("input", "SELECT count(*) FROM raw"),
    *[
        (reason, f"SELECT count(*) FROM tagged WHERE reject_reason = '{reason}'")
        for reason in ("missing_order_id", "invalid_values", "indeterminate_values")
    ],
    ("before_dedupe", "SELECT count(*) FROM normal"),
    ("after_dedupe", "SELECT count(*) FROM kept"),
    ("duplicates", "SELECT (SELECT count(*) FROM normal) - (SELECT count(*) FROM kept)"),
    ("cancelled", "SELECT count(*) FROM kept WHERE status = 'cancelled'"),
    ("unclassified", "SELECT count(*) FROM kept WHERE status IS NULL"),
    ("active", "SELECT count(*) FROM active"),
    ("revenue_days", "SELECT count(DISTINCT order_date) FROM active"),
    ("revenue_products", "SELECT count(DISTINCT product_id) FROM active"),
    ("revenue_hours", "SELECT count(DISTINCT hour_of_day) FROM active"),
    ("customers", "SELECT count(*) FROM customer"),
    ("products", "SELECT count(*) FROM part"),
]
COUNTS = "\nUNION ALL ".join(f"SELECT '{name}' AS stage, ({sql}) AS n_rows" for name, sql in STAGES)

# Payloads without JSON or without any known field decode to nothing.
_LOST = "event_id % 97 IN (3, 13, 23, 53, 63)"
DECODED = f"""SELECT
  CASE WHEN {_LOST} OR event_id % 101 = 0 THEN NULL ELSE 'o' || event_id END AS order_id,
  CASE WHEN {_LOST} THEN NULL ELSE 'c' || user_id END AS customer_id,
  CASE WHEN {_LOST} THEN NULL ELSE 'p' || json_extract_string(props, '$.k') END AS product_id,
  CASE WHEN {_LOST} OR event_id % 83 = 6 THEN NULL ELSE ts END AS order_timestamp,
  CASE WHEN {_LOST} OR event_id % 89 = 4 THEN NULL
       ELSE CAST(1 + event_id % 10 AS INTEGER) END AS quantity,
  CASE WHEN {_LOST} THEN NULL ELSE value END AS price,
  CASE WHEN {_LOST} THEN NULL ELSE event_type END AS status
FROM events"""

DEAD = """WITH texts AS (SELECT *,
    '{"order_id": ' || CASE WHEN event_id % 101 = 0 THEN 'NaN' ELSE '"o' || event_id || '"' END
    || ', "customer_id": "c' || user_id || '", "product_id": "p' || json_extract_string(props, '$.k')
    || '", "order_timestamp": "'
    || CASE WHEN event_id % 83 = 6 THEN 'garbage' ELSE CAST(ts AS VARCHAR) END
    || '", "quantity": ' || CASE WHEN event_id % 89 = 4 THEN '"x"' ELSE CAST(1 + event_id % 10 AS VARCHAR) END
    || ', "price": ' || value || ', "status": "' || event_type || '"}' AS json FROM events),
found AS (SELECT event_id AS "offset",
  CASE event_id % 97 WHEN 3 THEN '{bad' WHEN 13 THEN NULL WHEN 23 THEN '  '
       WHEN 33 THEN json || ' trailing' WHEN 43 THEN json || json WHEN 53 THEN '{}'
       WHEN 63 THEN '{"Order_ID": "o' || event_id || '"}' ELSE json END AS payload,
  CASE WHEN event_id % 97 IN (13, 23) THEN 'empty' WHEN event_id % 97 = 3 THEN 'malformed_json'
       WHEN event_id % 97 IN (53, 63) THEN 'no_known_field'
       WHEN event_id % 89 = 4 THEN 'malformed_json'
       WHEN event_id % 97 IN (33, 43) THEN 'trailing_content'
       WHEN event_id % 83 = 6 THEN 'bad_timestamp' END AS reason
  FROM texts)"""


# --- synthesis --------------------------------------------------------------


def _draw(name: str, *row: str, seed: int = 42) -> str:
    text = f"concat_ws('|', '{seed}', '{name}', {', '.join(row)})"
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def _int(name: str, low: int, high: int, *row: str) -> str:
    return f"({low} + {_draw(name, *row)} % {high - low + 1})"


def _item(name: str, items: list[str], *row: str) -> str:
    return f"({_list(items)})[{_int(name, 1, len(items), *row)}]"


def _chance(name: str, rate: float, *row: str) -> str:
    return f"({_draw(name, *row)} % 1000000 < {round(rate * 1_000_000)})"


_ROW = ("order_id", "epoch_us(order_timestamp)")
SYNTH = f"""clean AS (
  SELECT 'o' || o_orderkey AS order_id,
         'c' || {_int('customer', 1, 1000, 'o_orderkey')} AS customer_id,
         'p' || {_int('product', 1, 50, 'o_orderkey')} AS product_id,
         TIMESTAMP '2026-01-01' + to_seconds({_int('time', 0, 30 * 86400, 'o_orderkey')})
           AS order_timestamp,
         CAST({_int('quantity', 1, 10, 'o_orderkey')} AS INTEGER) AS quantity,
         {_int('price', 500, 50000, 'o_orderkey')} / 100.0::DOUBLE AS price,
         {_item('status', synth.ORDER_STATUSES, 'o_orderkey')} AS status
  FROM orders)"""
DEFECTS = f"""doubled AS (
  SELECT order_id, customer_id, product_id,
         order_timestamp + to_seconds(unnest(CASE WHEN {_chance('duplicate', 0.02, *_ROW)}
           THEN [0, {_int('duplicate_delay', 10, 300, *_ROW)}] ELSE [0] END)) AS order_timestamp,
         quantity, price, status
  FROM clean),
negative AS (
  SELECT order_id, customer_id, product_id, order_timestamp,
         CASE WHEN {_chance('negative_quantity', 0.05, *_ROW)} THEN -abs(quantity) ELSE quantity END
           AS quantity,
         CASE WHEN {_chance('negative_price', 0.05, *_ROW)} THEN -abs(price) ELSE price END AS price,
         status
  FROM doubled),
late AS (
  SELECT order_id, customer_id, product_id,
         CASE WHEN {_chance('late', 0.05, *_ROW)}
              THEN order_timestamp - to_seconds(60 * {_int('late_minutes', 1, 60, *_ROW)})
              ELSE order_timestamp END AS order_timestamp,
         quantity, price, status, order_timestamp AS arrival_time
  FROM negative)"""
SYNTH_DEFECTS = f"""SELECT CASE WHEN {_chance('missing_id', 0.01, *_ROW)} THEN NULL ELSE order_id END
  AS order_id, customer_id, product_id, order_timestamp, quantity, price, status, arrival_time
FROM late"""
SYNTH_CUSTOMERS = f"""named AS (
  SELECT c_custkey AS id, {_item('first_name', synth.FIRST_NAMES, 'c_custkey')} AS first,
         {_item('last_name', synth.LAST_NAMES, 'c_custkey')} AS last
  FROM customer)
SELECT 'c' || id AS customer_id, first || ' ' || last AS customer_name,
  lower(first || '.' || last) || id || '@{synth.MAIL_DOMAIN}' AS customer_email,
  {_item('segment', synth.SEGMENTS, 'id')} AS customer_segment,
  strftime(DATE '2026-01-31' - CAST({_int('registered', 1, 730, 'id')} AS INTEGER), '%Y-%m-%d')
    AS registration_date
FROM named"""
SYNTH_PRODUCTS = f"""drawn AS (
  SELECT p_partkey AS id, {_item('category', synth.CATEGORIES, 'p_partkey')} AS category,
         {_item('brand', synth.BRANDS, 'p_partkey')} AS brand,
         {_item('type', synth.ITEMS, 'p_partkey')} AS item
  FROM part)
SELECT 'p' || id AS product_id, brand || ' ' || item || ' ' || category AS product_name,
  category, brand, {_int('list_price', 1000, 60000, 'id')} / 100.0::DOUBLE AS list_price
FROM drawn"""

# --- streams of several batches ---------------------------------------------

def _delivery(*key: str) -> str:
    return f"""least(floor((epoch(arrival_time) - epoch(TIMESTAMP '2026-01-01')) / 259200), 9)::INT
  + CASE WHEN {_chance('delayed', 0.1, 'order_id', 'epoch_us(arrival_time)', *key)} THEN 2 ELSE 0 END"""


_SINGLE = f"""single AS (
  SELECT * REPLACE (CASE WHEN {_chance('negative_quantity', 0.05, *_ROW)} THEN -abs(quantity)
                         ELSE quantity END AS quantity) FROM clean)"""
_SINGLE_LATE = f"""SELECT * REPLACE (CASE WHEN {_chance('late', 0.05, *_ROW)}
  THEN order_timestamp - to_seconds(60 * {_int('late_minutes', 1, 60, *_ROW)})
  ELSE order_timestamp END AS order_timestamp), order_timestamp AS arrival_time FROM single"""
_REPEATED = f"""moved AS ({_SINGLE_LATE}),
repeated AS (
  SELECT *, unnest(CASE WHEN {_chance('repeat', 0.1, 'order_id', 'epoch_us(arrival_time)')}
    THEN [0, 1] ELSE [0] END) AS copy FROM moved)"""
_ANONYMOUS = f"""SELECT * REPLACE (CASE WHEN {_chance('missing_id', 0.01, *_ROW)} THEN NULL
  ELSE order_id END AS order_id) FROM repeated"""


def _on_time(rows: str, *key: str, restart: int | None = None) -> str:
    """Valid rows not behind the watermark. A batch drops by the watermark of the one
    before, so by what arrived two batches ago. A start on a checkpoint comes after a
    batch without rows, which has caught up by one."""
    back = f"CASE WHEN r.b = {restart} THEN 1 ELSE 2 END" if restart else "2"
    return f"""delivered AS (SELECT *, {_delivery(*key)} AS b FROM ({rows})),
raw AS (SELECT * FROM delivered),
{TAGGED},
good AS (
  SELECT * REPLACE (CASE WHEN lower(trim(status, ' ')) IN ('complete', 'done') THEN 'completed'
              WHEN lower(trim(status, ' ')) = 'canceled' THEN 'cancelled'
              ELSE lower(trim(status, ' ')) END AS status), status AS raw_status
  FROM tagged WHERE reject_reason IS NULL),
marks AS (SELECT b, max(order_timestamp) AS latest FROM good GROUP BY b),
judged AS (
  SELECT r.*, coalesce(order_timestamp <= (
    SELECT max(latest) FROM marks WHERE marks.b <= r.b - {back}) - INTERVAL '30 minutes', false) AS late
  FROM good r),
active AS (
  SELECT {ORDER}, quantity * price AS total_amount FROM judged WHERE status <> 'cancelled' AND NOT late)"""


_DELIVERED_TWICE = (SYNTH, _SINGLE, _REPEATED)
_TWICE = _with(*_DELIVERED_TWICE, _on_time(_ANONYMOUS, "copy"))
_ONCE = f"SELECT {ORDER}, 1::BIGINT AS n_rows FROM active GROUP BY ALL"
_STATE = """, stopped AS (SELECT max(latest) - INTERVAL '30 minutes' AS mark FROM marks WHERE b < 6)
SELECT DISTINCT order_id, order_timestamp + INTERVAL '30 minutes' AS expires_at FROM judged, stopped
WHERE NOT late AND b < 6 AND order_timestamp + INTERVAL '30 minutes' > mark"""
_SHOWN = """, on_time AS (
  SELECT *, time_bucket(INTERVAL '10 minutes', order_timestamp) AS w, quantity * price AS amount
  FROM judged WHERE status <> 'cancelled' AND NOT late),
changed AS (SELECT DISTINCT b, w, product_id FROM on_time),
shown AS (
  SELECT c.b::BIGINT AS batch_id, c.w AS window_start, c.w + INTERVAL '10 minutes' AS window_end,
         c.product_id, count(*) AS orders_count, round(sum(amount), 2) AS total_revenue,
         row_number() OVER (PARTITION BY c.b ORDER BY c.w, c.product_id) AS k
  FROM changed c JOIN on_time o ON o.w = c.w AND o.product_id = c.product_id AND o.b <= c.b
  GROUP BY c.b, c.w, c.product_id)
SELECT * EXCLUDE (k) FROM shown WHERE k <= 20"""
_BATCHES = """, firsts AS (
  SELECT b, count(*) AS kept FROM (
    SELECT order_id, min(b) AS b FROM judged WHERE NOT late GROUP BY order_id) GROUP BY b)
SELECT tagged.b::BIGINT AS batch_id, count(*) AS rows_in,
       count(*) FILTER (reject_reason = 'missing_order_id') AS missing_order_id,
       count(*) FILTER (reject_reason = 'invalid_values') AS invalid_values,
       count(*) FILTER (reject_reason = 'indeterminate_values') AS indeterminate_values,
       any_value(coalesce(kept, 0))::BIGINT AS kept
FROM tagged LEFT JOIN firsts USING (b) GROUP BY tagged.b"""

_ACTIVE = _with(*LINES)
_ENRICHED = _with(*LINES, CUSTOMERS, PRODUCTS)
_STREAM = _with(*STREAM)
_TOTALS = _STREAM + _revenue("product_id")
_EVENTS_ENRICHED = _with(*STREAM, CUSTOMERS, PRODUCTS) + f"SELECT {FULL} FROM active {LOOKUPS}"
_COUNTS = _ACTIVE + COUNTS
_STREAM_CLEAN = _STREAM + f"SELECT {ORDER} FROM active"

ORACLE: dict[str, str] = {
    "scan_orders": _with(RAW) + "SELECT * FROM raw",
    "scan_customers": _with(CUSTOMERS) + "SELECT * FROM customers",
    "scan_products": _with(PRODUCTS) + "SELECT * FROM products",
    "csv_orders": _with(RAW) + "SELECT * FROM raw",
    "csv_products": _with(PRODUCTS) + "SELECT * FROM products",
    "missing_id_valid": _with(RAW) + "SELECT * FROM raw WHERE order_id IS NOT NULL",
    "missing_id_rejects": _with(RAW) + "SELECT * FROM raw WHERE order_id IS NULL",
    "value_valid": _with(RAW)
    + "SELECT * FROM raw WHERE order_id IS NOT NULL AND quantity > 0 AND price >= 0",
    "value_rejects": _with(RAW)
    + "SELECT * FROM raw WHERE order_id IS NOT NULL AND (quantity <= 0 OR price < 0)",
    "quarantine": _with(RAW, TAGGED) + "SELECT * FROM tagged WHERE reject_reason IS NOT NULL",
    "normalize_status": _with(RAW, TAGGED, NORMAL) + "SELECT * FROM normal",
    "dedupe_orders": _with(RAW, TAGGED, NORMAL, KEPT) + "SELECT * FROM kept",
    "derive_columns": _with(RAW, TAGGED, NORMAL, KEPT, DERIVED) + "SELECT * FROM derived",
    "active_orders": _ACTIVE + "SELECT * FROM active",
    "cancelled_orders": _ACTIVE + CANCELLED,
    "cancelled_roundtrip": _ACTIVE + CANCELLED,
    "cancelled_roundtrip_events": _STREAM + CANCELLED,
    "enrich_customers": _ENRICHED
    + f"SELECT active.*, {CUSTOMER} FROM active LEFT JOIN customers USING (customer_id)",
    "enrich_products": _ENRICHED
    + f"SELECT active.*, {PRODUCT} FROM active LEFT JOIN products USING (product_id)",
    "enrich_dimensions": _ENRICHED + f"SELECT {FULL} FROM active {LOOKUPS}",
    "enrich_large_dimensions": _ENRICHED + f"SELECT {FULL} FROM active {LOOKUPS}",
    "daily_revenue": _ACTIVE + _revenue("order_date") + " ORDER BY order_date NULLS FIRST",
    "product_revenue": _ACTIVE + _revenue("product_id") + " ORDER BY total_revenue DESC, product_id",
    "hourly_revenue": _ACTIVE + _revenue("hour_of_day") + " ORDER BY hour_of_day NULLS FIRST",
    "top_products": _ACTIVE
    + _revenue("product_id")
    + " ORDER BY sum(total_amount) DESC, product_id LIMIT 10",
    "revenue_rollup": _ACTIVE
    + f"""SELECT order_date, product_id, hour_of_day,
  CASE WHEN grouping(order_date) = 0 THEN 'order_date' WHEN grouping(product_id) = 0
       THEN 'product_id' ELSE 'hour_of_day' END AS revenue_key, {REVENUE}
FROM active GROUP BY GROUPING SETS ((order_date), (product_id), (hour_of_day))""",
    "dq_metrics": _COUNTS,
    "batch_event_stats": _with(EVENTS)
    + """SELECT count(*) AS n_rows, min(order_timestamp) AS min_event_time,
  max(order_timestamp) AS max_event_time FROM raw""",
    "windowed_revenue_batch": _ACTIVE + WINDOWS,
    "parquet_roundtrip": _ENRICHED + f"SELECT {FULL} FROM active {LOOKUPS}",
    "parquet_roundtrip_events": _EVENTS_ENRICHED,
    "run_batch": _COUNTS,
    "run_batch_orders": _ENRICHED + f"SELECT {FULL} FROM active {LOOKUPS}",
    "batch_daily": _ACTIVE + _revenue("order_date"),
    "batch_products": _ACTIVE + _revenue("product_id"),
    "batch_hourly": _ACTIVE + _revenue("hour_of_day"),
    "run_batch_events": _EVENTS_ENRICHED,
    "kafka_decode": DECODED,
    "kafka_roundtrip": _with(EVENTS) + "SELECT * FROM raw",
    "kafka_dead_letter": DEAD + " SELECT * FROM found WHERE reason IS NOT NULL",
    "stream_clean": _STREAM_CLEAN,
    "stream_clean_thinned": _STREAM_CLEAN,
    "stream_clean_csv": _STREAM_CLEAN,
    "stream_clean_kafka": _STREAM_CLEAN,
    "stream_dedupe": _with(EVENTS) + "SELECT DISTINCT * FROM raw WHERE order_id IS NOT NULL",
    "stream_enrich": _EVENTS_ENRICHED,
    "stream_enrich_large": _EVENTS_ENRICHED,
    "stream_windowed_revenue": _STREAM + CLOSED_WINDOWS,
    "stream_windows_by_product": _STREAM + CLOSED_WINDOWS,
    "stream_windows_update": _with(SYNTH, _SINGLE, _on_time(_SINGLE_LATE)) + WINDOWS,
    "stream_totals_deltas": _with(SYNTH, _SINGLE, _on_time(_SINGLE_LATE)) + _revenue("product_id"),
    "stream_late_dropped": _TWICE + _ONCE,
    "stream_restart": _with(*_DELIVERED_TWICE, _on_time(_ANONYMOUS, "copy", restart=6)) + _ONCE,
    "stream_replay": _TWICE + _ONCE,
    "stream_state": _TWICE.rstrip() + _STATE,
    "stream_late_rows": _TWICE
    + f"SELECT {ORDER.replace('status', 'raw_status AS status')} FROM judged WHERE late",
    "stream_batch_metrics": _TWICE.rstrip() + _BATCHES,
    "stream_summary": _TWICE
    + """SELECT 'clean' AS query, (SELECT count(*) FROM raw) AS input_rows,
  count(*) FILTER (late) AS late_rows, min(order_timestamp) AS min_event_time,
  max(order_timestamp) AS max_event_time, true AS complete FROM judged""",
    "stream_triggered": _STREAM_CLEAN,
    "stream_console": _with(SYNTH, _SINGLE, _on_time(_SINGLE_LATE)).rstrip() + _SHOWN,
    "stream_cleaned": _STREAM_CLEAN,
    "stream_snapshots": _TOTALS,
    "stream_product_totals": _TOTALS,
    "stream_top_products": _TOTALS + " ORDER BY sum(total_amount) DESC, product_id LIMIT 10",
    "snapshot_latest": _TOTALS,
    "stream_quarantine": _with(EVENTS, TAGGED)
    + "SELECT * FROM tagged WHERE reject_reason IS NOT NULL",
    "stream_quarantine_stored": _with(EVENTS, TAGGED)
    + "SELECT * FROM tagged WHERE reject_reason IS NOT NULL",
    "stream_dead_letters_stored": DEAD
    + " SELECT payload, reason FROM found WHERE reason IS NOT NULL",
    "run_stream": _TOTALS,
    "run_stream_windows": _STREAM + CLOSED_WINDOWS,
    "reconcile": _STREAM
    + """SELECT product_id, count(order_id) AS batch_orders, count(order_id) AS stream_orders,
  CAST(0 AS BIGINT) AS orders_diff, CAST(0 AS DOUBLE) AS revenue_diff
FROM active GROUP BY product_id""",
    "synth_orders": _with(SYNTH) + "SELECT * FROM clean",
    "synth_defects": _with(SYNTH, DEFECTS) + SYNTH_DEFECTS,
    "microbatch_files": _with(SYNTH, DEFECTS)
    + f"SELECT {ORDER}, true AS size_kept, true AS order_kept FROM ({SYNTH_DEFECTS})",
    "synth_customers": "WITH " + SYNTH_CUSTOMERS,
    "synth_products": "WITH " + SYNTH_PRODUCTS,
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
