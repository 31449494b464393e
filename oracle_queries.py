"""Independent DuckDB SQL for the registered queries, written against the same parquet views.

Shared steps are common table expressions; each query lists the steps it needs.
"""

from __future__ import annotations

from lake_queries import ALARM_DELAY_DAYS, BUFFER_BYTES, HEARTBEAT_DAYS

_EVENT_PAYLOADS = """
base AS (
    SELECT event_id AS id,
           lpad(CAST(event_id AS VARCHAR), 12, '0') AS id12,
           CASE WHEN event_id % 500 BETWEEN 1 AND 16 THEN event_id % 500 ELSE 0 END AS planted,
           event_type AS kind, date_trunc('second', ts) AS t0, user_id,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value AS price
    FROM events
),
kinds AS (
    SELECT *,
           CASE WHEN planted IN (5, 10, 11, 12, 13) THEN 'order_placed'
                WHEN planted = 16 THEN 'cart_abandoned'
                WHEN kind = 'purchase' THEN 'order_placed'
                WHEN kind = 'click' THEN 'cart_abandoned'
                WHEN kind = 'error' THEN 'payment_failed'
                ELSE 'product_viewed' END AS typ,
           CASE WHEN planted = 15 THEN t0 + INTERVAL 1 HOUR
                WHEN planted = 0 AND id % 20 = 3 THEN t0 + to_hours(CAST(2 + id % 71 AS INTEGER))
                ELSE t0 + INTERVAL 5 MINUTE END AS first_arrival,
           ['lamp', 'chair', 'teapot', 'blanket', 'notebook', 'bicycle', 'kettle', 'mirror'][k % 8 + 1] AS cat,
           ['limit_reached', 'wrong_pin', 'account_closed', 'timed_out', 'bank_offline', 'suspicious'][id % 6 + 1] AS failure
    FROM base
),
copies AS (
    SELECT *, 0 AS copy FROM kinds
    UNION ALL
    SELECT *, 1 AS copy FROM kinds WHERE planted = 0 AND id % 40 = 7
),
shown AS (
    SELECT *,
           first_arrival + to_hours(copy) AS arrived_at,
           CASE WHEN planted = 9 THEN first_arrival + INTERVAL 10 MINUTE
                WHEN planted = 14 THEN first_arrival + INTERVAL 300 SECOND
                ELSE t0 END AS shown_time,
           CASE WHEN planted = 10 THEN '"abcde"' WHEN planted = 11 THEN '0' WHEN planted = 16 THEN '"many"'
                ELSE CAST(1 + id % 5 AS VARCHAR) END AS quantity,
           CASE WHEN planted = 12 THEN '-' || CAST(price AS VARCHAR) WHEN planted = 13 THEN '0'
                WHEN copy = 1 THEN CAST(round(price + 1, 2) AS VARCHAR)
                ELSE CAST(price AS VARCHAR) END AS unit_price
    FROM copies
),
objects AS (
    SELECT planted, arrived_at, '{' || concat_ws(',',
        '"event_id":"' || CASE WHEN planted = 6 THEN '#' ELSE '' END || id12 || '"',
        '"event_type":"' || CASE WHEN planted = 4 THEN 'wishlist_added' ELSE typ END || '"',
        '"event_timestamp":' || CASE WHEN planted = 7 THEN CAST(1700000000 + id AS VARCHAR)
            WHEN planted = 8 THEN '"not-a-date"'
            ELSE '"' || strftime(shown_time, '%Y-%m-%dT%H:%M:%SZ') || '"' END,
        CASE WHEN planted <> 3 THEN '"customer_id":"cust-' || lpad(CAST(user_id AS VARCHAR), 6, '0') || '"' END,
        '"product_id":"' || cat || '-' || lpad(CAST(k AS VARCHAR), 5, '0') || '"',
        '"category":"' || cat || '"',
        CASE WHEN typ IN ('order_placed', 'payment_failed') AND planted <> 5
             THEN '"order_id":"ord-' || id12 || '"' END,
        CASE WHEN typ = 'cart_abandoned' THEN '"cart_id":"cart-' || id12 || '"' END,
        CASE WHEN typ <> 'product_viewed' THEN '"quantity":' || quantity END,
        CASE WHEN typ <> 'product_viewed' THEN '"unit_price":' || unit_price END,
        CASE WHEN typ = 'payment_failed' THEN '"failure_code":"' || failure || '"' END
    ) || '}' AS json
    FROM shown
),
raw AS (
    SELECT CASE WHEN planted = 1 THEN left(json, length(json) - 10)
                WHEN planted = 2 THEN '[' || json || ']' ELSE json END AS value,
           arrived_at
    FROM objects
)"""

_ORDER_LINE_PAYLOADS = """
raw AS (
    SELECT '{"event_id":"' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '-'
           || lpad(CAST(l_linenumber AS VARCHAR), 4, '0')
           || '","event_type":"order_placed","event_timestamp":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')
           || '","customer_id":"cust-' || lpad(CAST(o_custkey AS VARCHAR), 6, '0')
           || '","product_id":"'
           || ['lamp', 'chair', 'teapot', 'blanket', 'notebook', 'bicycle', 'kettle', 'mirror'][l_partkey % 8 + 1]
           || '-' || lpad(CAST(l_partkey AS VARCHAR), 5, '0')
           || '","order_id":"ord-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0')
           || '","quantity":' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
           || ',"unit_price":' || CAST(l_extendedprice AS VARCHAR) || '}' AS value,
           l_shipdate AS arrived_at
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

_JUDGED = """
safe AS (
    SELECT value, arrived_at, json_valid(value) AS ok,
           CASE WHEN json_valid(value) THEN value ELSE '{}' END AS j
    FROM raw
),
fields AS (
    SELECT *, json_type(j) AS top,
           json_extract_string(j, '$.event_id') AS event_id,
           json_extract_string(j, '$.event_type') AS event_type,
           json_extract_string(j, '$.event_timestamp') AS event_timestamp,
           json_type(j, '$.event_timestamp') AS time_type,
           json_extract_string(j, '$.customer_id') AS customer_id,
           json_extract_string(j, '$.product_id') AS product_id,
           json_extract_string(j, '$.category') AS category,
           json_extract_string(j, '$.order_id') AS order_id,
           json_extract_string(j, '$.cart_id') AS cart_id,
           json_extract_string(j, '$.quantity') AS quantity,
           json_extract_string(j, '$.unit_price') AS unit_price,
           json_extract_string(j, '$.failure_code') AS failure_code,
           try_strptime(json_extract_string(j, '$.event_timestamp'), '%Y-%m-%dT%H:%M:%SZ') AS happened_at
    FROM safe
),
gaps AS (
    SELECT *,
        concat_ws(',', CASE WHEN coalesce(event_id, '') = '' THEN 'event_id' END,
            CASE WHEN coalesce(event_type, '') = '' THEN 'event_type' END,
            CASE WHEN coalesce(event_timestamp, '') = '' THEN 'event_timestamp' END,
            CASE WHEN coalesce(customer_id, '') = '' THEN 'customer_id' END) AS missing,
        concat_ws(',',
            CASE WHEN event_type IN ('order_placed', 'payment_failed') AND coalesce(order_id, '') = '' THEN 'order_id' END,
            CASE WHEN event_type = 'cart_abandoned' AND coalesce(cart_id, '') = '' THEN 'cart_id' END,
            CASE WHEN event_type IN ('order_placed', 'cart_abandoned', 'product_viewed')
                  AND coalesce(product_id, '') = '' THEN 'product_id' END,
            CASE WHEN event_type = 'order_placed' AND coalesce(quantity, '') = '' THEN 'quantity' END,
            CASE WHEN event_type = 'order_placed' AND coalesce(unit_price, '') = '' THEN 'unit_price' END,
            CASE WHEN event_type = 'payment_failed' AND coalesce(failure_code, '') = '' THEN 'failure_code' END
        ) AS type_missing,
        TRY_CAST(quantity AS BIGINT) AS qty, TRY_CAST(unit_price AS DOUBLE) AS price
    FROM fields
),
judged AS (
    SELECT *,
        CASE WHEN NOT ok THEN 'invalid_json'
             WHEN top <> 'OBJECT' THEN 'not_an_object'
             WHEN missing <> '' THEN 'missing_required_field'
             WHEN event_type NOT IN ('order_placed', 'cart_abandoned', 'product_viewed', 'payment_failed')
                  THEN 'unknown_event_type'
             WHEN type_missing <> '' THEN 'missing_type_specific_field'
             WHEN NOT regexp_full_match(event_id, '[0-9a-fA-F-]{8,36}') THEN 'malformed_event_id'
             WHEN time_type <> 'VARCHAR' THEN 'bad_timestamp_type'
             WHEN happened_at IS NULL THEN 'unparseable_timestamp'
             WHEN epoch(happened_at) - epoch(arrived_at) > 300 THEN 'future_timestamp'
             WHEN event_type = 'order_placed' AND (qty IS NULL OR price IS NULL) THEN 'non_numeric_amount'
             WHEN event_type = 'order_placed' AND qty <= 0 THEN 'non_positive_quantity'
             WHEN event_type = 'order_placed' AND price < 0 THEN 'negative_price'
        END AS reject_reason
    FROM gaps
)"""

_REJECTED = """
rejected AS (
    SELECT reject_reason,
        CASE reject_reason
            WHEN 'invalid_json' THEN 'payload is not exactly one JSON value'
            WHEN 'not_an_object' THEN CASE top WHEN 'ARRAY' THEN 'list' WHEN 'VARCHAR' THEN 'str' ELSE lower(top) END
            WHEN 'missing_required_field' THEN missing
            WHEN 'unknown_event_type' THEN event_type
            WHEN 'missing_type_specific_field' THEN event_type || ':' || type_missing
            WHEN 'malformed_event_id' THEN event_id
            WHEN 'bad_timestamp_type' THEN 'expected string, got '
                || CASE WHEN time_type IN ('BIGINT', 'UBIGINT') THEN 'int' ELSE lower(time_type) END
            WHEN 'unparseable_timestamp' THEN event_timestamp
            WHEN 'future_timestamp' THEN strftime(happened_at, '%Y-%m-%dT%H:%M:%S') || '+00:00'
            WHEN 'non_numeric_amount' THEN 'qty=' || quantity || ' price=' || unit_price
            WHEN 'non_positive_quantity' THEN CAST(qty AS VARCHAR)
            WHEN 'negative_price' THEN CAST(price AS VARCHAR)
        END AS reject_detail,
        strftime(arrived_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS rejected_at,
        value AS raw_payload, CAST(NULL AS VARCHAR) AS raw_base64,
        strftime(arrived_at, '%Y-%m-%d') AS ingest_date
    FROM judged WHERE reject_reason IS NOT NULL
)"""

_BRONZE = """
bronze AS (
    SELECT event_id, event_type, event_timestamp, customer_id, product_id, order_id, cart_id, quantity,
           unit_price, failure_code, category,
           strftime(happened_at, '%Y-%m-%d') AS event_date,
           strftime(arrived_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS _validated_at,
           epoch(arrived_at) - epoch(happened_at) > 3600 AS _is_late_arrival,
           strftime(arrived_at, '%Y-%m-%d') AS ingest_date
    FROM judged WHERE reject_reason IS NULL
)"""

_TYPED = """
typed AS (
    SELECT event_id, event_type, try_strptime(event_timestamp, '%Y-%m-%dT%H:%M:%SZ') AS event_timestamp,
           customer_id, product_id, order_id, cart_id, TRY_CAST(quantity AS INTEGER) AS quantity,
           TRY_CAST(unit_price AS DOUBLE) AS unit_price, failure_code,
           strptime(_validated_at, '%Y-%m-%dT%H:%M:%S+00:00') AS validated_at,
           coalesce(_is_late_arrival, false) AS is_late_arrival
    FROM bronze
)"""

_SILVER = """
silver_copies AS (
    SELECT *,
           CASE WHEN event_type = 'order_placed' THEN round(quantity * unit_price, 2) END AS gross_amount,
           strftime(event_timestamp, '%Y-%m-%d') AS event_date,
           row_number() OVER (PARTITION BY event_id ORDER BY validated_at DESC NULLS LAST,
               event_timestamp DESC NULLS LAST, event_type DESC NULLS LAST, customer_id DESC NULLS LAST,
               product_id DESC NULLS LAST, order_id DESC NULLS LAST, cart_id DESC NULLS LAST,
               quantity DESC NULLS LAST, unit_price DESC NULLS LAST, failure_code DESC NULLS LAST,
               is_late_arrival DESC NULLS LAST) AS rn
    FROM typed WHERE event_timestamp IS NOT NULL
),
silver AS (
    SELECT event_id, event_type, event_timestamp, customer_id, product_id, order_id, cart_id, quantity,
           unit_price, gross_amount, failure_code, is_late_arrival, event_date, validated_at
    FROM silver_copies WHERE rn = 1
)"""

_FACT = """
fact AS (
    SELECT left(sha256(order_id || '|' || product_id), 16) AS order_key, order_id,
           left(sha256('cust|' || customer_id), 16) AS customer_key,
           left(sha256('prod|' || product_id), 16) AS product_key,
           CAST(strftime(event_timestamp, '%Y%m%d') AS INTEGER) AS date_key,
           quantity, unit_price, gross_amount, event_timestamp, is_late_arrival, event_date
    FROM silver WHERE event_type = 'order_placed'
)"""

_DAYS = """
days AS (
    SELECT CAST(unnest(generate_series(
        (SELECT date_trunc('day', min(event_timestamp)) FROM silver),
        (SELECT date_trunc('day', max(event_timestamp)) FROM silver), INTERVAL 1 DAY)) AS DATE) AS full_date
),
dates AS (
    SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date,
           CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
           CAST(month(full_date) AS INTEGER) AS month, CAST(day(full_date) AS INTEGER) AS day,
           CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week, dayname(full_date) AS day_name,
           dayofweek(full_date) IN (0, 6) AS is_weekend
    FROM days
)"""

_DAILY = """
daily AS (
    SELECT d.full_date AS day, d.day_name, d.is_weekend, count(*) AS order_lines,
           CAST(sum(CAST(f.gross_amount AS DECIMAL(28, 2))) AS DOUBLE) AS revenue,
           CAST(round(CAST(CAST(sum(CAST(f.gross_amount AS DECIMAL(28, 2))) AS DOUBLE) / count(f.gross_amount) AS DECIMAL(38, 9)), 2) AS DOUBLE) AS avg_order_value
    FROM fact f JOIN dates d ON f.date_key = d.date_key
    GROUP BY d.full_date, d.day_name, d.is_weekend
)"""

_SUMMARY = """
summary AS (
    SELECT reject_reason, ingest_date, count(*) AS reject_count, max(rejected_at) AS last_seen_at,
           min(reject_detail) AS sample_detail
    FROM rejected GROUP BY reject_reason, ingest_date
)"""

_CUSTOMERS = """
customers AS (
    SELECT left(sha256('cust|' || customer_id), 16) AS customer_key, customer_id,
           min(event_timestamp) AS first_seen_at, max(event_timestamp) AS last_seen_at,
           count(*) AS total_events, count(*) FILTER (event_type = 'order_placed') AS total_orders
    FROM silver WHERE customer_id IS NOT NULL GROUP BY customer_id
)"""

_PRODUCTS = """
products AS (
    SELECT left(sha256('prod|' || product_id), 16) AS product_key, product_id,
           split_part(product_id, '-', 1) AS category,
           CAST(round(CAST(avg(unit_price) FILTER (unit_price > 0) AS DECIMAL(38, 9)), 2) AS DOUBLE) AS avg_unit_price,
           count(*) FILTER (event_type = 'product_viewed') AS times_viewed,
           count(*) FILTER (event_type = 'order_placed') AS times_ordered
    FROM silver WHERE product_id IS NOT NULL GROUP BY product_id
)"""

_LAYOUTS = "layouts AS (SELECT unnest(['raw_json', 'parquet_flat', 'parquet_part']) AS layout)"

_REASON_COLUMNS = ", ".join(
    f"count(*) FILTER (reject_reason = '{r}') AS {r}"
    for r in (
        "invalid_json", "not_an_object", "missing_required_field", "unknown_event_type",
        "missing_type_specific_field", "malformed_event_id", "bad_timestamp_type", "unparseable_timestamp",
        "future_timestamp", "non_numeric_amount", "non_positive_quantity", "negative_price",
    )
)

_LABELS = """(VALUES
    ('missing_required_field', 'Missing a required field'),
    ('missing_type_specific_field', 'Missing a field required for that event type'),
    ('invalid_json', 'Payload was not parseable JSON'),
    ('unknown_event_type', 'Event type not in the accepted set'),
    ('non_positive_quantity', 'Order quantity was zero or negative'),
    ('unparseable_timestamp', 'Timestamp could not be parsed'),
    ('non_numeric_amount', 'Quantity or price was not numeric'),
    ('malformed_event_id', 'Event ID failed format check'),
    ('future_timestamp', 'Timestamp was implausibly in the future'),
    ('negative_price', 'Unit price was negative'),
    ('bad_timestamp_type', 'Timestamp was not a string'),
    ('not_an_object', 'Record was not a JSON object')) AS labels(reason, label)"""

_SILVER_COLUMNS = (
    "event_id, event_type, event_timestamp, customer_id, product_id, order_id, cart_id, quantity, "
    "unit_price, gross_amount, failure_code, is_late_arrival, event_date"
)

_EVENTS = {"raw": _EVENT_PAYLOADS, "lines": _ORDER_LINE_PAYLOADS}


def _sql(steps: list[str], select: str, payloads: str = "raw") -> str:
    return "WITH " + ",".join([_EVENTS[payloads], *steps]) + "\n" + select


_TO_BRONZE = [_JUDGED, _BRONZE]
_TO_TYPED = [*_TO_BRONZE, _TYPED]
_TO_SILVER = [*_TO_TYPED, _SILVER]
_TO_FACT = [*_TO_SILVER, _FACT]
_TO_SUMMARY = [_JUDGED, _REJECTED, _SUMMARY]

_FRESHNESS = """
SELECT max(event_timestamp) AS max_event_ts, min(event_timestamp) AS min_event_ts,
       count(DISTINCT event_date) AS distinct_days,
       CAST(floor(epoch(TIMESTAMP '{as_of}') - epoch(max(event_timestamp))) AS BIGINT) AS lag_seconds,
       CASE WHEN epoch(TIMESTAMP '{as_of}') - epoch(max(event_timestamp)) > 86400 THEN 'stale'
            WHEN epoch(TIMESTAMP '{as_of}') - epoch(max(event_timestamp)) > 21600 THEN 'lagging'
            ELSE 'fresh' END AS health
FROM fact"""

_STAGE_METRICS = """
SELECT *, total_valid_events + quarantined_rows AS total_generated_events,
       CASE WHEN total_valid_events + quarantined_rows > 0
            THEN 100.0 * quarantined_rows / (total_valid_events + quarantined_rows) ELSE 0 END AS quarantine_rate_pct
FROM (SELECT (SELECT count(*) FROM fact) AS gold_fact_rows,
    (SELECT count(DISTINCT customer_key) FROM customers) AS gold_customers,
    (SELECT count(DISTINCT product_key) FROM products) AS gold_products,
    (SELECT CAST(coalesce(sum(reject_count), 0) AS BIGINT) FROM summary) AS quarantined_rows,
    (SELECT CAST(coalesce(sum(CAST(gross_amount AS DECIMAL(28, 2))), 0) AS DOUBLE) FROM fact) AS gross_revenue,
    (SELECT count(*) FROM fact WHERE is_late_arrival) AS late_arrivals,
    (SELECT CAST(coalesce(sum(total_events), 0) AS BIGINT) FROM customers) AS total_valid_events)"""

_RATE_ALARM = """,
windows AS (
    SELECT time_bucket(INTERVAL 5 MINUTE, arrived_at) AS period_start, count(*) AS received,
           count(reject_reason) AS rejected
    FROM judged GROUP BY 1
),
spine AS (
    SELECT unnest(generate_series((SELECT min(period_start) FROM windows),
        (SELECT max(period_start) FROM windows), INTERVAL 5 MINUTE)) AS period_start
),
dense AS (
    SELECT s.period_start, w.received, w.rejected,
           CASE WHEN w.received > 0 THEN 100.0 * w.rejected / w.received ELSE 0 END AS rate
    FROM spine s LEFT JOIN windows w ON s.period_start = w.period_start
),
alarms AS (
    SELECT *, rate > 5 AND coalesce(lag(rate) OVER (ORDER BY period_start), 0) > 5 AS in_alarm FROM dense
)
SELECT period_start, received, rejected, CAST(rate AS DOUBLE) AS reject_rate_pct, rate > 5 AS breaching, in_alarm
FROM alarms WHERE received IS NOT NULL"""

_FRESHNESS_ALARM = """,
orders_seen AS (
    SELECT validated_at, event_timestamp, date_trunc('hour', validated_at) AS period_start
    FROM typed WHERE event_type = 'order_placed' AND event_timestamp IS NOT NULL
),
arrivals AS (SELECT period_start, max(validated_at) AS observed_at FROM orders_seen GROUP BY 1),
points AS (
    SELECT a.period_start, greatest(epoch(a.observed_at) - epoch(
        (SELECT max(o.event_timestamp) FROM orders_seen o WHERE o.validated_at <= a.observed_at)), 0) AS lag
    FROM arrivals a
),
hours AS (
    SELECT unnest(generate_series((SELECT min(period_start) FROM points),
        (SELECT max(period_start) FROM points), INTERVAL 1 HOUR)) AS period_start
)
SELECT h.period_start, CAST(p.lag AS DOUBLE) AS max_lag_seconds, coalesce(p.lag > 86400, true) AS breaching
FROM hours h LEFT JOIN points p ON h.period_start = p.period_start"""


# A further hours' spine: on to the last hour that the watermark closes after the last heartbeat.
_FRESHNESS_STREAM = _FRESHNESS_ALARM.replace(
    "(SELECT max(period_start) FROM points)",
    f"(SELECT date_trunc('hour', max(arrived_at) + INTERVAL {HEARTBEAT_DAYS - ALARM_DELAY_DAYS} DAY) - INTERVAL 1 HOUR FROM raw)",
)

_NUMBER = "TRY_CAST(regexp_extract(value, '\"event_id\":\"#?([0-9]{12})\"', 1) AS BIGINT)"


def _changed(value: str) -> str:
    """The event payloads with another text."""
    return _EVENT_PAYLOADS.replace("raw AS (", "plain_raw AS (") + f", raw AS (SELECT {value} AS value, arrived_at FROM plain_raw)"


_SPELLED = _changed(
    f"""replace(value, 'Z"', CASE WHEN {_NUMBER} % 3 = 1 THEN '"' WHEN {_NUMBER} % 3 = 2 THEN '+02:00"' ELSE 'Z"' END)"""
)
_JUDGED_SPELLED = _JUDGED.replace(
    "try_strptime(json_extract_string(j, '$.event_timestamp'), '%Y-%m-%dT%H:%M:%SZ') AS happened_at",
    """coalesce(try_strptime(json_extract_string(j, '$.event_timestamp'), '%Y-%m-%dT%H:%M:%SZ'),
               try_strptime(json_extract_string(j, '$.event_timestamp'), '%Y-%m-%dT%H:%M:%S'),
               try_strptime(json_extract_string(j, '$.event_timestamp'), '%Y-%m-%dT%H:%M:%S+02:00') - INTERVAL 2 HOUR) AS happened_at""",
)
_GROWN = _changed(
    f"""CASE WHEN {_NUMBER} % 97 = 0 AND contains(value, '"event_type":"order_placed"') AND regexp_matches(value, '"quantity":[0-9]')
         THEN replace(value, '"quantity":', '"quantity":1000000000') ELSE value END"""
)


def build(as_of: str) -> dict[str, str]:
    """Query name -> SQL. ``as_of`` is the clock the freshness queries are asked at."""
    bronze = "SELECT * FROM bronze"
    silver = f"SELECT {_SILVER_COLUMNS} FROM silver"
    queries = {
        "bronze_scan": _sql(_TO_BRONZE, bronze),
        "validate_valid": _sql(_TO_BRONZE, bronze),
        "validate_rejects": _sql([_JUDGED, _REJECTED], "SELECT * FROM rejected"),
        "reject_counts": _sql([_JUDGED, _REJECTED], "SELECT reject_reason, count(*) AS n FROM rejected GROUP BY 1"),
        "ingest_counters": _sql(
            [_JUDGED],
            "SELECT count(*) AS received, count(*) FILTER (reject_reason IS NULL) AS valid, "
            f"count(reject_reason) AS quarantined, {_REASON_COLUMNS} FROM judged",
        ),
        "silver_typed": _sql(_TO_TYPED, "SELECT * FROM typed"),
        "silver_events": _sql(_TO_SILVER, silver),
        "silver_dedupe": _sql(_TO_SILVER, "SELECT event_id, validated_at, unit_price FROM silver"),
        "silver_counters": _sql(
            _TO_SILVER,
            """SELECT (SELECT count(*) FROM typed) AS rows_in,
                (SELECT count(*) FROM typed WHERE event_timestamp IS NULL) AS unparseable,
                (SELECT count(*) FROM silver) AS rows_out,
                (SELECT count(*) FROM silver_copies WHERE rn > 1) AS duplicates""",
        ),
        "late_arrivals": _sql(
            _TO_SILVER,
            "SELECT event_date, count(*) AS events, count(*) FILTER (is_late_arrival) AS late_events "
            "FROM silver GROUP BY event_date",
        ),
        "dim_customer": _sql([*_TO_SILVER, _CUSTOMERS], "SELECT * FROM customers"),
        "dim_product": _sql([*_TO_SILVER, _PRODUCTS], "SELECT * FROM products"),
        "dim_date": _sql([*_TO_SILVER, _DAYS], "SELECT * FROM dates"),
        "fact_orders": _sql(_TO_FACT, "SELECT * FROM fact"),
        "quarantine_summary": _sql(_TO_SUMMARY, "SELECT * FROM summary"),
        "freshness_lag": _sql(
            _TO_FACT,
            f"SELECT greatest(epoch(TIMESTAMP '{as_of}') - epoch(max(event_timestamp)), 0) AS lag_seconds FROM fact",
        ),
        "freshness": _sql(_TO_FACT, _FRESHNESS.format(as_of=as_of)),
        "stage_metrics": _sql([*_TO_FACT, _CUSTOMERS, _PRODUCTS, _REJECTED, _SUMMARY], _STAGE_METRICS),
        "daily_revenue": _sql([*_TO_FACT, _DAYS, _DAILY], "SELECT * FROM daily ORDER BY day"),
        "revenue_totals": _sql(
            [*_TO_FACT, _DAYS, _DAILY],
            "SELECT CAST(sum(CAST(revenue AS DECIMAL(28, 2))) AS DOUBLE) AS revenue, CAST(sum(order_lines) AS BIGINT) AS order_lines, "
            "count(*) AS days FROM daily",
        ),
        "quarantine_by_reason": _sql(
            _TO_SUMMARY,
            f"""SELECT reject_reason, coalesce(label, reject_reason) AS label, CAST(sum(reject_count) AS BIGINT) AS n,
                max(last_seen_at) AS last_seen_at,
                100.0 * sum(reject_count) / (SELECT sum(reject_count) FROM summary) AS share_pct
            FROM summary LEFT JOIN {_LABELS} ON reason = reject_reason
            GROUP BY reject_reason, label ORDER BY n DESC, reject_reason""",
        ),
        "pivot_date": _sql(
            _TO_SILVER,
            "SELECT event_date, count(*) AS c FROM silver GROUP BY event_date ORDER BY c DESC, event_date LIMIT 1",
        ),
        "bench_narrow_projection": _sql(
            [*_TO_SILVER, _LAYOUTS],
            "SELECT layout, (SELECT CAST(sum(CAST(gross_amount AS DECIMAL(28, 2))) AS DOUBLE) FROM silver) AS total_revenue FROM layouts",
        ),
        "bench_date_filtered": _sql(
            [*_TO_SILVER, _LAYOUTS],
            """SELECT layout, event_type, n, revenue FROM layouts, (
                SELECT event_type, count(*) AS n, CAST(sum(CAST(gross_amount AS DECIMAL(28, 2))) AS DOUBLE) AS revenue FROM silver
                WHERE event_date = (SELECT event_date FROM silver GROUP BY event_date
                                    ORDER BY count(*) DESC, event_date LIMIT 1)
                GROUP BY event_type)""",
        ),
        "bench_full_groupby": _sql(
            [*_TO_SILVER, _LAYOUTS],
            """SELECT layout, event_type, n, avg_price FROM layouts, (
                SELECT event_type, count(*) AS n, round(avg(unit_price), 6) AS avg_price
                FROM silver GROUP BY event_type)""",
        ),
        "clustered_days": _sql(
            _TO_SILVER,
            """SELECT event_date, event_type, count(*) AS n, count(DISTINCT event_id) AS ids,
                CAST(sum(CAST(gross_amount AS DECIMAL(28, 2))) AS DOUBLE) AS revenue
            FROM silver GROUP BY event_date, event_type""",
        ),
        "clustered_date_filtered": _sql(
            _TO_SILVER,
            """SELECT event_type, count(*) AS n, CAST(sum(CAST(gross_amount AS DECIMAL(28, 2))) AS DOUBLE) AS revenue FROM silver
            WHERE event_date = (SELECT event_date FROM silver GROUP BY event_date ORDER BY count(*) DESC, event_date LIMIT 1)
            GROUP BY event_type""",
        ),
        "layout_roundtrip": _sql(
            [*_TO_SILVER, _LAYOUTS],
            "SELECT layout, (SELECT count(*) FROM silver) AS rows_written, CAST(0 AS BIGINT) AS rows_missing, "
            "CAST(0 AS BIGINT) AS rows_extra FROM layouts",
        ),
        "catalog_tables": _sql(
            [*_TO_FACT, _CUSTOMERS, _PRODUCTS, _DAYS, _REJECTED, _SUMMARY],
            """SELECT 'silver_events' AS table_name, count(*) AS row_count FROM silver
            UNION ALL SELECT 'fact_orders', count(*) FROM fact
            UNION ALL SELECT 'dim_customer', count(*) FROM customers
            UNION ALL SELECT 'dim_product', count(*) FROM products
            UNION ALL SELECT 'dim_date', count(*) FROM dates
            UNION ALL SELECT 'quarantine_summary', count(*) FROM summary
            UNION ALL SELECT 'bench_raw_json', count(*) FROM silver
            UNION ALL SELECT 'bench_parquet_flat', count(*) FROM silver
            UNION ALL SELECT 'bench_parquet_part', count(*) FROM silver""",
        ),
        "stream_ingest": _sql(
            _TO_BRONZE + [_REJECTED],
            "SELECT 'bronze' AS side, event_id AS item, _validated_at AS stamped_at FROM bronze "
            "UNION ALL SELECT reject_reason, raw_payload, rejected_at FROM rejected",
        ),
        "ingest_replay": _sql(
            _TO_BRONZE + [_REJECTED],
            "SELECT 'bronze' AS side, event_id AS item, _validated_at AS stamped_at FROM bronze "
            "UNION ALL SELECT reject_reason, raw_payload, rejected_at FROM rejected",
        ),
        "stream_text_replay": _sql(
            _TO_BRONZE + [_REJECTED],
            "SELECT 'bronze' AS side, event_id AS item, _validated_at AS stamped_at FROM bronze "
            "UNION ALL SELECT reject_reason, raw_payload, rejected_at FROM rejected",
        ),
        "compacted_bronze": _sql(_TO_BRONZE, bronze),
        "compacted_quarantine": _sql([_JUDGED, _REJECTED], "SELECT * FROM rejected"),
        "silver_incremental": _sql(_TO_SILVER, silver),
        "catalog_incremental": _sql(_TO_SILVER, "SELECT event_date, count(*) AS events FROM silver GROUP BY event_date"),
        "buffered_ingest": _sql(
            [_JUDGED],
            "SELECT count(*) AS received, count(reject_reason) AS quarantined, CAST(0 AS BIGINT) AS oversized_batches, "
            f"sum(length(value)) > {BUFFER_BYTES} AS several_batches FROM judged",
        ),
        "reject_rate_alarm_stream": _sql([_JUDGED], "").rstrip() + _RATE_ALARM,
        "freshness_alarm_stream": _sql(_TO_TYPED, "").rstrip() + _FRESHNESS_STREAM,
        "accepted_times": "WITH " + ",".join([_SPELLED, _JUDGED_SPELLED]) + """
SELECT event_id, left(event_timestamp, 10) AS event_date, happened_at AS event_timestamp,
       epoch(arrived_at) - epoch(happened_at) > 3600 AS is_late_arrival, arrived_at AS validated_at
FROM judged WHERE reject_reason IS NULL""",
        "amounts_lost": "WITH " + ",".join([_GROWN, _JUDGED, _BRONZE, _TYPED, _SILVER]) + """
SELECT (SELECT count(*) FROM typed) AS rows_in, CAST(0 AS BIGINT) AS unparseable,
       (SELECT count(*) FROM silver_copies WHERE rn > 1) AS duplicates, (SELECT count(*) FROM silver) AS rows_out,
       (SELECT count(*) FROM typed WHERE event_type = 'order_placed' AND (quantity IS NULL OR unit_price IS NULL)) AS amounts_lost""",
        "empty_steps": _sql(
            [*_TO_FACT, _REJECTED],
            "SELECT (SELECT count(*) FROM fact) AS clean_facts, CAST(0 AS BIGINT) AS clean_summary_rows, "
            "(SELECT count(*) FROM rejected) AS dirty_quarantined, CAST(0 AS BIGINT) AS dirty_silver_rows, "
            "CAST(0 AS BIGINT) AS dirty_steps_built",
        ),
        "reject_rate_alarm": _sql([_JUDGED], "").rstrip() + _RATE_ALARM,
        "freshness_alarm": _sql(_TO_TYPED, "").rstrip() + _FRESHNESS_ALARM,
    }
    lines = {
        "order_lines_ingest_counters": _sql(
            [_JUDGED],
            "SELECT count(*) AS received, count(*) FILTER (reject_reason IS NULL) AS valid, "
            f"count(reject_reason) AS quarantined, {_REASON_COLUMNS} FROM judged",
            "lines",
        ),
        "order_lines_silver": _sql(_TO_SILVER, silver, "lines"),
        "order_lines_daily_revenue": _sql([*_TO_FACT, _DAYS, _DAILY], "SELECT * FROM daily ORDER BY day", "lines"),
        "order_lines_dim_customer": _sql([*_TO_SILVER, _CUSTOMERS], "SELECT * FROM customers", "lines"),
        "order_lines_dim_product": _sql([*_TO_SILVER, _PRODUCTS], "SELECT * FROM products", "lines"),
        "order_lines_stage_metrics": _sql(
            [*_TO_FACT, _CUSTOMERS, _PRODUCTS, _REJECTED, _SUMMARY], _STAGE_METRICS, "lines"
        ),
    }
    return queries | lines
