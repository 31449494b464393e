"""Silver, star schema, serving and alarms on small hand-made tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import monitoring, serving, silver, star

COLUMNS = schemas.BRONZE.names


def bronze(spark, *rows):
    defaults = dict.fromkeys(COLUMNS) | {
        "event_id": "aaaaaaaa",
        "event_type": "order_placed",
        "event_timestamp": "2026-07-31T10:00:00Z",
        "customer_id": "cust-1",
        "product_id": "toys-1",
        "order_id": "ord-1",
        "quantity": "2",
        "unit_price": "9.99",
        "_validated_at": "2026-07-31T10:05:00+00:00",
        "_is_late_arrival": False,
    }
    return spark.createDataFrame([tuple((defaults | r)[c] for c in COLUMNS) for r in rows], schemas.BRONZE)


def utc(*parts):
    return dt.datetime(*parts)


def test_uncastable_values_become_null_not_errors(spark):
    rows = bronze(
        spark,
        {"event_id": "a", "quantity": "many", "unit_price": "x", "_is_late_arrival": None},
        {"event_id": "b", "quantity": "3.7", "unit_price": "1e2"},
        {"event_id": "c", "event_timestamp": "nope"},
    )
    out = {r.event_id: r for r in silver.silver(rows).collect()}
    assert set(out) == {"a", "b"}
    assert (out["a"].quantity, out["a"].unit_price, out["a"].gross_amount, out["a"].is_late_arrival) == (None, None, None, False)
    assert (out["b"].quantity, out["b"].gross_amount) == (3, 300.0)


def test_silver_schema_and_own_event_date(spark):
    out = silver.silver(bronze(spark, {"event_timestamp": "2026-08-01T01:00:00+05:00", "event_date": "2026-08-01"}))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in schemas.SILVER]
    assert out.first().event_date == "2026-07-31"


def test_gross_amount_only_for_orders(spark):
    rows = bronze(spark, {"event_id": "a", "event_type": "cart_abandoned"}, {"event_id": "b"})
    assert {r.event_id: r.gross_amount for r in silver.silver(rows).collect()} == {"a": None, "b": 19.98}


def test_latest_validated_copy_wins(spark):
    rows = bronze(
        spark,
        {"unit_price": "1", "_validated_at": "2026-07-31T10:05:00+00:00"},
        {"unit_price": "2", "_validated_at": "2026-07-31T11:05:00+00:00"},
        {"unit_price": "3", "_validated_at": None},
        {"event_id": "bbbbbbbb", "unit_price": "4", "event_timestamp": "2026-07-31T10:00:00Z"},
        {"event_id": "bbbbbbbb", "unit_price": "5", "event_timestamp": "2026-07-31T10:00:01Z"},
    )
    assert {r.event_id: r.unit_price for r in silver.silver(rows).collect()} == {"aaaaaaaa": 2.0, "bbbbbbbb": 5.0}


def test_dedupe_trims_before_the_shuffle(spark):
    plan = silver.latest_copy(silver.dated(silver.typed(bronze(spark, {}))))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_text_that_is_no_time_stays_in_bronze_and_is_counted(spark):
    rows = bronze(spark, {"event_id": "a", "event_timestamp": "31 July, morning"}, {"event_id": "b"})
    assert [r.event_id for r in silver.silver(rows).collect()] == ["b"]
    assert silver.silver_counters(rows).first().unparseable == 1


def test_hot_key_keeps_one_row(spark):
    copies = spark.range(30_000).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id AS string)) AS event_id", "cast(id AS string) AS unit_price"
    )
    rows = copies.select(
        *[
            F.col(c) if c in copies.columns else F.lit(v).alias(c)
            for c, v in bronze(spark, {}).first().asDict().items()
        ]
    ).withColumn("_is_late_arrival", F.lit(False))
    out = silver.silver(rows)
    assert out.count() == 20_001
    assert out.where("event_id = 'hot'").first().unit_price == 29_997.0


def test_counters_reconcile(spark):
    rows = bronze(
        spark,
        {"event_id": "a"},
        {"event_id": "a"},
        {"event_id": "b", "event_timestamp": "x"},
        {"event_id": "c"},
        {"event_id": "c", "event_timestamp": "x"},
    )
    assert silver.silver_counters(rows).first().asDict() == {
        "rows_in": 5, "unparseable": 2, "rows_out": 2, "duplicates": 1,
    }
    assert silver.silver_counters(rows.limit(0)).first().rows_in == 0


@pytest.fixture(scope="module")
def events(spark):
    rows = bronze(
        spark,
        {"event_id": "a", "quantity": "1", "unit_price": "10.00", "event_timestamp": "2026-07-31T10:00:00Z"},
        {"event_id": "b", "quantity": "1", "unit_price": "10.01", "event_timestamp": "2026-07-31T11:00:00Z",
         "_is_late_arrival": True},
        {"event_id": "c", "event_type": "product_viewed", "unit_price": None, "quantity": None, "customer_id": "cust-2",
         "event_timestamp": "2026-08-01T10:00:00Z", "product_id": "nodash"},
        {"event_id": "d", "event_timestamp": "2026-08-03T10:00:00Z", "quantity": "3", "unit_price": "5",
         "product_id": "home-2", "order_id": None},
    )
    return silver.silver(rows).persist()


def test_dimensions(events):
    customers = {r.customer_id: r for r in star.dim_customer(events).collect()}
    assert (customers["cust-1"].total_events, customers["cust-1"].total_orders) == (3, 3)
    assert (customers["cust-2"].total_events, customers["cust-2"].total_orders) == (1, 0)
    assert customers["cust-1"].last_seen_at == utc(2026, 8, 3, 10)
    products = {r.product_id: r for r in star.dim_product(events).collect()}
    assert (products["toys-1"].category, products["toys-1"].avg_unit_price, products["toys-1"].times_ordered) == ("toys", 10.01, 2)
    assert (products["nodash"].category, products["nodash"].avg_unit_price, products["nodash"].times_viewed) == ("nodash", None, 1)


def test_dim_date_is_dense(events):
    days = star.dim_date(events).orderBy("date_key").collect()
    assert [d.date_key for d in days] == [20260731, 20260801, 20260802, 20260803]
    assert [(d.day_name, d.day_of_week, d.is_weekend) for d in days] == [
        ("Friday", 6, False), ("Saturday", 7, True), ("Sunday", 1, True), ("Monday", 2, False),
    ]
    assert star.dim_date(events.limit(0)).count() == 0


def test_gold_schemas_match_their_declaration(events):
    for table, schema in [
        (star.fact_orders(events), schemas.FACT_ORDERS),
        (star.dim_customer(events), schemas.DIM_CUSTOMER),
        (star.dim_product(events), schemas.DIM_PRODUCT),
        (star.dim_date(events), schemas.DIM_DATE),
    ]:
        assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in schema]


def test_fact_keys_resolve(events):
    fact = star.fact_orders(events)
    assert fact.count() == 3
    assert fact.join(star.dim_customer(events), "customer_key", "left_anti").isEmpty()
    assert fact.join(star.dim_product(events), "product_key", "left_anti").isEmpty()
    assert fact.join(star.dim_date(events), "date_key", "left_anti").isEmpty()


def test_keys_are_stable_hashes(events):
    import hashlib

    fact = {r.order_id: r for r in star.fact_orders(events).where("gross_amount <> 10.01").collect()}
    assert fact["ord-1"].order_key == hashlib.sha256(b"ord-1|toys-1").hexdigest()[:16]
    assert fact[None].order_key == hashlib.sha256(b"home-2").hexdigest()[:16]
    assert fact["ord-1"].customer_key == hashlib.sha256(b"cust|cust-1").hexdigest()[:16]


def test_daily_revenue_skips_days_without_orders(events):
    daily = serving.daily_revenue(star.fact_orders(events), star.dim_date(events))
    assert [(r.day.isoformat(), r.order_lines, r.revenue, r.avg_order_value) for r in daily.collect()] == [
        ("2026-07-31", 2, 20.01, 10.01), ("2026-08-03", 1, 15.0, 15.0),
    ]
    assert serving.revenue_totals(daily).first().asDict() == {"revenue": 35.01, "order_lines": 3, "days": 2}
    assert serving.revenue_totals(daily.limit(0)).first().asDict() == {"revenue": 0.0, "order_lines": 0, "days": 0}


def quarantine(spark, *rows):
    return spark.createDataFrame(rows, "reject_reason string, ingest_date string, rejected_at string, reject_detail string, raw_payload string")


def test_quarantine_summary_and_shares(spark):
    table = quarantine(
        spark,
        ("invalid_json", "2026-07-31", "t1", "z", "p"),
        ("invalid_json", "2026-07-31", "t2", "a", "p"),
        ("invalid_json", "2026-08-01", "t3", None, "p"),
        ("made_up", "2026-07-31", "t0", "d", "p"),
    )
    summary = star.quarantine_summary(table)
    assert "raw_payload" not in summary.columns
    assert [tuple(r) for r in summary.collect()] == [
        ("invalid_json", "2026-07-31", 2, "t2", "a"),
        ("invalid_json", "2026-08-01", 1, "t3", None),
        ("made_up", "2026-07-31", 1, "t0", "d"),
    ]
    assert [tuple(r) for r in serving.quarantine_by_reason(summary).collect()] == [
        ("invalid_json", "Payload was not parseable JSON", 3, "t3", 75.0), ("made_up", "made_up", 1, "t0", 25.0),
    ]


def test_stage_metrics(spark, events):
    summary = star.quarantine_summary(quarantine(spark, ("invalid_json", "2026-07-31", "t", "d", "p")))
    tables = star.fact_orders(events), star.dim_customer(events), star.dim_product(events)
    row = serving.stage_metrics(*tables, summary).first().asDict()
    assert row == {
        "gold_fact_rows": 3, "gold_customers": 2, "gold_products": 3, "quarantined_rows": 1, "late_arrivals": 1,
        "total_valid_events": 4, "gross_revenue": 35.01, "total_generated_events": 5, "quarantine_rate_pct": 20.0,
    }
    empty = serving.stage_metrics(*[t.limit(0) for t in tables], summary.limit(0)).first()
    assert (empty.gold_fact_rows, empty.gross_revenue, empty.quarantine_rate_pct) == (0, 0.0, 0.0)


@pytest.mark.parametrize(
    "as_of, lag, health",
    [
        ("2026-08-03 16:00:00", 21600, "fresh"),
        ("2026-08-03 16:00:01", 21601, "lagging"),
        ("2026-08-04 10:00:00", 86400, "lagging"),
        ("2026-08-04 10:00:01", 86401, "stale"),
        ("2026-08-03 09:59:00", -60, "fresh"),
    ],
)
def test_freshness(events, as_of, lag, health):
    clock = F.lit(as_of).cast("timestamp")
    row = serving.freshness(star.fact_orders(events), clock).first()
    assert (row.lag_seconds, row.health, row.distinct_days) == (lag, health, 2)
    assert star.freshness_lag(star.fact_orders(events), clock).first().lag_seconds == max(lag, 0)


def test_freshness_without_facts(events):
    none = star.fact_orders(events).limit(0)
    assert serving.freshness(none, F.current_timestamp()).first().health == "fresh"
    assert star.freshness_lag(none, F.current_timestamp()).isEmpty()


def test_layout_queries(events):
    assert serving.narrow_projection(events).first().total_revenue == pytest.approx(35.01)
    assert [tuple(r) for r in serving.date_filtered(events, "2026-08-01").collect()] == [("product_viewed", 1, None)]
    assert [(r.event_type, r.n) for r in serving.full_groupby(events).collect()] == [("order_placed", 3), ("product_viewed", 1)]
    assert tuple(serving.pivot_date(events).first()) == ("2026-07-31", 2)


def test_late_events_stay_on_their_day(events):
    assert {r.event_date: (r.events, r.late_events) for r in serving.late_arrivals(events).collect()} == {
        "2026-07-31": (2, 1), "2026-08-01": (1, 0), "2026-08-03": (1, 0),
    }


def test_reject_rate_alarm_needs_consecutive_periods(spark):
    def period(minute, bad, good):
        return [(f"2026-07-31 10:{minute:02d}:30", "invalid_json")] * bad + [(f"2026-07-31 10:{minute:02d}:30", None)] * good

    rows = period(0, 1, 9) + period(5, 1, 9) + period(10, 1, 19) + period(15, 1, 9) + period(25, 1, 9) + period(30, 2, 0)
    judged = spark.createDataFrame(rows, "t string, reject_reason string").selectExpr(
        "cast(t AS timestamp) AS arrived_at", "reject_reason"
    )
    alarms = monitoring.reject_rate_alarm(monitoring.reject_rate_windows(judged)).orderBy("period_start").collect()
    assert [(r.period_start.minute, r.breaching, r.in_alarm) for r in alarms] == [
        (0, True, False), (5, True, True), (10, False, False), (15, True, False), (25, True, False), (30, True, True),
    ]
    assert [r.reject_rate_pct for r in alarms][:3] == [10.0, 10.0, 5.0]


def test_missing_hours_breach_the_freshness_alarm(spark):
    points = spark.sql(
        """SELECT cast(t AS timestamp) AS observed_at, lag AS lag_seconds FROM VALUES
        ('2026-07-31 10:10:00', 10.0D), ('2026-07-31 10:50:00', 86400.0D), ('2026-07-31 12:00:00', 86400.5D),
        ('2026-07-31 13:59:59', 0.0D) AS v(t, lag)"""
    )
    alarm = monitoring.freshness_alarm(points).orderBy("period_start").collect()
    assert [(r.period_start.hour, r.max_lag_seconds, r.breaching) for r in alarm] == [
        (10, 86400.0, False), (11, None, True), (12, 86400.5, True), (13, 0.0, False),
    ]
