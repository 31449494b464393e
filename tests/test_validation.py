"""Every reject reason, every boundary, and the shape of what is stored."""

import json

import pytest

from tidemark import contract
from tidemark import schemas
from tidemark.operators import validation

ORDER = {
    "event_id": "0123abcd-ef",
    "event_type": "order_placed",
    "event_timestamp": "2026-07-31T11:59:00Z",
    "customer_id": "cust-000001",
    "product_id": "toys-00001",
    "category": "toys",
    "order_id": "ord-1",
    "quantity": 2,
    "unit_price": 9.99,
}
VIEW = {k: ORDER[k] for k in ("event_id", "event_timestamp", "customer_id", "product_id")} | {
    "event_type": "product_viewed"
}
DROP = object()


def event(base=ORDER, **changes):
    merged = {k: v for k, v in (base | changes).items() if v is not DROP}
    return json.dumps(merged)


def text(raw_json_value, field, base=ORDER):
    """An event with one field replaced by literal JSON text."""
    return event(base, **{field: "@@"}).replace('"@@"', raw_json_value)


CASES = [
    # payload, reason, detail
    (event(), None, None),
    ("", "invalid_json", "payload is not exactly one JSON value"),
    ("not json", "invalid_json", "payload is not exactly one JSON value"),
    (event()[:-5], "invalid_json", "payload is not exactly one JSON value"),
    (event() + " junk", "invalid_json", "payload is not exactly one JSON value"),
    (event() + "] junk", "invalid_json", "payload is not exactly one JSON value"),
    (event() + "," + event(), "invalid_json", "payload is not exactly one JSON value"),
    (event() + "} junk", "invalid_json", "payload is not exactly one JSON value"),
    ("﻿" + event(), None, None),
    ("  " + event() + " \t", None, None),
    (event()[:-1] + ', "quantity": 3}', None, None),
    ("[" + event() + "]", "not_an_object", "list"),
    ('"text"', "not_an_object", "str"),
    ("12", "not_an_object", "int"),
    ("-1.5", "not_an_object", "float"),
    ("1e5", "not_an_object", "float"),
    ("true", "not_an_object", "bool"),
    (" null", "not_an_object", "NoneType"),
    ("{}", "missing_required_field", "event_id,event_type,event_timestamp,customer_id"),
    (event(customer_id=DROP), "missing_required_field", "customer_id"),
    (event(customer_id=None, event_id=""), "missing_required_field", "event_id,customer_id"),
    (event(customer_id=0), None, None),
    (event(customer_id=False), None, None),
    (event(event_type="wishlist_added"), "unknown_event_type", "wishlist_added"),
    (event(event_type="x" * 100), "unknown_event_type", "x" * 100),
    (event(event_type=7), "unknown_event_type", "7"),
    (event(event_type=["order_placed"]), "unknown_event_type", '["order_placed"]'),
    (event(unit_price=DROP, order_id=""), "missing_type_specific_field", "order_placed:order_id,unit_price"),
    (
        event(VIEW, event_type="cart_abandoned", product_id=None),
        "missing_type_specific_field",
        "cart_abandoned:cart_id,product_id",
    ),
    (event(VIEW, product_id=DROP), "missing_type_specific_field", "product_viewed:product_id"),
    (
        event(VIEW, event_type="payment_failed"),
        "missing_type_specific_field",
        "payment_failed:order_id,failure_code",
    ),
    (event(VIEW, event_type="payment_failed", order_id="o", failure_code="f", product_id=DROP), None, None),
    (event(event_id="1234567"), "malformed_event_id", "1234567"),
    (event(event_id="12345678"), None, None),
    (event(event_id="a" * 36), None, None),
    (event(event_id="a" * 37), "malformed_event_id", "a" * 37),
    (event(event_id="xyz-xyz-xyz"), "malformed_event_id", "xyz-xyz-xyz"),
    (event(event_id=12345678), None, None),
    (event(event_id=12345678.0), "malformed_event_id", "12345678.0"),
    (event(event_id=True), "malformed_event_id", "True"),
    (event(event_id="abcdef12\n"), None, None),
    (event(event_id="abcdef12\n\n"), "malformed_event_id", "abcdef12\n\n"),
    (event(event_timestamp=1700000000), "bad_timestamp_type", "expected string, got int"),
    (event(event_timestamp=1.5), "bad_timestamp_type", "expected string, got float"),
    (event(event_timestamp=True), "bad_timestamp_type", "expected string, got bool"),
    (event(event_timestamp=["2026-07-31"]), "bad_timestamp_type", "expected string, got list"),
    (event(event_timestamp={"a": 1}), "bad_timestamp_type", "expected string, got dict"),
    (event(event_timestamp="not-a-date"), "unparseable_timestamp", "not-a-date"),
    (event(event_timestamp="2026-13-45T99:99:99Z"), "unparseable_timestamp", "2026-13-45T99:99:99Z"),
    (event(event_timestamp="0000-00-00"), "unparseable_timestamp", "0000-00-00"),
    (event(event_timestamp="2026-02-29T00:00:00Z"), "unparseable_timestamp", "2026-02-29T00:00:00Z"),
    (event(event_timestamp="T10:11:12"), "unparseable_timestamp", "T10:11:12"),
    (event(event_timestamp="2026"), "unparseable_timestamp", "2026"),
    (event(event_timestamp="20260731T101112"), None, None),
    (event(event_timestamp="2026-W01-1"), None, None),
    (event(event_timestamp="2026-07-31 11:00:00"), None, None),
    (event(event_timestamp="1950-01-01"), None, None),
    (event(event_timestamp="2026-07-31T12:05:00Z"), None, None),
    (event(event_timestamp="2026-07-31T12:05:00.000001Z"), "future_timestamp", "2026-07-31T12:05:00.000001+00:00"),
    (event(event_timestamp="2026-07-31T17:36:00+05:30"), "future_timestamp", "2026-07-31T17:36:00+05:30"),
    (event(event_timestamp="2026-07-31T17:35:00+05:30"), None, None),
    (event(quantity="abc"), "non_numeric_amount", "qty=abc price=9.99"),
    (event(quantity="3.7"), "non_numeric_amount", "qty=3.7 price=9.99"),
    (event(quantity=[1]), "non_numeric_amount", "qty=[1] price=9.99"),
    (event(unit_price="free", quantity=5.5), "non_numeric_amount", "qty=5.5 price=free"),
    (event(unit_price=[], quantity=True), "non_numeric_amount", "qty=True price=[]"),
    (event(unit_price="nan"), "non_numeric_amount", "qty=2 price=nan"),
    (event(quantity=" 5 ", unit_price="1_0.5e1"), None, None),
    (event(quantity=3.7), None, None),
    (event(quantity=True, unit_price=False), None, None),
    (text("1" * 60, "quantity"), None, None),
    (event(quantity=0), "non_positive_quantity", "0"),
    (event(quantity=0.9), "non_positive_quantity", "0"),
    (event(quantity=-0.9), "non_positive_quantity", "0"),
    (event(quantity="-007"), "non_positive_quantity", "-7"),
    (event(quantity=-3), "non_positive_quantity", "-3"),
    (event(quantity=False), "non_positive_quantity", "0"),
    (event(unit_price=0), None, None),
    (event(unit_price=-0.01), "negative_price", "-0.01"),
    (event(unit_price=-5), "negative_price", "-5.0"),
    (event(unit_price="-2e16"), "negative_price", "-2e+16"),
    (event(unit_price=-12345678.5), "negative_price", "-12345678.5"),
    (event(VIEW, quantity="many", unit_price=-1), None, None),
]


@pytest.fixture(scope="module")
def verdicts(spark):
    rows = [(i, case[0]) for i, case in enumerate(CASES)]
    raw = spark.createDataFrame(rows, "i int, value string").selectExpr(
        "value", "TIMESTAMP '2026-07-31 12:00:00' AS arrived_at"
    )
    judged = validation.judge(raw)
    rejected = {r.raw_payload: (r.reject_reason, r.reject_detail) for r in validation.rejects(judged).collect()}
    return {row.value: rejected.get(row.value, (row.reject_reason, None)) for row in judged.collect()}


@pytest.mark.parametrize("payload, reason, detail", CASES, ids=range(len(CASES)))
def test_verdict(verdicts, payload, reason, detail):
    assert verdicts[payload] == (reason, detail)


def test_every_reason_is_covered():
    assert {c[1] for c in CASES} - {None} == set(contract.REJECT_REASONS)
    assert len(contract.REJECT_REASONS) == 12


def test_counters_conserve_rows(raw):
    judged = validation.judge(raw(*[c[0] for c in CASES]))
    row = validation.ingest_counters(judged).first().asDict()
    assert row["received"] == len(CASES) == row["valid"] + row["quarantined"]
    assert row["quarantined"] == sum(row[r] for r in contract.REJECT_REASONS)
    per_reason = {r.reject_reason: r.n for r in validation.reject_counts(judged).collect()}
    assert per_reason == {r: row[r] for r in contract.REJECT_REASONS if row[r]}


@pytest.mark.parametrize(
    "timestamp, late, date",
    [
        ("2026-07-31T11:00:00Z", False, "2026-07-31"),
        ("2026-07-31T10:59:59.999999Z", True, "2026-07-31"),
        ("2026-08-01T01:30:00+14:00", False, "2026-08-01"),
        ("2026-07-31T11:30:00", False, "2026-07-31"),
        ("1999-12-31T23:00:00-05:00", True, "1999-12-31"),
    ],
)
def test_enrichment(raw, timestamp, late, date):
    row = validation.valid_events(validation.judge(raw(event(event_timestamp=timestamp)))).first()
    assert (row._is_late_arrival, row.event_date) == (late, date)
    assert (row._validated_at, row.ingest_date) == ("2026-07-31T12:00:00+00:00", "2026-07-31")


def test_rejects_keep_the_payload_up_to_its_limit(raw):
    long = "x" * 5000
    row = validation.rejects(validation.judge(raw(long))).first()
    assert row.raw_payload == long
    assert (row.rejected_at, row.ingest_date) == ("2026-07-31T12:00:00+00:00", "2026-07-31")


def test_undecodable_bytes_are_replaced_and_kept(spark):
    raw = spark.sql("SELECT cast(X'7B22FF227D' AS string) AS value, TIMESTAMP '2026-07-31 12:00:00' AS arrived_at")
    row = validation.rejects(validation.judge(raw)).first()
    assert (row.reject_reason, row.raw_payload) == ("invalid_json", '{"�"}')


def test_bronze_lines_keep_unknown_fields_and_stay_one_line(raw):
    pretty = json.dumps({**ORDER, "extra": {"a": [1]}}, indent=1)
    line = validation.bronze_lines(validation.judge(raw("﻿" + pretty))).first().value
    assert "\n" not in line
    assert json.loads(line) == {
        **ORDER,
        "extra": {"a": [1]},
        "event_date": "2026-07-31",
        "_validated_at": "2026-07-31T12:00:00+00:00",
        "_is_late_arrival": False,
    }


def test_valid_events_equal_the_stored_lines(spark, raw, tmp_path):
    from tidemark.sinks import writers
    from tidemark.sources import tables

    payloads = [c[0] for c in CASES if c[1] is None] + [event(unit_price=112.0), event(unit_price=3.70)]
    judged = validation.judge(raw(*payloads))
    writers.write_bronze(validation.bronze_lines(judged), str(tmp_path / "open" / "batch=b"))
    stored = tables.read_open(spark, str(tmp_path / "open"), schemas.BRONZE, "_validated_at").drop("batch")
    direct = validation.valid_events(judged).select(*stored.columns)
    assert sorted(map(str, stored.collect())) == sorted(map(str, direct.collect()))


def test_filters_do_not_repeat_the_parse(raw):
    judged = validation.judge(raw(event()))
    for frame in (validation.valid_events(judged), validation.rejects(judged), validation.ingest_counters(judged)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1
