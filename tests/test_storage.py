"""Writing, reading back, replaying, failing, streaming, declaring tables."""

import datetime as dt
import gzip
import json
import uuid

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.test_validation import CASES, ORDER, event
from tidemark import schemas
from tidemark.operators import monitoring, serving, silver, validation
from tidemark.plans import prepared
from tidemark.plans.lakehouse import Lakehouse
from tidemark.sinks import folders, writers
from tidemark.sources import raw as raw_source
from tidemark.sources import samples, tables
from tidemark.sources.catalog import TABLES
from tidemark.streaming.ingest import reject_rate_stream, start_ingest

PAYLOADS = [c[0] for c in CASES if "\n" not in c[0] and c[0]]


@pytest.fixture
def lake(spark, tmp_path):
    return Lakehouse(spark, str(tmp_path / "lake"))


def snapshot(lake):
    return sorted(map(str, lake.bronze().collect())), sorted(map(str, lake.quarantine().collect()))


def test_ingest_is_idempotent_per_batch(lake, raw):
    counters = lake.ingest(raw(*PAYLOADS), "b1")
    once = snapshot(lake)
    assert (len(once[0]), len(once[1])) == (counters["valid"], counters["quarantined"])
    assert counters["received"] == len(PAYLOADS)
    assert lake.ingest(raw(*PAYLOADS), "b1") == counters
    assert snapshot(lake) == once
    lake.ingest(raw(*PAYLOADS), "b2")
    assert snapshot(lake) == (sorted(once[0] * 2), sorted(once[1] * 2))


def records(folder):
    return [json.loads(line) for f in sorted(folder.glob("*.gz")) for line in gzip.open(f).read().splitlines()]


def test_stored_format(lake, raw, tmp_path):
    lake.ingest(raw(event(), "junk"), "b1")
    open_ = tmp_path / "lake/open"
    assert [set(r) for r in records(open_ / "quarantine/batch=b1")] == [{"reject_reason", "reject_detail", "rejected_at", "raw_payload"}]
    assert [r["customer_id"] for r in records(open_ / "bronze/batch=b1")] == [ORDER["customer_id"]]
    lake.compact()
    (bronze,) = (tmp_path / "lake/bronze/ingest_date=2026-07-31").iterdir()
    (rejects,) = (tmp_path / "lake/quarantine/reject_reason=invalid_json/ingest_date=2026-07-31").iterdir()
    assert bronze.name.startswith("segment=") and rejects.name == bronze.name
    assert [set(r) for r in records(rejects)] == [{"reject_detail", "rejected_at", "raw_payload"}]
    assert [r["customer_id"] for r in records(bronze)] == [ORDER["customer_id"]]


def test_failed_quarantine_write_stores_nothing_and_raises(lake, raw, monkeypatch):
    def broken(*_):
        raise OSError("disk gone")

    monkeypatch.setattr(writers, "write_quarantine", broken)
    with pytest.raises(OSError):
        lake.ingest(raw(event(), "junk"), "b1")
    assert snapshot(lake) == ([], [])


def test_a_repeated_batch_is_stored_once_whatever_the_clock(spark, lake, raw):
    near_limit = event(event_timestamp="2026-07-31T12:05:10Z")  # 310 s ahead at first, valid a day later
    first = lake.ingest(raw(event(), near_limit, "junk"), "it's b1")
    later = dt.datetime(2026, 8, 1, 12, 0, 5)
    assert lake.ingest(raw(event(), near_limit, "junk", now=later), "it's b1") == first
    assert (first["received"], first["valid"], first["future_timestamp"]) == (3, 1, 1)
    assert lake.bronze().count() == 1 and lake.quarantine().count() == 2


def test_a_failed_batch_keeps_its_clock(spark, lake, raw, monkeypatch):
    working = writers.write_bronze
    monkeypatch.setattr(writers, "write_bronze", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        lake.ingest(raw(event(), "junk"), "b1")
    monkeypatch.setattr(writers, "write_bronze", working)
    lake.ingest(raw(event(), "junk", now=dt.datetime(2026, 8, 1, 0, 0, 5)), "b1")
    assert [r.ingest_date for r in lake.bronze().collect()] == ["2026-07-31"]
    assert [r.ingest_date for r in lake.quarantine().collect()] == ["2026-07-31"]


def test_accepted_spellings_reach_silver_and_counters_reconcile(lake, raw):
    times = ["2026-07-31T10:00Z", "20260731T100000", "2026-W31-5T10:00:00", "2026-07-31x10:00:00Z", "2026-07-31T15:30:00.5+05:30"]
    amounts = [("3000000000", "1.5"), ('"1_000"', '"3_0"'), ("true", "2"), ("2.9", "1e1")]
    odd = [event(event_id=f"aaaa000{i}", event_timestamp=t) for i, t in enumerate(times)]
    lines = [
        event(event_id=f"bbbb000{i}").replace('"quantity": 2', f'"quantity": {q}').replace('"unit_price": 9.99', f'"unit_price": {p}')
        for i, (q, p) in enumerate(amounts)
    ]
    lake.ingest(raw(*odd, *lines), "b1")
    counted = lake.build_silver()
    # A quantity beyond the column is NULL in silver, and counted.
    assert counted == {"rows_in": 9, "unparseable": 0, "rows_out": 9, "duplicates": 0, "amounts_lost": 1}
    rows = {r.event_id: r for r in lake.silver().collect()}
    assert all(rows[f"aaaa000{i}"].event_timestamp.hour == 10 for i in range(5))
    assert (rows["bbbb0001"].quantity, rows["bbbb0001"].unit_price) == (1000, 30.0)
    assert (rows["bbbb0002"].quantity, rows["bbbb0003"].quantity, rows["bbbb0003"].unit_price) == (1, 2, 10.0)
    assert lake.build_gold()["freshness_lag_seconds"] is not None


def test_text_lines_end_at_line_feeds_alone(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_bytes(event().replace(",", ",\r", 1).encode() + b"\n")
    assert raw_source.read_raw(spark, str(tmp_path / "in")).count() == 1


def test_a_database_declared_over_another_lake_answers_from_it(spark, tmp_path, raw):
    for n in (1, 2):
        other = Lakehouse(spark, str(tmp_path / f"lake{n}"))
        other.ingest(raw(*[event(event_id=f"{i:08d}") for i in range(n)]), "b1")
        assert other.build_silver() and other.build_gold() and other.build_layouts()
        other.declare("moved")
        assert spark.table("moved.silver_events").count() == n


def test_empty_inputs_write_nothing(lake, raw):
    assert not lake.build_silver() and not lake.build_gold() and not lake.build_layouts()
    lake.ingest(raw("junk"), "b1")
    assert not lake.build_silver()
    assert lake.quarantine().count() == 1


def test_no_rejects_gives_an_empty_typed_summary(lake, raw):
    lake.ingest(raw(event()), "b1")
    assert lake.build_silver() and lake.build_gold()
    summary = lake.quarantine_summary()
    assert summary.isEmpty()
    assert summary.schema == schemas.QUARANTINE_SUMMARY


def test_full_build_layouts_and_catalog(spark, lake, raw):
    orders = [event(event_id=f"{i:08d}", event_timestamp=f"2026-07-{1 + i % 28:02d}T10:00:00.123456Z") for i in range(200)]
    lake.ingest(raw(*orders, "junk"), "b1")
    assert lake.build_silver() and lake.build_gold() and lake.build_layouts()
    stored = lake.silver()
    assert dict(stored.dtypes)["event_date"] == "string"
    for table in lake.layouts().values():
        assert table.exceptAll(stored).isEmpty() and stored.exceptAll(table).isEmpty()
        assert table.schema == schemas.SILVER

    lake.declare("shop")
    lake.declare("shop")  # declaring and registering again is fine
    counts = {t: spark.table(f"shop.{t}").count() for t in TABLES}
    assert counts["silver_events"] == counts["bench_raw_json"] == counts["bench_parquet_part"] == 200
    assert (counts["dim_date"], counts["quarantine_summary"]) == (28, 1)
    assert len(spark.sql("SHOW PARTITIONS shop.fact_orders").collect()) == 28
    by_sql = spark.sql(
        """SELECT d.full_date AS day, d.day_name, d.is_weekend, count(*) AS order_lines,
               round(sum(f.gross_amount), 2) AS revenue, round(avg(f.gross_amount), 2) AS avg_order_value
           FROM shop.fact_orders f JOIN shop.dim_date d ON f.date_key = d.date_key
           GROUP BY d.full_date, d.day_name, d.is_weekend ORDER BY d.full_date"""
    )
    assert by_sql.collect() == serving.daily_revenue(lake.fact_orders(), lake.dim_date()).collect()


def test_partitioned_layout_reads_one_day(spark, lake, raw):
    lake.ingest(raw(event(), event(event_id="bbbbbbbb", event_timestamp="2026-07-30T10:00:00Z")), "b1")
    lake.build_silver()
    plan = serving.date_filtered(lake.silver(), "2026-07-30")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(event_date" in scan and "2026-07-30" in scan
    assert "ReadSchema: struct<event_type:string,gross_amount:double>" in scan


def test_hot_day_is_split_by_the_rebalance(spark, tmp_path):
    events = spark.range(200_000).selectExpr(
        "sha2(cast(id AS string), 256) AS event_id", "if(id % 3 < 2, '2026-07-31', '2026-07-30') AS event_date"
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1MB")
    try:
        writers.write_by_date(events, str(tmp_path / "t"))
    finally:
        spark.conf.set(key, before)
    files = {d: len(list((tmp_path / "t" / f"event_date=2026-07-{d}").glob("*.parquet"))) for d in (30, 31)}
    assert files[31] > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200_000


def bytes_read(df):
    """Input bytes of a query's stages."""
    sc = df.sparkSession.sparkContext
    group = uuid.uuid4().hex
    sc.setJobGroup(group, group)
    rows = df.collect()
    sc.setLocalProperty("spark.jobGroup.id", None)
    stages = {s for job in sc.statusTracker().getJobIdsForGroup(group) for s in sc.statusTracker().getJobInfo(job).stageIds}
    return rows, sum(sc._jsc.sc().statusStore().lastStageAttempt(s).inputBytes() for s in stages)


def test_clustered_layout_reads_less_for_a_day_and_an_id(spark, tmp_path):
    events = spark.range(300_000).selectExpr(
        "sha2(cast(id AS string), 256) AS event_id", "concat('t', id % 5) AS event_type", "sha2(cast(-id AS string), 256) AS payload",
        "if(id % 3 = 0, '2026-07-31', date_format(date_add(DATE '2026-07-01', cast(id * 7919 % 30 AS int)), 'yyyy-MM-dd')) AS event_date",
    )
    writers.write_table(events, str(tmp_path / "flat"))
    writers.write_clustered(events, str(tmp_path / "clustered"))
    # Vectored reads run in threads whose bytes the stage does not count.
    plain = spark.read.option("parquet.hadoop.vectored.io.enabled", "false")
    flat, clustered = (plain.parquet(str(tmp_path / name)) for name in ("flat", "clustered"))
    assert clustered.exceptAll(flat).isEmpty() and flat.exceptAll(clustered).isEmpty()
    seen = {}
    for name, condition in (("day", "event_date = '2026-07-09'"), ("id", f"event_id = '{'5' * 64}'")):
        (rows, all_bytes), (same, few_bytes) = (bytes_read(t.where(condition).select("event_id", "payload")) for t in (flat, clustered))
        assert sorted(rows) == sorted(same)
        seen[name] = (all_bytes, few_bytes)
    assert all(few * 3 < every for every, few in seen.values()), seen


def test_clustered_layout_holds_silver(lake, raw):
    assert lake.ingest(raw("junk"), "b0") and not lake.build_clustered() and lake.clustered().isEmpty()
    lake.ingest(raw(*[event(event_id=f"{i:08d}") for i in range(50)]), "b1")
    lake.build_silver()
    assert lake.build_clustered()
    assert lake.clustered().exceptAll(lake.silver()).isEmpty() and lake.clustered().count() == 50


def land(path, name, payloads):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(payloads) + "\n", encoding="utf-8")


def test_stream_equals_batch_and_restarts_where_it_stopped(spark, lake, tmp_path):
    landing, now = tmp_path / "landing", F.expr("TIMESTAMP '2026-07-31 12:00:00'")
    seen = []

    def run():
        stream = raw_source.stream_raw(spark, str(landing), max_files_per_trigger=1, now=now)
        query = start_ingest(
            stream, lake, str(tmp_path / "offsets"), on_batch=lambda label, c: seen.append((label, c["received"])),
            trigger={"availableNow": True},
        )
        query.awaitTermination()

    land(landing, "1.txt", PAYLOADS[::2])
    land(landing, "2.txt", PAYLOADS[1::2])
    run()
    batch = Lakehouse(spark, str(tmp_path / "batch"))
    batch.ingest(raw_source.read_raw(spark, str(landing), now=now), "all")
    assert snapshot(lake) == snapshot(batch)
    assert sum(n for _, n in seen) == len(PAYLOADS) and len({label for label, _ in seen}) == 2

    land(landing, "3.txt", [event(event_id="cccccccc")])
    run()
    assert len(seen) == 3 and len({label for label, _ in seen}) == 3
    assert lake.bronze().where("event_id = 'cccccccc'").count() == 1


def test_failed_batch_is_replayed_without_loss_or_duplicates(spark, lake, tmp_path, monkeypatch):
    landing = tmp_path / "landing"
    land(landing, "1.txt", PAYLOADS)

    def run():
        query = start_ingest(
            raw_source.stream_raw(spark, str(landing)), lake, str(tmp_path / "offsets"), trigger={"availableNow": True}
        )
        query.awaitTermination()

    working = writers.write_bronze
    monkeypatch.setattr(writers, "write_bronze", lambda *_: 1 / 0)
    with pytest.raises(StreamingQueryException):
        run()
    rejected = sorted(map(str, lake.quarantine().collect()))
    assert rejected and lake.bronze().isEmpty()  # rejects are durable first

    monkeypatch.setattr(writers, "write_bronze", working)
    run()
    bronze, again = snapshot(lake)
    assert again == rejected  # same files, same clock: the replay replaced them
    assert len(bronze) + len(again) == len(PAYLOADS)


def test_reject_rate_stream_emits_closed_windows(spark, tmp_path):
    source = tmp_path / "arrivals"
    stamps = ["12:00:10", "12:01:00", "12:06:00", "12:30:00"]
    rows = [(event() if i != 1 else "junk", f"2026-07-31 {s}") for i, s in enumerate(stamps)]
    spark.createDataFrame(rows, "value string, t string").selectExpr(
        "value", "cast(t AS timestamp) AS arrived_at"
    ).coalesce(1).write.parquet(str(source))
    stream = spark.readStream.schema("value string, arrived_at timestamp").parquet(str(source))
    query = (
        reject_rate_stream(stream, "1 minute").writeStream.outputMode("append").format("memory").queryName("rates")
        .option("checkpointLocation", str(tmp_path / "offsets")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    emitted = spark.table("rates").orderBy("period_start")
    assert [(r.period_start.minute, r.received, r.rejected) for r in emitted.collect()] == [(0, 2, 1), (5, 1, 0)]
    assert monitoring.reject_rate_alarm(emitted).where("breaching").count() == 1


def test_missing_tables_are_empty_but_other_errors_surface(spark, lake, tmp_path):
    assert lake.quarantine().isEmpty() and lake.bronze().isEmpty()
    assert lake.quarantine().columns[0] == "reject_reason" and lake.bronze().columns[-1] == "ingest_date"
    with pytest.raises(Exception):
        tables.read_open(spark, str(tmp_path / "none"), schemas.BRONZE, "_validated_at").count()
    (tmp_path / "lake/open/bronze/batch=x").mkdir(parents=True)
    (tmp_path / "lake/open/bronze/batch=x/part.json.gz").write_bytes(b"not gzip")
    with pytest.raises(Exception):
        lake.bronze().count()


def test_order_lines_are_stored_before_silver_reads_them(spark, tmp_path, monkeypatch):
    spark.sql("SELECT id AS o_orderkey, id AS o_custkey, timestamp_ntz '2026-07-01 00:00:00' AS o_orderdate FROM range(20)").write.parquet(
        str(tmp_path / "orders.parquet")
    )
    spark.sql(
        "SELECT id % 20 AS l_orderkey, id % 7 AS l_partkey, cast(id % 2 AS int) AS l_linenumber, 2D AS l_quantity, 1.5D AS l_extendedprice, "
        "timestamp_ntz '2026-07-01 00:00:00' + make_interval(0, 0, 0, cast(id % 3 - 1 AS int)) AS l_shipdate FROM range(60)"
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    written = []
    write_table = prepared.writers.write_table
    monkeypatch.setattr(prepared.writers, "write_table", lambda df, path: written.append((path, df.inputFiles())) or write_table(df, path))
    got = prepared.order_line_events(spark, str(tmp_path))
    judged = validation.judge(samples.order_lines_as_payloads(spark, str(tmp_path)))
    expected = silver.silver(validation.valid_events(judged))
    assert sorted(got.collect()) == sorted(expected.select(got.columns).collect()) and 0 < got.count() < 60
    (bronze_path, _), (_, read) = written
    assert read and all(bronze_path.rsplit("/", 1)[-1] in file for file in read)
    assert not folders.exists(spark, bronze_path)
