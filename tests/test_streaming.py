"""Stamped text, buffers bounded in bytes, and alarms on the running stream."""

import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

import lake_queries
from tests.test_validation import event
from tidemark import contract
from tidemark.operators import monitoring, silver, validation
from tidemark.plans.lakehouse import Lakehouse
from tidemark.sources import raw as raw_source
from tidemark.sources import samples
from tidemark.streaming import alarms
from tidemark.streaming.ingest import _packed, start_buffered_ingest

START = dt.datetime(2026, 7, 31, 12, 0, 0)


def arrivals(spark, rows):
    """(payload, minutes after START) as raw rows."""
    stamped = [(value, START + dt.timedelta(minutes=m)) for value, m in rows]
    return spark.createDataFrame(stamped, "value string, arrived_at timestamp")


def land(df, path):
    raw_source.stamped_lines(df).coalesce(1).write.mode("append").text(path)


def at(minute, **more):
    moment = START + dt.timedelta(minutes=minute)
    return event(event_timestamp=moment.strftime("%Y-%m-%dT%H:%M:%SZ"), **more)


def answered(spark, tmp_path, alarm, files, delay, between=None):
    """Rows an alarm gives over files that land one by one, with a restart after the first."""
    landing, out, offsets = (str(tmp_path / n) for n in ("landing", "out", "offsets"))
    for k, rows in enumerate(files):
        land(arrivals(spark, rows), landing)
        if k in (0, len(files) - 1):
            stream = raw_source.stream_raw(spark, landing, 1, stamped=True, heartbeats=True)
            query = alarm(stream, delay).writeStream.outputMode("append").format("parquet").option("path", out)
            query.option("checkpointLocation", offsets).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


def test_stamped_lines_come_back_as_they_were(spark, tmp_path):
    rows = [("a\tb", 0), ("", 1), ("no stamp at all", 2), (None, 3)]
    land(arrivals(spark, rows), str(tmp_path / "in"))
    (tmp_path / "in" / "plain.txt").write_text("12x\tbad stamp\nplain\n")
    now = F.lit("2026-01-01").cast("timestamp")
    got = raw_source.read_raw(spark, str(tmp_path / "in"), now, stamped=True, heartbeats=True).collect()
    expected = [(v, START + dt.timedelta(minutes=m)) for v, m in rows]
    expected += [("12x\tbad stamp", dt.datetime(2026, 1, 1)), ("plain", dt.datetime(2026, 1, 1))]
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    assert raw_source.read_raw(spark, str(tmp_path / "in"), now, stamped=True).count() == 5


def test_reject_rate_alarm_of_the_stream_equals_the_batch(spark, tmp_path):
    good = lambda m: (at(m, event_id=f"{m:08d}"), m)
    files = [
        [good(1), ("junk", 2), good(12)],
        [("junk", 6), ("junk", 7), good(3), ("junk", 13)],  # earlier periods, within the delay
        [("junk", 16), good(31), ("junk", 36), ("junk", 44)],
        [(None, 200)],
    ]
    got = answered(spark, tmp_path, alarms.reject_rate_alarm_stream, files, "30 minutes")
    judged = validation.judge(arrivals(spark, [r for f in files for r in f if r[0] is not None]))
    expected = monitoring.reject_rate_alarm(monitoring.reject_rate_windows(judged))
    assert sorted(got.select(expected.columns).collect()) == sorted(expected.collect())
    in_alarm = sorted((r.period_start - START).seconds // 60 for r in got.where("in_alarm").collect())
    assert in_alarm == [5, 10, 15, 40]


def test_freshness_alarm_of_the_stream_equals_the_batch_and_goes_on(spark, tmp_path):
    files = [
        [(at(10, event_id="aaaa0001"), 11), (at(-3000, event_id="aaaa0002"), 20)],
        [(at(5, event_id="aaaa0003"), 65), ("junk", 130), (at(190, event_id="aaaa0006", event_type="product_viewed"), 190)],
        [(at(-5000, event_id="aaaa0004"), 60 * 30), (at(60, event_id="aaaa0005"), 60 * 5 + 1)],
        [(None, 60 * 33)],  # nothing arrives, but time passes
    ]
    got = answered(spark, tmp_path, alarms.freshness_alarm_stream, files, "26 hours")
    rows = [r for f in files[:2] for r in f] + files[2]
    judged = validation.judge(arrivals(spark, rows))
    expected = monitoring.freshness_alarm(monitoring.freshness_points(silver.typed(validation.valid_events(judged))))
    closed = [r for r in expected.collect() if r.period_start < START + dt.timedelta(hours=7)]
    assert sorted(got.select(expected.columns).collect(), key=lambda r: r.period_start) == closed

    land(arrivals(spark, [(None, 60 * 60)]), str(tmp_path / "landing"))
    got = answered(spark, tmp_path, alarms.freshness_alarm_stream, [[(None, 60 * 60 + 1)]], "26 hours")
    answers = {(r.period_start - START).total_seconds() / 3600: (r.max_lag_seconds, r.breaching) for r in got.collect()}
    assert sorted(answers) == list(range(34))  # each hour once, up to the watermark, timers included
    assert answers[30][1] and answers[30][0] == 29 * 3600.0 and all(answers[h] == (None, True) for h in (2, 3, 4, 31, 32, 33))


def test_batches_stay_below_the_bytes_given(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for k in range(7):
        (landing / f"{k}.txt").write_text("".join(event(event_id=f"{k:04d}{i:04d}") + "\n" for i in range(10)))
    size = (landing / "0.txt").stat().st_size
    lake, sizes = Lakehouse(spark, str(tmp_path / "lake")), []
    query = start_buffered_ingest(
        spark, str(landing), lake, str(tmp_path / "offsets"), max_bytes=int(2.5 * size),
        on_batch=lambda _, c: sizes.append(c["received"]), trigger={"availableNow": True},
    )
    query.awaitTermination()
    assert sum(sizes) == lake.bronze().count() == 70
    assert len(sizes) >= 4 and max(sizes) <= 20
    assert (contract.BUFFER_BYTES, contract.BUFFER_SECONDS) == (5 * 2**20, 60)


def landed_files(folder, count, rows=10):
    folder.mkdir()
    for k in range(count):
        good = [event(event_id=f"{k:04d}{i:04d}") for i in range(rows - 1)]
        (folder / f"{k}.txt").write_text("\n".join([*good, "junk"]) + "\n")
    return (folder / "0.txt").stat().st_size


def buffered(spark, tmp_path, lake, max_bytes, **more):
    started = start_buffered_ingest(
        spark, str(tmp_path / "landing"), lake, str(tmp_path / "offsets"), max_bytes=max_bytes, trigger={"availableNow": True}, **more
    )
    started.awaitTermination()


def test_a_backlog_is_stored_as_many_bounded_batches_in_few_triggers(spark, tmp_path):
    size = landed_files(tmp_path / "landing", 7)
    lake, sizes = Lakehouse(spark, str(tmp_path / "lake")), {}
    buffered(spark, tmp_path, lake, int(2.5 * size), on_batch=lambda label, c: sizes.update({label: c["received"]}))
    assert sorted(sizes.values()) == [10, 20, 20, 20]
    assert [p.name for p in (tmp_path / "offsets/commits").iterdir() if p.name.isdigit()] == ["0"]
    segments = lake.segments()
    assert segments.open_batches() == sorted(sizes)
    assert all(segments.counters_of(label)["received"] == n for label, n in sizes.items())
    assert (lake.bronze().count(), lake.quarantine().count()) == (63, 7)
    assert lake.update_silver()["rows_out"] == 63


def test_a_group_that_failed_between_its_sinks_is_stored_once(spark, tmp_path, monkeypatch):
    size = landed_files(tmp_path / "landing", 5)
    lake = Lakehouse(spark, str(tmp_path / "lake"))

    def gone(*_):
        raise OSError("drill")

    with monkeypatch.context() as drill:
        drill.setattr("tidemark.sinks.writers.write_bronze_batches", gone)
        with pytest.raises(StreamingQueryException):
            buffered(spark, tmp_path, lake, size)
    assert lake.segments().open_batches() == [] and lake.quarantine().count() == 5
    # Batches that were judged keep their labels, whatever the bound is now.
    buffered(spark, tmp_path, lake, 10 * size)
    labels = lake.segments().open_batches()
    assert len(labels) == 5 and (lake.bronze().count(), lake.quarantine().count()) == (45, 5)

    group = labels[0].rpartition(".")[0]
    assert lake.compact() == 5
    lake.vacuum()
    assert not list((tmp_path / "lake/_batches").iterdir())
    again = lake.ingest_group(spark.createDataFrame([], "value string, arrived_at timestamp, batch string"), group)
    assert sorted(again) == labels and {c["valid"] for c in again.values()} == {9}
    assert lake.segments().counters_of(labels[3])["quarantined"] == 1
    assert (lake.bronze().count(), lake.quarantine().count()) == (45, 5)


def test_files_are_packed_up_to_the_bound():
    assert _packed({"b": 3, "a": 3, "c": 9, "d": 1, "e": 0}, 6) == {"a": 0, "b": 0, "c": 1, "d": 2, "e": 2}


def test_payloads_of_a_small_file_are_made_on_all_cores(spark, tmp_path):
    spark.range(100).selectExpr(
        "id AS event_id", "timestamp_ntz '2026-07-01 00:00:00' AS ts", "id AS user_id", "'view' AS event_type", "1.5D AS value", "'{\"k\": 1}' AS props"
    ).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    payloads = samples.events_as_payloads(spark, str(tmp_path))
    assert payloads.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert payloads.where("value IS NOT NULL").count() == 102  # two have a second copy


@pytest.mark.parametrize("events", [60, 240])
def test_parts_land_in_several_files_and_give_the_alarm_of_single_ones(spark, tmp_path, monkeypatch, events):
    spark.range(events).selectExpr(
        "id AS event_id", f"timestamp_ntz '2026-07-01 00:00:00' + make_dt_interval(0, 0, 0, id * 2592000 / {events}) AS ts",
        "id AS user_id", "'purchase' AS event_type", "1.5D AS value", "'{\"k\": 1}' AS props",
    ).write.parquet(str(tmp_path / "events.parquet"))
    taken = []
    stream_raw = lake_queries.raw.stream_raw
    monkeypatch.setattr(
        lake_queries.raw, "stream_raw", lambda *a, max_files_per_trigger, **k: taken.append(max_files_per_trigger) or stream_raw(*a, max_files_per_trigger=max_files_per_trigger, **k)
    )
    single = sorted(lake_queries.freshness_alarm_stream(spark, str(tmp_path)).collect())
    monkeypatch.setattr(lake_queries, "LEAST_LINES", 20)
    several = sorted(lake_queries.freshness_alarm_stream(spark, str(tmp_path)).collect())
    assert several == single and len(single) > 500
    assert taken[0] == 1 and (taken[-1] > 1) == (events == 240)
