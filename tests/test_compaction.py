"""Compaction of batches into segments, and silver brought up to date batch by batch."""

import datetime as dt

import pytest

from tests.test_storage import PAYLOADS, snapshot
from tests.test_validation import event
from tidemark.plans import ledger
from tidemark.plans.compaction import Segments
from tidemark.plans.lakehouse import Lakehouse
from tidemark.sinks import folders, writers


@pytest.fixture
def lake(spark, tmp_path):
    return Lakehouse(spark, str(tmp_path / "lake"))


DAYS = [dt.datetime(2026, 7, 30, 23, 59), dt.datetime(2026, 7, 31, 12, 0)]


def fill(lake, raw, n=2):
    for k in range(n):
        lake.ingest(raw(*PAYLOADS, event(event_id=f"dddd{k:04d}"), now=DAYS[k % 2]), f"it's {k}/x")


def files(tmp_path, below):
    return sorted(str(p.relative_to(tmp_path)) for p in (tmp_path / "lake" / below).rglob("*.gz"))


def test_compaction_changes_where_rows_are_and_nothing_else(lake, raw, tmp_path):
    fill(lake, raw)
    before = snapshot(lake)
    assert lake.compact() == 2
    assert snapshot(lake) == before  # the replaced folders are still there, and left out
    assert files(tmp_path, "open")
    lake.vacuum()
    assert snapshot(lake) == before
    assert not files(tmp_path, "open") and not list((tmp_path / "lake/_batches").iterdir())
    assert all("/ingest_date=" in f and "/segment=" in f for f in files(tmp_path, "bronze") + files(tmp_path, "quarantine"))
    assert lake.compact() == 0


def test_a_replay_after_compaction_stores_nothing(lake, raw):
    fill(lake, raw, 2)
    first = lake.segments().counters_of("it's 0/x")
    for step in (lake.compact, lake.vacuum):
        step()
        before = snapshot(lake)
        assert lake.ingest(raw(*PAYLOADS, "more", now=DAYS[1]), "it's 0/x") == first
        assert snapshot(lake) == before
    lake.ingest(raw(event(event_id="eeee0000")), "new")
    assert lake.bronze().count() == len(before[0]) + 1 and lake.segments().open_batches() == ["new"]


@pytest.mark.parametrize("broken", ["write_bronze_segment", "done"])
def test_a_compaction_that_died_is_taken_up(lake, raw, tmp_path, monkeypatch, broken):
    fill(lake, raw)
    before = snapshot(lake)
    with monkeypatch.context() as patch:
        if broken.startswith("write"):
            patch.setattr(writers, broken, lambda *_: 1 / 0)
        else:
            kept = ledger.store
            patch.setattr(ledger, "store", lambda spark, path, *rest: 1 / 0 if path.endswith("/done") else kept(spark, path, *rest))
        with pytest.raises(ZeroDivisionError):
            lake.compact()
    assert snapshot(lake) == before  # what it wrote so far does not count
    lake.ingest(raw(event(event_id="eeee0001")), "meanwhile")
    more = snapshot(lake)
    assert lake.compact() == 1  # finishes the earlier one, then takes the batch that came in between
    assert snapshot(lake) == more
    lake.vacuum()
    assert snapshot(lake) == more and not files(tmp_path, "open")


def test_segments_of_closed_days_become_one(lake, raw, tmp_path):
    for k in range(4):
        lake.ingest(raw(*PAYLOADS[::9], event(event_timestamp="2026-07-30T10:00:00Z"), now=DAYS[k % 2]), f"b{k}")
        lake.compact()
    lake.vacuum()
    before = snapshot(lake)
    segments = lambda day: len(list((tmp_path / f"lake/bronze/ingest_date={day}").iterdir()))
    assert (segments("2026-07-30"), segments("2026-07-31")) == (2, 2)
    assert lake.compact_days(before="2026-07-31") == 2
    assert snapshot(lake) == before
    lake.vacuum()
    assert snapshot(lake) == before
    assert (segments("2026-07-30"), segments("2026-07-31")) == (1, 2)
    assert lake.ingest(raw("again"), "b0")["received"] == len(PAYLOADS[::9]) + 1


def test_the_manifest_names_folders_alone(lake, raw):
    fill(lake, raw, 1)
    lake.compact()
    plan = lake.segments().plan()
    assert plan.done and plan.batches == ("it's 0/x",) and plan.pairs == ()
    lake.vacuum()
    assert lake.segments().plan() is None
    assert list(lake.segments().segment_batches().values()) == [["it's 0/x"]]


# -- silver ------------------------------------------------------------------------------------------


def copy_of(event_id, day, price=9.99, **more):
    return event(event_id=event_id, event_timestamp=f"2026-07-{day:02d}T10:00:00Z", unit_price=price, **more)


def modified(tmp_path):
    return {str(p): p.stat().st_mtime_ns for p in (tmp_path / "lake/silver").rglob("*.parquet")}


def rebuilt(spark, lake, tmp_path):
    """Silver as a full build of the same bronze would have it."""
    from tidemark.operators import silver

    return sorted(map(str, silver.silver(lake.bronze()).collect()))


BATCHES = [
    [copy_of("aaaa0001", 10), copy_of("aaaa0002", 11), copy_of("aaaa0003", 12), copy_of("aaaa0004", 14)],
    # One price changes on its day, one event moves to another day and leaves its day empty, one is new.
    [copy_of("aaaa0001", 10, 5.0), copy_of("aaaa0002", 13), copy_of("aaaa0005", 12)],
    # An equal copy of an equal stamp changes nothing.
    [copy_of("aaaa0004", 14)],
]


@pytest.mark.parametrize("compacted", [False, True])
def test_batches_one_by_one_equal_a_full_build(spark, lake, raw, tmp_path, compacted):
    stamps = [DAYS[0], DAYS[1], DAYS[0]]
    touched = []
    for k, (payloads, now) in enumerate(zip(BATCHES, stamps)):
        lake.ingest(raw(*payloads, "junk", now=now), f"b{k}")
        if compacted:
            lake.compact()
            lake.vacuum()
        before = modified(tmp_path) if k else {}
        result = lake.update_silver()
        touched.append(result["days"])
        assert sorted(map(str, lake.silver().collect())) == rebuilt(spark, lake, tmp_path)
        same = {f: t for f, t in before.items() if not any(d in f for d in result["days"])}
        assert same.items() <= modified(tmp_path).items()
    assert touched == [[], ["2026-07-10", "2026-07-11", "2026-07-12", "2026-07-13"], []]
    assert not folders.exists(spark, f"{lake.silver_path}/event_date=2026-07-11")
    assert lake.update_silver() == {"batches": 0, "rows_in": 0, "changed": 0, "days": []}
    if not compacted:  # compacting what silver has seen is nothing new to it
        lake.compact()
        assert lake.update_silver()["batches"] == 0


def test_an_update_that_died_is_published_by_the_next(spark, lake, raw, tmp_path, monkeypatch):
    lake.ingest(raw(*BATCHES[0], now=DAYS[0]), "b0")
    lake.update_silver()
    lake.ingest(raw(*BATCHES[1], now=DAYS[1]), "b1")
    with monkeypatch.context() as patch:
        patch.setattr(Lakehouse, "_publish", lambda self: 1 / 0 if folders.exists(spark, f"{lake.root}/_silver/pending") else None)
        with pytest.raises(ZeroDivisionError):
            lake.update_silver()
    assert lake.silver().where("event_id = 'aaaa0005'").isEmpty()
    assert lake.update_silver()["batches"] == 0
    assert sorted(map(str, lake.silver().collect())) == rebuilt(spark, lake, tmp_path)


def test_a_full_build_counts_as_applied(lake, raw):
    lake.ingest(raw(*BATCHES[0], now=DAYS[0]), "b0")
    lake.build_silver()
    assert lake.update_silver()["batches"] == 0
    lake.ingest(raw(*BATCHES[1], now=DAYS[1]), "b1")
    assert lake.update_silver()["changed"] == 3


def test_only_touched_days_are_registered(spark, lake, raw):
    lake.ingest(raw(*BATCHES[0], now=DAYS[0]), "b0")
    lake.update_silver()
    lake.build_gold(), lake.build_layouts()
    lake.declare("daily")
    lake.ingest(raw(*BATCHES[1], now=DAYS[1]), "b1")
    lake.register_days("daily", lake.update_silver()["days"])
    days = {r[0].removeprefix("event_date=") for r in spark.sql("SHOW PARTITIONS daily.silver_events").collect()}
    assert days == {"2026-07-10", "2026-07-12", "2026-07-13", "2026-07-14"}
    assert spark.table("daily.silver_events").count() == lake.silver().count() == 5


def test_segments_know_nothing_of_an_empty_lake(spark, tmp_path):
    empty = Segments(spark, str(tmp_path / "none"))
    assert (empty.plan(), empty.open_batches(), empty.segment_batches(), empty.compact()) == (None, [], {}, 0)
    assert empty.compact_days("2030-01-01") == 0
