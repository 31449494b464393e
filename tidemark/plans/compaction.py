"""Compaction of bronze and quarantine: many small batches become a segment by day.

A batch lands in a folder of its own, whatever days and reasons it has, so that a micro-batch
costs two folders. Compaction gathers complete batches into ``ingest_date=…/segment=…`` and
``reject_reason=…/ingest_date=…/segment=…``, and later the segments of a closed day into one.

At most one compaction is under way, and its manifest says what it replaces:

1. *plan*: a segment's name and the batches, or the segments of days, that it takes;
2. the segment is written. Readers leave out a segment that is planned and not done;
3. *done*: the commit, one row. From here on readers take the segment and leave out what it replaced;
4. *vacuum* removes the replaced folders, then the manifest.

A compaction that died is taken up at its next step: the plan is written before anything else, so the
same segment is written over, from the same batches. The counters of a batch move into the segment's
ledger before its folder goes, so a replayed label is recognised for ever and stores nothing twice.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import contract, schemas
from tidemark.plans import ledger
from tidemark.sinks import folders, writers
from tidemark.sources import tables

COUNTERS = ("received", "valid", "quarantined", *contract.REJECT_REASONS)
#: A batch and its counters.
BATCH = T.StructType([T.StructField("batch", T.StringType()), *[T.StructField(n, T.LongType()) for n in COUNTERS]])
_PLAN = T.StructType([T.StructField(n, T.StringType()) for n in ("segment", "batch", "day", "replaced")])


class Plan(NamedTuple):
    """A compaction under way. ``pairs`` are (ingest day, segment) that it replaces."""

    segment: str
    batches: tuple[str, ...]
    pairs: tuple[tuple[str, str], ...]
    done: bool


class Segments:
    """The stored batches and segments below a lake's root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.manifest = f"{root}/_compaction"

    def bronze_path(self) -> str:
        return f"{self.root}/bronze"

    def quarantine_path(self) -> str:
        return f"{self.root}/quarantine"

    def batch_path(self, batch: str) -> str:
        """Marks of a batch: judged (its verdicts are whole), counters (it is complete)."""
        return f"{self.root}/_batches/{quote(batch, safe='')}"

    def group_path(self, group: str) -> str:
        """The same marks of batches that are stored together, a row each. No quoted name ends like it."""
        return f"{self.root}/_batches/{quote(group, safe='')}+"

    @staticmethod
    def label_in(group: str, number: int) -> str:
        """Label of a group's batch; the group's name has only letters, digits and ``_.-~``."""
        if quote(group, safe="") != group:
            raise ValueError(f"not a group's name: {group!r}")
        return f"{group}.{number:06d}"

    @staticmethod
    def _group_of(batch: str) -> str | None:
        group, _, number = batch.rpartition(".")
        return group if group and len(number) >= 6 and number.isdecimal() else None

    def open_path(self, side: str, batch: str | None = None) -> str:
        below = f"{self.root}/open/{side}"
        return below if batch is None else f"{below}/batch={quote(batch, safe='')}"

    # -- what is there -----------------------------------------------------------------

    def plan(self) -> Plan | None:
        rows = ledger.stored(self.spark, f"{self.manifest}/plan", _PLAN)
        if rows is None:
            return None
        rows = rows.collect()  # the batches of one compaction
        done = ledger.stored(self.spark, f"{self.manifest}/done", _PLAN)
        return Plan(
            rows[0]["segment"],
            tuple(r["batch"] for r in rows if r["batch"] is not None),
            tuple((r["day"], r["replaced"]) for r in rows if r["replaced"] is not None),
            done is not None and done.first()["segment"] == rows[0]["segment"],
        )

    def counters_of(self, batch: str) -> dict[str, int] | None:
        """Counters of a complete batch, open or compacted."""
        own = ledger.stored(self.spark, f"{self.batch_path(batch)}/counters", BATCH)
        if own is None and self._group_of(batch):
            own = ledger.stored(self.spark, f"{self.group_path(self._group_of(batch))}/counters", BATCH)
        if own is None:
            own = ledger.stored(self.spark, f"{self.root}/_segments", BATCH)
        row = None if own is None else own.where(F.col("batch") == batch).first()
        return None if row is None else {n: row[n] for n in COUNTERS}

    def begun(self, batch: str) -> bool:
        """Whether a batch of this very label is stored, or was begun and has to be repeated."""
        return folders.exists(self.spark, self.batch_path(batch)) or self.counters_of(batch) is not None

    def counters_of_group(self, group: str) -> dict[str, dict[str, int]]:
        """Counters of the batches of a complete group, open or compacted; none if it is not complete."""
        own = ledger.stored(self.spark, f"{self.group_path(group)}/counters", BATCH)
        if own is None:
            own = ledger.stored(self.spark, f"{self.root}/_segments", BATCH)
            own = None if own is None else own.where(F.col("batch").startswith(f"{group}."))
        rows = [] if own is None else own.orderBy("batch").collect()
        return {r["batch"]: {n: r[n] for n in COUNTERS} for r in rows if self._group_of(r["batch"]) == group}

    def open_batches(self) -> list[str]:
        """Complete batches that no committed segment has taken, by name."""
        found = ledger.stored(self.spark, f"{self.root}/_batches/*/counters", BATCH)
        plan = self.plan()
        taken = set(plan.batches) if plan and plan.done else set()
        return [] if found is None else sorted({r["batch"] for r in found.select("batch").collect()} - taken)

    def segment_batches(self) -> dict[str, list[str]]:
        """The batches each segment took; committed segments only."""
        schema = T.StructType([*BATCH.fields, T.StructField("segment", T.StringType())])
        rows = ledger.stored(self.spark, f"{self.root}/_segments", schema)
        out: dict[str, list[str]] = {}
        for r in [] if rows is None else rows.select("segment", "batch").distinct().collect():
            out.setdefault(r["segment"], []).append(r["batch"])
        return out

    # -- reading -----------------------------------------------------------------------

    def _current(self, stored: DataFrame) -> DataFrame:
        """Rows of segments that count; the filter is on partition columns."""
        plan = self.plan()
        if plan is None:
            return stored
        gone = [(F.col("ingest_date") == day) & (F.col("segment") == segment) for day, segment in plan.pairs]
        for hidden in gone if plan.done else [F.col("segment") == plan.segment]:
            stored = stored.where(~hidden)
        return stored

    def _still_open(self, stored: DataFrame) -> DataFrame:
        plan = self.plan()
        if plan is None or not plan.done or not plan.batches:
            return stored
        return stored.where(~F.col("batch").isin(*plan.batches))

    def bronze(self) -> DataFrame:
        """Accepted events of every batch, as (columns, ingest_date)."""
        columns = [*schemas.BRONZE.names, "ingest_date"]
        whole = self._current(tables.segments_or_empty(self.spark, self.bronze_path(), schemas.BRONZE, "ingest_date"))
        fresh = self._still_open(tables.open_or_empty(self.spark, self.open_path("bronze"), schemas.BRONZE, "_validated_at"))
        return whole.select(*columns).unionByName(fresh.select(*columns))

    def bronze_of(self, batches: list[str], segments: list[str]) -> DataFrame:
        """Accepted events of some open batches and some segments."""
        columns = [*schemas.BRONZE.names, "ingest_date"]
        whole = tables.segments_or_empty(self.spark, self.bronze_path(), schemas.BRONZE, "ingest_date")
        fresh = tables.open_or_empty(self.spark, self.open_path("bronze"), schemas.BRONZE, "_validated_at")
        return (
            self._current(whole).where(F.col("segment").isin(*segments)).select(*columns)
            .unionByName(fresh.where(F.col("batch").isin(*batches)).select(*columns))
        )

    def quarantine(self) -> DataFrame:
        columns = ["reject_reason", *schemas.QUARANTINE.names, "ingest_date"]
        whole = tables.segments_or_empty(self.spark, self.quarantine_path(), schemas.QUARANTINE, "reject_reason", "ingest_date")
        fresh = tables.open_or_empty(self.spark, self.open_path("quarantine"), schemas.REJECTS, "rejected_at")
        return self._current(whole).select(*columns).unionByName(self._still_open(fresh).select(*columns))

    # -- compaction --------------------------------------------------------------------

    def _begin(self, batches: list[str], pairs: list[tuple[str, str]]) -> None:
        name = uuid.uuid4().hex
        rows = [(name, b, None, None) for b in batches] + [(name, None, day, s) for day, s in pairs]
        ledger.store(self.spark, f"{self.manifest}/plan", _PLAN, rows)

    def _carry_out(self) -> None:
        """Write the planned segment and commit it."""
        plan = self.plan()
        if plan is None or plan.done:
            return
        chosen_batch = F.col("batch").isin(*plan.batches)
        pair = F.lit(False)
        for day, segment in plan.pairs:
            pair = pair | ((F.col("ingest_date") == day) & (F.col("segment") == segment))
        if plan.batches:
            lines = tables.open_lines(self.spark, self.open_path("bronze")).where(chosen_batch)
            rejects = tables.open_or_empty(self.spark, self.open_path("quarantine"), schemas.REJECTS, "rejected_at").where(chosen_batch)
        else:
            lines = tables.segment_lines(self.spark, self.bronze_path()).where(pair)
            rejects = tables.segments_or_empty(self.spark, self.quarantine_path(), schemas.QUARANTINE, "reject_reason", "ingest_date").where(pair)
        name = F.lit(plan.segment).alias("segment")
        writers.write_quarantine_segment(
            rejects.select("reject_reason", *schemas.QUARANTINE.names, "ingest_date", name), self.quarantine_path()
        )
        writers.write_bronze_segment(lines.select("value", "ingest_date", name), self.bronze_path())
        if plan.batches:
            stored = ledger.stored(self.spark, f"{self.root}/_batches/*/counters", BATCH)
            kept = stored.where(F.col("batch").isin(*plan.batches)).coalesce(1)
            kept.write.mode("overwrite").parquet(f"{self.root}/_segments/segment={plan.segment}")
        ledger.store(self.spark, f"{self.manifest}/done", _PLAN, [(plan.segment, None, None, None)])

    def vacuum(self) -> None:
        """Remove what a committed compaction replaced; run it when no reader of the state before is left."""
        plan = self.plan()
        if plan is None or not plan.done:
            return
        for batch in plan.batches:
            for path in (self.open_path("bronze", batch), self.open_path("quarantine", batch), self.batch_path(batch)):
                folders.remove(self.spark, path)
        for group in {self._group_of(b) for b in plan.batches} - {None}:
            folders.remove(self.spark, self.group_path(group))  # its batches were complete together
        for day, segment in plan.pairs:
            folders.remove(self.spark, f"{self.bronze_path()}/ingest_date={day}/segment={segment}")
            for reason in folders.names(self.spark, self.quarantine_path()):
                folders.remove(self.spark, f"{self.quarantine_path()}/{reason}/ingest_date={day}/segment={segment}")
        folders.remove(self.spark, self.manifest)

    def _finish_earlier(self) -> None:
        self._carry_out()
        self.vacuum()

    def compact(self) -> int:
        """All complete open batches become one segment; returns how many they were."""
        self._finish_earlier()
        batches = self.open_batches()
        if batches:
            self._begin(batches, [])
            self._carry_out()
        return len(batches)

    def compact_days(self, before: str) -> int:
        """Days before ``before`` that have several segments get one; returns how many folders' worth it replaced.

        Which segments a day has is read from the names of folders, not from rows.
        """
        self._finish_earlier()
        reasons = [f"{self.quarantine_path()}/{r}" for r in folders.names(self.spark, self.quarantine_path())]
        segments: dict[str, set[str]] = {}
        for side in [self.bronze_path(), *reasons]:
            for day in folders.names(self.spark, side):
                if day.startswith("ingest_date=") and day < f"ingest_date={before}":
                    found = segments.setdefault(day.removeprefix("ingest_date="), set())
                    found |= {s.removeprefix("segment=") for s in folders.names(self.spark, f"{side}/{day}")}
        pairs = [(day, s) for day, names in sorted(segments.items()) if len(names) > 1 for s in sorted(names)]
        if pairs:
            self._begin([], pairs)
            self._carry_out()
        return len(pairs)
