"""The stored lakehouse: raw batches in, bronze, quarantine, silver, gold and layouts out.

Each step reads what the step before it stored, so a lost executor costs a task and a failed
step can be run again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.operators import silver as silver_ops
from tidemark.operators import star, validation
from tidemark.plans import ledger
from tidemark.plans.compaction import BATCH, COUNTERS, Segments
from tidemark.session import configure
from tidemark.sinks import folders, writers
from tidemark.sources import catalog, tables

_BATCH_VERDICTS = T.StructType([*schemas.VERDICTS.fields, T.StructField("batch", T.StringType())])
_APPLIED = T.StructType([T.StructField("unit", T.StringType())])
_UPDATE = T.StructType([T.StructField(n, T.StringType()) for n in ("update", "unit", "day")])


@dataclass
class Lakehouse:
    spark: SparkSession
    root: str

    def __post_init__(self) -> None:
        configure(self.spark)

    # -- locations ---------------------------------------------------------------------

    def segments(self, spark: SparkSession | None = None) -> Segments:
        """Stored batches, open and compacted; a stream brings its own session."""
        return Segments(spark or self.spark, self.root)

    @property
    def silver_path(self) -> str:
        return f"{self.root}/silver"

    def gold_path(self, table: str) -> str:
        return f"{self.root}/gold/{table}"

    def layout_path(self, layout: str) -> str:
        return f"{self.root}/bench/{layout}"

    # -- steps -------------------------------------------------------------------------

    def ingest(self, raw: DataFrame, batch: str) -> dict[str, int]:
        """Validate one batch and store it, once; returns its counters.

        The label stands for the batch. Its payloads are judged a single time: the verdicts are
        stored first, counted by that very write, and both sinks are fed from them. If a write
        fails, the caller sees the error and repeats the batch under its label; the repeat takes the
        stored verdicts, with their clock, so it replaces the same files. A batch that is complete,
        compacted or not, is left alone. Rejects are stored before valid rows.
        """
        spark = configure(raw.sparkSession)  # a stream hands over its own session
        stored = self.segments(spark)
        counters = stored.counters_of(batch)
        if counters is not None:
            return counters
        own = stored.batch_path(batch)
        judged_mark = ledger.stored(spark, f"{own}/judged", BATCH)
        if judged_mark is None:
            seen = Observation()
            rows = validation.verdict_rows(validation.judge(raw)).observe(seen, *validation.counter_columns())
            rows.write.mode("overwrite").parquet(f"{own}/verdicts")
            counters = {n: seen.get[n] for n in COUNTERS}
            # Only a whole set of verdicts counts.
            ledger.store(spark, f"{own}/judged", BATCH, [(batch, *counters.values())])
        else:
            counters = {n: judged_mark.first()[n] for n in COUNTERS}
        judged = spark.read.schema(schemas.VERDICTS).parquet(f"{own}/verdicts")
        self._store_rejects(stored, judged, batch)
        self._store_valid(stored, judged, batch)
        ledger.store(spark, f"{own}/counters", BATCH, [(batch, *counters.values())])
        folders.remove(spark, f"{own}/verdicts")  # they have served
        return counters

    def ingest_group(self, raw: DataFrame, group: str) -> dict[str, dict[str, int]]:
        """Validate and store several batches in one pass, once; returns the counters of each.

        The column ``batch`` has the label of a row's batch, from ``Segments.label_in``. All that holds for
        ``ingest`` holds here: a repeat takes the stored verdicts, which keep their labels, and replaces the
        same files. The batches are complete together, with one mark of the group.
        """
        spark = configure(raw.sparkSession)
        stored = self.segments(spark)
        done = stored.counters_of_group(group)
        if done:
            return done
        own = stored.group_path(group)
        judged_mark = ledger.stored(spark, f"{own}/judged", BATCH)
        if judged_mark is None:
            rows = validation.verdict_rows(validation.judge(raw, "batch"), "batch")
            rows.write.mode("overwrite").parquet(f"{own}/verdicts")
        judged = spark.read.schema(_BATCH_VERDICTS).parquet(f"{own}/verdicts")
        if judged_mark is None:
            counted = judged.groupBy("batch").agg(*validation.counter_columns()).select("batch", *COUNTERS)
            ledger.store(spark, f"{own}/judged", BATCH, [tuple(r) for r in counted.collect()])  # a row a batch
            judged_mark = ledger.stored(spark, f"{own}/judged", BATCH)
        marks = [tuple(r) for r in judged_mark.select("batch", *COUNTERS).collect()]
        rejects = judged.where("reject_reason IS NOT NULL").drop("line")
        writers.write_quarantine_batches(rejects, stored.open_path("quarantine"))
        lines = judged.where("reject_reason IS NULL").select(F.col("line").alias("value"), "batch")
        writers.write_bronze_batches(lines, stored.open_path("bronze"))
        ledger.store(spark, f"{own}/counters", BATCH, marks)
        folders.remove(spark, f"{own}/verdicts")
        return {label: dict(zip(COUNTERS, counted)) for label, *counted in sorted(marks)}

    def _store_rejects(self, stored: Segments, judged: DataFrame, batch: str) -> None:
        rejects = judged.where("reject_reason IS NOT NULL").drop("line")
        writers.write_quarantine(rejects, stored.open_path("quarantine", batch))

    def _store_valid(self, stored: Segments, judged: DataFrame, batch: str) -> None:
        lines = judged.where("reject_reason IS NULL").select(F.col("line").alias("value"))
        writers.write_bronze(lines, stored.open_path("bronze", batch))

    def compact(self) -> int:
        """Open batches become one segment by day; ``vacuum`` then removes their folders."""
        return self.segments().compact()

    def compact_days(self, before: str) -> int:
        """Earlier days with several segments get one."""
        return self.segments().compact_days(before)

    def vacuum(self) -> None:
        """Remove folders that a compaction replaced, once no reader of the state before it is left."""
        self.segments().vacuum()

    def build_silver(self) -> dict[str, int]:
        """Full rebuild from bronze; without bronze rows nothing is written.

        Returns rows_in = unparseable + duplicates + rows_out, and how many copies had an amount that
        fits no column and is NULL in silver; counted by the write itself.
        """
        applied = self._units()
        bronze = self.bronze()
        if bronze.isEmpty():
            return {}
        seen, written = Observation(), Observation()
        typed = silver_ops.typed(bronze.withColumn("_lost", silver_ops.amount_lost()), "_lost").observe(
            seen, F.count("*").alias("rows_in"), F.count_if(F.col("event_timestamp").isNull()).alias("unparseable"),
            F.count_if("_lost").alias("amounts_lost"),
        ).drop("_lost")
        latest = silver_ops.latest_copy(silver_ops.dated(typed)).select(*silver_ops.STORED_COLUMNS)
        writers.write_by_date(latest.observe(written, F.count("*").alias("rows_out")), self.silver_path)
        folders.remove(self.spark, f"{self.root}/_silver")
        self._mark_applied(applied)
        counted = seen.get | written.get
        return counted | {"duplicates": counted["rows_in"] - counted["unparseable"] - counted["rows_out"]}

    # -- silver, batch by batch ----------------------------------------------------------

    def _units(self) -> list[str]:
        """What bronze is made of: open batches, and segments."""
        stored = self.segments()
        return [f"batch={b}" for b in stored.open_batches()] + [f"segment={s}" for s in stored.segment_batches()]

    def _applied(self) -> set[str]:
        rows = ledger.stored(self.spark, f"{self.root}/_silver/applied/*", _APPLIED)
        return set() if rows is None else {r["unit"] for r in rows.collect()}

    def _mark_applied(self, units: list[str], update: str = "full") -> None:
        if units:
            ledger.store(self.spark, f"{self.root}/_silver/applied/{update}", _APPLIED, [(u,) for u in units])

    def _unapplied(self) -> list[str]:
        """Units silver has not seen. A segment of batches that it has all seen is none."""
        done = self._applied()
        took = self.segments().segment_batches()
        known = lambda unit: unit in done or (
            unit.startswith("segment=") and all(f"batch={b}" in done for b in took[unit.removeprefix("segment=")])
        )
        return [u for u in self._units() if not known(u)]

    def update_silver(self) -> dict[str, int | list[str]]:
        """Bring silver up to date with batches it has not seen; only days that change are written.

        The copies of new batches meet the stored copies of the same events. Where a new one wins, its
        day is written anew, and so is the day the displaced copy was on. The days are first written
        beside silver and marked, then published; an update that died is published by the next one.
        A batch applied twice changes nothing.
        """
        if not folders.exists(self.spark, self.silver_path):
            return self.build_silver() | {"days": []}
        self._publish()
        units = self._unapplied()
        if not units:
            return {"batches": 0, "rows_in": 0, "changed": 0, "days": []}
        update = uuid.uuid4().hex
        staged = f"{self.root}/_silver/updates/{update}"
        split = lambda kind: [u.removeprefix(kind) for u in units if u.startswith(kind)]
        seen = Observation()
        rows = silver_ops.typed(self.segments().bronze_of(split("batch="), split("segment="))).observe(seen, F.count("*").alias("rows_in"))
        fresh = silver_ops.latest_copy(silver_ops.dated(rows)).select(*silver_ops.STORED_COLUMNS)
        writers.write_table(fresh, f"{staged}/fresh")
        fresh = self.spark.read.schema(schemas.STORED_SILVER).parquet(f"{staged}/fresh")

        silver = self.spark.read.schema(schemas.STORED_SILVER).option("basePath", self.silver_path).parquet(self.silver_path)
        ids = fresh.select("event_id")
        held_days = [r[0] for r in silver.select("event_id", "event_date").join(ids, "event_id", "left_semi").select("event_date").distinct().collect()]
        held = silver.where(F.col("event_date").isin(*held_days)).join(ids, "event_id", "left_semi")
        both = held.withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1)))
        winners = silver_ops.latest_copy(both, F.col("_new")).where("_new = 1").drop("_new")
        won_rows = Observation()
        winners = winners.observe(won_rows, F.count("*").alias("changed"))
        writers.write_table(winners, f"{staged}/winners")  # an equal copy does not win
        winners = self.spark.read.schema(schemas.STORED_SILVER).parquet(f"{staged}/winners")
        won = winners.select("event_id")
        touched = winners.select("event_date").unionByName(held.join(won, "event_id", "left_semi").select("event_date"))
        days = sorted(r[0] for r in touched.distinct().collect())  # days, not rows
        kept = silver.where(F.col("event_date").isin(*days)).join(won, "event_id", "left_anti")
        writers.write_by_date(kept.unionByName(winners), f"{staged}/days")
        marks = [(update, u, None) for u in units] + [(update, None, d) for d in days]
        ledger.store(self.spark, f"{self.root}/_silver/pending", _UPDATE, marks)
        self._publish()
        return {"batches": len(units), **seen.get, **won_rows.get, "days": days}

    def _publish(self) -> None:
        """Put the days of a marked update in place of silver's; repeating it gives the same."""
        pending = ledger.stored(self.spark, f"{self.root}/_silver/pending", _UPDATE)
        if pending is None:
            return
        rows = pending.collect()  # its units and days
        update = rows[0]["update"]
        staged = f"{self.root}/_silver/updates/{update}"
        days = [r["day"] for r in rows if r["day"] is not None]
        there = {name.removeprefix("event_date=") for name in folders.names(self.spark, f"{staged}/days")}
        if there:
            ready = self.spark.read.schema(schemas.STORED_SILVER).option("basePath", f"{staged}/days").parquet(f"{staged}/days")
            writers.write_by_date(ready, self.silver_path, only_own_days=True)
        for day in set(days) - there:  # its last event moved to another day
            folders.remove(self.spark, f"{self.silver_path}/event_date={day}")
        self._mark_applied([r["unit"] for r in rows if r["unit"] is not None], update)
        folders.remove(self.spark, f"{self.root}/_silver/pending")
        folders.remove(self.spark, staged)

    def build_gold(self) -> dict[str, float | None]:
        """All gold tables; returns how far the newest fact trails the clock, and records it."""
        silver = self.silver()
        if silver.isEmpty():
            return {}
        writers.write_table(star.dim_customer(silver), self.gold_path("dim_customer"))
        writers.write_table(star.dim_product(silver), self.gold_path("dim_product"))
        writers.write_table(star.dim_date(silver), self.gold_path("dim_date"))
        writers.write_by_date(star.fact_orders(silver), self.gold_path("fact_orders"))
        writers.write_table(star.quarantine_summary(self.quarantine()), self.gold_path("quarantine_summary"))
        now = F.current_timestamp()
        lag = star.freshness_lag(self.fact_orders(), now).select(now.alias("recorded_at"), "lag_seconds").first()
        if lag is None:
            return {"freshness_lag_seconds": None}
        point = self.spark.createDataFrame([tuple(lag)], schemas.FRESHNESS)
        point.write.mode("append").parquet(self.gold_path("freshness"))
        return {"freshness_lag_seconds": lag["lag_seconds"]}

    def build_layouts(self) -> bool:
        """The stored silver rows in three physical layouts."""
        silver = self.silver()
        if silver.isEmpty():
            return False
        writers.write_raw_json_layout(silver, self.layout_path("raw_json"))
        writers.write_table(silver, self.layout_path("parquet_flat"))
        writers.write_by_date(silver, self.layout_path("parquet_part"))
        return True

    def build_clustered(self) -> bool:
        """The stored silver rows once more, flat and clustered: for days and ids without a folder a day."""
        silver = self.silver()
        if silver.isEmpty():
            return False
        writers.write_clustered(silver, self.layout_path("parquet_clustered"))
        return True

    def declare(self, database: str) -> None:
        catalog.declare_tables(self.spark, self.root, database)
        catalog.refresh(self.spark, database)

    def register_days(self, database: str, days: list[str]) -> None:
        """Tell the catalog of the silver days an update wrote or emptied, and of no others."""
        catalog.register_days(self.spark, database, "silver_events", self.silver_path, days)

    # -- tables ------------------------------------------------------------------------

    def bronze(self) -> DataFrame:
        return self.segments().bronze()

    def quarantine(self) -> DataFrame:
        return self.segments().quarantine()

    def silver(self) -> DataFrame:
        return tables.silver_or_empty(self.spark, self.silver_path)

    def fact_orders(self) -> DataFrame:
        return tables.read_parquet(self.spark, self.gold_path("fact_orders"), schemas.FACT_ORDERS)

    def dim_customer(self) -> DataFrame:
        return tables.read_parquet(self.spark, self.gold_path("dim_customer"), schemas.DIM_CUSTOMER)

    def dim_product(self) -> DataFrame:
        return tables.read_parquet(self.spark, self.gold_path("dim_product"), schemas.DIM_PRODUCT)

    def dim_date(self) -> DataFrame:
        return tables.read_parquet(self.spark, self.gold_path("dim_date"), schemas.DIM_DATE)

    def quarantine_summary(self) -> DataFrame:
        return tables.read_parquet(
            self.spark, self.gold_path("quarantine_summary"), schemas.QUARANTINE_SUMMARY
        )

    def clustered(self) -> DataFrame:
        return tables.silver_or_empty(self.spark, self.layout_path("parquet_clustered"))

    def layouts(self) -> dict[str, DataFrame]:
        return {
            "raw_json": tables.read_raw_json_layout(self.spark, self.layout_path("raw_json")),
            "parquet_flat": tables.read_silver(self.spark, self.layout_path("parquet_flat")),
            "parquet_part": tables.read_silver(self.spark, self.layout_path("parquet_part")),
        }
