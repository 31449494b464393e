"""Registered queries that drive the stored lake: batches, compaction, updates, failures and streams."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import serving, silver, validation
from tidemark.plans.compaction import Segments
from tidemark.plans.lakehouse import Lakehouse
from tidemark.plans.prepared import lakehouse
from tidemark.session import configure, new_shared_path
from tidemark.sources import catalog, raw, samples
from tidemark.streaming import alarms
from tidemark.streaming.ingest import start_buffered_ingest, start_ingest

#: Of the alarm streams: how late an arrival may be, and when the closing heartbeat comes.
ALARM_DELAY_DAYS, HEARTBEAT_DAYS = 15, 30
#: Bytes a buffered batch may have in the query, and lines a landed file has at most.
BUFFER_BYTES, FILE_LINES = 1 << 20, 1000
BATCHES = 3
#: Files in which a part of an alarm's payloads lands at most, and lines a part has at least for each.
MOST_FILES, LEAST_LINES = 64, 4096

_lakes: dict[tuple[str, str, str], Lakehouse] = {}


def new_lake(spark: SparkSession, label: str) -> Lakehouse:
    return Lakehouse(configure(spark), new_shared_path(spark, label))


def both_sides(lake: Lakehouse) -> DataFrame:
    """Everything a lake has stored: accepted events and rejected payloads with their stamps."""
    accepted = lake.bronze().select(
        F.lit("bronze").alias("side"), F.col("event_id").alias("item"), F.col("_validated_at").alias("stamped_at")
    )
    rejected = lake.quarantine().select(
        F.col("reject_reason").alias("side"), F.col("raw_payload").alias("item"), F.col("rejected_at").alias("stamped_at")
    )
    return accepted.unionByName(rejected)


def _batches(spark: SparkSession, sf_dir: str) -> Iterator[tuple[str, DataFrame]]:
    """All payloads, dealt into batches by their text."""
    payloads = samples.events_as_payloads(configure(spark), sf_dir)
    for k in range(BATCHES):
        yield f"batch {k}", payloads.where(F.pmod(F.xxhash64("value"), F.lit(BATCHES)) == k)


# -- compaction -------------------------------------------------------------------------------------


def _compacted(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """Batches compacted after each but the first, one of them sent again after that, days merged at the end."""
    key = (spark.sparkContext.applicationId, sf_dir, "compacted")
    if key not in _lakes:
        lake, batches = new_lake(spark, "compacted"), list(_batches(spark, sf_dir))
        for k, (label, rows) in enumerate(batches):
            lake.ingest(rows, label)
            if k:
                lake.compact()
                lake.vacuum()
        lake.ingest(batches[0][1], batches[0][0])
        lake.compact_days(before="9999-12-31")
        lake.vacuum()
        left = Segments(spark, lake.root).open_batches()
        if left:
            raise AssertionError(f"batches are still open: {left}")
        _lakes[key] = lake
    return _lakes[key]


def compacted_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compacted(spark, sf_dir).bronze()


def compacted_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compacted(spark, sf_dir).quarantine()


# -- silver, batch by batch -------------------------------------------------------------------------


def _updated(spark: SparkSession, sf_dir: str) -> tuple[Lakehouse, str]:
    """Silver brought up to date after each batch, its days registered from what each update touched."""
    key = (spark.sparkContext.applicationId, sf_dir, "updated")
    database = "tidemark_daily_" + str(abs(hash(key)) % 10**9)
    if key not in _lakes:
        lake = new_lake(spark, "updated")
        for label, rows in _batches(spark, sf_dir):
            lake.ingest(rows, label)
            first = not spark.catalog.databaseExists(database)
            touched = lake.update_silver()
            if first:
                catalog.declare_tables(spark, lake.root, database)
                catalog.register_partitions(spark, database, "silver_events")
            else:
                lake.register_days(database, touched["days"])
        _lakes[key] = lake
    return _lakes[key], database


def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _updated(spark, sf_dir)[0].silver()


def catalog_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows a day, asked in SQL of the table whose partitions were registered update by update."""
    database = _updated(spark, sf_dir)[1]
    return spark.sql(f"SELECT event_date, count(*) AS events FROM {database}.silver_events GROUP BY event_date")


# -- streams ----------------------------------------------------------------------------------------


class _FailsBetweenSinks(Lakehouse):
    """Stores the rejects of its second batch, then fails once before the valid rows."""

    stored = 0

    def _store_valid(self, stored: Segments, judged: DataFrame, batch: str) -> None:
        type(self).stored += 1
        if type(self).stored == 2:
            raise OSError("drill: the second sink is gone")
        super()._store_valid(stored, judged, batch)


def _finished(query: StreamingQuery) -> None:
    query.awaitTermination()


def stream_text_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamped text files, one a trigger; one batch fails between its sinks and is replayed after a restart."""
    payloads = samples.events_as_payloads(configure(spark), sf_dir)
    landing, offsets = new_shared_path(spark, "landing"), new_shared_path(spark, "offsets")
    raw.stamped_lines(payloads).repartition(4).write.text(landing)
    failing = type("Drill", (_FailsBetweenSinks,), {"stored": 0})
    lake = failing(configure(spark), new_shared_path(spark, "replayed"))
    stream = raw.stream_raw(spark, landing, max_files_per_trigger=1, stamped=True)
    run = lambda: _finished(start_ingest(stream, lake, offsets, trigger={"availableNow": True}))
    try:
        run()
    except StreamingQueryException:
        run()
    else:
        raise AssertionError("the drill did not fail")
    return both_sides(lake)


def buffered_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files taken in batches bounded in bytes: what arrived, and how many batches broke the bound."""
    payloads = samples.events_as_payloads(configure(spark), sf_dir)
    landing = new_shared_path(spark, "landing")
    raw.stamped_lines(payloads).write.option("maxRecordsPerFile", FILE_LINES).text(landing)
    lake = new_lake(spark, "buffered")
    query = start_buffered_ingest(
        spark, landing, lake, new_shared_path(spark, "offsets"), max_bytes=BUFFER_BYTES, stamped=True, trigger={"availableNow": True}
    )
    query.awaitTermination()
    # The payloads of each stored batch; their stamps make the files a little larger.
    stored = lake.segments()
    accepted = spark.read.option("basePath", stored.open_path("bronze")).text(stored.open_path("bronze"))
    rejected = spark.read.schema("raw_payload string, batch string").json(stored.open_path("quarantine"))
    rows = accepted.select("batch", F.lit(0).alias("rejected"), F.octet_length("value").alias("n")).unionByName(
        rejected.select("batch", F.lit(1).alias("rejected"), F.octet_length("raw_payload").alias("n"))
    )
    per_batch = rows.groupBy("batch").agg(F.count("*").alias("c"), F.sum("rejected").alias("r"), F.sum("n").alias("bytes"))
    # Bronze lines carry three fields more than the payloads had.
    added = F.lit(2)
    return per_batch.agg(
        F.sum("c").alias("received"),
        F.sum("r").alias("quarantined"),
        F.count_if(F.col("bytes") > added * BUFFER_BYTES).alias("oversized_batches"),
        (F.count("*") > 1).alias("several_batches"),
    )


def _alarm(spark: SparkSession, sf_dir: str, alarm: Callable[[DataFrame, str], DataFrame], label: str) -> DataFrame:
    """An alarm over stamped text files that land out of order, with a restart half-way and a heartbeat at the end."""
    payloads = samples.events_as_payloads(configure(spark), sf_dir)
    landing, out, offsets = (new_shared_path(spark, f"{label}-{n}") for n in ("landing", "out", "offsets"))
    first, last = payloads.agg(F.min("arrived_at"), F.max("arrived_at")).first()
    span = (last - first) / 6
    part = F.least(F.floor((F.unix_micros("arrived_at") - F.unix_micros(F.lit(first))) / (span.total_seconds() * 1e6)), F.lit(5))
    # All parts are made in one pass over the payloads; a part then lands in as many files as cores can write.
    staged = new_shared_path(spark, f"{label}-staged")
    dealt = payloads.select(raw.stamped_line().alias("value"), part.alias("part")).where("part IS NOT NULL")
    dealt.write.partitionBy("part").text(staged)
    lines = spark.read.schema("value string, part int").option("basePath", staged).option("lineSep", "\n").text(staged)
    fewest = lines.groupBy("part").count().agg(F.min("count")).first()[0]
    # Every part has so many lines that each of its files gets some, so a trigger takes one whole part.
    files = max(1, min(2 * spark.sparkContext.defaultParallelism, MOST_FILES, fewest // LEAST_LINES))

    def land(*parts: int) -> None:
        for k in parts:
            own = lines.where(F.col("part") == k).select("value")
            (own.repartition(files) if files > 1 else own.coalesce(1)).write.mode("append").text(landing)

    def run() -> None:
        stream = raw.stream_raw(spark, landing, max_files_per_trigger=files, stamped=True, heartbeats=True)
        answers = alarm(stream, f"{ALARM_DELAY_DAYS} days").writeStream.outputMode("append").format("parquet")
        _finished(answers.option("path", out).option("checkpointLocation", offsets).trigger(availableNow=True).start())

    land(1, 0, 3)
    run()
    land(2, 5, 4)
    beat = spark.createDataFrame([(None, last + dt.timedelta(days=HEARTBEAT_DAYS))], "value string, arrived_at timestamp")
    raw.stamped_lines(beat).coalesce(1).write.mode("append").text(landing)
    run()
    return spark.read.parquet(out)


def reject_rate_alarm_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alarm(spark, sf_dir, alarms.reject_rate_alarm_stream, "rate-alarm")


def freshness_alarm_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alarm(spark, sf_dir, alarms.freshness_alarm_stream, "freshness-alarm")


# -- edges of the steps -----------------------------------------------------------------------------


def accepted_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid events whose times are spelled with Z, without an offset, or two hours east, by the number in their id."""
    payloads = samples.events_as_payloads(configure(spark), sf_dir)
    number = F.regexp_extract("value", r'"event_id":"#?(\d{12})"', 1).try_cast("bigint")
    ending = F.when(number % 3 == 1, '"').when(number % 3 == 2, '+02:00"').otherwise('Z"')
    spelled = payloads.withColumn("value", F.replace(F.col("value"), F.lit('Z"'), ending))
    return silver.typed(validation.valid_events(validation.judge(spelled)), "event_date").select(
        "event_id", "event_date", "event_timestamp", "is_late_arrival", "validated_at"
    )


def amounts_lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a full build counts when some orders have quantities beyond the column."""
    payloads = samples.events_as_payloads(configure(spark), sf_dir)
    number = F.regexp_extract("value", r'"event_id":"#?(\d{12})"', 1).try_cast("bigint")
    huge = (number % 97 == 0) & F.contains("value", F.lit('"event_type":"order_placed"')) & F.col("value").rlike('"quantity":[0-9]')
    grown = F.when(huge, F.replace(F.col("value"), F.lit('"quantity":'), F.lit('"quantity":1000000000'))).otherwise(F.col("value"))
    lake = new_lake(spark, "lost")
    lake.ingest(payloads.withColumn("value", grown), "all")
    counted = lake.build_silver()
    return spark.createDataFrame([counted]).select("rows_in", "unparseable", "duplicates", "rows_out", "amounts_lost")


def empty_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake without rejects and one without valid rows: what the steps leave where they have nothing to do."""
    judged = validation.judge(samples.events_as_payloads(configure(spark), sf_dir))
    rejected = F.col("reject_reason").isNotNull()
    clean, dirty = new_lake(spark, "clean"), new_lake(spark, "dirty")
    clean.ingest(judged.where(~rejected).select("value", "arrived_at"), "valid")
    clean.build_silver()
    clean.build_gold()
    dirty.ingest(judged.where(rejected).select("value", "arrived_at"), "rejects")
    built = [bool(dirty.build_silver()), bool(dirty.build_gold()), dirty.build_layouts()]
    return (
        clean.fact_orders().agg(F.count("*").alias("clean_facts"))
        .withColumns({
            "clean_summary_rows": F.lit(clean.quarantine_summary().count()),
            "dirty_quarantined": F.lit(dirty.quarantine().count()),
            "dirty_silver_rows": F.lit(dirty.silver().count()),
            "dirty_steps_built": F.lit(sum(built)),
        })
    )


def clustered_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day by event type on the clustered layout, whose order already holds a day's types together."""
    events = lakehouse(spark, sf_dir, "clustered").clustered()
    return events.groupBy("event_date", "event_type").agg(
        F.count("*").alias("n"), F.countDistinct("event_id").alias("ids"), serving.exact_sum(F.col("gross_amount")).alias("revenue")
    )


def clustered_date_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day with most events by event type, found by the statistics of files and pages."""
    events = lakehouse(spark, sf_dir, "clustered").clustered()
    day = serving.pivot_date(events).first()["event_date"]  # a literal reaches the scan
    return serving.date_filtered(events, day)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        compacted_bronze, compacted_quarantine, silver_incremental, catalog_incremental, stream_text_replay, buffered_ingest,
        reject_rate_alarm_stream, freshness_alarm_stream, accepted_times, amounts_lost, empty_steps,
        clustered_days, clustered_date_filtered,
    )
    return {f.__name__: f for f in found}
