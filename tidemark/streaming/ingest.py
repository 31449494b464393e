"""Streaming validation: raw lines in, quarantine and bronze out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import contract
from tidemark.operators import monitoring, validation
from tidemark.plans.lakehouse import Lakehouse
from tidemark.sources.raw import stream_raw

#: Buffered batches that one trigger may store together.
BATCHES_PER_TRIGGER = 256


def _batch_label(batch: DataFrame, batch_id: int) -> str:
    """Unique per stream and batch, and the same again when the batch is replayed.

    The query id is stored in the checkpoint. A stream started over with a new checkpoint
    gets a new id, so its batch 0 cannot overwrite an older batch 0.
    """
    query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query_id}-{batch_id:012d}"


def start_ingest(
    raw_stream: DataFrame,
    lake: Lakehouse,
    checkpoint: str,
    on_batch: Callable[[str, dict[str, int]], None] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Store every micro-batch; a failed write fails the batch, which is then replayed.

    Offsets are committed only after both writes, rejects first, so no payload is lost, and
    a replay replaces the files of its own batch, so none is stored twice.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        label = _batch_label(batch, batch_id)
        counters = lake.ingest(batch, label)
        if on_batch is not None:
            on_batch(label, counters)

    return _started(raw_stream, store, checkpoint, trigger)


def _started(stream: DataFrame, store: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": f"{contract.BUFFER_SECONDS} seconds"}))
        .start()
    )


def start_buffered_ingest(
    spark: SparkSession,
    path: str,
    lake: Lakehouse,
    checkpoint: str,
    max_bytes: int = contract.BUFFER_BYTES,
    stamped: bool = False,
    on_batch: Callable[[str, dict[str, int]], None] | None = None,
    trigger: dict | None = None,
    batches_per_trigger: int = BATCHES_PER_TRIGGER,
) -> StreamingQuery:
    """``start_ingest`` of a landing folder whose batches are bounded in bytes as well as in age.

    Of what has landed, a batch takes files up to ``max_bytes`` and leaves the rest to the next; only a
    single file that is larger by itself makes a larger batch. Nothing waits for a batch to fill. Where
    more has landed than a batch may hold, a trigger stores up to ``batches_per_trigger`` batches' worth
    in one pass, so that a backlog costs a few jobs for many batches, not for each.
    """
    stream = stream_raw(spark, path, max_bytes_per_trigger=max_bytes * batches_per_trigger, stamped=stamped, files=True)

    def store(batch: DataFrame, batch_id: int) -> None:
        label = _batch_label(batch, batch_id)
        spark_ = batch.sparkSession
        segments = lake.segments(spark_)
        found = batch.select("_file", "_file_bytes").distinct().collect()  # the files of a trigger
        numbers = _packed({r["_file"]: r["_file_bytes"] for r in found}, max_bytes)
        if not numbers or segments.begun(label):
            counted = {label: lake.ingest(batch.select("value", "arrived_at"), label)}
        else:
            labels = [(file, segments.label_in(label, k)) for file, k in numbers.items()]
            dealt = spark_.createDataFrame(labels, "_file string, batch string")
            counted = lake.ingest_group(batch.join(F.broadcast(dealt), "_file"), label)
        if on_batch is not None:
            for own, counters in counted.items():
                on_batch(own, counters)

    return _started(stream, store, checkpoint, trigger)


def _packed(sizes: dict[str, int], max_bytes: int) -> dict[str, int]:
    """The number of each file's batch: in order of names, as many files as stay within ``max_bytes``."""
    numbers, number, held = {}, 0, 0
    for file in sorted(sizes):
        if held and held + sizes[file] > max_bytes:
            number, held = number + 1, 0
        numbers[file], held = number, held + sizes[file]
    return numbers


def reject_rate_stream(raw_stream: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Reject rate per closed period. The watermark bounds this metric's state only; the
    events themselves go through ``start_ingest``, which has none."""
    judged = validation.judge(raw_stream).select("arrived_at", "reject_reason")
    return monitoring.reject_rate_windows(judged.withWatermark("arrived_at", delay))
