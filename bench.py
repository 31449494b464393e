"""Benchmark: one JSON line with the median seconds of every headline query.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Build steps run once, as they write tables, and are reported apart. Everything else is read from the stored tables,
warmed up once and timed BENCH_REPEATS times (default 5). The three layout queries also
report the bytes Spark read, because bytes are stable where milliseconds are not.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import serving, silver, star, validation
from tidemark.plans.lakehouse import Lakehouse
from tidemark.session import local_session, new_shared_path
from tidemark.sinks import writers
from tidemark.sources import samples, tables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "5"))

# Vectored reads run on other threads, where Spark does not count their bytes.
spark = local_session(
    CPUS, app="tidemark-bench", **{"spark.hadoop.parquet.hadoop.vectored.io.enabled": "false"}
)
spark.sparkContext.setLogLevel("ERROR")
seconds: dict[str, float] = {}
build_seconds: dict[str, float] = {}
read_bytes: dict[str, int] = {}


def bytes_read(group: str) -> int:
    """Input bytes of all stages that ran under a job group."""
    tracker, store = spark.sparkContext.statusTracker(), spark.sparkContext._jsc.sc().statusStore()
    stages = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
    total = 0
    for stage in stages:
        try:
            total += store.lastStageAttempt(stage).inputBytes()
        except Exception:  # noqa: BLE001 - AQE drops stages it did not need
            continue
    return total


def step(name: str, work) -> None:
    start = time.perf_counter()
    work()
    build_seconds[name] = round(time.perf_counter() - start, 4)


def query(name: str, build, count_bytes: bool = False) -> None:
    """Median of repeated full runs; results go to a no-op sink, not to the driver."""

    def run() -> float:
        start = time.perf_counter()
        frame: DataFrame = build()
        frame.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run()
    seconds[name] = round(statistics.median(run() for _ in range(REPEATS)), 4)
    if count_bytes:
        spark.sparkContext.setJobGroup(name, name)
        run()
        read_bytes[name] = bytes_read(name)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def main() -> None:
    # Payload text is stored first so that parsing is measured, not deriving the sample.
    event_path, line_path = new_shared_path(spark, "events"), new_shared_path(spark, "lines")
    samples.events_as_payloads(spark, SF_DIR).repartition(int(CPUS)).write.parquet(event_path)
    samples.order_lines_as_payloads(spark, SF_DIR).repartition(int(CPUS)).write.parquet(line_path)
    events, lines = spark.read.parquet(event_path), spark.read.parquet(line_path)

    query("validate_events", lambda: validation.ingest_counters(validation.judge(events)))
    query("validate_order_lines", lambda: validation.ingest_counters(validation.judge(lines)))
    query(
        "silver_order_lines",
        lambda: silver.silver(validation.valid_events(validation.judge(lines))),
    )

    lake = Lakehouse(spark, new_shared_path(spark, "lake"))
    step("build_ingest", lambda: lake.ingest(events, "b1"))
    step("build_silver", lake.build_silver)
    step("build_gold", lake.build_gold)
    step("build_layouts", lake.build_layouts)

    stored = lake.silver()
    query("dim_customer", lambda: star.dim_customer(stored))
    query("dim_product", lambda: star.dim_product(stored))
    query("dim_date", lambda: star.dim_date(stored))
    query("fact_orders", lambda: star.fact_orders(stored))
    fact, summary = lake.fact_orders(), lake.quarantine_summary()
    query("daily_revenue", lambda: serving.daily_revenue(fact, lake.dim_date()))
    query(
        "stage_metrics",
        lambda: serving.stage_metrics(fact, lake.dim_customer(), lake.dim_product(), summary),
    )
    query("quarantine_by_reason", lambda: serving.quarantine_by_reason(summary))
    query("freshness", lambda: serving.freshness(fact, F.lit("2024-02-01").cast("timestamp")))

    line_silver = new_shared_path(spark, "line-silver")
    step(
        "build_order_line_silver",
        lambda: writers.write_table(silver.silver(validation.valid_events(validation.judge(lines))), line_silver),
    )
    line_events = tables.read_silver(spark, line_silver)
    query(
        "daily_revenue_order_lines",
        lambda: serving.daily_revenue(star.fact_orders(line_events), star.dim_date(line_events)),
    )

    layouts = lake.layouts()
    day = serving.pivot_date(layouts["parquet_part"]).first()["event_date"]
    for name, table in layouts.items():
        query(f"narrow_projection.{name}", lambda: serving.narrow_projection(table), count_bytes=True)
        query(f"date_filtered.{name}", lambda: serving.date_filtered(table, day), count_bytes=True)
        query(f"full_groupby.{name}", lambda: serving.full_groupby(table), count_bytes=True)

    print(
        json.dumps(
            {
                "metric": "sum of median query seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "builds_once": build_seconds,
                "read_bytes": read_bytes,
                "rows": {"events": events.count(), "order_lines": lines.count(), "silver": stored.count()},
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()
    spark.stop()
    sys.exit(0)
