"""Data-quality alarms on the running stream, equal to those of ``operators.monitoring`` over all of it.

Both count arrivals in periods that a watermark closes; rows later than ``delay`` no longer move an alarm
(they still reach the lake, whose ingestion has no watermark). Heartbeats (null payloads) count for
nothing and let periods close while nothing arrives.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark import contract
from tidemark.operators import monitoring, validation

_RATE = contract.RATE_PERIOD_SECONDS
_HOUR_US = contract.FRESHNESS_PERIOD_SECONDS * 1_000_000


def reject_rate_alarm_stream(raw_stream: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """``reject_rate_alarm`` of the closed periods, for append mode.

    Closed periods flow into a second, sliding window as long as the periods an alarm needs: it
    holds their breaches in state and closes with the last of them. Both windows run in the
    JVM; state is a row a period, for the periods the delay keeps open.
    """
    judged = validation.judge(raw_stream).select("arrived_at", "value", "reject_reason")
    present = F.col("value").isNotNull()
    per_period = (
        judged.withWatermark("arrived_at", delay)
        .groupBy(F.window("arrived_at", f"{_RATE} seconds"))
        .agg(F.count("value").alias("received"), F.count_if(present & F.col("reject_reason").isNotNull()).alias("rejected"))
        .where("received > 0")
    )
    rate = monitoring.reject_rate(F.col("received"), F.col("rejected"))
    breaching = rate > contract.RATE_THRESHOLD_PCT
    needed = contract.RATE_PERIODS_TO_ALARM
    own = F.struct(F.col("window.start").alias("period_start"), "received", "rejected", rate.alias("reject_rate_pct"), breaching.alias("breaching"))
    recent = F.window(F.window_time("window"), f"{needed * _RATE} seconds", f"{_RATE} seconds")
    alarmed = per_period.groupBy(recent.alias("recent")).agg(F.max(own).alias("own"), F.count_if(breaching).alias("breaches"))
    last_period = F.unix_micros("recent.end") - _RATE * 1_000_000
    return alarmed.where(F.unix_micros("own.period_start") == last_period).select("own.*", (F.col("breaches") == needed).alias("in_alarm"))


_ALARM_DDL = "period_start timestamp, max_lag_seconds double, breaching boolean"


class _RunningFreshness(StatefulProcessor):
    """Keeps the newest order so far and the next hour to answer for, in microseconds.

    Hours come closed and in any order within a batch. An hour without an order breaches: when a later
    one comes, or, if none does, when the timer finds that the watermark has passed it.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("running", "newest long, next_hour long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest, next_hour = self.state.get() if self.state.exists() else (None, None)
        hours = sorted(pair for frame in rows for pair in zip(frame["hour"], frame["observed"], frame["seen"]) if pd.notna(pair[1]))
        out = []
        for hour, observed, seen in hours:
            hour, observed, seen = int(hour), int(observed), int(seen)
            if next_hour is not None:
                out += [(h, None, True) for h in range(next_hour, hour, _HOUR_US)]
            newest = seen if newest is None else max(newest, seen)
            lag = max((observed - newest) / 1e6, 0.0)
            out.append((hour, lag, lag > contract.FRESHNESS_THRESHOLD_SECONDS))
            next_hour = hour + _HOUR_US
        yield from self._answer(out, newest, next_hour)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        newest, next_hour = self.state.get()
        closed = timerValues.getCurrentWatermarkInMs() * 1000
        hours = list(range(next_hour, closed - _HOUR_US + 1, _HOUR_US))
        yield from self._answer([(h, None, True) for h in hours], newest, hours[-1] + _HOUR_US if hours else next_hour)

    def _answer(self, out: list[tuple], newest: int | None, next_hour: int | None) -> Iterator[pd.DataFrame]:
        if next_hour is not None:
            self.state.update((newest, next_hour))
            self.handle.registerTimer((next_hour + _HOUR_US) // 1000)
        if out:
            starts, lags, breaching = zip(*out)
            lags = pd.Series(lags, dtype="float64")
            yield pd.DataFrame({"period_start": pd.to_datetime(list(starts), unit="us"), "max_lag_seconds": lags, "breaching": list(breaching)})

    def close(self) -> None:
        pass


def freshness_alarm_stream(raw_stream: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """``freshness_alarm`` of the closed hours, for append mode; goes on while heartbeats alone arrive.

    Arrivals are reduced to a row an hour in the JVM before the one running state sees them.
    """
    judged = validation.judge(raw_stream)
    order = F.col("value").isNotNull() & F.col("reject_reason").isNull() & (F.col("event_type") == "order_placed")
    seen = judged.select(
        "arrived_at",
        F.when(order, F.unix_micros("arrived_at")).alias("observed"),
        F.when(order, F.unix_micros("_time.at")).alias("seen"),
    )
    per_hour = (
        seen.withWatermark("arrived_at", delay)
        .groupBy(F.window("arrived_at", f"{contract.FRESHNESS_PERIOD_SECONDS} seconds"))
        .agg(F.max("observed").alias("observed"), F.max("seen").alias("seen"))
    )
    hours = per_hour.select(
        F.lit(0).alias("one"), F.unix_micros("window.start").alias("hour"), "observed", "seen", F.window_time("window").alias("closed_at")
    )
    answered = hours.groupBy("one").transformWithStateInPandas(_RunningFreshness(), _ALARM_DDL, "append", "eventTime")
    return answered.select("period_start", "max_lag_seconds", "breaching")
