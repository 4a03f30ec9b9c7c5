"""Keyed state for streams where event order matters.

A micro-batch brings a key's rows unsorted, and later batches may bring earlier rows. So rows wait in
the key's state until the watermark has passed them, and are then handled in event-time order: the
results are those of the table operators, whatever the order of arrival.

The order states need no code per key: sessions with a length of their own per event do it inside
the engine. The jump alarm looks back without limit, which no built-in does on a stream; it keeps
typed state, and timers wake a key up. Such a key holds no more than the rows that the watermark
delay and one micro-batch span (bound the latter with `files_per_batch` at the source).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidemark.functions.eventtime import (
    epoch_us,
    from_epoch_us,
    interval_text,
    micros,
    time_type,
)
from tidemark.operators.patterns import LATE, NO_CREATE, PAID, TIMEOUT
from tidemark.session import use_rocksdb

def order_states_stream(
    orders: DataFrame,
    order_id: str,
    ts: str,
    event_type: str,
    limit: str = "15 minutes",
    late_wait: str = "0 seconds",
) -> DataFrame:
    """Order/pay state machine on a stream with a watermark on `ts`: order_id, channel, result_msg.

    A create waits for `limit` plus `late_wait`. A pay in the second part of that time is "payed but
    already timeout"; a pay after it finds no open create. What belongs together is one session: a
    create keeps it open for its wait, a pay does not, so a session holds the few events of one
    create, and its outcomes come when the watermark has passed its end, which also drops its state. A table gives
    all sessions at once.
    """
    return session_outcomes(order_sessions(orders, order_id, ts, event_type, limit, late_wait), order_id, limit, late_wait)


def order_sessions(orders: DataFrame, order_id: str, ts: str, event_type: str, limit: str, late_wait: str) -> DataFrame:
    """The sessions of `order_states_stream`: `_session` (start and end), `order_id`, `_events` in event-time order."""
    wait_us = micros(limit) + micros(late_wait)
    kind = F.col(event_type)
    is_create = kind == "create"
    stay = F.when(is_create, interval_text(wait_us + 1)).otherwise(interval_text(1))
    event = F.struct(
        epoch_us(ts).alias("us"), F.when(is_create, 0).otherwise(1).alias("is_pay")
    )
    return (
        orders.where(kind.isin("create", "pay"))
        .groupBy(F.session_window(ts, stay).alias("_session"), order_id)
        .agg(F.array_sort(F.collect_list(event)).alias("_events"))
    )


def session_outcomes(sessions: DataFrame, order_id: str, limit: str, late_wait: str) -> DataFrame:
    """The result of `order_states_stream` for sessions that have ended."""
    limit_us, wait_us = micros(limit), micros(limit) + micros(late_wait)
    events = F.col("_events")

    def outcome(now, i):
        before = F.get(events, i - 1)
        after = F.get(events, i + 1)
        since, until = now["us"] - before["us"], after["us"] - now["us"]
        paid_open = (now["is_pay"] == 1) & (before["is_pay"] == 0) & (since <= wait_us)
        left_open = after.isNull() | (until > wait_us)
        return (
            F.when(paid_open & (since < limit_us), PAID)
            .when(paid_open, LATE)
            .when(now["is_pay"] == 1, NO_CREATE)
            .when(left_open | ((after["is_pay"] == 0) & (until >= limit_us)), TIMEOUT)
        )

    message = F.explode(F.array_compact(F.transform(events, outcome)))
    channel = F.when(F.col("result_msg") == PAID, "main").otherwise("side")
    return sessions.select(order_id, message.alias("result_msg")).select(order_id, channel.alias("channel"), "result_msg")


class _Jumps(StatefulProcessor):
    """Keeps a sensor's last reading and the readings the watermark has not passed yet."""

    def __init__(self, sensor: str, threshold: float):
        self.sensor, self.threshold = sensor, threshold

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "temperature double")
        self.pending = handle.getListState("pending", "us bigint, id bigint, temperature double")

    def handleInputRows(self, key, rows, timerValues):
        new = pd.concat(list(rows))[["at_us", "row_id", "temperature"]]
        self.pending.appendList(list(new.itertuples(index=False, name=None)))
        self._wake(int(new["at_us"].min()), timerValues)
        yield from self._release(key, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._release(key, timerValues)

    def _wake(self, us: int, timerValues) -> None:
        at = us // 1000 + 1
        if at > timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(at)

    def _release(self, key, timerValues):
        mark_us = timerValues.getCurrentWatermarkInMs() * 1000
        rows = sorted(self.pending.get())
        due = [r for r in rows if r[0] <= mark_us]
        if not due:
            return
        waiting = rows[len(due) :]
        if waiting:
            self.pending.put(waiting)
            self._wake(waiting[0][0], timerValues)
        else:
            self.pending.clear()
        now = np.array([r[2] for r in due])
        before = self.last.get()[0] if self.last.exists() else np.nan
        last = np.concatenate([[before], now[:-1]])
        self.last.update((float(now[-1]),))
        hit = np.abs(now - last) > self.threshold
        if hit.any():
            yield pd.DataFrame(
                {
                    self.sensor: key[0],
                    "at_us": np.array([r[0] for r in due])[hit],
                    "last_temperature": last[hit],
                    "temperature": now[hit],
                }
            )

    def close(self) -> None:
        pass


def temperature_jumps_stream(
    readings: DataFrame,
    sensor: str,
    ts: str,
    row_id: str,
    temperature: str,
    threshold: float = 10.0,
) -> DataFrame:
    """The jump alarm on a stream with a watermark on `ts`, in event-time order."""
    use_rocksdb(readings.sparkSession)
    rows = readings.select(
        sensor,
        ts,
        epoch_us(ts).alias("at_us"),
        F.col(row_id).cast("long").alias("row_id"),
        F.col(temperature).alias("temperature"),
    )
    key_type = readings.schema[sensor].dataType.simpleString()
    hits = rows.groupBy(sensor).transformWithStateInPandas(
        _Jumps(sensor, threshold),
        f"{sensor} {key_type}, at_us bigint, last_temperature double, temperature double",
        "append",
        "eventTime",
    )
    return hits.select(
        sensor,
        from_epoch_us(F.col("at_us"), time_type(readings, ts)).alias(ts),
        "last_temperature",
        "temperature",
        F.lit("change too much").alias("msg"),
    )


class _RisingNow(StatefulProcessor):
    """Counts down from a sensor's first rise; any reading that is not a rise stops the clock."""

    def __init__(self, sensor: str, wait_ms: int, text: str):
        self.sensor, self.wait_ms, self.text = sensor, wait_ms, text

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "temperature double")
        self.clock = handle.getValueState("clock", "at_ms bigint")

    def handleInputRows(self, key, rows, timerValues):
        readings = pd.concat(list(rows)).sort_values(["at_us", "row_id"])["temperature"].to_numpy()
        before = self.last.get()[0] if self.last.exists() else np.nan
        rises = np.concatenate([[before], readings[:-1]]) < readings
        self.last.update((float(readings[-1]),))
        if not rises.all() and self.clock.exists():
            self.handle.deleteTimer(self.clock.get()[0])
            self.clock.clear()
        if rises[-1] and not self.clock.exists():
            at_ms = timerValues.getCurrentProcessingTimeInMs() + self.wait_ms
            self.handle.registerTimer(at_ms)
            self.clock.update((at_ms,))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.clock.clear()
        yield pd.DataFrame({self.sensor: [key[0]], "msg": [f"sensor {key[0]} {self.text}"]})

    def close(self) -> None:
        pass


def rising_now_stream(
    readings: DataFrame,
    sensor: str,
    ts: str,
    row_id: str,
    temperature: str,
    least: str = "10 seconds",
) -> DataFrame:
    """Alarm by the wall clock: `least` after a first rise, if no reading since was not a rise.

    For live sensors. `steady_rises` is the same alarm by event time and can be repeated.
    """
    use_rocksdb(readings.sparkSession)
    rows = readings.select(
        sensor,
        epoch_us(ts).alias("at_us"),
        F.col(row_id).cast("long").alias("row_id"),
        F.col(temperature).alias("temperature"),
    )
    key_type = readings.schema[sensor].dataType.simpleString()
    return rows.groupBy(sensor).transformWithStateInPandas(
        _RisingNow(sensor, micros(least) // 1000, f"temperature kept rising for {least}"),
        f"{sensor} {key_type}, msg string",
        "append",
        "processingTime",
    )
