"""Streams that keep their open rows as a table from one micro-batch to the next.

A state store takes every row in and out by itself. Where rows arrive in large micro-batches and stay open for a while only,
a batch can as well read what the one before left open, handle it together with its own rows as a table does, and leave
what is open now. A batch then costs a few shuffles of what it brings and of what is open.

The watermark after a batch is the greatest event time so far less the delay; with several logs, that of the log which is
behind. It counts in the same batch, so nothing is left for a batch without rows at the end. Rows without a time are left out,
and so are rows that come when the watermark has passed them. A batch reads what the batch before it left and writes folders
of its own, so it may be run again; folders that are no longer needed are removed.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.eventtime import epoch_us, from_epoch_us, micros, time_type
from tidemark.operators.alarms import temperature_jumps
from tidemark.operators.matching import CHANNELS, match_sessions, reconcile, waiting_sessions
from tidemark.sinks.days import _Files
from tidemark.sinks.keyed import BatchWriter, latest_per_key, write_batch
from tidemark.streaming.stateful import order_sessions, session_outcomes

#: Rows of a table and which of them a batch has brought (`_new`) to the two sides of a join.
Split = Callable[[DataFrame], tuple[DataFrame, DataFrame]]


class _Kept:
    """What batches leave beside the rows that they write to `path`: open rows, and the heads of the logs."""

    def __init__(self, df: DataFrame, path: str, batch_id: int):
        self.spark, self.path, self.batch = df.sparkSession, path, batch_id
        self.files = _Files(self.spark, path)

    def marks(self, df: DataFrame, ts: str, delay: str, logs: Sequence[Column] | None) -> tuple[Column, Column]:
        """The watermarks before and after the batch in microseconds, null while a log has not begun."""
        logs = logs or [F.lit(True)]
        before = json.loads(self.files.read(f"{self.path}-heads/{self.batch - 1}")) if self.batch else [None] * len(logs)
        now = df.agg(*[F.max(F.when(log, epoch_us(ts))) for log in logs]).first()
        heads = [max((x for x in pair if x is not None), default=None) for pair in zip(before, now)]
        self.files.write(f"{self.path}-heads/{self.batch}", json.dumps(heads))
        return tuple(F.lit(None if None in x else min(x) - micros(delay)).cast("long") for x in (before, heads))

    def open(self, schema) -> DataFrame | None:
        """What the batch before left, if there was one."""
        return self.spark.read.schema(schema).parquet(f"{self.path}-open/batch={self.batch - 1}") if self.batch else None

    def leave(self, df: DataFrame) -> None:
        write_batch(df, f"{self.path}-open", self.batch)

    def clear(self) -> None:
        """The batch before is what this one starts from if it is run again; earlier ones are not needed."""
        for name in self.files.names(f"{self.path}-open"):
            if name.startswith("batch=") and int(name[6:]) < self.batch - 1:
                self.files.remove(f"{self.path}-open/{name}")
                self.files.remove(f"{self.path}-heads/{name[6:]}")


def rows_writer(
    path: str,
    ts: str,
    delay: str,
    told: Callable[[DataFrame, Column, Column], DataFrame],
    needed: Callable[[DataFrame, Column], DataFrame],
    logs: Sequence[Column] | None = None,
) -> BatchWriter:
    """Writes what `told` makes of the open and the batch's rows (`_new`) between the watermarks before and after the batch,
    and leaves the rows that are `needed` after it. `logs` tells the rows of the logs that the watermark waits for.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        kept = _Kept(df, path, batch_id)
        before, mark = kept.marks(df, ts, delay, logs)
        new = df.where(F.col(ts).isNotNull() & F.coalesce(epoch_us(ts) > before, F.lit(True)))
        seen, earlier = new.withColumn("_new", F.lit(True)), kept.open(df.schema)
        if earlier is not None:
            seen = seen.unionByName(earlier.withColumn("_new", F.lit(False)))
        write_batch(told(seen, before, mark), path, batch_id)
        kept.leave(needed(seen, mark).drop("_new"))
        kept.clear()

    return write


def _within(ts: str, reach: str) -> Callable[[DataFrame, Column], DataFrame]:
    """Rows not older than `reach` before the watermark."""
    return lambda seen, mark: seen.where(F.coalesce(epoch_us(ts) >= mark - F.lit(micros(reach)), F.lit(True)))


def _sides(split: Split, seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    left, right = split(seen)
    return left.withColumnRenamed("_new", "_left_new"), right.withColumnRenamed("_new", "_right_new")


def _fresh() -> Column:
    """Whether the batch has brought one of the two."""
    return F.coalesce("_left_new", F.lit(False)) | F.coalesce("_right_new", F.lit(False))


def join_writer(
    path: str, ts: str, delay: str, split: Split, join: Callable[[DataFrame, DataFrame], DataFrame], reach: str, logs: Sequence[Column]
) -> BatchWriter:
    """An inner join of two sides of a log, whose pairs are at most `reach` apart: a pair is written when the later comes."""

    def told(seen: DataFrame, before: Column, mark: Column) -> DataFrame:
        return join(*_sides(split, seen)).where(_fresh()).drop("_left_new", "_right_new")

    return rows_writer(path, ts, delay, told, _within(ts, reach), logs)


def reconcile_writer(
    path: str, ts: str, delay: str, split: Split, key: str, pay_ts: str, receipt_ts: str, logs: Sequence[Column],
    pay_waits: str = "5 seconds", receipt_waits: str = "3 seconds",
) -> BatchWriter:
    """`reconcile` on a log of both sides: pairs when they meet, one-sided rows when the watermark has passed their wait."""

    def told(seen: DataFrame, before: Column, mark: Column) -> DataFrame:
        pays, receipts = _sides(split, seen)
        rows = reconcile(pays, receipts, key, pay_ts, receipt_ts, pay_waits, receipt_waits)
        until = F.when(F.col("channel") == CHANNELS[1], epoch_us(pay_ts) + micros(pay_waits)).otherwise(epoch_us(receipt_ts) + micros(receipt_waits))
        settled = (until < mark) & F.coalesce(until >= before, F.lit(True))
        due = F.when(F.col("channel") == CHANNELS[0], _fresh()).otherwise(settled)
        return rows.where(due).drop("_left_new", "_right_new")

    # a row whose wait has passed is still a partner of one that waits
    reach = f"{micros(pay_waits) + micros(receipt_waits)} microseconds"
    return rows_writer(path, ts, delay, told, _within(ts, reach), logs)


def jumps_writer(
    path: str, ts: str, delay: str, sensor: str, row_id: str, temperature: str, threshold: float = 10.0, chunk: str = "1 day"
) -> BatchWriter:
    """The jump alarm in event-time order. Each sensor's last reading up to the watermark is kept."""
    order = [ts, row_id]

    def told(seen: DataFrame, before: Column, mark: Column) -> DataFrame:
        jumps = temperature_jumps(seen, sensor, ts, order, temperature, threshold, chunk)
        return jumps.where((epoch_us(ts) <= mark) & F.coalesce(epoch_us(ts) > before, F.lit(True)))

    def needed(seen: DataFrame, mark: Column) -> DataFrame:
        passed = F.coalesce(epoch_us(ts) <= mark, F.lit(False))
        return seen.where(~passed).unionByName(latest_per_key(seen.where(passed), [sensor], order))

    return rows_writer(path, ts, delay, told, needed)


def sessions_writer(
    path: str,
    ts: str,
    delay: str,
    stay: Column,
    sessions: Callable[[DataFrame], DataFrame],
    told: Callable[[DataFrame], DataFrame],
    rows: Callable[[DataFrame], DataFrame],
) -> BatchWriter:
    """Writes what `told` makes of the `sessions` that the watermark has passed and takes the `rows` of the others on.

    `stay` is the time in microseconds for which a row keeps its session open.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        kept = _Kept(df, path, batch_id)
        before, mark = kept.marks(df, ts, delay, None)
        seen = df.where(F.col(ts).isNotNull() & F.coalesce(epoch_us(ts) + stay > before, F.lit(True)))
        closed = F.coalesce(epoch_us("_session.end") <= mark, F.lit(False))
        found = sessions(seen).withColumn("_closed", closed)
        earlier = kept.open(found.schema)
        if earlier is not None:
            seen = seen.unionByName(rows(earlier.where("not _closed")).select(seen.columns))
            found = sessions(seen).withColumn("_closed", closed)
        kept.leave(found)
        here = df.sparkSession.read.schema(found.schema).parquet(f"{path}-open/batch={batch_id}")
        write_batch(told(here.where("_closed")), path, batch_id)
        kept.clear()

    return write


def first_match_writer(
    path: str, log: DataFrame, delay: str, key: str, ts: str, side: str, row: str, pay_waits: str = "5 seconds", receipt_waits: str = "3 seconds",
    flat: Callable[[DataFrame], DataFrame] | None = None,
) -> BatchWriter:
    """`reconcile_first` on a stream of the columns of `log`; `flat` is applied to its result."""
    stay = F.when(F.col(side) == "pay", micros(pay_waits) + 1).otherwise(micros(receipt_waits) + 1)

    def rows(sessions: DataFrame) -> DataFrame:
        events = sessions.select(key, F.explode("_events").alias("x"))
        kind = F.when(F.col("x.kind") == 0, "pay").otherwise("receipt")
        return events.select(key, from_epoch_us(F.col("x.us"), time_type(log, ts)).alias(ts), kind.alias(side), F.col("x.row").alias(row))

    return sessions_writer(
        path, ts, delay, stay,
        lambda df: waiting_sessions(df.select(key, ts, side, row), key, ts, side, row, pay_waits, receipt_waits),
        lambda sessions: (flat or (lambda df: df))(match_sessions(sessions, key)), rows,
    )


def order_states_writer(
    path: str, orders: DataFrame, delay: str, order_id: str, ts: str, event_type: str, limit: str = "15 minutes", late_wait: str = "0 seconds"
) -> BatchWriter:
    """`order_states_stream` on a stream of the columns of `orders`."""
    stay = F.when(F.col(event_type) == "create", micros(limit) + micros(late_wait) + 1).otherwise(1)

    def rows(sessions: DataFrame) -> DataFrame:
        events = sessions.select(order_id, F.explode("_events").alias("x"))
        kind = F.when(F.col("x.is_pay") == 0, "create").otherwise("pay")
        return events.select(order_id, kind.alias(event_type), from_epoch_us(F.col("x.us"), time_type(orders, ts)).alias(ts))

    return sessions_writer(
        path, ts, delay, stay,
        lambda df: order_sessions(df, order_id, ts, event_type, limit, late_wait),
        lambda sessions: session_outcomes(sessions, order_id, limit, late_wait), rows,
    )
