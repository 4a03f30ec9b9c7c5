"""Watermark policies and rows that come too late."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.eventtime import epoch_us, interval_text, micros, step_index
from tidemark.operators.sequences import running
from tidemark.sinks.keyed import BatchWriter, several_passes, write_batch


def ascending(df: DataFrame, ts: str) -> DataFrame:
    """Event times only grow: the watermark is the greatest one seen (also per-element marks)."""
    return df.withWatermark(ts, "0 seconds")


def bounded(df: DataFrame, ts: str, delay: str, lateness: str = "0 seconds") -> DataFrame:
    """Out-of-order by at most `delay`, plus `lateness` during which results are still updated."""
    return df.withWatermark(ts, interval_text(micros(delay) + micros(lateness)))


def mark_late(
    df: DataFrame,
    ts: str,
    arrival: str,
    size: str,
    slide: str,
    delay: str,
    lateness: str = "0 seconds",
    batch: str = "10 seconds",
    chunk: str = "1 day",
) -> DataFrame:
    """Adds `late`: all windows of the row were closed when it arrived.

    Rows arrive in batches of `batch` arrival time; a batch sees the watermark left by the ones
    before it. The greatest event time is taken per batch first, so the ordered step runs over one
    row per batch.
    """
    width = micros(batch)
    rows = df.withColumn("_batch", step_index(epoch_us(arrival), width))
    heads = rows.groupBy("_batch").agg(F.max(epoch_us(ts)).alias("_head"))
    timed = heads.withColumn("_at", F.timestamp_micros(F.col("_batch") * F.lit(width)))
    marks = running(
        timed, [], "_at", ["_batch"], {"_before": ("max", "_head")}, chunk, include_current=False
    ).select("_batch", "_before")
    late = _is_late(ts, F.col("_before"), size, slide, delay, lateness)
    return rows.join(marks, "_batch", "left").withColumn("late", late).select(*df.columns, "late")


def _is_late(ts: str, head: Column, size: str, slide: str, delay: str, lateness: str) -> Column:
    """Whether the last window of `ts` was closed at `head`, the greatest event time seen (in us)."""
    slide_us = micros(slide)
    last_start = step_index(epoch_us(ts), slide_us) * F.lit(slide_us)
    closes = last_start + F.lit(micros(size) + micros(lateness))
    return F.coalesce(closes <= head - F.lit(micros(delay)), F.lit(False))


def split_late(df: DataFrame, **rule) -> dict[str, DataFrame]:
    marked = mark_late(df, **rule)
    return {
        "main": marked.where("not late").drop("late"),
        "late": marked.where("late").drop("late"),
    }


def late_writer(
    path: str, ts: str, size: str, slide: str, delay: str, lateness: str = "0 seconds"
) -> BatchWriter:
    """The split on a stream: each micro-batch is judged by the greatest event time of those before.

    Rows go to `main` and `late`. `heads` gets one row per batch: the greatest event time up to and with it, so that a
    batch reads the row of the batch before it, however long the stream has run.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        head = df.agg(F.max(epoch_us(ts)).alias("head"))
        seen = None
        if batch_id > 0:
            before = df.sparkSession.read.schema(head.schema).parquet(f"{path}/heads/batch={batch_id - 1}")
            seen = before.first()[0]
        seen = F.lit(seen).cast("long")
        late = _is_late(ts, seen, size, slide, delay, lateness)
        write_batch(df.where(~late), f"{path}/main", batch_id)
        write_batch(df.where(late), f"{path}/late", batch_id)
        write_batch(head.select(F.greatest("head", seen).alias("head")), f"{path}/heads", batch_id)

    return several_passes(write)
