"""Running results on streams that are read while windows are still open."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.eventtime import interval_text
from tidemark.operators.windowed import pane_width, sliding_counts
from tidemark.sinks.keyed import BatchWriter, write_batch


def pane_counts(
    stream: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str]
) -> DataFrame:
    """Update-mode counts per pane of a sliding window: state is one row per key and pane."""
    pane = interval_text(pane_width(size, slide))
    return stream.groupBy(F.window(ts, pane).alias("_pane"), *keys).agg(
        F.count("*").alias("n")
    ).select(*keys, F.col("_pane.start").alias("pane_start"), "n")


def windows_of_panes(
    panes: DataFrame, size: str, slide: str, keys: Sequence[str]
) -> DataFrame:
    """Window counts from the current pane counts, as a table."""
    counts = sliding_counts(panes, "pane_start", size, slide, keys, weight="n")
    return counts.select(*keys, "window_start", "window_end", F.col("total").alias("n"))


def new_visitors(stream: DataFrame, ts: str, user: str, size: str) -> DataFrame:
    """Each user once per window, as soon as seen: window_end, user."""
    return (
        stream.withColumn("_window", F.window(ts, size))
        .dropDuplicates(["_window", user])
        .select(F.col("_window.end").alias("window_end"), user)
    )


def increment_writer(path: str, keys: Sequence[str]) -> BatchWriter:
    """Counts of the batch's rows per key; the sum over batches is the count so far."""

    def write(df: DataFrame, batch_id: int) -> None:
        write_batch(df.groupBy(*keys).agg(F.count("*").alias("n")), path, batch_id)

    return write


def sum_increments(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("n").alias("n"))
