"""Running results that a stream keeps in tables by day: counts, top lists that are told as they change, bitmaps.

Each batch is counted before anything else, so state and joins see its few sums and not its rows. What a batch reads back
is its own days; old days can be dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.text import visitor_offset
from tidemark.operators.clicks import click_counts
from tidemark.operators.ranking import top_keys
from tidemark.sinks.days import DayTable
from tidemark.sinks.keyed import BatchWriter, several_passes, write_batch


def daily_counts(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], **options) -> DayTable:
    """A table of `keys`, one of which is `day`, and n, whose rows add up."""
    return DayTable(spark, path, schema, lambda df: click_counts(df, keys, "n"), **options)


def count_writer(
    path: str, keys: Sequence[str], raw: Sequence[str] | None = None, place: Callable[[DataFrame], DataFrame] | None = None, **options
) -> BatchWriter:
    """Adds each batch's counts per `keys` to the daily counts below `path`.

    With `place`, the batch is counted per `raw` columns first, and `place` adds what is missing of `keys` to these sums.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        counts = _counted(df, keys, raw, place)
        daily_counts(df.sparkSession, path, counts.schema, keys, **options).add(counts, batch_id)

    return several_passes(write)


def _counted(df, keys, raw, place):
    if place is None:
        return click_counts(df, keys)
    return click_counts(place(click_counts(df, raw)), keys, "n")


def top_list_writer(
    path: str, group: Sequence[str], member: str, k: int, raw: Sequence[str] | None = None,
    place: Callable[[DataFrame], DataFrame] | None = None, **options,
) -> BatchWriter:
    """The `k` most frequent members of each `group`, of which `day` is one, written to `path`/lists when they change.

    `top` is a list of (`member`, n) in order of rank. The counts are kept below `path`/counts, see `count_writer`.
    """
    keys = [*group, member]

    def lists(counts: DataFrame, name: str) -> DataFrame:
        top = top_keys(counts, list(group), member, k)
        entry = F.collect_list(F.struct("rank", member, "n"))
        return top.groupBy(*group).agg(F.transform(F.array_sort(entry), lambda x: F.struct(x[member].alias(member), x["n"].alias("n"))).alias(name))

    def write(df: DataFrame, batch_id: int) -> None:
        counts = _counted(df, keys, raw, place).persist()
        table = daily_counts(df.sparkSession, f"{path}/counts", counts.schema, keys, **options)
        earlier = table.read(table.days_of(counts), before=batch_id)
        now = lists(click_counts(earlier.unionByName(counts), keys, "n"), "top")
        before = lists(earlier, "before")
        joined = now.join(before.select(*(F.col(c).alias(f"_{c}") for c in group), "before"), _same(group), "left")
        changed = joined.where(~F.col("top").eqNullSafe(F.col("before"))).select(*group, "top")
        write_batch(changed, f"{path}/lists", batch_id)
        table.add(counts, batch_id)
        counts.unpersist()

    return several_passes(write)


def _same(group: Sequence[str]):
    out = F.lit(True)
    for c in group:
        out = out & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return out


BITMAPS = "day string, window_end timestamp, slice bigint, bits binary"


def _united(df: DataFrame) -> DataFrame:
    return df.groupBy("day", "window_end", "slice").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_table(spark: SparkSession, path: str, **options) -> DayTable:
    """Slices of the windows' bitmaps; those of several batches are united by OR."""
    return DayTable(spark, path, StructType.fromDDL(BITMAPS), _united, **options)


def bitmap_writer(path: str, ts: str, user: str, size: str = "1 hour", capacity: int = 1 << 28, **options) -> BatchWriter:
    """Keeps one bitmap of visitors per window; a batch reads and writes the slices that it has bits of.

    A batch's bitmaps are built where its rows are, per (window, slice), so a busy window is spread over its slices.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        hashed = df.where(F.col(user).isNotNull() & F.col(ts).isNotNull()).select(
            F.window(ts, size)["end"].alias("window_end"), visitor_offset(F.col(user), capacity).alias("offset")
        )
        slices = hashed.groupBy(
            F.date_format("window_end", "yyyy-MM-dd").alias("day"), "window_end", F.bitmap_bucket_number("offset").alias("slice")
        ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("offset")).alias("bits"))
        bitmap_table(df.sparkSession, path, **options).add(slices, batch_id)

    return several_passes(write)


def bitmap_counts(slices: DataFrame) -> DataFrame:
    """window_end, n: the bits that are set in all slices of a window."""
    return slices.groupBy("window_end").agg(F.sum(F.bitmap_count("bits")).alias("n"))
