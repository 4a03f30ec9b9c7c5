"""Ad clicks batch by batch: the blacklist, the filtered counts and the daily click cap.

A batch sees what earlier batches wrote, so a click is filtered by a blacklist that its own batch
has not changed yet. All state is in tables of increments per batch, which a repeated batch
overwrites.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.clicks import click_counts, drop_blacklisted
from tidemark.operators.ranking import top_per_group
from tidemark.sinks.keyed import (
    BatchWriter,
    read_batches,
    set_add_writer,
    several_passes,
    write_batch,
)
from tidemark.streaming.counts import sum_increments


def _increments(df: DataFrame, path: str, keys: Sequence[str], batch_id: int) -> DataFrame:
    """Writes the batch's counts per `keys` and `day`; the totals of those including earlier batches.

    Only the batch's days are read back, so old days do not slow new batches.
    """
    counts = click_counts(df, keys)
    write_batch(counts, path, batch_id)
    rows = read_batches(df.sparkSession, path, counts.schema).where(F.col("batch") <= batch_id)
    touched = rows.where(F.col("batch") == batch_id).select(*keys)
    since = touched.agg(F.min("day")).first()[0]
    rows = rows.where(F.col("day") >= F.lit(since))
    return sum_increments(rows.join(touched, list(keys), "left_semi"), keys)


def ads_writer(path: str, threshold: int = 100) -> BatchWriter:
    """For clicks (day, area, city, user_id, ads_id): drops blacklisted users' clicks, counts the
    rest under `counts`, and adds users who reach `threshold` on one ad and day to `blacklist`.

    The list is built from all clicks, also those of users already on it.
    """
    set_add = set_add_writer(f"{path}/blacklist", ["day", "user_id"])

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        members = df.select("day", "user_id").schema
        listed = read_batches(spark, f"{path}/blacklist", members).where(F.col("batch") < batch_id)
        kept = drop_blacklisted(df, listed, "day", "user_id")
        write_batch(
            click_counts(kept, ["day", "area", "city", "ads_id"]), f"{path}/counts", batch_id
        )
        totals = _increments(df, f"{path}/clicks", ["day", "user_id", "ads_id"], batch_id)
        set_add(totals.where(F.col("n") >= threshold), batch_id)

    return several_passes(write)


def click_cap_writer(
    path: str, keys: Sequence[str], ts: str, order: Sequence[str], cap: int = 100
) -> BatchWriter:
    """The daily click cap on a stream: rows within the cap and one warning row (`over`) per key
    and day go to `rows`. Within a batch clicks count in event-time order.
    """
    groups = [*keys, "day"]

    def write(df: DataFrame, batch_id: int) -> None:
        daily = df.withColumn("day", F.date_format(ts, "yyyy-MM-dd"))
        totals = _increments(daily, f"{path}/seen", groups, batch_id)
        here = read_batches(df.sparkSession, f"{path}/seen", totals.schema)
        before = (
            totals.withColumnRenamed("n", "_total")
            .join(here.where(F.col("batch") == batch_id).drop("batch"), groups)
            .select(*groups, (F.col("_total") - F.col("n")).alias("_before"))
        )
        first = top_per_group(daily, groups, [F.col(c) for c in order], cap + 1, "_rank")
        place = F.col("_before") + F.col("_rank")
        marked = (
            first.join(before, groups)
            .where(place <= cap + 1)
            .withColumn("over", place > cap)
            .select(*df.columns, "day", "over")
        )
        write_batch(marked, f"{path}/rows", batch_id)

    return several_passes(write)
