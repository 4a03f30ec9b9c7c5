"""Unique visitors per window: exact, by bitmap and approximate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.eventtime import epoch_us, from_epoch_us, micros, step_index, time_type
from tidemark.functions.text import visitor_offset
from tidemark.operators.windowed import pane_width, tumbling


def unique_visitors(df: DataFrame, ts: str, user: str, size: str = "1 hour") -> DataFrame:
    """window_end, n. Two grouped steps, so that a busy window is spread over its users.

    The same form runs on a stream, where a distinct aggregate is refused.
    """
    pairs = df.where(F.col(user).isNotNull()).groupBy(
        F.window(ts, size).alias("_window"), F.col(user)
    ).agg(F.count("*").alias("_rows"))
    if df.isStreaming:
        pairs = pairs.groupBy(F.window("_window", size).alias("_window"))
    else:
        pairs = pairs.groupBy("_window")
    return pairs.agg(F.count("*").alias("n")).select(F.col("_window.end").alias("window_end"), "n")


def bitmap_visitors(
    df: DataFrame, ts: str, user: str, size: str = "1 hour", capacity: int = 1 << 28
) -> DataFrame:
    """window_end, n: distinct bit offsets. Colliding users count once, so n never exceeds exact UV.

    The bitmap is held in slices of fixed size, one group per (window, slice).
    """
    hashed = df.where(F.col(user).isNotNull()).select(
        ts, visitor_offset(F.col(user), capacity).alias("_offset")
    )
    slices = (
        hashed.groupBy(
            F.window(ts, size).alias("_window"),
            F.bitmap_bucket_number("_offset").alias("_slice"),
        )
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_offset")).alias("_bits"))
        .select("_window", F.bitmap_count("_bits").alias("_set"))
    )
    return (
        slices.groupBy("_window")
        .agg(F.sum("_set").alias("n"))
        .select(F.col("_window.end").alias("window_end"), "n")
    )


def approx_visitors(
    df: DataFrame, ts: str, user: str, size: str = "1 hour", rsd: float = 0.02
) -> DataFrame:
    """window_end, n from a HyperLogLog sketch with relative deviation `rsd`."""
    return tumbling(df, ts, size, n=F.approx_count_distinct(user, rsd)).select("window_end", "n")


def sliding_approx_visitors(
    df: DataFrame, ts: str, user: str, size: str, slide: str, lg_k: int = 12
) -> DataFrame:
    """window_end, n: sketches of 2^`lg_k` buckets per pane, united for every window that holds the pane.

    Rows are read once, whatever the number of windows: what is copied to windows and shuffled is one sketch per pane.
    The relative deviation is about 1.04 / sqrt(2^lg_k).
    """
    width = pane_width(size, slide)
    panes = (
        df.where(F.col(user).isNotNull() & F.col(ts).isNotNull())
        .groupBy(step_index(epoch_us(ts), width).alias("_pane"))
        .agg(F.hll_sketch_agg(user, lg_k).alias("_sketch"))
    )
    size_us, slide_us = micros(size), micros(slide)
    start = F.col("_pane") * F.lit(width)
    windows = F.sequence(step_index(start - F.lit(size_us), slide_us) + 1, step_index(start, slide_us))
    if slide_us > size_us:  # some panes lie between windows
        panes = panes.where(step_index(start - F.lit(size_us), slide_us) < step_index(start, slide_us))
    united = panes.select("_sketch", F.explode(windows).alias("_i")).groupBy("_i").agg(F.hll_union_agg("_sketch").alias("_sketch"))
    end = F.col("_i") * F.lit(slide_us) + F.lit(size_us)
    return united.select(from_epoch_us(end, time_type(df, ts)).alias("window_end"), F.hll_sketch_estimate("_sketch").alias("n"))
