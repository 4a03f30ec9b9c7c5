"""Tumbling and sliding event-time aggregates.

A sliding window of size S and slide D holds S/D copies of every row when it is expanded directly.
Here rows are first counted per pane (gcd of S and D). Where S/D is small, pane counts are copied to
their windows and summed. Where it is large, the pane counts of a table become two edges each, "enters at window i" and "leaves at window j", and a running sum over the edges yields
every window's count: the shuffle carries two rows per pane whatever S/D is. The running sum is cut
into chunks of `span` windows, so one key never needs one task; an edge pair is clipped to each
chunk it touches. Streams chain two windowed aggregates (panes, then windows over panes).
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.eventtime import (
    epoch_us,
    from_epoch_us,
    interval_text,
    micros,
    step_index,
    time_type,
)

# Up to this many windows per row, copying pane counts costs less than ordering their edges.
_FEW_COPIES = 8


def tumbling(
    df: DataFrame, ts: str, size: str, keys: Sequence[str] = (), **aggs: Column
) -> DataFrame:
    """`keys`, window_start, window_end and the given aggregates (default `n`, the row count)."""
    aggs = aggs or {"n": F.count("*")}
    return (
        df.groupBy(F.window(ts, size).alias("_window"), *keys)
        .agg(*[a.alias(name) for name, a in aggs.items()])
        .select(
            *keys,
            F.col("_window.start").alias("window_start"),
            F.col("_window.end").alias("window_end"),
            *aggs,
        )
    )


def pane_width(size: str, slide: str) -> int:
    return gcd(micros(size), micros(slide))


def sliding_counts(
    df: DataFrame,
    ts: str,
    size: str,
    slide: str,
    keys: Sequence[str] = (),
    weight: str | None = None,
    span: int = 4096,
) -> DataFrame:
    """Rows per window and key: `keys`, window_start, window_end, n (and `total` of `weight`).

    `weight` must be an integer or decimal column; sums of doubles would not cancel exactly.
    Windows without rows are absent, as in any event-time window.
    """
    if df.isStreaming:
        return _sliding_counts_stream(df, ts, size, slide, keys, weight)
    size_us, slide_us, pane_us = micros(size), micros(slide), pane_width(size, slide)
    span = max(span, 2 * -(-size_us // slide_us))
    like = time_type(df, ts)
    totals = {"n": F.count("*")}
    if weight:
        totals["total"] = F.sum(weight)
        totals["_weights"] = F.count(weight)  # a window whose weights are all null has no total
    pane_start = F.col("_pane") * F.lit(pane_us)
    panes = (
        df.where(F.col(ts).isNotNull())
        .groupBy(*keys, step_index(epoch_us(ts), pane_us).alias("_pane"))
        .agg(*[a.alias(name) for name, a in totals.items()])
        .withColumn("_first", step_index(pane_start - F.lit(size_us), slide_us) + 1)
        .withColumn("_last", step_index(pane_start, slide_us))
    )
    if slide_us > size_us:  # some panes lie between windows
        panes = panes.where("_first <= _last")
    starts = F.col("_index") * F.lit(slide_us)
    if size_us <= _FEW_COPIES * slide_us:
        runs = panes.withColumn("_index", F.explode(F.sequence("_first", "_last")))
        counts = runs.groupBy(*keys, "_index").agg(*[F.sum(t).alias(t) for t in totals])
    else:
        counts = _swept(panes, keys, list(totals), span)
    result = {"n": F.col("n")}
    if weight:
        result["total"] = F.when(F.col("_weights") > 0, F.col("total"))
    return counts.select(
        *keys,
        from_epoch_us(starts, like).alias("window_start"),
        from_epoch_us(starts + F.lit(size_us), like).alias("window_end"),
        *[c.alias(name) for name, c in result.items()],
    )


def _swept(panes: DataFrame, keys: Sequence[str], totals: Sequence[str], span: int) -> DataFrame:
    """`keys`, _index and `totals` of every window with rows, by a running sum over pane edges."""
    chunked = panes.withColumn(
        "_chunk",
        F.explode(
            F.sequence(step_index(F.col("_first"), span), step_index(F.col("_last"), span))
        ),
    )
    chunk_start = F.col("_chunk") * F.lit(span)
    enters = F.struct(
        F.greatest("_first", chunk_start).alias("at"), *[F.col(t).alias(t) for t in totals]
    )
    leaves = F.struct(
        F.least(F.col("_last") + 1, chunk_start + F.lit(span)).alias("at"),
        *[(-F.col(t)).alias(t) for t in totals],
    )
    edges = chunked.select(*keys, "_chunk", F.explode(F.array(enters, leaves)).alias("_edge"))
    in_order = Window.partitionBy(*keys, "_chunk").orderBy("_edge.at")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = edges.select(
        *keys,
        F.col("_edge.at").alias("_from"),
        F.lead("_edge.at").over(in_order).alias("_until"),
        *[F.sum(f"_edge.{t}").over(so_far).alias(t) for t in totals],
    ).where("n > 0 and _until > _from")
    return runs.select(
        *keys, *totals, F.explode(F.sequence("_from", F.col("_until") - 1)).alias("_index")
    )


def _sliding_counts_stream(df, ts, size, slide, keys, weight):
    pane = interval_text(pane_width(size, slide))
    totals = {"n": F.count("*")}
    if weight:
        totals["total"] = F.sum(weight)
    panes = df.groupBy(F.window(ts, pane).alias("_pane"), *keys).agg(
        *[a.alias(name) for name, a in totals.items()]
    )
    return (
        panes.groupBy(F.window("_pane", size, slide).alias("_window"), *keys)
        .agg(*[F.sum(t).alias(t) for t in totals])
        .select(
            *keys,
            F.col("_window.start").alias("window_start"),
            F.col("_window.end").alias("window_end"),
            *totals,
        )
    )


def sliding_first_by(
    df: DataFrame,
    ts: str,
    size: str,
    slide: str,
    keys: Sequence[str],
    order: Sequence[str],
    fields: Sequence[str],
) -> DataFrame:
    """The record with the least `order` per key and sliding window (whole record, ties by order).

    A minimum has no inverse. In a table, a window is the end of one block of its own length and the beginning of the
    next, and is the lesser of the two minima that run to the first's end and from the second's begin: see `_least_of_blocks`.
    """
    record = F.struct(*order, *[f for f in fields if f not in order])
    names = list(dict.fromkeys([*order, *fields]))
    known = df.where(F.col(order[0]).isNotNull())
    if df.isStreaming:
        pane = interval_text(pane_width(size, slide))
        panes = known.groupBy(F.window(ts, pane).alias("_pane"), *keys).agg(F.min(record).alias("_best"))
        best = panes.groupBy(F.window("_pane", size, slide).alias("_window"), *keys).agg(F.min("_best").alias("_best"))
        ends = [F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end")]
        return best.select(*keys, *ends, *[F.col(f"_best.{f}").alias(f) for f in names])
    size_us, slide_us, pane_us = micros(size), micros(slide), pane_width(size, slide)
    panes = (
        known.where(F.col(ts).isNotNull())
        .groupBy(*keys, step_index(epoch_us(ts), pane_us).alias("_pane"))
        .agg(F.min(record).alias("_best"))
    )
    best = _least_of_blocks(panes, keys, size_us // pane_us, slide_us // pane_us)
    like, start = time_type(df, ts), F.col("_start") * F.lit(pane_us)
    return best.select(
        *keys,
        from_epoch_us(start, like).alias("window_start"),
        from_epoch_us(start + F.lit(size_us), like).alias("window_end"),
        *[F.col(f"_best.{f}").alias(f) for f in names],
    )


def _least_of_blocks(panes: DataFrame, keys: Sequence[str], size: int, slide: int) -> DataFrame:
    """`keys`, _start, _best for every window of `size` panes that begins at a multiple of `slide` and has rows.

    Windows are grouped by the block of `size` panes that they begin in. A pane p goes to its own block, whose windows
    hold it as long as they begin at p or before, and to the block before, whose windows hold it from p - size + 1 on.
    So two rows per pane are shuffled, whatever `size` / `slide` is, and a group is one block of one key.
    """
    pane, block = F.col("_pane"), step_index(F.col("_pane"), size)
    leaves = F.struct(block.alias("block"), (pane + 1).alias("at"), F.col("_best").alias("old"), F.lit(None).cast(panes.schema["_best"].dataType).alias("new"))
    enters = F.struct((block - 1).alias("block"), (pane - size + 1).alias("at"), F.lit(None).cast(panes.schema["_best"].dataType).alias("old"), F.col("_best").alias("new"))
    edges = panes.select(*keys, F.explode(F.array(leaves, enters)).alias("_e")).select(*keys, "_e.*")
    group = Window.partitionBy(*keys, "block")
    # from the end: what has not left yet, with and without the row's own place; from the begin: what has entered
    down, up = group.orderBy(F.desc("at")), group.orderBy("at")
    runs = edges.select(
        *keys,
        "block",
        "at",
        F.min("old").over(down.rangeBetween(Window.unboundedPreceding, -1)).alias("_left"),
        F.min("old").over(down.rangeBetween(Window.unboundedPreceding, Window.currentRow)).alias("_whole"),
        F.min("new").over(up.rangeBetween(Window.unboundedPreceding, Window.currentRow)).alias("_entered"),
        F.lag("at").over(up).alias("_before"),
        F.lead("at").over(up).alias("_until"),
    )
    begin, end = F.col("block") * F.lit(size), (F.col("block") + 1) * F.lit(size)
    here = F.struct(F.col("at").alias("since"), F.least(F.coalesce("_until", end), end).alias("until"), F.least("_left", "_entered").alias("best"))
    first = F.struct(begin.alias("since"), F.col("at").alias("until"), F.col("_whole").alias("best"))
    spans = runs.select(*keys, F.explode(F.when(F.col("_before").isNull(), F.array(first, here)).otherwise(F.array(here))).alias("_s"))
    low = F.ceil(F.col("_s.since") / F.lit(slide)).cast("long")
    high = F.ceil(F.col("_s.until") / F.lit(slide)).cast("long") - 1
    spans = spans.where(F.col("_s.best").isNotNull()).select(*keys, F.col("_s.best").alias("_best"), low.alias("_low"), high.alias("_high"))
    starts = spans.where("_low <= _high").withColumn("_start", F.explode(F.sequence("_low", "_high")))
    return starts.select(*keys, (F.col("_start") * F.lit(slide)).alias("_start"), "_best")
