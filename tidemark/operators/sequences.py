"""Row order within a key, without one task per key.

`lag`, running sums and the like need a key's rows in order. Partitioning by key alone would put a
hot key into one task, so every operator here works on (key, chunk of time) and brings in what it
needs from outside the chunk:

* `with_context` copies rows near a chunk's edge to the neighbour, for patterns of bounded length;
* `neighbours` adds the nearest row before and after the chunk, for look-back of any length;
* `running` adds one row that holds the aggregate of all earlier chunks.

The last two build on one small row per (key, chunk), so their per-key step is bounded by time, not
by the number of events. `chunk` is a width in event time; results do not depend on it. Choose it so that a hot key's rows of one chunk fit a task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.eventtime import epoch_us, micros, step_index

_AGGS = {"sum": F.sum, "min": F.min, "max": F.max}


def with_context(
    df: DataFrame, ts: str, reach: str, chunk: str, only=None, before: bool = False
) -> DataFrame:
    """Adds `_chunk` and `_home`; rows in a chunk's first `reach` also go to the chunk before.

    With `before` it is the last `reach` that goes to the chunk after. `only` limits which rows are
    copied. Copies have `_home` false and serve as context only.
    """
    reach_us = micros(reach)
    width = max(micros(chunk), reach_us)
    us = epoch_us(ts)
    home = step_index(us, width)
    other = step_index(us + reach_us if before else us - reach_us, width)
    if only is not None:
        other = F.when(F.coalesce(only, F.lit(False)), other).otherwise(home)
    return (
        df.where(F.col(ts).isNotNull())
        .withColumns({"_first": F.least(home, other), "_last": F.greatest(home, other)})
        .withColumn("_chunk", F.explode(F.sequence("_first", "_last")))
        .withColumn("_home", F.col("_chunk") == (F.col("_first") if before else F.col("_last")))
        .drop("_first", "_last")
    )


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    order: Sequence[str],
    fields: Sequence[str],
    chunk: str = "1 day",
    sides: Sequence[str] = ("prev",),
) -> DataFrame:
    """Adds prev_<field> and/or next_<field>: values of the adjacent rows of the same key.

    `order` must be total within a key and start with `ts`.
    """
    source = df.withColumn("_chunk", step_index(epoch_us(ts), micros(chunk)))
    carried = list(dict.fromkeys([*order, *fields]))
    row = F.struct(*carried)
    ends = source.groupBy(*keys, "_chunk").agg(F.min(row).alias("_low"), F.max(row).alias("_high"))
    over_chunks = Window.partitionBy(*keys).orderBy("_chunk")
    bring = []
    if "prev" in sides:
        bring.append(F.lag("_high").over(over_chunks))
    if "next" in sides:
        bring.append(F.lead("_low").over(over_chunks))
    markers = (
        ends.select(*keys, "_chunk", F.array_compact(F.array(*bring)).alias("_rows"))
        .select(*keys, "_chunk", F.explode("_rows").alias("_row"))
        .select(
            *keys, "_chunk", *[F.col(f"_row.{c}").alias(c) for c in carried if c not in keys]
        )
        .withColumn("_marker", F.lit(True))
    )
    rows = source.withColumn("_marker", F.lit(False)).unionByName(
        markers, allowMissingColumns=True
    )
    in_order = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    added = {}
    for field in fields:
        if "prev" in sides:
            added[f"prev_{field}"] = F.lag(field).over(in_order)
        if "next" in sides:
            added[f"next_{field}"] = F.lead(field).over(in_order)
    return rows.withColumns(added).where("not _marker").drop("_chunk", "_marker")


def running(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    order: Sequence[str],
    aggs: Mapping[str, tuple[str, str]],
    chunk: str = "1 day",
    include_current: bool = True,
) -> DataFrame:
    """Adds running aggregates per key in `order`: {name: ("sum" | "min" | "max", column)}.

    With `include_current` false a row sees only the rows before it (null on a key's first).
    """
    source = df.withColumn("_chunk", step_index(epoch_us(ts), micros(chunk)))
    parts = source.groupBy(*keys, "_chunk").agg(
        *[_AGGS[how](column).alias(name) for name, (how, column) in aggs.items()]
    )
    earlier = (
        Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    columns = {column for _, column in aggs.values()}
    if len(columns) != len(aggs):
        raise ValueError("each running aggregate needs a column of its own")
    markers = (
        parts.select(
            *keys,
            "_chunk",
            F.count("*").over(earlier).alias("_chunks"),
            *[
                _AGGS[how](name).over(earlier).alias(column)
                for name, (how, column) in aggs.items()
            ],
        )
        .where("_chunks > 0")
        .drop("_chunks")
        .withColumn("_marker", F.lit(True))
    )
    rows = source.withColumn("_marker", F.lit(False)).unionByName(
        markers, allowMissingColumns=True
    )
    so_far = (
        Window.partitionBy(*keys, "_chunk")
        .orderBy(F.col("_marker").desc(), *order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow if include_current else -1)
    )
    return (
        rows.withColumns(
            {name: _AGGS[how](column).over(so_far) for name, (how, column) in aggs.items()}
        )
        .where("not _marker")
        .drop("_chunk", "_marker")
    )
