"""Advertising and marketing reports over click records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.eventtime import epoch_us, from_epoch_us, interval_text, micros, step_index, time_type
from tidemark.functions.text import json_pairs
from tidemark.operators.ranking import ranked_lists, top_keys
from tidemark.operators.windowed import pane_width, sliding_counts


def click_counts(ads: DataFrame, keys: Sequence[str], weight: str | None = None) -> DataFrame:
    """`keys`, n. `weight` holds the number of clicks when the input is counted already."""
    n = F.sum(weight) if weight else F.count("*")
    return ads.groupBy(*keys).agg(n.alias("n"))


def build_blacklist(
    ads: DataFrame, day: str, user: str, ad: str, threshold: int = 100
) -> DataFrame:
    """(day, user) of every ad the user clicked at least `threshold` times that day.

    A user over the threshold on several ads is listed once per ad; the set sink removes repeats.
    """
    return (
        click_counts(ads, [day, user, ad]).where(F.col("n") >= threshold).select(day, user)
    )


def drop_blacklisted(ads: DataFrame, blacklist: DataFrame, day: str, user: str) -> DataFrame:
    """Clicks of users who are not on the list of the click's own day."""
    return ads.join(blacklist.select(day, user).distinct(), [day, user], "left_anti")


def area_top_ads(
    ads: DataFrame, day: str, area: str, ad: str, k: int = 3, weight: str | None = None
) -> DataFrame:
    """day, area, ad, n, rank: the `k` most clicked ads of each day and area."""
    return top_keys(click_counts(ads, [day, area, ad], weight), [day, area], ad, k)


def top_ads_json(top: DataFrame, day: str, area: str, ad: str) -> DataFrame:
    """day, area, top_ads: the ranked ads as a JSON list of {ad: n}."""
    lists = ranked_lists(top, [day, area], ad)
    return lists.select(day, area, json_pairs(F.col("ranked"), ad, "n").alias("top_ads"))


def last_span_by_minute(
    ads: DataFrame,
    ts: str,
    ad: str,
    as_of: Column,
    span: str = "1 hour",
    weight: str | None = None,
) -> DataFrame:
    """ad, minutes: array of (hm, n) in minute order, for clicks in the `span` before `as_of`.

    `span` must not exceed a day, since minutes are named HH:mm. `weight` holds the number of clicks
    when the input is counted already.
    """
    if micros(span) > micros("1 day"):
        raise ValueError("minutes of more than a day share their names")
    recent = ads.where(
        (F.col(ts) >= as_of - F.expr(f"interval {span}")) & (F.col(ts) < as_of)
    )
    named = recent.withColumn("hm", F.date_format(ts, "HH:mm"))
    counts = click_counts(named, [ad, "hm"], weight)
    return counts.groupBy(ad).agg(
        F.array_sort(F.collect_list(F.struct("hm", "n"))).alias("minutes")
    )


def sliding_minutes(
    ads: DataFrame, ts: str, ad: str, size: str = "1 hour", slide: str = "5 seconds", pane: str = "1 minute", chunk: int = 4096
) -> DataFrame:
    """`ad`, report, minutes: for the end of every sliding window with clicks, the clicks per `pane` in order.

    A list changes only where a pane enters or leaves, so clicks are counted per pane first, and lists are made at these
    places by an ordered frame over the panes of the last `size`; windows between two of them have the list of the first.
    A group is one ad in `chunk` windows. `slide` divides `size` and, with it, is a multiple of `pane` or a part of it.
    """
    size_us, slide_us, pane_us = micros(size), micros(slide), micros(pane)
    if size_us % slide_us or size_us % pane_us or size_us > micros("1 day"):
        raise ValueError("slide and pane must divide size, which is a day at most")
    width = size_us // slide_us
    chunk = max(chunk, 2 * width)
    like, start = time_type(ads, ts), F.col("_pane") * F.lit(pane_us)
    panes = click_counts(ads.where(F.col(ts).isNotNull()).withColumn("_pane", step_index(epoch_us(ts), pane_us)), [ad, "_pane"])
    # a window holds a pane if it holds its begin
    panes = panes.select(
        ad,
        (step_index(start - F.lit(size_us), slide_us) + 1).alias("_first"),
        F.struct(F.col("_pane").alias("pane"), F.date_format(from_epoch_us(start, like), "HH:mm").alias("hm"), "n").alias("_entry"),
    )
    nothing = F.lit(None).cast(panes.schema["_entry"].dataType)
    edges = F.array(
        F.struct(F.col("_first").alias("at"), F.col("_entry").alias("entry")),
        F.struct((F.col("_first") + width).alias("at"), nothing.alias("entry")),
    )
    chunks = F.sequence(step_index(F.col("_first"), chunk), step_index(F.col("_first") + width - 1, chunk))
    rows = panes.select(ad, F.explode(chunks).alias("_chunk"), "*").select(ad, "_chunk", F.explode(edges).alias("_edge")).select(ad, "_chunk", "_edge.*")
    in_order = Window.partitionBy(ad, "_chunk").orderBy("at")
    held = F.array_sort(F.collect_list("entry").over(in_order.rangeBetween(-(width - 1), 0)))
    runs = rows.select(ad, "_chunk", "at", held.alias("_held"), F.lead("at").over(in_order).alias("_until"))
    low = F.greatest("at", F.col("_chunk") * F.lit(chunk))
    high = F.least("_until", (F.col("_chunk") + 1) * F.lit(chunk)) - 1
    runs = runs.where(F.size("_held") > 0).select(ad, "_held", low.alias("_low"), high.alias("_high")).where("_low <= _high")
    reports = runs.select(ad, "_held", F.explode(F.sequence("_low", "_high")).alias("_i"))
    report = from_epoch_us(F.col("_i") * F.lit(slide_us) + F.lit(size_us), like)
    return reports.select(ad, report.alias("report"), F.transform("_held", lambda x: F.struct(x["hm"].alias("hm"), x["n"].alias("n"))).alias("minutes"))


def minutes_json(minutes: DataFrame, *keys: str) -> DataFrame:
    return minutes.select(*keys, json_pairs(F.col("minutes"), "hm", "n").alias("minutes"))


def count_fields(counts: DataFrame, day: str, parts: Sequence[str], n: str = "n") -> DataFrame:
    """Counts as fields of one hash per day: hash_key, field (`area:city:ad`), value."""
    return counts.select(
        F.concat(F.lit("date:area:city:ads:"), F.col(day)).alias("hash_key"),
        F.concat_ws(":", *parts).alias("field"),
        F.col(n).cast("string").alias("value"),
    )


def count_maps(fields: DataFrame, shards: int = 64) -> DataFrame:
    """Fields gathered to maps: hash_key, shard, fields. `shards` bounds the size of one map."""
    shard = F.pmod(F.xxhash64("field"), F.lit(shards)).cast("int").alias("shard")
    return fields.groupBy("hash_key", shard).agg(
        F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("fields")
    )


def marketing_totals(events: DataFrame, ts: str, size: str, slide: str, kept: Column) -> DataFrame:
    """window_start, channel, behavior, n over everything that is `kept`."""
    counts = sliding_counts(events.where(kept), ts, size, slide)
    return counts.select(
        "window_start",
        F.lit("total channel").alias("channel"),
        F.lit("total behavior").alias("behavior"),
        "n",
    )


def marketing_by_channel(
    events: DataFrame, ts: str, size: str, slide: str, kept: Column
) -> DataFrame:
    counts = sliding_counts(events.where(kept), ts, size, slide, ["channel", "behavior"])
    return counts.select("window_start", "channel", "behavior", "n")


def marketing_rollup(
    events: DataFrame, ts: str, size: str, slide: str, kept: Column
) -> DataFrame:
    """Counts per (channel, behavior), per channel and in total, in one pass over the events.

    Panes are counted once and rolled up, which makes few rows; the windows of all three levels are then swept together.
    """
    pane = F.window(ts, interval_text(pane_width(size, slide))).alias("_pane")
    panes = events.where(kept).groupBy(pane, "channel", "behavior").agg(F.count("*").alias("n"))
    panes = panes.select(F.col("_pane.start").alias("_at"), "channel", "behavior", "n")
    at, channel, behavior = F.col("_at"), F.col("channel"), F.col("behavior")
    levels = panes.groupingSets([[at, channel, behavior], [at, channel], [at]], at, channel, behavior).agg(
        F.sum("n").alias("n"),
        F.grouping("channel").alias("_all_channels"),
        F.grouping("behavior").alias("_all_behaviors"),
    )
    keys = ["_all_channels", "_all_behaviors", "channel", "behavior"]
    counts = sliding_counts(levels, "_at", size, slide, keys, weight="n")
    return counts.select(
        "window_start",
        F.when(F.col("_all_channels") == 1, "total channel").otherwise(channel).alias("channel"),
        F.when(F.col("_all_behaviors") == 1, "total behavior").otherwise(behavior).alias("behavior"),
        F.col("total").alias("n"),
    )
