"""Hot items and urls, page views, unique visitors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import is_page_url
from tidemark.operators.counting import average
from tidemark.operators.ranking import top_keys, top_report
from tidemark.operators.visitors import (
    approx_visitors,
    bitmap_visitors,
    sliding_approx_visitors,
    unique_visitors,
)
from tidemark.operators.windowed import sliding_counts, tumbling
from tidemark.plans.common import K_SQL, URL_SQL, behaviors, item, sliding_sql, url_of, views
from tidemark.sources.tables import table


def top_items(spark: SparkSession, sf: str, size: str, slide: str) -> DataFrame:
    counts = sliding_counts(views(behaviors(spark, sf)), "ts", size, slide, ["item_id"])
    return top_keys(counts, ["window_end"], "item_id", 3).select(
        "window_end", "rank", "item_id", "n"
    )


def hot_items(spark: SparkSession, sf: str) -> DataFrame:
    return top_items(spark, sf, "1 hour", "5 minutes")


def hot_items_report(spark: SparkSession, sf: str) -> DataFrame:
    return top_report(top_items(spark, sf, "1 hour", "5 minutes"), "window_end", "item_id", "item")


def page_requests(spark: SparkSession, sf: str) -> DataFrame:
    requests = table(spark, sf, "events").where(F.col("event_type") == "view")
    return requests.select("event_id", "ts", url_of("event_id", item()).alias("url")).where(
        is_page_url(F.col("url"))
    )


def hot_urls(spark: SparkSession, sf: str) -> DataFrame:
    counts = sliding_counts(page_requests(spark, sf), "ts", "10 minutes", "5 seconds", ["url"])
    return top_keys(counts, ["window_end"], "url", 5).select("window_end", "rank", "url", "n")


def page_view(spark: SparkSession, sf: str) -> DataFrame:
    return tumbling(views(behaviors(spark, sf)), "ts", "1 hour").select("window_end", "n")


def unique_visitor(spark: SparkSession, sf: str) -> DataFrame:
    return unique_visitors(views(behaviors(spark, sf)), "ts", "user_id", "1 hour")


def uv_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    return bitmap_visitors(views(behaviors(spark, sf)), "ts", "user_id", "1 hour")


def uv_approx(spark: SparkSession, sf: str) -> DataFrame:
    """Exact visitors beside the sketch: its relative error is held against four deviations."""
    seen = views(behaviors(spark, sf))
    sketch = approx_visitors(seen, "ts", "user_id", "1 hour", RSD).withColumnRenamed("n", "estimate")
    exact = unique_visitors(seen, "ts", "user_id", "1 hour")
    error = F.abs(F.col("estimate") - F.col("n"))
    within = error <= F.greatest(F.lit(1.0), F.lit(4 * RSD) * F.col("n"))
    return exact.join(sketch, "window_end").select("window_end", "n", within.alias("within_bound"))


def uv_sliding_approx(spark: SparkSession, sf: str) -> DataFrame:
    """A sketch per ten minutes, united for each hour that slides by ten minutes; held against the exact counts."""
    seen = views(behaviors(spark, sf)).where("user_id IS NOT NULL")
    sketch = sliding_approx_visitors(seen, "ts", "user_id", "1 hour", "10 minutes").withColumnRenamed("n", "estimate")
    # each user once per ten minutes, then once per hour
    panes = seen.select(F.window("ts", "10 minutes")["start"].alias("ts"), "user_id").distinct()
    exact = panes.groupBy(F.window("ts", "1 hour", "10 minutes").alias("w"), "user_id").agg(F.count("*").alias("times"))
    exact = exact.groupBy(F.col("w.end").alias("window_end")).agg(F.count("*").alias("n"))
    error = F.abs(F.col("estimate") - F.col("n"))
    within = error <= F.greatest(F.lit(1.0), F.lit(4 * RSD) * F.col("n"))
    return exact.join(sketch, "window_end").select("window_end", "n", within.alias("within_bound"))


def avg_value(spark: SparkSession, sf: str) -> DataFrame:
    return average(behaviors(spark, sf), ["behavior"], "item_id").select(
        "behavior", F.round("average", 9).alias("average"), "n"
    )


#: Relative standard deviation of the visitor sketch.
RSD = 0.02

QUERIES = {
    "hot_items": hot_items,
    "hot_items_report": hot_items_report,
    "hot_urls": hot_urls,
    "page_view": page_view,
    "unique_visitor": unique_visitor,
    "uv_bitmap": uv_bitmap,
    "uv_approx": uv_approx,
    "uv_sliding_approx": uv_sliding_approx,
    "avg_value": avg_value,
}

_VIEWS = f"(SELECT event_id, ts, user_id, {K_SQL} AS item_id FROM events WHERE event_type = 'view')"
_PAGES = f"""(SELECT * FROM (SELECT event_id, ts, {URL_SQL} AS url FROM events
               WHERE event_type = 'view')
             WHERE NOT regexp_matches(url, '\\.(css|js|png|ico)$'))"""


def top_sql(counts: str, key: str, k: int) -> str:
    return f"""
    SELECT window_end, CAST(rank AS INTEGER) AS rank, {key}, n FROM (
      SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY n DESC, {key}) AS rank
      FROM ({counts})) WHERE rank <= {k}"""


_HOT_ITEMS = top_sql(sliding_sql(_VIEWS, "item_id", "1 hour", "5 minutes"), "item_id", 3)
HOT_URL_COUNTS = sliding_sql(_PAGES, "url", "10 minutes", "5 seconds")
_HOUR = "time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') + INTERVAL '1 hour'"

SQL = {
    "hot_items": _HOT_ITEMS,
    "hot_items_report": f"""
    SELECT window_end,
           'time: ' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || chr(10)
           || string_agg('No' || rank || ': item=' || item_id || ' views=' || n, chr(10)
                         ORDER BY rank)
           || chr(10) || repeat('=', 37) AS report
    FROM ({_HOT_ITEMS}) GROUP BY window_end""",
    "hot_urls": top_sql(HOT_URL_COUNTS, "url", 5),
    "page_view": f"SELECT {_HOUR} AS window_end, count(*) AS n FROM {_VIEWS} GROUP BY 1",
    "unique_visitor": f"""
    SELECT {_HOUR} AS window_end, count(DISTINCT user_id) AS n FROM {_VIEWS} GROUP BY 1""",
    "uv_approx": f"""
    SELECT {_HOUR} AS window_end, count(DISTINCT user_id) AS n, true AS within_bound FROM {_VIEWS} GROUP BY 1""",
    "uv_sliding_approx": f"""
    SELECT window_end, count(DISTINCT user_id) AS n, true AS within_bound FROM (
      SELECT user_id, unnest(generate_series(time_bucket(INTERVAL '10 minutes', ts, TIMESTAMP '1970-01-01') + INTERVAL '10 minutes',
                                             time_bucket(INTERVAL '10 minutes', ts, TIMESTAMP '1970-01-01') + INTERVAL '60 minutes',
                                             INTERVAL '10 minutes')) AS window_end
      FROM {_VIEWS}) GROUP BY 1""",
    "uv_bitmap": f"""
    SELECT window_end, count(DISTINCT bit) AS n FROM (
      SELECT {_HOUR} AS window_end,
             list_reduce(list_transform(string_split(CAST(user_id AS VARCHAR), ''),
                                        lambda c: CAST(ascii(c) AS BIGINT)),
                         lambda a, c: (a * 61 + c) & ((1 << 28) - 1)) AS bit
      FROM {_VIEWS}) GROUP BY 1""",
    "avg_value": f"""
    SELECT event_type AS behavior, round(avg({K_SQL}), 9) AS average, count(*) AS n
    FROM events GROUP BY 1""",
}
