"""Marketing counts and advertising reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.clicks import (
    area_top_ads,
    build_blacklist,
    click_counts,
    count_fields,
    count_maps,
    drop_blacklisted,
    last_span_by_minute,
    marketing_totals,
    minutes_json,
    sliding_minutes,
    top_ads_json,
)
from tidemark.operators.clicks import marketing_by_channel as by_channel
from tidemark.operators.clicks import marketing_rollup as rollup
from tidemark.operators.patterns import capped_clicks, click_cap
from tidemark.operators.windowed import sliding_counts
from tidemark.plans.common import K_SQL, item, sliding_sql
from tidemark.sinks.keyed import latest_per_key as latest
from tidemark.sources.lines import ads_info
from tidemark.sources.tables import table

CHANNELS = 5


def marketing(spark: SparkSession, sf: str) -> DataFrame:
    """Marketing events: channel = k % 5; errors play uninstalls."""
    return table(spark, sf, "events").select(
        "ts",
        F.concat(F.lit("channel"), (item() % CHANNELS).cast("string")).alias("channel"),
        F.col("event_type").alias("behavior"),
    )


def kept():
    return F.col("behavior") != "error"


def marketing_total(spark: SparkSession, sf: str) -> DataFrame:
    return marketing_totals(marketing(spark, sf), "ts", "1 hour", "10 seconds", kept())


def marketing_total_text(spark: SparkSession, sf: str) -> DataFrame:
    """The start of each window as text."""
    totals = marketing_total(spark, sf)
    return totals.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


def marketing_by_channel(spark: SparkSession, sf: str) -> DataFrame:
    return by_channel(marketing(spark, sf), "ts", "1 hour", "10 seconds", kept())


def marketing_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return rollup(marketing(spark, sf), "ts", "1 hour", "10 seconds", kept())


def places(spark: SparkSession, sf: str) -> DataFrame:
    """user_id, city (nation) and area (region) of every customer."""
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_nationkey"
    )
    nation = table(spark, sf, "nation")
    region = table(spark, sf, "region")
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("user_id", F.col("n_name").alias("city"), F.col("r_name").alias("area"))
    )


def clicks(spark: SparkSession, sf: str) -> DataFrame:
    """Ad clicks before the user's place is known: ad = k."""
    return table(spark, sf, "events").select(
        "event_id",
        "ts",
        "user_id",
        item().alias("ads_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
    )


def placed_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks per user, day and ad, then joined to the place: a busy user is few rows by then."""
    counted = click_counts(clicks(spark, sf), ["user_id", "day", "ads_id"])
    return counted.withColumnRenamed("n", "clicks").join(places(spark, sf), "user_id")


def ads_enrich(spark: SparkSession, sf: str) -> DataFrame:
    raw = clicks(spark, sf).join(places(spark, sf), "user_id").select(
        "event_id",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
        "area",
        "city",
        "user_id",
        "ads_id",
    )
    return ads_info(raw)


def ad_count_by_province(spark: SparkSession, sf: str) -> DataFrame:
    within_cap = capped_clicks(
        table(spark, sf, "events"), ["user_id", "event_type"], "ts", ["ts", "event_id"], 2
    )["main"]
    placed = within_cap.select("user_id", "ts").join(places(spark, sf), "user_id")
    counts = sliding_counts(placed, "ts", "1 hour", "10 seconds", ["area"])
    return counts.select(
        F.date_format("window_end", "yyyy-MM-dd HH:mm:ss").alias("window_end"),
        F.col("area").alias("province"),
        "n",
    )


def ad_click_cap(spark: SparkSession, sf: str) -> DataFrame:
    marked = click_cap(
        table(spark, sf, "events"), ["user_id", "event_type"], "ts", ["ts", "event_id"], 2
    )
    return marked.select("event_id", "user_id", "event_type", "day", "over")


def ad_blacklist(spark: SparkSession, sf: str) -> DataFrame:
    return capped_clicks(
        table(spark, sf, "events"), ["user_id", "event_type"], "ts", ["ts", "event_id"], 2
    )["blacklist"]


def ads_click_count(spark: SparkSession, sf: str) -> DataFrame:
    return click_counts(placed_counts(spark, sf), ["day", "area", "city", "ads_id"], "clicks")


def ads_count_map(spark: SparkSession, sf: str) -> DataFrame:
    return count_fields(ads_click_count(spark, sf), "day", ["area", "city", "ads_id"])


def ads_count_hash(spark: SparkSession, sf: str) -> DataFrame:
    """The fields gathered to maps; what each day's maps hold together."""
    maps = count_maps(ads_count_map(spark, sf))
    sizes = maps.select("hash_key", F.size("fields").cast("long").alias("n"), F.explode(F.map_values("fields")).alias("value"))
    return sizes.groupBy("hash_key").agg(F.count("*").alias("fields"), F.sum(F.col("value").cast("long")).alias("clicks"))


THRESHOLD = 2


def blacklist_build(spark: SparkSession, sf: str) -> DataFrame:
    return build_blacklist(clicks(spark, sf), "day", "user_id", "ads_id", THRESHOLD)


def blacklist_sql_view(spark: SparkSession, sf: str) -> DataFrame:
    """The same list written as SQL over a view that lives as long as the statement."""
    return spark.sql(
        """SELECT day, user_id FROM {clicks}
           GROUP BY day, user_id, ads_id HAVING count(*) >= {least}""",
        clicks=clicks(spark, sf), least=THRESHOLD,
    )


def blacklist_filter(spark: SparkSession, sf: str) -> DataFrame:
    return drop_blacklisted(
        clicks(spark, sf), blacklist_build(spark, sf), "day", "user_id"
    ).select("event_id", "day", "user_id", "ads_id")


def area_top3_ads(spark: SparkSession, sf: str) -> DataFrame:
    top = area_top_ads(placed_counts(spark, sf), "day", "area", "ads_id", 3, "clicks")
    return top.select("day", "area", "rank", "ads_id", "n")


def area_top3_json(spark: SparkSession, sf: str) -> DataFrame:
    return top_ads_json(area_top3_ads(spark, sf), "day", "area", "ads_id")


SPAN = "6 hours"


def report_time(df: DataFrame, ts: str):
    """The end of the last minute with a row, as one value."""
    last = F.date_trunc("minute", F.max(ts)) + F.expr("interval 1 minute")
    return df.agg(last.cast(df.schema[ts].dataType).alias("as_of")).scalar()


def recent_minutes(spark: SparkSession, sf: str) -> DataFrame:
    as_of = report_time(table(spark, sf, "events"), "ts")
    return last_span_by_minute(clicks(spark, sf), "ts", "ads_id", as_of, SPAN)


def last_hour_by_minute(spark: SparkSession, sf: str) -> DataFrame:
    lists = F.transform("minutes", lambda m: F.concat_ws("=", m["hm"], m["n"].cast("string")))
    return recent_minutes(spark, sf).select("ads_id", F.concat_ws(",", lists).alias("minutes"))


def last_hour_json(spark: SparkSession, sf: str) -> DataFrame:
    return minutes_json(recent_minutes(spark, sf), "ads_id")


def last_hour_sliding(spark: SparkSession, sf: str) -> DataFrame:
    """A report every ten minutes, each of the hour before it."""
    lists = sliding_minutes(clicks(spark, sf), "ts", "ads_id", "1 hour", "10 minutes")
    return minutes_json(lists, "ads_id", "report")


def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    readings = table(spark, sf, "events").select("user_id", "ts", "event_id", "value")
    return latest(readings, ["user_id"], ["ts", "event_id"])


QUERIES = {
    "marketing_total": marketing_total,
    "marketing_total_text": marketing_total_text,
    "marketing_by_channel": marketing_by_channel,
    "marketing_rollup": marketing_rollup,
    "ads_enrich": ads_enrich,
    "ad_count_by_province": ad_count_by_province,
    "ad_click_cap": ad_click_cap,
    "ad_blacklist": ad_blacklist,
    "ads_click_count": ads_click_count,
    "ads_count_map": ads_count_map,
    "ads_count_hash": ads_count_hash,
    "blacklist_build": blacklist_build,
    "blacklist_sql_view": blacklist_sql_view,
    "blacklist_filter": blacklist_filter,
    "area_top3_ads": area_top3_ads,
    "area_top3_json": area_top3_json,
    "last_hour_by_minute": last_hour_by_minute,
    "last_hour_json": last_hour_json,
    "last_hour_sliding": last_hour_sliding,
    "latest_per_key": latest_per_key,
}

_MARKETING = f"""(SELECT ts, 'channel' || ({K_SQL} % {CHANNELS}) AS channel, event_type AS behavior
                 FROM events WHERE event_type <> 'error')"""
_BY_CHANNEL = sliding_sql(_MARKETING, "channel, behavior", "1 hour", "10 seconds")
_PLACES = """(SELECT c_custkey AS user_id, n_name AS city, r_name AS area
              FROM customer JOIN nation ON c_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey)"""
_CLICKS = f"""(SELECT event_id, ts, user_id, {K_SQL} AS ads_id,
                      strftime(ts, '%Y-%m-%d') AS day FROM events)"""
_CAPPED = """(SELECT *, strftime(ts, '%Y-%m-%d') AS day,
                     row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)
                                        ORDER BY ts, event_id) AS rank
              FROM events)"""
_COUNTS = f"""SELECT day, area, city, ads_id, count(*) AS n
              FROM {_CLICKS} JOIN {_PLACES} USING (user_id) GROUP BY ALL"""
_BLACKLIST = f"""SELECT day, user_id FROM {_CLICKS}
                 GROUP BY day, user_id, ads_id HAVING count(*) >= {THRESHOLD}"""
_TOP3 = f"""SELECT day, area, CAST(rank AS INTEGER) AS rank, ads_id, n FROM (
              SELECT day, area, ads_id, count(*) AS n,
                     row_number() OVER (PARTITION BY day, area
                                        ORDER BY count(*) DESC, ads_id) AS rank
              FROM {_CLICKS} JOIN {_PLACES} USING (user_id) GROUP BY day, area, ads_id)
            WHERE rank <= 3"""
_MINUTES = f"""SELECT ads_id, strftime(ts, '%H:%M') AS hm, count(*) AS n FROM {_CLICKS}
               WHERE ts >= (SELECT date_trunc('minute', max(ts)) + INTERVAL '1 minute' - INTERVAL '{SPAN}' FROM events)
               GROUP BY ALL"""

SQL = {
    "marketing_total": f"""
    SELECT window_start, 'total channel' AS channel, 'total behavior' AS behavior, n
    FROM ({sliding_sql(_MARKETING, "", "1 hour", "10 seconds")})""",
    "marketing_total_text": f"""
    SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, 'total channel' AS channel, 'total behavior' AS behavior, n
    FROM ({sliding_sql(_MARKETING, "", "1 hour", "10 seconds")})""",
    "marketing_by_channel": f"SELECT window_start, channel, behavior, n FROM ({_BY_CHANNEL})",
    "marketing_rollup": f"""
    SELECT window_start, coalesce(channel, 'total channel') AS channel,
           coalesce(behavior, 'total behavior') AS behavior, CAST(sum(n) AS BIGINT) AS n
    FROM ({_BY_CHANNEL})
    GROUP BY GROUPING SETS ((window_start, channel, behavior), (window_start, channel),
                            (window_start))""",
    "ads_enrich": f"""
    SELECT event_id, epoch_us(ts) // 1000 AS ts_ms, area, city, user_id, ads_id,
           date_trunc('millisecond', ts) AS ts, day AS day_string,
           strftime(ts, '%H:%M') AS hm_string
    FROM {_CLICKS} JOIN {_PLACES} USING (user_id)""",
    "ad_count_by_province": f"""
    SELECT strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, area AS province, n FROM (
      {sliding_sql(f"(SELECT ts, area FROM {_CAPPED} JOIN {_PLACES} USING (user_id) WHERE rank <= 2)",
                   "area", "1 hour", "10 seconds")})""",
    "ad_click_cap": f"""
    SELECT event_id, user_id, event_type, day, rank > 2 AS over FROM {_CAPPED} WHERE rank <= 3""",
    "ad_blacklist": f"""
    SELECT user_id, event_type, day, 'Click over 2 times today' AS msg
    FROM {_CAPPED} WHERE rank = 3""",
    "ads_click_count": _COUNTS,
    "ads_count_map": f"""
    SELECT 'date:area:city:ads:' || day AS hash_key, area || ':' || city || ':' || ads_id AS field,
           CAST(n AS VARCHAR) AS value
    FROM ({_COUNTS})""",
    "ads_count_hash": f"""
    SELECT 'date:area:city:ads:' || day AS hash_key, count(*) AS fields, CAST(sum(n) AS BIGINT) AS clicks
    FROM ({_COUNTS}) GROUP BY day""",
    "blacklist_build": _BLACKLIST,
    "blacklist_sql_view": _BLACKLIST,
    "blacklist_filter": f"""
    SELECT event_id, day, user_id, ads_id FROM {_CLICKS}
    WHERE (day, user_id) NOT IN ({_BLACKLIST})""",
    "area_top3_ads": _TOP3,
    "area_top3_json": f"""
    SELECT day, area,
           '[' || string_agg('{{"' || ads_id || '":' || n || '}}', ',' ORDER BY rank) || ']'
             AS top_ads
    FROM ({_TOP3}) GROUP BY day, area""",
    "last_hour_by_minute": f"""
    SELECT ads_id, string_agg(hm || '=' || n, ',' ORDER BY hm) AS minutes
    FROM ({_MINUTES}) GROUP BY ads_id""",
    "last_hour_json": f"""
    SELECT ads_id,
           '[' || string_agg('{{"' || hm || '":' || n || '}}', ',' ORDER BY hm) || ']' AS minutes
    FROM ({_MINUTES}) GROUP BY ads_id""",
    "last_hour_sliding": f"""
    SELECT ads_id, report, '[' || string_agg('{{"' || hm || '":' || n || '}}', ',' ORDER BY minute) || ']' AS minutes FROM (
      SELECT ads_id, minute, strftime(minute, '%H:%M') AS hm, n,
             unnest(generate_series(time_bucket(INTERVAL '10 minutes', minute, TIMESTAMP '1970-01-01') + INTERVAL '10 minutes',
                                    time_bucket(INTERVAL '10 minutes', minute, TIMESTAMP '1970-01-01') + INTERVAL '60 minutes',
                                    INTERVAL '10 minutes')) AS report
      FROM (SELECT ads_id, date_trunc('minute', ts) AS minute, count(*) AS n FROM {_CLICKS} GROUP BY ALL))
    GROUP BY ads_id, report""",
    "latest_per_key": """
    SELECT user_id, ts, event_id, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
      FROM events) WHERE r = 1""",
}
