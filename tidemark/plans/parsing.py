"""Text lines made of the events, parsed back to records; some lines are malformed on purpose."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.plans.common import K_SQL, URL_SQL, item, url_of
from tidemark.sources import lines as src
from tidemark.sources.tables import table

SECONDS_SQL = "CAST(floor(epoch(ts)) AS BIGINT)"


def seconds():
    return F.unix_timestamp(F.col("ts").cast("timestamp"))


def parse_delimited(spark: SparkSession, sf: str) -> DataFrame:
    """User-behavior lines; every 11th has a word where the item number should be."""
    k = F.when(F.col("event_id") % 11 == 0, F.lit("none")).otherwise(item().cast("string"))
    lines = table(spark, sf, "events").select(
        "event_id",
        F.concat_ws(
            ",",
            F.col("user_id").cast("string"),
            k,
            (F.col("event_id") % 100).cast("string"),
            "event_type",
            seconds().cast("string"),
        ).alias("value"),
    )
    return src.parse_delimited(lines, schemas.USER_BEHAVIOR, keep=("event_id",))


def parse_trimmed(spark: SparkSession, sf: str) -> DataFrame:
    """Sensor lines with a blank after each comma; every 13th lacks its last field."""
    temperature = F.when(F.col("event_id") % 13 != 0, F.col("value").cast("string"))
    lines = table(spark, sf, "events").select(
        "event_id",
        F.concat_ws(
            ", ",
            F.concat(F.lit("sensor_"), F.col("user_id").cast("string")),
            seconds().cast("string"),
            temperature,
        ).alias("value"),
    )
    parsed = src.parse_delimited(
        lines, schemas.SENSOR_READING, trim=True, keep=("event_id",)
    )
    return src.good_rows(parsed)


def parse_access_log(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "events").select(
        "event_id",
        F.concat_ws(
            " ",
            F.concat(F.lit("10.0.0."), (F.col("user_id") % 256).cast("string")),
            F.col("user_id").cast("string"),
            F.lit("-"),
            F.date_format("ts", src.ACCESS_LOG_TIME),
            F.lit("+0000"),
            F.when(F.col("event_type") == "view", "GET").otherwise("POST"),
            url_of("event_id", item()),
        ).alias("value"),
    )
    parsed = src.good_rows(src.parse_access_log(lines, keep=("event_id",)))
    return parsed.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def parse_ads(spark: SparkSession, sf: str) -> DataFrame:
    """Ad lines `ms,area,city,user,ad`, with area and city as numbered names."""
    lines = table(spark, sf, "events").select(
        "event_id",
        F.concat_ws(
            ",",
            F.unix_millis(F.col("ts").cast("timestamp")).cast("string"),
            F.concat(F.lit("area"), (F.col("user_id") % 5).cast("string")),
            F.concat(F.lit("city"), (F.col("user_id") % 25).cast("string")),
            F.col("user_id").cast("string"),
            item().cast("string"),
        ).alias("value"),
    )
    parsed = src.parse_delimited(lines, schemas.ADS_LINE, keep=("event_id",))
    return src.ads_info(src.good_rows(parsed))


QUERIES = {
    "parse_delimited": parse_delimited,
    "parse_trimmed": parse_trimmed,
    "parse_access_log": parse_access_log,
    "parse_ads": parse_ads,
}

SQL = {
    "parse_delimited": f"""
    SELECT event_id,
           CASE WHEN ok THEN user_id END AS user_id, CASE WHEN ok THEN k END AS item_id,
           CASE WHEN ok THEN CAST(event_id % 100 AS INTEGER) END AS category_id,
           CASE WHEN ok THEN event_type END AS behavior, CASE WHEN ok THEN s END AS ts_s,
           CASE WHEN NOT ok THEN user_id || ',none,' || (event_id % 100) || ',' || event_type
                                 || ',' || s END AS _corrupt
    FROM (SELECT *, {K_SQL} AS k, {SECONDS_SQL} AS s, event_id % 11 <> 0 AS ok FROM events)""",
    "parse_trimmed": f"""
    SELECT event_id, 'sensor_' || user_id AS id, {SECONDS_SQL} AS ts_s, value AS temperature
    FROM events WHERE event_id % 13 <> 0""",
    "parse_access_log": f"""
    SELECT event_id, '10.0.0.' || (user_id % 256) AS ip, CAST(user_id AS VARCHAR) AS user_id,
           date_trunc('second', ts) AS ts,
           CASE event_type WHEN 'view' THEN 'GET' ELSE 'POST' END AS method, {URL_SQL} AS url
    FROM events""",
    "parse_ads": f"""
    SELECT event_id, epoch_us(ts) // 1000 AS ts_ms, 'area' || (user_id % 5) AS area,
           'city' || (user_id % 25) AS city, CAST(user_id AS VARCHAR) AS user_id,
           CAST({K_SQL} AS VARCHAR) AS ads_id, date_trunc('millisecond', ts) AS ts,
           strftime(ts, '%Y-%m-%d') AS day_string, strftime(ts, '%H:%M') AS hm_string
    FROM events""",
}
