"""Sensor readings: id = user, temperature = value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.alarms import (
    freezing,
    rolling_minimum,
    steady_rises,
    temperature_jumps,
)
from tidemark.operators.routing import connect, label, select_labels, union_all
from tidemark.operators.windowed import sliding_first_by
from tidemark.plans.common import EVENT_CHUNK
from tidemark.sources.tables import table
from tidemark.streaming.watermarks import mark_late

ORDER = ["ts", "event_id"]


def readings(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id",
        "ts",
        F.concat(F.lit("sensor_"), F.col("user_id").cast("string")).alias("id"),
        F.col("value").alias("temperature"),
    )


def split(spark: SparkSession, sf: str) -> DataFrame:
    return label(readings(spark, sf), {"high": F.col("temperature") > 30}, "low")


def sensor_split(spark: SparkSession, sf: str) -> DataFrame:
    return split(spark, sf).select("event_id", "id", "temperature", "label")


def freezing_route(spark: SparkSession, sf: str) -> DataFrame:
    parts = freezing(readings(spark, sf), "id", "temperature")
    return connect(parts["main"], parts["freezing"])


def sensor_union(spark: SparkSession, sf: str) -> DataFrame:
    labelled = sensor_split(spark, sf)
    return union_all(
        select_labels(labelled, ["high"]),
        select_labels(labelled, ["low"]),
        select_labels(labelled, ["high", "low"]),
    )


def sensor_comap(spark: SparkSession, sf: str) -> DataFrame:
    labelled = split(spark, sf)
    warned = select_labels(labelled, ["high"]).select(
        "id", "temperature", F.lit("test connect").alias("msg")
    )
    healthy = select_labels(labelled, ["low"]).select("id", F.lit("healthy").alias("msg"))
    return connect(warned, healthy)


def sensor_rolling_min(spark: SparkSession, sf: str) -> DataFrame:
    df = readings(spark, sf)
    return rolling_minimum(df, "id", "ts", ORDER, "temperature", EVENT_CHUNK)


def sensor_window_minby(spark: SparkSession, sf: str) -> DataFrame:
    best = sliding_first_by(
        readings(spark, sf),
        "ts",
        "6 hours",
        "1 hour",
        ["id"],
        ["temperature", "ts", "event_id"],
        [],
    )
    return best.select("id", "window_end", "temperature", "ts", "event_id")


def temp_jump(spark: SparkSession, sf: str) -> DataFrame:
    df = readings(spark, sf)
    return temperature_jumps(df, "id", "ts", ORDER, "temperature", 10.0, EVENT_CHUNK)


def temp_rising(spark: SparkSession, sf: str) -> DataFrame:
    df = readings(spark, sf)
    return steady_rises(df, "id", "ts", ORDER, "temperature", "24 hours", EVENT_CHUNK)


def arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """Readings arrive at `ts`; every tenth was taken up to 6 hours before."""
    k = F.get_json_object("props", "$.k").cast("long")
    delay = F.when(F.col("event_id") % 10 == 0, k * 216).otherwise(0)
    return table(spark, sf, "events").select(
        "event_id",
        F.col("ts").alias("arrived"),
        (F.col("ts") - F.make_dt_interval(secs=delay.cast("decimal(18,6)"))).alias("ts"),
    )


def late_split(spark: SparkSession, sf: str) -> DataFrame:
    return mark_late(
        arrivals(spark, sf),
        ts="ts",
        arrival="arrived",
        size="1 hour",
        slide="10 minutes",
        delay="1 minute",
        lateness="10 minutes",
        batch="10 minutes",
    ).select("event_id", "late")


QUERIES = {
    "sensor_split": sensor_split,
    "freezing_route": freezing_route,
    "sensor_union": sensor_union,
    "sensor_comap": sensor_comap,
    "sensor_rolling_min": sensor_rolling_min,
    "sensor_window_minby": sensor_window_minby,
    "temp_jump": temp_jump,
    "temp_rising": temp_rising,
    "late_split": late_split,
}

_READINGS = """(SELECT event_id, ts, 'sensor_' || user_id AS id, value AS temperature
                FROM events)"""
_SPLIT = f"""SELECT event_id, id, temperature,
                    CASE WHEN temperature > 30 THEN 'high' ELSE 'low' END AS label
             FROM {_READINGS}"""
_BY_ID = "OVER (PARTITION BY id ORDER BY ts, event_id)"
_SO_FAR = "OVER (PARTITION BY id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"

SQL = {
    "sensor_split": _SPLIT,
    "freezing_route": f"""
    SELECT id, CASE WHEN temperature >= 32 THEN temperature END AS temperature,
           CASE WHEN temperature < 32 THEN 'freezing' ELSE 'healthy' END AS msg
    FROM {_READINGS}""",
    "sensor_union": f"SELECT * FROM ({_SPLIT}) UNION ALL SELECT * FROM ({_SPLIT})",
    "sensor_comap": f"""
    SELECT id, CASE WHEN temperature > 30 THEN temperature END AS temperature,
           CASE WHEN temperature > 30 THEN 'test connect' ELSE 'healthy' END AS msg
    FROM {_READINGS}""",
    "sensor_rolling_min": f"""
    SELECT id, ts, event_id, min(temperature) {_SO_FAR} AS min_temperature,
           first_value(ts) {_SO_FAR} AS first_ts
    FROM {_READINGS}""",
    "sensor_window_minby": f"""
    SELECT id, window_end, temperature, ts, event_id FROM (
      SELECT *, row_number() OVER (PARTITION BY id, window_end
                                   ORDER BY temperature, ts, event_id) AS r
      FROM (SELECT *, unnest(generate_series(
                     date_trunc('hour', ts) + INTERVAL '1 hour',
                     date_trunc('hour', ts) + INTERVAL '6 hours',
                     INTERVAL '1 hour')) AS window_end
            FROM {_READINGS})) WHERE r = 1""",
    "temp_jump": f"""
    SELECT id, ts, last_temperature, temperature, 'change too much' AS msg
    FROM (SELECT *, lag(temperature) {_BY_ID} AS last_temperature FROM {_READINGS})
    WHERE abs(temperature - last_temperature) > 10""",
    "temp_rising": f"""
    SELECT id, min(ts) AS rise_start, max(ts) AS rise_end, count(*) AS readings,
           'sensor ' || id || ' temperature kept rising for 24 hours' AS msg
    FROM (SELECT *, sum(CASE WHEN temperature > prev THEN 0 ELSE 1 END) {_SO_FAR} AS run
          FROM (SELECT *, lag(temperature) {_BY_ID} AS prev FROM {_READINGS}))
    GROUP BY id, run
    HAVING count(*) > 1 AND max(ts) - min(ts) >= INTERVAL '24 hours'""",
    "late_split": """
    WITH arrivals AS (
      SELECT event_id, ts AS arrived,
             time_bucket(INTERVAL '10 minutes', ts, TIMESTAMP '1970-01-01') AS batch,
             ts - CASE WHEN event_id % 10 = 0
                       THEN CAST(json_extract_string(props, '$.k') AS BIGINT) * 216 ELSE 0 END
                  * INTERVAL '1 second' AS ts
      FROM events),
    marks AS (
      SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING
                                       AND 1 PRECEDING) AS before
      FROM arrivals GROUP BY batch)
    SELECT event_id,
           coalesce(time_bucket(INTERVAL '10 minutes', ts, TIMESTAMP '1970-01-01')
                    + INTERVAL '1 hour' + INTERVAL '10 minutes'
                    <= before - INTERVAL '1 minute', false) AS late
    FROM arrivals JOIN marks USING (batch)""",
}
