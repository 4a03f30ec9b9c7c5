"""Failed logins: errors play failures, all other events successes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.bursts import failure_bursts
from tidemark.operators.patterns import failed_pairs, match_next
from tidemark.plans.common import EVENT_CHUNK
from tidemark.sources.tables import table

ORDER = ["ts", "event_id"]


def logins(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")


def failed():
    return F.col("event_type") == "error"


def login_fail_pairs(spark: SparkSession, sf: str) -> DataFrame:
    events = logins(spark, sf)
    return failed_pairs(events, "user_id", "ts", ORDER, failed(), "6 hours", EVENT_CHUNK)


def login_fail_cep(spark: SparkSession, sf: str) -> DataFrame:
    """Three adjacent steps: two failures and then a success within the time."""
    steps = [("first", failed()), ("second", failed()), ("third", ~failed())]
    events = logins(spark, sf)
    matched = match_next(
        events, ["user_id"], "ts", ORDER, steps, "12 hours", ["event_id"], EVENT_CHUNK
    )
    return matched.select("user_id", "first_event_id", "second_event_id", "third_event_id")


def login_fail_burst(spark: SparkSession, sf: str) -> DataFrame:
    events = logins(spark, sf)
    return failure_bursts(events, "user_id", "ts", ORDER, failed(), 2, "12 hours", EVENT_CHUNK)


QUERIES = {
    "login_fail_pairs": login_fail_pairs,
    "login_fail_cep": login_fail_cep,
    "login_fail_burst": login_fail_burst,
}

_BY_USER = "OVER (PARTITION BY user_id ORDER BY ts, event_id)"

SQL = {
    "login_fail_pairs": f"""
    SELECT user_id, prev_ts AS first_fail_time, ts AS last_fail_time,
           'login fail in 6 hours' AS warning_msg
    FROM (SELECT *, lag(ts) {_BY_USER} AS prev_ts, lag(event_type) {_BY_USER} AS prev_type
          FROM events)
    WHERE event_type = 'error' AND prev_type = 'error' AND ts - prev_ts < INTERVAL '6 hours'""",
    "login_fail_cep": f"""
    SELECT user_id, event_id AS first_event_id, id2 AS second_event_id, id3 AS third_event_id
    FROM (SELECT *, lead(event_type, 1) {_BY_USER} AS type2, lead(event_type, 2) {_BY_USER} AS type3,
                 lead(event_id, 1) {_BY_USER} AS id2, lead(event_id, 2) {_BY_USER} AS id3,
                 lead(ts, 2) {_BY_USER} AS ts3
          FROM events)
    WHERE event_type = 'error' AND type2 = 'error' AND type3 <> 'error'
      AND ts3 - ts < INTERVAL '12 hours'""",
    "login_fail_burst": """
    WITH RECURSIVE seq AS (
      SELECT user_id, ts, event_type = 'error' AS failed,
             row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos
      FROM events),
    ends AS (  -- for each failure: the success that ends its burst, or else the end of its time
      SELECT f.user_id, f.pos, f.ts,
             min(s.pos) FILTER (WHERE NOT s.failed AND s.pos > f.pos) AS ok_pos,
             max(s.pos) AS last_pos
      FROM seq f JOIN seq s ON s.user_id = f.user_id AND s.pos >= f.pos
                           AND s.ts <= f.ts + INTERVAL '12 hours'
      WHERE f.failed GROUP BY ALL),
    hops AS (
      SELECT e.*, (SELECT min(n.pos) FROM seq n WHERE n.user_id = e.user_id AND n.failed
                   AND n.pos > coalesce(e.ok_pos, e.last_pos)) AS next_pos
      FROM ends e),
    anchors AS (
      SELECT user_id, min(pos) AS pos FROM seq WHERE failed GROUP BY user_id
      UNION ALL
      SELECT h.user_id, h.next_pos FROM anchors a JOIN hops h USING (user_id, pos)
      WHERE h.next_pos IS NOT NULL)
    SELECT h.user_id, h.ts AS first_fail_time, max(s.ts) AS last_fail_time, count(*) AS failures,
           'login fail in 12 hours for ' || count(*) || ' times' AS warning_msg
    FROM anchors JOIN hops h USING (user_id, pos)
    JOIN seq s ON s.user_id = h.user_id AND s.pos BETWEEN h.pos AND h.last_pos AND s.failed
    WHERE h.ok_pos IS NULL
    GROUP BY h.user_id, h.pos, h.ts HAVING count(*) >= 2""",
}
