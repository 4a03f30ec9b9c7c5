"""Views of the given tables as event logs, and SQL fragments that several checks share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import table


#: Chunks of event time for operators that need a key's rows in order: `events` are dense, orders sparse.
EVENT_CHUNK = "1 day"
ORDER_CHUNK = "60 days"


def item(props: str = "props"):
    """The item number in an event's properties."""
    return F.get_json_object(props, "$.k").cast("long")


def behaviors(spark: SparkSession, sf: str) -> DataFrame:
    """User behavior: item = k; views play page views."""
    return table(spark, sf, "events").select(
        "event_id", "ts", "user_id", item().alias("item_id"), F.col("event_type").alias("behavior")
    )


def views(df: DataFrame) -> DataFrame:
    return df.where(F.col("behavior") == "view")


# Page urls: every seventh event asks for each of four static files.
URL_SUFFIXES = {0: ".css", 1: ".js", 2: ".png", 3: ".ico"}


def url_of(event_id: str, k) -> F.Column:
    suffix = F
    for rest, text in URL_SUFFIXES.items():
        suffix = suffix.when(F.col(event_id) % 7 == rest, text)
    return F.concat(F.lit("/p/"), k.cast("string"), suffix.otherwise(""))


K_SQL = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
URL_SQL = (
    f"'/p/' || {K_SQL} || CASE event_id % 7 WHEN 0 THEN '.css' WHEN 1 THEN '.js' "
    "WHEN 2 THEN '.png' WHEN 3 THEN '.ico' ELSE '' END"
)


def sliding_sql(source: str, keys: str, size: str, slide: str, ts: str = "ts") -> str:
    """Counts per key and sliding window by copying every row to each of its windows."""
    lead = f"{keys}, " if keys else ""
    return f"""
      SELECT {lead}window_start, window_start + INTERVAL '{size}' AS window_end, count(*) AS n
      FROM (
        SELECT *, unnest(generate_series(
                 time_bucket(INTERVAL '{slide}', {ts} - INTERVAL '{size}',
                             TIMESTAMP '1970-01-01') + INTERVAL '{slide}',
                 time_bucket(INTERVAL '{slide}', {ts}, TIMESTAMP '1970-01-01'),
                 INTERVAL '{slide}')) AS window_start
        FROM {source})
      GROUP BY {lead}window_start"""
