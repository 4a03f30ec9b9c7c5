"""Word counts over texts and over timed words (word = event type)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.counting import running_count as counted
from tidemark.operators.counting import timed_lines, timed_words
from tidemark.operators.counting import word_count as count_words
from tidemark.operators.windowed import sliding_counts
from tidemark.plans.common import EVENT_CHUNK, sliding_sql
from tidemark.session import work_dir
from tidemark.sources.lines import read_lines
from tidemark.sources.tables import table


def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return count_words(table(spark, sf, "documents"), "text")


def running_count(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "ts", "event_type")
    rows = counted(events, ["event_type"], "ts", ["ts", "event_id"], EVENT_CHUNK)
    return rows.select("event_id", "event_type", "n")


def event_lines(spark: SparkSession, sf: str) -> DataFrame:
    """event_id and a line `time,word word` with the event type and its user."""
    return table(spark, sf, "events").select(
        "event_id",
        F.concat_ws(
            "",
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
            F.lit(","),
            "event_type",
            F.lit(" user"),
            (F.col("user_id") % 3).cast("string"),
        ).alias("value"),
    )


def timed(spark: SparkSession, sf: str) -> DataFrame:
    """(word, ts) parsed from the lines."""
    return timed_words(event_lines(spark, sf))


def line_files(spark: SparkSession, sf: str) -> str:
    """A folder of text files with the lines, in a few of which the time is damaged."""
    folder = work_dir(spark, "lines")
    damaged = F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("at "), "value")).otherwise(F.col("value"))
    event_lines(spark, sf).select(damaged.alias("value")).write.text(folder)
    return folder


def text_file_words(spark: SparkSession, sf: str) -> DataFrame:
    """Words of text files by the hour of their line, and the lines without a time, which belong to no hour."""
    parsed = timed_lines(read_lines(spark, line_files(spark, sf)))
    hour = F.date_format("ts", "yyyy-MM-dd HH")
    words_ = parsed.where("ts is not null").select(hour.alias("hour"), F.explode(F.split("text", " ")).alias("word"))
    bad = parsed.where("_corrupt is not null").select(F.lit(None).cast("string").alias("hour"), F.col("_corrupt").alias("word"))
    return words_.unionByName(bad).groupBy("hour", "word").agg(F.count("*").alias("n"))


def counts(words: DataFrame, size: str, slide: str) -> DataFrame:
    return sliding_counts(words, "ts", size, slide, ["word"]).select(
        "word",
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "n",
    )


def windowed_word_count(spark: SparkSession, sf: str) -> DataFrame:
    return counts(timed(spark, sf), "10 minutes", "2 minutes")


def event_words(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("ts", F.col("event_type").alias("word"))


def window_10m_3m(spark: SparkSession, sf: str) -> DataFrame:
    return counts(event_words(spark, sf), "10 minutes", "3 minutes")


def reduce_by_window(spark: SparkSession, sf: str) -> DataFrame:
    words = event_words(spark, sf).withColumn("one", F.lit(1).cast("long"))
    sums = sliding_counts(words, "ts", "12 seconds", "8 seconds", ["word"], "one")
    return sums.select("word", "window_end", "total")


QUERIES = {
    "word_count": word_count,
    "text_file_words": text_file_words,
    "running_count": running_count,
    "windowed_word_count": windowed_word_count,
    "window_10m_3m": window_10m_3m,
    "reduce_by_window": reduce_by_window,
}

WORD_COUNT_SQL = """
    SELECT word, count(*) AS n
    FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
    WHERE word <> '' GROUP BY word"""
_WORDS = "(SELECT ts, event_type AS word FROM events)"
TIMED_WORDS_SQL = """(SELECT date_trunc('second', ts) AS ts,
                      unnest([event_type, 'user' || (user_id % 3)]) AS word FROM events)"""

SQL = {
    "word_count": WORD_COUNT_SQL,
    "running_count": """
    SELECT event_id, event_type,
           count(*) OVER (PARTITION BY event_type ORDER BY ts, event_id
                          ROWS UNBOUNDED PRECEDING) AS n
    FROM events""",
    "windowed_word_count": sliding_sql(TIMED_WORDS_SQL, "word", "10 minutes", "2 minutes"),
    "text_file_words": """
    SELECT hour, word, count(*) AS n FROM (
      SELECT CASE WHEN event_id % 50 <> 0 THEN strftime(ts, '%Y-%m-%d %H') END AS hour,
             unnest(CASE WHEN event_id % 50 = 0
                         THEN ['at ' || strftime(ts, '%Y-%m-%d %H:%M:%S') || ',' || event_type || ' user' || (user_id % 3)]
                         ELSE [event_type, 'user' || (user_id % 3)] END) AS word
      FROM events) GROUP BY hour, word""",
    "window_10m_3m": sliding_sql(_WORDS, "word", "10 minutes", "3 minutes"),
    "reduce_by_window": f"""
    SELECT word, window_end, n AS total
    FROM ({sliding_sql(_WORDS, "word", "12 seconds", "8 seconds")})""",
}
