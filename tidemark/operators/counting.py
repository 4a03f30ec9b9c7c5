"""Word counts, running counts and averages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import words
from tidemark.operators.sequences import running


def word_count(lines: DataFrame, text: str) -> DataFrame:
    """word, n. Works on tables and (update or complete mode) on streams."""
    return lines.select(words(F.col(text)).alias("word")).groupBy("word").agg(
        F.count("*").alias("n")
    )


def timed_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """(ts, text, _corrupt) of `yyyy-MM-dd HH:mm:ss,w1 w2` lines; a line without a time is kept whole in `_corrupt`."""
    parts = F.split(F.col(line), ",", 2)
    ts = F.try_to_timestamp(F.get(parts, 0), F.lit("yyyy-MM-dd HH:mm:ss"))
    return lines.select(
        ts.alias("ts"), F.when(ts.isNotNull(), F.get(parts, 1)).alias("text"), F.when(ts.isNull(), F.col(line)).alias("_corrupt")
    )


def timed_words(lines: DataFrame, line: str = "value") -> DataFrame:
    """(word, ts) rows of the lines that have a time; `timed_lines` also gives the others."""
    return timed_lines(lines, line).where("ts is not null").select(words(F.col("text")).alias("word"), "ts")


def running_count(
    df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], chunk: str = "1 day"
) -> DataFrame:
    """Every input row with the number of rows of its key so far, itself included."""
    return running(
        df.withColumn("_one", F.lit(1).cast("long")), keys, ts, order, {"n": ("sum", "_one")}, chunk
    ).drop("_one")


def average(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Mean of an integer column; sum and count are kept apart until the last division."""
    return df.groupBy(*keys).agg(F.avg(value).alias("average"), F.count(value).alias("n"))
