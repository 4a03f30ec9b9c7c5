"""Text lines to typed records.

A malformed line does not fail the job: it comes out with `_corrupt` set to the line and null
fields, so the caller can keep, count or drop it (`good_rows`, `bad_rows`).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One `value` row per line."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder)


def parse_delimited(
    lines: DataFrame,
    schema: StructType,
    line: str = "value",
    delimiter: str = ",",
    trim: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Fields of `schema` by position, plus `_corrupt`; further fields on the line are ignored."""
    parts = F.split(F.col(line), re.escape(delimiter), -1)
    fields, bad = [], F.col(line).isNull() | (F.size(parts) < len(schema))
    for i, field in enumerate(schema):
        text = F.get(parts, F.lit(i))
        if trim:
            text = F.trim(text)
        value = text if isinstance(field.dataType, StringType) else text.try_cast(field.dataType)
        fields.append((field.name, value))
        if not isinstance(field.dataType, StringType):
            bad = bad | value.isNull()
    return _with_corrupt(lines, line, fields, bad, keep)


# Positions of the fields in a space-separated access-log line, and its time format.
ACCESS_LOG_FIELDS = {"ip": 0, "user_id": 1, "time": 3, "method": 5, "url": 6}
ACCESS_LOG_TIME = "dd/MM/yyyy:HH:mm:ss"


def parse_access_log(
    lines: DataFrame, line: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """ip, user_id, ts, method, url and `_corrupt`."""
    parts = F.split(F.col(line), " ")
    part = {name: F.trim(F.get(parts, F.lit(i))) for name, i in ACCESS_LOG_FIELDS.items()}
    ts = F.try_to_timestamp(part["time"], F.lit(ACCESS_LOG_TIME))
    fields = [
        ("ip", part["ip"]),
        ("user_id", part["user_id"]),
        ("ts", ts),
        ("method", part["method"]),
        ("url", part["url"]),
    ]
    bad = ts.isNull() | part["url"].isNull()
    return _with_corrupt(lines, line, fields, bad, keep)


def ads_info(ads: DataFrame) -> DataFrame:
    """Ad records (ts_ms, area, city, user_id, ads_id) with timestamp, day and minute texts."""
    ts = F.timestamp_millis("ts_ms")
    return ads.withColumns(
        {
            "ts": ts.cast("timestamp_ntz"),
            "day_string": F.date_format(ts, "yyyy-MM-dd"),
            "hm_string": F.date_format(ts, "HH:mm"),
        }
    )


def _with_corrupt(
    lines: DataFrame, line: str, fields: list[tuple[str, Column]], bad: Column, keep
) -> DataFrame:
    ok = ~F.coalesce(bad, F.lit(True))
    return lines.select(
        *keep,
        *[F.when(ok, value).alias(name) for name, value in fields],
        F.when(~ok, F.coalesce(F.col(line), F.lit(""))).alias("_corrupt"),
    )


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where("_corrupt is null").drop("_corrupt")


def bad_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where("_corrupt is not null").select("_corrupt")
