"""Event-time arithmetic: intervals, epoch microseconds and window numbers.

`timestamp_ntz` columns stay zone-free in batch. Streams need `timestamp` for watermarks, so they
are cast on entry and back on exit (the session zone is pinned to UTC, which keeps the value).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

_UNIT_US = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def micros(interval: str) -> int:
    """Microseconds in a fixed-length interval such as "10 minutes" or "-15 seconds"."""
    found = re.fullmatch(r"\s*(-?\d+)\s+([a-z]+?)s?\s*", interval.lower())
    if not found or found.group(2) not in _UNIT_US:
        raise ValueError(f"not a fixed-length interval: {interval!r}")
    return int(found.group(1)) * _UNIT_US[found.group(2)]


def interval_text(us: int) -> str:
    return f"{us} microseconds"


def epoch_us(ts: Column | str) -> Column:
    """Microseconds since the epoch of a timestamp or timestamp_ntz column."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(column.cast("timestamp"))


# Far enough before the epoch for every timestamp (some 3,000 years).
_FAR_US = 10**17


def step_index(us: Column, width_us: int) -> Column:
    """Number of the epoch-aligned step of `width_us` that holds `us` (floor, also below zero).

    `div` cuts towards zero, so the value is moved above zero for it. It is named only once, since a
    filter would compute each mention anew.
    """
    steps_before = _FAR_US // width_us + 1
    moved = us + F.lit(steps_before * width_us)
    return F.call_function("div", moved, F.lit(width_us)) - F.lit(steps_before)


def from_epoch_us(us: Column, like: DataType) -> Column:
    """Timestamp of the same type as the column the microseconds came from."""
    return F.timestamp_micros(us).cast(like)


def time_type(df: DataFrame, ts: str) -> DataType:
    return df.schema[ts].dataType


def to_stream_time(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp") for c in columns})


def to_table_time(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})
