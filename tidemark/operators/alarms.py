"""Sensor alarms: jumps, steady rises, rolling minima, freezing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.eventtime import epoch_us, micros
from tidemark.operators.routing import route
from tidemark.operators.sequences import neighbours, running


def temperature_jumps(
    readings: DataFrame,
    sensor: str,
    ts: str,
    order: Sequence[str],
    temperature: str,
    threshold: float = 10.0,
    chunk: str = "1 day",
) -> DataFrame:
    """Readings that differ from the one before by more than `threshold`; never a key's first."""
    seen = neighbours(readings, [sensor], ts, order, [temperature], chunk)
    last, now = F.col(f"prev_{temperature}"), F.col(temperature)
    return seen.where(F.abs(now - last) > threshold).select(
        sensor,
        F.col(ts),
        last.alias("last_temperature"),
        now.alias("temperature"),
        F.lit("change too much").alias("msg"),
    )


def steady_rises(
    readings: DataFrame,
    sensor: str,
    ts: str,
    order: Sequence[str],
    temperature: str,
    least: str = "10 seconds",
    chunk: str = "1 day",
) -> DataFrame:
    """Unbroken rises that span at least `least`: sensor, rise_start, rise_end, readings, msg.

    A run starts at the last reading that was not a rise and ends at its last rising reading.
    """
    seen = neighbours(readings, [sensor], ts, order, [temperature], chunk)
    rising = F.coalesce(F.col(temperature) > F.col(f"prev_{temperature}"), F.lit(False))
    start = F.when(~rising, F.struct(*order))
    runs = running(
        seen.withColumn("_start", start), [sensor], ts, order, {"_run": ("max", "_start")}, chunk
    )
    spans = runs.groupBy(sensor, "_run").agg(
        F.min(ts).alias("rise_start"), F.max(ts).alias("rise_end"), F.count("*").alias("readings")
    )
    return spans.where(
        (F.col("readings") > 1)
        & (epoch_us("rise_end") - epoch_us("rise_start") >= micros(least))
    ).select(
        sensor,
        "rise_start",
        "rise_end",
        "readings",
        F.concat(
            F.lit("sensor "),
            F.col(sensor).cast("string"),
            F.lit(f" temperature kept rising for {least}"),
        ).alias("msg"),
    )


def rolling_minimum(
    readings: DataFrame,
    sensor: str,
    ts: str,
    order: Sequence[str],
    temperature: str,
    chunk: str = "1 day",
) -> DataFrame:
    """One row per reading: sensor, the least temperature so far and the sensor's first time.

    `order` columns of the reading itself come along; as in a keyed running minimum, fields other
    than the minimum keep the values of the first reading (`first_ts`).
    """
    seen = running(
        readings.withColumn("_row", F.struct(*order)),
        [sensor],
        ts,
        order,
        {"min_temperature": ("min", temperature), "_first": ("min", "_row")},
        chunk,
    )
    return seen.select(
        sensor, *[c for c in order], "min_temperature", F.col(f"_first.{ts}").alias("first_ts")
    )


def freezing(
    readings: DataFrame, sensor: str, temperature: str, below: float = 32.0
) -> dict[str, DataFrame]:
    """Side output `freezing` (sensor, msg) and `main` (sensor, temperature, msg)."""
    parts = route(readings, {"freezing": F.col(temperature) < below})
    return {
        "freezing": parts["freezing"].select(sensor, F.lit("freezing").alias("msg")),
        "main": parts["main"].select(sensor, temperature, F.lit("healthy").alias("msg")),
    }
