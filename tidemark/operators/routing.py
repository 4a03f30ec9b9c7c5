"""Splitting rows into named outputs and bringing streams together."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def label(
    df: DataFrame, rules: Mapping[str, Column], otherwise: str, name: str = "label"
) -> DataFrame:
    """Adds the name of the first rule a row fulfils, else `otherwise`."""
    column = F
    for value, rule in rules.items():
        column = column.when(rule, value)
    return df.withColumn(name, column.otherwise(otherwise))


def select_labels(df: DataFrame, wanted: Sequence[str], name: str = "label") -> DataFrame:
    return df.where(F.col(name).isin(list(wanted)))


def route(df: DataFrame, rules: Mapping[str, Column], main: str = "main") -> dict[str, DataFrame]:
    """Side outputs: one DataFrame per rule, and `main` for the rows that fulfil none."""
    labelled = label(df, rules, main, "_route")
    return {
        name: labelled.where(F.col("_route") == name).drop("_route") for name in [*rules, main]
    }


def union_all(*frames: DataFrame) -> DataFrame:
    """Bag union by column name: a row that is in two inputs is in the result twice."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def connect(left: DataFrame, right: DataFrame) -> DataFrame:
    """Union of two differently shaped inputs; columns one side lacks are null there."""
    return left.unionByName(right, allowMissingColumns=True)
