"""Top-k per group and its report text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import ranked_report


def top_per_group(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """First `k` rows per group. Spark cuts each task's part to k rows before the shuffle."""
    by = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(by)).where(F.col(rank) <= k)


def top_keys(
    counts: DataFrame, groups: Sequence[str], key: str, k: int, n: str = "n"
) -> DataFrame:
    """Keys with the most rows per group; ties go to the smaller key."""
    return top_per_group(counts, groups, [F.col(n).desc(), F.col(key).asc()], k)


def ranked_lists(
    top: DataFrame, groups: Sequence[str], key: str, n: str = "n", name: str = "ranked"
) -> DataFrame:
    """One row per group with its ranked entries as an array; `top` holds at most k rows a group."""
    return top.groupBy(*groups).agg(
        F.array_sort(F.collect_list(F.struct("rank", key, n))).alias(name)
    )


def top_report(top: DataFrame, group: str, key: str, label: str, n: str = "n") -> DataFrame:
    """`group` and `report`: one printed ranking per window."""
    heading = F.date_format(group, "yyyy-MM-dd HH:mm:ss")
    return ranked_lists(top, [group], key, n).select(
        group, ranked_report(heading, F.col("ranked"), label, key, n).alias("report")
    )
