"""Small helpers of this subpackage: intermediate tables in the shared folder, and plain column names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import work_dir


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` as a table below the shared folder of `spark.checkpoint.dir`.

    Later jobs read the files, so a lost executor costs no recomputation, and Spark plans joins with the
    files' true size: it broadcasts what is below its threshold and sorts and merges the rest.
    """
    path = work_dir(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def labels(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")
