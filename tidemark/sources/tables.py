"""Parquet tables of a folder, as tables and as streams, and in-memory rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


#: Files of a table that one micro-batch reads at most.
FILES_PER_BATCH = 64


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream_table(
    spark: SparkSession, folder: str, name: str, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """The same table as a stream of bounded micro-batches. The path may be one file or a folder of files."""
    reader = spark.readStream.schema(table(spark, folder, name).schema)
    # a file stream wants a folder or a pattern; this pattern matches the one name
    return reader.option("maxFilesPerTrigger", files_per_batch).parquet(f"{folder}/{name}.parque[t]")


def collection(spark: SparkSession, rows: Iterable, schema: StructType | str) -> DataFrame:
    """Rows held by the caller; for a stream, write them to a folder and read that."""
    return spark.createDataFrame(list(rows), schema)
