"""Options for Kafka topics as source and sink. The connector jar comes with the cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_options(
    servers: str, topics: Sequence[str], starting: str = "latest", per_batch: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
    }
    if per_batch:
        options["maxOffsetsPerTrigger"] = str(per_batch)
    return options


def stream_topic(spark: SparkSession, servers: str, *topics: str, **kwargs) -> DataFrame:
    """`value` as text, one row per message."""
    reader = spark.readStream.format("kafka").options(**read_options(servers, topics, **kwargs))
    return reader.load().select(F.col("value").cast("string").alias("value"))
