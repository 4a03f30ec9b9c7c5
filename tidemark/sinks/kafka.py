"""Rows to Kafka messages with a deterministic key, since delivery is at least once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def messages(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`key` and `value` (JSON of the whole row). Equal rows always get equal keys."""
    return df.select(
        F.concat_ws(":", *[F.col(k).cast("string") for k in keys]).alias("key"),
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"),
    )


def line_messages(lines: DataFrame, line: str = "value") -> DataFrame:
    return lines.select(F.sha2(line, 256).alias("key"), F.col(line).alias("value"))


def write_options(servers: str, topic: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
    }


def publish_file(spark: SparkSession, path: str, servers: str, topic: str) -> None:
    """Every line of a file as one message."""
    out = line_messages(spark.read.text(path))
    out.write.format("kafka").options(**write_options(servers, topic)).save()


def stream_to_topic(
    df: DataFrame, keys: Sequence[str], servers: str, topic: str, checkpoint: str
) -> DataStreamWriter:
    return (
        messages(df, keys)
        .writeStream.format("kafka")
        .options(**write_options(servers, topic))
        .option("checkpointLocation", checkpoint)
    )
