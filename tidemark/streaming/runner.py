"""Running a stream over what is there now, and reading back what it wrote.

End of stream: a watermark stops at the greatest event time minus the delay, so the last windows and
timers stay open. `closed_by` names the cut that a table must apply to be compared with a stream
that ran to its end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.functions.eventtime import epoch_us, micros
from tidemark.session import use_rocksdb, work_dir
from tidemark.sinks.keyed import BatchWriter, batch_writer, latest_per_key, read_batches


def start(
    df: DataFrame,
    writer: BatchWriter,
    checkpoint: str,
    mode: str = "append",
    every: str | None = None,
) -> StreamingQuery:
    """Starts a query that hands each micro-batch to `writer`, every `every` or over what is there."""
    use_rocksdb(df.sparkSession)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(writer)
        .trigger(**trigger)
        .start()
    )


def console(df: DataFrame, mode: str = "append", name: str | None = None) -> StreamingQuery:
    """Prints every row of every micro-batch without cutting long values; `name` labels the query."""
    folder = work_dir(df.sparkSession, "console")
    writer = (
        df.writeStream.outputMode(mode)
        .format("console")
        .option("truncate", "false")
        .option("numRows", 2**31 - 1)
        .option("checkpointLocation", f"{folder}/checkpoint")
    )
    return (writer.queryName(name) if name else writer).start()


def run_to_table(
    df: DataFrame,
    label: str,
    mode: str = "append",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    schema: StructType | str | None = None,
    writer: Callable[[str], BatchWriter] | None = None,
) -> DataFrame:
    """Runs over the available input; the rows of all batches with their `batch` id.

    `transform` is applied to every batch before it is written, and `schema` is that of its result.
    """
    spark = df.sparkSession
    folder = work_dir(spark, label)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    write = writer(f"{folder}/rows") if writer else batch_writer(f"{folder}/rows", transform)
    start(df, write, f"{folder}/checkpoint", mode).awaitTermination()
    return read_batches(spark, f"{folder}/rows", schema or df.schema)


def last_batch(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Complete and update mode repeat a key in later batches; keeps the last row of each."""
    return latest_per_key(rows, keys, ["batch"]).drop("batch")


def closed_by(window_end: str, max_ts: Column, delay: str) -> Column:
    """True for windows that a watermark of `max_ts` minus `delay` has closed."""
    return epoch_us(window_end) <= epoch_us(max_ts) - F.lit(micros(delay))
