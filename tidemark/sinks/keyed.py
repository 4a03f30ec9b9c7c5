"""Tables fed batch by batch from a stream.

Each micro-batch writes one folder `batch=<id>`, overwriting it when the batch is run again after a
failure, so every batch counts once. Upserts append the batch's latest row per key and are merged on
reading, so a batch costs what it brings, not what the table holds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.sinks.days import DayTable, _Files

BatchWriter = Callable[[DataFrame, int], None]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest `order` per key, all columns kept."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*order, *rest)
    best = df.groupBy(*keys).agg(F.max(row).alias("_row"))
    return best.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def batch_writer(path: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> BatchWriter:
    """foreachBatch function: the (transformed) batch goes to its own folder."""

    def write(df: DataFrame, batch_id: int) -> None:
        write_batch(transform(df) if transform else df, path, batch_id)

    return write


def several_passes(writer: BatchWriter) -> BatchWriter:
    """Keeps the batch while `writer` reads it more than once."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            writer(df, batch_id)
        finally:
            df.unpersist()

    return write


def read_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All batches with their id in `batch`; also right when no batch has written yet."""
    spark_schema = StructType([*schema.fields, StructField("batch", LongType())])
    try:
        return spark.read.schema(spark_schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], spark_schema)


def upsert_writer(path: str, keys: Sequence[str], order: Sequence[str]) -> BatchWriter:
    return batch_writer(path, lambda df: latest_per_key(df, keys, order))


def read_upserts(
    spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The current row per key; on equal `order` the later batch wins."""
    rows = read_batches(spark, path, schema)
    return latest_per_key(rows, keys, [*order, "batch"]).drop("batch")


def day_upsert_writer(path: str, keys: Sequence[str], order: Sequence[str], day: str = "day", **options) -> BatchWriter:
    """Keeps the latest row per key and day in a table that `day_upserts` reads; a batch touches its own days only."""

    def write(df: DataFrame, batch_id: int) -> None:
        table = day_upserts(df.sparkSession, path, df.schema, keys, order, day, **options)
        table.add(latest_per_key(df, [day, *keys], order), batch_id)

    return several_passes(write)


def day_upserts(
    spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], order: Sequence[str], day: str = "day", **options
) -> DayTable:
    return DayTable(spark, path, schema, lambda df: latest_per_key(df, [day, *keys], order), day, **options)


def day_set_writer(path: str, members: Sequence[str], day: str = "day", **options) -> BatchWriter:
    """Adds members, of which `day` is one, that no earlier batch has added: to the batch's folder below `path`/new, and
    to the days' sets below `path`/days, of which only the batch's days are read."""

    def write(df: DataFrame, batch_id: int) -> None:
        new = df.select(*members).distinct()
        table = DayTable(df.sparkSession, f"{path}/days", new.schema, lambda x: x.distinct(), day, **options)
        known = table.read(table.days_of(df), before=batch_id)
        same = [new[m].eqNullSafe(known[m]) for m in members]
        fresh = new.join(known, same, "left_anti")
        write_batch(fresh, f"{path}/new", batch_id)
        table.add(read_batches(df.sparkSession, f"{path}/new", new.schema).where(F.col("batch") == batch_id), batch_id)

    return several_passes(write)


def replacing_writer(path: str) -> BatchWriter:
    """Each batch is the whole table, as complete mode gives it: it takes the place of the one before, whose folder is
    removed when the batch after it has been written."""

    def write(df: DataFrame, batch_id: int) -> None:
        write_batch(df, path, batch_id)
        files = _Files(df.sparkSession, path)
        for name in files.names(path):
            if name.startswith("batch=") and int(name[6:]) < batch_id - 1:
                files.remove(f"{path}/{name}")

    return write


def set_add_writer(path: str, members: Sequence[str]) -> BatchWriter:
    """Adds members that no earlier batch has added. All of them are read each time: see `day_set_writer`."""

    def write(df: DataFrame, batch_id: int) -> None:
        new = df.select(*members).distinct()
        known = read_batches(df.sparkSession, path, new.schema).where(F.col("batch") < batch_id)
        write_batch(new.join(known, list(members), "left_anti"), path, batch_id)

    return write
