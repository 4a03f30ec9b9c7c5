"""Tables played back as streams in the order of their event times.

A table that is written by key holds years of event time in any of its files; read as it lies, it would need a
watermark that waits for years, and no state would ever be dropped. Here it is written once more, slice of event time
after slice, and streamed a slice to a micro-batch: from batch to batch event time only grows. Every slice has equally
many files, which as many tasks write, about one for each that reads the slice. A log that arrives in order needs none
of this.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.eventtime import epoch_us
from tidemark.session import work_dir
from tidemark.sinks.days import _Files

#: Micro-batches of a playback.
SLICES = 4

Edge = datetime.datetime | int


def slice_edges(times: Sequence[DataFrame], slices: int = SLICES) -> list[Edge]:
    """Event times that cut the rows of all `times`, each of one time column, into about equal slices."""
    us = times[0].select(epoch_us(times[0].columns[0]).alias("us"))
    for more in times[1:]:
        us = us.unionByName(more.select(epoch_us(more.columns[0]).alias("us")))
    cuts = us.approxQuantile("us", [i / slices for i in range(1, slices)], 0.01)
    return [datetime.datetime(1970, 1, 1) + datetime.timedelta(microseconds=int(x)) for x in sorted(set(cuts))]


def played_back(df: DataFrame, ts: str, edges: Sequence[Edge], label: str = "playback") -> DataFrame:
    """`df` as a stream, the rows before the first of `edges` (and those without a time) in its first micro-batch.

    `ts` may also be a number that grows with time, such as that of a log's lines, and `edges` numbers.

    Streams with equal `edges` keep step with each other: a slice without rows is a micro-batch without rows.
    """
    spark, folder = df.sparkSession, work_dir(df.sparkSession, label)
    is_time = all(isinstance(x, datetime.datetime) for x in edges)
    kind = "timestamp_ntz" if is_time else "bigint"
    time = F.col(ts).cast(kind)
    files = max(1, -(-df.rdd.getNumPartitions() // (len(edges) + 1)))
    # files are streamed by their age, so the slices are written one after the other
    for i, (low, high) in enumerate(zip([None, *edges], [*edges, None]), 1):
        inside = F.lit(True) if low is None else time >= F.lit(low).cast(kind)
        if high is not None:
            inside = inside & (time < F.lit(high).cast(kind))
        if low is None:
            inside = F.coalesce(inside, F.lit(True))
        df.where(inside).repartition(files).write.mode("append").parquet(folder)
        written = sum(name.startswith("part-") for name in _Files(spark, folder).names(folder))
        for _ in range(written, i * files):  # tasks without rows write no file: empty ones take their places
            df.limit(0).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(folder)
