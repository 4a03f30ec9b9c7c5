"""Tables that a stream keeps by day, and that do not age: a batch reads and writes its own days only.

Each batch adds a folder per day that it brings rows of. A manifest per batch names the live folders of every day. Once a
day has more than `keep` folders, the batch writes them as one, and its manifest names that one instead. Folders that
neither this batch's manifest nor the one before names are removed: the one before is what the batch starts from if it is
run again.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


class _Files:
    """The file system of a path: local, HDFS or an object store, as Spark sees it."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, path: str) -> list[str]:
        folder = self._path(path)
        return [x.getPath().getName() for x in self.fs.listStatus(folder)] if self.fs.exists(folder) else []

    def read(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """The whole text or nothing: a new name is given to a file once it is complete."""
        part = self._path(f"{path}.part")
        out = self.fs.create(part, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.fs.delete(self._path(path), False)
        self.fs.rename(part, self._path(path))

    def remove(self, path: str) -> None:
        self.fs.delete(self._path(path), True)


class DayTable:
    """Rows with a `day` (a string such as 2024-05-31, or null), kept below `path`.

    `merge` makes the table's rows from those that several batches have added, such as the latest per key or sums; it must
    give the same whether it is applied at once or in steps. `days_kept` days are kept, counted back from the last one.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: StructType, merge: Callable[[DataFrame], DataFrame],
        day: str = "day", keep: int = 4, days_kept: int | None = None,
    ):
        self.spark, self.path, self.schema, self.merge, self.day = spark, path, schema, merge, day
        self.keep, self.days_kept, self.files = keep, days_kept, _Files(spark, path)

    def _manifests(self) -> list[int]:
        return sorted(int(x[:-5]) for x in self.files.names(f"{self.path}/manifests") if x.endswith(".json"))

    def _manifest(self, before: int | None) -> dict[str, list[str]]:
        """Live folders by day, as the last batch, or the last one below `before`, left them."""
        known = [x for x in self._manifests() if before is None or x < before]
        return json.loads(self.files.read(f"{self.path}/manifests/{known[-1]}.json")) if known else {}

    def _rows(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{x}" for x in folders])

    def read(self, days: Sequence[str | None] | None = None, before: int | None = None) -> DataFrame:
        """The merged rows of `days` (all if not given), as the last batch (below `before`) left them."""
        live = self._manifest(before)
        wanted = live if days is None else [_NO_DAY if d is None else d for d in days]
        return self.merge(self._rows([x for d in wanted for x in live.get(d, [])]))

    def days_of(self, df: DataFrame) -> list[str | None]:
        """The days of a batch."""
        return [r[0] for r in df.select(self.day).distinct().collect()]

    def add(self, df: DataFrame, batch_id: int) -> None:
        """Adds the batch's rows. Run again, it starts from the same state and puts the same in place."""
        earlier = self._manifest(batch_id)
        live = {d: list(x) for d, x in earlier.items()}
        self._write(df, f"batch={batch_id}")
        for name in self.files.names(f"{self.path}/batch={batch_id}"):
            if name.startswith("_day="):
                live.setdefault(name[5:], []).append(f"batch={batch_id}/{name}")
        if self.days_kept is not None:
            newest = sorted((d for d in live if d != _NO_DAY), reverse=True)[: self.days_kept]
            live = {d: x for d, x in live.items() if d in newest}
        long = [d for d, x in live.items() if len(x) > self.keep]
        if long:
            self._write(self.merge(self._rows([x for d in long for x in live[d]])), f"merged={batch_id}")
            live |= {d: [f"merged={batch_id}/_day={d}"] for d in long}
        self.files.write(f"{self.path}/manifests/{batch_id}.json", json.dumps(live))
        self._clean(batch_id, {x for folders in (*live.values(), *earlier.values()) for x in folders})

    def _write(self, df: DataFrame, name: str) -> None:
        rows = df.select(*self.schema.names).withColumn("_day", F.col(self.day))
        rows.repartition("_day").write.mode("overwrite").partitionBy("_day").parquet(f"{self.path}/{name}")

    def _clean(self, batch_id: int, used: set[str]) -> None:
        tops = {x.split("/")[0] for x in used}
        for number in [x for x in self._manifests() if x < batch_id][:-1]:
            gone = {x for folders in json.loads(self.files.read(f"{self.path}/manifests/{number}.json")).values() for x in folders}
            for folder in gone - used:
                self.files.remove(f"{self.path}/{folder}")
            for top in {x.split("/")[0] for x in gone} - tops:
                self.files.remove(f"{self.path}/{top}")
            self.files.remove(f"{self.path}/manifests/{number}.json")
