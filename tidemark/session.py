"""Session settings and the folder for checkpoints and intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(
    cores: int | str = 8, app: str = "tidemark", memory: str = "8g", **conf: str
) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_utc(spark: SparkSession) -> SparkSession:
    """Event times are zone-free; UTC makes timestamp_ntz <-> timestamp casts the identity."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def use_rocksdb(spark: SparkSession) -> None:
    """State that may outgrow memory, saved as changes; timers and typed state need it too."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set(
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
    )


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the shared `spark.checkpoint.dir`.

    Where that is unset, a local master gets a folder of this machine; on a cluster each executor would write to a
    disk of its own, so that is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "local")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="tidemark-")
    return f"{shared.rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"
