"""Faults found in review: each with the case that showed it."""

import os

import pytest
from conftest import at, rows_of
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.matching import reconcile
from tidemark.operators.windowed import sliding_counts
from tidemark.plans import market, streams
from tidemark.session import work_dir
from tidemark.sources.lines import parse_delimited
from tidemark.sources.tables import stream_table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("size", ["8 seconds", "20 seconds"])
def test_windows_with_null_weights_only_have_no_total(spark, size):
    rows = [("a", at(1), None), ("a", at(100), 3), ("a", at(100), None)]
    df = spark.createDataFrame(rows, "key string, ts timestamp_ntz, w long")
    out = sliding_counts(df, "ts", size, "2 seconds", ["key"], weight="w").collect()
    early = [r for r in out if r.window_start < at(50)]
    late = [r for r in out if r.window_start > at(50)]
    assert early and all(r.total is None and r.n == 1 for r in early)
    assert late and all(r.total == 3 and r.n == 2 for r in late)


@pytest.mark.parametrize(("delimiter", "line"), [("||", "1||a|b"), ("^", "1^a|b"), ("]", "1]a|b"), (".", "1.a|b"), ("\\", "1\\a|b")])
def test_delimiters_are_literal(spark, delimiter, line):
    lines = spark.createDataFrame([(line,)], "value string")
    out = parse_delimited(lines, StructType.fromDDL("n int, s string"), delimiter=delimiter).first()
    assert (out["n"], out["s"], out["_corrupt"]) == (1, "a|b", None)


def test_rows_without_a_time_keep_their_side(spark):
    pays = spark.createDataFrame([("t1", None), ("t2", at(0))], "tx string, pay_ts timestamp_ntz")
    receipts = spark.createDataFrame([("t1", None), ("t2", at(1))], "tx string, receipt_ts timestamp_ntz")
    out = reconcile(pays, receipts, "tx", "pay_ts", "receipt_ts")
    assert sorted((r.tx, r.channel) for r in out.collect()) == [
        ("t1", "unmatched_pay"), ("t1", "unmatched_receipt"), ("t2", "matched"),
    ]
    assert "_pay" not in out.columns and "_receipt" not in out.columns


class _Conf:
    def __init__(self, **values):
        self.conf, self.values = self, values

    def get(self, key, default=None):
        return self.values.get(key.replace(".", "_"), default)


def test_a_cluster_needs_a_shared_folder():
    for master in ("yarn", "spark://host:7077", "k8s://host", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            work_dir(_Conf(spark_master=master), "x")
        assert work_dir(_Conf(spark_master=master, spark_checkpoint_dir="file:///s"), "x").startswith("file:///s/")
    assert work_dir(_Conf(spark_master="local[4]"), "x")


def test_streams_read_the_named_table_only(spark, tmp_path):
    for name in ("t.parquet", "t.parquet.old", "t.parquets"):
        spark.range(3).write.parquet(f"{tmp_path}/{name}")
    query = stream_table(spark, str(tmp_path), "t").writeStream.format("memory").queryName("named").trigger(availableNow=True)
    query.option("checkpointLocation", f"{tmp_path}/c").start().awaitTermination()
    assert spark.table("named").count() == 3


def test_report_time_follows_the_data(spark):
    df = spark.createDataFrame([(at(59.5),), (at(10),)], "ts timestamp_ntz")
    assert df.select(market.report_time(df, "ts").alias("t")).first()["t"] == at(60)


@pytest.fixture(scope="module")
def four_files(spark, tmp_path_factory):
    """The order tables and documents in four files each, ordered by key, one to a micro-batch."""
    folder = tmp_path_factory.mktemp("cut")
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("documents", "doc_id")):
        df = spark.read.parquet(f"{SF}/{name}.parquet")
        edges = [None, *df.approxQuantile(key, [0.25, 0.5, 0.75], 0.01), None]
        for low, high in zip(edges, edges[1:]):
            part = df.where((F.col(key) > low) if low is not None else F.lit(True))
            part = part.where((F.col(key) <= high) if high is not None else F.lit(True))
            part.coalesce(1).write.mode("append").parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")
@pytest.mark.parametrize("name", ["stream_interval_join", "stream_window_join", "stream_word_count"])
def test_streams_do_not_depend_on_the_cut_into_batches(spark, monkeypatch, four_files, name):
    whole = streams.QUERIES[name](spark, SF)
    monkeypatch.setattr(streams, "stream_table", lambda s, folder, table: stream_table(s, folder, table, files_per_batch=1))
    cut = streams.QUERIES[name](spark, four_files)
    assert rows_of(cut) == rows_of(whole) and whole.count() > 0
