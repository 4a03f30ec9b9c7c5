"""Streams over slices of many files, and streams that carry their open rows from one micro-batch to the next."""

import datetime
import os
import random

import duckdb
import pytest
from conftest import at, rows_of
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from test_matching_first import found, plain

from check import compare
from tidemark.operators.matching import reconcile
from tidemark.plans import streams
from tidemark.session import work_dir
from tidemark.sinks.keyed import read_batches
from tidemark.sources import replay
from tidemark.sources.tables import stream_table
from tidemark.streaming import carried, runner
from tidemark.streaming.runner import run_to_table


def test_a_slice_is_written_and_read_as_several_files(spark):
    """Also a slice of one row and one without rows, and rows without a time, in the first slice."""
    rows = [(i, at((i * 7919) % 4000)) for i in range(1200)] + [(-1, at(9000)), (-2, None)]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz").repartition(20)
    edges = [at(2000), at(5000), at(8000)]
    stream = replay.played_back(df, "ts", edges).withColumn("file", F.input_file_name())
    out = run_to_table(stream, "played", schema="id int, ts timestamp_ntz, file string")
    batches = {r.batch: (r.ids, r.files) for r in out.groupBy("batch").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.count_distinct("file").alias("files")).collect()}
    slices = [[i for i, ts in rows if ts is None or ts < edges[0]], [i for i, ts in rows if ts is not None and edges[0] <= ts < edges[1]], [], [-1]]
    assert {b: ids for b, (ids, _) in batches.items()} == {b: sorted(ids) for b, ids in enumerate(slices) if ids}
    assert batches[0][1] == batches[1][1] == 5


def order_tables(spark, folder):
    """Forty orders with up to four lines each, some of which come before their order, far after it, or without one."""
    rng = random.Random(5)
    day = lambda d: datetime.datetime(2020, 1, 1) + datetime.timedelta(days=d)
    made = [(k, rng.randrange(900, 950), day(rng.randrange(2000))) for k in range(40)]
    near = [-20, -15, -4, -3, 0, 1, 5, 6, 20, 89, 90, 491]
    lines = [(k, 7 * k + i, ts + datetime.timedelta(days=rng.choice(near))) for k, _, ts in made for i in range(rng.randrange(5))]
    lines += [(100, 1, day(50)), (100, 2, day(60)), (101, 3, day(2600))]
    spark.createDataFrame(made, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey bigint, l_suppkey bigint, l_shipdate timestamp_ntz").write.parquet(f"{folder}/lineitem.parquet")
    readings = [(i, at(i * 131 % 90000 + 0.25), rng.randrange(3), rng.choice([None, *map(float, range(60))])) for i in range(500)]
    df = spark.createDataFrame(readings, "event_id bigint, ts timestamp_ntz, user_id bigint, value double")
    for low in range(4):  # four micro-batches, an hour out of order at most
        df.where(F.floor((F.unix_seconds(F.col("ts").cast("timestamp")) - F.unix_seconds(F.lit(at(0)).cast("timestamp")) + F.col("event_id") % 3500) / 23500) == low).coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")


@pytest.mark.parametrize(
    "name", ["stream_tx_reconcile_first", "stream_order_pay", "stream_interval_join", "stream_tx_reconcile", "stream_window_join", "stream_temp_jump"]
)
def test_no_row_goes_through_a_state_store(spark, monkeypatch, tmp_path, name):
    """The rows of the SQL come from several micro-batches, none of which keeps rows in a state store."""
    queries, runs, begin = [], [], runner.start
    monkeypatch.setattr(runner, "start", lambda *a, **k: queries.append(begin(*a, **k)) or queries[-1])
    monkeypatch.setattr(streams, "run_to_table", lambda *a, **k: runs.append(run_to_table(*a, **k)) or runs[-1])
    monkeypatch.setattr(streams, "stream_table", lambda s, folder, name: stream_table(s, folder, name, files_per_batch=1))
    order_tables(spark, tmp_path)
    out = streams.QUERIES[name](spark, str(tmp_path))
    db = duckdb.connect()
    for table in ("orders", "lineitem", "events"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    assert compare(out, db, streams.SQL[name]) is None and out.count() > 5
    assert runs[0].select("batch").distinct().count() > 1
    assert len(queries[0].recentProgress) == 4 and all(not p["stateOperators"] for p in queries[0].recentProgress)


LOG = "k string, ts timestamp_ntz, side string, id int"


def carry(spark, writer, rows, parts=5, again=2):
    """What the writer has written when it got `rows` in order of arrival in `parts` batches, one of them twice."""
    size = -(-len(rows) // parts)
    for i in [*range(again + 1), *range(again, parts)]:
        writer(spark.createDataFrame(rows[i * size : (i + 1) * size], LOG).repartition(2), i)


def arrivals(seed, n=400):
    """A log up to 10 seconds out of order, with rows without a time, a late row, and both sides' last times."""
    rng = random.Random(seed)
    rows = [("abc"[i % 3], i * 2.0 + rng.randrange(-10, 1), rng.choice(["pay", "receipt"]), i) for i in range(n)]
    rows += [("d", n * 2.0 + 5, "pay", n), ("d", n * 2.0 + 100, "receipt", n + 1)]
    return rows


def logged(rows):
    return [(k, None if t is None else at(t), s, i) for k, t, s, i in rows]


def test_carried_queues_against_plain_ones(spark):
    rows = arrivals(1)
    odd = [("a", None, "pay", -1), ("a", 3.0, "pay", -2)]  # the second comes when the watermark has passed its session
    log, path = spark.createDataFrame([], LOG), work_dir(spark, "first")
    writer = carried.first_match_writer(path, log, "10 seconds", "k", "ts", "side", "id")
    carry(spark, writer, logged([*rows[:300], *odd, *rows[300:]]))
    out = read_batches(spark, path, StructType.fromDDL("k string, pay int, receipt int, channel string"))
    last = max(t for _, t, _, _ in rows)
    want = [r for r in plain(rows) if r[0] != "d" or r[1] is not None]  # the last receipt waits at the end
    assert last - 10 > rows[-2][1] + 5 and found(out.drop("batch")) == sorted(want, key=repr)
    assert out.select("batch").distinct().count() == 5
    folders = os.listdir(f"{path}-open")
    assert sorted(x for x in folders if x.startswith("batch=")) == ["batch=3", "batch=4"]


def test_carried_reconcile_against_the_table(spark):
    rows = arrivals(2)
    late = [("a", None, "pay", -1), ("a", 3.0, "pay", -2)]

    def split(df):
        new = [{"ts": "pay_ts", "id": "pay"}, {"ts": "receipt_ts", "id": "receipt"}]
        return tuple(df.where(F.col("side") == s).drop("side").withColumnsRenamed(n) for s, n in zip(("pay", "receipt"), new))

    path, logs = work_dir(spark, "reconcile"), [F.col("side") == "pay", F.col("side") == "receipt"]
    carry(spark, carried.reconcile_writer(path, "ts", "10 seconds", split, "k", "pay_ts", "receipt_ts", logs), logged([*rows[:300], *late, *rows[300:]]))
    table = reconcile(*split(spark.createDataFrame(logged(rows), LOG)), "k", "pay_ts", "receipt_ts")
    mark = rows[-2][1] - 10  # of the pays, which are behind
    open_ = lambda r: r.channel == "unmatched_pay" and r.pay_ts >= at(mark - 5) or r.channel == "unmatched_receipt" and r.receipt_ts >= at(mark - 3)
    want = sorted((tuple(r) for r in table.collect() if not open_(r)), key=repr)
    out = read_batches(spark, path, table.schema)
    assert rows_of(out.drop("batch")) == want and {r[-1] for r in want} == {"matched", "unmatched_pay", "unmatched_receipt"}
    assert out.select("batch").distinct().count() == 5
