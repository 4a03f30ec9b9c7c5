"""One-to-one matching against a queue per key, as a table and as a stream that is played back."""

import collections
import os
import random

import pytest
from conftest import at, rows_of
from pyspark.sql import functions as F
from test_round_two import SF, four_files  # noqa: F401

from tidemark.functions.eventtime import to_stream_time
from tidemark.operators.matching import reconcile_first
from tidemark.plans import streams
from tidemark.sources import replay
from tidemark.streaming.runner import run_to_table
from tidemark.streaming.watermarks import bounded

PAY, RECEIPT = 5, 3


def plain(rows):
    """Rows (key, seconds, side, id) in event-time order through one queue per key."""
    queues, out = collections.defaultdict(collections.deque), []
    for key, ts, side, row in sorted(rows, key=lambda r: (r[1], r[2] != "pay", r[3])):
        queue = queues[key]
        while queue and queue[0][2] < ts:  # all of one side and so of one wait: the oldest ends first
            old = queue.popleft()
            out.append((key, *((old[1], None) if old[0] == "pay" else (None, old[1]))))
        if queue and queue[0][0] != side:
            other = queue.popleft()[1]
            out.append((key, *((row, other) if side == "pay" else (other, row))))
        else:
            queue.append((side, row, ts + (PAY if side == "pay" else RECEIPT)))
    for key, queue in queues.items():
        out += [(key, r, None) if side == "pay" else (key, None, r) for side, r, _ in queue]
    return sorted(out, key=repr)


def log_rows(seed, n=600, keys=5, span=600):
    rng = random.Random(seed)
    return [(rng.choice(["a", "b", None, "c", "d"][:keys]), rng.randrange(span * 2) / 2, rng.choice(["pay", "receipt"]), i) for i in range(n)]


def found(df):
    for r in df.collect():
        assert r.channel == ("matched" if None not in (r.pay, r.receipt) else "unmatched_receipt" if r.pay is None else "unmatched_pay")
    return sorted(((r.k, r.pay, r.receipt) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed,keys,span", [(1, 5, 600), (2, 1, 400), (3, 2, 4000)])
def test_against_queues(spark, seed, keys, span):
    rows = log_rows(seed, keys=keys, span=span)
    df = spark.createDataFrame([(k, at(t), s, i) for k, t, s, i in rows], "k string, ts timestamp_ntz, s string, id int").repartition(3)
    got = found(reconcile_first(df, "k", "ts", "s", "id"))
    assert got == plain(rows)
    assert {(p is None, r is None) for _, p, r in got} == {(False, False), (True, False), (False, True)}


def test_waits_include_both_ends_and_empty_tables(spark):
    schema = "k string, ts timestamp_ntz, s string, id int"
    rows = [("x", 0, "pay", 1), ("x", 5, "receipt", 2), ("y", 0, "receipt", 3), ("y", 3, "pay", 4), ("z", 0, "receipt", 5), ("z", 3.5, "pay", 6), ("w", 7, "receipt", 7), ("w", 7, "pay", 8)]
    df = spark.createDataFrame([(k, at(t), s, i) for k, t, s, i in rows], schema)
    assert found(reconcile_first(df, "k", "ts", "s", "id")) == sorted(
        [("x", 1, 2), ("y", 4, 3), ("z", None, 5), ("z", 6, None), ("w", 8, 7)], key=repr
    )
    assert found(reconcile_first(df.limit(0), "k", "ts", "s", "id")) == []


def test_played_back_slices_only_go_forward(spark):
    rows = [(i, at((i * 7919) % 5000)) for i in range(2000)] + [(-1, None)]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz")
    edges = replay.slice_edges([df.where("ts is not null").select("ts")], 5)
    assert edges == sorted(edges) and len(edges) == 4
    out = run_to_table(replay.played_back(df, "ts", edges), "played")
    spans = {r.batch: (r.lo, r.hi) for r in out.groupBy("batch").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).collect()}
    assert out.count() == len(rows) and len(spans) == 5
    assert all(spans[b][1] < spans[b + 1][0] for b in range(4))


def test_a_stream_gives_what_a_table_gives_and_drops_its_state(spark):
    rows = log_rows(7, n=300, keys=3, span=900) + [("end", 5000, "pay", 9999)]
    df = spark.createDataFrame([(k, at(t), s, i) for k, t, s, i in rows], "k string, ts timestamp_ntz, s string, id int")
    log = replay.played_back(df, "ts", replay.slice_edges([df.select("ts")], 6))
    stream = bounded(to_stream_time(log, "ts"), "ts", "10 seconds")
    rows_out = run_to_table(reconcile_first(stream, "k", "ts", "s", "id"), "first")
    assert rows_out.select("batch").distinct().count() >= 4  # rows come as time goes on, not at the end
    assert found(rows_out.drop("batch")) == plain(rows[:-1])


@pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")
@pytest.mark.parametrize("name", ["stream_order_pay", "stream_tx_reconcile", "stream_tx_reconcile_first", "stream_interval_join"])
def test_all_rows_come_from_one_stream(spark, monkeypatch, four_files, name):  # noqa: F811
    """One run of a stream writes every row of the result, over a short watermark, however the table is cut."""
    runs = []

    def spied(df, label, *rest, **more):
        assert df.isStreaming
        runs.append(run_to_table(df, label, *rest, **more))
        return runs[-1]

    monkeypatch.setattr(streams, "run_to_table", spied)
    out = streams.QUERIES[name](spark, four_files)
    assert len(runs) == 1 and runs[0].count() == out.count() > 0
    assert runs[0].select("batch").distinct().count() > 1
    assert rows_of(out) == rows_of(streams.QUERIES[name](spark, SF))


