"""Blocks, roll-ups on panes, day tables."""

import random

import pytest
from conftest import EPOCH, at, rows_of
from pyspark.sql import functions as F

from tidemark.functions.eventtime import micros
from tidemark.operators.clicks import marketing_rollup
from tidemark.operators.windowed import sliding_first_by
from tidemark.session import work_dir
from tidemark.sinks.days import DayTable
from tidemark.sinks.keyed import (
    day_set_writer,
    day_upsert_writer,
    day_upserts,
    latest_per_key,
    read_batches,
    replacing_writer,
)


@pytest.mark.parametrize("size,slide", [("60 seconds", "10 seconds"), ("1 hour", "10 seconds"), ("7 seconds", "3 seconds"), ("5 seconds", "5 seconds"), ("4 seconds", "9 seconds"), ("1 second", "1 second")])
def test_sliding_minima_by_blocks(spark, size, slide):
    rng = random.Random(len(size) + len(slide))
    rows = [(rng.choice(["a", "b", None]), rng.randrange(-400, 900) / 2, rng.choice([1.0, 2.0, 3.0, 4.5, None]), i) for i in range(120)]
    df = spark.createDataFrame([(k, at(t), v, i) for k, t, v, i in rows], "k string, ts timestamp_ntz, v double, i int")
    out = sliding_first_by(df, "ts", size, slide, ["k"], ["v", "i"], ["ts"])
    w, d = micros(size) // 10**6, micros(slide) // 10**6
    origin = int((at(0) - EPOCH.replace(year=1970)).total_seconds())
    want = {}
    for k, t, v, i in rows:
        if v is None:
            continue
        s = (int((t + origin) // d)) * d
        while s > t + origin - w:
            best = want.get((k, s))
            if best is None or (v, i) < best:
                want[(k, s)] = (v, i)
            s -= d
    got = {(r.k, int((r.window_start - EPOCH.replace(year=1970)).total_seconds())): (r.v, r.i) for r in out.collect()}
    assert got == want
    assert all((r.window_end - r.window_start).total_seconds() == w for r in out.limit(5).collect())


def test_sliding_minima_shuffle_two_rows_per_pane(spark):
    """Whatever the number of windows a row is in, one shuffle of panes and one of their edges."""
    df = spark.createDataFrame([("a", at(1), 1.0)], "k string, ts timestamp_ntz, v double")
    plan = sliding_first_by(df, "ts", "1 hour", "1 second", ["k"], ["v"], [])._jdf.queryExecution().executedPlan().toString()
    before_last_shuffle = plan[plan.rindex("Exchange hashpartitioning(k"):] if plan.count("Exchange") else plan
    assert plan.count("Exchange hashpartitioning") == 2 and "sequence(" not in before_last_shuffle


def test_rollup_keeps_null_and_named_channels_apart(spark):
    rows = [("total channel", "x", 1), (None, "x", 1), ("c", None, 2), ("c", "x", 25), ("c", "gone", 3)]
    df = spark.createDataFrame([(c, b, at(t)) for c, b, t in rows], "channel string, behavior string, ts timestamp_ntz")
    kept = F.coalesce(F.col("behavior") != "gone", F.lit(True))
    out = rows_of(marketing_rollup(df, "ts", "20 seconds", "10 seconds", kept).where(F.col("window_start") == at(0)).select("channel", "behavior", "n"))
    assert out == sorted([(None, "total behavior", 1), (None, "x", 1), ("c", None, 1), ("c", "total behavior", 1), ("total channel", "total behavior", 1),
                          ("total channel", "total behavior", 3), ("total channel", "x", 1)], key=repr)


def day_rows(spark, rows):
    return spark.createDataFrame(rows, "day string, k int, at int, v int")


def test_day_upserts_read_their_days_and_stay_few(spark, monkeypatch):
    path = work_dir(spark, "upserts")
    write = day_upsert_writer(path, ["k"], ["at"], keep=3)
    rng, all_rows = random.Random(3), []
    touched = []
    rows_read = DayTable._rows
    monkeypatch.setattr(DayTable, "_rows", lambda self, folders: touched.append(list(folders)) or rows_read(self, folders))
    for batch in range(12):
        rows = [(f"2024-01-{1 + batch // 3:02d}" if rng.random() < 0.8 else None, rng.randrange(5), batch * 100 + i, rng.randrange(99)) for i in range(20)]
        all_rows += rows
        write(day_rows(spark, rows), batch)
        if batch in (4, 7):
            write(day_rows(spark, rows), batch)  # run again after a failure
    table = day_upserts(spark, path, day_rows(spark, []).schema, ["k"], ["at"], keep=3)
    assert rows_of(table.read()) == rows_of(latest_per_key(day_rows(spark, all_rows), ["day", "k"], ["at"]))
    assert all(len(x) <= 3 for x in table._manifest(None).values())
    for folders in touched:  # a batch that merges reads only days that it has rows of
        assert len({f.split("_day=")[1] for f in folders}) <= 5
    left = [n for n in table.files.names(path) if n != "manifests"]
    named = {f.split("/")[0] for before in (None, 11) for folders in table._manifest(before).values() for f in folders}
    assert set(left) == named and len(table._manifests()) == 2
    assert rows_of(table.read(["2024-01-02"])) == rows_of(table.read().where("day = '2024-01-02'"))


def test_day_sets_add_once_and_forget_old_days(spark):
    path = work_dir(spark, "sets")
    write = day_set_writer(path, ["day", "u"], days_kept=2)
    for batch, members in enumerate([[("d1", 1), ("d1", 2), ("d1", 1)], [("d1", 2), ("d2", 1), ("d2", None)], [("d2", None), ("d3", 3)], [("d3", 3), ("d2", 4)]]):
        write(spark.createDataFrame(members, "day string, u int"), batch)
    rows = read_batches(spark, f"{path}/new", spark.createDataFrame([], "day string, u int").schema)
    assert rows_of(rows) == [("d1", 1, 0), ("d1", 2, 0), ("d2", 1, 1), ("d2", 4, 3), ("d2", None, 1), ("d3", 3, 2)]
    table = DayTable(spark, f"{path}/days", rows.drop("batch").schema, lambda x: x.distinct())
    assert sorted(table._manifest(None)) == ["d2", "d3"]


def test_complete_output_replaces(spark):
    path = work_dir(spark, "whole")
    write = replacing_writer(path)
    for batch in range(4):
        write(spark.range(batch + 1), batch)
    rows = read_batches(spark, path, spark.range(0).schema)
    assert {r.batch for r in rows.collect()} == {2, 3} and rows.where("batch = 3").count() == 4
