"""Streams that keep their state by day: results over several batches, what is told between them, what a batch reads."""

import os
import random

import pytest
from conftest import at, rows_of
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from test_round_two import SF

from tidemark.operators.clicks import sliding_minutes
from tidemark.operators.visitors import sliding_approx_visitors
from tidemark.plans import streams
from tidemark.session import work_dir
from tidemark.sinks.days import DayTable
from tidemark.sinks.keyed import read_batches
from tidemark.sources.tables import stream_table
from tidemark.streaming import daily
from tidemark.streaming.runner import last_batch, run_to_table
from tidemark.streaming.watermarks import late_writer


@pytest.fixture(scope="module")
def four_event_files(spark, tmp_path_factory):
    """`events` in four files in the order of time, one to a micro-batch; the other tables as they are."""
    folder = tmp_path_factory.mktemp("events")
    df = spark.read.parquet(f"{SF}/events.parquet")
    edges = [None, *df.approxQuantile("event_id", [0.25, 0.5, 0.75], 0.0), None]
    for low, high in zip(edges, edges[1:]):
        part = df.where((F.col("event_id") > low) if low is not None else F.lit(True))
        part.where((F.col("event_id") <= high) if high is not None else F.lit(True)).coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
    for name in ("customer", "nation", "region"):
        os.symlink(f"{SF}/{name}.parquet", f"{folder}/{name}.parquet")
    return str(folder)


EVENT_STREAMS = [
    "stream_area_top3", "stream_ads_count", "stream_blacklist", "stream_latest_per_key", "stream_uv_bitmap", "stream_window_10m_3m",
    "stream_hot_items", "stream_page_view", "stream_temp_jump", "stream_uv", "stream_sensor_minby", "stream_windowed_word_count", "stream_hot_urls",
    "stream_click_cap", "stream_last_hour", "stream_late_split",
]


@pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")
@pytest.mark.parametrize("name", EVENT_STREAMS)
def test_event_streams_do_not_depend_on_the_cut_into_batches(spark, monkeypatch, four_event_files, name):
    whole = rows_of(streams.QUERIES[name](spark, SF))
    monkeypatch.setattr(streams, "stream_table", lambda s, folder, table: stream_table(s, folder, table, files_per_batch=1))
    assert rows_of(streams.QUERIES[name](spark, four_event_files)) == whole and whole


def test_lists_are_told_when_they_change(spark):
    path = work_dir(spark, "lists")
    write = daily.top_list_writer(path, ["day", "area"], "ad", 2)
    rows = lambda *x: spark.createDataFrame([(d, a, i) for d, a, i, n in x for _ in range(n)], "day string, area string, ad int")
    write(rows(("d1", "n", 1, 3), ("d1", "n", 2, 2), ("d1", "n", 3, 1), ("d1", None, 5, 1)), 0)
    write(rows(("d1", "n", 3, 1)), 1)  # 3 has as many as 2 now, which goes first: nothing to tell
    write(rows(("d1", "n", 3, 1), ("d2", "n", 3, 1)), 2)
    write(rows(("d1", "n", 3, 1), ("d2", "n", 3, 1)), 3)
    write(rows(("d1", "n", 3, 1), ("d2", "n", 3, 1)), 3)  # run again
    schema = StructType.fromDDL("day string, area string, top array<struct<ad: int, n: bigint>>")
    told = {(r.batch, r.day, r.area): [tuple(x) for x in r.top] for r in read_batches(spark, f"{path}/lists", schema).collect()}
    assert told == {
        (0, "d1", "n"): [(1, 3), (2, 2)], (0, "d1", None): [(5, 1)],
        (2, "d1", "n"): [(1, 3), (3, 3)], (2, "d2", "n"): [(3, 1)],
        (3, "d1", "n"): [(3, 4), (1, 3)], (3, "d2", "n"): [(3, 2)],
    }


def test_days_expire(spark):
    path = work_dir(spark, "expiring")
    write = daily.count_writer(path, ["day", "k"], days_kept=2)
    for i in range(5):
        write(spark.createDataFrame([(f"d{i}", 1), (f"d{i}", 1)], "day string, k int"), i)
    table = daily.daily_counts(spark, path, StructType.fromDDL("day string, k int, n bigint"), ["day", "k"])
    assert rows_of(table.read()) == [("d3", 1, 2), ("d4", 1, 2)]
    assert {x.split("=")[0] for x in table.files.names(path)} == {"batch", "manifests"} and len(table.files.names(path)) <= 4


def test_late_rows_cost_one_row_of_the_batch_before(spark):
    path = work_dir(spark, "late")
    write = late_writer(path, "ts", "10 seconds", "10 seconds", "0 seconds")
    batches = [[(1, at(5))], [(2, at(100)), (3, at(4))], [(4, None)], [(5, at(3)), (6, at(95)), (7, at(120))]]
    for i, rows in enumerate(batches):
        write(spark.createDataFrame(rows, "id int, ts timestamp_ntz"), i)
    got = {name: sorted(r.id for r in read_batches(spark, f"{path}/{name}", StructType.fromDDL("id int, ts timestamp_ntz")).collect()) for name in ("main", "late")}
    assert got == {"main": [1, 2, 3, 4, 7], "late": [5, 6]}  # a head of 100 closes the window from 90 to 100 too
    heads = read_batches(spark, f"{path}/heads", StructType.fromDDL("head bigint"))
    assert [r.n for r in heads.groupBy("batch").agg(F.count("*").alias("n")).collect()] == [1] * 4


def test_complete_and_update_mode_agree(spark, tmp_path):
    for i in range(3):
        spark.createDataFrame([(w, at(60 * i + j)) for j, w in enumerate("aab")], "word string, ts timestamp_ntz").coalesce(1).write.mode("append").parquet(
            f"{tmp_path}/words.parquet"
        )
    results = []
    for mode in ("complete", "update"):
        stream = stream_table(spark, str(tmp_path), "words", files_per_batch=1)
        counts = stream.groupBy(F.window("ts", "2 minutes", "1 minute").alias("w"), "word").agg(F.count("*").alias("n"))
        rows = run_to_table(counts.select("word", F.col("w.end").alias("end"), "n"), f"mode-{mode}", mode)
        assert rows.select("batch").distinct().count() == 3
        last = rows.where("batch = 2").drop("batch") if mode == "complete" else last_batch(rows, ["word", "end"])
        results.append(rows_of(last.select("word", "end", "n")))
    assert results[0] == results[1] and results[0]


@pytest.mark.parametrize("size,slide,chunk", [("1 hour", "1 minute", 4096), ("10 minutes", "5 minutes", 4096), ("1 hour", "5 seconds", 10), ("30 minutes", "30 minutes", 8)])
def test_sliding_minutes(spark, size, slide, chunk):
    from tidemark.functions.eventtime import micros

    rng = random.Random(1)
    rows = [(rng.choice([1, 2, None]), rng.randrange(0, 7200)) for _ in range(60)]
    df = spark.createDataFrame([(a, at(t)) for a, t in rows] + [(1, None)], "ad int, ts timestamp_ntz")
    w, d = micros(size) // 10**6, micros(slide) // 10**6
    want = {}
    for ad, t in rows:
        minute = t // 60 * 60
        s = minute // d * d
        while s > minute - w:
            lists = want.setdefault((ad, s + w), {})
            lists[minute] = lists.get(minute, 0) + 1
            s -= d
    got = {(r.ad, r.report): [(x.hm, x.n) for x in r.minutes] for r in sliding_minutes(df, "ts", "ad", size, slide, chunk=chunk).collect()}
    assert got == {(ad, at(e)): [(at(m).strftime("%H:%M"), n) for m, n in sorted(x.items())] for (ad, e), x in want.items()}


def test_sliding_sketches(spark):
    rows = [(at(t), t % 37 if t % 5 else None) for t in range(0, 3000, 3)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, user int")
    got = {r.window_end: r.n for r in sliding_approx_visitors(df, "ts", "user", "10 minutes", "1 minute").collect()}
    exact = {}
    for ts, user in rows:
        if user is not None:
            t = int((ts - at(0)).total_seconds())
            for e in range(t // 60 * 60 + 60, t // 60 * 60 + 660, 60):
                exact.setdefault(at(e), set()).add(user)
    assert {k: len(v) for k, v in exact.items()} == got  # sketches of few users are exact
    assert sliding_approx_visitors(df.limit(0), "ts", "user", "10 minutes", "1 minute").count() == 0


def test_bitmaps_unite(spark):
    path = work_dir(spark, "bits")
    write = daily.bitmap_writer(path, "ts", "user", keep=1)
    for i, users in enumerate(([1, 2, 2, None], [2, 3], [3])):
        write(spark.createDataFrame([(at(10), u) for u in users], "ts timestamp, user int"), i)
    assert [r.n for r in daily.bitmap_counts(daily.bitmap_table(spark, path).read()).collect()] == [3]
    assert isinstance(daily.bitmap_table(spark, path), DayTable)
