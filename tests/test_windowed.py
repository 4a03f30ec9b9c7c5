import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import at, rows_of, secs
from tidemark.functions.eventtime import micros
from tidemark.operators.ranking import top_keys, top_report
from tidemark.operators.visitors import bitmap_visitors, unique_visitors
from tidemark.operators.windowed import sliding_counts, sliding_first_by, tumbling

SCHEMA = "key string, ts timestamp_ntz, w bigint"


def sample(seed, n=150, span=3000):
    rng = random.Random(seed)
    return [(rng.choice("aaab"), at(rng.randrange(span)), rng.randrange(-3, 4)) for _ in range(n)]


def windows(second: float, size: int, slide: int):
    start = second // slide * slide
    while start > second - size:
        yield start
        start -= slide


SIZES = [
    ("1 hour", "5 minutes"),
    ("10 minutes", "3 minutes"),
    ("12 seconds", "8 seconds"),
    ("10 minutes", "5 seconds"),
    ("5 seconds", "20 seconds"),
    ("1 minute", "1 minute"),
]


@pytest.mark.parametrize("size,slide", SIZES)
@pytest.mark.parametrize("span", [4, 4096])
def test_sliding_counts(spark, size, slide, span):
    rows = sample(1)
    got = sliding_counts(
        spark.createDataFrame(rows, SCHEMA), "ts", size, slide, ["key"], "w", span
    )
    s, d = micros(size) // 10**6, micros(slide) // 10**6
    n, total = Counter(), Counter()
    for key, ts, w in rows:
        for start in windows(secs(ts), s, d):
            n[key, start] += 1
            total[key, start] += w
    want = [(k, at(w), at(w + s), n[k, w], total[k, w]) for k, w in n]
    assert rows_of(got) == sorted(want, key=repr)


def test_sliding_counts_without_keys_and_nulls(spark):
    rows = [("a", at(0), 1), ("b", at(10), 1), ("c", None, 1)]
    got = sliding_counts(spark.createDataFrame(rows, SCHEMA), "ts", "20 seconds", "10 seconds")
    assert rows_of(got) == [(at(-10), at(10), 1), (at(0), at(20), 2), (at(10), at(30), 1)]


def test_row_on_the_edge_belongs_to_the_later_window(spark):
    df = spark.createDataFrame([("a", at(3600), 1), ("a", at(3599), 1)], SCHEMA)
    got = tumbling(df, "ts", "1 hour", ["key"], n=F.count("*"), total=F.sum("w"))
    assert rows_of(got) == [("a", at(0), at(3600), 1, 1), ("a", at(3600), at(7200), 1, 1)]


def test_times_before_the_epoch(spark):
    df = spark.createDataFrame([("a", at(-(10**10)), 1)], SCHEMA)
    got = sliding_counts(df, "ts", "20 seconds", "10 seconds", ["key"]).collect()
    want = sorted(w for w in windows(-(10**10), 20, 10))
    assert sorted(secs(r.window_start) for r in got) == want


def test_first_by_takes_whole_record_and_breaks_ties_by_order(spark):
    rows = [("s", at(1), 5), ("s", at(2), 3), ("s", at(3), 3), ("s", at(65), 9), ("s", at(66), None)]
    got = sliding_first_by(
        spark.createDataFrame(rows, SCHEMA), "ts", "1 minute", "10 seconds", ["key"], ["w", "ts"], []
    )
    want = {}
    for key, ts, w in rows:
        if w is not None:
            for start in windows(secs(ts), 60, 10):
                want[start] = min(want.get(start, (99, at(0))), (w, ts))
    assert rows_of(got.select("window_start", "w", "ts")) == sorted(
        [(at(s), *best) for s, best in want.items()], key=repr
    )


def test_top_breaks_ties_by_key_and_report(spark):
    rows = [(at(0), 7, 2), (at(0), 3, 2), (at(0), 9, 5), (at(0), 1, 1), (at(60), 4, 1)]
    counts = spark.createDataFrame(rows, "window_end timestamp_ntz, item bigint, n bigint")
    top = top_keys(counts, ["window_end"], "item", 3)
    assert rows_of(top.select("window_end", "rank", "item", "n")) == [
        (at(0), 1, 9, 5), (at(0), 2, 3, 2), (at(0), 3, 7, 2), (at(60), 1, 4, 1),
    ]
    report = {r.window_end: r.report for r in top_report(top, "window_end", "item", "item").collect()}
    assert report[at(60)] == "time: 2024-01-01 00:01:00\nNo1: item=4 views=1\n" + "=" * 37


def test_unique_visitors(spark):
    rows = [(1, at(0)), (1, at(10)), (2, at(3599)), (1, at(3600)), (None, at(1))]
    df = spark.createDataFrame(rows, "user bigint, ts timestamp_ntz")
    want = [(at(3600), 2), (at(7200), 1)]
    assert rows_of(unique_visitors(df, "ts", "user")) == want
    assert rows_of(bitmap_visitors(df, "ts", "user")) == want


def test_bitmap_counts_colliding_users_once(spark):
    df = spark.createDataFrame([("a",), ("q",)], "user string").withColumn(
        "ts", F.lit(at(0)).cast("timestamp_ntz")
    )  # ascii 97 and 113 share their lowest four bits
    assert bitmap_visitors(df, "ts", "user", capacity=16).collect()[0].n == 1
    with pytest.raises(ValueError):
        bitmap_visitors(df, "ts", "user", capacity=10)


def test_order_of_input_does_not_matter(spark):
    rows = sample(7)
    shuffled = rows[:]
    random.Random(0).shuffle(shuffled)
    a, b = (
        sliding_counts(spark.createDataFrame(r, SCHEMA), "ts", "1 hour", "5 minutes", ["key"])
        for r in (rows, shuffled)
    )
    assert rows_of(a) == rows_of(b)


@pytest.mark.parametrize("text", ["1 month", "soon", "5"])
def test_intervals_of_no_fixed_length_are_refused(text):
    with pytest.raises(ValueError):
        micros(text)
