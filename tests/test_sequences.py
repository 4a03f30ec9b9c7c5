"""Row order within a key against plain Python, for several chunk widths and a hot key."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import at, rows_of
from tidemark.operators.counting import running_count
from tidemark.functions.eventtime import micros
from tidemark.operators.sequences import neighbours, running, with_context

SCHEMA = "key string, ts timestamp_ntz, id bigint, v bigint"


def sample(seed: int, n: int = 200, span: int = 400):
    rng = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b", None]
    rows = [(rng.choice(keys), at(rng.randrange(span)), i, rng.randrange(50)) for i in range(n)]
    rng.shuffle(rows)
    return rows


def by_key(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        groups.setdefault(row[0], []).append(row)
    return groups


@pytest.mark.parametrize("chunk", ["1 second", "17 seconds", "1 hour"])
def test_neighbours_see_across_chunks(spark, chunk):
    rows = sample(1)
    got = neighbours(
        spark.createDataFrame(rows, SCHEMA), ["key"], "ts", ["ts", "id"], ["v", "id"], chunk,
        ("prev", "next"),
    )
    want = []
    for group in by_key(rows).values():
        for i, row in enumerate(group):
            before = group[i - 1] if i else (None,) * 4
            after = group[i + 1] if i + 1 < len(group) else (None,) * 4
            want.append((*row, before[3], after[3], before[2], after[2]))
    columns = ["key", "ts", "id", "v", "prev_v", "next_v", "prev_id", "next_id"]
    assert rows_of(got.select(*columns)) == sorted(want, key=repr)


@pytest.mark.parametrize("chunk", ["1 second", "17 seconds", "1 hour"])
@pytest.mark.parametrize("include", [True, False])
def test_running(spark, chunk, include):
    rows = sample(2)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"w": F.col("v"), "x": F.col("v")})
    aggs = {"total": ("sum", "v"), "low": ("min", "w"), "high": ("max", "x")}
    got = running(df, ["key"], "ts", ["ts", "id"], aggs, chunk, include)
    want = []
    for group in by_key(rows).values():
        for i, row in enumerate(group):
            seen = [r[3] for r in group[: i + include]]
            want.append((row[2], sum(seen), min(seen), max(seen)) if seen else (row[2],) + (None,) * 3)
    assert rows_of(got.select("id", "total", "low", "high")) == sorted(want, key=repr)


def test_running_count_numbers_every_row(spark):
    rows = sample(3)
    got = running_count(
        spark.createDataFrame(rows, SCHEMA), ["key"], "ts", ["ts", "id"], "10 seconds"
    )
    want = [(r[2], i + 1) for group in by_key(rows).values() for i, r in enumerate(group)]
    assert rows_of(got.select("id", "n")) == sorted(want, key=repr)


def test_running_needs_one_column_per_aggregate(spark):
    df = spark.createDataFrame(sample(4, 5), SCHEMA)
    with pytest.raises(ValueError):
        running(df, ["key"], "ts", ["ts"], {"a": ("sum", "v"), "b": ("min", "v")})


@pytest.mark.parametrize("before", [True, False])
def test_every_row_is_home_once(spark, before):
    rows = sample(5)
    near = with_context(spark.createDataFrame(rows, SCHEMA), "ts", "5 seconds", "20 seconds", None, before)
    home = near.where("_home")
    assert rows_of(home.select("id")) == sorted([(r[2],) for r in rows], key=repr)
    copies = near.where("not _home").count()
    edge = [r for r in rows if ((r[1].minute * 60 + r[1].second) % 20 >= 15 if before else r[1].second % 20 < 5)]
    assert copies == len(edge)


def test_empty_input(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert neighbours(empty, ["key"], "ts", ["ts", "id"], ["v"]).count() == 0
    assert running(empty, ["key"], "ts", ["ts", "id"], {"t": ("sum", "v")}).count() == 0
