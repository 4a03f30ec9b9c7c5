import random

import pytest
from pyspark.sql import functions as F

from conftest import at, rows_of, secs
from tidemark.operators.alarms import rolling_minimum, steady_rises, temperature_jumps
from tidemark.operators.bursts import failure_bursts
from tidemark.operators.patterns import (
    capped_clicks,
    failed_pairs,
    followed_by,
    match_next,
    order_states,
    order_timeouts,
    unpaid_orders,
)

LOGIN = "user bigint, ts timestamp_ntz, id bigint, status string"
ORDER = "order_id bigint, ts timestamp_ntz, kind string"


def fail():
    return F.col("status") == "fail"



def logins(spark, *events):
    rows = [(u, at(s), i, status) for i, (u, s, status) in enumerate(events)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, LOGIN)


@pytest.mark.parametrize("chunk", ["5 seconds", "1 hour"])
def test_failed_pairs(spark, chunk):
    df = logins(
        spark,
        (1, 0, "fail"), (1, 4, "fail"), (1, 9, "fail"),       # 4 s apart, then exactly 5 s
        (2, 0, "fail"), (2, 1, "success"), (2, 2, "fail"),    # reset in between
        (3, 7, "fail"), (3, 7, "fail"), (3, 11, "fail"),      # equal times, then a third
        (4, 3, "fail"),
    )
    got = failed_pairs(df, "user", "ts", ["ts", "id"], fail(), chunk=chunk)
    pairs = rows_of(got.select("user", "first_fail_time", "last_fail_time"))
    assert pairs == [(1, at(0), at(4)), (3, at(7), at(11)), (3, at(7), at(7))]
    assert got.first().warning_msg == "login fail in 5 seconds"


@pytest.mark.parametrize("chunk", ["3 seconds", "1 minute"])
def test_match_next_three_steps(spark, chunk):
    rng = random.Random(3)
    events = [(rng.choice([1, 1, 1, 2]), rng.randrange(200), rng.choice(["fail", "success"])) for _ in range(150)]
    df = logins(spark, *events)
    steps = [("a", fail()), ("b", fail()), ("c", ~fail())]
    got = match_next(df, ["user"], "ts", ["ts", "id"], steps, "3 seconds", ["id"], chunk)
    want = []
    for user in (1, 2):
        seq = sorted((s, i, k) for i, (u, s, k) in enumerate(events) if u == user)
        for x, y, z in zip(seq, seq[1:], seq[2:]):
            if (x[2], y[2], z[2]) == ("fail", "fail", "success") and z[0] - x[0] < 3:
                want.append((user, x[1], y[1], z[1]))
    assert want
    assert rows_of(got.select("user", "a_id", "b_id", "c_id")) == sorted(want, key=repr)


def naive_bursts(events, within, times):
    """Walks each user's events in order: the definition."""
    found = []
    for user in {e[0] for e in events}:
        first, members = None, []
        for second, _, status in sorted((s, i, k) for i, (u, s, k) in enumerate(events) if u == user):
            if first is not None and second > first + within:
                if len(members) >= times:
                    found.append((user, at(first), at(members[-1]), len(members)))
                first, members = None, []
            if status != "fail":
                first, members = None, []
            elif first is None:
                first, members = second, [second]
            else:
                members.append(second)
        if len(members) >= times:
            found.append((user, at(first), at(members[-1]), len(members)))
    return sorted(found, key=repr)


@pytest.mark.parametrize("chunk", ["2 seconds", "7 seconds", "1 hour"])
@pytest.mark.parametrize("seed,dense", [(1, True), (2, True), (3, False), (4, False)])
def test_bursts_equal_a_walk(spark, chunk, seed, dense):
    """A dense user never leaves a gap, so every burst's start hangs on all before it."""
    rng = random.Random(seed)
    span = 120 if dense else 600
    share = 0.02 if dense else 0.3
    events = [
        (rng.choice([1, 1, 1, 1, 2]), rng.randrange(span), "success" if rng.random() < share else "fail")
        for _ in range(250)
    ]
    df = logins(spark, *events)
    got = failure_bursts(df, "user", "ts", ["ts", "id"], fail(), 2, "2 seconds", chunk)
    bursts = rows_of(got.select("user", "first_fail_time", "last_fail_time", "failures"))
    assert bursts == naive_bursts(events, 2, 2)


@pytest.mark.parametrize("kind,one,two", [("int", 1, 2), ("string", "", "=")])
def test_rows_without_a_user_are_one_key(spark, kind, one, two):
    rows = [(u, at(t), i, "fail") for i, (u, t) in enumerate([(None, 0), (None, 1), (one, 0), (one, 9), (two, 3), (two, 4), (two, 4.5)])]
    df = spark.createDataFrame(rows, f"user {kind}, ts timestamp_ntz, id long, status string")
    got = failure_bursts(df, "user", "ts", ["ts", "id"], fail())
    assert got.schema["user"].dataType == df.schema["user"].dataType
    assert rows_of(got.select("user", "failures")) == sorted([(None, 2), (two, 3)], key=repr)


def test_burst_bounds(spark):
    df = logins(
        spark,
        (1, 0, "fail"), (1, 2, "fail"),                          # the end is included
        (2, 0, "fail"), (2, 1, "fail"), (2, 2, "success"),       # a success voids it
        (3, 0, "fail"), (3, 3, "fail"),
    )
    got = failure_bursts(df, "user", "ts", ["ts", "id"], fail())
    assert rows_of(got) == [(1, at(0), at(2), 2, "login fail in 2 seconds for 2 times")]
    with pytest.raises(ValueError):
        failure_bursts(df, "user", "ts", ["ts", "id"], fail(), times=1)


def orders(spark, *events):
    rows = [(o, at(s), kind) for o, s, kind in events]
    random.Random(2).shuffle(rows)
    return spark.createDataFrame(rows, ORDER)


ORDERS = [
    (1, 0, "create"), (1, 899, "pay"),
    (2, 0, "create"), (2, 900, "pay"),          # exactly the limit
    (3, 0, "create"),
    (4, 5, "pay"),
    (5, 10, "create"), (5, 10, "pay"),          # equal times
    (6, 10, "pay"), (6, 20, "create"),          # paid before created
    (7, 0, "create"), (7, 10, "create"), (7, 20, "pay"),
    (8, 0, "create"), (8, 2000, "create"), (8, 2010, "pay"), (8, 2020, "pay"),
]


@pytest.mark.parametrize("chunk", ["1 minute", "1 day"])
def test_order_timeouts(spark, chunk):
    got = order_timeouts(orders(spark, *ORDERS), "order_id", "ts", "kind", chunk=chunk)
    assert rows_of(got.select("order_id", "create_ts", "result_msg")) == sorted(
        [
            (1, at(0), "payed successfully"), (2, at(0), "time out"), (3, at(0), "time out"),
            (5, at(10), "payed successfully"), (6, at(20), "time out"),
            (7, at(0), "payed successfully"), (7, at(10), "payed successfully"),
            (8, at(0), "time out"), (8, at(2000), "payed successfully"),
        ],
        key=repr,
    )


@pytest.mark.parametrize("chunk", ["1 minute", "1 day"])
def test_order_states(spark, chunk):
    got = order_states(orders(spark, *ORDERS), "order_id", "ts", "kind", chunk=chunk)
    ok, late = "payed successfully", "payed but already timeout"
    lonely, timeout = "already payed but not found created log", "order timeout"
    want = [(1, "main", ok), (2, "side", late), (3, "side", timeout), (4, "side", lonely)]
    want += [(5, "main", ok), (6, "side", lonely), (6, "side", timeout), (7, "main", ok)]
    want += [(8, "side", timeout), (8, "main", ok), (8, "side", lonely)]
    assert rows_of(got) == sorted(want, key=repr)


def test_unpaid_orders_count_early_pays_and_the_limit_itself(spark):
    got = unpaid_orders(orders(spark, *ORDERS), "order_id", "ts", "kind")
    assert rows_of(got.select("order_id", "create_ts")) == [(3, at(0)), (8, at(0))]


@pytest.mark.parametrize("chunk", ["1 second", "13 seconds", "1 hour"])
def test_followed_by_equals_a_search(spark, chunk):
    rng = random.Random(8)
    events = [(rng.choice([1, 1, 1, 2]), rng.randrange(300), rng.choice(["create", "pay"])) for _ in range(120)]
    kind = F.col("kind")
    got = followed_by(
        orders(spark, *events), ["order_id"], "ts", kind == "create", kind == "pay", "13 seconds", chunk
    )
    want = []
    for o, s, k in events:
        if k == "create":
            later = [t for p, t, q in events if p == o and q == "pay" and s <= t < s + 13]
            want.append((o, at(s), at(min(later)) if later else None))
    assert rows_of(got.select("order_id", "ts", "then_ts")) == sorted(want, key=repr)


def test_click_cap(spark):
    rows = [(1, 9, at(i), i) for i in range(5)] + [(1, 9, at(86400 + i), 10 + i) for i in range(2)]
    rows += [(2, 9, at(i), 20 + i) for i in range(3)]
    df = spark.createDataFrame(rows, "user bigint, ad bigint, ts timestamp_ntz, id bigint")
    parts = capped_clicks(df, ["user", "ad"], "ts", ["ts", "id"], 3)
    assert sorted(r.id for r in parts["main"].collect()) == [0, 1, 2, 10, 11, 20, 21, 22]
    assert rows_of(parts["blacklist"]) == [(1, 9, "2024-01-01", "Click over 3 times today")]


READING = "id string, ts timestamp_ntz, n bigint, t double"


def readings(spark, *rows):
    return spark.createDataFrame(
        [(i, at(s), n, t) for n, (i, s, t) in enumerate(rows)], READING
    )


@pytest.mark.parametrize("chunk", ["2 seconds", "1 hour"])
def test_jumps_rises_and_minima(spark, chunk):
    df = readings(
        spark,
        ("a", 0, 10.0), ("a", 4, 21.0), ("a", 8, 22.0), ("a", 12, 23.0), ("a", 13, 5.0),
        ("a", 20, 6.0), ("a", 21, 6.0), ("b", 0, 99.0), ("b", 3, 89.0),
    )
    jumps = temperature_jumps(df, "id", "ts", ["ts", "n"], "t", chunk=chunk)
    assert rows_of(jumps.select("id", "ts", "last_temperature", "temperature")) == [
        ("a", at(13), 23.0, 5.0), ("a", at(4), 10.0, 21.0),
    ]
    rises = steady_rises(df, "id", "ts", ["ts", "n"], "t", chunk=chunk)
    assert rows_of(rises.select("id", "rise_start", "rise_end", "readings")) == [
        ("a", at(0), at(12), 4)
    ]
    lows = rolling_minimum(df, "id", "ts", ["ts", "n"], "t", chunk)
    assert [(r.n, r.min_temperature, r.first_ts) for r in lows.orderBy("n").collect()] == [
        (0, 10.0, at(0)), (1, 10.0, at(0)), (2, 10.0, at(0)), (3, 10.0, at(0)), (4, 5.0, at(0)),
        (5, 5.0, at(0)), (6, 5.0, at(0)), (7, 99.0, at(0)), (8, 89.0, at(0)),
    ]


@pytest.mark.parametrize("chunk", ["3 seconds", "1 hour"])
def test_rises_equal_a_walk(spark, chunk):
    rng = random.Random(5)
    rows = [("k", s, float(rng.randrange(100))) for s in sorted(rng.sample(range(1000), 200))]
    runs, current = [], []
    for row in rows:
        if current and row[2] > current[-1][2]:
            current.append(row)
        else:
            runs.append(current)
            current = [row]
    runs.append(current)
    want = [(at(r[0][1]), at(r[-1][1]), len(r)) for r in runs if len(r) > 1 and r[-1][1] - r[0][1] >= 10]
    got = steady_rises(readings(spark, *rows), "id", "ts", ["ts", "n"], "t", chunk=chunk)
    assert rows_of(got.select("rise_start", "rise_end", "readings")) == sorted(want, key=repr)
    assert want and secs(want[0][1]) > 0
