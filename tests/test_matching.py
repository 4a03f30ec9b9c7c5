import random

import pytest

from conftest import at, rows_of
from tidemark.operators.matching import interval_join, reconcile, reconciled, window_join

PAY, RECEIPT = "tx string, pay_ts timestamp_ntz, p bigint", "tx string, rec_ts timestamp_ntz, r bigint"


def sides(spark, seed=1, n=120):
    rng = random.Random(seed)
    keys = ["hot"] * 5 + ["a", "b", None]
    pays = [(rng.choice(keys), at(rng.randrange(600)), i) for i in range(n)]
    receipts = [(rng.choice(keys), at(rng.randrange(600)), i) for i in range(n)]
    pays.append(("a", None, n))
    return pays, receipts, spark.createDataFrame(pays, PAY), spark.createDataFrame(receipts, RECEIPT)


def pairs_within(pays, receipts, low, high):
    return [
        (p, r)
        for p in pays
        for r in receipts
        if p[0] is not None and p[0] == r[0] and p[1] is not None
        and low <= (r[1] - p[1]).total_seconds() <= high
    ]


@pytest.mark.parametrize("how", ["inner", "left_outer", "full_outer"])
@pytest.mark.parametrize("bucket", [None, "35 seconds", "1 day"])
def test_interval_join(spark, how, bucket):
    pays, receipts, left, right = sides(spark)
    got = interval_join(
        left, right, "tx", "pay_ts", "rec_ts", "-15 seconds", "20 seconds", how, bucket
    )
    found = pairs_within(pays, receipts, -15, 20)
    want = [(p[0], p[1], p[2], r[1], r[2]) for p, r in found]
    if how != "inner":
        matched = {p[2] for p, _ in found}
        want += [(*p, None, None) for p in pays if p[2] not in matched]
    if how == "full_outer":
        matched = {r[2] for _, r in found}
        want += [(r[0], None, None, r[1], r[2]) for r in receipts if r[2] not in matched]
    assert rows_of(got) == sorted(want, key=repr)


def test_bounds_are_included_and_repeats_kept(spark):
    left = spark.createDataFrame([("x", at(100), 1), ("x", at(100), 1)], PAY)
    right = spark.createDataFrame([("x", at(s), s) for s in (84, 85, 120, 121)], RECEIPT)
    got = interval_join(left, right, "tx", "pay_ts", "rec_ts", "-15 seconds", "20 seconds")
    assert sorted(r.r for r in got.collect()) == [85, 85, 120, 120]


def test_unknown_join_type(spark):
    _, _, left, right = sides(spark, n=1)
    with pytest.raises(ValueError):
        interval_join(left, right, "tx", "pay_ts", "rec_ts", "-1 second", "1 second", "right_outer")


def test_reconcile(spark):
    left = spark.createDataFrame(
        [("a", at(10), 1), ("b", at(10), 2), ("c", at(10), 3), ("d", at(10), 4)], PAY
    )
    right = spark.createDataFrame(
        [("a", at(15), 1), ("b", at(16), 2), ("c", at(7), 3), ("e", at(0), 5)], RECEIPT
    )
    parts = reconciled(left, right, "tx", "pay_ts", "rec_ts")
    assert {k: sorted(r.tx for r in v.collect()) for k, v in parts.items()} == {
        "matched": ["a", "c"], "unmatched_pay": ["b", "d"], "unmatched_receipt": ["b", "e"],
    }
    assert reconcile(left, right, "tx", "pay_ts", "rec_ts").count() == 6


def test_window_join_needs_the_same_window(spark):
    left = spark.createDataFrame([("a", at(14), 1), ("b", at(0), 2)], PAY)
    right = spark.createDataFrame([("a", at(15), 1), ("b", at(14), 2), ("b", at(1), 3)], RECEIPT)
    got = window_join(left, right, "tx", "pay_ts", "rec_ts", "15 seconds")
    assert rows_of(got.select("tx", "p", "r", "window_start")) == [
        ("b", 2, 2, at(0)), ("b", 2, 3, at(0)),
    ]
