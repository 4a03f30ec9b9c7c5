"""SimHash near-duplicates against all pairs."""

import random

import numpy as np
import pytest

from plain import labels, make, plain_fingerprint  # noqa: F401

from tidemark.llm import simhash


def test_fingerprints():
    rng = random.Random(2)
    texts = ["", " \n", "One", "one two", "One TWO three", "a b c d", "É é x Y z", "same " * 500]
    texts += [" ".join(rng.choices(["aa", "Bb", "c", "d　e"], k=rng.randrange(40))) for _ in range(50)]
    for text in texts:
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)
    long = " ".join(rng.choices("abcdefgh", k=250_000))
    assert simhash.fingerprint(long.encode()) == plain_fingerprint(long)


@pytest.mark.parametrize(("small", "distance"), [(64, 2), (1, 2), (1, 1), (3, 3)])
def test_links_connect_what_all_pairs_connect(spark, small, distance):
    """Also with every block key crowded (small = 1), where links come through common neighbours."""
    rng = random.Random(4)
    values = [rng.getrandbits(64) for _ in range(40)]
    for _ in range(160):  # chains and clusters
        values.append(rng.choice(values) ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 4))))
    values = sorted(set(values))
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    marks = spark.createDataFrame([(v,) for v in signed], "fp long")
    edges = simhash.links(marks, distance, small)
    for a, b in edges.collect():
        assert a > b and bin((a ^ b) & (2**64 - 1)).count("1") <= distance
    found = dict(simhash.components(edges).collect())
    want = labels(values, distance)
    groups = {}
    for v, w in zip(signed, want):
        groups.setdefault(w, set()).add(found.get(v, v))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_documents(make):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(7, base), (3, base), (5, base + " end"), (9, None), (8, ""), (8, ""), (None, "nobody knows this one"), (2, "quite another text here")]
    out = simhash.near_duplicates(make(rows, clash=True)).collect()
    by = {r.doc_id: r.component_id for r in out}
    assert len(out) == len(rows)
    assert by[7] == by[3] == 3 and by[9] == by[8] == 8 and by[2] == 2 and by[None] is None
    values = [plain_fingerprint(t) for _, t in rows]
    assert (by[5] == 3) == ((values[0] ^ values[2]).bit_count() <= 2)
    kept = simhash.deduplicated(make(rows, clash=True))
    assert kept.columns == make(rows, clash=True).columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids.count(3) == 1 and ids.count(8) == 1 and ids.count(None) == 1 and 7 not in ids and 9 not in ids


def test_each_component_keeps_one_row_whatever_its_ids(make):
    """Two unlinked texts under one id, ids that repeat elsewhere, rows without an id, equal rows."""
    rng = random.Random(12)
    a, b, c = (" ".join(rng.choices([f"{x}{i}" for i in range(300)], k=200)) for x in "abc")
    rows = [(1, a), (1, b), (2, a), (3, b), (None, c), (None, c), (4, c), (5, "lone"), (5, "lone"), (None, None)]
    kept = [(r.doc_id, r.text) for r in simhash.deduplicated(make(rows, clash=True)).collect()]
    assert sorted(kept, key=str) == sorted([(1, a), (1, b), (4, c), (5, "lone"), (None, None)], key=str)


def test_empty_table(make):
    assert simhash.near_duplicates(make([])).count() == 0
    assert simhash.deduplicated(make([])).count() == 0


def test_a_long_chain_is_one_component(spark):
    rows = [(i + 1, i) for i in range(300)]
    found = dict(simhash.components(spark.createDataFrame(rows, "a long, b long")).collect())
    assert len(found) >= 300 and set(found.values()) == {0}
