"""Spelling variants against all pairs."""

import collections
import random
import re
import zlib

import pytest
from plain import make  # noqa: F401

from tidemark.llm import spelling


def near(a, b):
    """Exactly one letter inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain_counts(rows, shortest=5, least=3):
    out = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            out[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in out.items() if len(w) >= shortest and n >= least}


def plain_variants(words):
    out = {}
    for w, n in words.items():
        around = [v for v in words if near(w, v)]
        best = min(around, key=lambda v: (-words[v], v), default=None)
        out[w] = [best if best and words[best] >= 2 * n else None, n, len(around)]
    full = {}
    for w, (form, n, n_near) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        full[w] = (form, root, n, n_near, words[form] if form else None)
    return full


def result(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_against_all_pairs(spark):
    rng = random.Random(3)
    stems = ["".join(rng.choice("abÀé") for _ in range(rng.randrange(4, 9))) for _ in range(60)]
    rows = []
    for i in range(300):
        words = []
        for _ in range(60):
            w = rng.choice(stems) if rng.random() < 0.8 else rng.choice(stems[:6])
            if rng.random() < 0.3:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("abÀé") + w[k:], w[:k] + rng.choice("abÀé") + w[k + 1 :]])
            words.append(w.upper() if w.isascii() and rng.random() < 0.1 else w)
        rows.append((i, rng.choice([" ", "-", "1", "\n"]).join(words)))
    rows += [(7, "hello world"), (7, "hello world"), (7, "hello world"), (None, "nulls nulls nulls"), (8, None), (9, "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, word string").repartition(4)
    want = plain_variants(plain_counts(rows))
    got = result(spelling.variants(df))
    assert len(want) > 200 and got == want
    assert any(v[0] and v[1] != v[0] for v in want.values())  # some forms lead on


@pytest.mark.parametrize("seed,letters,longest", [(1, "ab", 9), (2, "abc", 6), (3, "a", 12)])
def test_neighbours_of_dense_vocabularies(spark, seed, letters, longest):
    """Words that begin one another, runs of one letter, ties between the places of an edit."""
    rng = random.Random(seed)
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(1, longest))) for _ in range(150)})
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = [tuple(r) for r in spelling.neighbours(df).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in words for b in words if near(a, b)}


def test_very_long_words(spark):
    """Thousands of letters take no more rounds than places where words part."""
    long = "ab" * 4000
    words = [long, long + "c", "x" + long, long[:4000] + long[4001:], long[:-1] + "z", "short", "shorts"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = {tuple(r) for r in spelling.neighbours(df).collect()}
    assert got == {(a, b) for a in words for b in words if near(a, b)}


def test_chains_of_forms(spark):
    links = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(40)] + [("u", "w7")], "word string, form string")
    assert {tuple(r) for r in spelling.roots(links).collect()} == {(f"w{i}", "w40") for i in range(40)} | {("u", "w40")}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert result(spelling.variants(empty)) == {}
    assert result(spelling.variants(spark.createDataFrame([(1, None), (2, "one one one")], empty.schema))) == {}
    once = spark.createDataFrame([(1, "lonely lonely lonely lonely")], empty.schema)
    assert result(spelling.variants(once)) == plain_variants(plain_counts([(1, "lonely lonely lonely lonely")]))
