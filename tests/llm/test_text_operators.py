"""Line dedup, mixing, repetition, fingerprints: edge cases and plain versions."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plain import make, plain_repetition  # noqa: F401

from tidemark.llm import linededup, mixing, multiset, repetition


def test_line_dedup_drops_lines_of_much_of_a_site(make):
    rows = [(i, f"Menu \nbody {i}\n\nMenu", "a") for i in range(5)] + [(9, "Menu\nalone", "b"), (10, "Menu", None), (11, None, "a"), (12, "", "a")]
    for clash in (False, True):
        out = {r.row.doc_id: r for r in linededup.dedup_lines(make(rows, clash), ratio=0.5).collect()}
        assert [out[i].text for i in range(5)] == [f"body {i}\n" for i in range(5)]
        assert out[0].n_lines == 4 and out[0].n_dropped == 2
        assert out[9].text == "Menu\nalone"  # one page is below min_pages
        assert out[10].text == "Menu" and out[11].text is None and out[12].text == ""
        assert out[11].n_lines == 0 and out[12].n_dropped == 0


def test_line_dedup_ratio_is_exclusive_and_counts_a_page_once(make):
    rows = [(i, f"x\nx\nx\n{i}" if i < 3 else f"y\n{i}", "a") for i in range(6)]
    out = {r.row.doc_id: r.text for r in linededup.dedup_lines(make(rows), ratio=0.5).collect()}
    assert out[0] == "x\nx\nx\n0" and out[5] == "y\n5"  # 3 of 6 pages each: not above one half
    out = {r.row.doc_id: r.text for r in linededup.dedup_lines(make(rows), ratio=0.49).collect()}
    assert out[0] == "0" and out[5] == "5"


def test_line_dedup_takes_copies_for_one_page(make):
    """A group of copies that holds a third of a site keeps its lines, and its copies are cleaned alike."""
    rows = [(i, "copied text\nof many lines\nMenu", "a") for i in range(20)] + [(100 + i, f"own {i}\nMenu", "a") for i in range(40)]
    rows += [(200, None, "a"), (201, "", "a"), (202, None, "a")]
    out = {r.row.doc_id: r.text for r in linededup.dedup_lines(make(rows)).collect()}
    assert {out[i] for i in range(20)} == {"copied text\nof many lines"}
    assert all(out[100 + i] == f"own {i}" for i in range(40)) and out[200] is None and out[201] == ""


def test_line_dedup_of_very_long_texts_and_lines(make):
    long = "z" * 300_000
    rows = [(i, "\n".join(f"{i} {k}" for k in range(20_000)) + f"\n{long}\nend", "a") for i in range(4)]
    out = {r.row.doc_id: r for r in linededup.dedup_lines(make(rows), ratio=0.5).collect()}
    assert all(out[i].text == "\n".join(f"{i} {k}" for k in range(20_000)) and out[i].n_dropped == 2 for i in range(4))


def test_rates_of_zero_weights_and_sizes(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 0), ("c", 5)], "source string, size long")
    weights = lambda *x: spark.createDataFrame(x, "source string, weight double")
    rates = lambda w: {r.source: r.rate for r in mixing.rates_for(sizes, w).collect()}
    assert rates(weights(("a", 0.0), ("b", 0.0))) == {"a": 0.0, "b": 0.0, "c": 0.0}
    assert rates(weights(("a", 1.0), ("b", 1.0))) == {"a": 0.75, "b": 0.0, "c": 0.0}
    assert rates(weights()) == {"a": 0.0, "b": 0.0, "c": 0.0}


def test_line_dedup_of_an_empty_table(make):
    assert linededup.dedup_lines(make([])).count() == 0


def test_poisson_cdf_inverts_to_the_right_mean():
    for rate in (0.01, 0.7, 3.0, 40.0, 5000.0):
        cdf = mixing.poisson_cdf(rate)
        mean = sum(1 - p for p in cdf)
        assert mean == pytest.approx(rate, rel=1e-6)
        assert cdf[-1] == pytest.approx(1, abs=1e-9)
    assert list(mixing.poisson_cdf(0.0)) == [1.0]


def test_mixing_meets_weights_and_repeats_itself(make, spark):
    rows = [(i, "t", "big") for i in range(3000)] + [(3000 + i, "t", "small") for i in range(300)] + [(5000, "t", "none")]
    docs = make(rows, clash=True)
    sizes = docs.groupBy("source").agg(F.count(F.lit(1)).alias("size"))
    weights = spark.createDataFrame([("big", 1.0), ("small", 1.0)], "source string, weight double")
    rates = mixing.rates_for(sizes, weights, total=3000)
    out = [(r.row.doc_id, r.copy, r.row.source) for r in mixing.mix(docs, rates).collect()]
    count = collections.Counter(x[2] for x in out)
    assert abs(count["big"] - 1500) < 150 and abs(count["small"] - 1500) < 200 and count["none"] == 0
    again = [(r.row.doc_id, r.copy, r.row.source) for r in mixing.mix(docs.repartition(7), rates).collect()]
    assert sorted(out) == sorted(again) and len(set(out)) == len(out)
    assert [x[0] for x in out] != sorted(x[0] for x in out)


def test_mixing_nulls_and_empty_tables(make):
    docs = make([(None, None, None), (1, "", None), (2, "abc", "a"), (2, "abc", "a")])
    rates = mixing.smoothed_rates(docs, alpha=1.0)
    assert {r.source: round(r.rate, 9) for r in rates.collect()} == {None: 1.0, "a": 1.0}
    copies = collections.Counter(r.row.doc_id for r in mixing.mix(docs, rates).collect())
    assert copies[2] % 2 == 0  # repeated rows draw alike
    empty = make([])
    assert mixing.mix(empty, mixing.smoothed_rates(empty)).count() == 0


def test_repetition_against_a_plain_version(make):
    rng = random.Random(3)
    texts = [None, "", "\n \t\n", "a", "é é 　x", "x\nx\n x\nx", "w " * 30000, "\x0b\x0c a\x1fb\x85c"]
    for _ in range(60):
        words = [rng.choice(["aa", "b", "cc#", "dé", "|", "e.", "f"]) for _ in range(rng.randrange(60))]
        texts.append("".join(w + rng.choice([" ", " ", "\n", "\t", "  "]) for w in words))
    docs = make(list(enumerate(texts)) + [(0, None)], clash=True)
    found = repetition.repetition(docs).collect()
    assert len(found) == len(texts) + 1
    for r in found:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept, r.dup_line_chars)
        got += tuple(r[f"dup_chars_{n}"] for n in repetition.GRAM_LIMITS)
        assert got == plain_repetition(texts[r.row.doc_id]), texts[r.row.doc_id]


def marks(make, texts):
    docs = make(list(enumerate(texts)))
    return [r.m for r in docs.select("doc_id", multiset.lanes(F.col("text")).alias("m")).orderBy("doc_id").collect()]


def test_fingerprints_are_homomorphic(make, spark):
    a, b, ab, ba, aab = marks(make, ["one. Two!\nthree", "four\n\nfive. six", "one. Two!\nthree\nfour\nfive. six", "five. six\nfour\n three \none. Two!", "one. Two!\none. Two!\nthree"])
    assert ab == ba and a != aab
    pair = spark.createDataFrame([(a, b, ab)], "a struct<equal:array<bigint>,like:array<int>>, b struct<equal:array<bigint>,like:array<int>>, ab struct<equal:array<bigint>,like:array<int>>")
    got = pair.select(
        (multiset.combined(F.col("a"), F.col("b")) == F.col("ab")).alias("sum"),
        (multiset.combined(F.col("ab"), F.col("b"), -1) == F.col("a")).alias("difference"),
    ).first()
    assert got["sum"] and got["difference"]


def test_fingerprint_lanes_against_a_plain_version(make):
    import xxhash

    text = "First one. Second! Third?\n\n  lone  \nlast"
    (mark,) = marks(make, [text])
    signed = lambda seed, s: xxhash.xxh64_intdigest(s.encode(), xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), 42))
    parts = ["First one. Second! Third?", "lone", "last"]
    equal = [sum(signed(seed, p) >> s & 0xFFFFFFFF for p in parts) % 2**32 for seed in range(4) for s in (0, 32)]
    assert mark.equal == equal
    sentences = ["First one.", "Second!", "Third?", "lone", "last"]
    like = [sum(1 if signed(seed, s) >> bit & 1 else -1 for s in sentences) for seed in (100, 101) for k in range(32) for bit in (k, k + 32)]
    assert mark.like == like


@pytest.mark.parametrize("ids", [[5, 3, 9, 1], [7], [None, 4, 2]])
def test_edited_texts(make, ids):
    texts = {i: "".join(random.Random(str(i)).choices("abcé\n. ", k=5 + (i or 0) * 7)) for i in ids}
    out = {r.doc_id: r for r in multiset.fingerprint_edits(make(list(texts.items()))).collect()}
    order = sorted(ids, key=lambda i: -(2**63) if i is None else i, reverse=True)
    for k, i in enumerate(order):
        text, following = texts[i], texts[order[(k + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert out[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert out[i].n_chars == len(text) and 0 <= out[i].near_edited <= 1
        assert out[i].near_next == (1.0 if text == following else pytest.approx(out[i].near_next))


def test_fingerprints_of_nulls_repeats_and_empty_tables(make):
    rows = [(1, None), (2, ""), (3, "same"), (3, "same"), (4, "same")]
    out = multiset.fingerprint_edits(make(rows, clash=True)).collect()
    assert len(out) == 5
    by = collections.defaultdict(set)
    for r in out:
        by[r.doc_id].add((r.fingerprint, r.n_chars))
    assert by[1] == by[2] and by[3] == by[4] and len(by[3]) == 1
    assert next(r for r in out if r.doc_id == 4).near_next == 1.0
    assert multiset.fingerprint_edits(make([])).count() == 0


def test_likeness_follows_shared_sentences(make, spark):
    rng = random.Random(1)
    lines = [f"{rng.random()} sentence." for _ in range(400)]
    texts = ["\n".join(lines[:200]), "\n".join(lines[:150] + lines[200:250]), "\n".join(lines[200:400])]
    a, b, c = marks(make, texts)
    kind = "struct<equal:array<bigint>,like:array<int>>"
    df = spark.createDataFrame([(a, b, c)], f"a {kind}, b {kind}, c {kind}")
    x, y = df.select(multiset.likeness(F.col("a"), F.col("b")), multiset.likeness(F.col("a"), F.col("c"))).first()
    assert abs(x - 0.75) < 0.2 and y < 0.3


def thue_morse(n):
    return [bin(i).count("1") & 1 for i in range(n)]


def test_sequences_that_defeat_polynomial_hashes_stay_different(make):
    """A Thue-Morse sequence and its complement have one hash under every odd base modulo a power of two."""
    bits = thue_morse(2048)
    lines = ["".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)]
    words = [" ".join("ab"[b] for b in bits), " ".join("ba"[b] for b in bits)]
    texts = ["\n".join(lines), "\n".join(words), "\n".join(lines + lines[:1]), "\n".join(words[1:])]
    for r, text in zip(sorted(repetition.repetition(make(list(enumerate(texts)))).collect(), key=lambda r: r.row.doc_id), texts):
        want = plain_repetition(text)
        assert tuple(getattr(r, c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want[:5]


def test_equal_hashes_are_compared_word_by_word(monkeypatch):
    from tidemark.llm import wordhash

    monkeypatch.setattr(wordhash._Prefix, "of", lambda self, a, b: np.zeros(len(a), np.uint64))
    texts = ["a b c a b d a b c", "x y z", "a b c x a b c", ""]
    t = wordhash.Texts([x.encode() for x in texts])
    first, again, before = t.repeated(3)
    got = [(int(t.doc[i]), int(i - np.flatnonzero(t.doc == t.doc[i])[0]), bool(x), bool(y)) for i, x, y in zip(first, again, before)]
    want = []
    for d, text in enumerate(texts):
        w = text.split()
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        want += [(d, i, grams.count(g) > 1, g in grams[:i]) for i, g in enumerate(grams)]
    assert got == want


def test_repetition_of_an_empty_table(make):
    assert repetition.repetition(make([])).collect() == []


def test_likeness_of_very_repetitive_and_of_unmarked_texts(make):
    """Lanes do not wrap at 2^15 equal sentences; a long paragraph without sentence marks is compared in parts."""
    many, fewer = "a\n" * 40_001, "a\n" * 30_000
    out = {r.doc_id: r for r in multiset.fingerprint_edits(make([(2, many), (1, fewer)])).collect()}
    assert out[2].near_next == pytest.approx(2 * 40_001 * 30_000 / (40_001**2 + 30_000**2), abs=1e-9)
    rng = random.Random(1)
    text = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(4000))
    other = " ".join("".join(rng.choices("ijklmnop", k=6)) for _ in range(4000))
    out = {r.doc_id: r for r in multiset.fingerprint_edits(make([(2, text), (1, other)])).collect()}
    assert 0.25 < out[2].near_edited < 0.75 and out[2].near_next < 0.3
