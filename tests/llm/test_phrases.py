"""Phrases against a plain count, and the counting quotient filters by themselves."""

import collections
import random
import re

import numpy as np
import pytest
from plain import make  # noqa: F401

from tidemark.llm import phrases, quotient


def plain_phrases(rows, least, top=2000, contained=80):
    """rows: (lang, text). {lang: [(phrase, a, l, r, n, score)]}"""
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    f[lang][tuple(words[i : i + size])] += 1
    out = {}
    for lang, counts in f.items():
        found = []
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        for p, a in candidates.items():
            cut = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            held = any(
                len(q) > len(p) and 100 * b >= contained * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in candidates.items()
            )
            if not held:
                found.append((" ".join(p), a, counts[p[: cut[1]]], counts[p[cut[1] :]], n[lang], cut[0]))
        found.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        if found:
            out[lang] = found[:top]
    return out


def spark_phrases(df, **options):
    out = collections.defaultdict(list)
    for r in sorted(phrases.phrases(df, **options).collect(), key=lambda r: (r.lang, r["rank"])):
        out[r.lang].append((r.phrase, r.a, r.l, r.r, r.n, r.score))
        assert r["rank"] == len(out[r.lang])
    return dict(out)


def texts(seed, n=120):
    rng = random.Random(seed)
    words = ["a", "b", "c", "Dé", "x'y", "é", "zz z", "A", "#"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "!", " ? "]
    return ["".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randrange(40))) for _ in range(n)]


@pytest.mark.parametrize("least,top", [(3, 2000), (12, 7)])
def test_against_plain_counts(spark, monkeypatch, least, top):
    monkeypatch.setattr(phrases, "SHARD", 500)
    rows = [("en" if i % 3 else None, t) for i, t in enumerate(texts(1))] + [("de", "Guten Tag, guten TAG. " * 9), ("fr", ""), ("fr", None)]
    df = spark.createDataFrame([(x, t, "clash", 7) for x, t in rows], "lang string, text string, block string, ids int").repartition(5)
    assert spark_phrases(df, least=least, top=top) == plain_phrases(rows, least, top)


def test_repeated_rows_count_each_time_and_ties_follow_bytes(spark):
    rows = [("en", "p q. é z. r s")] * 4
    df = spark.createDataFrame(rows, "lang string, text string")
    assert [x[0] for x in spark_phrases(df, least=4)["en"]] == ["p q", "r s", "é z"]
    assert spark_phrases(df, least=5) == {}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert spark_phrases(empty) == {}
    assert spark_phrases(spark.createDataFrame([(None, None), ("en", " \t.\n")], empty.schema)) == {}


def test_long_texts_are_cut_without_losing_phrases(spark, monkeypatch):
    """Small slices and blocks: a text is cut in the middle of phrases."""
    rng = random.Random(5)
    text = " ".join(rng.choice("abc") for _ in range(5000))
    found = list(phrases._tokens(text.encode()))
    monkeypatch.setattr(phrases, "SLICE", 64)
    parts = list(phrases._tokens(text.encode()))
    assert len(parts) > 50 and sum(parts, []) == sum(found, [])
    monkeypatch.setattr(phrases, "BLOCK", 50)
    ids = np.array([rng.randrange(4) for _ in range(1000)])
    counted = collections.Counter()
    for at in range(0, len(ids), 50):
        for batch in phrases._filters("en", ids[at : at + 53], 2, 1, 4):
            for size, shard, data in zip(*(batch.column(c).to_pylist() for c in ("size", "shard", "filter"))):
                high, low, counts = quotient.entries(data, shard, size, 2, 1)
                for *key, c in zip(*(x.tolist() for x in quotient.restored(high, low, size, 2)), counts.tolist()):
                    counted[tuple(key)] += c
    want = collections.Counter(
        tuple(ids[i : i + n].tolist()) for n in (2, 3, 4) for i in range(len(ids) - n + 1) if (ids[i : i + n] > 0).all()
    )
    assert counted == want


@pytest.mark.parametrize("size", [2, 3, 4])
@pytest.mark.parametrize("bits", [1, 2, 7, 16, 17, 24, 32])
def test_filters_lose_nothing(bits, size):
    """Pack, permute, filter, read, merge and restore: the n-grams and counts come back, at every width."""
    rng = np.random.default_rng(bits)
    shard_bits = min(3, bits)
    total, parts = collections.Counter(), collections.defaultdict(list)
    for _ in range(4):
        ids = [rng.integers(1, min(1 << bits, 40), 3000, endpoint=bits == 1).astype(np.uint64) for i in range(size)]
        if bits == 1:
            ids = [x & np.uint64(1) for x in ids]
        if bits == 32:
            ids[0] |= np.uint64(0xFFFF0000)
        total.update(zip(*(x.tolist() for x in ids)))
        run = quotient.summed(*quotient.permuted(ids, bits), None, size, bits)
        high, low, counts = run[0], run[1], run[2] * 300  # counters of several bytes
        shards = quotient.shard_of(high, size, bits, shard_bits)
        for s in np.unique(shards).tolist():
            part = tuple(x[shards == s] for x in (high, low, counts))
            back = quotient.entries(quotient.filter_of(part, size, bits, shard_bits), s, size, bits, shard_bits)
            assert all(np.array_equal(x, y) for x, y in zip(back, part))
            parts[s].append(back)
    out = {}
    for runs in parts.values():
        high, low, counts = quotient.merged(runs, size, bits)
        out |= dict(zip(zip(*(x.tolist() for x in quotient.restored(high, low, size, bits))), (counts // 300).tolist()))
    assert out == total


def test_equal_leading_bits_with_different_rests():
    """Beyond 64 bits the sort key is only a part of an n-gram; the rest decides."""
    high = np.array([5, 5, 5, 4], np.uint64)
    low = np.array([(1 << 40) + 1, 1 << 40, (1 << 40) + 1, 3], np.uint64)
    out = quotient.summed(high, low, None, 4, 22)
    assert [x.tolist() for x in out] == [[4, 5, 5], [3, 1 << 40, (1 << 40) + 1], [1, 1, 2]]
