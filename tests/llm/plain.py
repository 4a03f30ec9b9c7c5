"""Plain versions that the operators are held against, and a fixture that makes documents."""

import collections
import os
import re
import sys
from pathlib import Path

import numpy as np
import pytest
import xxhash

REPO = str(Path(__file__).resolve().parents[2])
if REPO not in sys.path:
    sys.path.insert(0, REPO)
os.environ["PYTHONPATH"] = f"{REPO}:{os.environ.get('PYTHONPATH', '')}"  # for Python workers

from tidemark.llm import repetition  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_repetition(text):
    words = WORD.findall(text or "")

    def inside(n):
        seen = collections.Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        mark = [False] * len(words)
        for i in range(len(words) - n + 1):
            if seen[tuple(words[i : i + n])] > 1:
                mark[i : i + n] = [True] * n
        return mark

    seen, dup, chars = set(), 0, 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            if line in seen:
                dup, chars = dup + 1, chars + sum(map(len, WORD.findall(line)))
            seen.add(line)
    out = [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, sum(inside(5))]
    grams = [sum(len(w) for w, m in zip(words, inside(n)) if m) for n in repetition.GRAM_LIMITS]
    failed = out[0] < 10 or 100 * out[4] > 20 * out[0]
    good = chars <= 0.2 * out[1] and all(g <= limit * out[1] for g, limit in zip(grams, repetition.GRAM_LIMITS.values()))
    return (*out, failed, good and not failed, chars, *grams)


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def labels(values, distance):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    a = np.array(values, np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ a[i]) <= distance):
            p, q = find(i), find(i + 1 + int(j))
            root[max(p, q)] = min(p, q)
    return [find(i) for i in range(len(values))]


def plain_spans(text):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        s = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1]))
        if 16 <= len(d) <= 19 and s % 10 == 0:
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) or (doc_id, text, source); extra columns have names that operators use inside."""

    def build(rows, clash=False):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        if clash:
            for name in ("row", "host", "lines", "body", "ids", "fp", "u", "key", "score", "kept", "place", "template"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return build
