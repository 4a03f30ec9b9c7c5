"""Words of many texts at once, in numpy: where they are, what they are, and rolling hashes of word n-grams.

Texts are laid end to end as UTF-8 bytes. Words and lines are told apart by their bytes. The hash of an n-gram is the
difference of two prefix sums of value times a power of an odd base, times the power's inverse, all modulo 2 ** 64: every
n-gram's hash comes from the same prefix sums. N-grams of equal hash are compared word by word before they count as equal.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled together; a longer text is handled by itself.
POOL = 1_000_000
_WORD_BASE = 0xD6E8FEB86659FD93
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of the input over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Prefix:
    """Hashes of stretches of `values`."""

    def __init__(self, values: np.ndarray, base: int):
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values.astype(np.uint64) * _powers(base, n)[:n], out=self.sums[1:])
        self.inverse = _powers(pow(base, -1, 1 << 64), n)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def repeats(hashes: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each element, whether its group holds the same hash elsewhere, and whether before it. Groups ascend."""
    order = np.argsort(hashes, kind="stable")
    same = (hashes[order][1:] == hashes[order][:-1]) & (group[order][1:] == group[order][:-1])
    before, any_ = np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)
    before[order[1:]] = same
    any_[order[1:]] |= same
    any_[order[:-1]] |= same
    return any_, before


class _Numbers(dict):
    """Numbers things in the order in which they are met."""

    def __missing__(self, key) -> int:
        self[key] = number = len(self)
        return number


def numbered(things: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_Numbers().__getitem__, things), np.int64, len(things))


def summed(values: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    return np.bincount(group, weights=values, minlength=groups).astype(np.int64)


class Texts:
    """`n` texts: for each word its text, start, end, code points and number (equal words have one), and for each line its text, start and end."""

    def __init__(self, texts: list[bytes]):
        self.n = len(texts)
        sizes = np.array([len(t) for t in texts], np.int64)
        # one line feed after each text ends its last word and line
        self.data = b"".join(t + b"\n" for t in texts)
        self.raw = np.frombuffer(self.data, np.uint8)
        self.begin = np.cumsum(sizes + 1) - (sizes + 1)
        self.end = self.begin + sizes
        self.points = np.concatenate([[0], np.cumsum((self.raw & 0xC0) != 0x80)])
        space = _SPACE[self.raw]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))
        self.start, self.stop = edge[::2], edge[1::2]
        self.doc = np.searchsorted(self.end, self.start, side="left") if len(edge) else np.empty(0, np.int64)
        self.chars = self.points[self.stop] - self.points[self.start]
        self.word = numbered(self.data.split())  # splits at the same bytes
        self.by_word = _Prefix(_mixed(self.word.astype(np.uint64) + np.uint64(_WORD_BASE)), _WORD_BASE)
        self.n_words = np.bincount(self.doc, minlength=self.n)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of n words within one text, and the windows' hashes."""
        if len(self.word) < n:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        first = np.flatnonzero(self.doc[: len(self.doc) - n + 1] == self.doc[n - 1 :])
        return first, self.by_word.of(first, first + n)

    def repeated(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First words of all windows of n words; whether the text has the window's words elsewhere, and whether before."""
        first, hashes = self.grams(n)
        doc = self.doc[first]
        order = np.argsort(hashes, kind="stable")
        met = (hashes[order][1:] == hashes[order][:-1]) & (doc[order][1:] == doc[order][:-1])
        a, b = first[order[:-1][met]], first[order[1:][met]]
        if any((self.word[a + i] != self.word[b + i]).any() for i in range(n)):  # one hash of different windows: by the words
            words = np.stack([self.word[first + i] for i in range(n)])
            hashes = np.unique(words, axis=1, return_inverse=True)[1].reshape(-1)
        return first, *repeats(hashes, doc)

    def covered(self, first: np.ndarray, n: int) -> np.ndarray:
        """Whether each word lies in one of the windows of n words that begin at `first`."""
        change = np.zeros(len(self.word) + 1, np.int64)
        np.add.at(change, first, 1)
        np.add.at(change, first + n, -1)
        return np.cumsum(change)[:-1] > 0

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the lines with a word: text, start, end, and whether an equal line comes before in the text."""
        feed = np.flatnonzero(self.raw == 10)
        start = np.concatenate([[0], feed[:-1] + 1]) if len(feed) else feed
        word_at = np.searchsorted(self.start, start)
        filled = np.zeros(len(start), bool)
        inside = word_at < len(self.start)
        filled[inside] = self.start[word_at[inside]] < feed[inside]
        start, feed = start[filled], feed[filled]
        doc = np.searchsorted(self.end, start, side="left")
        _, before = repeats(numbered([self.data[a:b] for a, b in zip(start.tolist(), feed.tolist())]), doc)
        return doc, start, feed, before

    def count_bytes(self, which: np.ndarray) -> np.ndarray:
        """How many bytes of each text are in the table `which` of 256 booleans."""
        sums = np.concatenate([[0], np.cumsum(which[self.raw])])
        return sums[self.end] - sums[self.begin]


def pools(
    batches: Iterable[pa.RecordBatch], text: str | tuple[str, str] = "text", size: int = POOL
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with their texts as bytes (null: empty), of some `size` bytes each.

    `text` names a column, or a struct column and its field, which saves a second copy of texts that a row holds.
    """
    for batch in batches:
        column = batch.column(text) if isinstance(text, str) else batch.column(text[0]).field(text[1])
        column = column.cast(pa.binary())
        lengths = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(lengths.astype(np.int64)) // size
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(lengths)] if len(lengths) else [0]
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a), [x or b"" for x in column.slice(a, b - a).to_pylist()]
