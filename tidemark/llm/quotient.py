"""Counting quotient filters without loss, over n-grams of word ids.

An n-gram of `size` ids is packed into a number of `size * bits` bits, which a Feistel network permutes: equal n-grams stay
equal, different ones stay different, and their leading bits are spread evenly. The leading bits name the shard, the next
ones are the quotient, and the rest is the remainder, kept in full: quotient and remainder give the n-gram back. A filter
holds, sorted, which quotients occur, where each one's run of remainders ends, the remainders, and their counters, of
which those of 1 take one bit.

A permuted n-gram is a pair of numbers: its high half, of `widths(...)[0]` bits, and its low half.
"""

from __future__ import annotations

import numpy as np

#: Ids of the longest n-gram: each half fits into 64 bits, with ids of up to 32.
LONGEST = 4
_ROUNDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)

Run = tuple[np.ndarray, np.ndarray, np.ndarray]


def widths(size: int, bits: int) -> tuple[int, int]:
    """Bits of the two halves; of an odd number of ids, the high half has one more."""
    return (size + 1) // 2 * bits, size // 2 * bits


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def _scrambled(x: np.ndarray, key: int, bits: int) -> np.ndarray:
    x = (x ^ np.uint64(key)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(29)
    return (x ^ (x >> np.uint64(47))) & _mask(bits)


def permuted(ids: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The halves of the permuted n-grams whose i-th ids are `ids[i]`."""
    h, l = widths(len(ids), bits)
    halves = [np.zeros(len(ids[0]), np.uint64), np.zeros(len(ids[0]), np.uint64)]
    for i, x in enumerate(ids):
        half = int(i >= (len(ids) + 1) // 2)
        halves[half] = (halves[half] << np.uint64(bits)) | x.astype(np.uint64)
    high, low = halves
    for first, second in zip(_ROUNDS[::2], _ROUNDS[1::2]):
        high ^= _scrambled(low, first, h)
        low ^= _scrambled(high, second, l)
    return high, low


def restored(high: np.ndarray, low: np.ndarray, size: int, bits: int) -> list[np.ndarray]:
    """The ids again."""
    h, l = widths(size, bits)
    high, low = high.copy(), low.copy()
    for first, second in zip(_ROUNDS[-2::-2], _ROUNDS[::-2]):
        low ^= _scrambled(high, second, l)
        high ^= _scrambled(low, first, h)
    out = []
    for half, n in ((high, (size + 1) // 2), (low, size // 2)):
        out += [(half >> np.uint64(bits * (n - 1 - i))) & _mask(bits) for i in range(n)]
    return out


def summed(high: np.ndarray, low: np.ndarray, counts: np.ndarray | None, size: int, bits: int) -> Run:
    """Distinct n-grams in ascending order and the sums of their counts (none given: 1 each)."""
    h, l = widths(size, bits)
    whole = h + l <= 64
    if whole:
        key = (high << np.uint64(l)) | low
    else:  # the leading 64 bits; equal ones with another rest need the full order
        key = (high << np.uint64(64 - h)) | (low >> np.uint64(h + l - 64))
    order = np.argsort(key, kind="stable")
    high, low, key = high[order], low[order], key[order]
    near = key[1:] == key[:-1]
    if not whole and (near & (low[1:] != low[:-1])).any():
        again = np.lexsort((low, high))
        high, low, order = high[again], low[again], order[again]
        near = (high[1:] == high[:-1]) & (low[1:] == low[:-1])
    first = np.flatnonzero(np.concatenate([[True], ~near])) if len(high) else np.empty(0, np.int64)
    if counts is None:
        sums = np.diff(np.append(first, len(high)))
    else:
        sums = np.add.reduceat(counts[order], first) if len(first) else np.empty(0, np.int64)
    return high[first], low[first], sums.astype(np.int64)


def _packed(values: np.ndarray, bits: int) -> bytes:
    width = (bits + 7) // 8
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpacked(data: memoryview, n: int, bits: int) -> tuple[np.ndarray, memoryview]:
    width = (bits + 7) // 8
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data[: n * width], np.uint8).reshape(n, width)
    return out.reshape(-1).view("<u8"), data[n * width :]


def _flags(data: memoryview, n: int) -> tuple[np.ndarray, memoryview]:
    size = (n + 7) // 8
    return np.unpackbits(np.frombuffer(data[:size], np.uint8), count=n).astype(bool), data[size:]


def shard_of(high: np.ndarray, size: int, bits: int, shard_bits: int) -> np.ndarray:
    return (high >> np.uint64(widths(size, bits)[0] - shard_bits)).astype(np.int64) if shard_bits else np.zeros(len(high), np.int64)


def filter_of(run: Run, size: int, bits: int, shard_bits: int) -> bytes:
    """The filter of distinct ascending n-grams of one shard with their counts."""
    high, low, counts = run
    n, (h, l) = len(high), widths(size, bits)
    q = min(max(n, 1).bit_length(), h - shard_bits)
    rest = h - shard_bits - q
    quotient = ((high >> np.uint64(rest)) & _mask(q)).astype(np.int64)
    occupied = np.zeros(1 << q, bool)
    occupied[quotient] = True
    ends = np.append(quotient[1:] != quotient[:-1], True) if n else np.empty(0, bool)
    more = counts > 1
    long = counts[more] - 2
    return b"".join([
        np.array([n, q], "<u4").tobytes(), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(),
        _packed(high & _mask(rest), rest), _packed(low, l), np.packbits(more).tobytes(),
        np.minimum(long, 255).astype(np.uint8).tobytes(), long[long >= 255].astype("<i8").tobytes(),
    ])


def entries(data: bytes, shard: int, size: int, bits: int, shard_bits: int) -> Run:
    """The n-grams in a filter, ascending, and their counts."""
    n, q = np.frombuffer(data[:8], "<u4").tolist()
    view, (h, l) = memoryview(data)[8:], widths(size, bits)
    rest = h - shard_bits - q
    occupied, view = _flags(view, 1 << q)
    ends, view = _flags(view, n)
    run = np.cumsum(ends) - ends  # of each entry: the number of runs that ended before it
    quotient = np.flatnonzero(occupied)[run].astype(np.uint64)
    high, view = _unpacked(view, n, rest)
    low, view = _unpacked(view, n, l)
    more, view = _flags(view, n)
    long = np.frombuffer(view[: int(more.sum())], np.uint8).astype(np.int64)
    view = view[len(long) :]
    long[long == 255] = np.frombuffer(view, "<i8")
    counts = np.ones(n, np.int64)
    counts[more] = long + 2
    lead = np.uint64(shard << (h - shard_bits))
    return lead | (quotient << np.uint64(rest)) | high, low, counts


def merged(parts: list[Run], size: int, bits: int) -> Run:
    """One ascending run of several ones; the stable sort below finds these runs and merges them."""
    high, low, counts = (np.concatenate(x) for x in zip(*parts))
    return summed(high, low, counts, size, bits)
