"""Byte-level byte-pair encoding and decoding with the ranks of a public tokenizer.

A text is cut by the tokenizer's pattern, and each piece is merged by itself. In each task DuckDB holds the
ranks as tables. One recursive query merges all pieces that the task has not met before: their rows (piece,
position, token) meet the merge table with the token that follows, each piece's leftmost pair of least rank
becomes one token, and pieces without such a pair drop out, until none is left. Decoding joins ids to the
vocabulary and aggregates the bytes in order. No id leaves its task, and nothing is shuffled.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import itertools
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import documents, text_of

#: Characters handled together: bounds the memory of a task whatever the length of texts.
POOL = 1_000_000
WORDS = 250_000
#: Tokens decoded by one ordered aggregation; longer texts are decoded in consecutive parts.
PART = 500_000
#: Pieces that a Python worker remembers, in two generations: when the younger one is half of this, the elder is forgotten
#: and it takes its place. A piece that is met again moves to the younger one.
REMEMBERED = 500_000
#: Pieces merged by one recursive query.
TOGETHER = 15_000
#: Bytes of a piece beyond which a heap takes the recursive query's place: a query step costs the piece's whole length.
LONG_PIECE = 400

#: A row: piece, position, token, position and token of the row that follows, and `pair` if the two merge: rank, own and
#: following position packed in one number, so that the least number is the leftmost pair of least rank.
_STEPS = """
WITH RECURSIVE state AS (
  SELECT word, pos, tok, after, after_tok, (made::BIGINT << 20) | (pos << 10) | after AS pair, 0 AS step
  FROM start LEFT JOIN merges ON l = tok AND r = after_tok
  UNION ALL
  (WITH best AS MATERIALIZED (
     SELECT word, min(pair) AS best FROM state GROUP BY word HAVING min(pair) IS NOT NULL),
   seen AS MATERIALIZED (
     SELECT state.*, best >> 20 AS merged, (best >> 10) & 1023 AS first, best & 1023 AS second
     FROM state JOIN best USING (word)),
   around AS (
     SELECT word, any_value(merged) AS merged, any_value(first) AS first, any_value(step) + 1 AS step,
            max(after) FILTER (pos = second) AS next, max(after_tok) FILTER (pos = second) AS next_tok,
            max(pos) FILTER (after = first) AS before, max(tok) FILTER (after = first) AS before_tok
     FROM seen WHERE pos = second OR after = first GROUP BY word),
   changed AS (
     SELECT word, first AS pos, merged AS tok, next AS after, next_tok AS after_tok, step FROM around
     UNION ALL
     SELECT word, before, before_tok, first, merged, step FROM around WHERE before IS NOT NULL)
   SELECT word, pos, tok, after, after_tok, pair, step + 1
   FROM seen WHERE pos <> first AND pos <> second AND after IS DISTINCT FROM first
   UNION ALL
   SELECT word, pos, tok, after, after_tok, (made::BIGINT << 20) | (pos << 10) | after, step
   FROM changed LEFT JOIN merges ON l = tok AND r = after_tok))
SELECT word, list(tok ORDER BY pos) AS ids
FROM state JOIN (SELECT word, max(step) AS step FROM state GROUP BY word) USING (word, step)
GROUP BY word ORDER BY word
"""
_DECODE = """
SELECT part, array_to_string(list(chars ORDER BY pos)::VARCHAR[], '') AS chars
FROM coded JOIN vocabulary USING (id) GROUP BY part ORDER BY part
"""


def read_ranks(path: str) -> bytes:
    """The rank file: a line for each token, its bytes in base 64 and its rank. Under a megabyte; sent with the task."""
    with open(path, "rb") as file:
        return file.read()


class Coder:
    """Encodes and decodes in one task."""

    def __init__(self, ranks: bytes, pattern: str):
        import duckdb
        import regex

        self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.find = regex.compile(pattern).finditer
        self.find_all = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}
        self.elder: dict[str, bytes] = {}
        self.bytes_of = np.array([self.rank[bytes([b])] for b in range(256)], dtype=np.int32)
        merges = [
            (self.rank[t[:i]], self.rank[t[i:]], made)
            for t, made in self.rank.items()
            for i in range(1, len(t))
            if t[:i] in self.rank and t[i:] in self.rank
        ]
        self.spelled = {made: t for t, made in self.rank.items()}
        self.db = duckdb.connect(
            config={"threads": 1, "memory_limit": "160MB", "temp_directory": tempfile.gettempdir()}
        )
        left, right, made = (pa.array(x, pa.int64()) for x in zip(*merges))
        self._table("merges", l=left, r=right, made=made)
        self._table(
            "spelled", id=pa.array(self.rank.values(), pa.int32()), chars=pa.array([t.decode("latin-1") for t in self.rank])
        )
        # tokens of an enumeration are sorted as small numbers
        self.db.execute("CREATE TYPE token AS ENUM (SELECT chars FROM spelled)")
        self.db.execute("CREATE TEMP TABLE vocabulary AS SELECT id, chars::token AS chars FROM spelled")

    def _table(self, name: str, **columns: pa.Array) -> None:
        self.db.register("arrived", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM arrived")
        self.db.unregister("arrived")

    def learn(self, words: Iterable[str]) -> None:
        """Remembers the ids of each piece, as little-endian 32-bit numbers."""
        words = set(words)
        if len(self.known) > REMEMBERED // 2:
            self.known, self.elder = {}, self.known
        new = words.difference(self.known)
        again = new.intersection(self.elder)
        for word in again:
            self.known[word] = self.elder[word]
        unmerged: list[tuple[str, bytes]] = []
        for word in new - again:
            data = word.encode()
            if data in self.rank:  # a piece that is a token is that token, before any merge
                self.known[word] = self.rank[data].to_bytes(4, "little")
            elif len(data) > LONG_PIECE:
                self.known[word] = self._merge_long(data).tobytes()
            else:
                unmerged.append((word, data))
        for start in range(0, len(unmerged), TOGETHER):
            self._merge(unmerged[start : start + TOGETHER])

    def _merge(self, unmerged: list[tuple[str, bytes]]) -> None:
        lengths = np.array([len(data) for _, data in unmerged])
        raw = np.frombuffer(b"".join(data for _, data in unmerged), np.uint8)
        word = np.repeat(np.arange(len(unmerged)), lengths)
        pos = np.arange(len(raw)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        tok = self.bytes_of[raw]
        last = pos + 1 == np.repeat(lengths, lengths)
        self._table(
            "start",
            word=pa.array(word, pa.int32()),
            pos=pa.array(pos, pa.int64()),
            tok=pa.array(tok, pa.int64()),
            after=pa.array(pos + 1, pa.int64(), mask=last),
            after_tok=pa.array(np.roll(tok, -1), pa.int64(), mask=last),
        )
        ids = self.db.sql(_STEPS).to_arrow_table()["ids"].combine_chunks()
        raw = ids.values.to_numpy().astype("<i4").tobytes()
        ends = (ids.offsets.to_numpy().astype(np.int64) * 4).tolist()
        for (word, _), a, b in zip(unmerged, ends, ends[1:]):
            self.known[word] = raw[a:b]

    def _merge_long(self, data: bytes) -> np.ndarray:
        """The same merges by a heap of (rank, position): leftmost pair of least rank first."""
        tok = self.bytes_of[np.frombuffer(data, np.uint8)].tolist()

        def pair(a: int, b: int) -> int | None:
            return self.rank.get(self.spelled[a] + self.spelled[b])

        after, before = list(range(1, len(tok) + 1)), list(range(-1, len(tok) - 1))
        heap = [(made, i) for i in range(len(tok) - 1) if (made := pair(tok[i], tok[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            made, i = heapq.heappop(heap)
            j = after[i]
            if tok[i] < 0 or j >= len(tok) or pair(tok[i], tok[j]) != made:
                continue
            tok[i], tok[j], after[i] = made, -1, after[j]
            if after[i] < len(tok):
                before[after[i]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else len(tok)
                if b < len(tok) and (made := pair(tok[a], tok[b])) is not None:
                    heapq.heappush(heap, (made, a))
        return np.array([t for t in tok if t >= 0], dtype=np.int32)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; a null text has none."""
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(texts)
        pool: list[tuple[int, list[str]]] = []
        size = 0

        def flush() -> None:
            self.learn(itertools.chain.from_iterable(words for _, words in pool))
            for i, words in pool:
                out[i] = np.frombuffer(b"".join(map(self.known.__getitem__, words)), "<i4")
            pool.clear()

        for i, text in enumerate(texts):
            if text is None or text == "":
                continue
            if len(text) > POOL:
                words, parts = (m.group() for m in self.find(text)), []
                while some := list(itertools.islice(words, WORDS)):
                    self.learn(some)
                    parts.append(b"".join(map(self.known.__getitem__, some)))
                out[i] = np.frombuffer(b"".join(parts), "<i4")
                continue
            pool.append((i, self.find_all(text)))
            size += len(text)
            if size > POOL:
                flush()
                size = 0
        flush()
        return out

    def decode(self, coded: list[np.ndarray]) -> list[bytes]:
        """Bytes of each list of ids, `PART` ids to an aggregation."""
        out: list[list[bytes]] = [[] for _ in coded]
        parts: list[tuple[int, np.ndarray]] = []
        size = 0

        def flush() -> None:
            if not parts:
                return
            lengths = np.array([len(ids) for _, ids in parts])
            starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
            ids = np.concatenate([ids for _, ids in parts])
            self.db.register(
                "coded",
                pa.table({
                    "part": np.repeat(np.arange(len(parts), dtype=np.int32), lengths),
                    "pos": np.arange(len(ids)) - starts,
                    "id": ids,
                }),
            )
            found = self.db.sql(_DECODE).to_arrow_table()
            self.db.unregister("coded")
            for part, text in zip(found["part"].to_pylist(), found["chars"].to_pylist()):
                out[parts[part][0]].append(text.encode("latin-1"))  # a character stands for each byte
            parts.clear()

        for i, ids in enumerate(coded):
            for a in range(0, len(ids), PART):
                parts.append((i, ids[a : a + PART]))
                size += len(parts[-1][1])
                if size > PART:
                    flush()
                    size = 0
        flush()
        return [b"".join(x) for x in out]


@functools.lru_cache(maxsize=2)
def _coder(ranks: bytes, pattern: str) -> Coder:
    """One per Python worker, whatever the number of its tasks."""
    return Coder(ranks, pattern)


def _slices(batches: Iterable[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of some `POOL` characters."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes) // POOL
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)] if len(sizes) else [0]
        for a, b in itertools.pairwise(edges):
            yield batch.slice(a, b - a)


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.empty(0, np.int32), *ids]), pa.int32()))


def encode(docs: DataFrame, ranks: bytes, pattern: str, text: str = "text") -> DataFrame:
    """(row, ids): each input row as a struct, and the token ids of its text, in order.

    A null or empty text has no ids. Repeated rows are encoded alike. Columns of any name may be present.
    """

    def run(batches):
        coder = _coder(ranks, pattern)
        for batch in _slices(batches, "text"):
            ids = coder.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("row"), _lists(ids)], names=["row", "ids"])

    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, ranks: bytes, pattern: str, ids: str = "ids") -> DataFrame:
    """The rows of `encoded` as a struct `row`, and `decoded`: the bytes of its ids; null ids decode to nothing."""

    def run(batches):
        coder = _coder(ranks, pattern)
        for batch in batches:
            lists = [np.empty(0, np.int32) if x is None else np.asarray(x, np.int32) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(coder.decode(lists), pa.binary())], names=["row", "decoded"]
            )

    rows = encoded.select(F.struct("*").alias("row"), F.col(ids).alias("ids"))
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, decoded binary")


def round_trip(docs: DataFrame, ranks: bytes, pattern: str, text: str = "text") -> DataFrame:
    """(row, ids, text): each input row as a struct without its text, its token ids, and the text decoded from them.

    Nulls, repeated rows and clashing names as in `encode`; a null text comes back empty.
    """

    def run(batches):
        coder = _coder(ranks, pattern)
        for batch in _slices(batches, "text"):
            ids = coder.encode(batch.column("text").to_pylist())
            back = pa.array(coder.decode(ids), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("row"), _lists(ids), back], names=["row", "ids", "text"])

    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    rows = docs.select(F.struct(*others).alias("row"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, ids array<int>, text string")


def digests(docs: DataFrame, ranks: bytes, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encodes and decodes in one pass and keeps digests."""

    def run(batches):
        coder = _coder(ranks, pattern)
        for batch in _slices(batches, "text"):
            ids = coder.encode(batch.column("text").to_pylist())
            back = coder.decode(ids)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in back], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Whole `documents`, encoded and decoded by the 50k byte-level vocabulary."""
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return digests(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)
