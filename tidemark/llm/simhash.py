"""SimHash near-duplicates: fingerprints of word shingles, pigeonhole blocks, Hamming verification, components.

A fingerprint of 64 bits is split into `distance + 2` blocks. Two fingerprints that differ in `distance` bits or fewer
agree in two blocks at least, so they meet under the key of two blocks. Equal fingerprints are one node from the
start, whatever the number of their documents.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import documents, written
from tidemark.llm.wordhash import pools

SHINGLE = 3
DISTANCE = 2
SEED = 42
BITS = 64
#: Members of a block key that are compared pair by pair; larger keys are linked through common neighbours.
SMALL = 64


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned; bit i is set if it is set in over half of the hashes of the text's shingles. No word: 0."""
    import xxhash

    words = text.lower().split()  # of bytes: lower-cases A-Z and splits at ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, seed)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-shingle]]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a : b - 1], seed) for a, b in zip(starts, ends[shingle - 1 :])], np.uint64)
    counts = np.zeros(BITS, np.int64)
    for part in range(0, len(hashes), 100_000):
        bits = np.unpackbits(hashes[part : part + 100_000].view(np.uint8), bitorder="little").reshape(-1, BITS)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): `fp` holds the 64 bits as a signed number. A null text has no words."""

    def run(batches):
        for batch, texts in pools(batches):
            marks = np.array([fingerprint(x, shingle) for x in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(marks)], names=["doc_id", "fp"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _keys(distance: int) -> list[int]:
    """Bit masks of all pairs of blocks."""
    n = distance + 2
    edges = [BITS * i // n for i in range(n + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in itertools.pairwise(edges)]
    return [_signed(a | b) for a, b in itertools.combinations(blocks, 2)]


def _far(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(marks: DataFrame, distance: int = DISTANCE, small: int = SMALL) -> DataFrame:
    """(a, b): links among the distinct fingerprints `fp`, a > b, that connect all within `distance` bits.

    Fingerprints under one block key are joined and their bits compared; each has fewer than `small` partners
    there. Keys with more members would need all their pairs: their fingerprints are linked exactly through
    common neighbours instead (`_through_neighbours`), which leaves out links but no connection.
    """
    nodes = written(marks.select("fp").distinct(), "fingerprints")
    keys = F.array(*(F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(_keys(distance))))
    keyed = nodes.select("fp", F.explode(keys).alias("k")).select("fp", "k.part", "k.key")
    shared = written(keyed.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1), "blocks")
    met = keyed.join(shared.where(F.col("n") <= small).select("part", "key"), ["part", "key"])
    pairs = met.alias("x").join(
        met.alias("y"),
        (F.col("x.part") == F.col("y.part")) & (F.col("x.key") == F.col("y.key")) & (F.col("x.fp") > F.col("y.fp"))
        & (_far(F.col("x.fp"), F.col("y.fp")) <= distance),
    ).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    crowded = keyed.join(shared.where(F.col("n") > small).select("part", "key"), ["part", "key"], "left_semi")
    return written(pairs.unionByName(_through_neighbours(crowded.select("fp").distinct(), distance)).distinct(), "links")


def _through_neighbours(nodes: DataFrame, distance: int) -> DataFrame:
    """Links of fingerprints by common neighbours, linear in their number.

    Two fingerprints differ in 2r bits or fewer exactly if some word differs from either in r bits or fewer. Each
    fingerprint goes to all words of that ball, and those that meet at a word are linked to the least of them: at
    most as many as the ball has words. With an odd `distance` = 2r + 1 a word is also met from r + 1 bits away;
    such links are checked, and the words of the larger ball are the candidates.
    """
    radius = (distance + 1) // 2
    balls = [0]
    for r in range(1, radius + 1):
        balls += [_signed(sum(1 << i for i in bits)) for bits in itertools.combinations(range(BITS), r)]
    at = nodes.select("fp", F.explode(F.array(*(F.lit(x) for x in balls))).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("word")
    )
    if distance % 2 == 0:
        least = F.min("fp").over(Window.partitionBy("word"))
        return at.select(F.col("fp").alias("a"), least.alias("b")).where(F.col("a") > F.col("b"))
    x, y = at.alias("x"), at.alias("y")
    return x.join(y, (F.col("x.word") == F.col("y.word")) & (F.col("x.fp") > F.col("y.fp")) & (_far(F.col("x.fp"), F.col("y.fp")) <= distance)).select(
        F.col("x.fp").alias("a"), F.col("y.fp").alias("b")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for each node of the links (a, b), a > b, the least node that it is connected to.

    Alternates two steps until nothing changes: every node sends its larger neighbours to its least neighbour, then
    its smaller ones. Links only become fewer or point lower; each round is written, so its lineage is one table.
    """
    state = edges.select("a", "b")
    before = None
    for turn in itertools.count():
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        low = low.select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where(F.col("a") > F.col("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        down = large.join(least, "a")
        small = down.where(F.col("b") > F.col("low")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        state = written(small.unionByName(least.select("a", F.col("low").alias("b"))).distinct(), f"round{turn}")
        after = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % F.lit(1 << 40))).first()
        if after == before:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """(doc_id, fp, component_id): one row per input row.

    `component_id` is the least id among all documents reachable over links; a null id is never the least unless a
    component has no other. Texts without words, null ones among them, share the fingerprint zero and are linked
    like any other. Repeated rows are rows of their own in one component.
    """
    marks = written(fingerprints(docs, doc_id, text, shingle), "marks")
    found = components(links(marks, distance))
    least = marks.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = least.join(found, least["fp"] == found["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = written(rooted, "roots")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_mark = written(rooted.join(named, "root").select("fp", "component_id"), "components")
    return marks.join(of_mark, "fp").select("doc_id", "fp", "component_id")


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of `docs` that come first in their component: one document of each group.

    First is the least id, null being the greatest; rows of one id go by 128 bits of the whole row, and of equal rows one
    stays. The columns are those of `docs`.
    """
    whole = [F.col(f"`{c}`") for c in docs.columns]
    key = F.struct(
        F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"),
        F.xxhash64(*whole).alias("a"), F.xxhash64(F.lit(1), *whole).alias("b"),
    )
    rows = docs.select(F.struct("*").alias("row"), key.alias("key"), F.col(text).alias("text"))
    found = near_duplicates(rows, "key", "text", shingle, distance)
    stay = written(found.select(F.col("component_id").alias("key")).distinct(), "stay")
    chosen = rows.select("row", "key").join(stay, "key", "left_semi")
    once = F.row_number().over(Window.partitionBy("key").orderBy(F.lit(0)))
    return chosen.withColumn("once", once).where("once = 1").select("row.*")


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    """Whole `documents`."""
    return near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
