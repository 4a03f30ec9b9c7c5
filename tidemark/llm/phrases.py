"""Phrase collocations: word n-grams that occur often, and oftener than their parts suggest.

Texts become blocks of one language: a list of its distinct words, and the words of the texts as places in that list.
Words that occur often enough get ids, which go back to the blocks, so no task holds the whole vocabulary. Each block's
n-grams become counting quotient filters (`quotient`), one for each shard, and the sorted filters of a shard are
merged. Only phrases of the least count leave that step; scores, contained phrases and ranks are joins over them.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import quotient
from tidemark.llm.tables import documents, text_of, written

LEAST = 30
LONGEST = 4
TOP = 2000
#: An n-gram is dropped if a longer one that holds it has so many per cent of its count.
CONTAINED = 80
#: Words of a block.
BLOCK = 1_000_000
#: Bytes of a text that are split at once.
SLICE = 4_000_000
#: Occurrences that a shard's filters have, on average, at most.
SHARD = 3_000_000
#: Entries that a merging task adds to a shard's merged filter at once.
MERGE = 1_500_000
UNKNOWN = "und"

#: Ends of pieces become full stops, tabs become spaces.
_PLAIN = bytes.maketrans(b",;:!?\x0a\x0b\x0c\x0d\x09", b"......... ")
_BLOCKS = "block long, lang string, words array<string>, counts array<long>, ids binary"


class _Places(dict):
    """Words and their places in order of arrival; place 0 stands for the end of a piece."""

    def __init__(self):
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


def _tokens(text: bytes) -> Iterator[list[bytes]]:
    """Lower-cased words, and a full stop where a piece ends, in lists of some `SLICE` bytes of text each."""
    plain, at = text.lower().translate(_PLAIN), 0
    while at < len(plain):
        ends = [x for x in (plain.find(b" ", at + SLICE), plain.find(b".", at + SLICE)) if x >= 0]
        end = min(ends, default=len(plain))
        yield plain[at:end].replace(b".", b" . ").split()
        at = end
    yield [b"."]


def _block(block: int, lang: str, parts: list[np.ndarray], places: _Places) -> pa.RecordBatch:
    """The words by falling count, so that most places are small; places as four planes of bytes, which compress well."""
    ids = np.concatenate(parts)
    counts = np.bincount(ids, minlength=len(places))[1:]
    order = np.argsort(-counts, kind="stable")
    new = np.zeros(len(places), "<i4")
    new[order + 1] = np.arange(1, len(places))
    words = pa.array(list(places)[1:], pa.binary()).cast(pa.string()).take(pa.array(order))
    ends = pa.array([0, len(words)], pa.int32())
    columns = [
        pa.array([block]), pa.array([lang], pa.string()), pa.ListArray.from_arrays(ends, words),
        pa.ListArray.from_arrays(ends, pa.array(counts[order], pa.int64())),
        pa.array([np.ascontiguousarray(new[ids].view(np.uint8).reshape(-1, 4).T).tobytes()], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["block", "lang", "words", "counts", "ids"])


def _places_of(ids: pa.Scalar) -> np.ndarray:
    planes = np.frombuffer(ids.as_buffer(), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").reshape(-1)


def blocks(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(block, lang, words, counts, ids): texts of one language, some `BLOCK` words together, as places in `words`.

    `counts` has each word's occurrences. `ids` holds 32-bit places from 1, 0 where a piece ends. Blocks are numbered by
    partition, so the table has to be written before its numbers are used.
    """

    def run(batches):
        numbers = itertools.count(TaskContext.get().partitionId() << 32)
        open_: dict[str, tuple[list, _Places]] = {}
        held = 0
        for batch in batches:
            for name, body in zip(batch.column("lang").to_pylist(), batch.column("text")):
                parts, places = open_.setdefault(name, ([], _Places()))
                for tokens in _tokens(body.as_buffer().to_pybytes()):
                    parts.append(np.fromiter(map(places.__getitem__, tokens), np.int32, len(tokens)))
                    held += len(tokens)
                if held >= BLOCK:
                    yield from (_block(next(numbers), k, *x) for k, x in open_.items() if x[0])
                    open_, held = {}, 0
        yield from (_block(next(numbers), k, *x) for k, x in open_.items() if x[0])

    rows = docs.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), text_of(text).alias("text"))
    return rows.mapInArrow(run, _BLOCKS)


def vocabulary(found: DataFrame, least: int) -> DataFrame:
    """(lang, word, n, id): words of `least` occurrences at least, with ids from 1 that have few gaps."""
    counts = found.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x")).groupBy("lang", F.col("x.words").alias("word"))
    often = written(counts.agg(F.sum("x.counts").alias("n")).where(F.col("n") >= least), "phrase-words")
    parts = 4 * int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("lang", "word"), F.lit(parts))
    place = F.row_number().over(Window.partitionBy("part").orderBy("lang", "word"))
    return written(often.withColumn("part", part).select("lang", "word", "n", (F.col("part") + (place - 1) * parts + 1).cast("long").alias("id")), "phrase-ids")


def ngrams(found: DataFrame, words: DataFrame, least: int, longest: int = LONGEST) -> DataFrame:
    """(lang, words, size, a): n-grams of 2 to `longest` word ids with their count `a`, if it is `least` or more.

    The words of a phrase and of its parts occur as often as it at least, so only words of the vocabulary take part.
    """
    # sums over no rows are null
    top, total = words.agg(F.max("id"), F.sum("n")).first()
    bits = max(1, int(top or 1).bit_length())
    shard_bits = min(bits, max(0, (int(total or 0) // SHARD).bit_length()))
    places = found.select("block", "lang", F.posexplode("words").alias("place", "word"))
    known = places.join(words.select("lang", "word", "id"), ["lang", "word"]).groupBy("block")
    known = known.agg(F.collect_list(F.struct((F.col("place") + 1).alias("place"), "id")).alias("known"))

    def count(batches):
        for batch in batches:
            for lang, ids, pairs in zip(batch.column("lang").to_pylist(), batch.column("ids"), batch.column("known")):
                places = _places_of(ids)
                to = np.zeros(int(places.max(initial=0)) + 1, np.int64)
                pairs = pairs.values
                to[pairs.field("place").to_numpy(zero_copy_only=False)] = pairs.field("id").to_numpy(zero_copy_only=False)
                for at in range(0, len(places), BLOCK):  # a long text's block in parts, by the n-grams' first words
                    yield from _filters(lang, to[places[at : at + BLOCK + longest - 1]], bits, shard_bits, longest)

    filters = found.select("block", "lang", "ids").join(known, "block").select("lang", "ids", "known")
    filters = filters.mapInArrow(count, "lang string, size int, shard long, filter binary")

    def merge(batches):
        key, parts, held, met = None, [], 0, 0
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("lang", "size", "shard")))
            for now, data in zip(keys, batch.column("filter")):
                if key != now:
                    if parts:
                        yield _often(key, quotient.merged(parts, key[1], bits), bits, least)
                    key, parts, held, met = now, [], 0, 0
                parts.append(quotient.entries(data.as_buffer().to_pybytes(), now[2], now[1], bits, shard_bits))
                met += len(parts[-1][0])
                if met - held > max(MERGE, held):
                    parts = [quotient.merged(parts, now[1], bits)]
                    held = met = len(parts[0][0])
        if parts:
            yield _often(key, quotient.merged(parts, key[1], bits), bits, least)

    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = filters.repartition(n, "lang", "size", "shard").sortWithinPartitions("lang", "size", "shard")
    return dealt.mapInArrow(merge, "lang string, words array<long>, size int, a long")


def _filters(lang: str, ids: np.ndarray, bits: int, shard_bits: int, longest: int):
    """The filters of up to `BLOCK` n-grams' first words, for each size one for each shard that has any."""
    whole = ids > 0
    for size in range(2, longest + 1):
        whole = whole[:-1] & (ids[size - 1 :] > 0) if len(ids) >= size else whole[:0]
        at = np.flatnonzero(whole[:BLOCK])
        if not len(at):
            return
        run = quotient.summed(*quotient.permuted([ids[at + i] for i in range(size)], bits), None, size, bits)
        shards = quotient.shard_of(run[0], size, bits, shard_bits)
        edges = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
        made = [quotient.filter_of(tuple(x[a:b] for x in run), size, bits, shard_bits) for a, b in zip(edges, edges[1:])]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(made), pa.string()), pa.array([size] * len(made), pa.int32()), pa.array(shards[edges[:-1]]), pa.array(made, pa.binary())],
            names=["lang", "size", "shard", "filter"],
        )


def _often(key: tuple[str, int, int], run: quotient.Run, bits: int, least: int) -> pa.RecordBatch:
    lang, size, _ = key
    high, low, counts = run
    keep = counts >= least
    n = int(keep.sum())
    ids = np.stack(quotient.restored(high[keep], low[keep], size, bits), 1).astype(np.int64)
    words = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * size), pa.array(ids.reshape(-1)))
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * n, pa.string()), words, pa.array([size] * n, pa.int32()), pa.array(counts[keep])], names=["lang", "words", "size", "a"]
    )


def _key(words: Column, start: Column | int, size: Column | int) -> Column:
    return F.slice(words, F.lit(start) if isinstance(start, int) else start, F.lit(size) if isinstance(size, int) else size)


def phrases(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST,
    contained: int = CONTAINED, top: int = TOP,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): per language the `top` phrases of 2 to `longest` words.

    Words are compared with A-Z lower-cased, and a phrase lies within one piece, pieces ending at `.,;:!?` and line
    ends. `a` counts the phrase, `l` and `r` its parts at the cut with the lowest score, n all words of the language;
    the score is floor(2000000 a / (l + r)). Phrases that a longer one of `contained` per cent of their count holds
    are left out. Null texts and texts without words add nothing; a null language is the language `und`. Repeated rows
    count each time. Equal ranks go by `a`, then by phrase. Empty tables give no rows; other columns are not read.
    """
    if not 2 <= longest <= quotient.LONGEST:
        raise ValueError(f"phrases have 2 to {quotient.LONGEST} words")
    found = written(blocks(docs, lang, text), "phrase-blocks")
    words = vocabulary(found, least)
    sizes = found.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x).alias("n"))
    sizes = sizes.groupBy("lang").agg(F.sum("n").alias("n"))
    candidates = written(ngrams(found, words, least, longest), "phrase-candidates")
    known = candidates.select("words", "a").unionByName(words.select(F.array("id").alias("words"), F.col("n").alias("a")))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    first = known.select(F.col("words").alias("first"), F.col("a").alias("l"))
    rest = known.select(F.col("words").alias("rest"), F.col("a").alias("r"))
    parts = (
        cuts.withColumn("first", _key(F.col("words"), 1, F.col("k")))
        .withColumn("rest", _key(F.col("words"), F.col("k") + 1, F.col("size") - F.col("k")))
        .join(first, "first")
        .join(rest, "rest")
    )
    score = F.expr("(CAST(2000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(19, 0))) DIV (CAST(l AS DECIMAL(19, 0)) + r)")
    scored = parts.groupBy("lang", "words", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("size") - 1),
            lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: F.slice("words", i, n)),
        )
    )
    holders = candidates.where("size > 2").select(F.explode(inner).alias("words"), "a").groupBy("words").agg(F.max("a").alias("held"))
    wide = "DECIMAL(19, 0)"
    kept = scored.join(holders, "words", "left").where(
        F.col("held").isNull() | F.expr(f"100 * CAST(held AS {wide}) < {contained} * CAST(a AS {wide})")
    )
    rank = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = kept.select("lang", "words", "a", "cut.*").withColumn("place", F.rank().over(rank)).where(F.col("place") <= top)
    best = written(best.drop("place"), "phrase-best")
    spelled = best.select("words", F.posexplode("words").alias("i", "id")).join(words.select("id", "word"), "id").groupBy("words")
    spelled = spelled.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x.word), " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.join(spelled, "words").withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def op11_phrases(spark, sf_dir: str) -> DataFrame:
    """Whole `documents`."""
    return phrases(documents(spark, sf_dir))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OP11_SQL = f"""
WITH pieces AS (
  SELECT lang, doc_id, unnest(s) AS piece, unnest(range(len(s))) AS pc FROM (
    SELECT coalesce(lang, '{UNKNOWN}') AS lang, doc_id,
           regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]') AS s
    FROM documents)),
words AS (SELECT lang, doc_id, pc, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
placed AS (SELECT lang, doc_id, pc, unnest(w) AS word, unnest(range(len(w))) AS i FROM words WHERE len(w) > 0),
runs AS (
  SELECT lang, word AS w1, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3, lead(word, 3) OVER o AS w4
  FROM placed WINDOW o AS (PARTITION BY doc_id, pc ORDER BY i)),
sizes AS (SELECT lang, count(*) AS n FROM placed GROUP BY lang),
f AS (
  SELECT lang, w1 AS p, 1 AS size, count(*) AS a FROM runs GROUP BY lang, w1 HAVING count(*) >= {LEAST}
  UNION ALL SELECT lang, w1 || ' ' || w2, 2, count(*) FROM runs WHERE w2 IS NOT NULL GROUP BY lang, w1, w2 HAVING count(*) >= {LEAST}
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3, count(*) FROM runs WHERE w3 IS NOT NULL
    GROUP BY lang, w1, w2, w3 HAVING count(*) >= {LEAST}
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, 4, count(*) FROM runs WHERE w4 IS NOT NULL
    GROUP BY lang, w1, w2, w3, w4 HAVING count(*) >= {LEAST}),
cuts AS (
  SELECT lang, p, size, a, string_split(p, ' ') AS w, unnest(range(1, size)) AS k FROM f WHERE size > 1),
scored AS (
  SELECT c.lang, c.p, c.a, c.k, x.a AS l, y.a AS r, (CAST(2000000 AS HUGEINT) * c.a) // (x.a + y.a) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.p = array_to_string(c.w[1:c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.p = array_to_string(c.w[c.k + 1:c.size], ' ')),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS o FROM scored),
inside AS (
  SELECT lang, unnest(CASE WHEN size = 3 THEN [w[1:2], w[2:3]] ELSE [w[1:2], w[2:3], w[3:4], w[1:3], w[2:4]] END) AS w, a
  FROM (SELECT *, string_split(p, ' ') AS w FROM f WHERE size > 2)),
held AS (SELECT lang, array_to_string(w, ' ') AS p, max(a) AS most FROM inside GROUP BY lang, w),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank, p AS phrase, a, l, r, score
  FROM lowest LEFT JOIN held USING (lang, p) WHERE o = 1 AND (most IS NULL OR 100 * most < {CONTAINED} * a))
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= {TOP}
"""
