"""Document fingerprints: a homomorphic hash of the multiset of a text's paragraphs.

Each paragraph is hashed to a wide vector; a document's fingerprint is the sum of its paragraphs' vectors,
lane by lane modulo a power of two. The sum does not depend on the order, a paragraph is inserted or deleted
by adding or subtracting its vector, and the fingerprint of joined texts is the sum of the fingerprints.

A vector has two parts. EQUAL_LANES lanes modulo 2 ** 32 come from hashes of the whole paragraph and tell
multisets apart. LIKE_LANES lanes modulo 2 ** 32 hold, for each sentence of the paragraph, +1 or -1 by one bit
of the sentence's hash; a sentence of over SENTENCE_WORDS words is cut after each so many words. The inner product of two such parts, over the number of lanes, estimates the inner product
of the two sentence multisets, which gives the likeness; its standard error is about (2 / LIKE_LANES) ** 0.5.
Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import documents, text_of, written

EQUAL_LANES = 8
LIKE_LANES = 128
SENTENCE_WORDS = 16
_TWO_32 = 1 << 32
#: One bit in each half of a 64-bit word: two lanes are counted by one addition, without a carry between them.
_PAIR = (1 << 32) | 1


def paragraphs(text: Column) -> Column:
    """Lines with something but blanks in them, without blanks at their ends."""
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\r"))), lambda x: x != "")


def _sentences(parts: Column) -> Column:
    some = F.lit(rf"\S+(?:\s+\S+){{0,{SENTENCE_WORDS - 1}}}")
    sentences = F.flatten(F.transform(parts, lambda p: F.split(p, r"(?<=[.!?])\s+")))
    return F.flatten(F.transform(sentences, lambda s: F.regexp_extract_all(s, some, F.lit(0))))


def _wrapped(x: Column) -> Column:
    """Modulo 2 ** 32, from -2 ** 31 on."""
    return (F.pmod(x + F.lit(_TWO_32 // 2), F.lit(_TWO_32)) - F.lit(_TWO_32 // 2)).cast("int")


def _let(value: Column, body) -> Column:
    """`body(value)` with the value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def lanes(text: Column) -> Column:
    """struct(equal: array<bigint>, like: array<int>) of a text that is not null; the empty text has zeros."""
    return _let(paragraphs(text), lambda parts: F.struct(_equal(parts).alias("equal"), _like(parts).alias("like")))


def _equal(parts: Column) -> Column:
    """For each lane, the sum of 32 bits of a hash of each paragraph, modulo 2 ** 32."""
    low = F.lit(_TWO_32 - 1)

    def total(seed: int, shift: int) -> Column:
        return F.aggregate(
            parts, F.lit(0).cast("long"),
            lambda acc, p: acc + F.shiftrightunsigned(F.xxhash64(F.lit(seed), p), shift).bitwiseAND(low),
        ).bitwiseAND(low)

    return F.array(*(total(seed, shift) for seed in range(EQUAL_LANES // 2) for shift in (0, 32)))


def _like(parts: Column) -> Column:
    """For each lane, (sentences with the lane's bit) - (those without), modulo 2 ** 32."""
    seeds = range(100, 100 + LIKE_LANES // 64)
    return _let(_sentences(parts), lambda found: F.flatten(F.array(*(_signs(found, seed) for seed in seeds))))


def _signs(found: Column, seed: int) -> Column:
    """64 lanes from one 64-bit hash of each sentence: the bits of all hashes are counted two at a time."""

    def counts(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.lit(31)),
            lambda k: F.aggregate(
                hashes, F.lit(0).cast("long"),
                lambda acc, h: acc + F.call_function("shiftrightunsigned", h, k).bitwiseAND(F.lit(_PAIR)),
            ),
        )

    n = F.size(found).cast("long")
    words = _let(F.transform(found, lambda s: F.xxhash64(F.lit(seed), s)), counts)
    both = F.transform(words, lambda w: F.array(w.bitwiseAND(F.lit(_TWO_32 - 1)), F.shiftrightunsigned(w, 32)))
    return F.transform(F.flatten(both), lambda c: _wrapped(c * 2 - n))


def combined(a: Column, b: Column, sign: int = 1) -> Column:
    """Fingerprint of both texts' paragraphs together, or with sign -1 of a's without b's."""

    def added(x: Column, y: Column) -> Column:
        return x.cast("long") + y.cast("long") * F.lit(sign)

    return F.struct(
        F.zip_with(a["equal"], b["equal"], lambda x, y: F.pmod(added(x, y), F.lit(_TWO_32))).alias("equal"),
        F.zip_with(a["like"], b["like"], lambda x, y: _wrapped(added(x, y))).alias("like"),
    )


def shown(fingerprint: Column) -> Column:
    """Lower-case hexadecimal digits, 8 for each lane."""
    equal = F.transform(fingerprint["equal"], lambda x: F.lpad(F.hex(x), 8, "0"))
    like = F.transform(fingerprint["like"], lambda x: F.lpad(F.hex(F.pmod(x.cast("long"), F.lit(_TWO_32))), 8, "0"))
    return F.lower(F.array_join(F.concat(equal, like), ""))


def likeness(a: Column, b: Column) -> Column:
    """2ab / (aa + bb) of the sentence parts, from 0 to 1; exactly 1 for equal fingerprints, also of empty texts."""

    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p)

    x, y = a["like"], b["like"]
    value = F.lit(2.0) * dot(x, y) / F.nullif(dot(x, x) + dot(y, y), F.lit(0.0))
    return F.when(a == b, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(value, F.lit(0.0)))))


def next_lower(docs: DataFrame, key: str) -> DataFrame:
    """(key, next_key): each distinct key with the next smaller one; the smallest is followed by the largest.

    Keys alone are dealt out by range and written; each range is then a window of its own, and one row per
    range joins the ranges up. No task gets more than a range.
    """
    ranged = docs.select(key).distinct().repartitionByRange(F.col(key))
    parts = written(ranged.select(key, F.spark_partition_id().alias("part")), "ranges")
    edges = parts.groupBy("part").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    wrap = edges.agg(F.max("high").alias("top"))
    from pyspark.sql import Window

    before = edges.select("part", F.lag("high").over(Window.orderBy("low")).alias("below")).join(wrap, F.lit(True))
    below = written(before.select("part", F.coalesce("below", "top").alias("below")), "edges")
    within = F.lag(key).over(Window.partitionBy("part").orderBy(key))
    return parts.withColumn("within", within).join(below, "part").select(
        key, F.coalesce("within", "below").alias("next_key")
    )


def fingerprint_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: its fingerprint, that of its edited text, and likenesses; see `op4_fingerprint`.

    A null text counts as empty and a null id as the smallest id. Rows with one id share their next document;
    of several rows with the next id, the one with the smallest text is taken. A single id is its own next.
    """
    none = F.lit(-(2**63))
    key = F.coalesce(F.col(doc_id).cast("long"), none).alias("key")
    # both sides of the last join start from these rows in this partitioning, so Spark hashes and shuffles them once
    texts = docs.select(key, text_of(text).alias("text")).withColumn("mark", lanes(F.col("text"))).repartition("key")
    links = written(next_lower(docs.select(key), "key"), "next")
    half = docs.select(key, text_of(text).alias("text")).groupBy("key").agg(F.max(F.floor(F.length("text") / 2)).cast("int").alias("half"))
    wanted = written(links.join(half, "key").select(F.col("next_key").alias("key"), F.col("key").alias("user"), "half"), "wanted")
    offers = texts.join(wanted, "key").select(
        "user", F.struct(F.substring("text", F.lit(1), F.col("half")).alias("lead"), "mark").alias("offer")
    )
    offered = offers.groupBy("user").agg(F.min("offer").alias("offer"))
    both = texts.join(offered, texts["key"] == offered["user"])
    n = F.length("text")
    cut = (n - F.floor(n / 2)).cast("int")
    lead = F.substring(F.col("offer.lead"), F.lit(1), F.floor(n / 2).cast("int"))
    edited = F.concat(F.substring("text", F.lit(1), cut), lead)
    return (
        both.select(
            F.nullif("key", none).alias("doc_id"), n.cast("long").alias("n_chars"), "mark", F.col("offer.mark").alias("next_mark"), edited.alias("edited")
        )
        .select("doc_id", "n_chars", "mark", "next_mark", F.sha2("edited", 256).alias("edited_sha256"), lanes(F.col("edited")).alias("edited_mark"))
        .select(
            "doc_id", "n_chars", "edited_sha256",
            shown(F.col("mark")).alias("fingerprint"),
            shown(F.col("edited_mark")).alias("edited_fingerprint"),
            likeness(F.col("mark"), F.col("edited_mark")).alias("near_edited"),
            likeness(F.col("mark"), F.col("next_mark")).alias("near_next"),
        )
    )


def op4_fingerprint(spark, sf_dir: str) -> DataFrame:
    """Whole `documents`: each text and its edited text, whose last half is the start of the next document."""
    return fingerprint_edits(documents(spark, sf_dir))
