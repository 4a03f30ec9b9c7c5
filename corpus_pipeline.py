"""From raw documents to token ids: the stages of a corpus pipeline, each one operator of `tidemark.llm`.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's
documents. All but the last return the columns of `documents`; rows that a stage does not drop pass through it,
with `n_chars` following the text. Null texts and ids, empty tables and repeated rows are treated as each
operator states.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, linededup, mixing, quality, simhash
from tidemark.llm.tables import documents, labels, written


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.accepted(docs, labels(spark, sf_dir))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on much of a source's pages go; the documents stay, be it with an empty text."""
    cleaned = linededup.dedup_lines(docs)
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    changed = {"text": F.col("text"), "n_chars": F.when(F.col("n_dropped") > 0, length).otherwise(F.col("row.n_chars"))}
    return cleaned.select(*(changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated to meet their source's share of the mixture, in a global shuffle."""
    return mixing.mix(docs, mixing.smoothed_rates(docs)).select("row.*")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each text as token ids, and the text that these decode to: doc_id, lang, source, n_tokens, ids, text."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN).select(
        "row.doc_id", "row.lang", "row.source", F.size("ids").cast("long").alias("n_tokens"), "ids", "text"
    )


STAGES = [
    ("quality classifier", classify),
    ("line dedup", drop_boilerplate),
    ("simhash near-dedup", drop_near_duplicates),
    ("mixing sources", mix_sources),
    ("byte-level bpe", tokenize),
]

#: Trees, SimHash groups and merges have no SQL form: tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over whole `documents`."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
