"""Quality rules on repetition: how much of a text lies inside repeated n-grams and repeated lines.

Rolling hashes of several n-gram lengths mark every window of n words that occurs again in its text; the
measure is the share of the text's word characters inside such windows. Repeated lines are measured alike.
The limits are those of published web-corpus filters for the shares of duplicated 5- to 10-grams and lines.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import documents, text_of
from tidemark.llm.wordhash import Texts, pools, summed

#: Largest shares of word characters inside repeated n-grams, by n.
GRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Largest share of word characters in lines that repeat an earlier one.
LINE_CHAR_LIMIT = 0.20
MIN_WORDS = 10
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True

COLUMNS = [
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("n_lines", pa.int64()),
    ("dup_line_chars", pa.int64()), *((f"dup_chars_{n}", pa.int64()) for n in GRAM_LIMITS),
]


def measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The measures of `COLUMNS` for each text."""
    t = Texts(texts)
    out = {
        "n_words": t.n_words.astype(np.int64),
        "word_chars": summed(t.chars, t.doc, t.n),
        "n_symbols": t.count_bytes(_SYMBOLS).astype(np.int64),
    }
    for n in GRAM_LIMITS:
        first, again, _ = t.repeated(n)
        inside = t.covered(first[again], n)
        out[f"dup_chars_{n}"] = summed(t.chars * inside, t.doc, t.n)
        if n == 5:
            out["n_repeat_words"] = summed(inside, t.doc, t.n)
    doc, start, end, before = t.lines()
    # characters of words only, as everywhere
    cum = np.concatenate([[0], np.cumsum(t.chars)])
    line_chars = cum[np.searchsorted(t.start, end)] - cum[np.searchsorted(t.start, start)]
    out["n_lines"] = np.bincount(doc, minlength=t.n).astype(np.int64)
    out["n_dup_lines"] = summed(before, doc, t.n)
    out["dup_line_chars"] = summed(line_chars * before, doc, t.n)
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > 20 * out["n_words"])
    good = out["dup_line_chars"] <= LINE_CHAR_LIMIT * out["word_chars"]
    for n, limit in GRAM_LIMITS.items():
        good &= out[f"dup_chars_{n}"] <= limit * out["word_chars"]
    out["kept"] = good & ~out["base_failed"]
    return out


def repetition(docs: DataFrame, text: str = "text") -> DataFrame:
    """`row` (each input row as a struct) and the measures of `COLUMNS`.

    A null text has no words and fails the base rule, like an empty one. Repeated rows are measured alike;
    columns of any name may be present. Rows stay in their partitions; a task works on slices of some
    megabyte of text, or on one longer text.
    """

    def run(batches):
        for batch, texts in pools(batches):
            found = measure(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(pa.array(found[name], kind) for name, kind in COLUMNS)],
                names=["row", *(name for name, _ in COLUMNS)],
            )

    rows = docs.select(F.struct("*").alias("row"), text_of(text).alias("text"))
    kinds = {pa.int64(): "long", pa.bool_(): "boolean"}
    declared = ", ".join(f"{name} {kinds[kind]}" for name, kind in COLUMNS)
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, {declared}")


def op3_repetition(spark, sf_dir: str) -> DataFrame:
    """Whole `documents`."""
    return repetition(documents(spark, sf_dir).select("doc_id", "text")).select("row.doc_id", *(name for name, _ in COLUMNS))
