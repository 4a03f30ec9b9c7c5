"""Quality classifier: histogram gradient-boosted trees over statistics of a text, in numpy.

Trees are grown level by level from histograms of at most 64 quantile bins and flattened into five arrays, so that
all trees take all rows one level down with a few array operations. Training uses a bounded sample of labelled
rows on the driver; statistics and scores of all texts are computed where the texts are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import documents, labels, text_of, written
from tidemark.llm.wordhash import Texts, pools, summed

#: Labelled rows to train on, at most; the rest of the labels is not read into the model.
TRAIN_ROWS = 20_000
THRESHOLD = 0.3
FOLDS = 5
BINS = 64

_CLASSES = {
    "digits": b"0123456789", "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)),
    "marks": b"#*$%&<>", "bars": b"|", "shouts": b"!", "stops": b".?", "commas": b",;:", "quotes": b"\"'()[]{}",
    "at": b"@=/\\_+", "blanks": b" \t\r\n",
}
_TABLES = {}
for _name, _members in _CLASSES.items():
    _TABLES[_name] = np.zeros(256, bool)
    _TABLES[_name][list(_members)] = True
_TABLES["wide"] = np.arange(256) >= 0x80
STATISTICS = [
    "log_words", "log_chars", "word_mean", "word_deviation", "word_max", "distinct_words", "top_word", "next_same",
    "dup_2", "dup_3", "dup_5", "log_lines", "line_mean", "dup_line_chars", "single_chars", *_TABLES,
]


def statistics(texts: list[bytes]) -> np.ndarray:
    """A row of `STATISTICS` for each text; an empty text has zeros."""
    t = Texts(texts)
    n = t.n
    words = np.maximum(t.n_words, 1)
    chars = np.maximum(t.points[t.end] - t.points[t.begin], 1)
    sizes = np.maximum(t.end - t.begin, 1)
    word_chars = summed(t.chars, t.doc, n)
    out = dict.fromkeys(STATISTICS, np.zeros(n))
    out["log_words"] = np.log1p(t.n_words)
    out["log_chars"] = np.log1p(t.points[t.end] - t.points[t.begin])
    out["word_mean"] = mean = word_chars / words
    out["word_deviation"] = np.sqrt(np.maximum(np.bincount(t.doc, t.chars.astype(float) ** 2, n) / words - mean**2, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, t.doc, t.chars)
    out["word_max"] = np.log1p(longest)
    out["single_chars"] = np.bincount(t.doc, t.chars == 1, n) / words
    # occurrences of each distinct word of each text
    order = np.lexsort((t.word, t.doc))
    same = (t.word[order][1:] == t.word[order][:-1]) & (t.doc[order][1:] == t.doc[order][:-1])
    begin = np.flatnonzero(np.concatenate([[True], ~same])) if len(order) else order
    runs = np.diff(np.concatenate([begin, [len(order)]]))
    run_doc = t.doc[order][begin]
    out["distinct_words"] = np.bincount(run_doc, minlength=n) / words
    top = np.zeros(n)
    np.maximum.at(top, run_doc, runs)
    out["top_word"] = top / words
    beside = (t.word[1:] == t.word[:-1]) & (t.doc[1:] == t.doc[:-1])
    out["next_same"] = np.bincount(t.doc[1:], beside, n) / words
    for k in (2, 3, 5):
        first, _, before = t.repeated(k)
        out[f"dup_{k}"] = np.bincount(t.doc[first], before, n) / words
    doc, start, end, before = t.lines()
    n_lines = np.bincount(doc, minlength=n)
    out["log_lines"] = np.log1p(n_lines)
    out["line_mean"] = np.log1p(chars / np.maximum(n_lines, 1))
    out["dup_line_chars"] = np.bincount(doc, (end - start) * before, n) / sizes
    for name, table in _TABLES.items():
        out[name] = t.count_bytes(table) / sizes
    rows = np.column_stack([out[name] for name in STATISTICS])
    rows[t.n_words == 0] = 0
    return rows.astype(np.float32)


@dataclass
class Forest:
    """Trees as flat arrays: inner nodes have a feature and go left where it is at most the threshold; leaves have
    feature -1 and lead to themselves."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities; all trees of up to some 4,000 rows step down together."""
        out = np.empty(len(x))
        for a in range(0, len(x), 4096):
            rows = x[a : a + 4096]
            at = np.broadcast_to(self.roots, (len(rows), len(self.roots)))
            line = np.arange(len(rows))[:, None]
            for _ in range(self.depth):
                feature = self.feature[at]
                goes_left = rows[line, np.maximum(feature, 0)] <= self.threshold[at]
                at = np.where(goes_left, self.left[at], self.right[at])
            out[a : a + 4096] = 1 / (1 + np.exp(-np.clip(self.base + self.value[at].sum(axis=1), -50, 50)))
        return out


def train(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, least: float = 1.0, ridge: float = 1.0
) -> Forest:
    """Boosts logistic loss; nodes split at the bin edge of greatest gain if both sides have `least` hessian.

    Without labels, or with one class alone, there are no splits and every score is the smoothed share of ones.
    """
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    parts = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    roots, used = [], 0
    f = x.shape[1]
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1])).astype(np.float32) if len(x) else np.empty(0, np.float32) for j in range(f)]
    binned = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)]) if len(x) else np.empty((0, f), int)
    raw = np.full(len(y), base)
    for _ in range(trees if len(np.unique(y)) > 1 else 0):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = p - y, p * (1 - p)
        feature, threshold, left, right, value = [-1], [0.0], [0], [0], [0.0]
        node = np.zeros(len(y), int)
        level = [0]
        for step in range(depth + 1):
            slot = {k: i for i, k in enumerate(level)}
            lookup = np.full(len(feature), -1)
            lookup[level] = range(len(level))
            rows = np.flatnonzero(lookup[node] >= 0)
            where = ((lookup[node[rows]][:, None] * f + np.arange(f)) * BINS + binned[rows]).ravel()
            size = len(level) * f * BINS
            g = np.bincount(where, np.repeat(grad[rows], f), size).reshape(len(level), f, BINS)
            h = np.bincount(where, np.repeat(hess[rows], f), size).reshape(len(level), f, BINS)
            gl, hl = g.cumsum(axis=2), h.cumsum(axis=2)
            total_g, total_h = gl[:, :1, -1:], hl[:, :1, -1:]
            gr, hr = total_g - gl, total_h - hl
            gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - total_g**2 / (total_h + ridge)
            gain[(hl < least) | (hr < least)] = -np.inf
            deeper = []
            for k, i in slot.items():
                value[k] = float(-rate * total_g[i, 0, 0] / (total_h[i, 0, 0] + ridge))
                j, b = np.unravel_index(np.argmax(gain[i]), gain[i].shape)
                if step == depth or not gain[i, j, b] > 1e-6 or b >= len(edges[j]):
                    continue
                feature[k], threshold[k], left[k], right[k] = int(j), float(edges[j][b]), len(feature), len(feature) + 1
                feature += [-1, -1]
                threshold += [0.0, 0.0]
                value += [0.0, 0.0]
                deeper += [len(feature) - 2, len(feature) - 1]
                left += [deeper[-2], deeper[-1]]
                right += [deeper[-2], deeper[-1]]
                mine = rows[node[rows] == k]
                node[mine] = np.where(binned[mine, j] <= b, left[k], right[k])
            level = deeper
            if not level:
                break
        inner = np.array(feature) >= 0
        value = np.where(inner, 0.0, value)
        raw += value[node]
        roots.append(used)
        for name, column in (("feature", feature), ("threshold", threshold), ("value", value)):
            parts[name].append(np.asarray(column))
        parts["left"].append(np.asarray(left) + used)
        parts["right"].append(np.asarray(right) + used)
        used += len(feature)
    joined = {k: np.concatenate(v) if v else np.empty(0) for k, v in parts.items()}
    return Forest(
        feature=joined["feature"].astype(np.int32), threshold=joined["threshold"].astype(np.float32),
        left=joined["left"].astype(np.int32), right=joined["right"].astype(np.int32), value=joined["value"],
        roots=np.array(roots, np.int32), depth=depth, base=base,
    )


def fold_of(doc_id) -> F.Column:
    """crc32 of the id as text, modulo `FOLDS`; fold 0 is held out. A null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS


def sampled_labels(marked: DataFrame, doc_id: str = "doc_id", label: str = "quality", bound: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, label) of at most `bound` labelled ids outside the held-out fold, those of least hash.

    Ids with both labels, no label or no id teach nothing.
    """
    clear = (
        marked.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & (fold_of(doc_id) != 0))
        .groupBy(F.col(doc_id).alias("doc_id"))
        .agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("other"))
        .where("label = other")
        .select("doc_id", "label")
    )
    return written(clear.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound), "labels")


def fit(docs: DataFrame, marked: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", bound: int = TRAIN_ROWS) -> Forest:
    """Trains on whole texts of the sampled ids. Repeated rows of an id count each.

    The driver receives `bound` rows of statistics at most, in the order of their ids, so that the same tables give the same trees.
    """

    def run(batches):
        for batch, texts in pools(batches):
            found = statistics(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(list(found), pa.list_(pa.float32()))],
                names=["doc_id", "label", "x"],
            )

    ids = sampled_labels(marked, doc_id, label, bound)
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text")).join(ids, "doc_id").select("doc_id", "label", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    table = rows.mapInArrow(run, f"doc_id {kind}, label int, x array<float>").orderBy("doc_id", "x").limit(bound).toArrow()
    y = table["label"].to_numpy().astype(float)
    x = np.array(table["x"].to_pylist(), np.float32).reshape(len(y), len(STATISTICS))
    return train(x, y)


def scored(docs: DataFrame, forest: Forest, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """`row` (each input row as a struct), score and predicted (1 where the score reaches the threshold).

    A null text is scored like an empty one. Repeated rows score alike; columns of any name may be present. Rows stay in their partitions.
    """

    def run(batches):
        for batch, texts in pools(batches, ("row", text)):
            score = forest.scores(statistics(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=["row", "score", "predicted"],
            )

    rows = docs.select(F.struct("*").alias("row"))
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, score double, predicted int")


def accepted(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """The rows of `docs` that the classifier, trained on their labels, does not reject."""
    return scored(docs, fit(docs, marked)).where("predicted = 1").select("row.*")


def op10_quality(spark, sf_dir: str) -> DataFrame:
    """Whole `documents`, labels from `labels`."""
    docs = documents(spark, sf_dir)
    forest = fit(docs, labels(spark, sf_dir))
    return scored(docs.select("doc_id", "text"), forest).select(
        "row.doc_id", (fold_of("row.doc_id") == 0).alias("held_out"), "score", "predicted"
    )
