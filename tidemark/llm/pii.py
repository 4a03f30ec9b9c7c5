"""Personal data: rules for the plain forms, and a character tagger that adds spans in forms the rules do not know.

The tagger reads overlapping windows; their scores are joined place by place, and one best path goes over each stretch of
windows that meet, so a span of any length is one span wherever the windows cut it. It reads the windows
around each digit, @, bracketed "at" and written "dot", in any spelling and whatever the length of the text: the forms
that `plausible` knows all hold one of these.
"""

from __future__ import annotations

import bisect
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import documents, text_of
from tidemark.llm.tagger import Tagger, codes

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 96, 48
#: Texts whose start carries the labelled spans that the tagger is trained on; the spans are drawn by seed.
CARRIERS = 200
CARRIER_CHARS = 1500
EXAMPLES = 1800
EPOCHS = 8
#: Windows that go through the network together.
TOGETHER = 512

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only begin where a run of digits does, as later beginnings fail where that one fails
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGNS = re.compile(r"[0-9@]")
_DIGIT = re.compile(r"[0-9]")
# what a span that the tagger adds holds at least one of, and the runs around it that windows must cover as well
_MARKS = re.compile(r"[0-9@]|[\[({<]\s?at\s?[\])}>]|\bdot\b", re.I)
BESIDE = 3
_ON = re.compile(rf"\S*(?:\s{{1,2}}\S+){{0,{BESIDE}}}")
_RUN = re.compile(r"\S*")
_WRITTEN_DOT = r"(?: ?[\[({<] ?(?:dot|\.) ?[\])}>] ?|\sdot\s)"
_ADDRESS = re.compile(
    rf"[\w.%+-]+(?:{_WRITTEN_DOT}[\w.%+-]+)*(?: ?@ ?| ?[\[({{<] ?(?:at|@) ?[\])}}>] ?|(?P<bare>\sat\s))"
    rf"[\w-]+(?:(?: ?\. ?|{_WRITTEN_DOT})[A-Za-z0-9-]+)+",
    re.I,
)
_YEAR = r"(?:1[5-9]|20)[0-9]{2}"
_DATES = re.compile(rf"{_YEAR}[ ./-]+[0-9]{{1,2}}[ ./-]+[0-9]{{1,2}}|[0-9]{{1,2}}[ ./-]+[0-9]{{1,2}}[ ./-]+{_YEAR}|{_YEAR}[ ./-]+{_YEAR}")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain: from each @ back over the local part, in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        tail = _DOMAIN.match(text, at + 1) if start < at else None
        if tail:
            yield start, tail.end()
            done = tail.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by the rules, ordered by kind and start; positions are code points, ends exclusive."""
    if not _SIGNS.search(text):
        return []
    out = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_DIGIT.findall(m.group())) <= 15:
            out.append((3, *m.span()))
    return out


# ---- labelled spans


def _with_check(digits: str) -> str:
    return next(digits + c for c in "0123456789" if luhn(digits + c))


def _forms(rng: np.random.Generator, words: list[str]) -> list[tuple[int, str]]:
    """One example of each form: plain ones and ones that people write to be read by people only."""

    def d(n: int) -> str:
        return "".join(str(rng.integers(10)) for _ in range(n))

    def word() -> str:
        return words[rng.integers(len(words))]

    local = rng.choice(["", f"{word()}."]) + word() + rng.choice(["", d(2), f".{d(2)}", f"_{d(1)}"])
    host = f"{word()}{rng.choice(['', d(1)])}"
    top = rng.choice(["com", "org", "net", "example.com", "de", "co.uk"])
    parts = [str(rng.integers(1, 256)) for _ in range(4)]
    card = _with_check(rng.choice(["4", "5", "3"]) + d(14))
    fours = [card[i : i + 4] for i in range(0, 16, 4)]
    area, mid, last = d(3), d(3), d(4)
    at, dot = [(" [at] ", " [dot] "), (" (at) ", " (dot) "), ("[at]", "[dot]"), ("(at)", "."), (" [at] ", "."), (" {at} ", " {dot} ")][rng.integers(6)]
    spaced_at, spaced_dot = [(" at ", " dot "), (" AT ", " DOT ")][int(rng.random() < 0.2)]
    if rng.random() < 0.2:
        at, dot = at.upper(), dot.upper()
    return [
        (0, f"{local}@{host}.{top}"), (0, f"{local}@{host}.{top}"), (0, f"{local} @ {host}.{top}"),
        (0, f"{local}@{host}[dot]{top.split('.')[0]}"), (0, f"{local}@{host} . {top.split('.')[0]}"),
        (0, f"{local}{at}{host}{dot}{top.replace('.', dot)}"), (0, f"{local}{at}{host}{dot}{top.replace('.', dot)}"),
        (0, f"{local}{spaced_at}{host}{spaced_dot}{top.replace('.', spaced_dot)}"),
        (1, ".".join(parts)), (1, "[.]".join(parts)), (1, " . ".join(parts)),
        (2, card), (2, card), (2, " ".join(fours)), (2, "-".join(fours)), (2, ".".join(fours)),
        (3, f"+1 ({area}) {mid}-{last}"), (3, f"+{d(2)} {d(3)} {d(7)}"), (3, f"({area}) {mid}-{last}"),
        (3, f"{area}-{mid}-{last}"), (3, f"{area}.{mid}.{last}"), (3, f"1-{area}-{mid}-{last}"), (3, f"({area}) {mid} {last}"),
        (3, f"({d(2)}) {mid}-{last}"), (3, f"{mid}-{d(2)}-{last}"), (3, f"{d(4)}-{last}"), (3, f"({d(2)}) {d(3)} {d(3)}"),
    ]


def _others(rng: np.random.Generator) -> list[str]:
    """Things with digits or signs that are nobody's."""

    def d(n: int) -> str:
        return "".join(str(rng.integers(10)) for _ in range(n))

    year, month, day = rng.integers(1900, 2030), rng.integers(1, 13), rng.integers(1, 29)
    return [
        f"at {'abc'[rng.integers(3)]} dot", f"{year}-{year + rng.integers(1, 9)}", f"{year}-{month:02}-{day:02}", f"{day}/{month}/{year}", f"{day}.{month}.{year}", f"{year}", f"${d(3)},{d(3)}.{d(2)}",
        f"{rng.integers(24)}:{d(2)}:{d(2)}", f"v{rng.integers(20)}.{rng.integers(20)}.{rng.integers(99)}", d(rng.integers(1, 9)),
        d(rng.integers(20, 30)), f'token = "{rng.bytes(20).hex()}"', rng.bytes(20).hex().upper(), f"@{'abc'[rng.integers(3)]}",
        f"978-{d(1)}-{d(4)}-{d(4)}-{d(1)}", f"{d(2)}-{d(2)}", f"{d(1)}.{d(2)} %", f"No. {d(4)}-{d(2)}", f"{d(5)}-{d(5)}-{d(5)}", f"{d(3)},{d(3)},{d(3)}",
    ]


def labelled_windows(carriers: list[str], n: int = EXAMPLES, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Codes and tags of `n` windows: stretches of the carriers' words with spans and other things put in between."""
    rng = np.random.default_rng(seed)
    words = [w for text in carriers for w in text.split() if w.isascii() and w.isalpha()] or ["some", "words", "here"]
    stock = [w for text in carriers for w in text.split() if not _SIGNS.search(w)] or words
    x, y = np.zeros((n, WINDOW), np.int64), np.zeros((n, WINDOW), np.int64)
    for row in range(n):
        forms, others = _forms(rng, [w.lower() for w in words[rng.integers(len(words)) :][:50]] or words), _others(rng)
        text, tags = "", []
        ahead = int(rng.integers(0, 60))
        while len(text) < WINDOW + 30:
            start = rng.integers(len(stock))
            for piece in stock[start : start + rng.choice([0, 1, 2, 4, 7])]:
                text, tags = f"{text}{piece} ", tags + [0] * (len(piece) + 1)
            if len(text) < ahead:
                continue
            tail = rng.choice([" ", ". ", ", ", "\n", "*** ", "!! ", " | "])
            if rng.random() < 0.65:
                kind, piece = forms[rng.integers(len(forms))]
                tags += [2 * kind + 1] + [2 * kind + 2] * (len(piece) - 1)
            else:
                piece = others[rng.integers(len(others))]
                tags += [0] * len(piece)
            text, tags = text + piece + tail, tags + [0] * len(tail)
        cut = int(rng.integers(0, len(text) - WINDOW + 1))
        x[row] = codes(text[cut : cut + WINDOW])
        row_tags = tags[cut : cut + WINDOW]
        for i, tag in enumerate(row_tags):  # a span that the edge cuts begins at the edge
            if tag and tag % 2 == 0 and i == 0:
                row_tags[0] = tag - 1
        y[row] = row_tags
        if rng.random() < 0.3:  # a text's end, then padding
            end = int(rng.integers(8, WINDOW))
            x[row, end:], y[row, end:] = 0, 0
    return x, y


def train_tagger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carriers: int = CARRIERS) -> Tagger:
    """A tagger trained on the driver; it gets the first `CARRIER_CHARS` of `carriers` texts, those of least id hash.

    Without any text it is trained on a few stock words.
    """
    chosen = (
        docs.where(F.length(text) > 0)
        .select(F.xxhash64(doc_id).alias("place"), F.substring(text, 1, CARRIER_CHARS).alias("text"))
        .orderBy("place", "text").limit(carriers).toArrow()
    )
    tagger = Tagger(len(KINDS))
    tagger.train(*labelled_windows(chosen["text"].to_pylist()), epochs=EPOCHS)
    return tagger


# ---- reconciling windows


def plausible(kind: int, span: str) -> bool:
    """What a span that the tagger adds must be like. An "at" without brackets needs a written "dot": others are prose."""
    digits = "".join(_DIGIT.findall(span))
    if kind == 0:
        found = _ADDRESS.fullmatch(span)
        return found is not None and (found["bare"] is None or re.search(r"\bdot\b", span[found.end("bare") :], re.I) is not None)
    if kind == 1:
        found = re.fullmatch(r"([0-9]{1,3})(?: ?\[?\.\]? ?([0-9]{1,3})){3}", span)
        return found is not None and all(int(p) <= 255 for p in re.findall("[0-9]+", span))
    if kind == 2:
        return re.fullmatch(r"[0-9]+(?:[ ./-][0-9]+)*", span) is not None and 13 <= len(digits) <= 19 and luhn(digits)
    formed = re.fullmatch(r"\+?[0-9(](?:[ ().-]{0,2}[0-9])+", span) is not None and len(digits) < len(span)
    return formed and 8 <= len(digits) <= 15 and (len(digits) > 9 or _DATES.fullmatch(span) is None)


def _window_spans(tags: np.ndarray) -> Iterator[tuple[int, int, int]]:
    i, n = 0, len(tags)
    while i < n:
        if tags[i] == 0:
            i += 1
            continue
        kind, start = (int(tags[i]) - 1) // 2, i
        i += 1
        while i < n and tags[i] == 2 * kind + 2:
            i += 1
        yield kind, start, i


# a place counts by its distance from its window's edges, where the network has seen little of one side
_WEIGHT = (np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1]) + 1).astype(np.float32)


def joined_scores(length: int, starts: list[int], scores: list[np.ndarray]) -> list[tuple[int, np.ndarray]]:
    """(start, scores by place) of each stretch of a text of `length` that overlapping windows cover: means over the windows."""
    out, first = [], 0
    for i in range(1, len(starts) + 1):
        if i < len(starts) and starts[i] < starts[i - 1] + WINDOW:
            continue
        begin, end = starts[first], min(length, starts[i - 1] + WINDOW)
        total, weight = np.zeros((end - begin, scores[0].shape[1]), np.float32), np.zeros((end - begin, 1), np.float32)
        for start, score in zip(starts[first:i], scores[first:i]):
            n = min(WINDOW, length - start)
            w = _WEIGHT[:n, None]
            total[start - begin : start - begin + n] += w * score[:n]
            weight[start - begin : start - begin + n] += w
        out.append((begin, total / weight))
        first = i
    return out


def best_paths(tagger: Tagger, stretches: list[np.ndarray]) -> list[np.ndarray]:
    """Best tags of each stretch; stretches of like length go together, filled up with places outside any span."""
    out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(stretches)
    order = sorted(range(len(stretches)), key=lambda i: len(stretches[i]))
    a = 0
    while a < len(order):
        b = a + 1
        while b < len(order) and len(stretches[order[b]]) * (b + 1 - a) <= TOGETHER * WINDOW:
            b += 1
        some = order[a:b]
        scores = np.full((len(some), len(stretches[some[-1]]), tagger.tags), -1e4, np.float32)
        scores[:, :, 0] = 0
        for row, i in enumerate(some):
            scores[row, : len(stretches[i])] = stretches[i]
        for row, i in zip(tagger.best(scores), some):
            out[i] = row[: len(stretches[i])]
        a = b
    return out


def added_spans(text: str, paths: list[tuple[int, np.ndarray]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of a text's stretches that are plausible, end at no letter or digit, and overlap no base span."""
    places = sorted((a, b) for _, a, b in base)
    # the farthest end of all base spans up to each, so one look to the left is enough
    begins, ends = [a for a, _ in places], list(itertools.accumulate((b for _, b in places), max))
    out = []
    for start, tags in paths:
        for kind, a, b in _window_spans(tags):
            a, b = start + a, start + b
            beside = text[a - 1 : a] + text[b : b + 1]
            at = bisect.bisect_left(begins, b)
            if (at and ends[at - 1] > a) or any(c.isalnum() for c in beside) or not plausible(kind, text[a:b]):
                continue
            out.append((kind, a, b))
    return out


def _around(text: str) -> Iterator[np.ndarray]:
    """Every `STRIDE` a place from `BESIDE` runs before each mark to as many after it, a run being all between white space."""
    done = 0
    for m in _MARKS.finditer(text):
        if m.start() < done:
            continue
        before = text[done : m.start()].rsplit(None, BESIDE + 1)
        start = done + len(before[0]) if len(before) == BESIDE + 2 else done
        yield np.arange(start // STRIDE * STRIDE, _ON.match(text, m.end() - 1).end(), STRIDE)
        done = _RUN.match(text, m.end() - 1).end()


def window_starts(text: str, around: bool = False) -> list[int]:
    """Starts of the windows, one each `STRIDE`, that hold a digit or an @; with `around` those of all marks and the runs beside them."""
    found = np.concatenate([np.zeros(0, np.int64), *_around(text)]) if around else np.array([m.start() for m in _SIGNS.finditer(text)], np.int64)
    if not len(found):
        return []
    last = max(0, -(-(len(text) - WINDOW) // STRIDE))
    k = found // STRIDE
    both = np.unique(np.concatenate([k, k - 1]))
    both = both[(both >= 0) & (both <= last)]
    return (both * STRIDE).tolist()


def find_spans(texts: list[str], tagger: Tagger) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text, both ordered by kind and start."""
    out = [(base_spans(t), []) for t in texts]
    starts = [window_starts(t, around=True) for t in texts]
    gathered: list[tuple[int, int]] = [(i, s) for i, some in enumerate(starts) for s in some]
    scores: dict[int, list[np.ndarray]] = {}
    ready: list[tuple[int, int, np.ndarray]] = []

    def settle() -> None:
        paths: dict[int, list[tuple[int, np.ndarray]]] = {}
        for (i, start, _), path in zip(ready, best_paths(tagger, [r[2] for r in ready])):
            paths.setdefault(i, []).append((start, path))
        for i, some in paths.items():
            out[i][1].extend(added_spans(texts[i], some, out[i][0]))
        ready.clear()

    for a in range(0, len(gathered), TOGETHER):
        some = gathered[a : a + TOGETHER]
        x = np.zeros((len(some), WINDOW), np.int64)
        for row, (i, s) in enumerate(some):
            part = codes(texts[i][s : s + WINDOW])
            x[row, : len(part)] = part
        for (i, _), score in zip(some, tagger.emissions(x)):
            scores.setdefault(i, []).append(score)
        # a text is done once the next window is of another text
        following = gathered[a + TOGETHER][0] if a + TOGETHER < len(gathered) else len(texts)
        for i in [i for i in scores if i < following]:
            ready += [(i, start, stretch) for start, stretch in joined_scores(len(texts[i]), starts[i], scores.pop(i))]
        if sum(len(r[2]) for r in ready) >= TOGETHER * WINDOW:
            settle()
    settle()
    return [(base, sorted(base + more)) for base, more in out]


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def personal_data(docs: DataFrame, tagger: Tagger, text: str = "text") -> DataFrame:
    """`row` (each input row as a struct), n_email, n_ip, n_card, n_phone by the rules, base and spans as text.

    A null text is empty and has no spans. Repeated rows have the same spans; columns of any name may be present. Rows stay in their partitions; windows go through
    the network by `TOGETHER`, so memory follows a batch's texts and not their windows.
    """

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                found = find_spans(part.column("text").to_pylist(), tagger)
                counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), *counts, pa.array([shown(b) for b, _ in found], pa.string()), pa.array([shown(s) for _, s in found], pa.string())],
                    names=["row", *(f"n_{k}" for k in KINDS), "base", "spans"],
                )

    rows = docs.select(F.struct("*").alias("row"), text_of(text).alias("text"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, {counts}, base string, spans string")


def op6_pii(spark, sf_dir: str) -> DataFrame:
    """Whole `documents`."""
    docs = documents(spark, sf_dir)
    return personal_data(docs.select("doc_id", "text"), train_tagger(docs)).select(
        "row.doc_id", *(f"n_{k}" for k in KINDS), F.sha2("base", 256).alias("base_sha256"), "spans"
    )
