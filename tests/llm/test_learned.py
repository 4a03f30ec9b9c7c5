"""Quality classifier and personal data: plain versions, gradients and held-out accuracy."""

import random
import re
import zlib

import numpy as np
import pytest

from plain import make, plain_spans  # noqa: F401

from tidemark.llm import pii, quality
from tidemark.llm.tagger import Tagger


def test_flat_trees_equal_a_walk_per_row():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((1500, 6)).astype(np.float32)
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    forest = quality.train(x[:1000], y[:1000])
    scores = forest.scores(x)
    for row in range(0, 1500, 50):
        total = forest.base
        for node in forest.roots:
            while forest.feature[node] >= 0:
                node = forest.left[node] if x[row, forest.feature[node]] <= forest.threshold[node] else forest.right[node]
            total += forest.value[node]
        assert scores[row] == pytest.approx(1 / (1 + np.exp(-total)))
    assert ((scores[1000:] > 0.5) == y[1000:]).mean() > 0.95


@pytest.mark.parametrize("labels", [[], [1.0, 1.0], [0.0]])
def test_without_two_classes_the_score_is_a_share(labels):
    forest = quality.train(np.zeros((len(labels), 3), np.float32), np.array(labels))
    assert forest.scores(np.ones((2, 3), np.float32)).tolist() == pytest.approx([(sum(labels) + 1) / (len(labels) + 2)] * 2)


def test_statistics_do_not_depend_on_neighbours():
    texts = [b"", b"a b a b a b\nx y\nx y", "É! 12 | $$ é".encode(), b"  \n", b"same same same"]
    together = quality.statistics(texts)
    for i, text in enumerate(texts):
        assert np.allclose(together[i], quality.statistics([text])[0])
    assert not together[0].any() and not together[3].any()
    assert together[4][quality.STATISTICS.index("next_same")] == pytest.approx(2 / 3)


def test_quality_of_documents(make, spark):
    rng = random.Random(5)
    prose = lambda: " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(2, 9))) for _ in range(60))
    rows = [(i, prose() if i % 2 else "bad " * 50) for i in range(300)] + [(None, None), (1, prose())]
    docs = make(rows, clash=True)
    marked = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (5, None)], "doc_id long, quality int")
    forest = quality.fit(docs, marked)
    out = quality.scored(docs, forest).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert all(r.predicted == r.row.doc_id % 2 for r in out if r.row.doc_id is not None)
    assert all(r.predicted == (r.score >= 0.3) for r in out)
    kept = quality.accepted(docs, marked)
    assert kept.columns == docs.columns and kept.where("doc_id % 2 = 0").count() == 0
    folds = docs.select("doc_id", quality.fold_of("doc_id").alias("f")).collect()
    assert all(r.f == zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 5 for r in folds)
    empty = make([])
    assert quality.scored(empty, quality.fit(empty, marked.limit(0))).count() == 0


def test_held_out_labels_are_not_read(make, spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    sample = quality.sampled_labels(spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int"), bound=50)
    got = [r.doc_id for r in sample.collect()]
    assert len(got) == 50 and not set(got) & set(ids)


def test_rules_against_plain_patterns():
    rng = random.Random(9)
    parts = ["a.b@c.de", "@", "a@b", "x@y..z", "1.2.3.4", "300.1.1.1", "01.002.3.4.5", "4111111111111111", "4111-1111 1111 1111", "+1 (017) 555-7713", "+", "5", "-", " ", ".", "é", "@@", "%", "a@b.c@d.e", "007.8.9.10"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 9)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_rules_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "a.b@" * 50_000, "+1" * 100_000, "1." * 100_000, "1 " * 100_000):
        pii.base_spans(text)


def test_gradient_of_the_tagger():
    tagger, rng = Tagger(2), np.random.default_rng(0)
    tagger.p = {k: v.astype(np.float64) for k, v in tagger.p.items()}
    x, y = rng.integers(1, 90, (3, 9)), np.zeros((3, 9), int)
    y[0, 3:6], y[1, 0] = [1, 2, 2], 3
    _, grad = tagger.loss_and_gradient(x, y)
    for name, g in grad.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        value = tagger.p[name]
        old, losses = value[at], []
        for shift in (1e-3, -1e-3):
            value[at] = old + shift
            losses.append(tagger.loss_and_gradient(x, y)[0])
        value[at] = old
        assert (losses[0] - losses[1]) / 2e-3 == pytest.approx(g[at], rel=2e-2, abs=1e-3)


def carriers(seed):
    rng = random.Random(seed)
    letters = "etaoinshrdlucmfwypvbgkqjxz" * 3 + "ÉéèüñßTAOIN"
    word = lambda: "".join(rng.choices(letters, k=rng.randrange(1, 10))) + rng.choice(["", "", "", ",", "."])
    return [" ".join(word() for _ in range(200)) for _ in range(60)]


@pytest.fixture(scope="module")
def tagger():
    trained = Tagger(len(pii.KINDS))
    trained.train(*pii.labelled_windows(carriers(1)), epochs=pii.EPOCHS)
    return trained


def test_tagger_on_held_out_windows(tagger):
    x, y = pii.labelled_windows(carriers(2), 200, seed=77)
    tags, _ = tagger.decode(x)
    assert (tags == y).mean() > 0.94 and (tags[y > 0] == y[y > 0]).mean() > 0.85


def test_viterbi_finds_the_best_path(tagger):
    import itertools

    small = Tagger(1, seed=3)
    x = np.random.default_rng(2).integers(1, 90, (4, 5))
    tags, scores = small.decode(x)
    step, begin = small.p["step"] + small.barred, small.p["begin"] + small.barred_begin
    for i in range(4):
        value = lambda path, i=i: begin[path[0]] + sum(scores[i, t, k] for t, k in enumerate(path)) + sum(step[a, b] for a, b in itertools.pairwise(path))
        assert value(tags[i].tolist()) == pytest.approx(max(value(p) for p in itertools.product(range(3), repeat=5)), rel=1e-5)


def test_added_spans(tagger):
    pad = "plain words stand here and go on for a while " * 4
    text = f"{pad}call (017) 555-7713 soon, {pad}card 4539-1488-0343-6467, host 10[.]0[.]0[.]12 and a.b@c.org {pad}"
    ((base, every),) = pii.find_spans([text], tagger)
    assert base == pii.base_spans(text) and set(base) <= set(every)
    found = {text[a:b] for _, a, b in every}
    assert {"(017) 555-7713", "a.b@c.org"} <= found
    spans = sorted((a, b) for _, a, b in every)
    assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:]))
    clean = "In 1999 it was 3.5 % of 1,234,567 on 2024-01-15 at 12:30:45, see v1.2.3 and 978-3-1234-5678-9."
    assert pii.find_spans([clean, "", pad], tagger) == [([], []), ([], []), ([], [])]


def test_windows_without_signs_are_the_only_ones_left_out():
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choices("abc 1@", weights=[9, 9, 9, 9, 0.3, 0.1], k=rng.randrange(700)))
        starts = pii.window_starts(text)
        n = max(1, -(-(len(text) - pii.WINDOW) // pii.STRIDE) + 1)
        want = [k * pii.STRIDE for k in range(n) if re.search("[0-9@]", text[k * pii.STRIDE :][: pii.WINDOW])]
        assert starts == want


def test_texts_across_network_batches(tagger, monkeypatch):
    texts = [f"{'x ' * (i % 90)}ring 017-555-77{i:02} now {'y ' * 70}or +1 (017) 555-7713" for i in range(40)]
    want = pii.find_spans(texts, tagger)
    monkeypatch.setattr(pii, "TOGETHER", 7)
    assert pii.find_spans(texts, tagger) == want


def test_personal_data_table(make, tagger):
    docs = make([(1, None), (2, ""), (3, "a.b@c.org 1.2.3.4"), (3, "a.b@c.org 1.2.3.4"), (4, "w " * 200_000 + "+49 30 1234567")], clash=True)
    out = pii.personal_data(docs, tagger).collect()
    assert len(out) == 5
    by = {r.row.doc_id: r for r in out}
    assert by[3].base == "email:0:9,ip:10:17" and by[3].n_email == by[3].n_ip == 1 and by[3].spans == by[3].base
    assert by[1].spans == by[2].spans == "" and by[4].base == "phone:400000:400014"
    assert pii.personal_data(make([]), tagger).count() == 0
    assert pii.train_tagger(make([(1, None)])).tags == 9


