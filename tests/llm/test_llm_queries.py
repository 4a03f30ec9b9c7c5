"""Registered queries on the smallest tables: SQL, plain versions, held-out accuracy, and the pipeline."""

import base64
import collections
import hashlib
import os
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from plain import labels, make, plain_fingerprint, plain_repetition, plain_spans  # noqa: F401
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import queries
from tidemark.llm import QUERIES, SQL
from tidemark.llm import pii as personal

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")


def read(name):
    return duckdb.sql(f"SELECT * FROM '{SF}/{name}.parquet'").fetchall()


@pytest.fixture(scope="module")
def texts():
    return {r[0]: r[1] for r in read("documents")}


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(SQL) <= set(QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5


def test_repetition(spark, texts):
    for r in queries()["op3_repetition"](spark, SF).collect():
        want = plain_repetition(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) == want[:7]


def test_fingerprint(spark, texts):
    out = {r.doc_id: r for r in queries()["op4_fingerprint"](spark, SF).collect()}
    ids = sorted(texts, reverse=True)
    assert set(out) == set(ids)
    for i, following in zip(ids, ids[1:] + ids[:1]):
        text, half = texts[i], len(texts[i]) // 2
        assert out[i].edited_sha256 == hashlib.sha256((text[: len(text) - half] + texts[following][:half]).encode()).hexdigest()
    assert np.mean([r.near_edited for r in out.values()]) > np.mean([r.near_next for r in out.values()]) + 0.3


def test_simhash(spark, texts):
    out = {r.doc_id: r for r in queries()["op5_simhash"](spark, SF).collect()}
    ids = sorted(texts)
    values = [plain_fingerprint(texts[i]) for i in ids]
    assert {i: (out[i].fingerprint, out[i].component_id) for i in ids} == {
        i: (f"{v:016x}", ids[c]) for i, v, c in zip(ids, values, labels(values, 2))
    }


def test_personal_data(spark, texts):
    out = queries()["op6_pii"](spark, SF).collect()
    assert len(out) == len(texts)
    for r in out:
        base = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(personal.shown(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in range(4)]
        assert set(personal.shown(base).split(",")) <= set(r.spans.split(","))


def test_extraction(spark):
    html = {r[0]: r[2] for r in read("pages")}
    out = {r.page_id: r for r in queries()["op7_extract"](spark, SF).collect()}
    assert set(out) == set(html)
    for i, page in html.items():
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1]
        words = re.sub(r"<[^>]*>", " ", article).replace("&amp;", "&").replace("&quot;", '"').split()
        got = out[i].text.split()
        assert collections.Counter(got) == collections.Counter(words) or len(set(words) ^ set(got)) <= 2
        assert out[i].n_chars == len(out[i].text)


def test_bpe(spark, texts):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in queries()["op8_byte_bpe"](spark, SF).collect():
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_quality_on_held_out_labels(spark):
    larger = SF.replace("0.001", "0.01")
    quality = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{larger}/labels.parquet'").fetchall())
    out = queries()["op10_quality"](spark, larger).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in out)
    right = [r.predicted == quality[r.doc_id] for r in out if r.held_out and r.doc_id in quality]
    assert len(right) > 50 and np.mean(right) > 0.95


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    """Queries with SQL against DuckDB, cell by cell."""
    db = duckdb.connect()
    for table in ("documents", "pages"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    expected = db.sql(SQL[name])
    df = queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(expected.columns)
    same = lambda v: None if v is None else round(v, 9) if isinstance(v, float) else v
    want = sorted((tuple(map(same, r)) for r in expected.select(*[duckdb.ColumnExpression(c) for c in df.columns]).fetchall()), key=repr)
    assert sorted((tuple(map(same, r)) for r in df.collect()), key=repr) == want and want


def test_token_files(spark, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out, start = {r.doc_id: r for r in queries()["op13_token_files"](spark, SF).collect()}, 0
    assert set(out) == set(texts)
    for i in sorted(texts):
        ids = [*tokenizer.encode(texts[i], add_special_tokens=False).ids, 2]
        assert (out[i].start, out[i].n_tokens, out[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_on_odd_tables(spark, make, tmp_path, empty):  # noqa: F811
    """Nulls, empty and very long texts, repeated rows, columns of clashing names, and a table without rows."""
    good = "The committee met on Tuesday to discuss the budget, and most members agreed with the proposal. " * 4
    rows = [(1, good), (1, good), (2, good + "Then they left."), (None, good.upper()), (3, None), (4, ""), (5, "short"), (6, good * 500), (None, None)]
    docs = make([] if empty else [(i, t, s) for (i, t), s in zip(rows, ["a", "a", None, "b", "a", "b", "b", "b", None])], clash=True)
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == columns, name
    assert docs.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "text"]
    assert all(r.n_tokens == len(r.ids) for r in docs.collect()) and (not empty or docs.count() == 0)


def test_pipeline_stage_by_stage(spark, texts, tmp_path):
    """Each stage's rows against a plain version over what the stage before it kept."""
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), {}
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen[name] = {r.doc_id: r for r in docs.collect()}
        assert k == 4 or docs.columns == columns
        if k == 3:
            copies = collections.Counter(r.doc_id for r in docs.select("doc_id").collect())
    classified, lines, single, mixed, coded = seen.values()
    accepted = {r.doc_id for r in queries()["op10_quality"](spark, SF).where("predicted = 1").collect()}
    assert set(classified) == accepted
    distinct = {(r.source, r.text) for r in classified.values()}
    pages = collections.Counter(source for source, _ in distinct)
    holds = collections.Counter((source, x) for source, text in distinct for x in {y.strip(" \t\r") for y in text.split("\n")} if x)
    bad = {key for key, n in holds.items() if n >= 3 and n > 0.05 * pages[key[0]]}
    for i, r in classified.items():
        assert lines[i].text == "\n".join(x for x in r.text.split("\n") if (r.source, x.strip(" \t\r")) not in bad)
        assert lines[i].n_chars == len(lines[i].text)
    ids = sorted(lines)
    groups = labels([plain_fingerprint(lines[i].text) for i in ids], 2)
    assert set(single) == {ids[g] for g in groups}
    assert set(mixed) <= set(single) and set(coded) == set(mixed)
    assert all(r.text == lines[i].text and r.n_tokens == len(r.ids) for i, r in coded.items())
    assert sum(copies.values()) == pytest.approx(len(single), rel=0.25)
    assert {(r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, SF).collect()} == {(i, tuple(r.ids)) for i, r in coded.items()}
