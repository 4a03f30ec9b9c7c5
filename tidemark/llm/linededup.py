"""Lines that recur over much of one site are boilerplate: navigation, notices, signatures.

A line's site frequency is the number of the site's pages that hold it over the site's number of pages, a page being a
distinct text.
Lines above a ratio go; everything else of a page stays in place. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import text_of, written

RATIO = 0.05
MIN_PAGES = 3
_BLANKS = " \t\r"


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(_BLANKS))


def _key(line: Column) -> Column:
    """128 bits that stand for a line; the two hashes differ in their seed."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def boilerplate(
    docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """(host, lines): per site the keys of lines on more than `ratio` of its pages and on `min_pages` at least.

    Equal texts of a site are one page, so copies make no line more frequent, and a page counts once per line. A site of
    P pages has fewer than L / ratio such lines, L being its mean number of lines a page, so that `lines` stays short
    whatever the number of pages. Pages are told apart by 128 bits of their texts and shuffled as the 16-byte keys of
    their lines, copies being combined in each task before; then lines are counted, again combined in each task. Rows are
    spread over a site's texts and lines, so no site lands in one task.
    """
    lines = F.array_distinct(F.transform(F.split(text_of(text), "\n"), _trimmed))
    keys = F.transform(F.filter(lines, lambda x: x != ""), _key)
    texts = docs.where(F.col(host).isNotNull()).select(F.col(host).alias("host"), _key(text_of(text)).alias("page"), keys.alias("keys"))
    found = written(texts.groupBy("host", "page").agg(F.first("keys").alias("keys")), "site-pages")
    pages = written(found.groupBy("host").agg(F.count(F.lit(1)).alias("pages")), "sites")
    counts = (
        found.select("host", F.explode("keys").alias("key"))
        .groupBy("host", F.col("key.a").alias("a"), F.col("key.b").alias("b"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_pages)
    )
    return (
        counts.join(pages, "host")
        .where(F.col("n") > ratio * F.col("pages"))
        .groupBy("host")
        .agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("lines"))
    )


def dedup_lines(
    docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """(row, text, n_lines, n_dropped): each input row as a struct, its text without boilerplate lines.

    Lines are compared without blanks at their ends; blank lines are never boilerplate and stay. Rows without
    a host belong to no site and stay as they are; a null text stays null with no lines; a text of which
    every line goes becomes empty. Repeated rows and texts are one page of their site and are all cleaned. Columns of any name may be present.
    """
    bad = written(boilerplate(docs, host, text, ratio, min_pages), "boilerplate")
    rows = docs.select(F.struct("*").alias("row"), F.col(host).alias("host"))
    body = F.split(F.col(f"row.`{text}`"), "\n")
    joined = rows.join(bad, "host", "left").select(
        "row", body.alias("body"), F.coalesce("lines", F.array().cast(bad.schema["lines"].dataType)).alias("lines")
    )
    keep = F.filter("body", lambda x: (_trimmed(x) == "") | ~F.array_contains("lines", _key(_trimmed(x))))
    return joined.select("row", "body", keep.alias("kept")).select(
        "row",
        F.array_join("kept", "\n").alias("text"),
        F.coalesce(F.size("body"), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("body") - F.size("kept"), F.lit(0)).alias("n_dropped"),
    )


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Whole `documents`, a source being a site."""
    from tidemark.llm.tables import documents

    return dedup_lines(documents(spark, sf_dir)).select(
        F.col("row.doc_id").alias("doc_id"), "text", "n_lines", "n_dropped"
    )


OP1_SQL = f"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents),
keyed AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS k FROM lines),
texts AS (SELECT DISTINCT source, coalesce(text, '') AS text FROM documents WHERE source IS NOT NULL),
sites AS (SELECT source, count(*) AS pages FROM texts GROUP BY source),
site_lines AS (
  SELECT source, text, trim(line, ' ' || chr(9) || chr(13)) AS k
  FROM (SELECT source, text, unnest(string_split(text, chr(10))) AS line FROM texts)),
bad AS (
  SELECT source, k FROM site_lines JOIN sites USING (source)
  WHERE k <> '' GROUP BY source, k
  HAVING count(DISTINCT text) >= {MIN_PAGES} AND count(DISTINCT text) > {RATIO} * any_value(pages)),
done AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE bad.k IS NULL), '') AS text,
         count(*) AS n_lines, count(bad.k) AS n_dropped
  FROM keyed LEFT JOIN bad ON bad.source = keyed.source AND bad.k = keyed.k
  GROUP BY doc_id)
SELECT doc_id, CASE WHEN documents.text IS NULL THEN NULL ELSE done.text END AS text,
       CAST(coalesce(n_lines, 0) AS INTEGER) AS n_lines, CAST(coalesce(n_dropped, 0) AS INTEGER) AS n_dropped
FROM documents LEFT JOIN done USING (doc_id)
"""
