"""HTML extraction by deducing each site's template from its pages.

Tokens (block tags and text blocks with their path) that occur equally often on every page of a site form an equivalence class.
Large, frequent classes whose tokens keep one order, and which lie in one slot between tokens of the site's largest
class, are the template; what they leave over is the page's own text.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.pagetokens import main_text, tokens
from tidemark.llm.tables import pages, text_of, written

#: Pages of a site below which it has no template, share of its pages on which a class must occur, and tokens in a class.
MIN_PAGES = 5
SUPPORT = 0.5
MIN_TOKENS = 3


def host_of(url: Column) -> Column:
    """Lower-case host of an address; null where there is none."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def occurrences(rows: DataFrame) -> DataFrame:
    """(host, token, support, a, b): how many pages hold a token, and two sums that stand for its occurrence vector.

    A page adds, for each of its tokens, hashes of the page and the token's count there. Equal vectors have equal
    sums; different ones agree by chance about once in 2 ** 64. Sums are combined in each task, so a site's rows
    meet by token and no site lands in one task.
    """

    def run(batches):
        for batch in batches:
            host, page, token, count = [], [], [], []
            for h, p, text in zip(*(batch.column(c).to_pylist() for c in ("host", "page", "html"))):
                for key, n in Counter(t.key for t in tokens(text)).items():
                    host.append(h)
                    page.append(p)
                    token.append(key)
                    count.append(n)
                if len(host) > 100_000:
                    yield _columns(host, page, token, count)
                    host, page, token, count = [], [], [], []
            yield _columns(host, page, token, count)

    def _columns(host, page, token, count):
        return pa.RecordBatch.from_arrays(
            [pa.array(host, pa.string()), pa.array(page, pa.int64()), pa.array(token, pa.int64()), pa.array(count, pa.int32())],
            names=["host", "page", "token", "n"],
        )

    found = rows.mapInArrow(run, "host string, page long, token long, n int")

    def part(shift: int) -> Column:
        return F.shiftrightunsigned(F.xxhash64("page", "n"), shift).bitwiseAND(F.lit((1 << 32) - 1))

    return found.groupBy("host", "token").agg(
        F.count(F.lit(1)).alias("support"), F.sum(part(0)).alias("a"), F.sum(part(32)).alias("b")
    )


def candidates(rows: DataFrame, min_pages: int = MIN_PAGES, support: float = SUPPORT, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """(host, classes): the large and frequent classes of each site, the most frequent and largest first.

    A site's frequent tokens are fewer than its mean tokens a page over `support`, so the array is short.
    """
    sizes = written(rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages")), "hosts")
    frequent = (
        occurrences(rows).where(F.col("support") >= min_pages).join(sizes, "host")
        .where(F.col("support") >= support * F.col("pages"))
    )
    classes = (
        frequent.groupBy("host", "support", "a", "b").agg(F.sort_array(F.collect_list("token")).alias("members"))
        .where(F.size("members") >= min_tokens)
        .select("host", F.struct((-F.col("support")).alias("order"), (-F.size("members")).alias("size"), "members").alias("class"))
    )
    return classes.groupBy("host").agg(F.sort_array(F.collect_list("class")).alias("classes")).select("host", F.col("classes.members").alias("classes"))


def page_orders(page: str, classes: list[list[int]]) -> list[tuple[int, int, bool]]:
    """For each class on a page: a hash of its tokens' order, the root token before it, and whether the order repeats.

    The first class is the root. A class whose tokens occur several times must repeat one sequence.
    """
    of = {key: c for c, members in enumerate(classes) for key in members}
    orders: dict[int, list[int]] = {}
    slots: dict[int, int] = {}
    last_root = 0
    for t in tokens(page):
        c = of.get(t.key)
        if c is None:
            continue
        orders.setdefault(c, []).append(t.key)
        slots.setdefault(c, last_root if c else 0)
        if c == 0:
            last_root = t.key
    out = []
    for c, members in enumerate(classes):
        if found := orders.get(c):
            m = len(members)
            steady = len(found) % m == 0 and all(found[i] == found[i % m] for i in range(len(found))) and len(set(found[:m])) == m
            out.append((c, hash(tuple(found[:m])), slots[c], steady))
    return out


def templates(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(host, template): tokens of the site's valid classes: one order and one slot of the root class on all pages."""

    def run(batches):
        for batch in batches:
            out = []
            for host, page, classes in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "classes"))):
                out += [(host, *x) for x in page_orders(page, classes)]
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["host", "class", "sequence", "slot", "steady"])

    checked = (
        rows.join(found, "host").select("host", "html", "classes")
        .mapInArrow(run, "host string, class int, sequence long, slot long, steady boolean")
        .groupBy("host", "class")
        .agg(F.min("sequence").alias("s0"), F.max("sequence").alias("s1"), F.min("slot").alias("t0"), F.max("slot").alias("t1"), F.min("steady").alias("steady"))
        .where("steady AND s0 = s1 AND t0 = t1")
    )
    valid = checked.join(found, "host").select("host", F.col("classes")[F.col("class")].alias("members"))
    return valid.groupBy("host").agg(F.flatten(F.collect_list("members")).alias("template"))


def extract(docs: DataFrame, url: str = "url", html: str = "html", min_pages: int = MIN_PAGES, support: float = SUPPORT) -> DataFrame:
    """`row` (each input row as a struct) and `text`, the page's main text, empty if there is none.

    A null html is an empty page. Pages that are equal byte for byte count once in a site's template, so that copies of
    one page do not make its text a template. A page without a host, or on a site of fewer than `min_pages`
    different pages, has no template; it is read by its elements alone. Repeated rows get the same text; columns of
    any name may be present.
    """

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                texts = [
                    main_text(page, frozenset(template or ()))
                    for page, template in zip(part.column("html").to_pylist(), part.column("template").to_pylist())
                ]
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    every = docs.select(F.struct("*").alias("row"), host_of(F.col(url)).alias("host"), text_of(html).alias("html"))
    every = every.withColumn("page", F.xxhash64("html"))
    sited = every.where(F.col("host").isNotNull()).select("host", "page", "html")
    copies = sited.groupBy("host", "page").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("host", "page")
    copies = written(copies, "copies")
    single = sited.join(copies, ["host", "page"], "left_anti")
    one_each = sited.join(copies, ["host", "page"], "left_semi").groupBy("host", "page").agg(F.min("html").alias("html"))
    distinct = single.unionByName(one_each)
    found = written(candidates(distinct, min_pages, support), "classes")
    template = written(templates(distinct, found), "templates")
    joined = every.join(template, "host", "left").select("row", "html", "template")
    return joined.mapInArrow(run, f"row {joined.schema['row'].dataType.simpleString()}, text string")


def op7_extract(spark, sf_dir: str) -> DataFrame:
    """Whole `pages`."""
    return extract(pages(spark, sf_dir)).select(
        "row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars")
    )
