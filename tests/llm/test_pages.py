"""WARC archives and template extraction."""

import gzip
import io
import random

import plain  # noqa: F401
import pytest
from pyspark.sql import functions as F

from tidemark.llm import template, warc
from tidemark.llm.pagetokens import main_text, tokens

PAGES = "page_id long, url string, html string"


def archived(payloads, **options):
    return b"".join(warc.record(i, f"http://h/{i}", p, None, False, "2024-01-01T00:00:00Z") for i, p in payloads)


def test_records_are_members_of_their_own_and_come_back():
    rng = random.Random(1)
    payloads = [(1, b""), (None, b"x"), (3, b"\r\n\r\nWARC/1.1\r\n"), (4, rng.randbytes(3_000_000)), (5, b"a" * 2_000_000)]
    data = archived(payloads)
    assert gzip.decompress(data).count(b"WARC-Record-ID") == len(payloads)

    class Slow(io.BytesIO):
        def read(self, n=-1):
            return super().read(min(n, 1009))

    for source in (io.BytesIO(data), Slow(data)):
        found = list(warc.read_records(source))
        assert [x["payload"] for x in found] == [p for _, p in payloads]
        assert [warc._page_of(x["headers"]["warc-record-id"]) for x in found] == [i for i, _ in payloads]
    assert list(warc.read_records(io.BytesIO(b""))) == []


def test_damage_is_found():
    data = archived([(1, b"hello world"), (2, b"more")])
    with pytest.raises(warc.Damaged):
        list(warc.read_records(io.BytesIO(data[:-20])))
    plain = gzip.decompress(archived([(1, b"hello world")]))
    for old, new in ((b"hello", b"jello"), (b"Content-Length: ", b"Content-Length: 1"), (b"WARC/1.1", b"WORC/1.1")):
        with pytest.raises(warc.Damaged):
            list(warc.read_records(io.BytesIO(gzip.compress(plain.replace(old, new, 1)))))


def test_archives_of_a_table(spark, tmp_path):
    rows = [(1, "http://a/ b", "same"), (5, None, "same"), (3, "u", "same"), (2, "u", None), (7, "u", ""), (9, "u", "é" * 10), (None, "u", "same"), (11, "u", "twice"), (11, "u", "twice")]
    pages = spark.createDataFrame(rows, PAGES).selectExpr("*", "'x' AS original", "'y' AS digest").repartition(3)
    archives = warc.write_archives(pages, f"file://{tmp_path}/w", archive_bytes=400)
    assert archives.selectExpr("sum(records)").first()[0] == len(rows) and archives.count() > 3
    out = warc.read_archives(archives, f"file://{tmp_path}/w").collect()
    by = {r.page_id: r for r in out}
    assert len(out) == len(rows)
    assert [(by[i].record_type, by[i].refers_to) for i in (1, 3, 5, None, 2, 7, 9, 11)] == [
        ("revisit", 5), ("revisit", 5), ("response", None), ("revisit", 5), ("revisit", 7), ("response", None), ("response", None), ("response", None),
    ]
    assert bytes(by[5].payload) == b"same" and by[1].payload is None and by[1].payload_bytes == 4
    assert by[1].payload_digest == warc.digest_of(b"same") and by[9].payload_bytes == 20
    small = warc.read_archives(warc.write_archives(pages, f"file://{tmp_path}/v", min_revisit=5), f"file://{tmp_path}/v").collect()
    assert {r.record_type for r in small} == {"response"}
    none = warc.write_archives(pages.limit(0), f"file://{tmp_path}/e")
    assert warc.read_archives(none, f"file://{tmp_path}/e").count() == 0


def test_archives_are_read_by_several_tasks(spark, tmp_path):
    """About one archive to a task, also where adaptive execution would merge partitions."""
    pages = spark.createDataFrame([(i, f"http://a.org/{i}", f"page {i} " * 50) for i in range(120)], PAGES).repartition(4)
    archives = warc.write_archives(pages, f"file://{tmp_path}/many", archive_bytes=500)
    n = archives.count()
    assert n >= 12
    read = warc.read_archives(archives, f"file://{tmp_path}/many")
    parts = read.select(F.spark_partition_id().alias("part")).groupBy("part").count().collect()
    assert len(parts) >= n // 2 and sum(r["count"] for r in parts) == 120


def test_main_text_of_odd_pages():
    none = frozenset()
    assert main_text("", none) == "" and main_text("just text &amp; more", none) == "just text & more"
    assert main_text("<p>a<p>b <b>c</b>d<br>e", none) == "a\n\nb cd e"
    assert main_text("<script>var a='<p>no</p>'</script><style>x</style><p>1 < 2 &#233;&nbsp;f</p><!-- <p>x -->", none) == "1 < 2 é f"
    assert main_text('<nav>m</nav><article><h1>T</h1><p>x</p></article><div class="x">y</div>', none) == "T\n\nx"
    assert main_text('<main><p>x</p><section id="comments"><p>c</p></section><aside>a</aside></main>', none) == "x"
    assert main_text('<header>H</header><article><header><h1>T</h1></header><p>x</p></article>', none) == "T\n\nx"
    assert main_text('<div class="cookie-notice">c</div><form>f</form><p>x', none) == "x"
    assert main_text("<p title='a>b'>x</p><a href=\"odd>y</a> <p>end <a hre", none) == "x\n\ny\n\nend"
    assert main_text("<" * 20000, none).count("<") == 20000
    assert len(tokens("<div>" * 3000 + "x")) == 3001


def page(i, body, menu=True):
    nav = "<div><b>Home</b></div><div>About us</div><div>Contact</div>" if menu else ""
    return f"<html><body>{nav}<div class=c><p>{body}</p></div><div>Site of all</div><p>id {i}</p></body></html>"


def test_template_is_deduced_per_site(spark):
    rows = [(i, f"http://A.org/{i}", page(i, f"own text {i}")) for i in range(8)]
    rows += [(20, "http://a.org:80/x", page(20, "own text", menu=False))]
    rows += [(30, "http://small.org/", page(30, "alone")), (31, None, page(31, "nowhere")), (32, "http://a.org/n", None), (0, "http://A.org/0", rows[0][2])]
    pages = spark.createDataFrame(rows, PAGES).selectExpr("*", "'x' AS row", "'y' AS host", "1 AS class").repartition(3)
    out = {}
    for r in template.extract(pages).collect():
        assert out.setdefault(r.row.page_id, r.text) == r.text
    assert out[3] == "own text 3\n\nid 3" and out[20] == "own text\n\nid 20" and out[32] == ""
    assert out[30] == "Home\n\nAbout us\n\nContact\n\nalone\n\nSite of all\n\nid 30" and out[31].startswith("Home")
    assert template.extract(pages.limit(0)).count() == 0


def test_copies_of_one_page_are_no_template(spark):
    same = page(1, "copied text")
    rows = [(i, "http://a.org/", same) for i in range(50)] + [(100 + i, "http://a.org/", page(i + 7, f"own {i}")) for i in range(6)]
    out = {r.row.page_id: r.text for r in template.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert out[4] == "copied text\n\nid 1" and out[103] == "own 3\n\nid 10"


def test_classes_without_one_order_are_no_template(spark):
    def shuffled(i):
        parts = ["<p>one</p>", "<p>two</p>", "<p>three</p>"]
        return "<body>" + "".join(parts[k % 3] for k in range(i, i + 3)) + f"<div>{i}</div></body>"

    rows = [(i, "http://a.org/", shuffled(i)) for i in range(9)]
    out = {r.row.page_id: r.text for r in template.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert sorted(out[4].split("\n\n")) == ["4", "one", "three", "two"]
