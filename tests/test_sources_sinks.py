import json

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import at, rows_of
from tidemark import schemas
from tidemark.operators.clicks import count_fields, count_maps
from tidemark.operators.counting import average, timed_words, word_count
from tidemark.operators.routing import connect, label, route, select_labels, union_all
from tidemark.sinks import keyed
from tidemark.sinks.jdbc import jdbc_upsert_writer, merge_statement
from tidemark.sinks.kafka import line_messages, messages, write_options
from tidemark.sources.kafka import read_options
from tidemark.sources.lines import (
    ads_info,
    bad_rows,
    good_rows,
    parse_access_log,
    parse_delimited,
    read_lines,
)
from tidemark.sources.tables import collection


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_delimited_lines_keep_going_after_a_bad_one(spark):
    df = parse_delimited(
        lines(spark, "1,2,3,pv,10", "1,x,3,pv,10", "1,2,3", "", None, "4,5,6,buy,20,extra"),
        schemas.USER_BEHAVIOR,
    )
    assert rows_of(good_rows(df)) == [(1, 2, 3, "pv", 10), (4, 5, 6, "buy", 20)]
    assert sorted(r._corrupt for r in bad_rows(df).collect()) == ["", "", "1,2,3", "1,x,3,pv,10"]


def test_blanks_are_kept_unless_trimmed(spark):
    text = lines(spark, "sensor_1, 100, 35.8")
    assert rows_of(good_rows(parse_delimited(text, schemas.SENSOR_READING, trim=True))) == [
        ("sensor_1", 100, 35.8)
    ]
    order = good_rows(parse_delimited(lines(spark, "7,create,,100"), schemas.ORDER_EVENT))
    assert rows_of(order) == [(7, "create", "", 100)]


def test_access_log(spark):
    df = parse_access_log(
        lines(
            spark,
            "83.1.2.3 u1 - 17/05/2015:10:05:03 +0000 GET /a.png",
            "83.1.2.3 u1 - 17/99/2015:10:05:03 +0000 GET /a.png",
            "short line",
        )
    )
    good = good_rows(df).first()
    assert (good.ip, good.user_id, good.method, good.url) == ("83.1.2.3", "u1", "GET", "/a.png")
    assert str(good.ts) == "2015-05-17 10:05:03"
    assert bad_rows(df).count() == 2


def test_ads_lines(spark):
    parsed = parse_delimited(lines(spark, "1569588591712,north,town,104,3"), schemas.ADS_LINE)
    row = ads_info(good_rows(parsed)).first()
    assert (row.day_string, row.hm_string, row.area, row.ads_id) == ("2019-09-27", "12:49", "north", "3")


def test_text_files_and_words(spark, tmp_path):
    (tmp_path / "a.txt").write_text("hello you\nhello  me\n\n")
    df = word_count(read_lines(spark, str(tmp_path)), "value")
    assert rows_of(df) == [("hello", 2), ("me", 1), ("you", 1)]


def test_timed_words(spark):
    df = timed_words(lines(spark, "2024-01-01 00:00:05,a b", "no time,c", "2024-01-01 00:00:06,"))
    assert [(r.word, str(r.ts)) for r in df.orderBy("word").collect()] == [
        ("a", "2024-01-01 00:00:05"), ("b", "2024-01-01 00:00:05"),
    ]


def test_collection_and_average(spark):
    df = collection(spark, [("a", 1), ("a", 2), ("b", 4)], "k string, v bigint")
    assert rows_of(average(df, ["k"], "v")) == [("a", 1.5, 2), ("b", 4.0, 1)]


def test_routing(spark):
    df = spark.createDataFrame([("a", 31.0), ("b", 30.0), ("c", None)], "id string, t double")
    labelled = label(df, {"high": F.col("t") > 30}, "low")
    assert rows_of(labelled.select("id", "label")) == [("a", "high"), ("b", "low"), ("c", "low")]
    assert select_labels(labelled, ["high", "low"]).count() == 3
    parts = route(df, {"freezing": F.col("t") < 32})
    assert (parts["freezing"].count(), parts["main"].count()) == (2, 1)
    assert union_all(df, df.select("t", "id")).count() == 6
    joined = connect(df, df.select("id", F.lit("x").alias("msg")))
    assert joined.columns == ["id", "t", "msg"] and joined.count() == 6


def test_count_fields_and_maps(spark):
    counts = spark.createDataFrame(
        [("d1", "north", "town", 1, 5), ("d1", "south", "city", 2, 7)],
        "day string, area string, city string, ad bigint, n bigint",
    )
    fields = count_fields(counts, "day", ["area", "city", "ad"])
    row = count_maps(fields, shards=1).first()
    assert row.hash_key == "date:area:city:ads:d1"
    assert row.fields == {"north:town:1": "5", "south:city:2": "7"}
    assert sum(len(r.fields) for r in count_maps(fields).collect()) == 2


def test_upserts_are_merged_on_reading_and_safe_to_repeat(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "id string, ts timestamp_ntz, t double"
    write = keyed.upsert_writer(path, ["id"], ["ts"])
    first = spark.createDataFrame([("a", at(1), 1.0), ("a", at(3), 3.0), ("b", at(1), 9.0)], schema)
    second = spark.createDataFrame([("a", at(2), 2.0), ("b", at(1), 8.0)], schema)
    for batch, df in [(0, first), (1, second), (1, second)]:
        write(df, batch)
    got = keyed.read_upserts(spark, path, first.schema, ["id"], ["ts"])
    assert rows_of(got) == [("a", at(3), 3.0), ("b", at(1), 8.0)]


def test_reading_before_the_first_batch(spark, tmp_path):
    schema = spark.createDataFrame([], "id string").schema
    assert keyed.read_batches(spark, str(tmp_path / "none"), schema).count() == 0


def test_set_add(spark, tmp_path):
    path = str(tmp_path / "s")
    write = keyed.set_add_writer(path, ["day", "user"])
    batches = [[("d", 1), ("d", 1), ("d", 2)], [("d", 2), ("d", 3)], [("d", 2), ("d", 3)]]
    frames = [spark.createDataFrame(b, "day string, user bigint") for b in batches]
    for batch, df in [(0, frames[0]), (1, frames[1]), (1, frames[2])]:
        write(df, batch)
    got = keyed.read_batches(spark, path, frames[0].schema)
    assert rows_of(got) == [("d", 1, 0), ("d", 2, 0), ("d", 3, 1)]


def test_merge_statement_updates_and_inserts():
    db = duckdb.connect()
    db.execute("CREATE TABLE temperature (sensor VARCHAR PRIMARY KEY, temp DOUBLE)")
    db.execute("INSERT INTO temperature VALUES ('a', 1), ('b', 2)")
    db.execute("CREATE TABLE temperature_staging AS SELECT * FROM (VALUES ('b', 20.0), ('c', 30.0)) v(sensor, temp)")
    db.execute(merge_statement("temperature", "temperature_staging", ["sensor"], ["sensor", "temp"]))
    assert sorted(db.execute("SELECT * FROM temperature").fetchall()) == [("a", 1.0), ("b", 20.0), ("c", 30.0)]


def test_jdbc_writer_stages_the_latest_rows_before_the_merge(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    steps = []
    monkeypatch.setattr(
        DataFrameWriter,
        "jdbc",
        lambda self, url, table, mode, properties: steps.append((url, table, mode, rows_of(self._df))),
    )
    write = jdbc_upsert_writer(
        "jdbc:x", "temperature", ["sensor"], ["ts"], ["sensor", "temp"], steps.append
    )
    rows = [("a", at(1), 1.0), ("a", at(2), 2.0)]
    write(spark.createDataFrame(rows, "sensor string, ts timestamp_ntz, temp double"), 0)
    staging = steps[0][1]
    assert staging.startswith("temperature_staging_") and steps[0] == ("jdbc:x", staging, "overwrite", [("a", 2.0)])
    assert steps[1].startswith(f"MERGE INTO temperature AS t USING {staging} AS s") and steps[2] == f"DROP TABLE {staging}"


def test_jdbc_writers_do_not_meet_and_names_are_quoted(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    tables, run = [], []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, mode, properties: tables.append(table))
    df = spark.createDataFrame([("a", 1, 2)], '`key` string, `order` int, `odd"name` int')
    for _ in range(2):
        jdbc_upsert_writer("jdbc:x", "t", ["key"], ["order"], ["key", "order", 'odd"name'], run.append, quote='"')(df, 0)
    assert len(set(tables)) == 2 and all(t.startswith('"t_staging_') for t in tables)
    assert f'MERGE INTO "t" AS t USING {tables[0]} AS s ON t."key" = s."key"' in run[0]
    assert '"odd""name" = s."odd""name"' in run[0] and run[1] == f"DROP TABLE {tables[0]}"


def test_kafka_messages_and_options(spark):
    df = spark.createDataFrame([("a", 1, None)], "id string, n bigint, x string")
    row = messages(df, ["id", "n"]).first()
    assert row.key == "a:1" and json.loads(row.value) == {"id": "a", "n": 1, "x": None}
    keys = [r.key for r in line_messages(lines(spark, "x", "x", "y")).collect()]
    assert keys[0] == keys[1] != keys[2]
    assert read_options("h:1", ["s", "t"], per_batch=5) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "s,t", "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "5",
    }
    assert write_options("h:1", "out")["topic"] == "out"


@pytest.mark.parametrize("schema", [s for n, s in vars(schemas).items() if n.isupper()])
def test_schemas_are_nullable(schema):
    assert all(f.nullable for f in schema)
