"""Streams over several files against the table operators on the same rows."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import at, rows_of
from tidemark.functions.eventtime import to_stream_time, to_table_time
from tidemark.operators.alarms import temperature_jumps
from tidemark.operators.matching import interval_join, reconcile, window_join
from tidemark.operators.patterns import click_cap, order_states
from tidemark.operators.ranking import top_keys
from tidemark.operators.visitors import unique_visitors
from tidemark.operators.windowed import sliding_counts, sliding_first_by, tumbling
from tidemark.session import work_dir
from tidemark.sinks.keyed import read_batches
from tidemark.sources.lines import stream_lines
from tidemark.streaming import counts as live
from tidemark.streaming.ads import ads_writer, click_cap_writer
from tidemark.streaming.runner import closed_by, console, last_batch, run_to_table, start
from tidemark.streaming.stateful import (
    order_states_stream,
    rising_now_stream,
    temperature_jumps_stream,
)
from tidemark.streaming.watermarks import ascending, bounded, late_writer, mark_late, split_late

SCHEMA = "k string, ts timestamp_ntz, id bigint, v double"


def sample(seed, n=240, span=7200, jitter=0):
    """Rows in order of arrival: event times grow, up to `jitter` seconds out of order."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        second = span * i // n + rng.randrange(-jitter, 1)
        rows.append((rng.choice("aaab"), at(second), i, float(rng.randrange(60))))
    return rows


def files(spark, tmp_path, rows, parts=4, schema=SCHEMA, name="in"):
    """A stream that gets the rows in `parts` micro-batches, in order."""
    folder = str(tmp_path / name)
    size = -(-len(rows) // parts)
    import os, time

    for i in range(parts):
        part = rows[i * size : (i + 1) * size]
        random.Random(i).shuffle(part)
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        for file in os.listdir(folder):  # arrival order is by file time
            full = os.path.join(folder, file)
            if os.path.getmtime(full) > time.time() - 10**6:
                os.utime(full, (10**9 + i, 10**9 + i))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    columns = [f.name for f in StructType.fromDDL(schema) if f.dataType.simpleString() == "timestamp_ntz"]
    return to_stream_time(stream, *columns)


def closed(df, rows, delay, column="window_end"):
    last = max(r[1] for r in rows if r[1] is not None)
    return df.where(closed_by(column, F.lit(last).cast("timestamp_ntz"), delay))


def test_work_folders_lie_in_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first.startswith(shared) and first != second


@pytest.mark.parametrize("size,slide", [("10 minutes", "2 minutes"), ("10 minutes", "3 minutes")])
def test_sliding_counts_stream_equals_table(spark, tmp_path, size, slide):
    rows = sample(1, jitter=50)
    stream = bounded(files(spark, tmp_path, rows), "ts", "1 minute")
    got = run_to_table(sliding_counts(stream, "ts", size, slide, ["k"]), "t").drop("batch")
    want = sliding_counts(spark.createDataFrame(rows, SCHEMA), "ts", size, slide, ["k"])
    assert rows_of(to_table_time(got, "window_start", "window_end")) == rows_of(
        closed(want, rows, "1 minute")
    )


def test_top_of_closed_windows(spark, tmp_path):
    rows = sample(2)
    counts = sliding_counts(
        ascending(files(spark, tmp_path, rows), "ts"), "ts", "10 minutes", "5 minutes", ["k"]
    )
    got = run_to_table(
        counts,
        "t",
        transform=lambda df: top_keys(df, ["window_end"], "k", 1).select("window_end", "k", "n"),
        schema="window_end timestamp, k string, n bigint",
    ).drop("batch")
    table = sliding_counts(
        spark.createDataFrame(rows, SCHEMA), "ts", "10 minutes", "5 minutes", ["k"]
    )
    want = top_keys(closed(table, rows, "0 seconds"), ["window_end"], "k", 1)
    assert rows_of(to_table_time(got, "window_end")) == rows_of(want.select("window_end", "k", "n"))


def test_first_by_stream(spark, tmp_path):
    rows = sample(3, jitter=1)
    args = ("ts", "10 minutes", "2 minutes", ["k"], ["v", "ts", "id"], [])
    stream = bounded(files(spark, tmp_path, rows), "ts", "1 second")
    got = run_to_table(sliding_first_by(stream, *args), "t").drop("batch")
    want = sliding_first_by(spark.createDataFrame(rows, SCHEMA), *args)
    assert rows_of(to_table_time(got, "window_start", "window_end", "ts")) == rows_of(
        closed(want, rows, "1 second")
    )


def test_updates_while_windows_are_open(spark, tmp_path):
    rows = sample(4, jitter=50)
    stream = bounded(files(spark, tmp_path, rows), "ts", "1 second", "1 minute")
    panes = live.pane_counts(stream, "ts", "10 minutes", "2 minutes", ["k"])
    written = run_to_table(panes, "t", "update")
    assert written.groupBy("k", "pane_start").count().where("count > 1").count() > 0
    current = last_batch(written, ["k", "pane_start"])
    got = live.windows_of_panes(current, "10 minutes", "2 minutes", ["k"])
    want = sliding_counts(
        spark.createDataFrame(rows, SCHEMA), "ts", "10 minutes", "2 minutes", ["k"]
    )
    assert rows_of(to_table_time(got, "window_start", "window_end")) == rows_of(want)


def test_visitors_two_ways(spark, tmp_path):
    rows = sample(5)
    table = spark.createDataFrame(rows, SCHEMA)
    want = unique_visitors(table, "ts", "id", "30 minutes")
    stream = ascending(files(spark, tmp_path, rows), "ts")
    final = run_to_table(unique_visitors(stream, "ts", "id", "30 minutes"), "t").drop("batch")
    assert rows_of(to_table_time(final, "window_end")) == rows_of(closed(want, rows, "0 seconds"))
    so_far = run_to_table(
        live.new_visitors(stream, "ts", "k", "30 minutes"),
        "u",
        schema="window_end timestamp, n bigint",
        writer=lambda path: live.increment_writer(path, ["window_end"]),
    )
    got = to_table_time(live.sum_increments(so_far, ["window_end"]), "window_end")
    assert rows_of(got) == rows_of(unique_visitors(table, "ts", "k", "30 minutes"))


def test_late_rows_do_not_count(spark, tmp_path):
    # Spark lets a row pass for one batch after the watermark has gone by, so it comes in the fourth
    rows = [("a", at(s), s, 0.0) for s in (10, 20, 5000, 5001, 5002, 5003, 30, 5004)]
    stream = ascending(files(spark, tmp_path, rows, parts=4), "ts")
    got = run_to_table(tumbling(stream, "ts", "1 minute", ["k"]), "t").drop("batch")
    assert rows_of(to_table_time(got, "window_start", "window_end")) == [("a", at(0), at(60), 2)]


def test_split_late_names_them(spark):
    rows = [(1, at(0), at(0)), (2, at(5000), at(5000)), (3, at(5001), at(30)), (4, at(5020), at(30)),
            (5, at(5021), at(4990))]
    df = spark.createDataFrame(rows, "id bigint, arrived timestamp_ntz, ts timestamp_ntz")
    rule = dict(ts="ts", arrival="arrived", size="1 minute", slide="1 minute", delay="1 second",
                lateness="10 seconds", batch="10 seconds")
    got = {r.id: r.late for r in mark_late(df, **rule, chunk="20 seconds").collect()}
    # row 3 arrives in the batch that brings the high time, so it is not late yet
    assert got == {1: False, 2: False, 3: False, 4: True, 5: False}
    parts = split_late(df, **rule)
    assert [r.id for r in parts["late"].collect()] == [4]


def test_jumps_in_event_order(spark, tmp_path):
    rows = sample(6, jitter=50)
    stream = bounded(files(spark, tmp_path, rows), "ts", "1 minute")
    got = run_to_table(temperature_jumps_stream(stream, "k", "ts", "id", "v", 20.0), "t")
    want = temperature_jumps(
        spark.createDataFrame(rows, SCHEMA), "k", "ts", ["ts", "id"], "v", 20.0
    ).withColumnRenamed("v", "temperature")
    last = max(r[1] for r in rows)
    due = want.where((F.lit(last) - F.col("ts")) > F.expr("interval 1 minute"))
    assert rows_of(to_table_time(got.drop("batch"), "ts")) == rows_of(due) != []


def test_late_rows_of_a_stream(spark, tmp_path):
    rows = [("a", at(s), i, 0.0) for i, s in enumerate((10, 5000, 30, 5001, 40, 4999))]
    out = str(tmp_path / "late")
    stream = files(spark, tmp_path, rows, parts=3)
    start(stream, late_writer(out, "ts", "1 minute", "1 minute", "1 second"), f"{out}/cp").awaitTermination()
    ids = {
        part: sorted(r.id for r in read_batches(spark, f"{out}/{part}", StructType.fromDDL("id bigint")).collect())
        for part in ("main", "late")
    }
    assert ids == {"main": [0, 1, 3, 5], "late": [2, 4]}


def test_rising_by_the_wall_clock(spark, tmp_path):
    rows = [("up", at(1), 1, 1.0), ("down", at(1), 2, 9.0), ("up", at(2), 3, 2.0), ("down", at(2), 4, 8.0),
            ("up", at(3), 5, 3.0), ("back", at(1), 6, 1.0), ("back", at(2), 7, 2.0), ("back", at(3), 8, 1.0)]
    stream = files(spark, tmp_path, rows, parts=1)
    alarms = rising_now_stream(stream, "k", "ts", "id", "v", "1 second")
    out = str(tmp_path / "rise")
    query = start(alarms, live.increment_writer(f"{out}/rows", ["k", "msg"]), f"{out}/cp", every="1 second")
    got, tries = [], 0
    while not got and tries < 60:
        assert not query.awaitTermination(1)
        got = rows_of(read_batches(spark, f"{out}/rows", StructType.fromDDL("k string, msg string")).drop("batch"))
        tries += 1
    query.stop()
    assert got == [("up", "sensor up temperature kept rising for 1 second")]


ORDER = "o bigint, ts timestamp_ntz, kind string"


def test_order_states_stream(spark, tmp_path):
    rows = [
        (1, at(0), "create"), (2, at(0), "create"), (4, at(5), "pay"), (3, at(10), "create"),
        (1, at(899), "pay"), (2, at(900), "pay"), (5, at(910), "pay"), (5, at(900), "create"),
        (9, at(10**6), "pay"), (9, at(10**6), "pay"),
    ]
    stream = bounded(files(spark, tmp_path, rows, 3, ORDER), "ts", "30 seconds")
    got = run_to_table(order_states_stream(stream, "o", "ts", "kind", "15 minutes", "1 hour"), "t")
    table = spark.createDataFrame([r for r in rows if r[0] != 9], ORDER)
    want = order_states(table, "o", "ts", "kind", "15 minutes")
    assert rows_of(got.drop("batch")) == rows_of(want)


PAY, RECEIPT = "tx string, p_ts timestamp_ntz, p bigint", "tx string, r_ts timestamp_ntz, r bigint"


def test_stream_joins(spark, tmp_path):
    rng = random.Random(9)
    pays = [(rng.choice("abc"), at(20 * i + rng.randrange(5)), i) for i in range(60)]
    receipts = [(rng.choice("abc"), at(20 * i + rng.randrange(9)), i) for i in range(60)]
    left = bounded(files(spark, tmp_path, pays, 3, PAY, "p"), "p_ts", "10 seconds")
    right = bounded(files(spark, tmp_path, receipts, 3, RECEIPT, "r"), "r_ts", "10 seconds")
    a, b = spark.createDataFrame(pays, PAY), spark.createDataFrame(receipts, RECEIPT)

    args = ("tx", "p_ts", "r_ts", "-15 seconds", "20 seconds")
    got = run_to_table(interval_join(left, right, *args), "i").drop("batch")
    assert rows_of(to_table_time(got, "p_ts", "r_ts")) == rows_of(interval_join(a, b, *args))

    args = ("tx", "p_ts", "r_ts", "15 seconds")
    got = run_to_table(window_join(left, right, *args), "w").drop("batch")
    times = ("p_ts", "r_ts", "window_start", "window_end")
    assert rows_of(to_table_time(got, *times)) == rows_of(window_join(a, b, *args))

    args = ("tx", "p_ts", "r_ts")
    got = to_table_time(run_to_table(reconcile(left, right, *args), "r").drop("batch"), "p_ts", "r_ts")
    want = reconcile(a, b, *args)
    assert rows_of(got.where("channel = 'matched'")) == rows_of(want.where("channel = 'matched'"))
    done = at(1000)  # well before the last watermark
    early = F.coalesce("p_ts", "r_ts") < F.lit(done)
    assert rows_of(got.where(early)) == rows_of(want.where(early))


def test_click_cap_stream(spark, tmp_path):
    rows = sorted(sample(10, n=60), key=lambda r: r[1])
    stream = files(spark, tmp_path, rows)
    out = str(tmp_path / "cap")
    start(stream, click_cap_writer(out, ["k"], "ts", ["ts", "id"], 12), f"{out}/checkpoint").awaitTermination()
    got = read_batches(spark, f"{out}/rows", StructType.fromDDL("id bigint, day string, over boolean"))
    want = click_cap(spark.createDataFrame(rows, SCHEMA), ["k"], "ts", ["ts", "id"], 12)
    assert rows_of(got.drop("batch")) == rows_of(want.select("id", "day", "over"))


def test_ads_pipeline_filters_by_earlier_batches(spark, tmp_path):
    out = str(tmp_path / "ads")
    write = ads_writer(out, threshold=2)
    schema = "day string, area string, city string, user_id bigint, ads_id bigint"
    batches = [
        [("d", "n", "c", 1, 7), ("d", "n", "c", 2, 7)],
        [("d", "n", "c", 1, 7), ("d", "n", "c", 2, 8)],   # user 1 reaches two clicks on ad 7
        [("d", "n", "c", 1, 9), ("d", "n", "c", 2, 9)],   # so this click of user 1 is dropped
    ]
    for batch, rows in [(0, batches[0]), (1, batches[1]), (2, batches[2]), (2, batches[2])]:
        write(spark.createDataFrame(rows, schema), batch)
    listed = read_batches(spark, f"{out}/blacklist", StructType.fromDDL("day string, user_id bigint"))
    assert rows_of(listed) == [("d", 1, 1)]
    counts = read_batches(spark, f"{out}/counts", StructType.fromDDL("ads_id bigint, n bigint"))
    assert rows_of(live.sum_increments(counts, ["ads_id"])) == [(7, 3), (8, 1), (9, 1)]


def test_a_query_goes_on_where_it_stopped(spark, tmp_path):
    rows = sample(11)
    out = str(tmp_path / "again")
    for part in (rows[:120], rows[120:]):
        stream = files(spark, tmp_path, part, 1)
        writer = live.increment_writer(f"{out}/rows", ["k"])
        start(stream, writer, f"{out}/checkpoint").awaitTermination()
    got = read_batches(spark, f"{out}/rows", StructType.fromDDL("k string, n bigint"))
    want = spark.createDataFrame(rows, SCHEMA).groupBy("k").count()
    assert rows_of(live.sum_increments(got, ["k"])) == rows_of(want)


def test_text_stream_and_console(spark, tmp_path):
    folder = tmp_path / "text"
    folder.mkdir()
    (folder / "a.txt").write_text("one two\n")
    query = console(stream_lines(spark, str(folder), 1), name="lines")
    query.processAllAvailable()
    query.stop()
    assert query.name == "lines" and query.lastProgress is not None
