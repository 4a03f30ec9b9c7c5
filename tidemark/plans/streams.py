"""Streaming forms, run over what the tables hold now.

A query that appends only closed windows is checked with the same cut in SQL (see `runner`).
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.eventtime import epoch_us, to_stream_time, to_table_time
from tidemark.functions.text import is_page_url, words
from tidemark.operators.clicks import count_fields, last_span_by_minute, minutes_json
from tidemark.operators.counting import timed_words, word_count
from tidemark.operators.matching import interval_join, reconcile, window_join
from tidemark.operators.ranking import top_keys
from tidemark.operators.windowed import sliding_counts, sliding_first_by, tumbling
from tidemark.plans import market, orders, sensors, traffic, wordcounts
from tidemark.plans.common import item, sliding_sql, url_of
from tidemark.plans.market import THRESHOLD, places
from tidemark.plans.traffic import HOT_URL_COUNTS, top_sql
from tidemark.plans.wordcounts import TIMED_WORDS_SQL, WORD_COUNT_SQL
from tidemark.session import work_dir
from tidemark.sinks.keyed import (
    day_set_writer,
    day_upsert_writer,
    day_upserts,
    latest_per_key,
    read_batches,
    replacing_writer,
    several_passes,
    write_batch,
)
from tidemark.sources.lines import stream_lines
from tidemark.sources.replay import played_back, slice_edges
from tidemark.sources.tables import stream_table, table
from tidemark.streaming import carried
from tidemark.streaming import counts as live
from tidemark.streaming.ads import click_cap_writer
from tidemark.streaming.daily import bitmap_counts, bitmap_table, bitmap_writer, count_writer, daily_counts, top_list_writer
from tidemark.streaming.runner import last_batch, run_to_table, start
from tidemark.streaming.watermarks import ascending, bounded, late_writer


def events(spark: SparkSession, sf: str) -> DataFrame:
    return to_stream_time(stream_table(spark, sf, "events"), "ts")


def view_events(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).where(F.col("event_type") == "view").select(
        "event_id", "ts", "user_id", item().alias("item_id")
    )


def stream_word_count(spark: SparkSession, sf: str) -> DataFrame:
    stream = word_count(stream_table(spark, sf, "documents"), "text")
    return last_batch(run_to_table(stream, "word-count", "update"), ["word"])


def stream_batch_word_count(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of each micro-batch on its own: the documents in four equal ranges of ids, a range to a batch."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    last = docs.agg(F.max("doc_id")).first()[0] or 0
    stream = played_back(docs, "doc_id", [(last + 1) * i // 4 for i in (1, 2, 3)], "document-log")
    tokens = stream.select(words(F.col("text")).alias("word"))

    def writer(path):
        def write(df: DataFrame, batch_id: int) -> None:
            write_batch(df.groupBy("word").agg(F.count("*").alias("n")), path, batch_id)

        return write

    rows = run_to_table(tokens, "batch-words", schema="word string, n bigint", writer=writer)
    return rows.select("batch", "word", "n")


def stream_text_file_words(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of a folder of text files, as they come."""
    lines = stream_lines(spark, wordcounts.line_files(spark, sf), files_per_batch=2)
    counts = timed_words(lines).groupBy("word").agg(F.count("*").alias("n"))
    return last_batch(run_to_table(counts, "text-words", "update"), ["word"])


def stream_windowed_word_count(spark: SparkSession, sf: str) -> DataFrame:
    second = F.date_trunc("second", "ts")
    timed = events(spark, sf).select(
        second.alias("ts"),
        F.explode(
            F.array(
                "event_type", F.concat(F.lit("user"), (F.col("user_id") % 3).cast("string"))
            )
        ).alias("word"),
    )
    counts = sliding_counts(
        bounded(timed, "ts", "2 minutes"), "ts", "10 minutes", "2 minutes", ["word"]
    )
    rows = run_to_table(counts, "timed-words").drop("batch")
    return to_table_time(rows, "window_start", "window_end")


def stream_page_view(spark: SparkSession, sf: str) -> DataFrame:
    counts = tumbling(ascending(view_events(spark, sf), "ts"), "ts", "1 hour")
    rows = run_to_table(counts, "page-view").select("window_end", "n")
    return to_table_time(rows, "window_end")


def stream_hot_items(spark: SparkSession, sf: str) -> DataFrame:
    """All items of a window close in the same batch, so each batch is ranked on its own."""
    counts = sliding_counts(
        ascending(view_events(spark, sf), "ts"), "ts", "1 hour", "5 minutes", ["item_id"]
    )
    rows = run_to_table(
        counts,
        "hot-items",
        transform=lambda df: top_keys(df, ["window_end"], "item_id", 3).select(
            "window_end", "rank", "item_id", "n"
        ),
        schema="window_end timestamp, rank int, item_id bigint, n bigint",
    ).drop("batch")
    return to_table_time(rows, "window_end")


def stream_hot_urls(spark: SparkSession, sf: str) -> DataFrame:
    """Counts are updated while late rows may still come; the report takes the last ones."""
    size, slide = "10 minutes", "5 seconds"
    pages = view_events(spark, sf).select("ts", url_of("event_id", F.col("item_id")).alias("url"))
    on_time = bounded(pages.where(is_page_url(F.col("url"))), "ts", "1 second", "1 minute")
    panes = live.pane_counts(on_time, "ts", size, slide, ["url"])
    current = last_batch(run_to_table(panes, "hot-urls", "update"), ["url", "pane_start"])
    counts = live.windows_of_panes(current, size, slide, ["url"])
    top = top_keys(counts, ["window_end"], "url", 5).select("window_end", "rank", "url", "n")
    return to_table_time(top, "window_end")


def stream_uv(spark: SparkSession, sf: str) -> DataFrame:
    visitors = live.new_visitors(
        ascending(view_events(spark, sf), "ts"), "ts", "user_id", "1 hour"
    )
    rows = run_to_table(
        visitors,
        "uv",
        schema="window_end timestamp, n bigint",
        writer=lambda path: live.increment_writer(path, ["window_end"]),
    )
    return to_table_time(live.sum_increments(rows, ["window_end"]), "window_end")


def stream_sensor_minby(spark: SparkSession, sf: str) -> DataFrame:
    readings = events(spark, sf).select(
        "event_id", "ts", "user_id", F.col("value").alias("temperature")
    )
    best = sliding_first_by(
        bounded(readings, "ts", "1 second"),
        "ts",
        "6 hours",
        "1 hour",
        ["user_id"],
        ["temperature", "ts", "event_id"],
        [],
    )
    rows = run_to_table(best, "minby").drop("batch", "window_start")
    return to_table_time(rows, "window_end", "ts")


def stream_temp_jump(spark: SparkSession, sf: str) -> DataFrame:
    readings = events(spark, sf).select("user_id", "ts", "event_id", F.col("value").alias("temperature"))
    rows = run_to_table(
        readings,
        "temp-jump",
        schema="user_id bigint, ts timestamp, last_temperature double, temperature double, msg string",
        writer=lambda path: carried.jumps_writer(path, "ts", "1 hour", "user_id", "event_id", "temperature"),
    )
    return to_table_time(rows.drop("batch"), "ts")


#: Delay of the streams that are played back in the order of event time.
DELAY = "1 hour"


def stream_order_pay(spark: SparkSession, sf: str) -> DataFrame:
    """Creates, and every line of an order as a pay: outcomes come once the watermark has passed their session."""
    creates = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.lit("create").alias("event_type"),
        F.col("o_orderdate").alias("ts"),
    )
    pays = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.lit("pay").alias("event_type"),
        F.col("l_shipdate").alias("ts"),
    )
    both = creates.unionByName(pays)
    rows = run_to_table(
        played_back(both, "ts", slice_edges([both.select("ts")]), "order-log"),
        "order-pay",
        schema="order_id bigint, channel string, result_msg string",
        writer=lambda path: carried.order_states_writer(path, both, DELAY, "order_id", "ts", "event_type", limit="90 days", late_wait="400 days"),
    )
    return rows.drop("batch")


def pay_receipt_log(spark: SparkSession, sf: str) -> DataFrame:
    """Both sides in one log, played back in event-time order."""
    log = orders.tx_log(*orders.pays_and_receipts(spark, sf)).select("tx", "ts", "side", "row.party")
    return played_back(log, "ts", slice_edges([log.select("ts")]), "tx-log")


def sides_of(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pays and receipts of a log, and what else its rows have."""
    names = {"pay": {"ts": "pay_ts", "party": "o_custkey"}, "receipt": {"ts": "receipt_ts", "party": "l_suppkey"}}
    return tuple(log.where(F.col("side") == side).drop("side").withColumnsRenamed(new) for side, new in names.items())


def _is_side() -> list[Column]:
    """A watermark over both sides waits for the slower one."""
    return [F.col("side") == side for side in ("pay", "receipt")]


def _log_joined(spark: SparkSession, sf: str, label: str, join: Callable[[DataFrame, DataFrame], DataFrame], reach: str) -> DataFrame:
    rows = run_to_table(
        pay_receipt_log(spark, sf),
        label,
        schema=join(*orders.pays_and_receipts(spark, sf)).schema,
        writer=lambda path: carried.join_writer(path, "ts", DELAY, sides_of, join, reach, _is_side()),
    )
    return rows.drop("batch")


def stream_interval_join(spark: SparkSession, sf: str) -> DataFrame:
    def pairs(pays, receipts):
        return interval_join(pays, receipts, "tx", "pay_ts", "receipt_ts", "-15 days", "20 days")

    return to_table_time(_log_joined(spark, sf, "interval-join", pairs, "20 days"), "pay_ts", "receipt_ts")


def stream_window_join(spark: SparkSession, sf: str) -> DataFrame:
    def pairs(pays, receipts):
        return window_join(pays, receipts, "tx", "pay_ts", "receipt_ts", "15 days")

    rows = _log_joined(spark, sf, "window-join", pairs, "15 days")
    return to_table_time(rows, "pay_ts", "receipt_ts", "window_start", "window_end")


def stream_tx_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs come when they meet, one-sided rows when the watermark has passed their wait."""
    waits = {"pay_waits": "5 days", "receipt_waits": "3 days"}
    rows = run_to_table(
        pay_receipt_log(spark, sf),
        "reconcile",
        schema=reconcile(*orders.pays_and_receipts(spark, sf), "tx", "pay_ts", "receipt_ts", **waits).schema,
        writer=lambda path: carried.reconcile_writer(path, "ts", DELAY, sides_of, "tx", "pay_ts", "receipt_ts", _is_side(), **waits),
    )
    return to_table_time(rows.drop("batch"), "pay_ts", "receipt_ts")


def stream_tx_reconcile_first(spark: SparkSession, sf: str) -> DataFrame:
    """One log of both sides: first in, first out for each transaction."""
    log = orders.tx_log(*orders.pays_and_receipts(spark, sf))
    stream = played_back(log, "ts", slice_edges([log.select("ts")]), "tx-log")
    rows = run_to_table(
        stream,
        "reconcile-first",
        schema=orders.first_matches(log).schema,
        writer=lambda path: orders.first_match_writer(path, log, DELAY),
    )
    return to_table_time(rows.drop("batch"), "pay_ts", "receipt_ts")


def stream_click_cap(spark: SparkSession, sf: str) -> DataFrame:
    clicks = events(spark, sf).select("event_id", "ts", "user_id", "event_type")
    folder = work_dir(spark, "click-cap")
    writer = click_cap_writer(folder, ["user_id", "event_type"], "ts", ["ts", "event_id"], 2)
    start(clicks, writer, f"{folder}/checkpoint").awaitTermination()
    rows = read_batches(
        spark,
        f"{folder}/rows",
        StructType.fromDDL(
            "event_id bigint, user_id bigint, event_type string, day string, over boolean"
        ),
    )
    return rows.drop("batch")


def _places_of(spark: SparkSession, sf: str):
    """Adds city and area to the few sums of a batch."""
    return lambda counts: counts.join(places(spark, sf), "user_id")


_RAW = ["day", "user_id", "ads_id"]


def stream_ads_count(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks per day, area, city and ad as fields of one hash per day, updated batch by batch."""
    keys, folder = ["day", "area", "city", "ads_id"], work_dir(spark, "ads-count")
    writer = count_writer(f"{folder}/counts", keys, _RAW, _places_of(spark, sf))
    start(_stream_clicks(spark, sf), writer, f"{folder}/checkpoint").awaitTermination()
    schema = StructType.fromDDL("day string, area string, city string, ads_id bigint, n bigint")
    return count_fields(daily_counts(spark, f"{folder}/counts", schema, keys).read(), "day", ["area", "city", "ads_id"])


def stream_area_top3(spark: SparkSession, sf: str) -> DataFrame:
    """A list per day and area is told when it changes; here the last one of each."""
    folder = work_dir(spark, "area-top3")
    writer = top_list_writer(folder, ["day", "area"], "ads_id", 3, _RAW, _places_of(spark, sf))
    start(_stream_clicks(spark, sf), writer, f"{folder}/checkpoint").awaitTermination()
    schema = StructType.fromDDL("day string, area string, top array<struct<ads_id: bigint, n: bigint>>")
    lists = last_batch(read_batches(spark, f"{folder}/lists", schema), ["day", "area"])
    ranked = lists.select("day", "area", F.posexplode("top").alias("rank", "x"))
    return ranked.select("day", "area", (F.col("rank") + 1).alias("rank"), "x.ads_id", "x.n")


def stream_last_hour(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks per ad and minute are kept up to date; a report takes the minutes of its span."""
    minutes = bounded(
        events(spark, sf).select("ts", item().alias("ads_id")), "ts", market.SPAN
    )
    counts = live.pane_counts(minutes, "ts", "1 minute", "1 minute", ["ads_id"])
    current = last_batch(run_to_table(counts, "last-hour", "update"), ["ads_id", "pane_start"])
    as_of = market.report_time(current, "pane_start")
    lists = last_span_by_minute(current, "pane_start", "ads_id", as_of, market.SPAN, "n")
    return minutes_json(lists, "ads_id")


def stream_blacklist(spark: SparkSession, sf: str) -> DataFrame:
    """SQL over the running counts of a batch's days. Users over the threshold join the day's set once, however many
    ads brought them there.
    """
    folder = work_dir(spark, "blacklist")
    add = day_set_writer(f"{folder}/set", ["day", "user_id"])
    count = count_writer(f"{folder}/clicks", _RAW)

    def write(df: DataFrame, batch_id: int) -> None:
        count(df, batch_id)
        schema = StructType.fromDDL("day string, user_id bigint, ads_id bigint, n bigint")
        table = daily_counts(df.sparkSession, f"{folder}/clicks", schema, _RAW)
        counts = table.read(table.days_of(df))
        over = df.sparkSession.sql("SELECT day, user_id FROM {counts} WHERE n >= {least}", counts=counts, least=THRESHOLD)
        add(over, batch_id)

    start(_stream_clicks(spark, sf), several_passes(write), f"{folder}/checkpoint").awaitTermination()
    return read_batches(spark, f"{folder}/set/new", StructType.fromDDL("day string, user_id bigint")).drop("batch")


def stream_latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    """The latest reading per user and day is kept; the latest of all days is asked for."""
    folder = work_dir(spark, "latest")
    readings = events(spark, sf).select("user_id", "ts", "event_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    writer = day_upsert_writer(f"{folder}/rows", ["user_id"], ["ts", "event_id"])
    start(readings, writer, f"{folder}/checkpoint").awaitTermination()
    kept = day_upserts(spark, f"{folder}/rows", readings.schema, ["user_id"], ["ts", "event_id"]).read()
    return to_table_time(latest_per_key(kept.drop("day"), ["user_id"], ["ts", "event_id"]), "ts")


def stream_uv_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_dir(spark, "uv-bitmap")
    start(view_events(spark, sf), bitmap_writer(f"{folder}/bits", "ts", "user_id"), f"{folder}/checkpoint").awaitTermination()
    return to_table_time(bitmap_counts(bitmap_table(spark, f"{folder}/bits").read()), "window_end")


def stream_window_10m_3m(spark: SparkSession, sf: str) -> DataFrame:
    """Complete mode: every batch gives the whole result, and the last one stands."""
    words_ = events(spark, sf).select("ts", F.col("event_type").alias("word"))
    counts = words_.groupBy(F.window("ts", "10 minutes", "3 minutes").alias("w"), "word").agg(F.count("*").alias("n"))
    counts = counts.select("word", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n")
    rows = run_to_table(counts, "complete", "complete", writer=replacing_writer)
    newest = rows.agg(F.max("batch")).first()[0]
    return to_table_time(rows.where(F.col("batch") == F.lit(newest)).drop("batch"), "window_start", "window_end")


def stream_late_split(spark: SparkSession, sf: str) -> DataFrame:
    """The log in four equal spans of arrival time, a span to a batch; see `late_split` for the readings."""
    arrivals = sensors.arrivals(spark, sf)
    low, high = (int(x) if x is not None else 0 for x in arrivals.agg(F.min(epoch_us("arrived")), F.max(epoch_us("arrived"))).first())
    epoch = datetime.datetime(1970, 1, 1)
    edges = [epoch + datetime.timedelta(microseconds=low + (high - low) * i // 4) for i in (1, 2, 3)]
    folder = work_dir(spark, "late-split")
    writer = late_writer(folder, "ts", "1 hour", "10 minutes", "1 minute", "10 minutes")
    start(played_back(arrivals, "arrived", edges, "arrivals"), writer, f"{folder}/checkpoint").awaitTermination()
    parts = [read_batches(spark, f"{folder}/{name}", arrivals.schema).select("event_id", F.lit(name == "late").alias("late")) for name in ("main", "late")]
    return parts[0].unionByName(parts[1])


def _stream_clicks(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select(
        "user_id", item().alias("ads_id"), F.date_format("ts", "yyyy-MM-dd").alias("day")
    )


QUERIES = {
    "stream_word_count": stream_word_count,
    "stream_batch_word_count": stream_batch_word_count,
    "stream_text_file_words": stream_text_file_words,
    "stream_windowed_word_count": stream_windowed_word_count,
    "stream_page_view": stream_page_view,
    "stream_hot_items": stream_hot_items,
    "stream_hot_urls": stream_hot_urls,
    "stream_uv": stream_uv,
    "stream_sensor_minby": stream_sensor_minby,
    "stream_temp_jump": stream_temp_jump,
    "stream_order_pay": stream_order_pay,
    "stream_interval_join": stream_interval_join,
    "stream_window_join": stream_window_join,
    "stream_tx_reconcile": stream_tx_reconcile,
    "stream_tx_reconcile_first": stream_tx_reconcile_first,
    "stream_click_cap": stream_click_cap,
    "stream_ads_count": stream_ads_count,
    "stream_area_top3": stream_area_top3,
    "stream_last_hour": stream_last_hour,
    "stream_blacklist": stream_blacklist,
    "stream_latest_per_key": stream_latest_per_key,
    "stream_uv_bitmap": stream_uv_bitmap,
    "stream_window_10m_3m": stream_window_10m_3m,
    "stream_late_split": stream_late_split,
}

_LAST_VIEW = "(SELECT max(ts) FROM events WHERE event_type = 'view')"
_HOUR = "time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') + INTERVAL '1 hour'"
_VIEW_MARK = f"window_end <= {_LAST_VIEW}"

SQL = {
    "stream_word_count": WORD_COUNT_SQL,
    "stream_batch_word_count": """
    WITH last AS (SELECT max(doc_id) + 1 AS n FROM documents)
    SELECT batch, word, count(*) AS n FROM (
      SELECT CASE WHEN doc_id >= n * 3 // 4 THEN CAST(3 AS BIGINT) WHEN doc_id >= n * 2 // 4 THEN 2
                  WHEN doc_id >= n // 4 THEN 1 ELSE 0 END AS batch,
             unnest(string_split(text, ' ')) AS word
      FROM documents, last)
    WHERE word <> '' GROUP BY batch, word""",
    "stream_text_file_words": """
    SELECT word, count(*) AS n FROM (
      SELECT unnest([event_type, 'user' || (user_id % 3)]) AS word FROM events WHERE event_id % 50 <> 0) GROUP BY word""",
    "stream_windowed_word_count": f"""
    SELECT * FROM ({sliding_sql(TIMED_WORDS_SQL, "word", "10 minutes", "2 minutes")})
    WHERE window_end <= (SELECT date_trunc('second', max(ts)) FROM events) - INTERVAL '2 minutes'""",
    "stream_page_view": f"""
    SELECT * FROM (SELECT {_HOUR} AS window_end, count(*) AS n FROM events
                   WHERE event_type = 'view' GROUP BY 1) WHERE {_VIEW_MARK}""",
    "stream_uv": f"""
    SELECT {_HOUR} AS window_end, count(DISTINCT user_id) AS n FROM events
    WHERE event_type = 'view' GROUP BY 1""",
    "stream_hot_items": f"SELECT * FROM ({traffic.SQL['hot_items']}) WHERE {_VIEW_MARK}",
    "stream_interval_join": orders.SQL["interval_join"],
    "stream_hot_urls": top_sql(HOT_URL_COUNTS, "url", 5),
    "stream_order_pay": """
    WITH mark AS (
      SELECT greatest((SELECT max(o_orderdate) FROM orders),
                      (SELECT max(l_shipdate) FROM lineitem)) - INTERVAL '1 hour' AS mark_at),
    spans AS (  -- a create keeps its session open for 490 days, a pay does not
      SELECT *, ts + CASE kind WHEN 0 THEN INTERVAL '490 days' ELSE INTERVAL '0 days' END AS until
      FROM (SELECT o_orderkey AS order_id, o_orderdate AS ts, 0 AS kind FROM orders
            UNION ALL SELECT l_orderkey, l_shipdate, 1 FROM lineitem)),
    marked AS (
      SELECT *, CASE WHEN ts > max(until) OVER (PARTITION BY order_id ORDER BY ts, kind
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                     THEN 1 ELSE 0 END AS fresh
      FROM spans),
    numbered AS (
      SELECT *, sum(fresh) OVER (PARTITION BY order_id ORDER BY ts, kind
                                 ROWS UNBOUNDED PRECEDING) AS session
      FROM marked),
    seq AS (
      SELECT *, lag(kind) OVER w AS prev_kind, lag(ts) OVER w AS prev_ts,
             lead(kind) OVER w AS next_kind, lead(ts) OVER w AS next_ts,
             max(until) OVER (PARTITION BY order_id, session) AS session_end
      FROM numbered
      WINDOW w AS (PARTITION BY order_id ORDER BY ts, kind)),
    outcomes AS (
      SELECT order_id, CASE
               WHEN kind = 1 AND prev_kind = 0 AND ts - prev_ts < INTERVAL '90 days'
                 THEN 'payed successfully'
               WHEN kind = 1 AND prev_kind = 0 AND ts - prev_ts <= INTERVAL '490 days'
                 THEN 'payed but already timeout'
               WHEN kind = 1 THEN 'already payed but not found created log'
               WHEN next_kind = 0 AND next_ts - ts >= INTERVAL '90 days' THEN 'order timeout'
               WHEN next_kind = 1 AND next_ts - ts > INTERVAL '490 days' THEN 'order timeout'
               WHEN next_kind IS NULL THEN 'order timeout'
             END AS result_msg
      FROM seq WHERE session_end < (SELECT mark_at FROM mark))
    SELECT order_id,
           CASE result_msg WHEN 'payed successfully' THEN 'main' ELSE 'side' END AS channel,
           result_msg
    FROM outcomes WHERE result_msg IS NOT NULL""",
    "stream_sensor_minby": f"""
    SELECT CAST(replace(id, 'sensor_', '') AS BIGINT) AS user_id, window_end, temperature, ts,
           event_id
    FROM ({sensors.SQL["sensor_window_minby"]})
    WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '1 second'""",
    "stream_temp_jump": f"""
    SELECT CAST(replace(id, 'sensor_', '') AS BIGINT) AS user_id, ts, last_temperature, temperature,
           msg
    FROM ({sensors.SQL["temp_jump"]})
    WHERE ts <= (SELECT max(ts) FROM events) - INTERVAL '1 hour'""",
    "stream_window_join": orders.SQL["window_join"],
    "stream_last_hour": market.SQL["last_hour_json"],
    "stream_tx_reconcile": f"""
    WITH mark AS (
      SELECT least((SELECT max(o_orderdate) FROM orders),
                   (SELECT max(l_shipdate) FROM lineitem)) - INTERVAL '1 hour' AS mark_at)
    SELECT * FROM ({orders.SQL["tx_reconcile"]})
    WHERE channel = 'matched'
       OR pay_ts + INTERVAL '5 days' < (SELECT mark_at FROM mark)
       OR receipt_ts + INTERVAL '3 days' < (SELECT mark_at FROM mark)""",
    "stream_tx_reconcile_first": f"""
    SELECT * FROM ({orders.SQL["tx_reconcile_first"]}) r
    WHERE (SELECT max(until) FROM ({orders.TX_SESSIONS}) s
           WHERE s.tx = r.tx AND coalesce(pay_ts, receipt_ts) BETWEEN s.since AND s.until)
          < (SELECT greatest((SELECT max(o_orderdate) FROM orders), (SELECT max(l_shipdate) FROM lineitem)) - INTERVAL '1 hour')""",
    "stream_click_cap": market.SQL["ad_click_cap"],
    "stream_ads_count": market.SQL["ads_count_map"],
    "stream_area_top3": market.SQL["area_top3_ads"],
    "stream_blacklist": f"SELECT DISTINCT * FROM ({market.SQL['blacklist_build']})",
    "stream_latest_per_key": market.SQL["latest_per_key"],
    "stream_uv_bitmap": traffic.SQL["uv_bitmap"],
    "stream_window_10m_3m": wordcounts.SQL["window_10m_3m"],
    "stream_late_split": """
    WITH arrivals AS (
      SELECT event_id, epoch_us(ts) AS us,
             ts - CASE WHEN event_id % 10 = 0
                       THEN CAST(json_extract_string(props, '$.k') AS BIGINT) * 216 ELSE 0 END
                  * INTERVAL '1 second' AS ts
      FROM events),
    ends AS (SELECT min(us) AS low, max(us) - min(us) AS span FROM arrivals),
    placed AS (
      SELECT event_id, ts, CASE WHEN us >= low + span * 3 // 4 THEN 3 WHEN us >= low + span * 2 // 4 THEN 2
                                WHEN us >= low + span // 4 THEN 1 ELSE 0 END AS batch
      FROM arrivals, ends),
    marks AS (
      SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
      FROM placed GROUP BY batch)
    SELECT event_id,
           coalesce(time_bucket(INTERVAL '10 minutes', ts, TIMESTAMP '1970-01-01') + INTERVAL '1 hour' + INTERVAL '10 minutes'
                    <= before - INTERVAL '1 minute', false) AS late
    FROM placed JOIN marks USING (batch)""",
}
