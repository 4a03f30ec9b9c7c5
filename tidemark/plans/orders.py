"""Order payment: create = order date, pay = an order's first ship date; lines play receipts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.matching import interval_join as within_interval
from tidemark.operators.matching import reconcile, reconcile_first
from tidemark.operators.matching import window_join as same_window
from tidemark.operators.patterns import order_states, order_timeouts, unpaid_orders
from tidemark.plans.common import ORDER_CHUNK
from tidemark.sinks.keyed import BatchWriter
from tidemark.sources.tables import table
from tidemark.streaming import carried


def order_events(spark: SparkSession, sf: str) -> DataFrame:
    """order_id, event_type, ts: one create per order, one pay per order that has lines."""
    creates = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.lit("create").alias("event_type"),
        F.col("o_orderdate").alias("ts"),
    )
    pays = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(F.min("l_shipdate").alias("ts"))
        .select("order_id", F.lit("pay").alias("event_type"), "ts")
    )
    return creates.unionByName(pays)


def order_timeout_cep(spark: SparkSession, sf: str) -> DataFrame:
    return order_timeouts(
        order_events(spark, sf), "order_id", "ts", "event_type", within="90 days", chunk=ORDER_CHUNK
    )


def order_pay_match(spark: SparkSession, sf: str) -> DataFrame:
    return order_states(order_events(spark, sf), "order_id", "ts", "event_type", "90 days", ORDER_CHUNK)


def order_timeout_only(spark: SparkSession, sf: str) -> DataFrame:
    return unpaid_orders(order_events(spark, sf), "order_id", "ts", "event_type", "90 days")


def pays_and_receipts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    pays = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("tx"), F.col("o_orderdate").alias("pay_ts"), "o_custkey"
    )
    receipts = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("tx"), F.col("l_shipdate").alias("receipt_ts"), "l_suppkey"
    )
    return pays, receipts


def interval_join(spark: SparkSession, sf: str) -> DataFrame:
    pays, receipts = pays_and_receipts(spark, sf)
    return within_interval(pays, receipts, "tx", "pay_ts", "receipt_ts", "-15 days", "20 days")


def interval_join_left(spark: SparkSession, sf: str) -> DataFrame:
    pays, receipts = pays_and_receipts(spark, sf)
    return within_interval(
        pays, receipts, "tx", "pay_ts", "receipt_ts", "-15 days", "20 days", "left_outer"
    )


def window_join(spark: SparkSession, sf: str) -> DataFrame:
    pays, receipts = pays_and_receipts(spark, sf)
    return same_window(pays, receipts, "tx", "pay_ts", "receipt_ts", "15 days")


def tx_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    pays, receipts = pays_and_receipts(spark, sf)
    return reconcile(
        pays,
        receipts,
        "tx",
        "pay_ts",
        "receipt_ts",
        pay_waits="5 days",
        receipt_waits="3 days",
    )


def tx_log(pays: DataFrame, receipts: DataFrame) -> DataFrame:
    """Both sides in one log: tx, ts, side, row (time and the other party)."""
    parts = [
        df.select("tx", F.col(ts).alias("ts"), F.lit(side).alias("side"), F.struct(F.col(ts).alias("ts"), F.col(party).alias("party")).alias("row"))
        for df, ts, side, party in ((pays, "pay_ts", "pay", "o_custkey"), (receipts, "receipt_ts", "receipt", "l_suppkey"))
    ]
    return parts[0].unionByName(parts[1])


FIRST_WAITS = {"pay_waits": "5 days", "receipt_waits": "3 days"}


def first_matches(log: DataFrame) -> DataFrame:
    return _flat(reconcile_first(log, "tx", "ts", "side", "row", **FIRST_WAITS))


def first_match_writer(path: str, log: DataFrame, delay: str) -> BatchWriter:
    """The same for a stream of the columns of `log`."""
    return carried.first_match_writer(path, log, delay, "tx", "ts", "side", "row", flat=_flat, **FIRST_WAITS)


def _flat(found: DataFrame) -> DataFrame:
    return found.select(
        "tx", F.col("pay.ts").alias("pay_ts"), F.col("pay.party").alias("o_custkey"),
        F.col("receipt.ts").alias("receipt_ts"), F.col("receipt.party").alias("l_suppkey"), "channel",
    )


def tx_reconcile_first(spark: SparkSession, sf: str) -> DataFrame:
    return first_matches(tx_log(*pays_and_receipts(spark, sf)))


QUERIES = {
    "tx_reconcile_first": tx_reconcile_first,
    "order_timeout_cep": order_timeout_cep,
    "order_pay_match": order_pay_match,
    "order_timeout_only": order_timeout_only,
    "interval_join": interval_join,
    "interval_join_left": interval_join_left,
    "window_join": window_join,
    "tx_reconcile": tx_reconcile,
}

_PAYS = "(SELECT o_orderkey AS tx, o_orderdate AS pay_ts, o_custkey FROM orders)"
_RECEIPTS = "(SELECT l_orderkey AS tx, l_shipdate AS receipt_ts, l_suppkey FROM lineitem)"
_PAIRS = """(SELECT o_orderkey, o_orderdate, pay_ts
             FROM orders LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS pay_ts
                                    FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)"""
_ORPHANS = """(SELECT DISTINCT l_orderkey FROM lineitem
               WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))"""
_NEAR = """p.tx = r.tx AND r.receipt_ts BETWEEN p.pay_ts - INTERVAL '{low}'
           AND p.pay_ts + INTERVAL '{high}'"""
_FIELDS = "p.tx, pay_ts, o_custkey, receipt_ts, l_suppkey"


# A transaction has one pay, which takes the first receipt in reach; of equal receipts one.
_FIRST = f"""
    SELECT tx, pay_ts, o_custkey, receipt_ts, l_suppkey, id FROM (
      SELECT p.*, receipt_ts, l_suppkey, id, row_number() OVER (PARTITION BY p.tx ORDER BY receipt_ts, l_suppkey, id) AS place
      FROM {_PAYS} p JOIN numbered r
      ON {_NEAR.format(low="3 days", high="5 days")}) WHERE place = 1"""

# Runs of a transaction's rows, each within the wait of one before it.
TX_SESSIONS = """
    SELECT tx, min(ts) AS since, max(until) AS until FROM (
      SELECT *, sum(fresh) OVER (PARTITION BY tx ORDER BY ts RANGE UNBOUNDED PRECEDING) AS session FROM (
        SELECT *, CASE WHEN ts > max(until) OVER (PARTITION BY tx ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                       THEN 1 ELSE 0 END AS fresh FROM (
          SELECT o_orderkey AS tx, o_orderdate AS ts, 0 AS side, o_orderdate + INTERVAL '5 days' AS until FROM orders
          UNION ALL SELECT l_orderkey, l_shipdate, 1, l_shipdate + INTERVAL '3 days' FROM lineitem)))
    GROUP BY tx, session"""


def bucket(column: str) -> str:
    return f"time_bucket(INTERVAL '15 days', {column}, TIMESTAMP '1970-01-01')"


SQL = {
    "order_timeout_cep": f"""
    SELECT o_orderkey AS order_id, o_orderdate AS create_ts,
           CASE WHEN ok THEN pay_ts END AS pay_ts,
           CASE WHEN ok THEN 'payed successfully' ELSE 'time out' END AS result_msg
    FROM (SELECT *, coalesce(pay_ts >= o_orderdate
                             AND pay_ts - o_orderdate < INTERVAL '90 days', false) AS ok
          FROM {_PAIRS})""",
    "order_pay_match": f"""
    WITH outcomes AS (
      SELECT o_orderkey AS order_id,
             CASE WHEN pay_ts IS NULL OR pay_ts < o_orderdate THEN 'order timeout'
                  WHEN pay_ts - o_orderdate < INTERVAL '90 days' THEN 'payed successfully'
                  ELSE 'payed but already timeout' END AS result_msg
      FROM {_PAIRS}
      UNION ALL
      SELECT o_orderkey, 'already payed but not found created log'
      FROM {_PAIRS} WHERE pay_ts < o_orderdate
      UNION ALL
      SELECT l_orderkey, 'already payed but not found created log' FROM {_ORPHANS})
    SELECT order_id,
           CASE result_msg WHEN 'payed successfully' THEN 'main' ELSE 'side' END AS channel,
           result_msg
    FROM outcomes""",
    "order_timeout_only": f"""
    SELECT o_orderkey AS order_id, o_orderdate AS create_ts, 'order timeout' AS result_msg
    FROM {_PAIRS} WHERE pay_ts IS NULL OR pay_ts > o_orderdate + INTERVAL '90 days'""",
    "interval_join": f"""
    SELECT {_FIELDS} FROM {_PAYS} p JOIN {_RECEIPTS} r
    ON {_NEAR.format(low="15 days", high="20 days")}""",
    "interval_join_left": f"""
    SELECT {_FIELDS} FROM {_PAYS} p LEFT JOIN {_RECEIPTS} r
    ON {_NEAR.format(low="15 days", high="20 days")}""",
    "window_join": f"""
    SELECT {_FIELDS}, {bucket("pay_ts")} AS window_start,
           {bucket("pay_ts")} + INTERVAL '15 days' AS window_end
    FROM {_PAYS} p JOIN {_RECEIPTS} r
    ON p.tx = r.tx AND {bucket("pay_ts")} = {bucket("receipt_ts")}""",
    "tx_reconcile": f"""
    SELECT coalesce(p.tx, r.tx) AS tx, pay_ts, o_custkey, receipt_ts, l_suppkey,
           CASE WHEN r.tx IS NULL THEN 'unmatched_pay' WHEN p.tx IS NULL THEN 'unmatched_receipt'
                ELSE 'matched' END AS channel
    FROM {_PAYS} p FULL JOIN {_RECEIPTS} r ON {_NEAR.format(low="3 days", high="5 days")}""",
    "tx_reconcile_first": f"""
    WITH numbered AS (
      SELECT *, row_number() OVER (PARTITION BY tx ORDER BY receipt_ts, l_suppkey) AS id FROM {_RECEIPTS}),
    first AS ({_FIRST})
    SELECT tx, pay_ts, o_custkey, receipt_ts, l_suppkey, 'matched' AS channel FROM first
    UNION ALL
    SELECT o_orderkey, o_orderdate, o_custkey, NULL, NULL, 'unmatched_pay' FROM orders WHERE o_orderkey NOT IN (SELECT tx FROM first)
    UNION ALL
    SELECT tx, NULL, NULL, receipt_ts, l_suppkey, 'unmatched_receipt' FROM numbered l
    WHERE NOT EXISTS (SELECT 1 FROM first f WHERE f.tx = l.tx AND f.id = l.id)""",
}
