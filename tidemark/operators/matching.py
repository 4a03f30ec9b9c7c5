"""Two-stream matching on a key and event time: window join, interval join, reconciliation.

The interval join also joins on a time bucket at least as wide as the interval, so a hot key is
spread over its buckets instead of meeting all of its rows in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.eventtime import epoch_us, interval_text, micros, step_index


def window_join(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, size: str
) -> DataFrame:
    """All pairs with equal `key` in the same tumbling window; adds window_start and window_end."""
    a = left.withColumn("_window", F.window(left_ts, size))
    b = right.withColumn("_window", F.window(right_ts, size))
    if left.isStreaming or right.isStreaming:  # the window alone carries the watermark
        a = a.withColumn(left_ts, F.col(left_ts) + F.expr("interval 0 seconds"))
        b = b.withColumn(right_ts, F.col(right_ts) + F.expr("interval 0 seconds"))
    return a.join(b, [key, "_window"]).select(
        *left.columns,
        *[c for c in right.columns if c != key],
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
    )


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    lower: str,
    upper: str,
    how: str = "inner",
    bucket: str | None = None,
) -> DataFrame:
    """Pairs with right_ts in [left_ts + lower, left_ts + upper], both ends included.

    `how`: inner, left_outer or full_outer. The result has `key` once (of whichever side exists) and
    all other columns of both sides. Streams need a watermark on both time columns.
    """
    if how not in ("inner", "left_outer", "full_outer"):
        raise ValueError(f"unsupported join type: {how}")
    low, high = micros(lower), micros(upper)
    if left.isStreaming or right.isStreaming:
        return _stream_interval_join(left, right, key, left_ts, right_ts, lower, upper, how)
    width = max(high - low, 1) * 4 if bucket is None else max(micros(bucket), high - low, 1)
    l_us, r_us = epoch_us(left_ts), epoch_us(right_ts)
    others = [c for c in right.columns if c != key]
    gap = epoch_us(right_ts) - epoch_us(left_ts)
    near = (gap >= low) & (gap <= high)

    l_once = left.withColumn("_bucket", step_index(l_us, width))
    r_copies = (
        right.withColumn(
            "_bucket",
            F.explode(F.sequence(step_index(r_us - high, width), step_index(r_us - low, width))),
        )
        .withColumnRenamed(key, "_key")
        .withColumnRenamed("_bucket", "_rbucket")
    )
    same = (F.col(key) == F.col("_key")) & (F.col("_bucket") == F.col("_rbucket")) & near
    pairs = l_once.join(r_copies, same, "left_outer" if how == "full_outer" else how).select(
        *left.columns, *others
    )
    if how != "full_outer":
        return pairs
    r_once = right.withColumn("_bucket", step_index(r_us, width))
    l_copies = left.select(
        F.col(key).alias("_key"),
        left_ts,
        F.explode(
            F.sequence(step_index(l_us + low, width), step_index(l_us + high, width))
        ).alias("_rbucket"),
    )
    lonely = r_once.join(l_copies, same, "left_anti").select(*right.columns)
    return pairs.unionByName(lonely, allowMissingColumns=True)


def _stream_interval_join(left, right, key, left_ts, right_ts, lower, upper, how):
    other = right.withColumnRenamed(key, "_key")
    on = (
        (F.col(key) == F.col("_key"))
        & (F.col(right_ts) >= F.col(left_ts) + F.expr(f"interval {lower}"))
        & (F.col(right_ts) <= F.col(left_ts) + F.expr(f"interval {upper}"))
    )
    joined = left.join(other, on, how)
    return joined.select(
        F.coalesce(key, "_key").alias(key),
        *[c for c in left.columns if c != key],
        *[c for c in right.columns if c != key],
    )


CHANNELS = ("matched", "unmatched_pay", "unmatched_receipt")


def reconcile(
    pays: DataFrame,
    receipts: DataFrame,
    key: str,
    pay_ts: str,
    receipt_ts: str,
    pay_waits: str = "5 seconds",
    receipt_waits: str = "3 seconds",
) -> DataFrame:
    """Pays against receipts with unequal waits; `channel` tells matched from one-sided rows.

    All pairs within the waits are kept, also where a key has several pays or receipts.
    """
    # a side is told by its marker: a row without a time is still a pay or a receipt
    joined = interval_join(
        pays.withColumn("_pay", F.lit(True)),
        receipts.withColumn("_receipt", F.lit(True)),
        key,
        pay_ts,
        receipt_ts,
        f"-{receipt_waits}",
        pay_waits,
        "full_outer",
    )
    channel = (
        F.when(F.col("_receipt").isNull(), CHANNELS[1])
        .when(F.col("_pay").isNull(), CHANNELS[2])
        .otherwise(CHANNELS[0])
    )
    return joined.withColumn("channel", channel).drop("_pay", "_receipt")


def reconciled(pays, receipts, key, pay_ts, receipt_ts, **waits) -> dict[str, DataFrame]:
    """The three outputs of `reconcile` by name."""
    rows = reconcile(pays, receipts, key, pay_ts, receipt_ts, **waits)
    return {c: rows.where(F.col("channel") == c).drop("channel") for c in CHANNELS}


def reconcile_first(
    log: DataFrame, key: str, ts: str, side: str, row: str, pay_waits: str = "5 seconds", receipt_waits: str = "3 seconds"
) -> DataFrame:
    """One-to-one matching, first in, first out: `key`, `pay`, `receipt` (their `row`, null where missing), `channel`.

    `log` holds both sides, `side` telling "pay" from "receipt". In event-time order each row takes the oldest row of
    the other side that still waits; where there is none it waits itself, a pay for `pay_waits`, a receipt for
    `receipt_waits`, both ends included. Of equal times a pay comes first, then the lesser `row`.

    Rows that can meet are in one session, which each of them keeps open for its wait. A session is matched by
    itself, so a busy key is spread over its sessions, and a stream with a watermark on `ts` drops the state of
    each once it has ended.
    """
    return match_sessions(waiting_sessions(log, key, ts, side, row, pay_waits, receipt_waits), key)


def waiting_sessions(log: DataFrame, key: str, ts: str, side: str, row: str, pay_waits: str, receipt_waits: str) -> DataFrame:
    """The sessions of `reconcile_first`: `_session` (start and end), `key`, `_events` in event-time order."""
    waits = F.when(F.col(side) == "pay", micros(pay_waits)).otherwise(micros(receipt_waits))
    stay = F.when(F.col(side) == "pay", interval_text(micros(pay_waits) + 1)).otherwise(interval_text(micros(receipt_waits) + 1))
    event = F.struct(
        epoch_us(ts).alias("us"), F.when(F.col(side) == "pay", 0).otherwise(1).alias("kind"), F.col(row).alias("row"), (epoch_us(ts) + waits).alias("until")
    )
    return log.groupBy(F.session_window(ts, stay).alias("_session"), key).agg(F.array_sort(F.collect_list(event)).alias("_events"))


def match_sessions(sessions: DataFrame, key: str) -> DataFrame:
    """The result of `reconcile_first` for sessions that have ended. Where all rows are of one side, none meets another."""
    kinds = sessions.schema["_events"].dataType.simpleString()
    pair = kinds.replace("array<", "", 1)[:-1]
    pairs = f"array<struct<a:{pair},b:{pair}>>"

    def alone(rows):
        return F.transform(rows, lambda x: F.struct(x.alias("a"), F.lit(None).cast(pair).alias("b")))

    def step(state, now):
        # all rows in the queue are of one side: one of the other would have taken its oldest
        alive = F.filter(state["queue"], lambda x: x["until"] >= now["us"])
        given_up = alone(F.filter(state["queue"], lambda x: x["until"] < now["us"]))
        met = (F.size(alive) > 0) & (F.get(alive, F.lit(0))["kind"] != now["kind"])
        both = F.array(F.struct(F.get(alive, F.lit(0)).alias("a"), now.alias("b")))
        queue = F.when(met, F.slice(alive, 2, F.greatest(F.size(alive) - 1, F.lit(0)))).otherwise(F.array_append(alive, now))
        done = F.concat(state["done"], given_up, F.when(met, both).otherwise(F.array().cast(pairs)))
        return F.struct(queue.alias("queue"), done.cast(pairs).alias("done"))

    start = F.struct(F.array().cast(kinds).alias("queue"), F.array().cast(pairs).alias("done"))
    events = F.col("_events")
    one_sided = ~F.exists(events, lambda x: x["kind"] != F.get(events, F.lit(0))["kind"])
    queued = F.aggregate(events, start, step, lambda state: F.concat(state["done"], alone(state["queue"])))
    found = sessions.select(key, F.explode(F.when(one_sided, alone(events).cast(pairs)).otherwise(queued)).alias("_x"))
    first_is_pay = F.col("_x.a.kind") == 0
    return found.select(
        key,
        F.when(first_is_pay, F.col("_x.a.row")).otherwise(F.col("_x.b.row")).alias("pay"),
        F.when(first_is_pay, F.col("_x.b.row")).otherwise(F.col("_x.a.row")).alias("receipt"),
        F.when(F.col("_x.b").isNotNull(), CHANNELS[0]).when(first_is_pay, CHANNELS[1]).otherwise(CHANNELS[2]).alias("channel"),
    )
