"""Keyed event patterns in event-time order: adjacency, first follower, order states, click caps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.eventtime import epoch_us, micros
from tidemark.operators.ranking import top_per_group
from tidemark.operators.sequences import neighbours, with_context

# The result messages of the order patterns.
PAID = "payed successfully"
LATE = "payed but already timeout"
NO_CREATE = "already payed but not found created log"
TIMEOUT = "order timeout"
PATTERN_TIMEOUT = "time out"


def match_next(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    order: Sequence[str],
    steps: Sequence[tuple[str, Column]],
    within: str,
    fields: Sequence[str] = (),
    chunk: str = "1 hour",
) -> DataFrame:
    """Strictly adjacent events of a key that fulfil `steps` in turn, less than `within` apart.

    `steps` are (name, condition); the result has `keys` and <name>_<field> for `ts` and `fields`.
    """
    taken = list(dict.fromkeys([ts, *fields]))
    flags = {f"_is_{name}": F.coalesce(cond, F.lit(False)) for name, cond in steps}
    near = with_context(df.withColumns(flags), ts, within, chunk)
    in_order = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    columns, hit = {}, F.col("_home")
    for i, (name, _) in enumerate(steps):
        flag = F.col(f"_is_{name}")
        hit = hit & (flag if i == 0 else F.lead(flag, i).over(in_order))
        for field in taken:
            value = F.col(field) if i == 0 else F.lead(field, i).over(in_order)
            columns[f"{name}_{field}"] = value
    first, last = steps[0][0], steps[-1][0]
    gap = epoch_us(f"{last}_{ts}") - epoch_us(f"{first}_{ts}")
    return (
        near.withColumns(columns)
        .withColumn("_hit", hit)
        .where(F.col("_hit") & (gap < micros(within)))
        .select(*keys, *columns)
    )


def failed_pairs(
    logins: DataFrame,
    user: str,
    ts: str,
    order: Sequence[str],
    failed: Column,
    within: str = "5 seconds",
    chunk: str = "1 hour",
) -> DataFrame:
    """Two consecutive failures of a user less than `within` apart; a success in between resets."""
    pairs = match_next(
        logins, [user], ts, order, [("first", failed), ("last", failed)], within, chunk=chunk
    )
    return pairs.select(
        user,
        F.col(f"first_{ts}").alias("first_fail_time"),
        F.col(f"last_{ts}").alias("last_fail_time"),
        F.lit(f"login fail in {within}").alias("warning_msg"),
    )


def followed_by(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    begin: Column,
    then: Column,
    within: str,
    chunk: str = "1 day",
) -> DataFrame:
    """Each `begin` event with the first `then` event at the same time or later, in less than
    `within`; `then_ts` is null where none came. Other events in between do not matter.
    """
    rows = df.withColumns(
        {
            "_begin": F.coalesce(begin, F.lit(False)),
            "_then": F.coalesce(then, F.lit(False)),
        }
    ).where("_begin or _then")
    near = with_context(rows, ts, within, chunk, only=F.col("_then"))
    backwards = (
        Window.partitionBy(*keys, "_chunk")
        .orderBy(F.col(ts).desc(), F.col("_then").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    follower = F.last(F.when(F.col("_then"), F.col(ts)), ignorenulls=True).over(backwards)
    gap = epoch_us("_follower") - epoch_us(ts)
    return (
        near.withColumn("_follower", follower)
        .where("_home and _begin")
        .withColumn("then_ts", F.when(gap < micros(within), F.col("_follower")))
        .drop("_begin", "_then", "_follower", "_chunk", "_home")
    )


def order_timeouts(
    orders: DataFrame,
    order_id: str,
    ts: str,
    event_type: str,
    paid: Column | None = None,
    within: str = "15 minutes",
    chunk: str = "1 day",
) -> DataFrame:
    """One row per create event: "payed successfully", or "time out" when no pay came in time."""
    kind = F.col(event_type)
    pay = kind == "pay" if paid is None else (kind == "pay") & paid
    matched = followed_by(orders, [order_id], ts, kind == "create", pay, within, chunk)
    message = F.when(F.col("then_ts").isNotNull(), PAID).otherwise(PATTERN_TIMEOUT)
    return matched.select(
        order_id,
        F.col(ts).alias("create_ts"),
        F.col("then_ts").alias("pay_ts"),
        message.alias("result_msg"),
    )


def order_states(
    orders: DataFrame,
    order_id: str,
    ts: str,
    event_type: str,
    limit: str = "15 minutes",
    chunk: str = "1 day",
) -> DataFrame:
    """Order/pay state machine: order_id, channel ("main" | "side"), result_msg.

    A create waits for the next event of its order. A pay closes it: in time, or late when the gap
    reaches `limit`. Equal times count as paid. A pay without an open create and a create that is
    never closed go to the side channel; a create within `limit` of an older open one replaces it.
    """
    kind = F.col(event_type)
    relevant = orders.where(kind.isin("create", "pay")).select(
        order_id, ts, F.when(kind == "pay", 1).otherwise(0).alias("_kind")
    )
    seen = neighbours(
        relevant, [order_id], ts, [ts, "_kind"], [ts, "_kind"], chunk, ("prev", "next")
    )
    since = epoch_us(ts) - epoch_us(f"prev_{ts}")
    until = epoch_us(f"next_{ts}") - epoch_us(ts)
    is_pay = F.col("_kind") == 1
    outcome = (
        F.when(
            is_pay & (F.col("prev__kind") == 0),
            F.when(since < micros(limit), PAID).otherwise(LATE),
        )
        .when(is_pay, NO_CREATE)
        .when(F.col("next__kind").isNull(), TIMEOUT)
        .when((F.col("next__kind") == 0) & (until >= micros(limit)), TIMEOUT)
    )
    channel = F.when(F.col("result_msg") == PAID, "main").otherwise("side")
    return (
        seen.select(order_id, outcome.alias("result_msg"))
        .where("result_msg is not null")
        .select(order_id, channel.alias("channel"), "result_msg")
    )


def unpaid_orders(
    orders: DataFrame, order_id: str, ts: str, event_type: str, limit: str = "15 minutes"
) -> DataFrame:
    """Create events without any pay up to `limit` later: order_id, create_ts, result_msg."""
    kind = F.col(event_type)
    creates = orders.where(kind == "create").select(order_id, F.col(ts).alias("create_ts"))
    first_pay = (
        orders.where(kind == "pay").groupBy(order_id).agg(F.min(ts).alias("_first_pay"))
    )
    in_time = epoch_us("_first_pay") - epoch_us("create_ts") <= micros(limit)
    pays = first_pay.withColumnRenamed(order_id, "_order")
    return creates.join(
        pays, (F.col(order_id) == F.col("_order")) & in_time, "left_anti"
    ).withColumn("result_msg", F.lit(TIMEOUT))


def click_cap(
    clicks: DataFrame,
    keys: Sequence[str],
    ts: str,
    order: Sequence[str],
    cap: int = 100,
) -> DataFrame:
    """First `cap` clicks per key and calendar day, and the one after as a warning.

    Adds `day` and `over` (true on the warning row); all later clicks are dropped. Each task keeps
    at most cap + 1 rows of a key and day before the shuffle.
    """
    daily = clicks.withColumn("day", F.date_format(ts, "yyyy-MM-dd"))
    ranked = top_per_group(daily, [*keys, "day"], [F.col(c) for c in order], cap + 1, "_rank")
    return ranked.withColumn("over", F.col("_rank") > cap).drop("_rank")


def capped_clicks(clicks: DataFrame, keys, ts, order, cap: int = 100) -> dict[str, DataFrame]:
    """`main`: clicks within the cap. `blacklist`: one warning per key and day over it."""
    marked = click_cap(clicks, keys, ts, order, cap)
    return {
        "main": marked.where("not over").drop("over"),
        "blacklist": marked.where("over").select(
            *keys, "day", F.lit(f"Click over {cap} times today").alias("msg")
        ),
    }
