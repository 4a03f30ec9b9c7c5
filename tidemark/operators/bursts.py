"""Bursts of failures: several within a short time of the first, with no success in between.

A burst is anchored at its first failure and lasts `within`; the next burst starts at the first
failure after it, and a success ends it without a warning. So where one burst starts depends on
where the one before ended, and an unbroken run of failures could only be walked from its start.
To walk a hot user's run in parallel, each (user, chunk of time) is solved for every failure that
could be the chunk's first anchor, that is those in its first `within`; a second, small step follows
which of them was the real one from chunk to chunk, and keeps the warnings of those.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.eventtime import epoch_us, from_epoch_us, micros, time_type
from tidemark.operators.sequences import with_context

_NEVER = 2**63 - 1


def failure_bursts(
    logins: DataFrame,
    user: str,
    ts: str,
    order: Sequence[str],
    failed: Column,
    times: int = 2,
    within: str = "2 seconds",
    chunk: str = "1 hour",
) -> DataFrame:
    """user, first_fail_time, last_fail_time, failures, warning_msg: bursts of at least `times`.

    `order` is (ts, an integer id). The end of the time span is included. Rows without a user are one key, as in
    `failed_pairs`; users are numbers or texts.
    """
    if times < 2:
        raise ValueError("a burst has at least two failures")
    reach = micros(within)
    width = max(micros(chunk), reach)
    near = _clustered(logins, user, ts, order[1], failed, within, chunk)
    key = "string"
    solved = near.sortWithinPartitions("_user", "_chunk", "_us", "_id").mapInPandas(
        lambda batches: _solve(batches, reach, width, times),
        f"_user {key}, _chunk bigint, _entry_from bigint, _entry_to bigint, "
        "_at bigint, _at_id bigint, _exit bigint, _exit_id bigint, "
        "_first bigint, _last bigint, failures bigint",
    )
    exits = solved.where("_first is null").select(
        "_user", "_chunk", "_entry_from", "_at", "_at_id", "_exit", "_exit_id"
    )
    entries = (
        exits.repartition("_user")
        .sortWithinPartitions("_user", "_chunk", "_at", "_at_id")
        .mapInPandas(_follow, f"_user {key}, _chunk bigint, _entry bigint")
    )
    warnings = solved.where("_first is not null").join(entries, ["_user", "_chunk"])
    like = time_type(logins, ts)
    return warnings.where("_entry between _entry_from and _entry_to").select(
        F.when(F.col("_user") != "", F.substr("_user", F.lit(2))).cast(logins.schema[user].dataType).alias(user),
        from_epoch_us(F.col("_first"), like).alias("first_fail_time"),
        from_epoch_us(F.col("_last"), like).alias("last_fail_time"),
        "failures",
        F.concat(
            F.lit(f"login fail in {within} for "), F.col("failures").cast("string"), F.lit(" times")
        ).alias("warning_msg"),
    )


def _clustered(logins, user, ts, row_id, failed, within, chunk) -> DataFrame:
    """Failures with another one close by, each with the next success after it.

    A lone failure neither warns nor moves another burst's start. Near a chunk's start the failure
    before may be out of sight, so those are kept.
    """
    reach, width = micros(within), max(micros(chunk), micros(within))
    rows = logins.select(
        # a text for each user, the empty one for rows without a user, who are one key
        F.coalesce(F.concat(F.lit("="), F.col(user).cast("string")), F.lit("")).alias("_user"),
        ts,
        epoch_us(ts).alias("_us"),
        F.col(row_id).cast("long").alias("_id"),
        F.coalesce(failed, F.lit(False)).alias("_failed"),
    )
    near = with_context(rows, ts, within, chunk).drop(ts).repartition("_user", "_chunk")
    by_time = Window.partitionBy("_user", "_chunk").orderBy("_us", "_id")
    later = (
        Window.partitionBy("_user", "_chunk")
        .orderBy(F.col("_us").desc(), F.col("_id").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    success = F.when(~F.col("_failed"), F.struct("_us", "_id"))
    return (
        near.withColumn("_ok", F.last(success, ignorenulls=True).over(later))
        .where("_failed")
        .withColumns(
            {
                "_gap_before": F.col("_us") - F.lag("_us").over(by_time),
                "_gap_after": F.lead("_us").over(by_time) - F.col("_us"),
            }
        )
        .where(
            (F.col("_gap_before") <= reach)
            | (F.col("_gap_after") <= reach)
            | (F.col("_us") - F.col("_chunk") * F.lit(width) <= reach)
        )
        .select(
            "_user",
            "_chunk",
            "_us",
            "_id",
            "_home",
            F.col("_ok._us").alias("_ok_us"),
            F.col("_ok._id").alias("_ok_id"),
        )
    )


def _runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[dict[str, list]]:
    """Columns, as lists, of each run of rows with equal `keys` in sorted batches."""
    rest = None
    for pdf in batches:
        if rest is not None:
            pdf = pd.concat([rest, pdf], ignore_index=True)
        if pdf.empty:
            continue
        fresh = (pdf[keys] != pdf[keys].shift()).any(axis=1).to_numpy()
        starts = [*fresh.nonzero()[0].tolist()]
        rest = pdf.iloc[starts[-1] :]
        columns = {c: pdf[c].tolist() for c in pdf.columns}
        for begin, end in zip(starts, starts[1:]):
            yield {c: values[begin:end] for c, values in columns.items()}
    if rest is not None:
        yield {c: rest[c].tolist() for c in rest.columns}


def _frames(rows: Iterator[tuple], columns: list[str], size: int = 10_000):
    """Rows as frames; all columns but the first (the user) are nullable integers."""
    while part := list(islice(rows, size)):
        numbers = {c: pd.array([row[n] for row in part], "Int64") for n, c in enumerate(columns) if n}
        yield pd.DataFrame({columns[0]: [row[0] for row in part], **numbers})


def _solve(batches, reach: int, width: int, times: int):
    columns = ["_user", "_chunk", "_entry_from", "_entry_to", "_at", "_at_id", "_exit", "_exit_id"]
    columns += ["_first", "_last", "failures"]
    runs = _runs(batches, ["_user", "_chunk"])
    rows = (row for run in runs for row in _solve_chunk(run, reach, width, times))
    return _frames(rows, columns)


def _solve_chunk(run: dict[str, list], reach: int, width: int, times: int) -> Iterator[tuple]:
    """Exit of the chunk for each possible first anchor, and the warnings on each one's chain."""
    user, chunk = run["_user"][0], run["_chunk"][0]
    spots = list(zip(run["_us"], run["_id"]))
    home = sum(run["_home"])  # context rows lie after the chunk, so home rows come first
    ends, nexts, sizes = [], [], []
    for i in range(home):
        end, ok, killed = (spots[i][0] + reach, _NEVER), run["_ok_us"][i], False
        if not pd.isna(ok) and ok <= end[0]:
            end, killed = (int(ok), int(run["_ok_id"][i])), True
        after = bisect_right(spots, end, lo=i)
        ends.append(end)
        nexts.append(after)
        sizes.append(0 if killed else after - i)
    exits = list(range(home))
    for i in reversed(range(home)):
        if nexts[i] < home:
            exits[i] = exits[nexts[i]]
    entries = range(min(bisect_right(spots, (chunk * width + reach, _NEVER), hi=home) + 1, home))
    first, last = _chains(entries, nexts, home)
    for i, number in first.items():
        if sizes[i] >= times:
            until = spots[nexts[i] - 1][0]
            yield (user, chunk, number, last[i], *[None] * 4, spots[i][0], until, sizes[i])
    for i in entries:
        yield (user, chunk, first[i], first[i], *spots[i], *ends[exits[i]], *[None] * 3)


def _chains(entries: range, nexts: list[int], home: int) -> tuple[dict[int, int], dict[int, int]]:
    """Numbers the anchors that can be reached from `entries`, in the order of a walk over the tree
    that `nexts` spans: anchor a lies on the chain of entry e when first[a] <= first[e] <= last[a].
    """
    size = dict.fromkeys(entries, 1)
    for i in range(home):
        if i in size and nexts[i] < home:
            size[nexts[i]] = size.get(nexts[i], 1) + size[i]
    first, free, roots = {}, {}, 0
    for i in sorted(size, reverse=True):
        parent = nexts[i]
        if parent < home:
            first[i] = free[parent]
            free[parent] += size[i]
        else:
            first[i] = roots
            roots += size[i]
        free[i] = first[i] + 1
    return first, {i: first[i] + size[i] - 1 for i in size}


def _follow(batches):
    """The real first anchor of each chunk of a user, from the exit of the chunk before."""
    return _frames(_entries(batches), ["_user", "_chunk", "_entry"])


def _entries(batches) -> Iterator[tuple]:
    user = resume = None
    for run in _runs(batches, ["_user", "_chunk"]):
        if resume is None or run["_user"][0] != user:
            user, resume = run["_user"][0], (-_NEVER, 0)
        entry = bisect_right(list(zip(run["_at"], run["_at_id"])), resume)
        if entry < len(run["_at"]):
            yield user, run["_chunk"][0], run["_entry_from"][entry]
            resume = (run["_exit"][entry], run["_exit_id"][entry])
