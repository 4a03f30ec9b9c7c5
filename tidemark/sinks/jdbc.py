"""Database upsert: the batch's latest row per key goes to a staging table, then one MERGE.

Executors write the staging table in parallel; only the statements run on the driver. The merge is
idempotent, so a repeated batch leaves the same rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from tidemark.sinks.keyed import BatchWriter, latest_per_key


def merge_statement(
    table: str, staging: str, keys: Sequence[str], columns: Sequence[str], quote: str = ""
) -> str:
    """`quote` is the database's mark around names, doubled inside them; without it they are taken as they are."""

    def named(name: str) -> str:
        return quote + name.replace(quote, quote * 2) + quote if quote else name

    rest = [named(c) for c in columns if c not in keys]
    on = " AND ".join(f"t.{named(k)} = s.{named(k)}" for k in keys)
    update = ", ".join(f"{c} = s.{c}" for c in rest)
    every = [named(c) for c in columns]
    return (
        f"MERGE INTO {named(table)} AS t USING {named(staging)} AS s ON {on}"
        + (f" WHEN MATCHED THEN UPDATE SET {update}" if rest else "")
        + f" WHEN NOT MATCHED THEN INSERT ({', '.join(every)})"
        + f" VALUES ({', '.join('s.' + c for c in every)})"
    )


def jdbc_upsert_writer(
    url: str,
    table: str,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    execute: Callable[[str], None],
    properties: dict[str, str] | None = None,
    quote: str = "",
) -> BatchWriter:
    """foreachBatch function. `execute` runs one statement on the database.

    Each writer has a staging table of its own, which is dropped after the merge, so writers do not meet.
    """
    staging = f"{table}_staging_{uuid.uuid4().hex[:12]}"
    marked = quote + staging.replace(quote, quote * 2) + quote if quote else staging

    def write(df: DataFrame, batch_id: int) -> None:
        latest = latest_per_key(df, keys, order).select(*columns)
        latest.write.jdbc(url, marked, mode="overwrite", properties=properties or {})
        execute(merge_statement(table, staging, keys, columns, quote))
        execute(f"DROP TABLE {marked}")

    return write
