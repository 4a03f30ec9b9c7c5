"""Text expressions: tokens, url filter, ranked report lines, visitor offsets, JSON lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The static-file suffixes that do not count as page visits.
STATIC_SUFFIXES = ("css", "js", "png", "ico")

# Fixed value: seed of the polynomial visitor hash.
VISITOR_SEED = 61


def words(line: Column) -> Column:
    """One row per space-separated token; empty tokens (from runs of spaces) are left out."""
    return F.explode(F.array_remove(F.split(line, " "), ""))


def is_page_url(url: Column) -> Column:
    return ~url.rlike(r"\.(" + "|".join(STATIC_SUFFIXES) + r")$")


def visitor_offset(user: Column, capacity: int = 1 << 28, seed: int = VISITOR_SEED) -> Column:
    """Bit offset of a user in a bitmap of `capacity` bits (a power of two).

    Polynomial over the characters, reduced at every step, so that it never overflows a long.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    characters = F.split(user.cast("string"), "")
    mask = F.lit(capacity - 1)
    return F.aggregate(
        characters,
        F.lit(0).cast("long"),
        lambda acc, c: (acc * F.lit(seed) + F.ascii(c)).bitwiseAND(mask),
    )


def ranked_report(heading: Column, ranked: Column, label: str, key: str, count: str) -> Column:
    """Report text of one group: a heading, one "No1: ..." line per entry and a rule.

    `ranked` is an array of structs with fields `rank`, `key` and `count`, in rank order.
    """
    lines = F.transform(
        ranked,
        lambda r: F.concat(
            F.lit("No"),
            r["rank"].cast("string"),
            F.lit(f": {label}="),
            r[key].cast("string"),
            F.lit(" views="),
            r[count].cast("string"),
        ),
    )
    return F.concat_ws(
        "\n", F.concat(F.lit("time: "), heading), F.concat_ws("\n", lines), F.lit("=" * 37)
    )


def json_pairs(pairs: Column, key: str, value: str) -> Column:
    """JSON list of one-entry objects, `[{"10:21":3},{"10:22":1}]`, from an array of structs."""
    return F.to_json(
        F.transform(pairs, lambda p: F.create_map(p[key].cast("string"), p[value]))
    )
