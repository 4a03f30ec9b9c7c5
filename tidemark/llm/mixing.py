"""Mixing sources to target weights: every document is repeated a Poisson number of times.

The mean is the source's target repetition rate, so that the expected size of each source meets its share of
the target. The count is the inverse of the Poisson distribution at a number drawn from a hash of seed and
id: the same document gets the same count in every run, whatever the partitioning.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tidemark.llm.tables import documents, text_of, written

SEED = 17
ALPHA = 0.5


def poisson_cdf(rate: float) -> np.ndarray:
    """P(count <= k) for k = 0, 1, ... as far as doubles can tell it from 1; sums logarithms, so large rates work."""
    if not rate > 0:
        return np.ones(1)
    last = int(rate + 12 * np.sqrt(rate) + 40)
    k = np.arange(1, last + 1)
    log_p = np.concatenate([[0.0], np.cumsum(np.log(rate) - np.log(k))]) - rate
    return np.minimum(np.cumsum(np.exp(log_p)), 1.0)


@F.pandas_udf(ArrayType(DoubleType()))
def _cdf(rates: pd.Series) -> pd.Series:
    return rates.map(poisson_cdf)


def uniform(seed: int, key: Column) -> Column:
    """A number in [0, 1) of 52 bits from a hash of seed and key; a null key counts as the empty text."""
    digits = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digits, 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def smoothed_rates(docs: DataFrame, source: str = "source", text: str = "text", alpha: float = ALPHA) -> DataFrame:
    """(source, rate) for shares proportional to size ** alpha, at an unchanged total size.

    A source's size is its characters plus one per document, so that it is never zero. The sizes are one row
    per source; their total is one row.
    """
    sizes = written(
        docs.groupBy(F.col(source).alias("source")).agg(F.sum(F.length(text_of(text)) + F.lit(1)).alias("size")), "sizes"
    )
    return rates_for(sizes, sizes.select("source", F.pow("size", F.lit(alpha)).alias("weight")))


def rates_for(sizes: DataFrame, weights: DataFrame, total: float | None = None) -> DataFrame:
    """(source, rate) from sizes and target weights by source; `total` is the target size, by default that of all.

    A source without a weight gets rate 0: it is not in the mixture. So do sources whose size is zero, which no
    repetition makes larger, and all of them if the weights add up to zero.
    """
    sums = weights.agg(F.sum("weight").alias("all_weights"))
    whole = sizes.agg(F.sum("size").cast("double").alias("whole"))
    if total is not None:
        whole = whole.select(F.lit(float(total)).alias("whole"))
    one_row = sums.join(whole, F.lit(True))
    known = sizes.join(weights.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left")
    share = F.try_divide(F.col("weight").cast("double"), F.col("all_weights"))
    rate = F.try_divide(share * F.col("whole"), F.col("size"))
    return known.join(one_row, F.lit(True)).select("source", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def mix(docs: DataFrame, rates: DataFrame, source: str = "source", doc_id: str = "doc_id", seed: int = SEED) -> DataFrame:
    """(row, copy, n_copies): each input row as a struct, once for each copy from 1 to n_copies, in a global shuffle.

    Rows whose count is 0 are not in the mixture. A null source is a source of its own; a null id draws by the
    empty text; repeated rows draw alike. Each task copies its own rows; the one shuffle deals them out by a
    hash of seed, id and copy, which no source or id can make uneven, and sorts each part by it.
    """
    inverse = written(rates.select(F.col("source").alias("of"), "rate", _cdf("rate").alias("cdf")), "rates")
    rows = docs.select(F.struct("*").alias("row"), F.col(source).alias("from"), uniform(seed, F.col(doc_id)).alias("u"))
    counted = rows.join(inverse, F.col("from").eqNullSafe(F.col("of"))).select(
        "row", F.size(F.filter("cdf", lambda c: c <= F.col("u"))).alias("n_copies")
    )
    copies = counted.where(F.col("n_copies") > 0).select(
        "row", "n_copies", F.explode(F.sequence(F.lit(1), F.col("n_copies"))).alias("copy")
    )
    place = F.xxhash64(F.lit(seed), F.col(f"row.`{doc_id}`"), F.col("copy"))
    return copies.withColumn("place", place).repartition("place").sortWithinPartitions("place").drop("place")


def op2_mix_sources(spark, sf_dir: str) -> DataFrame:
    """Whole `documents`, shares proportional to the square root of a source's size."""
    docs = documents(spark, sf_dir)
    return mix(docs, smoothed_rates(docs)).select(
        F.col("row.doc_id").alias("doc_id"), "copy", "n_copies",
        F.col("row.source").alias("source"), F.col("row.text").alias("text"),
    )


OP2_SQL = f"""
WITH sizes AS (
  SELECT source, CAST(sum(length(coalesce(text, '')) + 1) AS DOUBLE) AS size FROM documents GROUP BY source),
rates AS (
  SELECT source, power(size, {ALPHA}) / sum(power(size, {ALPHA})) OVER () * sum(size) OVER () / size AS rate
  FROM sizes),
steps AS (
  SELECT source, rate, unnest(range(CAST(floor(rate + 12 * sqrt(rate) + 40) AS BIGINT) + 1)) AS k FROM rates),
cdf AS (
  SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS p
  FROM steps),
drawn AS (
  SELECT doc_id, source, text,
         CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT)
           / 4503599627370496.0 AS u
  FROM documents),
counted AS (
  SELECT drawn.*, (SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM drawn.source AND p <= u) AS n
  FROM drawn)
SELECT doc_id, CAST(unnest(range(1, n + 1)) AS INTEGER) AS copy, CAST(n AS INTEGER) AS n_copies, source, text
FROM counted WHERE n > 0
"""
