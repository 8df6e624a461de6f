"""Bounded samples of labelled rows, the same on every run and cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_SPAN = 1 << 40


def smallest_hashes(rows: DataFrame, by: str, key: str, most: int, seed: int) -> DataFrame:
    """At most ``most`` rows of each value of ``by`` (a few classes): those whose key has the smallest hash, ties by key.

    The classes are counted first, and only rows with a hash below the share that can matter are ranked, four times as many as are
    kept, so the ranking task does not grow with the table. Null classes are left out; of keys that repeat each row counts.
    """
    h = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(_SPAN))
    counts = rows.where(F.col(by).isNotNull()).groupBy(by).count().collect()
    share = F.lit(-1).cast("long")
    for r in counts:
        share = F.when(F.col(by) == r[by], F.lit(min(_SPAN, _SPAN * (4 * most + 100) // r["count"]))).otherwise(share)
    near = rows.withColumn("_h", h).where(F.col("_h") < share)
    place = F.row_number().over(Window.partitionBy(by).orderBy("_h", key))
    return near.withColumn("_place", place).where(F.col("_place") <= most).drop("_h", "_place")
