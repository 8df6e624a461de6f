"""Ranks and medians inside groups of any size: rows are cut at splitters, counted by bucket, and only a bucket is ever sorted whole.

Splitters are the values with the smallest hashes of their group, so buckets are about even whatever the values' distribution; the results
are exact whichever rows are chosen. A group may be null and may hold any share of all rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A group of n different values is ranked in buckets of about n / SPLITTERS.
SPLITTERS = 255


def attach(rows: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the further columns of ``small``, one row for each value of ``keys`` (null is one); null where it has none."""
    named = small.withColumnsRenamed({c: f"_at_{c}" for c in keys})
    same = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(named[f"_at_{c}"]) for c in keys])
    return rows.join(named, same, "left").drop(*[f"_at_{c}" for c in keys])


def _bucketed(rows: DataFrame, group: list[str], key: Column) -> DataFrame:
    """``rows`` with ``_key`` and ``_bucket``: how many splitters of the group lie below the key."""
    rows = rows.withColumn("_key", key)
    drawn = F.row_number().over(Window.partitionBy(*group).orderBy(F.xxhash64("_key"), "_key"))
    chosen = rows.select(*group, "_key").withColumn("_n", drawn).where(F.col("_n") <= SPLITTERS)
    splitters = chosen.groupBy(*group).agg(F.array_sort(F.collect_set("_key")).alias("_splitters"))
    below = F.filter("_splitters", lambda s: s < F.col("_key"))
    return attach(rows, splitters, group).withColumn("_bucket", F.size(below)).drop("_splitters")


def _running(counts: DataFrame, group: list[str]) -> DataFrame:
    """Buckets (group, _bucket, _n) with the rows of the buckets before, and of the whole group."""
    whole = Window.partitionBy(*group)
    return counts.withColumns({"_before": F.sum("_n").over(whole.orderBy("_bucket")) - F.col("_n"), "_all": F.sum("_n").over(whole)})


def ranked(rows: DataFrame, group: list[str], order: list[Column], out: str) -> DataFrame:
    """``rows`` with the rank from 1 inside ``group``, ascending by ``order`` (numbers are negated to descend); rows of equal order are in any order."""
    rows = _bucketed(rows, group, F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]))
    starts = _running(rows.groupBy(*group, "_bucket").agg(F.count("*").alias("_n")), group).select(*group, "_bucket", "_before")
    inside = F.row_number().over(Window.partitionBy(*group, "_bucket").orderBy("_key"))
    return attach(rows.withColumn(out, inside), starts, [*group, "_bucket"]).withColumn(out, F.col(out) + F.col("_before")).drop("_key", "_bucket", "_before")


def medians(rows: DataFrame, group: list[str], value: str, out: str) -> DataFrame:
    """(group, out): the exact median of each group, the mean of the middle two for an even count; nulls do not count, a group of nulls has none.

    Equal values are counted first, so a value that fills a group is one row.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(*group, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n"))
    cut = _bucketed(counts, group, F.col("_v"))
    buckets = _running(cut.groupBy(*group, "_bucket").agg(F.sum("_n").alias("_n")), group)
    first, second = F.floor((F.col("_all") + 1) / 2), F.floor((F.col("_all") + 2) / 2)
    holds = lambda at, n: (F.col("_before") < at) & (at <= F.col("_before") + n)
    middle = buckets.where(holds(first, F.col("_n")) | holds(second, F.col("_n"))).select(*group, "_bucket", F.col("_before").alias("_start"), "_all")
    near = attach(cut, middle, [*group, "_bucket"]).where("_all is not null")
    before = F.sum("_n").over(Window.partitionBy(*group, "_bucket").orderBy("_v")) - F.col("_n") + F.col("_start")
    near = near.withColumn("_before", before)
    two = near.groupBy(*group).agg(F.max(F.when(holds(first, F.col("_n")), F.col("_v"))).alias("a"), F.max(F.when(holds(second, F.col("_n")), F.col("_v"))).alias("b"))
    return two.select(*group, ((F.col("a") + F.col("b")) / 2).alias(out))
