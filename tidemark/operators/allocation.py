"""Largest-remainder allocation and what is built on it: every total is met exactly."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.selection import attach, ranked
from tidemark.sources.sinks import kept


#: Remainders are whole numbers of billionths, in bins of this many.
BILLION, BIN = 1_000_000_000, 1 << 15


def allocate(df: DataFrame, group: list[str], weight: str, total: str, tie: list[str], out: str) -> DataFrame:
    """Whole numbers in proportion to ``weight`` that add up to ``total`` in each group; remainders go to the largest, ties by ``tie``.

    All are 0 where the total or the sum of weights is not positive; a null weight is 0, a null group is a group. Remainders are selected,
    not sorted: they are counted in at most BILLION / BIN bins of each group, all above the bin in which the total is met are rounded up, all
    below it down, and only that bin's rows are ranked, in buckets. So a group may hold any share of all rows. The rows are read several times,
    so they are written first.
    """
    rows = kept(df.withColumn("_weight", F.coalesce(F.col(weight), F.lit(0.0))), "allocated")
    # a row for each group; written, so that Spark knows whether it is small enough to broadcast
    rows = attach(rows, kept(rows.groupBy(*group).agg(F.sum("_weight").alias("_sum")), "sums"), group)
    good = (F.col(total) > 0) & (F.col("_sum") > 0)
    share = F.when(good, F.col("_weight") / F.col("_sum") * F.col(total)).otherwise(0.0)
    rows = rows.withColumn("_share", share).withColumn("_floor", F.floor(F.round("_share", 9)))
    # remainders are compared to nine places, so equal shares are ties on every machine
    rows = rows.withColumn("_rest", F.round(F.round(F.col("_share") - F.col("_floor"), 9) * BILLION).cast("long")).withColumn("_bin", F.floor(F.col("_rest") / BIN))
    whole = Window.partitionBy(*group)
    bins = rows.where(good).groupBy(*group, "_bin").agg(F.count("*").alias("_n"), F.sum("_floor").alias("_f"), F.max(total).alias("_t"))
    upto = F.sum("_n").over(whole.orderBy(F.desc("_bin")))
    bins = bins.withColumns({"_upto": upto, "_left": F.floor(F.max("_t").over(whole) - F.sum("_f").over(whole))})
    met = (F.col("_upto") - F.col("_n") < F.col("_left")) & (F.col("_left") <= F.col("_upto"))
    # a total that is met before the first bin, or by none, has no bin to be ranked
    cut = bins.groupBy(*group).agg(F.max("_left").alias("_left"), F.max(F.when(met, F.col("_bin"))).alias("_cut"), F.max(F.when(met, F.col("_left") - F.col("_upto") + F.col("_n"))).alias("_need"))
    rows = attach(rows, kept(cut, "cuts"), group).drop("_weight", "_sum", "_share")
    tight = F.coalesce(F.col("_bin") == F.col("_cut"), F.lit(False))
    up = F.coalesce(F.when(F.col("_cut").isNull(), F.col("_left") > 0).otherwise(F.col("_bin") > F.col("_cut")), F.lit(False))
    placed = ranked(rows.where(tight), group, [-F.col("_rest"), *map(F.col, tie)], "_rank").withColumn(out, F.col("_floor") + (F.col("_rank") <= F.col("_need")).cast("long"))
    others = rows.where(~tight).withColumn(out, F.col("_floor") + up.cast("long"))
    columns = [*[c for c in df.columns if c.lower() != out.lower()], out]
    return others.select(*columns).unionByName(placed.select(*columns))


def anchor(shape: DataFrame, totals: DataFrame, day: str, units: str, total: str, tie: list[str], out: str) -> DataFrame:
    """The shape's positive rows scaled to each day's total of another candidate, rounded half to even."""
    daily = totals.groupBy(day).agg(F.bround(F.sum(total)).alias("_total"))
    return allocate(shape.where(F.col(units) > 0).join(daily, day), [day], units, "_total", tie, out).drop("_total")


def by_category(totals: DataFrame, weights: DataFrame, day: str, total: str, category: str, sku: str, weight: str, out: str) -> DataFrame:
    """Daily totals to categories by their weights, then to SKUs; a day's units are met exactly.

    The categories, with their weights, are one array, put to each day: their number does not grow with the facts.
    """
    weights = kept(weights, "weights")  # read for the categories and for the SKUs
    cats = weights.groupBy(category).agg(F.sum(weight).alias("w")).where("w > 0").agg(F.array_sort(F.collect_list(F.struct(category, "w"))).alias("_cats"))
    spread = totals.select(day, total).withColumn("_cats", cats.scalar()).select(day, total, F.explode("_cats").alias("c")).select(day, total,
        f"c.{category}", F.col("c.w").alias("_cw"))
    top = allocate(spread, [day], "_cw", total, [category], "_cu").select(day, category, "_cu")
    return allocate(top.join(weights, category), [day, category], weight, "_cu", [sku], out).select(day, category, sku, out)
