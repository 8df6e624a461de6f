"""Gates between two candidates: thresholds learnt from earlier windows, policies against each other, period slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import ratio_or_null


def walk_forward(windows: DataFrame, order: str, gate: str, low: str, high: str, sold: str, taus: list[float], least: int) -> DataFrame:
    """For each window the threshold that was best over strictly earlier ones, and the error that it gives here.

    Below the threshold ``low`` is used, else (and without a gate value) ``high``. Ties take the lowest threshold; windows
    with fewer than ``least`` before them have no row. All thresholds are summed in one window, partitioned by threshold.
    """
    used = F.coalesce(F.col(gate) < F.col("Tau"), F.lit(False))
    grid = windows.withColumn("Tau",
        F.explode(F.array(*map(F.lit, taus)))).withColumns({"UsedLow": used, "Gated": F.when(used, F.col(low)).otherwise(F.col(high))})
    before = Window.partitionBy("Tau").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    past = grid.withColumns({"_r": F.round(ratio_or_null(F.sum("Gated").over(before), F.sum(sold).over(before)), 12), "_n": F.count("*").over(before)})
    best = Window.partitionBy(order).orderBy(F.asc_nulls_last("_r"), "Tau")
    return past.where(F.col("_n") >= least).withColumn("_k", F.row_number().over(best)).where("_k = 1").select(order, "Tau", "UsedLow", "Gated", low, high,
        sold)


def policies(windows: DataFrame, named: dict[str, Column], base: str, sold: str) -> DataFrame:
    """Pooled and mean error of each policy's absolute error, and how often it is better or worse than ``base``."""
    rows = windows.select(F.col(base).alias("_b"), F.col(sold).alias("_s"),
        F.explode(F.array(*[F.struct(F.lit(n).alias("Policy"), e.cast("double").alias("_e")) for n, e in named.items()])).alias("x")).select("_b", "_s", "x.*")
    return rows.groupBy("Policy").agg(F.count("*").alias("Windows"), F.round(ratio_or_null(F.sum("_e"), F.sum("_s")), 6).alias("PooledWAPE"),
        F.round(F.avg(ratio_or_null(F.col("_e"), F.col("_s"))), 6).alias("MeanWAPE"), F.count_if(F.col("_e") < F.col("_b")).alias("Improved"),
            F.count_if(F.col("_e") > F.col("_b")).alias("Worsened"))


def by_period(rows: DataFrame, day: str, first, last) -> DataFrame:
    """Each row once for every period that it is in: all, the last 7 and 28 days, the year of the last day, its month."""
    d, a, b = F.col(day), F.lit(first).cast("date"), F.lit(last).cast("date")
    new_year = F.trunc(b, "year")
    labels = F.array(F.lit("holdout"), F.when(F.datediff(b, d) < 7, "last_7_days"), F.when(F.datediff(b, d) < 28, "last_28_days"),
        F.when((new_year >= a) & (d >= new_year), "year_to_date"), F.date_format(d, "yyyy-MM"))
    return rows.where(d.between(a, b)).withColumn("Period", F.explode(F.array_compact(labels)))
