"""Lags, rolling means, streaks of candidates and other window operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_lags(df: DataFrame, keys: list[str], day: str, measure: str, lags=(1, 7, 14), means=(7, 28)) -> DataFrame:
    """Lags and means of earlier rows of a key, counted in rows; nothing earlier is 0. One exchange serves all."""
    w = Window.partitionBy(*keys).orderBy(day)
    out = {f"Lag{n}": F.coalesce(F.lag(measure, n).over(w), F.lit(0.0)) for n in lags}
    out |= {f"RollingMean{n}": F.coalesce(F.avg(measure).over(w.rowsBetween(-n, -1)), F.lit(0.0)) for n in means}
    return df.withColumns(out)


def calendar_mean(measure: str, keys: list[str], day: str, days: int) -> Column:
    """Mean over the calendar days before a row; a day without a row counts as 0."""
    number = F.unix_date(F.col(day))
    return F.coalesce(F.sum(measure).over(Window.partitionBy(*keys).orderBy(number).rangeBetween(-days, -1)), F.lit(0.0)) / days


def day_spine(df: DataFrame, day: str) -> DataFrame:
    """Every day between the first and the last."""
    return df.agg(F.min(day).alias("_a"), F.max(day).alias("_b")).select(F.explode(F.sequence("_a", "_b")).alias(day))


def rolling_window_sums(df: DataFrame, day: str, measure: str, days: int, out: str) -> DataFrame:
    """Sums over each full run of calendar days, labelled by its first day: each row counts for the days before it."""
    spread = df.withColumn("_start", F.explode(F.sequence(F.date_sub(day, days - 1), F.col(day))))
    bounds = df.agg(F.min(day).alias("_a"), F.date_sub(F.max(day), days - 1).alias("_b"))
    sums = spread.groupBy("_start").agg(F.sum(measure).alias(out))
    return sums.join(bounds, F.col("_start").between(F.col("_a"), F.col("_b"))).select(F.col("_start").alias(day), out)


def best_prior(scores: DataFrame, start: str, candidate: str, error: str, sold: str, default: str, last: int | None = None) -> DataFrame:
    """For each window the row of the candidate with the lowest pooled error over earlier windows, of the default where there are none."""
    w = Window.partitionBy(candidate).orderBy(start).rowsBetween(Window.unboundedPreceding if last is None else -last, -1)
    past = scores.withColumns({"_e": F.sum(error).over(w), "_s": F.sum(sold).over(w)}).withColumn("_r", F.when(F.col("_s") > 0, F.col("_e") / F.col("_s")))
    own = F.col("_r").isNull() & (F.col(candidate) != default)
    order = Window.partitionBy(start).orderBy(F.asc_nulls_last(F.round("_r", 9)), own, candidate)
    return past.withColumn("_k", F.row_number().over(order)).where("_k = 1").where(~own).select(*scores.columns)


def spaced(dates: DataFrame, day: str, days: int) -> DataFrame:
    """The first date, then each next that is at least ``days`` after the last one taken. The dates are one array."""
    taken = F.aggregate(
        F.array_sort(F.collect_set(day)),
        F.array().cast("array<date>"),
        lambda done, x: F.when((F.size(done) == 0) | (F.datediff(x, F.element_at(done, -1)) >= days), F.concat(done, F.array(x))).otherwise(done),
    )
    return dates.agg(taken.alias("_d")).select(F.explode("_d").alias(day))
