"""Category run rates, event lifts and weekday shapes, for all origins in one plan.

Origins are rows (column Origin). What lies before or around them is reached by an equi join on days, so the facts are read
once for all origins. A SKU without a category is UNKNOWN.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import clip

HORIZON = 14
#: Least and most lift.
LIFT = (0.5, 3.0)


def days_of(origins: DataFrame, first: int, last: int, day: str = "ActualDate") -> DataFrame:
    """(Origin, day) for the days from ``first`` to ``last`` after each origin, both included."""
    return origins.select("Origin", F.explode(F.sequence(F.date_add("Origin", first), F.date_add("Origin", last))).alias(day))


def on_days(facts: DataFrame, days: DataFrame, day: str = "ActualDate") -> DataFrame:
    """Facts with the further columns of ``days``, a row for each of the spans that a fact's day is in.

    Spark takes the semi join below an aggregate by day, so facts of no span are left out before they are summed.
    """
    return facts.join(days.select(day), day, "left_semi").join(days, day)


def lookback(facts: DataFrame, origins: DataFrame, categories: DataFrame, days: int = 56) -> DataFrame:
    """(Origin, ActualDate, SKU, Category, SoldUnits) of the ``days`` days before each origin."""
    rows = on_days(facts.select("SKU", "ActualDate", "SoldUnits"), days_of(origins, -days, -1)).join(categories, "SKU", "left")
    return rows.withColumn("Category", F.coalesce("Category", F.lit("UNKNOWN")))


def run_rate(recent: DataFrame, days: int = 56) -> DataFrame:
    """(Origin, Category, DailyRunRate): a day counts for 2.5 times the median day or 10 units at most; all days divide."""
    daily = recent.groupBy("Origin", "Category", "ActualDate").agg(F.sum("SoldUnits").alias("u"))
    daily = daily.withColumn("med", F.median("u").over(Window.partitionBy("Origin", "Category")))
    return daily.groupBy("Origin", "Category").agg((F.sum(F.least("u", F.greatest(2.5 * F.col("med"), F.lit(10.0)))) / days).alias("DailyRunRate"))


def event_lift(facts: DataFrame, origins: DataFrame, categories: DataFrame, years: int = 3, base_days: int = 28, shrink: float = 400.0) -> DataFrame:
    """(Origin, Category, ShrunkLift): the horizon's days of earlier years against the days before them.

    A year with a base and no event units counts as none sold; a year without a base is left out. Lifts are clipped, weighted by base
    units and drawn towards 1. 29 February is the 28th of other years; a horizon over the turn of a year has no event days.
    """
    same = lambda c, k: f"add_months({c}, -12 * {k})"
    end = f"date_add(Origin, {HORIZON - 1})"
    # the last day of the horizon is taken to the origin's own earlier year
    spans = origins.withColumn("k",
        F.explode(F.sequence(F.lit(1), F.lit(years)))).withColumns({"es": F.expr(same("Origin", "k")),
            "ee": F.expr(same(end, f"(k + year({end}) - year(Origin))"))})
    days = spans.select("Origin", "k", "es", "ee", F.explode(F.expr(f"sequence(date_sub(es, {base_days}), greatest(ee, es))")).alias("ActualDate"))
    days = days.withColumn("event", F.when(F.col("ActualDate") < F.col("es"), False).when(F.col("ActualDate") <= F.col("ee"), True)).where("event is not null")
    rows = on_days(facts.select("SKU", "ActualDate", "SoldUnits"), days).join(categories, "SKU", "left").withColumn("Category",
        F.coalesce("Category", F.lit("UNKNOWN")))
    total = lambda e: F.coalesce(F.sum(F.when(F.col("event") == e, F.col("SoldUnits"))), F.lit(0.0))
    sums = rows.groupBy("Origin", "k", "Category").agg(total(True).alias("event"), total(False).alias("base"),
        F.greatest(F.datediff(F.first("ee"), F.first("es")) + 1, F.lit(1)).alias("n")).where("base > 0")
    lift = clip((F.col("event") / F.col("n")) / (F.col("base") / base_days), *LIFT)
    return sums.groupBy("Origin", "Category").agg(clip((F.sum(lift * F.col("base")) + shrink) / (F.sum("base") + shrink), *LIFT).alias("ShrunkLift"))


def weekday_factors(recent: DataFrame, origins: DataFrame, days: int = 56, low: float = 0.65, high: float = 1.35) -> DataFrame:
    """(Origin, dow, factor): mean units of a weekday over calendar days against the mean of all days; 1 without any units."""
    spine = days_of(origins, -days, -1).groupBy("Origin", F.weekday("ActualDate").alias("dow")).agg(F.count("*").alias("n"))
    sold = recent.groupBy("Origin", F.weekday("ActualDate").alias("dow")).agg(F.sum("SoldUnits").alias("u"))
    mean = F.sum("u").over(Window.partitionBy("Origin")) / days
    rows = spine.join(sold, ["Origin", "dow"], "left").withColumn("mean", mean)
    return rows.select("Origin", "dow",
        F.when(F.col("mean") > 0, clip(F.coalesce("u", F.lit(0.0)) / F.col("n") / F.col("mean"), low, high)).otherwise(1.0).alias("factor"))


def weekday_shape(recent: DataFrame) -> DataFrame:
    """(Origin, Category, dow, weight): each weekday's share of a category's units."""
    sums = recent.groupBy("Origin", "Category", F.weekday("ActualDate").alias("dow")).agg(F.sum("SoldUnits").alias("u"))
    total = F.sum("u").over(Window.partitionBy("Origin", "Category"))
    return sums.withColumn("t", total).where("t > 0").select("Origin", "Category", "dow", (F.col("u") / F.col("t")).alias("weight"))


def targets(rates: DataFrame, lifts: DataFrame) -> DataFrame:
    """(Origin, Category, CategoryTarget): the run rate over the horizon times the lift, 1 where there is none."""
    rows = rates.join(lifts, ["Origin", "Category"], "left")
    return rows.select("Origin", "Category",
        (F.col("DailyRunRate") * HORIZON * F.coalesce("ShrunkLift", F.lit(1.0))).alias("CategoryTarget")).where("CategoryTarget > 0")
