"""Forecasts without fitted models, and what is done to any forecast: scaling, hybrids, caps, blends, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import clip
from tidemark.operators import allocation as A
from tidemark.operators.category import HORIZON, days_of
from tidemark.operators.selection import attach
from tidemark.sources.sinks import kept


def recent_daily(recent: DataFrame, factors: DataFrame, origins: DataFrame, days: int = 56) -> DataFrame:
    """(Origin, SKU, ForecastDate, RecentUnits): a SKU's daily rate times the factor of the weekday, for each day of the horizon."""
    rate = recent.groupBy("Origin", "SKU").agg((F.sum("SoldUnits") / days).alias("rate"))
    ahead = days_of(origins, 0, HORIZON - 1, "ForecastDate").withColumn("dow", F.weekday("ForecastDate")).join(factors, ["Origin", "dow"])
    return rate.join(ahead, "Origin").select("Origin", "SKU", "ForecastDate", (F.col("rate") * F.col("factor")).alias("RecentUnits"))


def no_model(universe: DataFrame, origins: DataFrame, recent: DataFrame, seasonal: DataFrame, promo: DataFrame, recent_weight: float = 0.65) -> DataFrame:
    """(Variant, Origin, SKU, ForecastUnits) of four variants: with and without the season, with and without the promotion's floor.

    ``universe`` has (Origin, SKU), the others their signals by (Origin, SKU, ForecastDate): RecentUnits, SeasonalUnits, and Multiplier and
    Floor. Recent and seasonal demand are mixed where both are positive; a season alone stands in for missing recent demand. Days are
    summed, rounded half to even, and only positive totals stay.
    """
    keys, inside = ["Origin", "SKU", "ForecastDate"], F.datediff("ForecastDate", "Origin").between(0, HORIZON - 1)
    # a day without signals adds nothing, so the SKUs' days are no rows; all is dealt by origin and SKU once
    rows = universe.join(F.broadcast(origins.select("Origin").distinct()), "Origin", "left_semi").select("Origin", "SKU", F.lit(True).alias("_in"))
    signals = {"RecentUnits": recent, "SeasonalUnits": seasonal, "Multiplier": promo, "Floor": promo}
    for df in (recent, seasonal, promo):
        rows = rows.unionByName(df.where(inside).select(*keys, *[c for c, of in signals.items() if of is df]), allowMissingColumns=True)
    rows = rows.repartition("Origin", "SKU").groupBy(*keys).agg(F.max("_in").alias("_in"), *[F.max(c).alias(c) for c in signals]).fillna(0.0, ["RecentUnits", "SeasonalUnits"])
    r, s = F.col("RecentUnits"), F.col("SeasonalUnits")
    both = F.when((r > 0) & (s > 0), r * recent_weight + s * (1 - recent_weight)).when((r <= 0) & (s > 0), s).otherwise(r)
    lifted = lambda raw, floor: F.when(F.col("Multiplier").isNull(), raw).otherwise(F.greatest(raw * F.col("Multiplier"), floor))
    floor = F.coalesce("Floor", F.lit(0.0))
    named = {"recent": lifted(r, F.lit(0.0)), "recent_floor": lifted(r, floor), "seasonal": lifted(both, F.lit(0.0)), "seasonal_floor": lifted(both, floor)}
    sums = rows.groupBy("Origin", "SKU").agg(F.bool_or("_in").alias("_in"), *[F.bround(F.round(F.sum(v), 6)).alias(n) for n, v in named.items()]).where("_in").drop("_in")
    return sums.unpivot(["Origin", "SKU"], list(named), "Variant", "ForecastUnits").where("ForecastUnits > 0")


def planner_scaled(daily: DataFrame, plan: DataFrame, group: list[str], sku: str, units: str, planned: str, out: str) -> DataFrame:
    """Each group's units scaled to its plan and made whole by largest remainders, ties by SKU; a group without a plan keeps its scale.

    The whole units of a group add up to its scaled sum, rounded half to even, and never to less than the sum of the floors.
    """
    w = Window.partitionBy(*group)
    rows = daily.join(plan, group, "left").withColumn("_now", F.sum(units).over(w))
    factor = F.when((F.col(planned) > 0) & (F.col("_now") > 0), F.col(planned) / F.col("_now")).otherwise(1.0)
    rows = rows.withColumn("_raw", F.round(F.greatest(F.col(units), F.lit(0.0)) * factor, 9)).withColumn("_floor", F.floor("_raw"))
    left = F.greatest(F.bround(F.round(F.sum("_raw").over(w), 6)), F.sum("_floor").over(w)) - F.sum("_floor").over(w)
    rank = F.row_number().over(w.orderBy(F.desc(F.round(F.col("_raw") - F.col("_floor"), 9)), sku))
    rows = rows.withColumns({"_left": left, "_rank": rank})
    return rows.withColumn(out, (F.col("_floor") + F.when(F.col("_rank") <= F.col("_left"), 1).otherwise(0)).cast("long")).drop("_now", "_raw", "_floor",
        "_left", "_rank")


def spread_over_days(sku_totals: DataFrame, shapes: DataFrame, origins: DataFrame) -> DataFrame:
    """(Origin, SKU, ForecastDate, Units) from whole totals (Origin, Category, SKU, Total) by the category's weekday shape.

    Without a shape, or with none on the horizon's days, all days weigh the same; remainders go to earlier days first.
    """
    ahead = days_of(origins, 0, HORIZON - 1, "ForecastDate").withColumn("dow", F.weekday("ForecastDate"))
    rows = sku_totals.where("Total > 0").join(ahead, "Origin").join(shapes, ["Origin", "Category", "dow"], "left")
    weight = F.coalesce("weight", F.lit(0.0))
    rows = rows.withColumn("_w", F.when(F.sum(weight).over(Window.partitionBy("Origin", "SKU")) > 0, weight).otherwise(1.0))
    return A.allocate(rows, ["Origin", "SKU"], "_w", "Total", ["ForecastDate"], "Units").where("Units > 0").select("Origin", "SKU", "ForecastDate", "Units")


def hybrid(model: DataFrame, fallback: DataFrame, keys: list[str], sku: str, units: str, least: float, weight: float) -> DataFrame:
    """The model's rows of at least ``least`` units; for all other SKUs of the fallback a share of their units."""
    chosen = model.where(F.col(units) >= least).select(*keys, sku, units)
    rest = fallback.join(chosen.select(*keys, sku), [*keys, sku], "left_anti").select(*keys, sku, (F.greatest(F.col(units), F.lit(0.0)) * weight).alias(units))
    return chosen.unionByName(rest.where(F.col(units) > 0))


def volume_capped(forecast: DataFrame, totals: DataFrame, keys: list[str], units: str, total: str, multiple: float) -> DataFrame:
    """The forecast scaled down to ``multiple`` times another's total where it is above; never scaled up."""
    cap = F.col(total) * multiple
    rows = forecast.join(totals, keys, "left").withColumn("_sum", F.sum(units).over(Window.partitionBy(*keys)))
    factor = F.when((F.col("_sum") > cap) & (F.col("_sum") > 0) & (cap > 0), cap / F.col("_sum")).otherwise(1.0)
    return rows.withColumn(units, F.greatest(F.col(units), F.lit(0.0)) * factor).drop("_sum", total)


def group_scaled(model: DataFrame, other: DataFrame, groups: list[str], units: str, other_units: str) -> DataFrame:
    """Each group's units scaled to another forecast's total and rounded half to even; 1 where either is 0. Null groups are groups."""
    totals = other.groupBy(*groups).agg(F.sum(other_units).alias("_other")).select(*[F.col(g).alias(f"_{g}") for g in groups], "_other")
    on = [model[g].eqNullSafe(F.col(f"_{g}")) for g in groups]
    rows = model.withColumn("_own", F.sum(units).over(Window.partitionBy(*groups))).join(totals, on, "left").drop(*[f"_{g}" for g in groups])
    factor = F.when((F.col("_other") > 0) & (F.col("_own") > 0), F.col("_other") / F.col("_own")).otherwise(1.0)
    return rows.withColumn(units, F.greatest(F.bround(F.round(F.col(units) * factor, 9)), F.lit(0.0))).drop("_own", "_other").where(F.col(units) > 0)


def reconciled(base: str, target: str, groups: list[str], alpha: float = 1.0, most: float = 5.0) -> Column:
    """The base scaled in each group towards the target's sum, ``alpha`` of the way, by a factor of at most ``most`` either way."""
    w = Window.partitionBy(*groups)
    return _towards(base, F.sum(base).over(w), F.sum(target).over(w), alpha, most)


def _towards(base: str, own: Column, other: Column, alpha: float, most: float) -> Column:
    aim = alpha * other + (1 - alpha) * own
    return F.greatest(F.col(base) * F.when(own > 0, clip(aim / own, 1 / most, most)).otherwise(1.0), F.lit(0.0))


def reconciled_levels(rows: DataFrame, base: str, target: str, levels: dict[str, tuple[list[str], float]], most: float = 5.0) -> DataFrame:
    """``rows`` with a column for each level, a name with its groups and ``alpha``: as ``reconciled``, for groups of any size.

    Sums are one row for each group and are joined back, so no task holds a group. The rows are read several times, so they are written first.
    """
    rows = out = kept(rows, "levels")
    for i, (name, (groups, alpha)) in enumerate(levels.items()):
        out = attach(out, kept(rows.groupBy(*groups).agg(F.sum(base).alias(f"_own{i}"), F.sum(target).alias(f"_other{i}")), "sums"), groups)
        out = out.withColumn(name, _towards(base, F.col(f"_own{i}"), F.col(f"_other{i}"), alpha, most))
    return out.drop(*[f"{c}{i}" for c in ("_own", "_other") for i in range(len(levels))])
