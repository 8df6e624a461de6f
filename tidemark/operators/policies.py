"""Which windows count, and which candidate is used in the next one: inclusion, the recency brake, break-even prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import ratio_or_null
from tidemark.operators.category import days_of


def inclusion(ahead: DataFrame, categories: DataFrame, facts: DataFrame, least: float, days: int = 28) -> DataFrame:
    """(Origin, Mapped, Included, Proxy): what is known at the origin about how far a forecast (Origin, SKU, q) can be trusted.

    Mapped is the share of its units with a category, Proxy the share of the demand of the days before on SKUs that it has.
    """
    rows = ahead.join(categories, "SKU", "left")
    mapped = rows.groupBy("Origin").agg(ratio_or_null(F.sum(F.when(F.col("Mapped").isNotNull(), F.col("q"))), F.sum("q")).alias("Mapped"))
    origins = ahead.select("Origin").distinct()
    before = facts.select("SKU", "ActualDate", "SoldUnits").join(days_of(origins, -days, -1), "ActualDate").groupBy("Origin",
        "SKU").agg(F.sum("SoldUnits").alias("s"))
    share = before.join(ahead.where("q > 0"), ["Origin", "SKU"],
        "left").groupBy("Origin").agg(ratio_or_null(F.sum(F.when(F.col("q").isNotNull(), F.col("s"))), F.sum("s")).alias("Proxy"))
    zero = lambda c: F.round(F.coalesce(c, F.lit(0.0)), 6)
    return mapped.join(share, "Origin", "left").select("Origin", zero("Mapped").alias("Mapped"), (F.col("Mapped") >= least).alias("Included"),
        zero("Proxy").alias("Proxy"))


def recency_brake(windows: DataFrame, order: str, forecast: str, sold: str, caps: list[tuple[float, str]], floor: str, last: int, least_cap: float,
    least_coverage: float) -> DataFrame:
    """(order, Candidate, Ratio): the candidate of the largest cap that is not above the recent ratio of sales to forecast.

    ``caps`` are (cap, candidate), loosest first. Where the pick's recent coverage (columns cov_...) is too low, the hardest cap that is
    at least as loose and covered enough is taken, then the floor candidate; without either the pick stays. Without a forecast before,
    the loosest is used. Each window is one row of scores, so one ordered window over all of them is small.
    """
    w = Window.partitionBy().orderBy(order).rowsBetween(-last, -1)
    names = [c for _, c in caps]
    rows = windows.withColumn("_r", F.when(F.sum(forecast).over(w) > 0, F.sum(sold).over(w) / F.sum(forecast).over(w)))
    rows = rows.withColumns({f"_c_{c}": F.coalesce(F.avg(f"cov_{c}").over(w), F.lit(0.0)) for c in [*names, floor]})
    target = F.greatest(F.lit(least_cap), F.least("_r", F.lit(caps[0][0])))
    pick = F.coalesce(*[F.when(F.lit(cap) <= target, F.lit(k)) for k, (cap, _) in enumerate(caps)], F.lit(len(caps) - 1))
    rows = rows.withColumn("_k", pick)
    enough = lambda c: F.col(f"_c_{c}") >= least_coverage
    own = F.coalesce(*[F.when(F.col("_k") == k, enough(c)) for k, c in enumerate(names)])
    looser = F.coalesce(*[F.when((F.col("_k") >= k) & enough(names[k]), F.lit(names[k])) for k in reversed(range(len(names)))])
    stay = F.coalesce(*[F.when(F.col("_k") == k, F.lit(c)) for k, c in enumerate(names)])
    chosen = F.when(F.col("_r").isNull(), names[0]).when(own, stay).otherwise(F.coalesce(looser, F.when(enough(floor), floor), stay))
    return rows.select(order, chosen.alias("Candidate"), F.round("_r", 6).alias("Ratio"))


def break_even(scores: DataFrame, candidate: str, ratios: list[float], zero: float, named: dict[str, str]) -> DataFrame:
    """(Ratio, Winner, costs): the cheaper candidate at each price of a missing unit against one too many; uncovered units cost ``zero`` times it."""
    sums = scores.groupBy(candidate).agg(F.sum("OverUnits").alias("o"), F.sum(F.col("UnderUnits") - F.col("ZeroForecastSoldUnits")).alias("u"),
        F.sum("ZeroForecastSoldUnits").alias("z"))
    rows = sums.withColumn("Ratio", F.explode(F.array(*map(F.lit, ratios)))).withColumn("cost",
        F.col("o") + F.col("Ratio") * F.col("u") + zero * F.col("Ratio") * F.col("z"))
    costs = [F.round(F.max(F.when(F.col(candidate) == c, F.col("cost"))), 6).alias(n) for n, c in named.items()]
    return rows.groupBy("Ratio").agg(F.min(F.struct(F.round("cost", 6), candidate))[candidate].alias("Winner"), *costs)


