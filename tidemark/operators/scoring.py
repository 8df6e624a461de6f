"""Scorecards of forecasts against what was sold, summaries over windows, gates and costs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import ratio_or_null
from tidemark.operators.joins import full_outer_zero


def score(forecast: DataFrame, actual: DataFrame, window: list[str], sku: str, units: str, sold: str) -> DataFrame:
    """One row for each window and candidate, of frames that hold them as columns."""
    return score_rows(full_outer_zero(forecast, actual, [*window, sku], [units, sold]), window, units, sold)


def score_rows(rows: DataFrame, window: list[str], units: str, sold: str) -> DataFrame:
    """Sums, error, bias, coverage, misses and use of the forecasts in each window; ratios of nothing are null.

    ``rows`` has one row for each window and SKU, with its forecast and what was sold.
    """
    f, s = F.col(units), F.col(sold)
    total = lambda c, x: F.sum(F.when(c, x).otherwise(0.0))
    used, missed, over = (f > 0) & (s > 0), (f <= 0) & (s > 0), (f > 0) & (s <= 0)
    out = rows.groupBy(*window).agg(
        F.sum(f).alias("ForecastUnits"), F.sum(s).alias("SoldUnits"), F.sum(F.abs(f - s)).alias("AbsErrorUnits"),
            F.sum(F.greatest(f - s, F.lit(0.0))).alias("OverUnits"), F.sum(F.greatest(s - f, F.lit(0.0))).alias("UnderUnits"),
        F.count_if(f > 0).alias("ForecastedSKUs"), F.count_if(s > 0).alias("SoldSKUs"), F.count_if((f > 0) | (s > 0)).alias("UnionSKUs"),
            total(used, s).alias("SoldUnitsWithForecast"), F.count_if(missed).alias("ZeroForecastSoldSKUs"),
        total(f <= 0, s).alias("ZeroForecastSoldUnits"), F.count_if(over).alias("OverGeneratedSKUs"), total(over, f).alias("OverGeneratedUnits"),
            F.count_if((f <= 0) & (s >= 10)).alias("Missed10SKUs"), total((f <= 0) & (s >= 10), s).alias("Missed10Units"),
        F.count_if(used).alias("UsedSKUs"), total(used, f).alias("UnitsOnUsedSKUs"),
    )
    ratio = lambda a, b: F.round(ratio_or_null(F.col(a), F.col(b)), 6)
    out = out.withColumn("BiasUnits", F.col("ForecastUnits") - F.col("SoldUnits"))
    return out.withColumns({
        "WAPE": ratio("AbsErrorUnits", "SoldUnits"), "BiasPct": ratio("BiasUnits", "SoldUnits"),
            "CoveragePct": F.round(1 - ratio_or_null(F.col("ZeroForecastSoldUnits"), F.col("SoldUnits")), 6),
                "ZeroForecastPct": ratio("ZeroForecastSoldUnits", "SoldUnits"),
        "SKUUseRate": ratio("UsedSKUs", "ForecastedSKUs"), "UnitsOnUsedPct": ratio("UnitsOnUsedSKUs", "ForecastUnits"),
            "ZeroDemandUnitPct": ratio("OverGeneratedUnits", "ForecastUnits"),
    })


def side_by_side(scores: DataFrame, window: str, candidate: str, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """One row for each window: each new column is a measure of one candidate."""
    return scores.groupBy(window).agg(*[F.max(F.when(F.col(candidate) == c, F.col(m))).alias(name) for name, (c, m) in columns.items()])


def summarise(scores: DataFrame, candidate: str) -> DataFrame:
    """Pooled and mean error of each candidate over windows."""
    return scores.groupBy(candidate).agg(F.count("*").alias("Windows"),
        F.round(ratio_or_null(F.sum("AbsErrorUnits"), F.sum("SoldUnits")), 6).alias("PooledWAPE"), F.round(F.avg("WAPE"), 6).alias("MeanWAPE"),
            F.round(F.median("WAPE"), 6).alias("MedianWAPE"))


def wins(scores: DataFrame, window: str, candidate: str, reference: str) -> DataFrame:
    """In how many windows each candidate is strictly better than the reference; windows without it are left out."""
    base = F.max(F.when(F.col(candidate) == reference, F.struct("WAPE"))).over(Window.partitionBy(window))
    rows = scores.withColumn("_ref", base).where("_ref is not null")
    return rows.groupBy(candidate).agg(F.count_if(F.col("WAPE") < F.col("_ref.WAPE")).alias("Wins"), F.count("*").alias("Compared"))


def winners(scores: DataFrame, window: str, candidate: str) -> DataFrame:
    return scores.withColumn("_k", F.row_number().over(Window.partitionBy(window).orderBy(F.asc_nulls_last("WAPE"), F.abs("BiasPct"),
        candidate))).where("_k = 1").select(window, F.col(candidate).alias("Winner"), "WAPE")


def gate_grid(windows: DataFrame, taus: list[float], gate: str, low: str, high: str, sold: str) -> DataFrame:
    """For each threshold how the policy does that uses ``low`` where the gate value is below it, else ``high``.

    Errors are absolute; a window counts as better or worse only beyond 1e-9.
    """
    wape = lambda e: ratio_or_null(e, F.col(sold))
    rows = windows.withColumn("Tau", F.explode(F.array(*map(F.lit, taus)))).withColumn("_low", F.coalesce(F.col(gate) < F.col("Tau"), F.lit(False)))
    rows = rows.withColumn("_e", F.when(F.col("_low"), F.col(low)).otherwise(F.col(high))).withColumns({"_g": wape(F.col("_e")), "_h": wape(F.col(high))})
    return rows.groupBy("Tau").agg(
        F.count_if("_low").alias("Triggered"), F.round(ratio_or_null(F.sum("_e"), F.sum(sold)), 6).alias("PooledWAPE"),
            F.round(F.avg("_g"), 6).alias("MeanWAPE"),
        F.count_if(F.col("_g") < F.col("_h") - 1e-9).alias("Improved"), F.count_if(F.col("_g") > F.col("_h") + 1e-9).alias("Worsened"),
    )


def cost_split(scores: DataFrame, ratios: list[float], window: list[str]) -> DataFrame:
    """Cost of over- and under-forecasting at each price ratio, from error and bias alone."""
    over = F.greatest(F.col("AbsErrorUnits") + F.col("ForecastUnits") - F.col("SoldUnits"), F.lit(0.0)) / 2
    under = F.greatest(F.col("AbsErrorUnits") - F.col("ForecastUnits") + F.col("SoldUnits"), F.lit(0.0)) / 2
    return scores.withColumn("Ratio", F.explode(F.array(*map(F.lit, ratios)))).select(*window, "Ratio", over.alias("Over"), under.alias("Under"),
        (over + F.col("Ratio") * under).alias("Cost"))


def bootstrap(windows: DataFrame, order: str, new: str, old: str, sold: str, block: int, draws: int) -> DataFrame:
    """95% interval of pooled error(new) - pooled error(old) over draws of moving blocks of consecutive windows.

    Block starts are hashes of draw and block, so reruns agree. One row; none with fewer windows than a block. ``windows`` has one
    row for each scoring window, so its numbering is small; draws are rows, summed in parallel.
    """
    rows = windows.withColumn("_i", F.row_number().over(Window.orderBy(order)).cast("long") - 1).select("_i", F.col(new).alias("_a"),
        F.col(old).alias("_b"), F.col(sold).alias("_s"))
    n = windows.count()
    if n < block:
        return windows.sparkSession.createDataFrame([], "Windows long, Draws long, Low double, High double, ShareBetter double")
    start = F.conv(F.substring(F.md5(F.concat_ws(":", F.col("b").cast("string"), F.floor(F.col("pos") / block).cast("string"))), 1, 8), 16,
        10).cast("long") % (n - block + 1)
    picks = windows.sparkSession.range(draws).withColumnRenamed("id", "b").withColumn("pos", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("_i",
        F.col("pos") % block + start)
    diffs = picks.join(rows, "_i").groupBy("b").agg((F.sum("_a") / F.sum("_s") - F.sum("_b") / F.sum("_s")).alias("d"))
    return diffs.agg(F.lit(n).cast("long").alias("Windows"), F.count("*").alias("Draws"), F.round(F.percentile("d", F.lit(0.025)), 6).alias("Low"),
        F.round(F.percentile("d", F.lit(0.975)), 6).alias("High"), F.round(F.avg((F.col("d") < 0).cast("double")), 6).alias("ShareBetter"))
