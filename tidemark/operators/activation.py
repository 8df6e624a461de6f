"""SKU weights at the turn of a season: new active SKUs get a prior, SKUs without supply decay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.selection import attach, medians
from tidemark.sources.sinks import kept


def activation_weights(recent: DataFrame, evidence: DataFrame, categories: DataFrame, prior_share: float = 0.5, decay: float = 0.35) -> DataFrame:
    """(Origin, SKU, Category, Gate, Weight) from recent units (Origin, SKU, RecentUnits) and active SKUs (Origin, SKU, HasInv, HasInbound).

    The gate of an origin rises from 0 to 1 as the share of active SKUs without recent demand goes from 0.10 to 0.25. With a closed
    gate new SKUs are left out and weights stay the recent units. All origins are one plan; SKUs without a category are UNKNOWN.
    """
    rows = recent.join(evidence, ["Origin", "SKU"], "full").join(categories, "SKU", "left")
    rows = rows.withColumns({"Category": F.coalesce("Category", F.lit("UNKNOWN")), "HasInv": F.coalesce("HasInv", F.lit(False)),
        "HasInbound": F.coalesce("HasInbound", F.lit(False)), "Units": F.coalesce("RecentUnits", F.lit(0.0))})
    rows = kept(rows, "active")
    active = F.col("HasInv") | F.col("HasInbound")
    positive = F.when(F.col("Units") > 0, F.col("Units"))
    turnover = F.count_if(F.col("RecentUnits").isNull()) / F.greatest(F.count_if(active), F.lit(1))
    gates = rows.groupBy("Origin").agg(F.greatest(F.least((turnover - 0.10) / 0.15, F.lit(1.0)), F.lit(0.0)).alias("Gate"))
    sold = rows.withColumn("_positive", positive)
    rows = attach(rows, medians(sold, ["Origin", "Category"], "_positive", "_own"), ["Origin", "Category"])
    rows = attach(rows, medians(sold, ["Origin"], "_positive", "_all"), ["Origin"])
    rows = rows.join(gates, "Origin").where(F.col("RecentUnits").isNotNull() | (F.col("Gate") > 0))
    prior = F.coalesce("_own", "_all", F.lit(1.0))
    low = (F.col("Units") <= 0) | (F.col("Units") < 0.25 * prior)
    weight = F.when(low & active, F.greatest("Units", prior * prior_share * F.col("Gate"))).when((F.col("Units") > 0) & ~active,
        F.col("Units") * (1 - F.col("Gate") * (1 - decay))).otherwise(F.col("Units"))
    return rows.select("Origin", "SKU", "Category", "Gate", weight.alias("Weight"))
