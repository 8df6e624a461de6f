"""Queries of gates, segments, periods and training frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalars import ratio_or_zero
from tidemark.operators import gates as G
from tidemark.plans.forecasts import _PAIR, TAUS, _pair, _with
from tidemark.plans.registry import query

_WALK = f"""(select SnapshotId, Tau, coalesce(gate < Tau, false) as UsedLow, case when gate < Tau then low else high end as Gated, low, high, sold from
  (select *, sum(case when gate < Tau then low else high end) over x as e, sum(sold) over x as s, count(*) over x as n from
    {_PAIR}, (select unnest({TAUS}::double[]) as Tau)
   window x as (partition by Tau order by SnapshotId rows between unbounded preceding and 1 preceding)) where n >= 5 qualify row_number()
  over (partition by SnapshotId order by round(e / nullif(s, 0), 12) nulls last, Tau) = 1)"""


def _walk(t):
    return G.walk_forward(_pair(t), "SnapshotId", "gate", "low", "high", "sold", TAUS, 5)


@query(_with(f"select * from {_WALK}"))
def walk_forward_gate(t):
    """SC9 and SC11 the best threshold over strictly earlier windows."""
    return _walk(t)


@query(_with(f"""select Policy, count(*) as Windows, round(sum(e) / nullif(sum(sold), 0), 6) as PooledWAPE, round(avg(e / nullif(sold, 0)), 6) as MeanWAPE,
  count(*) filter (e < high) as Improved, count(*) filter (e > high) as Worsened
  from (select high, sold, unnest(['raw', 'recent', 'gated', 'oracle']) as Policy, unnest([high, low, Gated, least(low, high)]::double[]) as e from {_WALK})
  group by 1"""))
def gate_policies(t):
    """SC10 policies against each other, with the best that any gate could do."""
    named = {"raw": F.col("high"), "recent": F.col("low"), "gated": F.col("Gated"), "oracle": F.least("low", "high")}
    return G.policies(_walk(t), named, "high", "sold")


_DAYS = "(select f.SnapshotId, f.ForecastStartDate, f.SKU, f.Category, f.ForecastDayOffset, f.ForecastDate, f.ForecastQty as f, coalesce(a.SoldUnits, 0) as s from forecast_sku_day f left join actual_sku_day a on a.SKU = f.SKU and a.ActualDate = f.ForecastDate)"


def _with_sold(t, ahead):
    sold = t.actual_sku_day.select("SKU", F.col("ActualDate").alias("ForecastDate"), F.col("SoldUnits").alias("s"))
    return ahead.withColumnRenamed("ForecastQty", "f").join(sold, ["SKU", "ForecastDate"], "left").withColumn("s", F.coalesce("s", F.lit(0.0)))


def _days(t):
    return _with_sold(t, t.forecast_sku_day)


#: Edges of absolute differences; a fractional one between two buckets is in none. The last bucket is open.
BUCKETS = ((0, 0), (1, 5), (6, 10), (11, 25), (26, 50), (51, 75), (76, 99), (100, None))


@query(f"""select SnapshotId, {", ".join(f"count(*) filter (v >= {a}{'' if b is None else f' and v <= {b}'}) as b{a}" for a, b in BUCKETS)}
  from (select SnapshotId, abs(f - s) as v from {_DAYS} where f > 0 or s > 0) group by 1""")
def variance_buckets(t):
    """AG27 counts of absolute differences by bucket."""
    v = F.abs(F.col("f") - F.col("s"))
    return _days(t).where("f > 0 or s > 0").groupBy("SnapshotId").agg(*[F.count_if((v >= a) if b is None else v.between(a, b)).alias(f"b{a}") for a,
        b in BUCKETS])


@query(f"""select Category, ForecastName, count(*) as n, sum(q) as Forecast, sum(s) as Actual, round(coalesce(sum(abs(q - s)) / nullif(sum(s), 0), 0), 6)
  as WAPE, round(coalesce((sum(q) - sum(s)) / nullif(sum(s), 0), 0), 6) as Bias
  from (select Category, s, unnest(['whole', 'half']) as ForecastName, unnest([f, f / 2]) as q from {_DAYS}) group by all""")
def segment_metrics(t):
    """AG25, AG29 and AG52 metrics of each forecast column by category; ratios are 0 without any actual."""
    rows = _days(t).withColumn("half", F.col("f") / 2).withColumnRenamed("f", "whole").select("Category", "s", "whole", "half").unpivot(["Category", "s"],
        ["whole", "half"], "ForecastName", "q")
    actual = F.sum("s")
    return rows.groupBy("Category", "ForecastName").agg(F.count("*").alias("n"), F.sum("q").alias("Forecast"), actual.alias("Actual"),
        F.round(ratio_or_zero(F.sum(F.abs(F.col("q") - F.col("s"))), actual), 6).alias("WAPE"),
            F.round(ratio_or_zero(F.sum("q") - actual, actual), 6).alias("Bias"))


@query(f"""select Period, count(*) as n, count(distinct SKU) as skus, sum(f) as Forecast, sum(s) as Actual, sum(abs(f - s)) as AbsError from (select *,
  unnest([x for x in ['holdout', case when date '1998-11-20' - ForecastDate < 7 then 'last_7_days' end, case when date '1998-11-20' - ForecastDate < 28
  then 'last_28_days' end,
  case when ForecastDate >= date '1998-01-01' then 'year_to_date' end, strftime(ForecastDate, '%Y-%m')] if x is not null]) as Period from {_DAYS}
  where ForecastDate between date '1998-01-01' and date '1998-11-20') group by 1""")
def period_slices(t):
    """AG26 one pass over all periods; months are clipped to the holdout."""
    # dealt by SKU and day once: sums, join and the periods of a row stay in those partitions
    lines = t.dealt(t.forecast_lines.select("SnapshotId", "SKU", "ForecastDate", "ForecastQty"), "SKU", "ForecastDate")
    ahead = lines.groupBy("SnapshotId", "SKU", "ForecastDate").agg(F.sum("ForecastQty").alias("ForecastQty"))
    rows = G.by_period(_with_sold(t, ahead), "ForecastDate", "1998-01-01", "1998-11-20")
    return rows.groupBy("Period").agg(F.count("*").alias("n"), F.countDistinct("SKU").alias("skus"), F.sum("f").alias("Forecast"),
        F.sum("s").alias("Actual"), F.sum(F.abs(F.col("f") - F.col("s"))).alias("AbsError"))


@query(f"select ForecastDayOffset, count(*) as n, sum(f) as Forecast, sum(s) as Actual, sum(abs(f - s)) as AbsError, count(*) filter (s > 0) as Sold from {_DAYS} group by 1")
def day_offset_scores(t):
    """SC19 scores by day of the window."""
    return _days(t).groupBy("ForecastDayOffset").agg(F.count("*").alias("n"), F.sum("f").alias("Forecast"), F.sum("s").alias("Actual"),
        F.sum(F.abs(F.col("f") - F.col("s"))).alias("AbsError"), F.count_if(F.col("s") > 0).alias("Sold"))


@query("""select o.SKU, o.ActualDate as Origin, h as Horizon, o.SoldUnits as OriginUnits, coalesce(a.SoldUnits, 0) as TargetUnits,
  dayofweek(o.ActualDate + cast(h as int)) as TargetWeekday from actual_sku_day o cross join (select unnest([1, 7, 14]) as h) left
  join actual_sku_day a on a.SKU = o.SKU and a.ActualDate = o.ActualDate + cast(h as int)""")
def horizon_frame(t):
    """FC20 training rows: each origin with its targets at several horizons; calendar columns are the target's."""
    origins = t.actual_sku_day.select("SKU", F.col("ActualDate").alias("Origin"), F.col("SoldUnits").alias("OriginUnits"),
        F.explode(F.array(*map(F.lit, (1, 7, 14)))).alias("Horizon")).withColumn("_day", F.date_add("Origin", F.col("Horizon")))
    targets = t.actual_sku_day.select("SKU", F.col("ActualDate").alias("_day"), F.col("SoldUnits").alias("_units"))
    rows = origins.join(targets, ["SKU", "_day"], "left")
    return rows.select("SKU", "Origin", "Horizon", "OriginUnits", F.coalesce("_units", F.lit(0.0)).alias("TargetUnits"),
        (F.dayofweek("_day") - 1).alias("TargetWeekday"))
