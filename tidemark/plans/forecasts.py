"""Queries of forecast construction, allocation, scoring and policies."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import allocation as A
from tidemark.operators import category as K
from tidemark.operators import joins as J
from tidemark.operators import scoring as C
from tidemark.operators import windows as W
from tidemark.plans.registry import query

_ALLOC = """select SnapshotId, SKU, w, total, (fl + case when total > 0 and row_number() over (partition by SnapshotId order by round(share - fl, 9) desc,
  SKU) <= total - sum(fl) over (partition by SnapshotId) then 1 else 0 end)::bigint as units from
  (select *, w / sum(w) over (partition by SnapshotId) * total as share, floor(round(w / sum(w) over (partition by SnapshotId) * total, 9)) as fl
  from (select SnapshotId, SKU, sum(ForecastQty) as w, (1000 + 37 * ascii(substr(SnapshotId, 4, 1)))::bigint as total from forecast_sku_day group by all))"""


@query(_ALLOC)
def largest_remainder(t):
    """FC1, WN8 (totals of a group on each row) and WN10 largest-remainder allocation; every total is met."""
    rows = t.forecast_sku_day.groupBy("SnapshotId", "SKU").agg(F.sum("ForecastQty").alias("w")).withColumn("total",
        (1000 + 37 * F.ascii(F.substring("SnapshotId", 4, 1))).cast("long"))
    return A.allocate(rows, ["SnapshotId"], "w", "total", ["SKU"], "units").select("SnapshotId", "SKU", "w", "total", "units")


@query("""with s as (select ForecastDate, SKU, sum(ForecastQty) as f from forecast_sku_day group by all having sum(ForecastQty) > 0), d as (select ActualDate
  as ForecastDate, round_even(sum(SoldUnits), 0) as total from actual_sku_day group by 1), x as (select s.*, total, f / sum(f)
  over (partition by ForecastDate) * total as share from s join d using (ForecastDate)), y as (select *, floor(round(share, 9)) as fl from x)
  select ForecastDate, SKU, (fl + case when row_number() over (partition by ForecastDate order by round(share - fl, 9) desc, SKU) <= total - sum(fl)
  over (partition by ForecastDate) then 1 else 0 end)::bigint as units from y""")
def anchored_candidate(t):
    """FC2 and FC12 one candidate's shape in another's daily totals."""
    shape = t.forecast_sku_day.groupBy("ForecastDate", "SKU").agg(F.sum("ForecastQty").alias("f"))
    totals = t.actual_sku_day.select(F.col("ActualDate").alias("ForecastDate"), "SoldUnits")
    return A.anchor(shape, totals, "ForecastDate", "f", "SoldUnits", ["SKU"], "units").select("ForecastDate", "SKU", "units")


_BY_CATEGORY = """with p as (select date_trunc('month', Date)::date as Month, sum(PlanUnits)::bigint as total from planner_daily group by 1),
  w as (select SKU, Category, sum(SoldUnits) as w from actual_sku_day join dim_product using (SKU) group by all), c as (select Category, sum(w) as w from w
  group by 1),
  x as (select Month, Category, total, c.w / sum(c.w) over (partition by Month) * total as share from p cross join c), y as (select *, floor(round(share, 9))
  as fl from x),
  u as (select Month, Category, fl + case when row_number() over (partition by Month order by round(share - fl, 9) desc, Category) <= total - sum(fl)
  over (partition by Month) then 1 else 0 end as units from y),
  v as (select Month, u.Category, SKU, units, w.w / sum(w.w) over (partition by Month, u.Category) * units as share from u join w using (Category)), z
  as (select *, floor(round(share, 9)) as fl from v),
  r as (select Month, Category, SKU, (fl + case when units > 0 and row_number() over (partition by Month, Category order by round(share - fl, 9) desc,
  SKU) <= units - sum(fl) over (partition by Month, Category) then 1 else 0 end)::bigint as Units from z)
  """


def _by_category(t):
    plan = t.planner_daily.groupBy(F.trunc("Date", "month").alias("Month")).agg(F.sum("PlanUnits").cast("long").alias("total"))
    weights = t.actual_sku_day.groupBy("SKU").agg(F.sum("SoldUnits").alias("w")).join(t.dim_product.select("SKU", "Category"), "SKU")
    return plan, A.by_category(plan, weights, "Month", "total", "Category", "SKU", "w", "Units")


@query(_BY_CATEGORY + "select Month, Category, SKU, Units from r where Units > 0")
def category_allocation(t):
    """FC9 and FC10 a month's total to categories and then to SKUs."""
    return _by_category(t)[1].where("Units > 0")


@query(_BY_CATEGORY + "select Month, sum(Units)::bigint as units, any_value(total) as plan, count(*) filter (Units < 0) as below, true as exact from r join p using (Month) group by 1")
def category_allocation_totals(t):
    """SC18 what is allotted is the plan's total and nothing is below 0."""
    plan, rows = _by_category(t)
    sums = rows.groupBy("Month").agg(F.sum("Units").alias("units"), F.count_if(F.col("Units") < 0).alias("below"))
    return sums.join(plan, "Month").select("Month", "units", F.col("total").alias("plan"), "below", (F.col("units") == F.col("total")).alias("exact"))


_SCORES = """with c as (select 'forecast' as Candidate, SnapshotId, SKU, sum(ForecastQty) as f from forecast_sku_day group by all union all select 'half',
  SnapshotId, SKU, sum(ForecastQty) / 2 from forecast_sku_day group by all union all
    select 'recent', v.SnapshotId, a.SKU, sum(a.SoldUnits) / 4 from vintages v join actual_sku_day a on a.ActualDate between v.ForecastStartDate - 56
  and v.ForecastStartDate - 1 group by all),
  a as (select v.SnapshotId, a.SKU, sum(a.SoldUnits) as s from vintages v join actual_sku_day a on a.ActualDate between v.ForecastStartDate
  and v.ForecastStartDate + 13 group by all), n as (select unnest(['forecast', 'half', 'recent']) as Candidate),
  r as (select coalesce(c.Candidate, b.Candidate) as Candidate, coalesce(c.SnapshotId, b.SnapshotId) as SnapshotId, coalesce(f, 0) as f, coalesce(s, 0) as s
  from c full join (select * from a cross join n) b on c.Candidate = b.Candidate and c.SnapshotId = b.SnapshotId and c.SKU = b.SKU),
  w as (select SnapshotId, Candidate, sum(f) as ForecastUnits, sum(s) as SoldUnits, sum(abs(f - s)) as AbsErrorUnits, sum(greatest(f - s, 0)) as OverUnits,
  sum(greatest(s - f, 0)) as UnderUnits, count(*) filter (f > 0) as ForecastedSKUs, count(*) filter (s > 0) as SoldSKUs,
    count(*) filter (f > 0 or s > 0) as UnionSKUs, sum(case when f > 0 and s > 0 then s else 0 end) as SoldUnitsWithForecast, count(*) filter (f <= 0 and s > 0)
  as ZeroForecastSoldSKUs, sum(case when f <= 0 then s else 0 end) as ZeroForecastSoldUnits, count(*) filter (f > 0 and s <= 0) as OverGeneratedSKUs,
    sum(case when f > 0 and s <= 0 then f else 0 end) as OverGeneratedUnits, count(*) filter (f <= 0 and s >= 10) as Missed10SKUs, sum(case when f <= 0
  and s >= 10 then s else 0 end) as Missed10Units, count(*) filter (f > 0 and s > 0) as UsedSKUs, sum(case when f > 0 and s > 0 then f else 0 end)
  as UnitsOnUsedSKUs, sum(f) - sum(s) as BiasUnits,
    round(sum(case when f <= 0 then s else 0 end) / nullif(sum(s), 0), 6) as ZeroForecastPct, round(count(*) filter (f > 0
  and s > 0) / nullif(count(*) filter (f > 0), 0), 6) as SKUUseRate, round(sum(case when f > 0 and s > 0 then f else 0 end) / nullif(sum(f), 0), 6)
  as UnitsOnUsedPct,
    round(sum(case when f > 0 and s <= 0 then f else 0 end) / nullif(sum(f), 0), 6) as ZeroDemandUnitPct, round(sum(abs(f - s)) / nullif(sum(s), 0), 6) as WAPE,
  round((sum(f) - sum(s)) / nullif(sum(s), 0), 6) as BiasPct, round(1 - sum(case when f <= 0 then s else 0 end) / nullif(sum(s), 0), 6) as CoveragePct from r
  group by all) """


def _with(sql: str) -> str:
    """The scores' tables come after the views."""
    return _SCORES.replace("with c as", "select * from (with c as", 1) + sql + ")"


CANDIDATES = {"forecast": "q", "half": "q / 2", "recent": "recent"}


def _score_detail(t):
    """A row for each window, candidate and SKU, with its forecast and sales: the picks are read once for both of their windows."""
    days = t.vintages.select("SnapshotId", "ForecastStartDate",
        F.explode(F.expr("sequence(date_sub(ForecastStartDate, 56), date_add(ForecastStartDate, 13))")).alias("ActualDate"))
    during = F.col("ActualDate") >= F.col("ForecastStartDate")
    picks = K.on_days(t.actual_sku_day.select("SKU", "ActualDate", "SoldUnits"), days).groupBy("SnapshotId", "SKU")
    picks = picks.agg((F.sum(F.when(~during, F.col("SoldUnits"))) / 4).alias("recent"), F.sum(F.when(during, F.col("SoldUnits"))).alias("sold"))
    ahead = t.forecast_sku_day.groupBy("SnapshotId", "SKU").agg(F.sum("ForecastQty").alias("q"))
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("Candidate"), F.expr(c).cast("double").alias("ForecastUnits")) for n, c in CANDIDATES.items()]))
    rows = ahead.join(picks, ["SnapshotId", "SKU"], "full").select("SnapshotId", "SKU", "sold", each.alias("c")).select("SnapshotId", "c.*", "SKU",
        F.col("sold").alias("SoldUnits"))
    return rows.where("ForecastUnits is not null or SoldUnits is not null").fillna(0.0, ["ForecastUnits", "SoldUnits"])


def _scores(t):
    return C.score_rows(_score_detail(t), ["SnapshotId", "Candidate"], "ForecastUnits", "SoldUnits")


@query(_with("select * from w"))
def window_scorecard(t):
    """SC1-SC3, SC24 and JN1: all windows and candidates in one plan."""
    return _scores(t)


@query(_with("select Candidate, count(*) as Windows, round(sum(AbsErrorUnits) / nullif(sum(SoldUnits), 0), 6) as PooledWAPE, round(avg(WAPE), 6) as MeanWAPE, round(median(WAPE), 6) as MedianWAPE from w group by 1"))
def candidate_summary(t):
    """SC4 summary over windows."""
    return C.summarise(_scores(t), "Candidate")


@query(_with("select w.Candidate, count(*) filter (w.WAPE < b.WAPE) as Wins, count(*) as Compared from w join w b on b.SnapshotId = w.SnapshotId and b.Candidate = 'forecast' group by 1"))
def leaderboard_wins(t):
    """SC5 wins against a reference."""
    return C.wins(_scores(t), "SnapshotId", "Candidate", "forecast")


@query(_with("select SnapshotId, Candidate as Winner, WAPE from w qualify row_number() over (partition by SnapshotId order by WAPE nulls last, abs(BiasPct), Candidate) = 1"))
def window_winners(t):
    """WN9 winner of each window."""
    return C.winners(_scores(t), "SnapshotId", "Candidate")


_PRIOR = """select p.SnapshotId, p.Candidate, w.AbsErrorUnits, w.SoldUnits from (select SnapshotId, case when r is null then 'recent' else Candidate end
  as Candidate from (select *, case when s > 0 then e / s end as r from (select SnapshotId, Candidate, sum(AbsErrorUnits) over x as e, sum(SoldUnits) over x
  as s from w window x as (partition by Candidate order by SnapshotId rows between {0} preceding and 1 preceding)))
  qualify row_number() over (partition by SnapshotId order by round(r, 9) nulls last, Candidate) = 1) p join w using (SnapshotId, Candidate)"""


@query(_with(_PRIOR.format("8")))
def rolling_policy(t):
    """WN14 and SC15 best candidate over the eight windows before."""
    return W.best_prior(_scores(t), "SnapshotId", "Candidate", "AbsErrorUnits", "SoldUnits", "recent", 8).select("SnapshotId", "Candidate", "AbsErrorUnits",
        "SoldUnits")


@query(_with(_PRIOR.format("unbounded")))
def expanding_policy(t):
    """SC15 best candidate over all windows before."""
    return W.best_prior(_scores(t), "SnapshotId", "Candidate", "AbsErrorUnits", "SoldUnits", "recent").select("SnapshotId", "Candidate", "AbsErrorUnits",
        "SoldUnits")


@query(_with("select SnapshotId, Candidate, q as Ratio, greatest(AbsErrorUnits + ForecastUnits - SoldUnits, 0) / 2 as Over, greatest(AbsErrorUnits - ForecastUnits + SoldUnits, 0) / 2 as Under, greatest(AbsErrorUnits + ForecastUnits - SoldUnits, 0) / 2 + q * (greatest(AbsErrorUnits - ForecastUnits + SoldUnits, 0) / 2) as Cost from w, (select unnest([0.5, 1.0, 2.0]::double[]) as q)"))
def cost_sweep(t):
    """SC13 and SC14 cost split over price ratios."""
    return C.cost_split(_scores(t), [0.5, 1.0, 2.0], ["SnapshotId", "Candidate"])


#: The grid of thresholds: 0.30 to 0.85 by 0.01.
TAUS = [round(0.30 + 0.01 * i, 2) for i in range(56)]
_PAIR = "(select f.SnapshotId, f.CoveragePct as gate, r.AbsErrorUnits as low, f.AbsErrorUnits as high, f.SoldUnits as sold from (select * from w where Candidate = 'forecast') f join (select * from w where Candidate = 'recent') r using (SnapshotId))"


def _pair(t):
    """A row for each window: the coverage as gate, the errors of the two candidates, what was sold."""
    named = {"gate": ("forecast", "CoveragePct"), "low": ("recent", "AbsErrorUnits"), "high": ("forecast", "AbsErrorUnits"), "sold": ("forecast", "SoldUnits")}
    return C.side_by_side(_scores(t), "SnapshotId", "Candidate", named).where("low is not null and high is not null")


@query(_with(f"""select tau as Tau, count(*) filter (gate < tau) as Triggered, round(sum(case when gate < tau then low else high end) / nullif(sum(sold), 0), 6)
  as PooledWAPE, round(avg(case when gate < tau then low else high end / nullif(sold, 0)), 6) as MeanWAPE,
  count(*) filter (case when gate < tau then low else high end / nullif(sold, 0) < high / nullif(sold, 0) - 1e-9) as Improved, count(*) filter (case
  when gate < tau then low else high end / nullif(sold, 0) > high / nullif(sold, 0) + 1e-9) as Worsened
  from {_PAIR}, (select unnest({TAUS}::double[]) as tau) group by 1"""))
def threshold_gate(t):
    """SC8 and SC9 threshold grid."""
    return C.gate_grid(_pair(t), TAUS, "gate", "low", "high", "sold")


@query("""with recursive r(d) as (select min(ForecastStartDate) from vintages union all select (select min(ForecastStartDate) from vintages
  where ForecastStartDate >= d + 20) from r where d is not null) select d as ForecastStartDate from r where d is not null""")
def spaced_origins(t):
    """WN16 origins that do not overlap."""
    return W.spaced(t.vintages, "ForecastStartDate", 20)


def _wide(t):
    """(SnapshotId, SKU, FD1 to FD14): lines are dealt by vintage and SKU once and summed to columns there; days without any are 0."""
    lines = t.dealt(t.forecast_lines.select("SnapshotId", "SKU", "ForecastDayOffset", "ForecastQty"), "SnapshotId", "SKU")
    day = lambda k: F.sum(F.when(F.col("ForecastDayOffset") == k, F.col("ForecastQty")))
    return lines.groupBy("SnapshotId", "SKU").agg(*[F.coalesce(day(k), F.lit(0.0)).alias(f"FD{k}") for k in range(1, 15)])


@query("""select SnapshotId, SKU, {0} from forecast_sku_day group by all""".format(", ".join(f"coalesce(sum(ForecastQty) filter (ForecastDayOffset = {k}), 0) as FD{k}" for k in range(1, 15))))
def wide_horizon(t):
    """FC22 long to wide; all 14 columns always."""
    return _wide(t)


_TIERS = """t as (select x.SnapshotId, x.SKU, x.q, case when x.q * 6.5 <= 20 then 'C' when x.q * 6.5 <= 40 then 'B' when x.q * 6.5 <= 100 then 'A' else 'AA' end
  as OldTier, d.Velocity as NewTier from (select SnapshotId, SKU, sum(ForecastQty) as q from forecast_sku_day group by all) x join dim_product d using (SKU))"""


def _tiers(t):
    rows = t.forecast_sku_day.groupBy("SnapshotId",
        "SKU").agg(F.sum("ForecastQty").alias("q")).join(t.dim_product.select("SKU", F.col("Velocity").alias("NewTier")), "SKU")
    return rows.withColumn("OldTier", S.velocity_tier(F.col("q") * 6.5))


@query(f"with {_TIERS} select SnapshotId, OldTier, NewTier, count(*) as n from t group by all")
def tier_transitions(t):
    """AG30 and PRJ14 tiers against each other."""
    return _tiers(t).groupBy("SnapshotId", "OldTier", "NewTier").agg(F.count("*").alias("n"))


@query(f"""with {_TIERS}, m as (select *, abs(list_position(['C', 'B', 'A', 'AA'], OldTier) - list_position(['C', 'B', 'A', 'AA'], NewTier)) as miss
  from t) select SnapshotId, count(*) as SKUs, round(avg((miss = 0)::int), 6) as Exact, round(avg((miss <= 1)::int), 6) as WithinOne, sum(q * miss) as UnitMiss,
  round(sum(q * miss) / nullif(sum(q), 0), 6) as WeightedMiss from m group by 1""")
def tier_accuracy(t):
    """AG31 how many tiers are right, within one, and how far units are off."""
    rank = lambda c: F.array_position(F.array(*map(F.lit, ("C", "B", "A", "AA"))), F.col(c))
    rows = _tiers(t).withColumn("miss", F.abs(rank("OldTier") - rank("NewTier")))
    share = lambda c: F.round(F.avg(c.cast("int")), 6)
    return rows.groupBy("SnapshotId").agg(F.count("*").alias("SKUs"), share(F.col("miss") == 0).alias("Exact"),
        share(F.col("miss") <= 1).alias("WithinOne"), F.sum(F.col("q") * F.col("miss")).alias("UnitMiss"),
            F.round(S.ratio_or_null(F.sum(F.col("q") * F.col("miss")), F.sum("q")), 6).alias("WeightedMiss"))


@query("""select SKU, ForecastDate, arg_max(ForecastQty, effective::varchar || SnapshotId) as units, arg_max(SnapshotId, effective::varchar || SnapshotId)
  as vintage
  from (select f.*, greatest(InferredFileDate + 1, v.ForecastStartDate) as effective from forecast_sku_day f join vintages v using (SnapshotId))
  where effective <= ForecastDate group by all""")
def operational_vintage(t):
    """SNK7 for each SKU and day the latest vintage whose first full day has come: a file holds from the day after it was made."""
    first = F.greatest(F.date_add("InferredFileDate", 1), "ForecastStartDate").alias("effective")
    rows = t.forecast_sku_day.select("SnapshotId", "SKU", "ForecastDate", "ForecastQty").join(t.vintages.select("SnapshotId", first),
        "SnapshotId").where("effective <= ForecastDate")
    best = F.max(F.struct("effective", "SnapshotId", "ForecastQty"))
    return rows.groupBy("SKU", "ForecastDate").agg(best.alias("b")).select("SKU", "ForecastDate", F.col("b.ForecastQty").alias("units"),
        F.col("b.SnapshotId").alias("vintage"))


@query("""select ForecastStartDate, SnapshotId, InferredFileDate from (select date_trunc('month', ForecastStartDate)::date as ForecastStartDate, SnapshotId,
  InferredFileDate from vintages) qualify row_number() over (partition by ForecastStartDate order by InferredFileDate nulls last, SnapshotId) = 1""")
def earliest_vintage(t):
    """WN17 the earliest vintage of each start (here of each month of starts); files without a date come last."""
    rows = t.vintages.select(F.trunc("ForecastStartDate", "month").alias("ForecastStartDate"), "SnapshotId", "InferredFileDate")
    return J.keep_one(rows, ["ForecastStartDate"], [F.asc_nulls_last("InferredFileDate"), "SnapshotId"])


@query("""select SKU, Item, Color, SoldUnits as units, row_number() over (order by SoldUnits desc, SKU) as rank from (select SKU, sum(SoldUnits) as SoldUnits
  from actual_sku_day group by 1) join dim_product using (SKU) qualify rank <= 100""")
def top_skus(t):
    """TK1 and TK2 the hundred largest."""
    rows = t.actual_sku_day.groupBy("SKU").agg(F.sum("SoldUnits").alias("units")).orderBy(F.desc("units"),
        "SKU").limit(100).join(t.dim_product.select("SKU", "Item", "Color"), "SKU")
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy().orderBy(F.desc("units"), "SKU"))).select("SKU", "Item", "Color", "units", "rank")
