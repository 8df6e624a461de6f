"""Queries of candidates at every origin and their adjustment: pools, planner scale, hybrids, caps, blends, reconciliation, policies."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import allocation as A
from tidemark.operators import category as K
from tidemark.operators import forecasting as P
from tidemark.operators import policies as B
from tidemark.operators import scoring as C
from tidemark.operators.joins import full_outer_zero
from tidemark.plans.forecasts import _score_detail, _scores, _with
from tidemark.plans.origins import _LIFT, _O, _R, _RATE, _SHAPE, _TARGET, _categories, _recent, origins_of
from tidemark.plans.registry import query
from tidemark.sources.sinks import kept


def _hamilton(source: str, group: str, weight: str, total: str, tie: str, out: str) -> str:
    """SQL of a largest-remainder allocation over the rows of ``source``."""
    share = f"{weight} / sum({weight}) over (partition by {group}) * {total}"
    return f"""(select * exclude (_s, _f), (_f + case when {total} > 0 and row_number() over (partition by {group} order by round(_s - _f, 9) desc,
  {tie}) <= {total} - sum(_f) over (partition by {group}) then 1 else 0 end)::bigint as {out}
      from (select *, floor(round(_s, 9)) as _f from (select *, case when {total} > 0 and sum({weight}) over (partition by {group}) > 0 then {share} else 0 end
  as _s from {source})))"""


_WEIGHT = "weight as (select Origin, SKU, Category, sum(SoldUnits) as w from r group by all)"
_POOL = f"""{_TARGET}, {_SHAPE}, {_WEIGHT}, x as (select t.Origin, t.Category, SKU, w, round_even(CategoryTarget, 0)::bigint as total from target t
  join weight w on w.Origin = t.Origin and w.Category = t.Category),
  y as (select Origin, Category, SKU, n from {_hamilton('x', 'Origin, Category', 'w', 'total', 'SKU', 'n')} where n > 0),
  h as (select y.*, d as ForecastDate, coalesce(weight, 0) as v from y join (select Origin as O, unnest(generate_series(Origin, Origin + 13,
  interval 1 day))::date as d from o) on O = y.Origin left join shape s on s.Origin = y.Origin and s.Category = y.Category and s.dow = isodow(d) - 1),
  h2 as (select * exclude (v), case when sum(v) over (partition by Origin, SKU) > 0 then v else 1.0 end as v from h),
  pool as (select Origin, SKU, ForecastDate, Units from {_hamilton('h2', 'Origin, SKU', 'v', 'n', 'ForecastDate', 'Units')} where Units > 0)"""


def _weights(recent):
    return recent.groupBy("Origin", "SKU", "Category").agg(F.sum("SoldUnits").alias("w"))


def _pool(t):
    recent, origins = _recent(t), origins_of(t)
    targets = K.targets(K.run_rate(recent), K.event_lift(t.actual_sku_day, origins, _categories(t)))
    rows = targets.withColumn("total", F.bround("CategoryTarget").cast("long")).join(_weights(recent), ["Origin", "Category"])
    totals = A.allocate(rows, ["Origin", "Category"], "w", "total", ["SKU"], "Total").select("Origin", "Category", "SKU", "Total")
    return P.spread_over_days(totals, K.weekday_shape(recent), origins)


@query(f"with {_POOL} select * from pool")
def category_pool(t):
    """FC7, FC9 and FC11 category targets to SKUs by recent weights, and to days by the category's weekdays."""
    return _pool(t)


@query(f"with {_POOL} select Origin, sum(Units)::bigint as Units, count(distinct SKU) as SKUs, min(ForecastDate) >= Origin and max(ForecastDate) < Origin + 14 as Inside, min(Units) >= 0 as NotNegative from pool group by 1")
def pool_guardrails(t):
    """SC18 totals, days inside the horizon, nothing below 0; the pool is built from days before each origin alone."""
    rows = _pool(t).groupBy("Origin").agg(F.sum("Units").alias("Units"), F.countDistinct("SKU").alias("SKUs"), F.min("ForecastDate").alias("a"),
        F.max("ForecastDate").alias("b"), (F.min("Units") >= 0).alias("NotNegative"))
    return rows.select("Origin", "Units", "SKUs", ((F.col("a") >= F.col("Origin")) & (F.col("b") < F.date_add("Origin", 14))).alias("Inside"), "NotNegative")


@query(f"""with {_RATE}, {_LIFT}, {_WEIGHT}, actual as (select Origin, SKU, sum(SoldUnits) as s from o join actual_sku_day on ActualDate between Origin
  and Origin + 13 group by all), total as (select Origin, round_even(sum(s), 0)::bigint as total from actual group by 1),
  mix as (select Origin, Category, 'recentmix' as Method, DailyRunRate as m from rate union all select Origin, Category, 'liftmix',
  DailyRunRate * coalesce(ShrunkLift, 1.0) from rate left join lift using (Origin, Category) union all select Origin, 'ALL', 'global', 1.0 from total),
  a1 as (select Origin, Method, Category, m, total from mix join total using (Origin) where m > 0), a2 as (select Origin, Method, Category, u
  from {_hamilton('a1', 'Origin, Method', 'm', 'total', 'Category', 'u')}),
  a3 as (select a2.Origin, Method, a2.Category, SKU, w, u from a2 join (select Origin, SKU, Category, w from weight union all select Origin, SKU, 'ALL', w
  from weight) w on w.Origin = a2.Origin and w.Category = a2.Category),
  a4 as (select Origin, Method, SKU, sum(f) as f from {_hamilton('a3', 'Origin, Method, Category', 'w', 'u', 'SKU', 'f')} group by all),
  b as (select coalesce(x.Origin, y.Origin) as Origin, coalesce(x.Method, y.Method) as Method, coalesce(f, 0) as f, coalesce(s, 0) as s from a4 x full
  join (select * from actual, (select unnest(['global', 'recentmix', 'liftmix']) as Method)) y on x.Origin = y.Origin and x.Method = y.Method and x.SKU = y.SKU)
  select Origin, Method, sum(f)::double as ForecastUnits, sum(s) as SoldUnits, round(sum(abs(f - s)) / nullif(sum(s), 0), 6) as WAPE from b group by all""")
def oracle_total_allocation(t):
    """SC17 three ways to allot the total that was really sold: globally, by the recent category mix, by the lifted mix."""
    recent, origins = _recent(t), origins_of(t)
    weights = _weights(recent)
    actual = K.on_days(t.actual_sku_day, K.days_of(origins, 0, 13)).groupBy("Origin", "SKU").agg(F.sum("SoldUnits").alias("s"))
    total = actual.groupBy("Origin").agg(F.bround(F.sum("s")).cast("long").alias("total"))
    rates = K.run_rate(recent).join(K.event_lift(t.actual_sku_day, origins, _categories(t)), ["Origin", "Category"], "left")
    ways = F.array(F.struct(F.lit("recentmix").alias("Method"), F.col("DailyRunRate").alias("m")),
        F.struct(F.lit("liftmix").alias("Method"), (F.col("DailyRunRate") * F.coalesce("ShrunkLift", F.lit(1.0))).alias("m")))
    mix = rates.select("Origin", "Category", F.explode(ways).alias("x")).select("Origin", "Category",
        "x.*").unionByName(total.select("Origin", F.lit("ALL").alias("Category"), F.lit("global").alias("Method"), F.lit(1.0).alias("m")))
    cats = A.allocate(mix.where("m > 0").join(total, "Origin"), ["Origin", "Method"], "m", "total", ["Category"], "u").select("Origin", "Method",
        "Category", "u")
    both = weights.unionByName(weights.withColumn("Category", F.lit("ALL")))
    skus = A.allocate(cats.join(both, ["Origin", "Category"]), ["Origin", "Method", "Category"], "w", "u", ["SKU"], "f").groupBy("Origin", "Method",
        "SKU").agg(F.sum("f").cast("double").alias("f"))
    sold = actual.withColumn("Method", F.explode(F.array(*map(F.lit, ("global", "recentmix", "liftmix")))))
    rows = full_outer_zero(skus, sold, ["Origin", "Method", "SKU"], ["f", "s"]).groupBy("Origin", "Method")
    return rows.agg(F.sum("f").alias("ForecastUnits"), F.sum("s").alias("SoldUnits"),
        F.round(S.ratio_or_null(F.sum(F.abs(F.col("f") - F.col("s"))), F.sum("s")), 6).alias("WAPE"))


@query("""with d as (select SnapshotId, SKU, ForecastDate, sum(ForecastQty) as q from forecast_sku_day group by all), x as (select *, sum(q)
  over (partition by SnapshotId, ForecastDate) as now from d left join (select Date as ForecastDate, PlanUnits from planner_daily) using (ForecastDate)),
  y as (select *, round(greatest(q, 0) * case when PlanUnits > 0 and now > 0 then PlanUnits / now else 1.0 end, 9) as raw from x), z as (select *, floor(raw)
  as fl, greatest(round_even(round(sum(raw) over (partition by SnapshotId, ForecastDate), 6), 0), sum(floor(raw)) over (partition by SnapshotId, ForecastDate))
  as total from y)
  select SnapshotId, SKU, ForecastDate, q as OriginalUnits, (fl + case when row_number() over (partition by SnapshotId, ForecastDate order by round(raw - fl,
  9) desc, SKU) <= total - sum(fl) over (partition by SnapshotId, ForecastDate) then 1 else 0 end)::bigint as ScaledUnits from z""")
def planner_scaled(t):
    """FC5 each vintage's days scaled to the planner's totals, in whole units."""
    lines = t.dealt(t.forecast_lines.select("SnapshotId", "SKU", "ForecastDate", "ForecastQty"), "SnapshotId", "SKU", "ForecastDate")
    daily = lines.groupBy("SnapshotId", "SKU", "ForecastDate").agg(F.sum("ForecastQty").alias("q"))
    plan = t.planner_daily.select(F.col("Date").alias("ForecastDate"), "PlanUnits")
    rows = daily.join(plan, "ForecastDate", "left")
    return P.planner_scaled(rows, rows.select("SnapshotId", "ForecastDate").distinct(), ["SnapshotId", "ForecastDate"], "SKU", "q", "PlanUnits",
        "ScaledUnits").select("SnapshotId", "SKU", "ForecastDate", F.col("q").alias("OriginalUnits"), "ScaledUnits")


_TWO = """f as (select SnapshotId, SKU, sum(ForecastQty) as q from forecast_sku_day group by all), v as (select SnapshotId, SKU, sum(SoldUnits) / 4 as q
  from vintages join actual_sku_day on ActualDate between ForecastStartDate - 56 and ForecastStartDate - 1 group by all),
  h as (select SnapshotId, SKU, q from f where q >= 30 union all select SnapshotId, SKU, q * 0.5 from v anti join (select SnapshotId, SKU from f
  where q >= 30) using (SnapshotId, SKU) where q > 0)"""


def _two(t):
    """Units of the vintage, and of recent demand over 14 days, by window and SKU."""
    rows = _score_detail(t).where("ForecastUnits > 0 and Candidate <> 'half'").select("SnapshotId", "SKU", "Candidate", F.col("ForecastUnits").alias("q"))
    rows = kept(rows, "two")  # read for each of them
    return rows.where("Candidate = 'forecast'").drop("Candidate"), rows.where("Candidate = 'recent'").drop("Candidate")


def _hybrid(t):
    f, v = _two(t)
    return P.hybrid(f, v, ["SnapshotId"], "SKU", "q", 30.0, 0.5)


@query(f"with {_TWO} select * from h")
def hybrid_forecast(t):
    """FC14 and PRJ41 a forecast above a threshold, half of recent demand for other SKUs; JN15 membership."""
    return _hybrid(t)


@query(f"with {_TWO}, c as (select SnapshotId, sum(q) * 1.1 as cap from v group by 1) select SnapshotId, SKU, round(q * case when s > cap and cap > 0 then cap / s else 1 end, 6) as q from (select *, sum(q) over (partition by SnapshotId) as s from h) left join c using (SnapshotId)")
def volume_cap(t):
    """FC15 the hybrid scaled down to 1.1 times recent demand."""
    totals = _two(t)[1].groupBy("SnapshotId").agg(F.sum("q").alias("total"))
    return P.volume_capped(_hybrid(t), totals, ["SnapshotId"], "q", "total", 1.1).withColumn("q", F.round("q", 6))


@query(f"""with {_TWO}, c as (select SnapshotId, Category, sum(q) as other from f join dim_product using (SKU) group by all), m as (select v.*, Category, sum(q)
  over (partition by SnapshotId, Category) as own from v join dim_product using (SKU))
  select * from (select SnapshotId, SKU, Category, greatest(round_even(round(q * case when other > 0 and own > 0 then other / own else 1 end, 9), 0), 0) as q
  from m left join c using (SnapshotId, Category)) where q > 0""")
def category_blend(t):
    """FC16 recent demand scaled to the vintage's category totals."""
    f, v = (x.join(_categories(t), "SKU") for x in _two(t))
    return P.group_scaled(v, f, ["SnapshotId", "Category"], "q", "q").select("SnapshotId", "SKU", "Category", "q")


@query(f"""with {_TWO}, m as (select SnapshotId, SKU, Category, substr(Category, 1, 3) as Grp, coalesce(v.q, 0) as base, coalesce(f.q, 0) as aim from v full
  join f using (SnapshotId, SKU) join dim_product using (SKU)),
  k as (select *, sum(base) over w1 as b1, sum(aim) over w1 as a1, sum(base) over w2 as b2, sum(aim) over w2 as a2, sum(base) over w3 as b3, sum(aim) over w3
  as a3 from m window w1 as (partition by SnapshotId), w2 as (partition by SnapshotId, Grp), w3 as (partition by SnapshotId, Category))
  select SnapshotId, SKU, round(base * case when b1 > 0 then least(greatest(a1 / b1, 0.2), 5) else 1 end, 6) as TopDown, round(base * case when b2 > 0
  then least(greatest(a2 / b2, 0.2), 5) else 1 end, 6) as MiddleOut, round(base * case when b3 > 0 then least(greatest((0.5 * a3 + 0.5 * b3) / b3, 0.2), 5)
  else 1 end, 6) as Blend from k""")
def reconciliation(t):
    """FC17 top-down, middle-out and half-way reconciliation with clipped factors."""
    f, v = _two(t)
    rows = v.withColumnRenamed("q", "base").join(f.withColumnRenamed("q", "aim"), ["SnapshotId", "SKU"], "full").fillna(0.0,
        ["base", "aim"]).join(_categories(t), "SKU").withColumn("Grp", F.substring("Category", 1, 3))
    levels = {"TopDown": (["SnapshotId"], 1.0), "MiddleOut": (["SnapshotId", "Grp"], 1.0), "Blend": (["SnapshotId", "Category"], 0.5)}
    return P.reconciled_levels(rows, "base", "aim", levels).select("SnapshotId", "SKU", *[F.round(c, 6).alias(c) for c in levels])


_BREAK = """(select x.*, v.ForecastStartDate as Origin, case when InferredFileDate < ForecastStartDate then 'clean_frozen'
  when InferredFileDate = ForecastStartDate then 'same_day' else 'late' end as Frozen,
  max(x.CoveragePct) filter (x.Candidate = 'forecast') over (partition by SnapshotId) as RawCov, max(x.WAPE) filter (x.Candidate = 'forecast')
  over (partition by SnapshotId) as RawWAPE from w x join vintages v using (SnapshotId))"""


@query(_with(f"""select Kind, Value, Candidate, count(distinct Origin) as Windows, round(avg(WAPE), 3) as MeanWAPE, round(avg(CoveragePct) * 100, 1)
  as MeanCoverage, round(avg((WAPE < RawWAPE)::int) * 100, 1) as WinRate from
  (select *, unnest(['year', 'regime', 'freeze']) as Kind, unnest([year(Origin)::varchar, case when RawCov >= 0.75 then 'healthy' else 'degraded' end, Frozen])
  as Value from {_BREAK}) group by all"""))
def score_breakdowns(t):
    """SC6 by year, by regime in hindsight (coverage of at least 0.75) and by freeze class."""
    ref = lambda c: F.max(F.when(F.col("Candidate") == "forecast", F.col(c))).over(Window.partitionBy("SnapshotId"))
    rows = _scores(t).withColumns({"cov": ref("CoveragePct"), "raw": ref("WAPE")}).join(t.vintages.select("SnapshotId",
        F.col("ForecastStartDate").alias("Origin"), "InferredFileDate"), "SnapshotId")
    kinds = {"year": F.year("Origin").cast("string"), "regime": F.when(F.col("cov") >= 0.75, "healthy").otherwise("degraded"),
        "freeze": S.freeze_class(F.col("InferredFileDate"), F.col("Origin"))}
    rows = rows.withColumn("k", F.explode(F.array(*[F.struct(F.lit(n).alias("Kind"), c.alias("Value")) for n, c in kinds.items()])))
    win = F.coalesce(F.col("WAPE") < F.col("raw"), F.lit(False)).cast("int")
    return rows.groupBy("k.Kind", "k.Value", "Candidate").agg(F.countDistinct("Origin").alias("Windows"), F.round(F.avg("WAPE"), 3).alias("MeanWAPE"),
        F.round(F.avg("CoveragePct") * 100, 1).alias("MeanCoverage"), F.round(F.avg(win) * 100, 1).alias("WinRate"))


@query(f"""with {_O}, c as (select ForecastStartDate as Origin, SKU, sum(ForecastQty) as q, any_value(case when Velocity = 'C' then 'UNKNOWN'
  else f.Category end) as Category from forecast_sku_day f join dim_product using (SKU) group by all),
  m as (select Origin, sum(q) filter (Category <> 'UNKNOWN') / sum(q) as mapped from c group by 1),
  p as (select Origin, sum(SoldUnits) filter (c.q > 0) / sum(SoldUnits) as proxy from o join actual_sku_day a on ActualDate between Origin - 28 and Origin - 1
  left join c using (Origin, SKU) group by 1)
  select Origin, round(coalesce(mapped, 0), 6) as Mapped, mapped >= 0.75 as Included, round(coalesce(proxy, 0), 6) as Proxy from m left join p using (Origin)""")
def window_inclusion(t):
    """SC7 share of forecast units with a category (slow movers have none here), and the share of trailing demand on forecast SKUs."""
    cats = t.dim_product.select("SKU", F.when(F.col("Velocity") != "C", F.col("Category")).alias("Mapped"))
    ahead = t.forecast_sku_day.groupBy(F.col("ForecastStartDate").alias("Origin"), "SKU").agg(F.sum("ForecastQty").alias("q"))
    return B.inclusion(ahead, cats, t.actual_sku_day, least=0.75)


_BRAKE = [(1.0, "forecast"), (0.5, "half")]


@query(_with("""select SnapshotId, case when fc is null then 'forecast' else case when pick = 'half' and covh < 0.6 and covf >= 0.6 then 'forecast'
  when (case pick when 'half' then covh else covf end) < 0.6 and covr >= 0.6 and not (covh >= 0.6 and pick = 'half') and not covf >= 0.6 then 'recent'
  else pick end end as Candidate, round(ratio, 6) as Ratio
  from (select *, case when ratio is null then 'forecast' when greatest(0.4, least(ratio, 1.0)) >= 1.0 then 'forecast' else 'half' end as pick
  from (select SnapshotId, sum(fq) over p as fc, case when sum(fq) over p > 0 then sum(sq) over p / sum(fq) over p end as ratio, coalesce(avg(cf) over p, 0)
  as covf, coalesce(avg(ch) over p, 0) as covh, coalesce(avg(cr) over p, 0) as covr
    from (select SnapshotId, sum(ForecastUnits) filter (Candidate = 'forecast') as fq, sum(SoldUnits) filter (Candidate = 'forecast') as sq,
  max(CoveragePct) filter (Candidate = 'forecast') as cf, max(CoveragePct) filter (Candidate = 'half') as ch, max(CoveragePct) filter (Candidate = 'recent')
  as cr from w group by 1)
    window p as (order by SnapshotId rows between 4 preceding and 1 preceding)))"""))
def recency_brake(t):
    """SC16 and WN15 the cap that the last four windows ask for, loosened where its coverage was too low."""
    named = {n: ("forecast", c) for n,
        c in (("fq", "ForecastUnits"), ("sq", "SoldUnits"))} | {f"cov_{c}": (c, "CoveragePct") for c in ("forecast", "half", "recent")}
    windows = C.side_by_side(_scores(t), "SnapshotId", "Candidate", named)
    return B.recency_brake(windows, "SnapshotId", "fq", "sq", _BRAKE, "recent", last=4, least_cap=0.4, least_coverage=0.6)


@query(_with("""select Candidate, count(distinct SnapshotId) as Windows, sum(SoldUnits) as Actual, sum(ForecastUnits) as Forecast, round(avg(BiasPct), 6)
  as MeanBias, round(avg(abs(BiasPct)), 6) as MeanAbsBias, round(avg(WAPE), 6) as MeanWAPE, round(median(WAPE), 6) as MedianWAPE, count(*) filter (k = 1)
  as WindowWins
  from (select *, row_number() over (partition by SnapshotId order by WAPE nulls last, abs(BiasPct), Candidate) as k from w) group by 1"""))
def rolling_origin_summary(t):
    """SC20 means over windows, and in how many each candidate is the best."""
    best = F.row_number().over(Window.partitionBy("SnapshotId").orderBy(F.asc_nulls_last("WAPE"), F.abs("BiasPct"), "Candidate"))
    mean = lambda c: F.round(F.avg(c), 6)
    return _scores(t).withColumn("k", best).groupBy("Candidate").agg(F.countDistinct("SnapshotId").alias("Windows"), F.sum("SoldUnits").alias("Actual"),
        F.sum("ForecastUnits").alias("Forecast"), mean("BiasPct").alias("MeanBias"), mean(F.abs("BiasPct")).alias("MeanAbsBias"),
            mean("WAPE").alias("MeanWAPE"), F.round(F.median("WAPE"), 6).alias("MedianWAPE"), F.count_if(F.col("k") == 1).alias("WindowWins"))


@query(_with("""select r as Ratio, arg_min(Candidate, (round(cost, 6), Candidate)) as Winner, round(max(cost) filter (Candidate = 'forecast'), 6)
  as CostForecast, round(max(cost) filter (Candidate = 'recent'), 6) as CostRecent
  from (select r, Candidate, sum(OverUnits) + r * sum(UnderUnits - ZeroForecastSoldUnits) + 1.5 * r * sum(ZeroForecastSoldUnits) as cost from w,
  (select unnest([0.25, 0.5, 1, 2, 4, 8]::double[]) as r) where Candidate in ('forecast', 'recent') group by r, Candidate) group by 1"""))
def break_even(t):
    """SC14 which of two candidates costs less at each price of a shortfall; uncovered demand costs half as much again."""
    return B.break_even(_scores(t).where("Candidate in ('forecast', 'recent')"), "Candidate", [0.25, 0.5, 1.0, 2.0, 4.0, 8.0], zero=1.5,
        named={"CostForecast": "forecast", "CostRecent": "recent"})


@query(_with("select SnapshotId, Candidate, AbsErrorUnits, SoldUnits from w where Candidate = 'half'"))
def fixed_policy(t):
    """SC15 the same candidate in every window."""
    return _scores(t).where("Candidate = 'half'").select("SnapshotId", "Candidate", "AbsErrorUnits", "SoldUnits")


@query("""select Candidate, SnapshotId, sum(f) as ForecastUnits, sum(s) as SoldUnits, round(sum(abs(f - s)) / nullif(sum(s), 0), 6) as WAPE
  from (select 'forecast' as Candidate, coalesce(a.SnapshotId, b.SnapshotId) as SnapshotId, coalesce(f, 0) as f, coalesce(s, 0) as s from (select SnapshotId,
  SKU, sum(ForecastQty) as f from forecast_sku_day where ForecastDayOffset <= 7 group by all) a
  full join (select SnapshotId, SKU, sum(SoldUnits) as s from vintages join actual_sku_day on ActualDate between ForecastStartDate and ForecastStartDate + 6
  group by all) b on a.SnapshotId = b.SnapshotId and a.SKU = b.SKU) group by all""")
def partial_horizon(t):
    """SC22 scores of the first seven days alone."""
    ahead = t.forecast_sku_day.where("ForecastDayOffset <= 7").groupBy("SnapshotId", "SKU").agg(F.sum("ForecastQty").alias("f"))
    days = t.vintages.select("SnapshotId", F.explode(F.sequence(F.col("ForecastStartDate"), F.date_add("ForecastStartDate", 6))).alias("ActualDate"))
    sold = t.actual_sku_day.join(days, "ActualDate").groupBy("SnapshotId", "SKU").agg(F.sum("SoldUnits").alias("s"))
    rows = full_outer_zero(ahead, sold, ["SnapshotId", "SKU"], ["f", "s"]).groupBy(F.lit("forecast").alias("Candidate"), "SnapshotId")
    return rows.agg(F.sum("f").alias("ForecastUnits"), F.sum("s").alias("SoldUnits"),
        F.round(S.ratio_or_null(F.sum(F.abs(F.col("f") - F.col("s"))), F.sum("s")), 6).alias("WAPE"))


@query("""select m as Month, a as ActualUnits, w as MonitoringUnits, a - w as Delta from (select date_trunc('month', ActualDate)::date as m, sum(SoldUnits) as a
  from actual_sku_day group by 1) full join (select date_trunc('month', PickDate)::date as m, sum(Units) as w from work_lines where LocProfile like 'Picking%'
  group by 1) using (m)""")
def reconciliation_delta(t):
    """SC23 actual against monitored units."""
    a = t.actual_sku_day.groupBy(F.trunc("ActualDate", "month").alias("Month")).agg(F.sum("SoldUnits").alias("ActualUnits"))
    w = t.work_lines.where(F.col("LocProfile").startswith("Picking")).groupBy(F.trunc("PickDate",
        "month").alias("Month")).agg(F.sum("Units").alias("MonitoringUnits"))
    return a.join(w, "Month", "full").withColumn("Delta", F.col("ActualUnits") - F.col("MonitoringUnits"))
