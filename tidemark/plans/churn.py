"""Queries of vintages against each other and against live stock: churn, stability, cohorts, slot tiers, accuracy by snapshot."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import joins as J
from tidemark.operators.joins import full_outer_zero
from tidemark.plans.registry import query

_SNAP = """snap as (select k, SnapshotId, SKU, FD14, Velocity, Category || '-' || Velocity as SlotTier, case Velocity when 'AA' then 4 when 'A' then 3 when 'B'
  then 2 else 1 end as Rank, Grp from
  (select v.k, f.SnapshotId, f.SKU, sum(ForecastQty) as FD14, case when sum(ForecastQty) * 6.5 <= 20 then 'C' when sum(ForecastQty) * 6.5 <= 40 then 'B'
  when sum(ForecastQty) * 6.5 <= 100 then 'A' else 'AA' end as Velocity, any_value(f.Category) as Category, any_value(substr(f.Category, 1, 3)) as Grp
  from forecast_sku_day f join vintages v using (SnapshotId) group by all))"""
_PAIR = f"{_SNAP}, pair as (select o.k as K, o.SKU, o.FD14 as OldUnits, n.FD14 as NewUnits, o.Velocity as OldVelocity, n.Velocity as NewVelocity, o.SlotTier as OldTier, n.SlotTier as NewTier, n.Rank - o.Rank as Delta from snap o join snap n on n.SKU = o.SKU and n.k = o.k + 1)"


def _snapshots(t):
    """(k, SnapshotId, SKU, FD14, Velocity, SlotTier, Rank): SRC24 each vintage by SKU with its total and tiers."""
    rows = t.forecast_sku_day.groupBy("SnapshotId", "SKU", "Category").agg(F.sum("ForecastQty").alias("FD14")).join(t.vintages.select("SnapshotId", "k"),
        "SnapshotId")
    rows = rows.withColumn("Velocity", S.velocity_tier(F.col("FD14") * 6.5))
    rank = F.array_position(F.array(*map(F.lit, ("C", "B", "A", "AA"))), F.col("Velocity")).cast("int")
    return rows.select("k", "SnapshotId", "SKU", "FD14", "Velocity", F.concat_ws("-", "Category", "Velocity").alias("SlotTier"), rank.alias("Rank"))


def _pairs(t):
    """Each vintage and the next one, by SKU: JN13, by a window over the vintages of a SKU instead of a self join."""
    w = Window.partitionBy("SKU").orderBy("k")
    rows = _snapshots(t).withColumn("n", F.lead(F.struct("k", "FD14", "Velocity", "SlotTier", "Rank")).over(w)).where("n.k = k + 1")
    return rows.select(F.col("k").alias("K"), "SKU", F.col("FD14").alias("OldUnits"), F.col("n.FD14").alias("NewUnits"),
        F.col("Velocity").alias("OldVelocity"), F.col("n.Velocity").alias("NewVelocity"), F.col("SlotTier").alias("OldTier"),
            F.col("n.SlotTier").alias("NewTier"), (F.col("n.Rank") - F.col("Rank")).alias("Delta"))


@query(f"""with {_PAIR} select K, count(*) as Shared, count(*) filter (OldVelocity <> NewVelocity) as VelocityChanges,
  round(avg((OldVelocity <> NewVelocity)::int), 6) as ChangeRate, count(*) filter (OldTier <> NewTier) as TierChanges, count(*) filter (Delta > 0)
  as Promotions, count(*) filter (Delta < 0) as Demotions,
  count(*) filter (abs(Delta) > 1) as Jumps, count(*) filter (OldVelocity = 'AA' and NewVelocity = 'C') as AAToC, count(*) filter (OldVelocity = 'C'
  and NewVelocity = 'AA') as CToAA, count(*) filter (OldVelocity in ('AA', 'A') and NewVelocity = 'C') as HighToC, sum(OldUnits) as OldUnits, sum(NewUnits)
  as NewUnits, round(avg((abs(Delta) >= 3)::int), 6) as ThreeRankShare from pair group by 1""")
def vintage_churn(t):
    """AG33 churn metrics of each vintage and the next, JN14 and WN13 stability, AG53 shares of flags."""
    old, new, delta = F.col("OldVelocity"), F.col("NewVelocity"), F.col("Delta")
    count = lambda c, n: F.count_if(c).alias(n)
    return _pairs(t).groupBy("K").agg(
        F.count("*").alias("Shared"), count(old != new, "VelocityChanges"), F.round(F.avg((old != new).cast("int")), 6).alias("ChangeRate"),
            count(F.col("OldTier") != F.col("NewTier"), "TierChanges"), count(delta > 0, "Promotions"), count(delta < 0, "Demotions"),
                count(F.abs(delta) > 1, "Jumps"),
        count((old == "AA") & (new == "C"), "AAToC"), count((old == "C") & (new == "AA"), "CToAA"), count(old.isin("AA", "A") & (new == "C"), "HighToC"),
            F.sum("OldUnits").alias("OldUnits"), F.sum("NewUnits").alias("NewUnits"),
                F.round(F.avg((F.abs(delta) >= 3).cast("int")), 6).alias("ThreeRankShare"),
    )


@query(f"""with {_SNAP}, s as (select k, SlotTier, Velocity, count(*) as slots from snap group by all) select coalesce(o.k, n.k - 1) as K, coalesce(o.SlotTier,
  n.SlotTier) as SlotTier, coalesce(o.Velocity, n.Velocity) as Velocity, coalesce(o.slots, 0) as OldSlots, coalesce(n.slots, 0) as NewSlots, coalesce(n.slots,
  0) - coalesce(o.slots, 0) as Delta
  from s o full join s n on n.k = o.k + 1 and n.SlotTier = o.SlotTier""")
def slot_deltas(t):
    """AG34 slots that each vintage and the next ask for, by tier."""
    s = _snapshots(t).groupBy("k", "SlotTier", "Velocity").agg(F.count("*").alias("slots"))
    both = s.select(F.col("k").alias("K"), "SlotTier", "Velocity", F.col("slots").alias("o"),
        F.lit(0).alias("n")).unionByName(s.select((F.col("k") - 1).alias("K"), "SlotTier", "Velocity", F.lit(0).alias("o"), F.col("slots").alias("n")))
    rows = both.groupBy("K", "SlotTier", "Velocity").agg(F.sum("o").alias("OldSlots"), F.sum("n").alias("NewSlots"))
    return rows.withColumn("Delta", F.col("NewSlots") - F.col("OldSlots"))


_LIVE = f"""{_SNAP}, live as (select SKU, Location, LocProfile, sum(Units) as Qty, any_value(pk) as pk from work_lines where Location <> '' group by all), b
  as (select l.*, p.Category || '-' || case l.pk % 4 when 0 then 'AA' when 1 then 'A' when 2 then 'B' else 'C' end as Zone, o.SlotTier as OldTier, n.SlotTier
  as NewTier
  from live l join dim_product p using (SKU) left join (select * from snap where k = (select max(k) - 1 from snap)) o using (SKU)
  left join (select * from snap where k = (select max(k) from snap)) n using (SKU))"""


def _live(t):
    """Stock on the floor with the tiers of the two newest vintages: JN18; the zone's velocity is its suffix."""
    live = t.work_lines.where("Location <> ''").groupBy("SKU", "Location", "LocProfile").agg(F.sum("Units").alias("Qty"), F.first("pk").alias("pk"))
    velocity = F.element_at(F.array(*map(F.lit, ("AA", "A", "B", "C"))), (F.col("pk") % 4 + 1).cast("int"))
    live = live.join(t.dim_product.select("SKU", "Category"), "SKU").withColumn("Zone", F.concat_ws("-", "Category", velocity))
    snaps = _snapshots(t)
    back = snaps.agg(F.max("k")).scalar() - F.col("k")
    tiers = snaps.withColumn("_back", back).where("_back < 2").groupBy("SKU").agg(F.max(F.when(F.col("_back") == 1, F.col("SlotTier"))).alias("OldTier"),
        F.max(F.when(F.col("_back") == 0, F.col("SlotTier"))).alias("NewTier"))
    return live.join(tiers, "SKU", "left")


@query(f"""with {_LIVE}, c as (select *, coalesce(OldTier = Zone, false) as eo, coalesce(NewTier = Zone, false) as en, coalesce(OldTier <> NewTier, false) as ch
  from b)
  select Cohort, count(*) as Rows, count(distinct Location) as Locations, count(distinct SKU) as SKUs, sum(Qty) as Qty from (select *,
  unnest([x for x in ['live_scope', case when OldTier is not null and NewTier is not null then 'has_both' end, case when ch then 'tier_changed' end, case
  when eo and not en then 'would_lose' end, case when en and not eo then 'would_gain' end,
    case when eo then 'old_exact' end, case when en then 'new_exact' end, case when NewTier is null then 'no_new_forecast' end, case when OldTier is null
  and NewTier is not null then 'new_only' end] if x is not null]) as Cohort from c) group by 1""")
def live_cohorts(t):
    """AG35 nine overlapping cohorts of live stock, PRJ15 velocity from the zone, AG36 what has no forecast."""
    old, new, zone = F.col("OldTier"), F.col("NewTier"), F.col("Zone")
    no = lambda c: F.coalesce(c, F.lit(False))
    eo, en = no(old == zone), no(new == zone)
    named = {"live_scope": F.lit(True), "has_both": old.isNotNull() & new.isNotNull(), "tier_changed": no(old != new), "would_lose": eo & ~en,
        "would_gain": en & ~eo, "old_exact": eo, "new_exact": en, "no_new_forecast": new.isNull(), "new_only": old.isNull() & new.isNotNull()}
    rows = _live(t).withColumn("Cohort", F.explode(F.array_compact(F.array(*[F.when(c, n) for n, c in named.items()]))))
    return rows.groupBy("Cohort").agg(F.count("*").alias("Rows"), F.countDistinct("Location").alias("Locations"), F.countDistinct("SKU").alias("SKUs"),
        F.sum("Qty").alias("Qty"))


@query(f"""with {_SNAP}, e as (select SKU, v.ForecastStartDate as ValidFrom, SlotTier, lag(SlotTier) over (partition by SKU order by snap.k) as was from snap
  join vintages v using (SnapshotId)), s as (select SKU, ValidFrom, SlotTier, lead(ValidFrom) over (partition by SKU order by ValidFrom) as ValidTo from e
  where was is distinct from SlotTier)
  select a.SKU, a.ActualDate, a.SoldUnits, s.SlotTier, s.ValidTo is null as IsCurrent from actual_sku_day a left join s on s.SKU = a.SKU
  and s.ValidFrom <= a.ActualDate and a.ActualDate < coalesce(s.ValidTo, date '9999-12-31')""")
def slot_tier_history(t):
    """JN24 slot tiers as intervals, and each day's tier as of that day; unchanged tiers are one interval."""
    w = Window.partitionBy("SKU").orderBy("ValidFrom")
    rows = _snapshots(t).join(t.vintages.select("SnapshotId", F.col("ForecastStartDate").alias("ValidFrom")), "SnapshotId").select("SKU", "ValidFrom",
        "SlotTier")
    turns = rows.withColumn("was", F.lag("SlotTier").over(w)).where("not (was <=> SlotTier)")
    spans = turns.select("SKU", "ValidFrom", "SlotTier", F.lead("ValidFrom").over(w).alias("ValidTo"))
    out = J.asof_latest(t.actual_sku_day.select("SKU", "ActualDate", "SoldUnits"), spans, ["SKU"], "ActualDate", "ValidFrom")
    return out.select("SKU", "ActualDate", "SoldUnits", "SlotTier", F.col("ValidTo").isNull().alias("IsCurrent"))


@query("""with f as (select SnapshotId, SKU, sum(ForecastQty) as f from forecast_sku_day group by all), a as (select SnapshotId, SKU, sum(SoldUnits) as s
  from vintages join actual_sku_day on ActualDate between ForecastStartDate and ForecastStartDate + 13 group by all), c as (select SnapshotId, SKU, coalesce(f,
  0) as f, coalesce(s, 0) as s from f full join a using (SnapshotId, SKU))
  select SnapshotId, ForecastStartDate + 13 <= (select max(ActualDate) from actual_sku_day) as IsComplete, sum(s) as SoldUnits, sum(f) as ForecastUnits,
  sum(s) - sum(f) as NetError, sum(abs(f - s)) as AbsError, count(*) filter (s > 0) as SoldSKUs, count(*) filter (s > 0 and f > 0) as SoldWithForecast,
  round(1 - sum(abs(f - s)) / nullif(sum(s), 0), 6) as Accuracy from c join vintages using (SnapshotId) group by all""")
def snapshot_accuracy(t):
    """AG28 accuracy of each snapshot; the net error is sold less forecast."""
    last = t.actual_sku_day.agg(F.max("ActualDate"))
    days = t.vintages.select("SnapshotId", F.explode(F.sequence(F.col("ForecastStartDate"), F.date_add("ForecastStartDate", 13))).alias("ActualDate"))
    sold = t.actual_sku_day.join(days, "ActualDate").groupBy("SnapshotId", "SKU").agg(F.sum("SoldUnits").alias("s"))
    rows = full_outer_zero(t.forecast_sku_day.groupBy("SnapshotId", "SKU").agg(F.sum("ForecastQty").alias("f")), sold, ["SnapshotId", "SKU"], ["f", "s"])
    f, s = F.col("f"), F.col("s")
    sums = rows.groupBy("SnapshotId").agg(F.sum(s).alias("SoldUnits"), F.sum(f).alias("ForecastUnits"), (F.sum(s) - F.sum(f)).alias("NetError"),
        F.sum(F.abs(f - s)).alias("AbsError"), F.count_if(s > 0).alias("SoldSKUs"), F.count_if((s > 0) & (f > 0)).alias("SoldWithForecast"))
    whole = t.vintages.withColumn("_last", last.scalar()).select("SnapshotId", (F.date_add("ForecastStartDate", 13) <= F.col("_last")).alias("IsComplete"))
    return sums.join(whole, "SnapshotId").withColumn("Accuracy", F.round(1 - S.ratio_or_null(F.col("AbsError"), F.col("SoldUnits")), 6))


@query(f"""with {_SNAP}, x as (select SnapshotId, SKU, unnest(['whole', 'half', 'double']) as ForecastName, unnest([FD14, FD14 / 2, FD14 * 2]) as u
  from snap) select SnapshotId, ForecastName, count(*) filter (u * 6.5 > 100) as AA, count(*) filter (u * 6.5 > 40 and u * 6.5 <= 100) as A,
  count(*) filter (u * 6.5 > 20 and u * 6.5 <= 40) as B, count(*) filter (u * 6.5 <= 20) as C, sum(u) as Units from x group by all""")
def forecast_tiers(t):
    """PRJ45 totals and tiers of each forecast column."""
    rows = _snapshots(t).select("SnapshotId", "SKU", F.col("FD14").alias("whole"), (F.col("FD14") / 2).alias("half"),
        (F.col("FD14") * 2).alias("double")).unpivot(["SnapshotId", "SKU"], ["whole", "half", "double"], "ForecastName", "u")
    tier = S.velocity_tier(F.col("u") * 6.5)
    return rows.groupBy("SnapshotId", "ForecastName").agg(*[F.count_if(tier == n).alias(n) for n in ("AA", "A", "B", "C")], F.sum("u").alias("Units"))
