"""Queries of aggregations, window functions, top-k and set operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import joins as J
from tidemark.operators import windows as W
from tidemark.plans.registry import query
from tidemark.sources import sinks
from tidemark.sources.store import PartStore

#: The profiles whose work lines are picks.
PICK_PROFILES = ("Picking", "Picking A", "Picking D", "PalletPicking")


@query("select ActualDate, SKU, SoldUnits, PickLines, DistinctOrders from actual_sku_day")
def pick_rollup(t):
    """AG1 work lines to SKU and day; JN19 scope as a parameter."""
    lines = t.work_lines.where(F.col("LocProfile").isin(*PICK_PROFILES) & ~F.col("Location").isin("Washed", "Bander"))
    return lines.groupBy(F.col("PickDate").alias("ActualDate"), "SKU").agg(F.sum("Units").alias("SoldUnits"), F.count("*").alias("PickLines"),
        F.countDistinct("OrderNum").alias("DistinctOrders"))


@query("""select PickDate, SKU, sum(u) as units, sum(o)::bigint as order_sum from (select PickDate, SKU, PickDate < date '1998-01-01' as archive, sum(Units)
  as u, count(distinct OrderNum) as o from work_lines group by all) group by all""")
def segment_rollup(t):
    """AG2, SRC9 and ST1: archive and live parts, half-open at the boundary, summed again; orders are added, not distinct."""
    lines, cut = t.work_lines, F.lit("1998-01-01").cast("date")
    part = lambda rows: rows.groupBy("PickDate", "SKU").agg(F.sum("Units").alias("u"), F.countDistinct("OrderNum").alias("o"))
    both = part(lines.where(F.col("PickDate") < cut)).unionByName(part(lines.where(F.col("PickDate") >= cut)))
    return both.groupBy("PickDate", "SKU").agg(F.sum("u").alias("units"), F.sum("o").alias("order_sum"))


_ORDERS = """select {0}, sum(QtyOrdered) as Units, sum(abs(QtyOrdered)) as AbsUnits, count(*) as Lines, count(distinct SalesID) as Orders, count(distinct SKU)
  as SKUs, count(*) filter (QtyOrdered < 0) as ReturnLines, sum(QtyOrdered) filter (QtyOrdered < 0) as ReturnUnits, round(sum(abs(QtyOrdered) * MSRP), 4)
  as GrossMSRP, round(sum(abs(QtyOrdered) * SalesPrice), 4) as GrossSales,
  round(sum(LineAmount), 4) as Amount, round(sum(abs(QtyOrdered) * MSRP) - sum(abs(LineAmount)), 4) + 0.0 as DiscountMSRP,
  round(sum(abs(QtyOrdered) * SalesPrice) - sum(abs(LineAmount)), 4) + 0.0 as DiscountSales, max(off) as MaxOff, count(*) filter (LineDiscPercent > 0
  or off >= 0.05) as DiscountedLines, round(case when sum(QtyOrdered * MSRP) <> 0 then 1 - sum(LineAmount) / sum(QtyOrdered * MSRP) end, 6) + 0.0
  as WeightedOffMSRP,
  round(case when sum(QtyOrdered * SalesPrice) <> 0 then 1 - sum(LineAmount) / sum(QtyOrdered * SalesPrice) end, 6) + 0.0 as WeightedOffSales from (select *,
  case when MSRP <> 0 and QtyOrdered <> 0 then round(1 - LineAmount / (QtyOrdered * MSRP), 6) end as off from order_lines) group by all"""


def _order_sums(t, *by):
    q, off = F.col("QtyOrdered"), F.round(1 - S.ratio_or_null(F.col("LineAmount"), F.col("QtyOrdered") * F.col("MSRP")), 6)
    # adding 0 turns a rounded -0.0 into 0.0
    gross, total = lambda p: F.sum(F.abs(q) * F.col(p)), lambda c: F.round(c, 4) + F.lit(0.0)
    weighted = lambda p: F.round(1 - S.ratio_or_null(F.sum("LineAmount"), F.sum(q * F.col(p))), 6) + F.lit(0.0)
    paid = F.sum(F.abs("LineAmount"))
    # a key has one value: counting it distinctly beside the orders would double all rows
    skus = F.max(F.lit(1).cast("long")) if "SKU" in by else F.countDistinct("SKU")
    lines = t.order_lines.withColumn("off", off)
    # almost every line has a day and SKU of its own: lines are dealt before they are summed, not summed in large tasks first
    lines = t.dealt(lines, *by) if "SKU" in by else lines
    return lines.groupBy(*by).agg(
        F.sum(q).alias("Units"), F.sum(F.abs(q)).alias("AbsUnits"), F.count("*").alias("Lines"), F.countDistinct("SalesID").alias("Orders"),
            skus.alias("SKUs"), F.count_if(q < 0).alias("ReturnLines"), F.sum(F.when(q < 0, q)).alias("ReturnUnits"),
        total(gross("MSRP")).alias("GrossMSRP"), total(gross("SalesPrice")).alias("GrossSales"), total(F.sum("LineAmount")).alias("Amount"),
            total(gross("MSRP") - paid).alias("DiscountMSRP"), total(gross("SalesPrice") - paid).alias("DiscountSales"),
        F.max("off").alias("MaxOff"), F.count_if((F.col("LineDiscPercent") > 0) | (F.col("off") >= 0.05)).alias("DiscountedLines"),
            weighted("MSRP").alias("WeightedOffMSRP"), weighted("SalesPrice").alias("WeightedOffSales"),
    )


@query(_ORDERS.format("OrderDate, SKU"))
def order_rollup(t):
    """AG3 order lines to SKU and day, JN20 orders and their lines."""
    return _order_sums(t, "OrderDate", "SKU")


@query(_ORDERS.format("OrderDate"))
def order_days(t):
    """AG4 order lines to days."""
    return _order_sums(t, "OrderDate")


@query("""select d.OrderDate, b.band, coalesce(x.n, 0) as lines, coalesce(x.q, 0) as qty, coalesce(x.s, 0) as skus, coalesce(x.a, 0) as amount
  from (select distinct OrderDate from order_lines) d
  cross join (select unnest(['<5%', '5-15%', '15-25%', '25-35%', '35-50%', '50-70%', '70%+']) as band) b left join (select OrderDate, count(*) as n,
  sum(QtyOrdered) as q, count(distinct SKU) as s, round(sum(LineAmount), 4) as a,
    case when off <= -0.001 then null when off <= 0.0499 then '<5%' when off <= 0.1499 then '5-15%' when off <= 0.2499 then '15-25%' when off <= 0.3499
  then '25-35%' when off <= 0.4999 then '35-50%' when off <= 0.6999 then '50-70%' when off <= 1 then '70%+' end as band
    from (select OrderDate, QtyOrdered, SKU, LineAmount, coalesce(round(1 - LineAmount / nullif(QtyOrdered * MSRP, 0), 6), 0) as off from order_lines)
  group by all) x on x.OrderDate = d.OrderDate and x.band = b.band""")
def discount_bands(t):
    """AG5 and PRJ19: every day has every band, empty ones too."""
    off = F.round(1 - S.ratio_or_null(F.col("LineAmount"), F.col("QtyOrdered") * F.col("MSRP")), 6)
    lines = t.order_lines.select("OrderDate", "QtyOrdered", "SKU", "LineAmount", S.discount_band(off).alias("band"))
    days = lines.select("OrderDate").distinct().withColumn("band", F.explode(F.array(*map(F.lit, S.BANDS))))
    sums = lines.groupBy("OrderDate", "band").agg(F.count("*").alias("n"), F.sum("QtyOrdered").alias("q"), F.countDistinct("SKU").alias("s"),
        F.round(F.sum("LineAmount"), 4).alias("a"))
    return days.join(sums, ["OrderDate", "band"], "left").select(
        "OrderDate", "band", F.coalesce("n", F.lit(0)).alias("lines"), F.coalesce("q", F.lit(0.0)).alias("qty"), F.coalesce("s", F.lit(0)).alias("skus"),
            F.coalesce("a", F.lit(0.0)).alias("amount")
    )


@query("""select SnapshotDate, count(*) as rows, count(distinct SKU) as skus, sum(AvailPhysical) as avail, sum(greatest(AvailPhysical - PhysicalReserved, 0))
  as net, count(*) filter (AvailPhysical > 0) as in_stock, count(*) filter (OrderedInTotal > 1) as on_order from inventory_sku_day group by all""")
def inventory_summary(t):
    """AG7 and PRJ10 snapshot-day summary."""
    return t.inventory_sku_day.groupBy("SnapshotDate").agg(F.count("*").alias("rows"), F.countDistinct("SKU").alias("skus"),
        F.sum("AvailPhysical").alias("avail"), F.sum(F.greatest(F.col("AvailPhysical") - F.col("PhysicalReserved"), F.lit(0.0))).alias("net"),
            F.count_if(F.col("AvailPhysical") > 0).alias("in_stock"), F.count_if(F.col("OrderedInTotal") > 1).alias("on_order"))


_BUCKET = "case when Location = '' then 'BlankLocation' when LocProfile in ('Picking', 'Picking A', 'Picking D', 'PalletPicking') then 'PickFace' when LocProfile = 'W001' then 'W001' when LocProfile in ('Bulk', 'Overflow') then 'ReserveOrBulk' when LocProfile in ('RSTAGE', 'Induction', 'Direct Packing') then 'StagingOrProcessing' else 'OtherLocated' end"
BUCKETS = ("BlankLocation", "PickFace", "W001", "ReserveOrBulk", "StagingOrProcessing", "OtherLocated")


@query(f"""select PickDate, SKU, {", ".join(f"coalesce(sum(Units) filter (b = '{x}'), 0) as {x}" for x in BUCKETS)},
  coalesce(sum(Units) filter (b <> 'BlankLocation'), 0) as Located, coalesce(sum(Units) filter (WorkTransType = 1), 0) as Received,
  coalesce(sum(Units) filter (WorkTransType = 12), 0) as Returned, coalesce(sum(Units) filter (WorkTransType = 11), 0) as Replenished,
  coalesce(sum(Units) filter (WorkTransType = 7), 0) as Moved,
  coalesce(sum(Units) filter (Location in ('Washed', 'Rags', 'Quality') or Zone = 'Quarantine'), 0) as Unsold, bool_or(LocProfile = 'W001') as AnyReturn,
  bool_or(Location in ('Washed', 'Bander')) as AnyExcluded, count(distinct Location) as Locations from (select *, {_BUCKET} as b from work_lines) group by all""")
def supply_pivot(t):
    """AG8 quantities by bucket and totals, AG9 filtered sums, AG12 any-flags and distinct locations."""
    rows = t.work_lines.withColumn("b", S.reservation_bucket(F.col("Location"), F.col("LocProfile")))
    total = lambda c: F.sum(F.when(c, F.col("Units")).otherwise(0.0))
    kind = F.col("WorkTransType")
    return rows.groupBy("PickDate", "SKU").agg(
        *[total(F.col("b") == x).alias(x) for x in BUCKETS], total(F.col("b") != "BlankLocation").alias("Located"), total(kind == 1).alias("Received"),
            total(kind == 12).alias("Returned"), total(kind == 11).alias("Replenished"), total(kind == 7).alias("Moved"),
        total(F.col("Location").isin(*S.UNSOLD_LOCATIONS) | (F.col("Zone") == S.UNSOLD_ZONE)).alias("Unsold"),
            F.bool_or(F.col("LocProfile") == "W001").alias("AnyReturn"), F.bool_or(F.col("Location").isin("Washed", "Bander")).alias("AnyExcluded"),
                F.countDistinct("Location").alias("Locations"),
    )


@query("""select SnapshotDate, Category, max(Name) as Name, sum(AvailPhysical) as Avail, round(avg(MSRP), 4) as AvgPrice, count(*) as Rows, max(case
  when AvailPhysical > 0 then i.SKU end) as LastInStock from inventory_sku_day i join dim_product using (SKU) group by all""")
def inventory_rollup(t):
    """AG6 largest text, summed quantity, mean price and count."""
    rows = t.inventory_sku_day.join(t.dim_product.select("SKU", "Category", "Name", "MSRP"), "SKU")
    return rows.groupBy("SnapshotDate", "Category").agg(F.max("Name").alias("Name"), F.sum("AvailPhysical").alias("Avail"),
        F.round(F.avg("MSRP"), 4).alias("AvgPrice"), F.count("*").alias("Rows"), F.max(F.when(F.col("AvailPhysical") > 0, F.col("SKU"))).alias("LastInStock"))


@query("""select SnapshotDate, SKU, sum(case when d < 0 then u else 0 end) as past_due, sum(case when d between 0 and 7 then u else 0 end) as d0_7, sum(case
  when d between 8 and 14 then u else 0 end) as d8_14, sum(case when d between 15 and 30 then u else 0 end) as d15_30, sum(case when d between 31 and 60 then u
  else 0 end) as d31_60, sum(case when d between 61 and 90 then u else 0 end) as d61_90, sum(case when d > 90 then u else 0 end) as d90_up
  from (select SnapshotDate, SKU, ExpectedInDCDate - SnapshotDate as d, InboundRemainderUnits as u from inbound_snapshots) group by all""")
def inbound_buckets(t):
    """AG11 inbound age buckets."""
    d = F.datediff("ExpectedInDCDate", "SnapshotDate")
    edges = {"d0_7": (0, 7), "d8_14": (8, 14), "d15_30": (15, 30), "d31_60": (31, 60), "d61_90": (61, 90)}
    total = lambda c: F.sum(F.when(c, F.col("InboundRemainderUnits")).otherwise(0.0))
    return t.inbound_snapshots.groupBy("SnapshotDate", "SKU").agg(total(d < 0).alias("past_due"),
        *[total(d.between(*e)).alias(n) for n, e in edges.items()], total(d > 90).alias("d90_up"))


@query("""select SKU, array_to_string(list_sort(list_distinct(list(PurchID))), '|') as orders, array_to_string(list_sort(list_distinct(list(PurchID)))[1:5],
  '|') as first_five from inbound_snapshots group by all""")
def text_sets(t):
    """AG13 sorted distinct texts joined by a bar."""
    found = F.sort_array(F.collect_set("PurchID"))
    return t.inbound_snapshots.groupBy("SKU").agg(F.array_join(found, "|").alias("orders"), F.array_join(F.slice(found, 1, 5), "|").alias("first_five"))


@query("""select day, count(*) as events, count(distinct event_name) as names, count(*) filter (sheet_type = 'markdown') as markdowns,
  bool_or(contains(promo_scope, 'Baby')) as any_baby from (select e.*, unnest(generate_series(start_date, end_date, interval 1 day))::date as day
  from promo_events e
  where sheet_type <> 'coupon' and (sheet_type <> 'aggregate_promo_offers' or file_id not in (select file_id from promo_events
  where sheet_type = 'promo_detail'))) group by all""")
def promo_days(t):
    """AG15 events to days; aggregate sheets only for files without a detail sheet."""
    e = t.promo_events.where("sheet_type <> 'coupon'")
    whole = e.where("sheet_type = 'aggregate_promo_offers'").join(e.where("sheet_type = 'promo_detail'").select("file_id").distinct(), "file_id", "left_anti")
    used = e.where("sheet_type <> 'aggregate_promo_offers'").unionByName(whole)
    days = used.withColumn("day", F.explode(F.sequence("start_date", "end_date")))
    return days.groupBy("day").agg(F.count("*").alias("events"), F.countDistinct("event_name").alias("names"),
        F.count_if(F.col("sheet_type") == "markdown").alias("markdowns"), F.bool_or(F.contains("promo_scope", F.lit("Baby"))).alias("any_baby"))


@query("""select s.day, coalesce(n, 0) as orders, coalesce(p.PlanUnits, 0)::double as plan from (select unnest(generate_series(min(Date), max(Date),
  interval 1 day))::date as day from planner_daily) s left join (select OrderDate, count(*) as n from order_lines group by 1) o on o.OrderDate = s.day left
  join planner_daily p on p.Date = s.day""")
def daily_calendar(t):
    """AG17 calendar spine with gaps filled; AG4 day summary."""
    plan = t.planner_daily
    orders = t.order_lines.groupBy(F.col("OrderDate").alias("Date")).agg(F.count("*").alias("n"))
    return W.day_spine(plan, "Date").join(orders, "Date", "left").join(plan, "Date", "left").select(F.col("Date").alias("day"),
        F.coalesce("n", F.lit(0)).alias("orders"), F.coalesce("PlanUnits", F.lit(0)).cast("double").alias("plan"))


@query("""select SKU, ActualDate, coalesce(lag(SoldUnits, 1) over w, 0) as Lag1, coalesce(lag(SoldUnits, 7) over w, 0) as Lag7, coalesce(lag(SoldUnits, 14)
  over w, 0) as Lag14, round(coalesce(avg(SoldUnits) over (w rows between 7 preceding and 1 preceding), 0), 6) as RollingMean7, round(coalesce(avg(SoldUnits)
  over (w rows between 28 preceding and 1 preceding), 0), 6) as RollingMean28,
  round(coalesce(sum(SoldUnits) over (partition by SKU order by ActualDate range between interval 7 day preceding and interval 1 day preceding), 0) / 7, 6)
  as Calendar7 from actual_sku_day window w as (partition by SKU order by ActualDate)""")
def demand_lags(t):
    """WN1, WN2 lags by row; WN4 calendar means."""
    rows = W.row_lags(t.actual_sku_day, ["SKU"], "ActualDate", "SoldUnits").withColumn("Calendar7",
        F.round(W.calendar_mean("SoldUnits", ["SKU"], "ActualDate", 7), 6))
    return rows.select("SKU", "ActualDate", "Lag1", "Lag7", "Lag14", F.round("RollingMean7", 6).alias("RollingMean7"),
        F.round("RollingMean28", 6).alias("RollingMean28"), "Calendar7")


@query("""select Family, Member, ActualDate, Units, coalesce(lag(Units, 1) over w, 0) as Lag1, round(coalesce(avg(Units) over (w rows between 7 preceding
  and 1 preceding), 0), 6) as Mean7 from (select Family, Member, ActualDate, sum(u) as Units
  from (select unnest(['category', 'item']) as Family, unnest([Category, Item || '-' || Color]) as Member, ActualDate, SoldUnits as u from actual_sku_day
  join dim_product using (SKU)) group by all) window w as (partition by Family, Member order by ActualDate)""")
def family_lags(t):
    """AG19 and WN3 totals of categories and of item and colour, with their lags; JN3 category join."""
    named = F.array(F.struct(F.lit("category").alias("Family"), F.col("Category").alias("Member")),
        F.struct(F.lit("item").alias("Family"), F.concat_ws("-", "Item", "Color").alias("Member")))
    rows = t.actual_sku_day.join(t.dim_product.select("SKU", "Category", "Item", "Color"), "SKU").select("ActualDate", "SoldUnits",
        F.explode(named).alias("f")).select("f.*", "ActualDate", "SoldUnits")
    days = rows.groupBy("Family", "Member", "ActualDate").agg(F.sum("SoldUnits").alias("Units"))
    return W.row_lags(days, ["Family", "Member"], "ActualDate", "Units", lags=(1,), means=(7,)).select("Family", "Member", "ActualDate", "Units", "Lag1",
        F.round("RollingMean7", 6).alias("Mean7"))


@query("""select s.day as Date, coalesce(sum(u), 0) as Sum14 from (select unnest(generate_series(min(ActualDate), max(ActualDate) - 13, interval 1 day))::date
  as day from actual_sku_day) s join (select ActualDate, sum(SoldUnits) as u from actual_sku_day group by 1) a on a.ActualDate between s.day and s.day + 13
  group by 1""")
def rolling_14(t):
    """WN11 sums over 14 calendar days."""
    days = t.actual_sku_day.groupBy(F.col("ActualDate").alias("Date")).agg(F.sum("SoldUnits").alias("u"))
    return W.rolling_window_sums(days, "Date", "u", 14, "Sum14")


@query("""with r as (select s.day as Date, sum(u) as Sum14 from (select unnest(generate_series(min(ActualDate), max(ActualDate) - 13, interval 1 day))::date
  as day from actual_sku_day) s join (select ActualDate, sum(SoldUnits) as u from actual_sku_day group by 1) a on a.ActualDate between s.day and s.day + 13
  group by 1)
  select year(Date) as y, Date, Sum14, row_number() over (partition by year(Date) order by Sum14 desc, Date) as rank from r qualify rank <= 5""")
def top_windows(t):
    """TK3 top five windows of each year."""
    days = t.actual_sku_day.groupBy(F.col("ActualDate").alias("Date")).agg(F.sum("SoldUnits").alias("u"))
    rows = W.rolling_window_sums(days, "Date", "u", 14, "Sum14").withColumn("y", F.year("Date"))
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("y").orderBy(F.desc("Sum14"), "Date"))).where("rank <= 5").select("y", "Date",
        "Sum14", "rank")


@query("""select SKU, arg_max(AvailPhysical, SnapshotDate) as last_avail, max(SnapshotDate) as last_day, arg_max(PhysicalReserved,
  SnapshotDate) filter (PhysicalReserved > 3) as last_reserved from inventory_sku_day group by 1""")
def last_values(t):
    """WN5 last value of each column as of an origin; WN6 and WN7 last row."""
    return t.inventory_sku_day.groupBy("SKU").agg(F.max_by("AvailPhysical", "SnapshotDate").alias("last_avail"), F.max("SnapshotDate").alias("last_day"),
        F.max(F.when(F.col("PhysicalReserved") > 3, F.struct("SnapshotDate", "PhysicalReserved")))["PhysicalReserved"].alias("last_reserved"))


@query("""select Item, Color, arg_min(SKU, GoLiveDate::varchar || SKU) as SKU, min(GoLiveDate) as GoLiveDate from dim_product group by all""")
def keep_first(t):
    """WN7 and SRC18 one row of each key in a stated order."""
    return J.keep_one(t.dim_product, ["Item", "Color"], ["GoLiveDate", "SKU"]).select("Item", "Color", "SKU", "GoLiveDate")


@query("""select year(PickDate) as y, LocProfile, count(*) as lines, sum(Units) as units, count(*) filter (Location in ('Washed', 'Bander')) as excluded,
  count(distinct SKU) as skus from work_lines group by all""")
def scope_audit(t):
    """AG37 and AG38 scope audit by year and profile."""
    return t.work_lines.groupBy(F.year("PickDate").alias("y"), "LocProfile").agg(F.count("*").alias("lines"), F.sum("Units").alias("units"),
        F.count_if(F.col("Location").isin("Washed", "Bander")).alias("excluded"), F.countDistinct("SKU").alias("skus"))


@query("""select m, count(*) as keys from (select SKU, SnapshotDate, count(*) as m from inbound_snapshots group by all) group by m""")
def key_multiplicity(t):
    """AG39 how often keys repeat."""
    return t.inbound_snapshots.groupBy("SKU", "SnapshotDate").agg(F.count("*").alias("m")).groupBy("m").agg(F.count("*").alias("keys"))


@query("""select date_trunc('month', ActualDate)::date as month, count(distinct ActualDate) as days, (max(ActualDate) - min(ActualDate) + 1)::int as span,
  sum(SoldUnits) as units from actual_sku_day group by 1""")
def completeness(t):
    """AG40 and AG41 distinct days against expected, by month."""
    return t.actual_sku_day.groupBy(F.trunc("ActualDate", "month").alias("month")).agg(F.countDistinct("ActualDate").alias("days"),
        (F.datediff(F.max("ActualDate"), F.min("ActualDate")) + 1).alias("span"), F.sum("SoldUnits").alias("units"))


@query("""select SnapshotId, count(*) filter (PutawayIndicator = 1) as active, count(*) filter (PutawayIndicator = 0) as reserve,
  count(*) filter (PutawayIndicator = 2) as offsite, count(*) filter (Velocity = 'AA') as aa, sum(q) as units from (select SnapshotId, SKU, sum(ForecastQty)
  as q from forecast_sku_day group by all) join dim_product using (SKU) group by 1""")
def vintage_summary(t):
    """AG32 and AG54 vintage summary."""
    rows = t.forecast_sku_day.groupBy("SnapshotId",
        "SKU").agg(F.sum("ForecastQty").alias("q")).join(t.dim_product.select("SKU", "PutawayIndicator", "Velocity"), "SKU")
    return rows.groupBy("SnapshotId").agg(*[F.count_if(F.col("PutawayIndicator") == k).alias(n) for k,
        n in ((1, "active"), (0, "reserve"), (2, "offsite"))], F.count_if(F.col("Velocity") == "AA").alias("aa"), F.sum("q").alias("units"))


@query("""select SnapshotId, ForecastDate, sum(ForecastQty) as units from forecast_sku_day group by all having sum(ForecastQty) <> 0""")
def daily_totals(t):
    """AG43 and AG44 daily totals, those that are not zero."""
    return t.forecast_sku_day.groupBy("SnapshotId", "ForecastDate").agg(F.sum("ForecastQty").alias("units")).where("units <> 0")


@query("""select (from_utc::timestamp at time zone 'UTC' at time zone 'America/New_York')::date as local_day, event_type, count(*) as n, round(sum(value), 4)
  as total from (select ts as from_utc, event_type, value from events) group by all""")
def local_days(t):
    """UTC time to the local date."""
    events = t.base("events")
    day = F.to_date(F.from_utc_timestamp(F.col("ts").cast("timestamp"), "America/New_York"))
    return events.groupBy(day.alias("local_day"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


def _month(day):
    return F.date_format(day, "yyyy-MM")


_MIDDLE = "(select min(ActualDate) + ((max(ActualDate) - min(ActualDate)) // 2)::int as lo from actual_sku_day)"


@query(f"""with n as (select SKU, PickDate as ActualDate, sum(Units) as SoldUnits from work_lines, {_MIDDLE} where PickDate between lo and lo + 40 group by all)
  select SKU, ActualDate, SoldUnits from actual_sku_day, (select min(ActualDate) as a, max(ActualDate) as b from n) where ActualDate not between a and b
  union all select SKU, ActualDate, SoldUnits from n""")
def range_replace(t):
    """SNK4 and ST3: a store by month, in which the whole date range of new rows (40 days from the middle of the table) replaces the old ones."""
    old = t.actual_sku_day.select("SKU", "ActualDate", "SoldUnits")
    lo = old.agg(F.expr("date_add(min(ActualDate), cast(datediff(max(ActualDate), min(ActualDate)) div 2 as int))")).first()[0]
    new = t.work_lines.where(F.col("PickDate").between(F.lit(lo), F.date_add(F.lit(lo), 40))).groupBy("SKU", F.col("PickDate").alias("ActualDate")).agg(F.sum("Units").alias("SoldUnits"))
    store = PartStore(old.sparkSession, sinks.work_folder(old.sparkSession, "store"))
    store.replace_range("actual", old, "ActualDate", _month)
    store.replace_range("actual", new, "ActualDate", _month)
    return store.read("actual")


@query("""select strftime(ActualDate, '%Y-%m') as part, count(*) as rows, sum(SoldUnits) as units, count(distinct SKU) as skus, min(ActualDate) as first_day,
  max(ActualDate) as last_day from actual_sku_day group by 1""")
def month_parts(t):
    """SNK3 a table split into months and put together again: what each part holds, by the manifest and by the rows that were read."""
    rows = t.actual_sku_day.select("SKU", "ActualDate", "SoldUnits")
    store = PartStore(rows.sparkSession, sinks.work_folder(rows.sparkSession, "store"))
    store.replace_range("actual", rows, "ActualDate", _month)
    back = store.read("actual").groupBy(_month("ActualDate").alias("part")).agg(F.sum("SoldUnits").alias("units"), F.countDistinct("SKU").alias("skus"),
        F.min("ActualDate").alias("first_day"), F.max("ActualDate").alias("last_day"))
    return store.manifest().select("part", "rows").join(back, "part", "full")


@query("""select coalesce(n.SKU, o.SKU) as SKU, coalesce(n.SnapshotDate, o.SnapshotDate) as SnapshotDate, case when n.SKU is not null then n.AvailPhysical
  else o.AvailPhysical end as AvailPhysical, n.SKU is not null and o.SKU is not null as replaced
  from (select SKU, SnapshotDate, AvailPhysical + 1000 as AvailPhysical from inventory_sku_day where PhysicalReserved > 3 union all select SKU,
  SnapshotDate + 700, AvailPhysical from inventory_sku_day where PhysicalReserved > 6) n
  full join inventory_sku_day o on n.SKU = o.SKU and n.SnapshotDate = o.SnapshotDate""")
def key_upsert(t):
    """ST4 key upsert: new rows have other values, and some have keys of their own."""
    inv = t.inventory_sku_day.select("SKU", "SnapshotDate", "AvailPhysical", "PhysicalReserved")
    other = inv.where("PhysicalReserved > 3").withColumn("AvailPhysical", F.col("AvailPhysical") + 1000)
    more = inv.where("PhysicalReserved > 6").withColumn("SnapshotDate", F.date_add("SnapshotDate", 700))
    return J.upserted(inv, other.unionByName(more), ["SKU", "SnapshotDate"], ["AvailPhysical"])
