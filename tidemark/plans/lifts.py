"""Queries of lifts, exposure, attributes, sources, normalisers and set operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import joins as J
from tidemark.plans.forecasts import _score_detail, _with
from tidemark.plans.origins import _OFFERS, _promo_features
from tidemark.plans.registry import query

#: The event of each year and the days before it: 1 to 14 July, and the 28 days before.
_DAYS = "make_date(y, 7, 1) as es, make_date(y, 7, 14) as ee, (make_date(y, 7, 1) - 28) as bs, (make_date(y, 7, 1) - 1) as be"


def _years(t):
    """The event's days of each year with units, as rows (y, Date, event)."""
    years = t.planner_daily.select(F.year("Date").alias("y")).distinct()
    es = F.make_date("y", F.lit(7), F.lit(1))
    days = years.select("y", es.alias("es"), F.explode(F.sequence(F.date_sub(es, 28), F.date_add(es, 13))).alias("Date"))
    return days.select("y", "Date", (F.col("Date") >= F.col("es")).alias("event"))


@query(f"""with s as (select y, {_DAYS} from (select distinct year(Date) as y from planner_daily)), m as (select y, sum(PlanUnits) filter (Date between es
  and ee)::double as SaleUnits, count(*) filter (Date between es and ee) as SaleDays, avg(PlanUnits) filter (Date between bs and be) as BaseDaily from s
  join planner_daily on Date between bs and ee group by 1)
  select y::int as Year, SaleUnits, SaleDays, round(BaseDaily, 6) as BaseDaily, round(SaleUnits / nullif(BaseDaily * SaleDays, 0), 6) as Lift from m""")
def planner_lift(t):
    """AG47 the plan's event against the days before, by year."""
    e, u = F.col("event"), F.col("PlanUnits").cast("double")
    rows = t.planner_daily.join(_years(t), "Date").groupBy(F.col("y").alias("Year")).agg(F.sum(F.when(e, u)).alias("SaleUnits"),
        F.count_if(e).alias("SaleDays"), F.avg(F.when(~e, u)).alias("BaseDaily"))
    return rows.select("Year", "SaleUnits", "SaleDays", F.round("BaseDaily", 6).alias("BaseDaily"),
        F.round(S.ratio_or_null(F.col("SaleUnits"), F.col("BaseDaily") * F.col("SaleDays")), 6).alias("Lift"))


@query(f"""with s as (select y, {_DAYS} from (select distinct year(Date) as y from planner_daily)), c as (select y, Category, coalesce(sum(greatest(QtyOrdered,
  0)) filter (OrderDate between es and ee), 0) as sale, coalesce(sum(greatest(QtyOrdered, 0)) filter (OrderDate between bs and be), 0) as base,
  count(distinct OrderDate) filter (OrderDate between es and ee) as seen from s join order_lines on OrderDate between bs and ee group by all)
  select y::int as Year, Category, sale as SaleUnits, base as BaseUnits, seen as SaleDaysSeen, round(sale / nullif(base / 28 * 14, 0), 6) as Lift,
  round(sale / nullif(sum(sale) over (partition by y), 0), 6) as Share from c""")
def category_lift(t):
    """AG48 and PRJ43 each category's event against the days before: by calendar days, with the days on which something was seen."""
    e, u = F.col("event"), F.greatest("QtyOrdered", F.lit(0.0))
    rows = t.order_lines.select("Category", "QtyOrdered", F.col("OrderDate").alias("Date")).join(_years(t), "Date").groupBy(F.col("y").alias("Year"),
        "Category")
    rows = rows.agg(F.sum(F.when(e, u).otherwise(0.0)).alias("SaleUnits"), F.sum(F.when(~e, u).otherwise(0.0)).alias("BaseUnits"),
        F.countDistinct(F.when(e, F.col("Date"))).alias("SaleDaysSeen"))
    return rows.withColumns({"Lift": F.round(S.ratio_or_null(F.col("SaleUnits"), F.col("BaseUnits") / 28 * 14), 6),
        "Share": F.round(S.ratio_or_null(F.col("SaleUnits"), F.sum("SaleUnits").over(Window.partitionBy("Year"))), 6)})


@query(f"""with s as (select y, {_DAYS} from (select distinct year(Date) as y from planner_daily)) select y::int as Year,
  coalesce(sum(SoldUnits) filter (ActualDate between es and ee), 0) as WindowUnits, coalesce(sum(SoldUnits) filter (ActualDate between bs and be), 0)
  as PriorUnits,
  round((coalesce(sum(SoldUnits) filter (ActualDate between es and ee), 0) / 14) / nullif(coalesce(sum(SoldUnits) filter (ActualDate between bs and be),
  0) / 28, 0), 6) as Lift from s join actual_sku_day on ActualDate between bs and ee group by 1""")
def prior_28_lift(t):
    """AG50 a fixed window of each year against the 28 days before."""
    e, u = F.col("event"), F.col("SoldUnits")
    rows = t.actual_sku_day.select("SoldUnits", F.col("ActualDate").alias("Date")).join(_years(t),
        "Date").groupBy(F.col("y").alias("Year")).agg(F.sum(F.when(e, u).otherwise(0.0)).alias("WindowUnits"),
            F.sum(F.when(~e, u).otherwise(0.0)).alias("PriorUnits"))
    return rows.withColumn("Lift", F.round(S.ratio_or_null(F.col("WindowUnits") / 14, F.col("PriorUnits") / 28), 6))


@query(f"""with {_OFFERS} select Category, count(distinct SKU) as PromoSKUs, count(*) as PromoDays, max(MaxDiscount) as MaxDiscount, round(avg(MaxDiscount), 6)
  as AvgDiscount, count(*) filter (Markdown) as MarkdownDays, count(*) filter (FinalSale) as FinalSaleDays from feature join dim_product using (SKU) group by 1""")
def promo_exposure(t):
    """AG49 how far each category is promoted; SRC16 flags from counts."""
    rows = _promo_features(t).join(t.dim_product.select("SKU", "Category"), "SKU")
    return rows.groupBy("Category").agg(F.countDistinct("SKU").alias("PromoSKUs"), F.count("*").alias("PromoDays"),
        F.max("MaxDiscount").alias("MaxDiscount"), F.round(F.avg("MaxDiscount"), 6).alias("AvgDiscount"), F.count_if("Markdown").alias("MarkdownDays"),
            F.count_if("FinalSale").alias("FinalSaleDays"))


_WIDE = "select Category, coalesce(sum(ForecastUnits) filter (Candidate = 'forecast'), 0) as forecast, coalesce(sum(ForecastUnits) filter (Candidate = 'half'), 0) as half, coalesce(sum(ForecastUnits) filter (Candidate = 'recent'), 0) as recent from (select Candidate, SKU, f as ForecastUnits from c) join dim_product using (SKU) group by 1"


@query(_with(_WIDE))
def shadow_pivot(t):
    """AG49 and SRC22 candidates side by side by category."""
    rows = _score_detail(t).join(t.dim_product.select("SKU", "Category"), "SKU")
    return rows.groupBy("Category").pivot("Candidate", ["forecast", "half", "recent"]).agg(F.sum("ForecastUnits")).fillna(0.0)


@query("""select 'picks' as Source, max(ActualDate) as Last, max(ActualDate) >= date '1998-12-31' as Covers, 1 as Priority from actual_sku_day
  union all select 'orders', max(OrderDate), max(OrderDate) >= date '1998-12-31', 2 from order_lines union all select 'planner', max(Date),
  max(Date) >= date '1998-12-31', 3 from planner_daily""")
def source_coverage(t):
    """AG42 how far each source reaches, in order of priority."""
    one = lambda df, day, name, k: df.agg(F.max(day).alias("Last")).select(F.lit(name).alias("Source"), "Last",
        (F.col("Last") >= F.lit("1998-12-31").cast("date")).alias("Covers"), F.lit(k).alias("Priority"))
    return one(t.actual_sku_day, "ActualDate", "picks",
        1).unionByName(one(t.order_lines, "OrderDate", "orders", 2)).unionByName(one(t.planner_daily, "Date", "planner", 3))


@query("""with a as (select SKU, coalesce(arg_min(nullif(GroupCode, ''), (last_seen, SalesID)) filter (GroupCode <> ''), '') as GroupCode,
  coalesce(arg_min(nullif(SizeCode, ''), (last_seen, SalesID)) filter (SizeCode <> ''), '') as SizeCode, count(*) filter (GroupCode = '') as NoGroup,
  array_to_string(list_sort(list_distinct(list(source_file) filter (GroupCode = ''))), '|') as Files from ledger group by 1) select SKU, GroupCode, SizeCode,
  NoGroup, coalesce(Files, '') as Files from a""")
def first_attributes(t):
    """AG45 the first value of each attribute that is there, AG46 where it is missing; JN25 only missing columns are filled."""
    first = lambda c: F.coalesce(F.min(F.when(F.col(c) != "", F.struct("last_seen", "SalesID", c)))[c], F.lit(""))
    none = F.col("GroupCode") == ""
    return t.ledger.groupBy("SKU").agg(first("GroupCode").alias("GroupCode"), first("SizeCode").alias("SizeCode"), F.count_if(none).alias("NoGroup"),
        F.array_join(F.sort_array(F.collect_set(F.when(none, F.col("source_file")))), "|").alias("Files"))


@query("""select event_name, sheet_type, count(*) as n, count(distinct file_id) as files, min(start_date) as first_day, row_number()
  over (order by count(*) desc, event_name, sheet_type) as rank from promo_events group by event_name, sheet_type qualify rank <= 20""")
def biggest_events(t):
    """TK8 the twenty biggest events, TK7 in a stated order."""
    rows = t.promo_events.groupBy("event_name", "sheet_type").agg(F.count("*").alias("n"), F.countDistinct("file_id").alias("files"),
        F.min("start_date").alias("first_day"))
    order = [F.desc("n"), "event_name", "sheet_type"]
    return rows.orderBy(*order).limit(20).withColumn("rank", F.row_number().over(Window.partitionBy().orderBy(*order)))


@query(_with("select * from (select coalesce(c.Candidate, b.Candidate) as Candidate, coalesce(c.SnapshotId, b.SnapshotId) as SnapshotId, coalesce(c.SKU, b.SKU) as SKU, coalesce(f, 0) as f, coalesce(s, 0) as s from c full join (select * from a cross join n) b on c.Candidate = b.Candidate and c.SnapshotId = b.SnapshotId and c.SKU = b.SKU) qualify row_number() over (partition by Candidate order by abs(f - s) desc, SnapshotId, SKU) <= 200"))
def largest_errors(t):
    """TK1 and TK2 the rows of each candidate with the largest errors."""
    rows = _score_detail(t).select("Candidate", "SnapshotId", "SKU", F.col("ForecastUnits").alias("f"), F.col("SoldUnits").alias("s"))
    k = F.row_number().over(Window.partitionBy("Candidate").orderBy(F.desc(F.abs(F.col("f") - F.col("s"))), "SnapshotId", "SKU"))
    return rows.withColumn("k", k).where("k <= 200").drop("k")


_STOCK = "case when AvailPhysical > 180 then 1e9 else AvailPhysical end"


@query(f"""select SnapshotDate, count(*) filter (oh >= 1e9) as Quarantined, count(*) filter (oh < 0) as Negative, coalesce(sum(oh) filter (oh < 1e9), 0)
  as OnHand, min(oh) as Least, count(*) - count(distinct SKU) as Repeated from (select SnapshotDate, trim(upper(SKU)) as SKU, {_STOCK} as oh
  from inventory_sku_day where SnapshotDate is not null) group by 1""")
def stock_sentinels(t):
    """PRJ32 stand-in quantities of a billion are set apart and negatives kept, PRJ33 normal keys, AG39 repeated keys."""
    rows = t.inventory_sku_day.where("SnapshotDate is not null").select("SnapshotDate", F.trim(F.upper("SKU")).alias("SKU"), F.expr(_STOCK).alias("oh"))
    real = F.col("oh") < 1e9
    return rows.groupBy("SnapshotDate").agg(F.count_if(~real).alias("Quarantined"), F.count_if(F.col("oh") < 0).alias("Negative"),
        F.sum(F.when(real, F.col("oh")).otherwise(0.0)).alias("OnHand"), F.min("oh").alias("Least"), (F.count("*") - F.countDistinct("SKU")).alias("Repeated"))


@query("""select SnapshotDate, SKU, ExpectedInDCDate, sum(InboundRemainderUnits) as Units, count(distinct PurchID) as Orders from inbound_snapshots
  where InboundRemainderUnits > 2 and ExpectedInDCDate is not null and trim(SKU) <> '' and SKU in (select SKU from inventory_sku_day where AvailPhysical > 0)
  group by all""")
def inbound_rows(t):
    """PRJ34 inbound rows with units, date and SKU; PRJ40 only of SKUs that had stock, JN15 and JN26 by membership."""
    stocked = t.dealt(t.inventory_sku_day.where("AvailPhysical > 0").select("SKU"), "SKU").distinct()
    # dealt by SKU once: the membership and both levels of the distinct count stay in those partitions; Spark would take a semi join below them
    rows = t.dealt(t.inbound_snapshots.where("InboundRemainderUnits > 2 and ExpectedInDCDate is not null and trim(SKU) <> ''"), "SKU").join(stocked, "SKU")
    return rows.groupBy("SnapshotDate", "SKU", "ExpectedInDCDate").agg(F.sum("InboundRemainderUnits").alias("Units"),
        F.countDistinct("PurchID").alias("Orders"))


@query("""select PickDate, SKU, Location, sum(case when LocProfile like 'Picking%' then Units else 0 end) as Physical, sum(case when LocProfile = 'Bulk'
  then Units else 0 end) as Ordered, min(nullif(regexp_extract(Location, '[0-9]+', 0), '')::int) as Aisle from work_lines where trim(Location) <> ''
  group by all having Physical <> 0 or Ordered <> 0""")
def reservation_rows(t):
    """PRJ44 trimmed texts, whole numbers that may be missing, and rows with some reserved or ordered quantity."""
    total = lambda c: F.sum(F.when(c, F.col("Units")).otherwise(0.0))
    aisle = F.regexp_extract("Location", "[0-9]+", 0).try_cast("int")
    rows = t.work_lines.where(F.trim("Location") != "").groupBy("PickDate", "SKU",
        "Location").agg(total(F.col("LocProfile").startswith("Picking")).alias("Physical"), total(F.col("LocProfile") == "Bulk").alias("Ordered"),
            F.min(aisle).alias("Aisle"))
    return rows.where("Physical <> 0 or Ordered <> 0")


@query("""with k as (select id, raw, len([w for w in ['red', 'blue', 'metallic', 'off', 'up'] if contains(lower(raw), w)]) as score
  from dirty_text) select score, count(*) as n, min(id) as first_id from k group by 1""")
def keyword_scores(t):
    """PRJ42 how many of some keywords a name holds."""
    score = F.size(F.filter(F.array(*map(F.lit, ("red", "blue", "metallic", "off", "up"))), lambda w: F.contains(F.lower("raw"), w)))
    return t.dirty_text.select("id", F.coalesce(score, F.lit(0)).cast("long").alias("score")).groupBy("score").agg(F.count("*").alias("n"),
        F.min("id").alias("first_id"))


@query("""with c as (select unnest(generate_series(min(ActualDate), max(ActualDate), interval 90 day))::date as a, min(ActualDate) as lo, max(ActualDate) as hi
  from actual_sku_day) select a as First, least(a + 90, hi + 1) as Until, count(x.SKU) as Rows, coalesce(sum(x.SoldUnits), 0) as Units from c left
  join actual_sku_day x on x.ActualDate >= a and x.ActualDate < least(a + 90, hi + 1) group by all""")
def date_chunks(t):
    """SRC8 and SRC27 an extract cut into chunks of days, the end of each not included, with what each part holds."""
    span = t.actual_sku_day.agg(F.min("ActualDate").alias("lo"), F.max("ActualDate").alias("hi"))
    chunks = span.select("lo", "hi", F.explode(F.expr("sequence(lo, hi, interval 90 day)")).alias("First")).withColumn("Until",
        F.least(F.date_add("First", 90), F.date_add("hi", 1)))
    rows = t.actual_sku_day.withColumn("lo", span.select("lo").scalar()).withColumn("First",
        F.expr("date_add(lo, cast(floor(datediff(ActualDate, lo) / 90) * 90 as int))"))
    sums = rows.groupBy("First").agg(F.count("*").alias("Rows"), F.sum("SoldUnits").alias("Units"))
    return chunks.join(sums, "First", "left").select("First", "Until", F.coalesce("Rows", F.lit(0)).alias("Rows"),
        F.coalesce("Units", F.lit(0.0)).alias("Units"))


@query("""with b as (select max(PickDate) as cut from work_lines where WorkTransType = 7), r as (select PickDate as Date, SKU, sum(Units) as u from work_lines,
  b where PickDate <= cut group by all union all select OrderDate, SKU, sum(QtyOrdered) from order_lines, b where OrderDate > cut group by all) select Date,
  SKU, sum(u) as Units from r group by all""")
def routed_actuals(t):
    """SRC19 the boundary is the last day of closed work; one source up to it, the other after; SRC7 both under common names."""
    cut = t.work_lines.where("WorkTransType = 7").agg(F.max("PickDate"))
    old = t.work_lines.select(F.col("PickDate").alias("Date"), "SKU", F.col("Units").alias("u"), F.lit(True).alias("old"))
    new = t.order_lines.select(F.col("OrderDate").alias("Date"), "SKU", F.col("QtyOrdered").alias("u"), F.lit(False).alias("old"))
    rows = old.unionByName(new).withColumn("cut",
        cut.scalar()).where(F.when(F.col("old"), F.col("Date") <= F.col("cut")).otherwise(F.col("Date") > F.col("cut")))
    return rows.groupBy("Date", "SKU").agg(F.sum("u").alias("Units"))


@query("""with s as (select 1 as part, SnapshotId, SKU, sum(ForecastQty) as q from forecast_sku_day group by all union all select 2, SnapshotId, SKU,
  sum(ForecastQty) + 5 from forecast_sku_day where SnapshotId < 'V010' group by all) select SnapshotId, SKU, arg_max(q, part) as Units, count(*) > 1 as Replaced
  from s group by all""")
def later_parts_win(t):
    """SRC21 and ST6 parts put together, the later one counts where both have a row; ST8 columns in a stated order."""
    one = t.forecast_sku_day.groupBy("SnapshotId", "SKU").agg(F.sum("ForecastQty").alias("Units"))
    two = one.where("SnapshotId < 'V010'").withColumn("Units", F.col("Units") + 5)
    rows = J.upserted(one, two, ["SnapshotId", "SKU"], ["Units"])
    return rows.select("SnapshotId", "SKU", "Units", F.col("replaced").alias("Replaced"))


@query("""with a as (select file_id, rw, max(val) filter (cl = 0) as offer, max(val) filter (cl = 1) as style from cells where rw >= 3 and cl < 3 group by all),
  b as (select file_id, rw, max(val) filter (cl = 5) as price from cells where rw >= 3 and cl >= 3 group by all), x as (select * from a where offer <> ''
  qualify row_number() over (partition by file_id, offer order by rw) = 1), y as (select * from b qualify row_number() over (partition by file_id, price
  order by rw) = 1)
  select x.file_id, x.offer, x.style, y.price from x left join y using (file_id, rw)""")
def side_by_side_tables(t):
    """SRC20 two tables side by side in one sheet, each row once, joined by row."""
    cells = t.cells.where("rw >= 3")
    at = lambda k: F.max(F.when(F.col("cl") == k, F.col("val")))
    a = J.keep_one(cells.where("cl < 3").groupBy("file_id", "rw").agg(at(0).alias("offer"), at(1).alias("style")).where("offer <> ''"),
        ["file_id", "offer"], ["rw"])
    b = J.keep_one(cells.where("cl >= 3").groupBy("file_id", "rw").agg(at(5).alias("price")), ["file_id", "price"], ["rw"])
    return a.join(b, ["file_id", "rw"], "left").select("file_id", "offer", "style", "price")


@query("""select PickDate, Category, case when Location in ('Washed', 'Rags', 'Quality') or Zone = 'Quarantine' then 'NonSellable'
  when LocProfile in ('Picking', 'Picking A', 'PalletPicking') then 'SellableFloor' when LocProfile in ('Bulk', 'Overflow') or Zone in ('Bulk', 'OVFLO')
  then 'ReserveOrBulk'
  when upper(LocProfile) like '%STAGE%' or upper(Zone) like '%STAGE%' or Location like 'RSTAGE%' then 'Staging' else 'Other' end as Destination, sum(Units)
  as Units, count(*) as Lines, count(distinct SKU) as SKUs from work_lines join dim_product using (SKU) group by all""")
def supply_days(t):
    """AG10 supply by day, category and destination."""
    rows = t.work_lines.join(t.dim_product.select("SKU", "Category"), "SKU").withColumn("Destination",
        S.destination_class(F.col("Location"), F.col("LocProfile"), F.col("Zone")))
    return rows.groupBy("PickDate", "Category", "Destination").agg(F.sum("Units").alias("Units"), F.count("*").alias("Lines"),
        F.countDistinct("SKU").alias("SKUs"))
