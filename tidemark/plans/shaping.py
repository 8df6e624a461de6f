"""Queries of row-wise operators and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import joins as J
from tidemark.plans.registry import query


@query("""select id, case when lower(trim(regexp_replace(raw, '\\s+', ' ', 'g'))) in ('', 'nan') then null else trim(regexp_replace(raw, '\\s+', ' ', 'g')) end
  as cleaned,
  try_cast(regexp_replace(regexp_replace(trim(raw), '[$,%\\s]', '', 'g'), '^\\((.*)\\)$', '-\\1') as double) as num,
  list_max([x::int for x in regexp_extract_all(raw, '(\\d{1,3})(?:\\.\\d+)?\\s*%', 1) if x::int between 0 and 100]) as pct,
  array_to_string([w for w in ['red', 'blue', 'hot', 'small'] if contains(lower(raw), w)], '|') as tags,
  case when strpos(trim(raw), '-') = 0 then trim(raw) else trim(string_split(trim(raw),
  '-')[1]) || '-' || array_to_string([upper(trim(x)) for x in string_split(trim(raw), '-')[2:]], '-') end as sku from dirty_text""")
def dirty_text_clean(t):
    """PRJ1 normal SKU, PRJ5 clean text, PRJ7 numbers, PRJ20 tags, PRJ22 largest percentage."""
    raw = F.col("raw")
    return t.dirty_text.select("id", S.clean_text(raw).alias("cleaned"), S.to_number(raw).alias("num"), S.max_percent(raw).alias("pct"),
        S.scope_tags(raw, ("red", "blue", "hot", "small")).alias("tags"), S.normal_sku(raw).alias("sku"))


@query("""select id, make_date(case when m >= 7 then 2025 else 2026 end, m, d) as first_day from (select id, regexp_extract(raw, '(\\d{1,2})/(\\d{1,2})-', 1)
  as a, nullif(regexp_extract(raw, '(\\d{1,2})/(\\d{1,2})-', 1), '')::int as m, nullif(regexp_extract(raw, '(\\d{1,2})/(\\d{1,2})-', 2), '')::int as d
  from dirty_text) where m is not null""")
def dirty_text_dates(t):
    """PRJ23 date tokens with the year inferred."""
    m, d = (F.regexp_extract("raw", r"(\d{1,2})/(\d{1,2})-", k) for k in (1, 2))
    rows = t.dirty_text.where(m != "").select("id", m.cast("int").alias("m"), d.cast("int").alias("d"))
    return rows.select("id", S.inferred_date(F.col("m"), F.col("d")).alias("first_day"))


@query("""select SKU, upper(Item) || '-' || upper(Color) || '-' || upper(Size) as made, Item as item, Color as color, Category as cat, case
  when GoLiveDate > date '1999-06-01' then 'PreGoLive' when date '1999-06-01' - GoLiveDate <= 30 then 'New0To30' when date '1999-06-01' - GoLiveDate <= 90
  then 'New31To90' else 'Established' end as newness,
  case when pk % 150 <= 20 then 'C' when pk % 150 <= 40 then 'B' when pk % 150 <= 100 then 'A' else 'AA' end as tier, case PutawayIndicator when 1 then 'active'
  when 0 then 'reserve' else 'offsite' end as putaway from dim_product""")
def product_classes(t):
    """PRJ2-4 SKU parts, PRJ14 tiers, PRJ16 newness, SRC13 category."""
    day = F.lit("1999-06-01").cast("date")
    return t.dim_product.select("SKU", S.make_sku(F.col("Item"), F.col("Color"), F.col("Size")).alias("made"), S.sku_part(F.col("SKU"), 1).alias("item"),
        S.sku_part(F.col("SKU"), 2).alias("color"), F.col("Category").alias("cat"), S.newness(day, F.col("GoLiveDate")).alias("newness"),
        S.velocity_tier(F.col("pk") % 150).alias("tier"),
            F.when(F.col("PutawayIndicator") == 1, "active").when(F.col("PutawayIndicator") == 0, "reserve").otherwise("offsite").alias("putaway"))


@query("""select OrderNum, LineNum,
  case WorkTransType when 12 then case when Location in ('Washed', 'Rags', 'Quality') or Zone = 'Quarantine' then 'ReturnNonSellable'
  when LocProfile in ('Picking', 'Picking A', 'PalletPicking') then 'ReturnToSellableFloor' else 'ReturnOther' end
    when 11 then 'Replenishment' when 7 then 'Transfer'
    when 1 then case when WorkTemplateCode = 'Active Putaway' then 'ActivePutaway' when contains(WorkTemplateCode, 'Cubiscan') then 'CubiscanPutaway'
  else 'ReceivingPutaway' end else 'OtherSupplyWork' end as supply,
  case when Location in ('Washed', 'Rags', 'Quality') or Zone = 'Quarantine' then 'NonSellable' when LocProfile in ('Picking', 'Picking A', 'PalletPicking')
  then 'SellableFloor'
    when LocProfile in ('Bulk', 'Overflow') or Zone in ('Bulk', 'OVFLO') then 'ReserveOrBulk' when upper(LocProfile) like '%STAGE%'
  or upper(Zone) like '%STAGE%' or Location like 'RSTAGE%' then 'Staging' else 'Other' end as destination,
  case when Location = '' then 'BlankLocation' when LocProfile in ('Picking', 'Picking A', 'Picking D', 'PalletPicking') then 'PickFace'
  when LocProfile = 'W001' then 'W001' when LocProfile in ('Bulk', 'Overflow') then 'ReserveOrBulk'
    when LocProfile in ('RSTAGE', 'Induction', 'Direct Packing') then 'StagingOrProcessing' else 'OtherLocated' end as bucket from work_lines""")
def supply_classes(t):
    """PRJ11 supply, PRJ12 destination, PRJ13 reservation bucket."""
    location, profile, zone = F.col("Location"), F.col("LocProfile"), F.col("Zone")
    supply = S.supply_class(F.col("WorkTransType"), F.col("WorkTemplateCode"), location, profile, zone)
    return t.work_lines.select("OrderNum", "LineNum", supply.alias("supply"), S.destination_class(location, profile, zone).alias("destination"),
        S.reservation_bucket(location, profile).alias("bucket"))


@query("""select SalesID, LineNum, abs(QtyOrdered) * MSRP as gross, case when MSRP <> 0 and QtyOrdered <> 0 then round(1 - LineAmount / (QtyOrdered * MSRP), 6)
  end as off, LineDiscPercent > 0 or round(1 - LineAmount / nullif(QtyOrdered * MSRP, 0), 6) >= 0.05 as discounted,
  least(greatest(case when LineDiscPercent > 1 then LineDiscPercent / 100 else LineDiscPercent end, 0), 1) as unit_discount from order_lines""")
def order_line_enrichment(t):
    """PRJ8 unit discounts, PRJ9 gross, discount share and flag."""
    gross = F.col("QtyOrdered") * F.col("MSRP")
    off = F.round(1 - S.ratio_or_null(F.col("LineAmount"), gross), 6)
    return t.order_lines.select("SalesID", "LineNum", F.abs(gross).alias("gross"), off.alias("off"),
        ((F.col("LineDiscPercent") > 0) | (off >= 0.05)).alias("discounted"), S.unit_discount(F.col("LineDiscPercent")).alias("unit_discount"))


@query("""select event_id, SKU_code as code, nullif(regexp_extract(SKU_code, '^([A-Z0-9]+)-([A-Z0-9]+)(?:-.*)?$', 1), '') as item,
  nullif(regexp_extract(SKU_code, '^([A-Z0-9]+)-([A-Z0-9]+)(?:-.*)?$', 2), '') as color, d as disc,
  case when sheet_type = 'coupon' then 1.0 when d <= 0 then 1.25 else least(greatest(1 + least(d, 1.0) * 0.75, 1.0), 2.0) end as mult,
  regexp_matches(sheet_type, '(?i)markdown') as is_markdown, regexp_matches(sheet_type, '(?i)final.?sale') as is_final
  from (select event_id, sheet_type, upper(offer_cc) as SKU_code, round(case when pct_off_msrp > 1 then pct_off_msrp / 100 else pct_off_msrp end, 6) as d
  from promo_offers where sheet_type in ('promo_detail', 'markdown', 'final_sale', 'coupon') and end_date - start_date between 1 and 60)""")
def offer_features(t):
    """PRJ18 multiplier, PRJ25 offer codes, PRJ26 modelable offers, PRJ28 flags."""
    rows = t.promo_offers.where(F.col("sheet_type").isin("promo_detail", "markdown", "final_sale", "coupon") & F.datediff("end_date",
        "start_date").between(1, 60))
    d = F.round(F.when(F.col("pct_off_msrp") > 1, F.col("pct_off_msrp") / 100).otherwise(F.col("pct_off_msrp")), 6)
    code = S.offer_code(F.col("offer_cc"))
    return rows.select("event_id", F.upper("offer_cc").alias("code"), code["Item"].alias("item"), code["Color"].alias("color"), d.alias("disc"),
        S.promo_multiplier(F.col("sheet_type") != "coupon", d).alias("mult"), F.col("sheet_type").rlike("(?i)markdown").alias("is_markdown"),
            F.col("sheet_type").rlike("(?i)final.?sale").alias("is_final"))


@query("""select ActualDate, SKU, isodow(ActualDate) - 1 as dow, week(ActualDate) as week, month(ActualDate) as month, (ActualDate + interval 1 year)::date
  as next_year from actual_sku_day""")
def calendar_features(t):
    """PRJ29 calendar columns, PRJ30 the same day of another year."""
    return t.actual_sku_day.select("ActualDate", "SKU", F.weekday("ActualDate").alias("dow"), F.weekofyear("ActualDate").alias("week"),
        F.month("ActualDate").alias("month"), S.same_day_of_year(F.col("ActualDate"), 1).alias("next_year"))


@query("""select k, SnapshotId, case when InferredFileDate < ForecastStartDate then 'clean_frozen' when InferredFileDate = ForecastStartDate then 'same_day'
  else 'late' end as freeze, substr(sha256(SnapshotId || '|' || ForecastStartDate::varchar), 1, 12) as content_id from vintages""")
def vintage_classes(t):
    """PRJ17 freeze class, SRC12 content ids."""
    return t.vintages.select("k", "SnapshotId", S.freeze_class(F.col("InferredFileDate"), F.col("ForecastStartDate")).alias("freeze"),
        F.substring(F.sha2(F.concat_ws("|", "SnapshotId", F.col("ForecastStartDate").cast("string")).cast("binary"), 256), 1, 12).alias("content_id"))


@query("""select coalesce(f.SnapshotId, a.SnapshotId) as SnapshotId, coalesce(f.SKU, a.SKU) as SKU, coalesce(f.F, 0) as ForecastUnits, coalesce(a.S, 0)
  as SoldUnits from
  (select SnapshotId, SKU, sum(ForecastQty) as F from forecast_sku_day group by all) f full join (select v.SnapshotId, a.SKU, sum(a.SoldUnits) as S
  from vintages v join actual_sku_day a on a.ActualDate between v.ForecastStartDate and v.ForecastStartDate + 13 group by all) a on f.SnapshotId = a.SnapshotId
  and f.SKU = a.SKU""")
def forecast_actual_outer(t):
    """JN1 full outer with zero fill, AG51 actual windows, FC13 frozen candidate."""
    days = t.vintages.select("SnapshotId", F.explode(F.sequence(F.col("ForecastStartDate"), F.date_add("ForecastStartDate", 13))).alias("ActualDate"))
    sold = t.actual_sku_day.join(days, "ActualDate").groupBy("SnapshotId", "SKU").agg(F.sum("SoldUnits").alias("SoldUnits"))
    ahead = t.forecast_sku_day.groupBy("SnapshotId", "SKU").agg(F.sum("ForecastQty").alias("ForecastUnits"))
    return J.full_outer_zero(ahead, sold, ["SnapshotId", "SKU"], ["ForecastUnits", "SoldUnits"])


_ASOF = "select a.ActualDate, a.SKU, a.SoldUnits, i.SnapshotDate, i.AvailPhysical from actual_sku_day a asof left join inventory_sku_day i on a.SKU = i.SKU and a.ActualDate {0} i.SnapshotDate"


@query(_ASOF.format(">="))
def asof_inventory(t):
    """JN4 as-of join, latest at or before."""
    return J.asof_latest(t.actual_sku_day.select("ActualDate", "SKU", "SoldUnits"), t.inventory_sku_day.select("SKU", "SnapshotDate", "AvailPhysical"),
        ["SKU"], "ActualDate", "SnapshotDate")


@query("select ActualDate, SKU, SoldUnits, case when ActualDate - SnapshotDate <= 35 then SnapshotDate end as SnapshotDate, case when ActualDate - SnapshotDate <= 35 then AvailPhysical end as AvailPhysical from (" + _ASOF.format(">") + ")")
def asof_inventory_fresh(t):
    """JN5 and JN6 as-of join with tolerance, strictly before; no fallback to older rows."""
    return J.asof_latest(t.actual_sku_day.select("ActualDate", "SKU", "SoldUnits"), t.inventory_sku_day.select("SKU", "SnapshotDate", "AvailPhysical"),
        ["SKU"], "ActualDate", "SnapshotDate", tolerance=35, strict=True)


@query("""select ForecastStartDate, SnapshotDate, count(*) as n, sum(AvailPhysical) as avail from (select v.ForecastStartDate, max(i.SnapshotDate)
  as SnapshotDate from vintages v join (select distinct SnapshotDate from inventory_sku_day) i on i.SnapshotDate <= v.ForecastStartDate - 1 group by 1)
  join inventory_sku_day using (SnapshotDate) group by all""")
def latest_inventory_snapshot(t):
    """JN6 whole latest snapshot before an origin."""
    rows = J.latest_snapshot(t.inventory_sku_day, t.vintages.select("ForecastStartDate"), "ForecastStartDate", "SnapshotDate", 1)
    return rows.groupBy("ForecastStartDate", "SnapshotDate").agg(F.count("*").alias("n"), F.sum("AvailPhysical").alias("avail"))


@query("""select f.SnapshotId, f.SKU, f.ForecastStartDate, coalesce(sum(a.SoldUnits), 0) as Sold14 from (select distinct SnapshotId, SKU, ForecastStartDate
  from forecast_sku_day) f left join actual_sku_day a on a.SKU = f.SKU and a.ActualDate >= f.ForecastStartDate and a.ActualDate < f.ForecastStartDate + 14
  group by all""")
def interval_actuals(t):
    """JN10 interval join of [start, start + 14)."""
    starts = t.forecast_sku_day.select("SnapshotId", "SKU", "ForecastStartDate").distinct()
    return J.in_window(starts, t.actual_sku_day, ["SKU"], "ForecastStartDate", "ActualDate", 14, "SoldUnits", "Sold14")


@query("""select f.SKU, f.ForecastStartDate, coalesce(sum(a.SoldUnits), 0) / 14 as Seasonal from (select distinct SKU, ForecastStartDate
  from forecast_sku_day) f left join (select 1 as y union all select 2) on true left join actual_sku_day a on a.SKU = f.SKU
  and a.ActualDate between (f.ForecastStartDate - to_years(y))::date - 3 and (f.ForecastStartDate - to_years(y))::date + 3 group by all""")
def seasonal_demand(t):
    """JN11 same season of prior years."""
    starts = t.forecast_sku_day.select("SKU", "ForecastStartDate").distinct()
    return J.seasonal_mean(starts, t.actual_sku_day, ["SKU"], "ForecastStartDate", "ActualDate", "SoldUnits", 2, 3, "Seasonal")


_GRAINS = """g as (select SKU, unnest(['sku', 'item_color', 'group', 'category_size']) as Grain, unnest([SKU, Item || '-' || Color, ProductGroupCode, Category || '-' || Size]) as Key
    from dim_product), a as (select Grain, Key, ActualDate, sum(SoldUnits) as u from actual_sku_day join g using (SKU) group by all),
  q as (select distinct ForecastStartDate, Grain, Key from forecast_sku_day join g using (SKU))"""


@query(f"""with {_GRAINS} select q.Grain, q.Key, q.ForecastStartDate, coalesce(sum(u), 0) / 14 as Seasonal from q left join (select 1 as y union all select 2) on true
  left join a on a.Grain = q.Grain and a.Key = q.Key and a.ActualDate between (q.ForecastStartDate - to_years(y))::date - 3 and (q.ForecastStartDate - to_years(y))::date + 3
  group by all""")
def seasonal_grains(t):
    """FC19 same season of prior years at four grains: SKU, item and colour, product group, category and size, in one scan and one window."""
    keys = {"sku": F.col("SKU"), "item_color": F.concat_ws("-", "Item", "Color"), "group": F.col("ProductGroupCode"), "category_size": F.concat_ws("-", "Category", "Size")}
    grains = F.explode(F.array(*[F.struct(F.lit(n).alias("Grain"), c.alias("Key")) for n, c in keys.items()])).alias("g")
    products = t.dim_product.select("SKU", grains).select("SKU", "g.*")
    # a day of a grain is one row before the window, however many SKUs the grain has
    facts = t.actual_sku_day.join(products, "SKU").groupBy("Grain", "Key", "ActualDate").agg(F.sum("SoldUnits").alias("SoldUnits"))
    asks = t.forecast_sku_day.select("SKU", "ForecastStartDate").distinct().join(products, "SKU").select("Grain", "Key", "ForecastStartDate").distinct()
    return J.seasonal_mean(asks, facts, ["Grain", "Key"], "ForecastStartDate", "ActualDate", "SoldUnits", 2, 3, "Seasonal")


@query("""select count(*) filter (b.SKU is null) as old_only, count(*) filter (a.SKU is null) as new_only, count(*) filter (a.SKU is not null
  and b.SKU is not null) as shared from (select distinct SKU from inventory_sku_day) a full join (select distinct SKU from actual_sku_day) b on a.SKU = b.SKU""")
def sku_set_difference(t):
    """JN15 and JN16 membership and set difference."""
    return J.set_difference(t.inventory_sku_day, t.actual_sku_day, "SKU")


@query("""select a.SKU, a.ActualDate, a.SoldUnits, i.AvailPhysical from actual_sku_day a join inventory_sku_day i on i.SKU = a.SKU
  and i.SnapshotDate + 1 = a.ActualDate""")
def lagged_inventory(t):
    """JN9 one-day-lag join."""
    lag = J.days_later(t.inventory_sku_day.select("SKU", F.col("SnapshotDate").alias("ActualDate"), "AvailPhysical"), "ActualDate", 1)
    return t.actual_sku_day.join(lag, ["SKU", "ActualDate"]).select("SKU", "ActualDate", "SoldUnits", "AvailPhysical")
