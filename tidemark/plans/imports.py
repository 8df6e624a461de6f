"""Queries of imports: file names, weekly picks, sheets as cells, crosswalks, coupons, vintages that are replaced."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import joins as J
from tidemark.operators import sheets as H
from tidemark.plans.registry import query
from tidemark.sources import scans, sinks, vintages
from tidemark.sources.store import PartStore

#: Aliases of header keys: those of all sheets, and one of these sheets' own.
ALIASES = H.ALIASES | {"promo_and_dollar_price": "promo_price"}


@query(r"""with c as (select id, name, modified, case kind when 0 then [make_date(y::int, m::int, d::int)] when 1 then [make_date(y::int, m::int, d::int)]
    when 2 then (select list(x) from (select unnest([case when length(b) = 3 then try_cast('20' || right(y, 2) || '-' || lpad(b[1:1], 2, '0') || '-' || b[2:3]
  as date) else try_cast('20' || right(y, 2) || '-' || b[1:2] || '-' || b[3:4] as date) end, case when length(b) = 3 then try_cast('20' || right(y,
  2) || '-' || b[1:2] || '-0' || b[3:3] as date) end]) as x) where x is not null) else [modified] end as found
    from (select *, m || lpad(d, 2, '0') as b from source_files))
  select id, name, len(found) as n, found[1] as near from (select id, name,
  [x.d for x in list_sort([{'far': abs(x - modified), 'd': x} for x in list_distinct(found)])] as found from c)""")
def file_dates(t):
    """SRC11 and PRJ46 dates in file names, nearest to the file's own first."""
    rows = t.source_files.select("id", "name", H.dates_in_name(F.col("name"), F.col("modified")).alias("found"))
    return rows.select("id", "name", F.size("found").cast("long").alias("n"), F.element_at("found", 1).alias("near"))


@query("""with h as (select * from source_files qualify row_number() over (partition by sha256(content || '|' || start_min::varchar) order by modified, name,
  id) = 1), k as (select *, case folder when 'Error' then 0 when 'Complete' then 1 when 'Processing' then 2 else 9 end as p from h)
  select id, name, folder, start_min, skus, units, row_number() over (partition by start_min, skus, units order by p, modified, name, id) = 1 as selected from k""")
def weekly_files(t):
    """ST7 files of equal content once, and of each weekly key the file of the first folder; TK5 earliest first."""
    f = t.source_files.withColumn("hash", F.sha2(F.concat_ws("|", "content", F.col("start_min").cast("string")).cast("binary"), 256))
    once = J.keep_one(f, ["hash"], ["modified", "name", "id"])
    rank = F.coalesce(*[F.when(F.col("folder") == n, F.lit(k)) for k, n in enumerate(("Error", "Complete", "Processing"))], F.lit(9))
    rows = once.withColumn("p", rank)
    best = rows.groupBy("start_min", "skus", "units").agg(F.min(F.struct("p", "modified", "name", "id"))["id"].alias("best"))
    return rows.join(best, ["start_min", "skus", "units"]).select("id", "name", "folder", "start_min", "skus", "units",
        (F.col("id") == F.col("best")).alias("selected"))


_KEY = r"trim(regexp_replace(replace(replace(replace(lower(trim(regexp_replace(val, '\s+', ' ', 'g'))), '%', ' pct '), '&', ' and '), '$', ' dollar '), '[^a-z0-9]+', '_', 'g'), '_')"
_ALIASED = f"case {' '.join(f"when raw = '{a}' then '{b}'" for a, b in ALIASES.items())} when raw = '' then 'unnamed_' || (cl + 1) else raw end"
_WORTH = f"case {' '.join(f"when header = '{k}' then {v}" for k, v in H.SCORES.items())} else 0 end"
_KEYED = f"""k1 as (select *, {_ALIASED} as key from (select *, {_KEY} as raw from cells)),
  k2 as (select *, row_number() over (partition by file_id, sheet_name, rw, key order by cl) as n from k1),
  keyed as (select *, case when n = 1 then key else key || '_' || n end as header from k2),
  heads as (select file_id, sheet_name, arg_max(rw, (score, -rw)) as header_row, max(score) as score from (select file_id, sheet_name, rw, sum({_WORTH}) as score
    from keyed where rw < 35 group by all) group by all having max(score) >= 7)"""


@query(f"with {_KEYED} select file_id, sheet_name, rw, cl, header from keyed")
def header_keys(t):
    """PRJ6 labels of all rows in snake case, by all aliases, told apart."""
    return H.keyed(t.cells, ALIASES).select("file_id", "sheet_name", "rw", "cl", "header")


@query(f"with {_KEYED} select * from heads")
def header_rows(t):
    """FC26 the header row of each sheet, by score."""
    return H.header_rows(t.cells, ALIASES)


_FILE_NAME = "case file_id % 7 when 0 then 'Coupon book ' when 1 then 'Markdown ' else 'Promo ' end || file_id::varchar || '.xlsx'"
_FILE_DATE = "date '1998-03-01' + (file_id * 37 % 300)::int"


def _date_sql(text: str) -> str:
    """(first, last) of a date range in a text, as a SQL struct over columns fd (the file's date) and the text."""
    return f"""(select {{'first': first, 'last': case when first is null then null else coalesce(last, first) end}} from (select first,
      case when b.y = '' and make_last < first then coalesce(try_cast(format('{{:04d}}-{{:02d}}-{{:02d}}', year(first) + 1, b.m, b.d) as date), first) else make_last end as last
      from (select *, try_cast(format('{{:04d}}-{{:02d}}-{{:02d}}', case when b.y = '' then year(first) when length(b.y) = 2 then try_cast(b.y as int) + 2000 else try_cast(b.y as int) end, b.m, b.d) as date) as make_last
      from (select *, try_cast(format('{{:04d}}-{{:02d}}-{{:02d}}', case when a.y = '' then year(fd) when length(a.y) = 2 then try_cast(a.y as int) + 2000 else try_cast(a.y as int) end, a.m, a.d) as date) as first
      from (select x[1] as a, x[2] as b from (select [{{'m': regexp_extract(z, '^([0-9]+)[/.-]([0-9]+)', 1)::int, 'd': regexp_extract(z, '^([0-9]+)[/.-]([0-9]+)', 2)::int,
        'y': regexp_extract(z, '^[0-9]+[/.-][0-9]+[/.-]([0-9]+)', 1)}} for z in regexp_extract_all(coalesce({text}, ''), '[0-9]{{1,2}}[/.-][0-9]{{1,2}}(?:[/.-][0-9]{{2,4}})?')] as x))))))"""


_EVENTS = f"""{_KEYED}, lab as (select file_id, sheet_name, key, arg_min(nx, (rw, cl)) as nx from (select *, lead(val) over (partition by file_id, sheet_name, rw
    order by cl) as nx from keyed where trim(val) <> '') where key in ('event_name', 'effective_date_s') and nx is not null group by all),
  sh as (select file_id, sheet_name, max(rw) + 1 as height, max(cl) + 1 as width, {_FILE_NAME} as source_file, {_FILE_DATE} as fd from cells group by all),
  s as (select sh.*, e.nx as event, d.nx as dates, header_row, lower(source_file || ' ' || sheet_name || ' ' || coalesce(e.nx, '')) as x from sh
    left join (select * from lab where key = 'event_name') e using (file_id, sheet_name) left join (select * from lab where key = 'effective_date_s') d using (file_id, sheet_name)
    left join heads using (file_id, sheet_name)),
  k as (select *, case when x like '%coupon%' then 'coupon' when header_row is null then case when x like '%pivot%' then 'rollup_or_pivot' else 'non_offer' end
    when x like '%final sale%' then 'final_sale' when x like '%markdown%' then 'markdown' when lower(sheet_name) like 'promo offers%' then 'aggregate_promo_offers'
    else 'promo_detail' end as kind from s)"""


@query(f"with {_EVENTS} select file_id, sheet_name, event, header_row, kind from k")
def sheet_kinds(t):
    """PRJ21 kinds of sheets, by the words in the names of file, sheet and event."""
    return H.sheet_events(t.cells, _workbooks(t), ALIASES).select(*H.SHEET, "event", "header_row", "kind")


def _workbooks(t):
    """Names and dates of the files."""
    ids = t.cells.select("file_id").distinct()
    name = F.concat(F.when(F.col("file_id") % 7 == 0, "Coupon book ").when(F.col("file_id") % 7 == 1, "Markdown ").otherwise("Promo "), F.col("file_id").cast("string"), F.lit(".xlsx"))
    return ids.select("file_id", name.alias("source_file"), F.date_add(F.lit("1998-03-01").cast("date"), (F.col("file_id") * 37 % 300).cast("int")).alias("file_date"))


@query(f"""with {_EVENTS}, r as (select *, {_date_sql('dates')} as own, {_date_sql('sheet_name')} as named from k),
  z as (select *, case when own.first is not null then own else named end as p from r),
  q as (select *, month(fd) >= 10 and month(p.first) <= 3 and p.first < fd as late from z)
  select file_id, sheet_name, source_file, height, width, header_row, event, trim(dates) as dates, kind, case when late then (p.first + interval 1 year)::date else p.first end as start_date,
  case when late then (p.last + interval 1 year)::date else p.last end as end_date from q""")
def sheet_events(t):
    """FC27 a record for each sheet, with PRJ23 the dates of its event from the label or the sheet's name, and PRJ24 the year after for a file of the last quarter."""
    return H.sheet_events(t.cells, _workbooks(t), ALIASES)


@query(f"""with {_KEYED}, b as (select k.file_id, k.sheet_name, k.rw, h.header, trim(k.val) as val from keyed k join heads using (file_id, sheet_name)
  join (select x.file_id, x.sheet_name, cl, header from keyed x join heads y on y.file_id = x.file_id and y.sheet_name = x.sheet_name
  and y.header_row = x.rw) h on h.file_id = k.file_id and h.sheet_name = k.sheet_name and h.cl = k.cl where k.rw > header_row),
  r as (select file_id, sheet_name, rw, coalesce(max(val) filter (header = 'offer'), '') as offer, coalesce(max(val) filter (header = 'style'), '') as style,
  coalesce(max(val) filter (header = 'pct_off_msrp'), '') as pct, coalesce(max(val) filter (header = 'promo_price'), '') as price from b group by all)
  select file_id, sheet_name, rw, offer, case when style = '' then string_split(offer, '-')[1] else style end as style, try_cast(replace(pct, '%', '')
  as double) / 100 as discount, try_cast(replace(price, '$', '') as double) as price from r where (offer <> '' or style <> '') and lower(offer) <> 'offer'""")
def sheet_records(t):
    """FC27 and PRJ38 records of all sheets with a header, valid rows alone; PRJ39 sheets without records have none."""
    rows = H.records(t.cells, ALIASES, ["offer", "style", "pct_off_msrp", "promo_price"])
    return rows.select(*H.SHEET, "rw", "offer", "style", (S.to_number(F.col("pct_off_msrp")) / 100).alias("discount"),
        S.to_number(F.col("promo_price")).alias("price"))


@query("""select try_cast(d.val as date) as Date, p.val::double as PlanUnits, a.val::double as ActualUnits, round(p.val::double / nullif(a.val::double, 0), 6)
  as PlanVsActual from planner_cells d left join planner_cells p on p.cl = d.cl and p.rw = 9 left join planner_cells a on a.cl = d.cl and a.rw = 12
  where d.rw = 4 and try_cast(d.val as date) is not null""")
def planner_grid(t):
    """FC25 a grid with dates across to a table by day: rows are found by their labels, columns by the date row."""
    cells = t.planner_cells
    labels = cells.where("cl = 0").select("rw", F.lower(F.trim("val")).alias("label"))
    named = cells.where("cl > 0").join(labels, "rw")
    pick = lambda label: F.max(F.when(F.col("label") == label, F.col("val")))
    rows = named.groupBy("cl").agg(pick("date").try_cast("date").alias("Date"), pick("ops imf plan").try_cast("double").alias("PlanUnits"),
        pick("actual demand (units)").try_cast("double").alias("ActualUnits"))
    return rows.where("Date is not null").select("Date", "PlanUnits", "ActualUnits",
        F.round(S.ratio_or_null(F.col("PlanUnits"), F.col("ActualUnits")), 6).alias("PlanVsActual"))


@query("""with x as (select unnest(generate_series(start_date, end_date, interval 1 day))::date as day, event_id, promo_scope from promo_events
  where sheet_type = 'coupon'), f as (select day, promo_scope, min(event_id) as first from x where promo_scope <> '' group by all)
  select day, count(*) as Coupons, max(event_id % 60) as MaxPercent, coalesce((select string_agg(promo_scope, '|' order by first) from f where f.day = x.day),
  '') as Scopes from x group by day""")
def coupon_days(t):
    """AG16 coupons by day, AG14 scopes in the order in which they are first seen, blanks skipped."""
    x = t.promo_events.where("sheet_type = 'coupon'").select(F.explode(F.sequence("start_date", "end_date")).alias("day"), "event_id", "promo_scope")
    scopes = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(F.col("promo_scope") != "", F.struct("event_id", "promo_scope")))),
        lambda s: s["promo_scope"]))
    return x.groupBy("day").agg(F.count("*").alias("Coupons"), F.max(F.col("event_id") % 60).alias("MaxPercent"), F.array_join(scopes, "|").alias("Scopes"))


@query("""with n as (select SKU, trim(upper(GroupCode)) as g, trim(upper(SizeCode)) as s, last_seen, source_file, SalesID from ledger), a as (select * from n
  qualify row_number() over (partition by SKU order by last_seen desc, source_file desc, SalesID desc) = 1), b as (select * from n qualify row_number()
  over (partition by SKU order by g, last_seen desc, SalesID desc) = 1)
  select SKU, case when a.g || a.s = '' then 'UNKNOWN' else a.g || a.s end as Newest, case when b.g <> '' and b.s <> '' then b.g || b.s when b.g <> '' then b.g
  else 'UNKNOWN' end as FirstGroup from a join b using (SKU)""")
def crosswalks(t):
    """SRC13 a SKU's category by its newest row, SRC14 by its first group code: two rules that differ."""
    n = t.ledger.select("SKU", F.trim(F.upper("GroupCode")).alias("g"), F.trim(F.upper("SizeCode")).alias("s"), "last_seen", "source_file", "SalesID")
    newest, lowest = F.max(F.struct("last_seen", "source_file", "SalesID", "g", "s")), F.min(F.struct("g", (-F.unix_date("last_seen")).alias("d"),
        (-F.col("SalesID")).alias("i"), "s"))
    rows = n.groupBy("SKU").agg(newest.alias("a"), lowest.alias("b"))
    both = F.concat("a.g", "a.s")
    return rows.select("SKU", F.when(both == "", "UNKNOWN").otherwise(both).alias("Newest"),
        F.when((F.col("b.g") != "") & (F.col("b.s") != ""), F.concat("b.g", "b.s")).when(F.col("b.g") != "",
            F.col("b.g")).otherwise("UNKNOWN").alias("FirstGroup"))


#: Imports: every fifth vintage with other quantities; of these every second has an id of its own, the others that of an old one.
_NEW = """n as (select case when k % 10 = 0 then SnapshotId else 'N' || SnapshotId end as SnapshotId, SKU, ForecastDate, ForecastQty + 1 as ForecastQty
  from forecast_sku_day join (select k, SnapshotId from vintages where k % 5 = 0) using (SnapshotId))"""


def _tables(rows):
    """A vintage's three tables: its file, its SKUs and its days."""
    return {
        "file": rows.groupBy("SnapshotId").agg(F.countDistinct("SKU").alias("SKUs"), F.sum("ForecastQty").alias("Units")),
        "sku": rows.groupBy("SnapshotId", "SKU").agg(F.sum("ForecastQty").alias("Units")), "day": rows,
    }


def _replaced(t, overwrite: bool):
    """A store of all vintages, into which others are imported."""
    # written once: an import reads its rows for the parts and again for each of its tables
    old = sinks.kept(t.forecast_sku_day.select("SnapshotId", "SKU", "ForecastDate", "ForecastQty"), "days")
    numbers = t.vintages.where("k % 5 = 0").select("SnapshotId", "k")
    new = old.join(numbers, "SnapshotId").select(F.when(F.col("k") % 10 == 0, F.col("SnapshotId")).otherwise(F.concat(F.lit("N"), "SnapshotId")).alias("SnapshotId"), "SKU",
        "ForecastDate", (F.col("ForecastQty") + 1).alias("ForecastQty"))
    store = PartStore(old.sparkSession, sinks.work_folder(old.sparkSession, "vintages"))
    store.replace_parts(_tables(old), "SnapshotId")
    return store, store.replace_parts(_tables(new), "SnapshotId", overwrite)


@query(f"with {_NEW} select SnapshotId, SKU, ForecastDate, ForecastQty from forecast_sku_day where SnapshotId not in (select SnapshotId from n) union all select * from n")
def vintage_replace(t):
    """SNK8 and ST2 what has an imported id goes as a whole from the stored tables, other vintages stay: the days."""
    return _replaced(t, True)[0].read("day")


@query(f"""with {_NEW}, d as (select SnapshotId, SKU, ForecastQty from forecast_sku_day union all select SnapshotId, SKU, ForecastQty from n
  where SnapshotId not in (select SnapshotId from vintages)), u as (select SnapshotId, count(distinct SKU) as SKUs, sum(ForecastQty) as Units, count(*) as Days from d
  group by 1), i as (select distinct SnapshotId as part from n)
  select SnapshotId, SKUs, Units, SKUs as SkuRows, Days as DayRows, case when part is null then 'old' when SnapshotId like 'N%' then 'imported' else 'skipped' end as Status
  from u left join i on part = SnapshotId""")
def vintage_tables(t):
    """SNK8 the three tables of each vintage after an import that may not overwrite: known ids are skipped in all of them."""
    store, status = _replaced(t, False)
    count = lambda table, name: store.read(table).groupBy("SnapshotId").agg(F.count("*").alias(name))
    rows = store.read("file").join(count("sku", "SkuRows"), "SnapshotId").join(count("day", "DayRows"), "SnapshotId")
    rows = rows.join(status.withColumnRenamed("part", "SnapshotId"), "SnapshotId", "left")
    return rows.select("SnapshotId", "SKUs", "Units", "SkuRows", "DayRows", F.coalesce("status", F.lit("old")).alias("Status"))


_FDS = ", ".join(f"coalesce(sum(ForecastQty) filter (ForecastDayOffset = {k}), 0) as FD{k}" for k in range(1, 15))
_DAY_LIST = ", ".join(f"FD{k}" for k in range(1, 15))
_WIDE = f"""x as (select SnapshotId, k, SKU, Velocity, PutawayIndicator, start, {_FDS} from (select f.SnapshotId, v.k, f.SKU, p.Velocity, p.PutawayIndicator,
    f.ForecastStartDate as start, ForecastDayOffset, ForecastQty from forecast_sku_day f join vintages v on v.SnapshotId = f.SnapshotId join dim_product p on p.SKU = f.SKU) group by all),
  raw as (select 'FwdDemandCSV_' || SnapshotId || '.csv' as SourceFile, * from x union all select 'FwdDemandCSV_' || SnapshotId || '_again.csv', * from x where k % 8 = 0
    union all select 'FwdDemandCSV_' || SnapshotId || '_twice.csv', * from x where k % 8 = 1 union all select 'FwdDemandCSV_' || SnapshotId || '_twice.csv', * from x where k % 8 = 1),
  txt as (select *, concat_ws('|', SKU, Velocity, PutawayIndicator::varchar, start::varchar, {", ".join(f"FD{k}::decimal(18,4)::varchar" for k in range(1, 15))}) as t,
    {" + ".join(f"FD{k}" for k in range(1, 15))} as total, hash_bad from (select *, ('0x' || substr(md5(SKU), 1, 1))::int = 7 as hash_bad from raw)),
  files as (select SourceFile, count(*) as RowsImported, count(distinct SKU) as DistinctSKUs, min(start) as ForecastStartDateMin, max(start) as ForecastStartDateMax,
    sum(total) as TotalForecastUnits, count(*) filter (total > 0) as ForecastedSKUs, count(*) filter (total = 0) as ZeroForecastSKUs,
    count(*) filter (PutawayIndicator = 1) as ActiveSKUCount, count(*) filter (PutawayIndicator = 0) as ReserveSKUCount, count(*) filter (PutawayIndicator = 2) as OffsiteSKUCount,
    count(*) filter (hash_bad) as FilledStarts, sha256(count(*)::varchar || ':' || sum(('0x' || substr(md5(t), 1, 15))::bigint)::varchar || ':'
    || sum(('0x' || substr(md5(t), 17, 15))::bigint)::varchar) as ContentId from txt group by 1),
  meta as (select *, sha256(lower(SourceFile) || '|' || ContentId) as SnapshotId, case when DistinctSKUs < RowsImported then 'duplicate_skus'
    when row_number() over (partition by ContentId order by SourceFile) > 1 then 'skipped_content' else 'imported' end as Status from files)"""


def _wide_files(t):
    """The vintages as wide CSV files on disk, some again in another order under other names and some with every SKU twice; some starts are no dates."""
    f = t.forecast_sku_day.join(t.vintages.select("SnapshotId", "k"), "SnapshotId").join(t.dim_product.select("SKU", "Velocity", "PutawayIndicator"), "SKU")
    sums = [F.coalesce(F.sum(F.when(F.col("ForecastDayOffset") == k, F.col("ForecastQty"))), F.lit(0.0)).alias(c) for k, c in enumerate(vintages.DAYS, 1)]
    wide = f.groupBy("SnapshotId", "k", "SKU", "Velocity", "PutawayIndicator", "ForecastStartDate").agg(*sums)
    bad = F.conv(F.substring(F.md5(F.col("SKU").cast("binary")), 1, 1), 16, 10).cast("int") == 7
    wide = wide.withColumn("ForecastStartDate", F.when(bad, "n/a").otherwise(F.col("ForecastStartDate").cast("string")))
    kinds = F.when(F.col("k") % 8 == 0, F.array(F.lit(""), F.lit("_again"))).when(F.col("k") % 8 == 1, F.array(F.lit(""), F.lit("_twice"), F.lit("_twice"))).otherwise(F.array(F.lit("")))
    rows = wide.withColumn("_kind", F.explode(kinds)).withColumn("SourceFile", F.concat(F.lit("FwdDemandCSV_"), "SnapshotId", "_kind", F.lit(".csv")))
    path = sinks.work_folder(f.sparkSession, "wide")
    rows.select("SourceFile", *vintages.COLUMNS).write.partitionBy("SourceFile").option("header", True).csv(path)
    return vintages.typed(f.sparkSession.read.option("header", True).csv(path), F.col("SourceFile"))


@query(f"with {_WIDE} select * from meta")
def vintage_imports(t):
    """SRC5, SRC10, SRC12 and ST7: wide CSV files read by path; bad starts take the file's most common one, files with a SKU twice are
    rejected, and of files with the same rows in any order the first is imported; the metadata of each."""
    return vintages.file_metadata(_wide_files(t))


@query(f"""with {_WIDE} select SnapshotId, SKU, ForecastStartDate, k::int as ForecastDayOffset, ForecastStartDate + (k - 1)::int as ForecastDate, q as ForecastQty
  from (select meta.SnapshotId, SKU, start as ForecastStartDate, unnest(range(1, 15)) as k, unnest([{_DAY_LIST}]) as q from txt join meta using (SourceFile)
  where Status = 'imported') where q <> 0""")
def vintage_days(t):
    """SRC10 the imported files' days as rows, those without units left out."""
    rows = _wide_files(t)
    return vintages.by_day(rows, vintages.file_metadata(rows))


@query("""with v as (select k, SnapshotId, ForecastStartDate as d from vintages), r as (select SKU, last_seen, SalesID, upper(GroupCode) as g
  from ledger) select v.SnapshotId, r.SKU, coalesce(nullif(arg_max(g, (last_seen, SalesID)), ''), 'UNKNOWN') as Category from v join r on r.last_seen < v.d
  group by all""")
def vintage_categories(t):
    """JN8 and JN7 each SKU's category as it was known when a vintage began: the last row before its start."""
    starts = t.vintages.select("SnapshotId", F.col("ForecastStartDate").alias("d"))
    rows = t.ledger.select("SKU", "last_seen", "SalesID", F.upper("GroupCode").alias("g"))
    last = rows.groupBy("SKU", "last_seen").agg(F.max(F.struct("SalesID", "g"))["g"].alias("g"))
    skus = last.select("SKU").distinct()
    asks = starts.agg(F.array_sort(F.collect_list(F.struct("d", "SnapshotId"))).alias("s"))
    events = skus.withColumn("s", F.explode(asks.scalar())).select("SKU", "s.SnapshotId", F.col("s.d").alias("d"))
    known = J.asof_latest(events, last, ["SKU"], "d", "last_seen", strict=True).where("last_seen is not null")
    return known.select("SnapshotId", "SKU", F.coalesce(F.nullif(F.col("g"), F.lit("")), F.lit("UNKNOWN")).alias("Category"))


@query("""select year(Date)::int as Year, count(*) as Rows, sum(PlanUnits)::double as PlanUnits, sum(ActualUnits) filter (year(Date) % 2 = 0)::double
  as ActualUnits from planner_daily group by 1""")
def planner_years(t):
    """SRC23 and SRC4 a folder of year parts with different columns, read as one table, null where a part lacks one; FC32 which columns there are."""
    plan = t.planner_daily.withColumn("Year", F.year("Date"))
    path = sinks.work_folder(plan.sparkSession, "years")
    plan.where("Year % 2 = 1").select("Year", "Date", "PlanUnits").write.partitionBy("Year").parquet(path)
    plan.where("Year % 2 = 0").select("Year", "Date", "PlanUnits", "ActualUnits").write.mode("append").partitionBy("Year").parquet(path)
    both = scans.read_parts(plan.sparkSession, path)
    sums = scans.available(both, ["PlanUnits", "ActualUnits", "ShippedUnits"])
    return both.groupBy("Year").agg(F.count("*").alias("Rows"), *[F.sum(c).cast("double").alias(c) for c in sums])


@query("""select ActualDate, SKU, SoldUnits from actual_sku_day, (select min(ActualDate) as a, max(ActualDate) as b from actual_sku_day)
  where ActualDate between a + 100 and b - 100""")
def portable_actuals(t):
    """SRC1, SRC6 and SRC7: actuals exported as CSV and as Parquet under other names, read by suffix, probed for their columns, cut to a span."""
    rows, spark = t.actual_sku_day, t.actual_sku_day.sparkSession
    path = sinks.work_folder(spark, "portable")
    early = F.year("ActualDate") % 2 == 0
    rows.where(early).select(F.col("ActualDate").alias("PickDate"), F.concat(F.lit(" "), "SKU").alias("SKU"), F.col("SoldUnits").alias("PickUnits")).write.option("header",
        True).csv(f"{path}/early.csv")
    rows.where(~early).select(F.col("ActualDate").alias("Date"), "SKU", F.col("SoldUnits").alias("Units"), "PickLines").write.parquet(f"{path}/late.parquet")
    first, last = rows.agg(F.date_add(F.min("ActualDate"), 100), F.date_sub(F.max("ActualDate"), 100)).first()
    return scans.portable_actuals(spark, f"{path}/early.csv", first, last).unionByName(scans.portable_actuals(spark, f"{path}/late.parquet", first, last))
