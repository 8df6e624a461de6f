"""Demand facts over the base tables: SKU-by-day picks, order lines, vintages, inventory, inbound and promotions.

The text of each view is in the common subset of Spark SQL and DuckDB, so a query and its check read one definition.
Every view covers its whole base table. Profiles, locations and zones in them are fixed values of the rules that read them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE = ("part", "lineitem", "orders", "nation", "events")

# at least six digits; lpad cuts longer keys, so two parts would share a SKU from 1,000,000 on
_ITEM = "'I' || lpad(cast(p_partkey as string), cast(greatest(6, length(cast(p_partkey as string))) as int), '0')"
_SKU = f"{_ITEM} || '-' || 'C' || replace(p_brand, 'Brand#', '') || '-' || 'S' || cast(p_size % 10 as string)"
_START = "date '1998-01-06' + cast(14 * (l_orderkey % 25) as int)"
_FORECAST = f"""select 'V' || lpad(cast(l_orderkey % 25 as string), 3, '0') as SnapshotId, {_START} as ForecastStartDate, p.SKU, p.Category, cast(1 + l_suppkey % 14 as int) as ForecastDayOffset,
        {_START} + cast(l_suppkey % 14 as int) as ForecastDate, l_quantity as ForecastQty from {{lineitem}} l join dim_product p on l.l_partkey = p.pk"""

VIEWS = {
    "dim_product": f"""select p_partkey as pk, {_SKU} as SKU, {_ITEM} as Item, 'C' || replace(p_brand, 'Brand#', '') as Color, 'S' || cast(p_size % 10 as string) as Size,
        p_type as Division, p_brand as Department, upper(substr(p_type, 1, 3)) as ProductGroupCode, case when p_size <= 12 then 'S' when p_size <= 25 then 'M' when p_size <= 37 then 'L' else 'X' end as SizeGroupCode,
        upper(substr(p_type, 1, 3)) || case when p_size <= 12 then 'S' when p_size <= 25 then 'M' when p_size <= 37 then 'L' else 'X' end as Category,
        case p_partkey % 4 when 0 then 'AA' when 1 then 'A' when 2 then 'B' else 'C' end as Velocity, cast(p_partkey % 3 as int) as PutawayIndicator,
        date '1995-01-01' + cast((p_partkey * 37) % 2400 as int) as GoLiveDate, p_retailprice as MSRP, p_name as Name, p_size as RawSize from {{part}}""",
    "work_lines": """select l.l_orderkey as OrderNum, l.l_linenumber as LineNum, cast(l.l_shipdate as date) as PickDate, p.SKU, p.pk, l.l_quantity as Units,
        case l.l_suppkey % 7 when 0 then 'Picking' when 1 then 'Picking A' when 2 then 'Picking D' when 3 then 'PalletPicking' when 4 then 'W001' when 5 then 'Bulk' else 'RSTAGE' end as LocProfile,
        case l.l_suppkey % 11 when 0 then 'Washed' when 1 then 'Bander' when 2 then '' when 3 then 'Rags' else 'L' || cast(l.l_suppkey as string) end as Location,
        case l.l_suppkey % 13 when 0 then 'Quarantine' when 1 then 'Bulk' when 2 then 'OVFLO' when 3 then 'Stage 1' else 'Z' || cast(l.l_suppkey % 13 as string) end as Zone,
        case l.l_linenumber % 5 when 0 then 12 when 1 then 2 when 2 then 11 when 3 then 7 else 1 end as WorkTransType,
        case l.l_returnflag when 'A' then 'Active Putaway' when 'N' then 'Cubiscan In' else 'Putaway' end as WorkTemplateCode
        from {lineitem} l join dim_product p on l.l_partkey = p.pk""",
    "actual_sku_day": """select PickDate as ActualDate, SKU, sum(Units) as SoldUnits, count(*) as PickLines, count(distinct OrderNum) as DistinctOrders
        from work_lines where LocProfile in ('Picking', 'Picking A', 'Picking D', 'PalletPicking') and Location not in ('Washed', 'Bander') group by PickDate, SKU""",
    "order_lines": """select cast(o.o_orderdate as date) as OrderDate, o.o_orderkey as SalesID, l.l_linenumber as LineNum, p.SKU, p.Category,
        case when l.l_returnflag = 'R' and l.l_linenumber % 3 = 0 then -l.l_quantity else l.l_quantity end as QtyOrdered, p.MSRP, l.l_extendedprice / l.l_quantity as SalesPrice,
        (case when l.l_returnflag = 'R' and l.l_linenumber % 3 = 0 then -1 else 1 end) * l.l_extendedprice * (1 - l.l_discount) as LineAmount,
        case when l.l_discount > 0.07 then l.l_discount * 100 else 0.0 end as LineDiscPercent
        from {lineitem} l join {orders} o on o.o_orderkey = l.l_orderkey join dim_product p on l.l_partkey = p.pk""",
    "vintages": """select cast(n_nationkey as int) as k, 'V' || lpad(cast(n_nationkey as string), 3, '0') as SnapshotId, date '1998-01-06' + cast(14 * n_nationkey as int) as ForecastStartDate,
        date '1998-01-06' + cast(14 * n_nationkey + (n_nationkey % 3) - 1 as int) as InferredFileDate from {nation}""",
    "forecast_sku_day": _FORECAST.replace("l_quantity", "sum(l_quantity)") + " group by l_orderkey % 25, p.SKU, p.Category, l_suppkey % 14",
    "inventory_sku_day": f"""select {_START} as SnapshotDate, p.SKU, sum(case when l_returnflag = 'R' then -l_quantity else l_quantity end) as AvailPhysical, sum(cast(l_linenumber as double)) as PhysicalReserved, cast(count(*) as double) as OrderedInTotal
        from {{lineitem}} l join dim_product p on l.l_partkey = p.pk group by l_orderkey % 25, p.SKU""",
    "inbound_snapshots": f"""select {_START} as SnapshotDate, p.SKU, {_START} + cast(l_suppkey % 120 - 15 as int) as ExpectedInDCDate, 'PO' || cast(l_suppkey % 50 as string) as PurchID, l_quantity as InboundRemainderUnits
        from {{lineitem}} l join dim_product p on l.l_partkey = p.pk""",
    "promo_events": """select 'F' || cast(o_custkey % 100 as string) as file_id, o_orderkey as event_id, case o_orderkey % 5 when 0 then 'promo_detail' when 1 then 'markdown' when 2 then 'final_sale' when 3 then 'aggregate_promo_offers' else 'coupon' end as sheet_type,
        'Event ' || cast(o_orderkey % 17 as string) as event_name, case o_orderkey % 3 when 0 then 'Swim|Kids' when 1 then '' else 'Baby' end as promo_scope, cast(o_orderdate as date) as start_date, cast(o_orderdate as date) + cast(3 + o_orderkey % 10 as int) as end_date from {orders}""",
    "promo_offers": """select e.*, p.Item, p.Color, p.Item || '-' || p.Color || case when p.pk % 2 = 0 then '-X1' else '' end as offer_cc, l.l_discount * 100 as pct_off_msrp, p.MSRP * 0.8 as promo_price,
        case when l.l_linenumber % 3 = 0 then 20.0 else null end as extra_off, case when l.l_linenumber % 2 = 0 then p.MSRP * 0.7 else null end as clearance_price, l.l_quantity as lw_units, l.l_tax * 1000 as avail_inv
        from promo_events e join {lineitem} l on l.l_orderkey = e.event_id join dim_product p on l.l_partkey = p.pk""",
    "planner_daily": """select cast(o_orderdate as date) as Date, count(*) * 25.0 as PlanUnits, count(*) * 24.0 as ActualUnits from {orders} group by cast(o_orderdate as date)""",
    "source_files": """select *, 'FWD' || case kind when 0 then '_' || y || '-' || m || '-' || lpad(d, 2, '0') when 1 then ' ' || m || '-' || d || '-' || substr(y, 3, 2) when 2 then ' ' || m || lpad(d, 2, '0') || substr(y, 3, 2) else ' ' || y || lpad(m, 2, '0') || lpad(d, 2, '0') end || '.csv' as name
        from (select o_orderkey as id, cast(o_orderkey % 4 as int) as kind, cast(year(day) as string) as y, cast(month(day) as string) as m, cast(day(day) as string) as d, day + cast(o_custkey % 9 as int) as modified, case o_custkey % 4 when 0 then 'Error' when 1 then 'Complete' when 2 then 'Processing' else 'Archive' end as folder,
          date '1998-01-06' + cast(14 * (o_orderkey % 25) as int) as start_min, cast(o_custkey % 20 as int) as skus, cast(o_custkey % 11 as double) as units, 'c' || cast(o_custkey % 400 as string) as content from (select *, cast(o_orderdate as date) + 9132 as day from {orders}) x) f""",
    "cell_files": """select distinct cast(floor(p_partkey / 20.0) as int) as fid from {part}""",
    "cells": """select fid as file_id, case fid % 4 when 0 then 'Markdown list' when 1 then 'Coupon tracker' when 2 then 'Promo Offers A' else 'Sale 3/5-3/9' end as sheet_name, rw, cl, val from (
        select fid, 0 as rw, 0 as cl, 'Event Name:' as val from cell_files union all select fid, 0, 2, case fid % 3 when 0 then 'Final Sale ' || cast(fid as string) else 'Summer ' || cast(fid as string) end from cell_files
        union all select fid, 1, 0, 'Effective Date(s)' from cell_files union all select fid, 1, 1, case fid % 5 when 0 then '7/4/98 - 7/9/98' when 1 then '12/28 - 1/3' when 2 then ' ' when 3 then '2/5' else '13/40' end from cell_files
        union all select fid, 2, 0, 'Offer' from cell_files where fid % 5 <> 4 union all select fid, 2, 1, case fid % 3 when 1 then 'Style ID' else ' Style ' end from cell_files where fid % 5 <> 4 union all select fid, 2, 2, '% Off MSRP' from cell_files where fid % 5 <> 4
        union all select fid, 2, 3, case fid % 2 when 1 then 'Dept' else 'Orig MSRP' end from cell_files where fid % 5 <> 4 union all select fid, 2, 4, 'Division' from cell_files where fid % 5 <> 4 union all select fid, 2, 5, 'Promo & $ Price' from cell_files where fid % 5 <> 4
        union all select cast(floor(p_partkey / 20.0) as int), 3 + cast(p_partkey % 20 as int), 0, case when p_partkey % 6 = 0 then '' else 'I' || cast(p_partkey as string) || '-C' || cast(p_size as string) end from {part}
        union all select cast(floor(p_partkey / 20.0) as int), 3 + cast(p_partkey % 20 as int), 1, case when p_partkey % 4 = 0 then 'S' || cast(p_partkey as string) else '' end from {part}
        union all select cast(floor(p_partkey / 20.0) as int), 3 + cast(p_partkey % 20 as int), 2, cast(p_size as string) || '%' from {part}
        union all select cast(floor(p_partkey / 20.0) as int), 3 + cast(p_partkey % 20 as int), 5, '$' || cast(p_size * 3 as string) || '.50' from {part}) c""",
    "planner_cells": """select cl, 4 as rw, cast(Date as string) as val from (select *, row_number() over (order by Date) as cl from planner_daily) a union all select cl, 9, cast(PlanUnits as string) from (select *, row_number() over (order by Date) as cl from planner_daily) b
        union all select cl, 12, cast(ActualUnits as string) from (select *, row_number() over (order by Date) as cl from planner_daily) c union all select 0, 9, ' Ops IMF Plan ' union all select 0, 12, 'Actual Demand (units)' union all select 0, 4, 'Date'""",
    "ledger": """select SKU, OrderDate as last_seen, 'L' || cast(SalesID % 9 as string) as source_file, SalesID, case when SalesID % 7 = 0 then '' else substr(Category, 1, 3) end as GroupCode, case when SalesID % 5 = 0 then '' else lower(substr(Category, 4, 1)) end as SizeCode from order_lines""",
    "dirty_text": """select p_partkey as id, case p_partkey % 6 when 0 then ' $' || cast(p_size as string) || ',000 ' when 1 then '(' || cast(p_size as string) || ')' when 2 then cast(p_size as string) || '%' when 3 then 'nan'
        when 4 then ' i1-c2-' || cast(p_size as string) || '-b ' else p_name || ' up to ' || cast(p_size as string) || '% off 6/' || cast(1 + p_size % 28 as string) || '-7/4' end as raw from {part}""",
}

#: For Spark alone: the lines whose sums are ``forecast_sku_day``, for queries that deal them to tasks before they are summed.
LINES = {"forecast_lines": _FORECAST}


def with_views(sql: str) -> str:
    """``sql`` with all views in front, for DuckDB, where the base tables are views of their own names."""
    sql = f"select * from ({sql})" if sql.lstrip().lower().startswith("with") else sql
    return "WITH " + ",\n".join(f"{n} AS ({t.format(**{b: b for b in BASE})})" for n, t in VIEWS.items()) + "\n" + sql


def fact(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame. Only what the query needs is read."""
    tables = {b: spark.read.parquet(f"{sf_dir}/{b}.parquet") for b in BASE}
    return spark.sql("WITH " + ",\n".join(f"{n} AS ({t})" for n, t in (VIEWS | LINES).items()) + f"\nSELECT * FROM {name}", **tables)
