"""Days of offers and of inbound orders become rows only where the panel, or a forecast, has some."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import functions as F

from tidemark.operators import forecasting as P
from tidemark.operators import panel as N
from tidemark.plans.origins import _promo_features
from tidemark.plans.registry import Facts

SF = "/root/testdata/sf0.001"
FIRST, LAST = dt.date(1995, 1, 1), dt.date(1996, 12, 31)


def _same(a, b):
    return a.count() > 0 and a.exceptAll(b.select(a.columns)).isEmpty() and b.select(a.columns).exceptAll(a).isEmpty()


def _sold(t):
    return t.actual_sku_day.select("SKU", F.col("ActualDate").alias("Date"))


def test_offers_of_wanted_days(spark):
    t = Facts(spark, SF)
    wanted = N.days_with([_sold(t)], FIRST, LAST)
    got, every = _promo_features(t, days=wanted), _promo_features(t).persist()
    keys = _sold(t).where(F.col("Date").between(FIRST, LAST))
    assert _same(got, every.join(keys, ["SKU", "Date"], "left_semi")) and got.count() < every.count()
    dates = spark.range(3).select(F.date_add(F.lit(dt.date(1996, 3, 1)), F.col("id").cast("int")).alias("Date"))
    assert _same(_promo_features(t, dates), every.join(dates, "Date", "left_semi"))


def test_inbound_orders_of_wanted_days(spark):
    t = Facts(spark, SF)
    days = t.inbound_snapshots.select("SKU", F.date_add("SnapshotDate", 1).alias("Date")).where("SKU like '%S3'").distinct()
    got, every = N.inbound_features(t.inbound_snapshots, N.days_with([days], dt.date(1990, 1, 1), dt.date(2010, 1, 1))), N.inbound_features(t.inbound_snapshots)
    assert _same(got, every.join(days, ["SKU", "Date"], "left_semi"))
    # lines are dealt by SKU, none of their days is dealt again
    assert not re.search(r"hashpartitioning\(SKU#\d+, Date#", every._jdf.queryExecution().executedPlan().toString())


def test_no_model_has_no_row_for_each_day(spark):
    """Signals are dealt by origin and SKU, one exchange for all; SKUs outside the universe and days outside the horizon stay out."""
    origin, day = dt.date(2024, 1, 1), lambda k: dt.date(2024, 1, 1) + dt.timedelta(k)
    origins = spark.createDataFrame([(origin,)], "Origin date")
    frame = lambda rows, c: spark.createDataFrame([(origin, *r) for r in rows], f"Origin date, SKU string, ForecastDate date, {c}")
    universe = spark.createDataFrame([(origin, "a"), (origin, "b"), (origin, "n")], "Origin date, SKU string")
    recent = frame([("a", day(0), 10.0), ("a", day(14), 99.0)], "RecentUnits double")
    season = frame([("a", day(0), 20.0), ("a", day(1), 4.0), ("x", day(1), 50.0)], "SeasonalUnits double")
    promo = frame([("a", day(0), 1.5, 2.0), ("b", day(2), 1.25, 7.0)], "Multiplier double, Floor double")
    out = P.no_model(universe, origins, recent, season, promo)
    plan = out._jdf.queryExecution().executedPlan().toString()
    got = {(r.SKU, r.Variant): r.ForecastUnits for r in out.collect()}
    assert got == {("a", "recent"): 15, ("a", "recent_floor"): 15, ("a", "seasonal"): 24, ("a", "seasonal_floor"): 24, ("b", "recent_floor"): 7, ("b", "seasonal_floor"): 7}
    assert len(re.findall(r"Exchange hashpartitioning\(Origin#\d+, SKU#", plan)) == 1
