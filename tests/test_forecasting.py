"""Forecasts without models, their adjustment, panels, policies and sheets on small literal frames."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import category as K
from tidemark.operators import forecasting as P
from tidemark.operators import joins as J
from tidemark.operators import panel as N
from tidemark.operators import policies as B
from tidemark.operators import sheets as H
from tidemark.sources import sinks


def day(m, d, y=2024):
    return dt.date(y, m, d)


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


@pytest.mark.parametrize("share, band",
    [(None, "<5%"), (0.0, "<5%"), (0.0499, "<5%"), (0.05, "5-15%"), (0.2499, "15-25%"), (0.6999, "50-70%"), (1.0, "70%+"), (1.01, None), (-0.2, None)])
def test_discount_bands(spark, share, band):
    assert values(spark, [(share,)], "x double", S.discount_band(F.col("x"))) == [(band,)]


@pytest.mark.parametrize("row, supply, destination", [
    ((12, None, "Washed", "Picking", ""), "ReturnNonSellable", "NonSellable"),
        ((12, "", "L1", "PalletPicking", ""), "ReturnToSellableFloor", "SellableFloor"),
            ((12, "", "L1", "Bulk", "Quarantine"), "ReturnNonSellable", "NonSellable"),
    ((7, None, None, None, None), "Transfer", "Other"), ((1, "x Cubiscan", " ", "Overflow", ""), "CubiscanPutaway", "ReserveOrBulk"),
        ((None, "", "RSTAGE1", "", ""), "OtherSupplyWork", "Staging"), ((1, "Active Putaway", "L", "Picking D", "OVFLO"), "ActivePutaway", "ReserveOrBulk"),
])
def test_supply_and_destination(spark, row, supply, destination):
    c = [F.col(x) for x in ("t", "w", "l", "p", "z")]
    assert values(spark, [row], "t int, w string, l string, p string, z string", S.supply_class(*c), S.destination_class(*c[2:])) == [(supply, destination)]


def test_run_rate_cuts_spikes_and_counts_all_days(spark):
    origins = spark.createDataFrame([(day(3, 1),)], "Origin date")
    facts = spark.createDataFrame([("a", day(2, 1), 10.0), ("a", day(2, 2), 10.0), ("a", day(2, 3), 1000.0), ("a", day(3, 1), 99.0), ("b", day(2, 5), 7.0)],
        "SKU string, ActualDate date, SoldUnits double")
    rows = {r.Category: r.DailyRunRate for r in K.run_rate(K.lookback(facts, origins,
        spark.createDataFrame([("a", "X")], "SKU string, Category string"))).collect()}
    assert rows == {"X": pytest.approx(45 / 56), "UNKNOWN": pytest.approx(7 / 56)}


def test_lift_of_a_year_without_event_units_and_over_the_turn_of_a_year(spark):
    facts = spark.createDataFrame([("a", day(6, 10, 2023), 400.0), ("a", day(12, 1, 2023), 100.0), ("a", day(1, 2, 2023), 500.0)],
        "SKU string, ActualDate date, SoldUnits double")
    cats = spark.createDataFrame([("a", "X")], "SKU string, Category string")
    one = K.event_lift(facts, spark.createDataFrame([(day(7, 1),)], "Origin date"), cats).first()
    assert one.ShrunkLift == pytest.approx((0.5 * 400 + 400) / 800)
    two = K.event_lift(facts, spark.createDataFrame([(day(12, 25),)], "Origin date"), cats).first()
    assert two.ShrunkLift == pytest.approx((0.5 * 100 + 400) / 500)
    assert K.event_lift(facts.limit(0), spark.createDataFrame([(day(7, 1),)], "Origin date"), cats).count() == 0


def test_no_model_variants(spark):
    o = day(7, 1)
    frame = lambda rows, cols: spark.createDataFrame(rows, f"Origin date, SKU string, ForecastDate date, {cols}")
    universe = spark.createDataFrame([(o, "a"), (o, "b"), (o, "c"), (o, "d")], "Origin date, SKU string")
    recent = frame([(o, "a", o, 10.0), (o, "d", o, 0.4)], "RecentUnits double")
    seasonal = frame([(o, "a", o, 20.0), (o, "b", o, 6.0)], "SeasonalUnits double")
    promo = frame([(o, "c", o, 1.5, 9.0), (o, "a", o, 2.0, 0.0)], "Multiplier double, Floor double")
    got = {(r.Variant, r.SKU): r.ForecastUnits for r in P.no_model(universe, spark.createDataFrame([(o,)], "Origin date"), recent, seasonal, promo).collect()}
    assert got == {("recent", "a"): 20, ("recent_floor", "a"): 20, ("recent_floor", "c"): 9, ("seasonal", "a"): 27, ("seasonal", "b"): 6,
        ("seasonal_floor", "a"): 27, ("seasonal_floor", "b"): 6, ("seasonal_floor", "c"): 9}


def test_planner_scale_keeps_totals(spark):
    rows = spark.createDataFrame([(1, "a", 1.0), (1, "b", 1.0), (1, "c", 1.0), (2, "a", 2.5), (2, "b", 2.5)], "g int, sku string, u double")
    plan = spark.createDataFrame([(1, 10.0)], "g int, p double")
    got = {(r.g, r.sku): r.x for r in P.planner_scaled(rows, plan, ["g"], "sku", "u", "p", "x").collect()}
    assert got == {(1, "a"): 4, (1, "b"): 3, (1, "c"): 3, (2, "a"): 3, (2, "b"): 2}


def test_hybrid_cap_and_blend(spark):
    frame = lambda rows: spark.createDataFrame(rows, "w int, sku string, u double")
    model, recent = frame([(1, "a", 40.0), (1, "b", 5.0)]), frame([(1, "b", 8.0), (1, "a", 2.0), (1, "c", -1.0)])
    mixed = P.hybrid(model, recent, ["w"], "sku", "u", 30.0, 0.5)
    assert sorted((r.sku, r.u) for r in mixed.collect()) == [("a", 40.0), ("b", 4.0)]
    totals = spark.createDataFrame([(1, 10.0)], "w int, t double")
    assert sum(r.u for r in P.volume_capped(mixed, totals, ["w"], "u", "t", 1.1).collect()) == pytest.approx(11)
    assert sum(r.u for r in P.volume_capped(mixed, totals, ["w"], "u", "t", 9.0).collect()) == pytest.approx(44)
    g = spark.createDataFrame([(None, "a", 1.0), (None, "b", 3.0), ("x", "c", 2.0)], "g string, sku string, u double")
    aim = spark.createDataFrame([(None, 8.0)], "g string, v double")
    assert sorted((r.sku, r.u) for r in P.group_scaled(g, aim, ["g"], "u", "v").collect()) == [("a", 2.0), ("b", 6.0), ("c", 2.0)]


def test_reconciliation_is_clipped(spark):
    rows = spark.createDataFrame([("a", 1.0, 100.0), ("b", 0.0, 4.0)], "g string, x double, y double")
    got = {r.g: r.z for r in rows.select("g", P.reconciled("x", "y", ["g"]).alias("z")).collect()}
    assert got == {"a": 5.0, "b": 0.0}


def test_new_rows_win(spark):
    old, new = spark.createDataFrame([(1, 5.0), (2, 6.0)], "k int, v double"), spark.createDataFrame([(2, None), (3, 1.0)], "k int, v double")
    assert sorted((r.k, r.v, r.replaced) for r in J.upserted(old, new, ["k"], ["v"]).collect()) == [(1, 5.0, False), (2, None, True), (3, 1.0, False)]


def test_frozen_features_never_look_ahead(spark):
    panel = spark.createDataFrame([("a", day(1, 1), 1.0), ("a", day(1, 5), None), ("a", day(1, 10), 9.0), ("a", day(1, 12), 8.0), ("b", day(1, 11), 3.0)],
        "SKU string, Date date, Rolling7 double")
    got = {(r.SKU, r.Date.day): r.Rolling7 for r in N.frozen_at_origin(panel, spark.createDataFrame([(day(1, 10),)], "Origin date"), ["Rolling7"]).collect()}
    assert got == {("a", 10): 1.0, ("a", 12): 1.0, ("b", 11): None}
    assert N.frozen_columns(["Lag1", "SoldRolling7", "InboundUnits", "Units"]) == ["Lag1", "SoldRolling7", "InboundUnits"]


def test_recency_brake(spark):
    rows = [(1, 10.0, 9.0, 0.9, 0.9, 0.9), (2, 10.0, 4.0, 0.9, 0.5, 0.9), (3, 10.0, 2.0, 0.4, 0.4, 0.9), (4, 10.0, 2.0, 0.1, 0.1, 0.9),
        (5, 10.0, 2.0, 0.1, 0.1, 0.9)]
    df = spark.createDataFrame(rows, "w int, f double, s double, cov_forecast double, cov_half double, cov_recent double")
    got = [r.Candidate for r in B.recency_brake(df, "w", "f", "s", [(1.0, "forecast"), (0.5, "half")], "recent", 1, 0.4, 0.6).orderBy("w").collect()]
    assert got == ["forecast", "half", "forecast", "recent", "recent"]


@pytest.mark.parametrize("name, found",
    [("x_2024-02-30.csv", []), ("F 6-11-26.csv", [day(6, 11, 2026)]), ("F 11126.csv", [day(1, 11, 2026), day(11, 1, 2026)]), ("no date", []), ("2025.csv", [])])
def test_dates_in_names(spark, name, found):
    got = values(spark, [(name, day(1, 20, 2026))], "n string, m date", H.dates_in_name(F.col("n"), F.col("m")))[0][0]
    assert got == (found or [day(1, 20, 2026)])


def test_headers_and_kinds(spark):
    got = values(spark, [(" % Off\n MSRP ",), ("A & B",), (None,), ("nan",)], "x string", H.header_key(F.col("x"), {"a_and_b": "both"}))
    assert got == [("pct_off_msrp",), ("both",), ("",), ("",)]
    kinds = values(spark, [("Tier 1", "pin list", True), ("Data", None, False), ("x", "Further cuts", True), ("Promo Offers", "", True),
        ("Pivot", "", False)], "s string, e string, h boolean", H.sheet_kind(F.col("s"), F.col("e"), F.col("h")))
    assert [k for k, in kinds] == ["tier1_recommendation", "support", "markdown", "aggregate_promo_offers", "rollup_or_pivot"]
    cells = spark.createDataFrame([("f", "s", 0, 0, "Offer"), ("f", "s", 0, 1, "Style"), ("f", "s", 2, 0, "Offer"), ("f", "s", 2, 1, "Style"),
        ("f", "s", 3, 0, "A-B"), ("f", "s", 3, 1, ""), ("f", "s", 4, 0, ""), ("f", "s", 4, 1, " ")],
            "file_id string, sheet_name string, rw int, cl int, val string")
    assert H.header_rows(cells, {}).first().header_row == 0
    assert [(r.rw, r.offer, r.style) for r in H.records(cells, {}, ["offer", "style"]).collect()] == [(3, "A-B", "A")]
    assert H.records(cells.limit(0), {}, ["offer", "style"]).count() == 0


def test_work_folders_need_a_shared_place_on_a_cluster(spark):
    class Far:
        master = "spark://host:7077"

        @staticmethod
        def getConf():
            return {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sinks.work_folder(type("S", (), {"sparkContext": Far})(), "x")
