"""Small literal frames for the rules that are easy to get wrong."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import allocation as A
from tidemark.operators import gates
from tidemark.operators import joins as J
from tidemark.operators import scoring as C
from tidemark.operators import windows as W


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


@pytest.mark.parametrize("raw, sku",
    [("i1", "i1"), (" - c", ""), ("it-", "it--"), ("it--l", "it--L"), ("it - c1 ", "it-C1"), ("it-c-s-x", "it-C-S-X"), (None, "")])
def test_normal_sku(spark, raw, sku):
    assert values(spark, [(raw,)], "x string", S.normal_sku(F.col("x"))) == [(sku,)]


def test_numbers_and_percentages(spark):
    got = values(spark, [("$1,200",), ("(5)",), ("7%",), ("x",), (None,)], "x string", S.to_number(F.col("x")))
    assert got == [(1200.0,), (-5.0,), (7.0,), (None,), (None,)]
    assert values(spark, [("10% to 40.5% off 900%",)], "x string", S.max_percent(F.col("x"))) == [(40,)]


def test_dates(spark):
    got = values(spark, [(7, 1), (2, 30), (2, 28)], "m int, d int", S.inferred_date(F.col("m"), F.col("d")))
    assert got == [(dt.date(2025, 7, 1),), (None,), (dt.date(2026, 2, 28),)]
    assert values(spark, [(dt.date(2024, 2, 29),)], "d date", S.same_day_of_year(F.col("d"), 1)) == [(dt.date(2025, 2, 28),)]


def test_multiplier_and_ratios(spark):
    got = values(spark, [(False, 0.5), (True, 0.0), (True, None), (True, 0.4), (True, 9.0)], "p boolean, d double", S.promo_multiplier(F.col("p"), F.col("d")))
    assert [round(x, 6) for x, in got] == [1.0, 1.25, 1.25, 1.3, 1.75]
    assert values(spark, [(1.0, 0.0)], "a double, b double", S.ratio_or_null(F.col("a"), F.col("b")), S.ratio_or_zero(F.col("a"), F.col("b"))) == [(None, 0.0)]


def test_asof_edges(spark):
    d = lambda k: dt.date(2024, 1, k)
    events = spark.createDataFrame([("a", d(5)), ("a", d(5)), ("a", d(1)), ("b", d(9)), (None, d(9))], "k string, at date")
    history = spark.createDataFrame([("a", d(5), 1), ("a", d(2), 2), (None, d(3), 7)], "k string, known date, v int")
    got = sorted(map(tuple, J.asof_latest(events, history, ["k"], "at", "known").select("k", "at", "v").collect()), key=str)
    assert got == sorted([("a", d(5), 1), ("a", d(5), 1), ("a", d(1), None), ("b", d(9), None), (None, d(9), 7)], key=str)
    strict = J.asof_latest(events, history, ["k"], "at", "known", tolerance=2, strict=True).where("k = 'a'").select("at", "v").collect()
    assert sorted(map(tuple, strict), key=str) == sorted([(d(5), None), (d(5), None), (d(1), None)], key=str)


@pytest.mark.parametrize("weights, total, want", [([1, 1, 1], 10, [4, 3, 3]), ([0, 0], 5, [0, 0]), ([3, 1], 0, [0, 0]), ([2, 1], 4, [3, 1])])
def test_allocation(spark, weights, total, want):
    rows = spark.createDataFrame([(1, f"s{i}", float(w), total) for i, w in enumerate(weights)], "g int, sku string, w double, t long")
    got = A.allocate(rows, ["g"], "w", "t", ["sku"], "u").orderBy("sku").collect()
    assert [r.u for r in got] == want


def test_calendar_mean_counts_missing_days(spark):
    rows = spark.createDataFrame([("a", dt.date(2024, 1, 1), 7.0), ("a", dt.date(2024, 1, 6), 1.0), ("a", dt.date(2024, 1, 20), 1.0)],
        "k string, d date, v double")
    got = rows.select("d", W.calendar_mean("v", ["k"], "d", 7).alias("m")).orderBy("d").collect()
    assert [r.m for r in got] == [0.0, 1.0, 0.0]


def test_spaced_dates(spark):
    rows = spark.createDataFrame([(dt.date(2024, 1, k),) for k in (1, 5, 15, 16, 29)], "d date")
    assert [r.d.day for r in W.spaced(rows, "d", 14).orderBy("d").collect()] == [1, 15, 29]


def test_score_identities(spark):
    f = spark.createDataFrame([("w", "c", "a", 5.0), ("w", "c", "b", 0.0)], "w string, c string, sku string, f double")
    s = spark.createDataFrame([("w", "c", "b", 12.0), ("w", "c", "d", 3.0)], "w string, c string, sku string, s double")
    r = C.score(f, s, ["w", "c"], "sku", "f", "s").first()
    assert r.OverUnits - r.UnderUnits == r.ForecastUnits - r.SoldUnits and r.OverUnits + r.UnderUnits == r.AbsErrorUnits == 20
    assert r.Missed10SKUs == 1 and r.OverGeneratedSKUs == 1 and r.CoveragePct == 0


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "w string, c string, sku string, f double")
    assert C.score(none, none.withColumnRenamed("f", "s"), ["w", "c"], "sku", "f", "s").count() == 0
    assert A.allocate(none.withColumn("t", F.lit(3)), ["w"], "f", "t", ["sku"], "u").count() == 0


def test_walk_forward_learns_from_earlier_windows_only(spark):
    rows = [(k, g, float(lo), float(hi), 10.0) for k, (g, lo, hi) in enumerate([(0.2, 1, 5), (0.6, 9, 2), (None, 3, 4), (0.4, 2, 6), (0.2, 7, 1), (0.8, 5, 5)])]
    taus, want = [0.1, 0.3, 0.5, 0.7], []
    for k, (_, g, lo, hi, _) in enumerate(rows):
        if k >= 2:
            cost = {t: sum(r[2] if r[1] is not None and r[1] < t else r[3] for r in rows[:k]) for t in taus}
            best = min(taus, key=lambda t: (cost[t], t))
            want.append((k, best, lo if g is not None and g < best else hi))
    df = spark.createDataFrame(rows, "o int, g double, lo double, hi double, s double")
    got = gates.walk_forward(df, "o", "g", "lo", "hi", "s", taus, 2).orderBy("o").collect()
    assert [(r.o, r.Tau, r.Gated) for r in got] == want
    assert gates.walk_forward(df.limit(0), "o", "g", "lo", "hi", "s", taus, 2).count() == 0


def test_periods_overlap_and_are_clipped(spark):
    df = spark.sql("select explode(array('2024-12-31', '2025-01-01', '2025-02-01', '2025-02-10', '2025-02-11', null)) as day").selectExpr("cast(day as date) as day")
    got = {r.Period: r.n for r in gates.by_period(df, "day", "2025-01-01", "2025-02-10").groupBy("Period").agg(F.count("*").alias("n")).collect()}
    assert got == {"holdout": 3, "last_7_days": 1, "last_28_days": 2, "year_to_date": 3, "2025-01": 1, "2025-02": 2}
