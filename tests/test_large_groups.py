"""Levels of reconciliation whose groups may hold any share of the rows."""

from __future__ import annotations

import pytest

from tidemark.operators import forecasting as P


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_levels_are_reconciled_without_windows(spark):
    rows = spark.createDataFrame([("a", "k", 1.0, 8.0), ("a", "k", 3.0, 0.0), ("a", "l", 4.0, 1.0), ("a", None, 0.0, 2.0)], "w string, c string, b double, t double")
    levels = {"top": (["w"], 1.0), "half": (["w", "c"], 0.5)}
    got = P.reconciled_levels(rows, "b", "t", levels)
    assert "Window" not in _plan(got)
    want = rows.select("*", *[P.reconciled("b", "t", g, a).alias(n) for n, (g, a) in levels.items()])
    assert sorted(got.select(*want.columns).collect(), key=str) == sorted(want.collect(), key=str)
    assert got.where("c = 'l'").first()["half"] == pytest.approx(2.5)
