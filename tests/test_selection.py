"""Ranks, medians and largest remainders against plain Python, with groups that fill the table and values that tie."""

from __future__ import annotations

import math
import random
import statistics
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.operators import selection
from tidemark.operators.allocation import allocate

RNG = random.Random(4)
GROUPS = ["big"] * 4000 + [None] * 7 + [f"g{k % 9}" for k in range(200)]
ROWS = [(g, k, RNG.choice([None, 1.5, 1.5, 2.0, float(RNG.randint(1, 400)), RNG.random()]), f"s{k:05d}") for k, g in enumerate(GROUPS)] + [("empty", -1, None, "x")]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "g string, k long, v double, sku string").repartition(64)


def grouped(rows):
    out = defaultdict(list)
    for r in rows:
        out[r[0]].append(r)
    return out


@pytest.mark.parametrize("splitters", [1, 7, 255])
def test_ranked(rows, monkeypatch, splitters):
    monkeypatch.setattr(selection, "SPLITTERS", splitters)
    got = {(r.g, r.k): r["rank"] for r in selection.ranked(rows, ["g"], [-F.coalesce("v", F.lit(0.0)), F.col("sku")], "rank").collect()}
    want = {(g, r[1]): n for g, rs in grouped(ROWS).items() for n, r in enumerate(sorted(rs, key=lambda r: (-(r[2] or 0.0), r[3])), 1)}
    assert got == want


@pytest.mark.parametrize("splitters", [1, 7, 255])
def test_medians(rows, monkeypatch, splitters):
    monkeypatch.setattr(selection, "SPLITTERS", splitters)
    got = {r.g: r.m for r in selection.medians(rows, ["g"], "v", "m").collect()}
    assert got == {g: statistics.median(v) for g, rs in grouped(ROWS).items() if (v := [r[2] for r in rs if r[2] is not None])}


def by_hand(rows, total):
    out = []
    for rs in grouped(rows).values():
        weights = sum(r[2] or 0.0 for r in rs)
        shares = [(r[2] or 0.0) / weights * total if weights > 0 and total > 0 else 0.0 for r in rs]
        floors = [math.floor(round(s, 9)) for s in shares]
        order = sorted(range(len(rs)), key=lambda i: (-round(shares[i] - floors[i], 9), rs[i][3]))
        left = total - sum(floors) if weights > 0 and total > 0 else 0
        for n, i in enumerate(order):
            out.append((rs[i][0], rs[i][1], floors[i] + (n < left)))
    return out


@pytest.mark.parametrize("total", [0, 1, 37, 4000, 123_457])
@pytest.mark.parametrize("even", [False, True])
def test_largest_remainder(spark, rows, total, even):
    """One group has most rows, in 64 partitions; with even weights all remainders tie and the SKU decides."""
    table = [(g, k, 1.0 if even else v, s) for g, k, v, s in ROWS]
    df = spark.createDataFrame(table, "g string, k long, v double, sku string").repartition(64).withColumn("total", F.lit(total))
    got = allocate(df, ["g"], "v", "total", ["sku"], "units")
    assert got.columns == ["g", "k", "v", "sku", "total", "units"]
    assert Counter((r.g, r.k, r.units) for r in got.collect()) == Counter(by_hand(table, total))
    if total:
        windows = [x for x in got._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Window [" in x]
        assert windows and not any("sku#" in x or "_rest#" in x for x in windows)
        assert all("_bucket#" in x or "_w0#" in x for x in windows if "_key#" in x)


def test_nothing_to_allocate(spark):
    df = spark.createDataFrame([], "g string, v double, total long, sku string")
    assert allocate(df, ["g"], "v", "total", ["sku"], "units").count() == 0
