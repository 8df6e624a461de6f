"""Demand models, calibration, activation and intervals on small frames with odd rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import activation, models
from tidemark.operators.scoring import bootstrap
from tidemark.sources import sinks


def test_parts_and_prepared(spark):
    rows = spark.createDataFrame([(dt.date(2024, 1, d), None if d == 2 else float(d), None) for d in range(1, 11)], "day date, u double, c string")
    out = models.parts(models.prepared(rows, ["u"], ["c"], "u"), "day", 2, 3)
    assert {r["Part"]: r["count"] for r in out.groupBy("Part").count().collect()} == {"train": 5, "calibration": 2, "holdout": 3}
    assert out.where("u is null or c <> 'UNKNOWN'").count() == 0
    assert models.parts(rows, "day", 8, 3).where("Part = 'calibration'").count() == 0
    assert models.parts(rows.limit(0), "day", 2, 3).count() == 0


def test_calibration(spark):
    rows = spark.createDataFrame([("a", 1.0, 9.0)] * 3 + [("b", 2.0, 4.0)] + [(None, 0.0, 5.0)] * 3, "c string, f double, s double")
    factors = models.calibration_factors(rows, ["c"], "f", "s", 2, 1.0)
    got = {r["c"]: (r["Factor"], r["FallbackUsed"]) for r in factors.collect()}
    assert got == {"a": (4.0, False), "b": (4.0, True), None: (1.0, False)}
    assert models.calibrated(rows, factors, "c", "f").agg(F.sum("Calibrated")).first()[0] == pytest.approx(20.0)


def test_activation(spark):
    origin = dt.date(2024, 1, 1)
    recent = spark.createDataFrame([(origin, "a", 10.0), (origin, "b", 4.0), (origin, "c", 1.0)], "Origin date, SKU string, RecentUnits double")
    evidence = spark.createDataFrame([(origin, "a", True, False), (origin, "c", False, True), (origin, "n", True, True)],
        "Origin date, SKU string, HasInv boolean, HasInbound boolean")
    kinds = spark.createDataFrame([("a", "X"), ("b", "X"), ("c", "X"), ("n", "X")], "SKU string, Category string")
    got = {r["SKU"]: (r["Gate"], r["Weight"]) for r in activation.activation_weights(recent, evidence, kinds).collect()}
    assert got["a"] == (1.0, 10.0) and got["n"] == (1.0, 2.0)
    assert got["b"][1] == pytest.approx(1.4) and got["c"][1] == 1.0
    assert activation.activation_weights(recent.limit(0), evidence.limit(0), kinds).count() == 0


def test_bootstrap(spark):
    rows = spark.createDataFrame([(i, 1.0, 2.0, 10.0) for i in range(6)], "w int, a double, b double, s double")
    r = bootstrap(rows, "w", "a", "b", "s", 4, 50).first()
    assert (r["Windows"], r["Draws"], r["ShareBetter"]) == (6, 50, 1.0) and r["Low"] == r["High"] == pytest.approx(-0.1)
    assert bootstrap(rows.limit(2), "w", "a", "b", "s", 4, 50).count() == 0


def test_files(spark, tmp_path):
    rows = spark.createDataFrame([("a", "1"), ("b", "x"), (None, None)], "k string, v string")
    rows.coalesce(1).write.option("header", True).csv(f"{tmp_path}/c")
    assert sinks.read_typed_csv(spark, f"{tmp_path}/c", {"v": "double"}).agg(F.sum("v"), F.count("*")).first()[:] == (1.0, 3)
    with pytest.raises(ValueError, match="missing columns: q"):
        sinks.read_typed_csv(spark, f"{tmp_path}/c", {"q": "int"})
    sinks.write_shards(rows, f"{tmp_path}/s", {"p": F.lit(1)})
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        sinks.write_shards(rows, f"{tmp_path}/s", {"p": F.lit(1)})
