"""What several steps of a query read is computed once, and what no step needs is left out early."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import functions as F

from tidemark.operators import category as K
from tidemark.plans import exports, imports
from tidemark.sources import vintages
from tidemark.sources.facts import fact

SF = "/root/testdata/sf0.001"


def _counted(df):
    """``df`` and how many of its rows were computed."""
    rows = df.sparkSession.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            rows.add(len(b))
            yield b

    return df.mapInPandas(run, df.schema), rows


def test_an_import_computes_its_rows_once(spark):
    ahead = fact(spark, SF, "forecast_sku_day").limit(300).cache()
    rows, read = _counted(ahead)
    store, _ = imports._replaced(SimpleNamespace(forecast_sku_day=rows, vintages=fact(spark, SF, "vintages")), True)
    assert store.read("day").count() > 300 and read.value == 300


def test_days_of_no_span_are_left_out_below_the_aggregate(spark):
    facts, days = fact(spark, SF, "actual_sku_day"), K.days_of(fact(spark, SF, "vintages").select(F.col("ForecastStartDate").alias("Origin")), -56, -1)
    got = K.on_days(facts.select("SKU", "ActualDate", "SoldUnits"), days)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert -1 < plan.index("Aggregate") < plan.index("LeftSemi")
    plain = facts.select("SKU", "ActualDate", "SoldUnits").join(days, "ActualDate").select(*got.columns)
    assert got.count() > 0 and got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()


def test_texts_of_a_file_are_parsed_once(spark):
    raw = spark.range(40).select(F.concat(F.lit("s"), "id").alias("SKU"), F.lit("A").alias("Velocity"), F.lit("1").alias("PutawayIndicator"),
        F.lit("1998-01-06").alias("ForecastStartDate"), *[F.lit("2").alias(c) for c in vintages.DAYS])
    raw, read = _counted(raw)
    rows = vintages.typed(raw, F.lit("a.csv"))
    assert vintages.by_day(rows, vintages.file_metadata(rows)).count() == 40 * 14 and read.value == 40
