"""Forecasts of an origin know nothing of the days from it on, and come out the same again."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.plans import adjust, exports
from tidemark.plans.registry import Facts

SF, CUT = "/root/testdata/sf0.001", dt.date(1998, 6, 9)


class Later(Facts):
    """The facts with other demand from a day on."""

    @property
    def actual_sku_day(self):
        rows = super().__getattr__("actual_sku_day")
        return rows.withColumn("SoldUnits", F.when(F.col("ActualDate") >= F.lit(CUT), F.col("SoldUnits") * 3 + 1).otherwise(F.col("SoldUnits")))


@pytest.mark.parametrize("forecast", [adjust._pool, lambda t: exports._pack(t).where("Candidate = 'recent'")], ids=["pool", "recent"])
def test_no_leakage_and_the_same_again(spark, forecast):
    found = {name: forecast(t).collect() for name, t in (("as it is", Facts(spark, SF)), ("again", Facts(spark, SF)), ("later", Later(spark, SF)))}
    early = {name: sorted(str(r) for r in rows if r.Origin <= CUT) for name, rows in found.items()}
    late = {name: sorted(str(r) for r in rows if r.Origin > CUT) for name, rows in found.items()}
    assert early["as it is"] and early["as it is"] == early["again"] == early["later"]
    assert late["as it is"] == late["again"] != late["later"]
