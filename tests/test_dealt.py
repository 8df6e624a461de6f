"""Queries over line items deal them to more partitions as there are more of them, so that no task's rows grow with the table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.plans import catalog, registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["order_rollup", "wide_horizon", "export_shape", "inbound_rows"])
def test_rows_of_a_task_stay_few(spark, monkeypatch, name):
    query = catalog.queries()[name]
    whole = query(spark, SF)
    want = whole.collect()
    monkeypatch.setattr(registry, "LINES", 300)
    rows = query(spark, SF)
    tasks = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    # a SKU is in one task, and there are few SKUs here; without dealing one task has all rows
    assert max(tasks) < 1200 < sum(tasks) and sorted(map(str, rows.collect())) == sorted(map(str, want))


@pytest.mark.parametrize("name", ["period_slices", "planner_scaled"])
def test_lines_are_dealt_before_they_are_summed(spark, monkeypatch, name):
    monkeypatch.setattr(registry, "LINES", 300)
    rows = catalog.queries()[name](spark, SF)
    n = -(-spark.read.parquet(f"{SF}/lineitem.parquet").count() // 300)
    assert any("RepartitionByExpression" in line and line.endswith(f", {n}") for line in rows._jdf.queryExecution().optimizedPlan().toString().split("\n"))
