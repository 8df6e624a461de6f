"""Stores of parts, scans by path and wide vintage files, on small tables on disk."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.sources import scans, vintages
from tidemark.sources.store import PartStore

DAY = dt.date(2024, 1, 1)


def month(c):
    return F.date_format(c, "yyyy-MM")


def days(spark, first, n, value):
    return spark.createDataFrame([(DAY + dt.timedelta(first + k), "s", float(value)) for k in range(n)], "day date, sku string, u double")


def files_of(store, table):
    return {r[0]: {x[0] for x in store.spark.read.parquet(f"{store.root}/{table}/{r[0]}").where(F.col("_part").isin([f"_{p}" for p in r[1]])).select(F.input_file_name()).distinct().collect()}
            for r in store.manifest().where(F.col("table") == table).groupBy("write").agg(F.collect_list("part")).collect()}


def test_range_replace(spark, tmp_path):
    store = PartStore(spark, f"{tmp_path}/s")
    assert store.version() == 0 and store.replace_range("t", days(spark, 0, 0, 1), "day", month) is None
    store.replace_range("t", days(spark, 0, 120, 1), "day", month)
    before = {r.part: r.write for r in store.manifest().collect()}
    # 10 January to 5 February: two months are written anew, the days outside the span are kept
    assert store.replace_range("t", days(spark, 9, 27, 2), "day", month) == (DAY + dt.timedelta(9), DAY + dt.timedelta(35))
    after = {r.part: r.write for r in store.manifest().collect()}
    assert {p for p in before if before[p] != after[p]} == {"2024-01", "2024-02"}
    got = {r.day: r.u for r in store.read("t").collect()}
    assert got == {DAY + dt.timedelta(k): 2.0 if 9 <= k <= 35 else 1.0 for k in range(120)}
    assert {r.part: r.rows for r in store.manifest().collect()} == {"2024-01": 31, "2024-02": 29, "2024-03": 31, "2024-04": 29}


def test_failed_write_changes_nothing(spark, tmp_path):
    store = PartStore(spark, f"{tmp_path}/s")
    store.replace_range("t", days(spark, 0, 60, 1), "day", month)
    rows, version = Counter(store.read("t").collect()), store.version()
    bad = days(spark, 9, 27, 2).withColumn("u", F.when(F.col("day") == F.lit(DAY + dt.timedelta(20)), F.raise_error("no")).otherwise(F.col("u")))
    with pytest.raises(Exception, match="no"):
        store.replace_range("t", bad, "day", month)
    assert store.version() == version and Counter(store.read("t").collect()) == rows


def test_tables_change_together(spark, tmp_path):
    store = PartStore(spark, f"{tmp_path}/s")
    heads = lambda *ids: spark.createDataFrame([(i, 1) for i in ids], "id string, n int")
    lines = lambda v, *ids: spark.createDataFrame([(i, k, v) for i in ids for k in range(3)], "id string, k int, v int")
    status = lambda df: {r.part: r.status for r in df.collect()}
    assert status(store.replace_parts({"heads": heads("1", "2"), "lines": lines(1, "1", "2")}, "id")) == {"1": "imported", "2": "imported"}
    files = files_of(store, "lines")
    assert status(store.replace_parts({"heads": heads("2", "3"), "lines": lines(2, "2", "3")}, "id")) == {"2": "skipped", "3": "imported"}
    assert Counter((r.id, r.v) for r in store.read("lines").collect()) == {("1", 1): 3, ("2", 1): 3, ("3", 2): 3}
    assert all(files_of(store, "lines")[w] == f for w, f in files.items())
    assert status(store.replace_parts({"heads": heads("2"), "lines": lines(5, "2")}, "id", overwrite=True)) == {"2": "imported"}
    assert Counter((r.id, r.v) for r in store.read("lines").collect()) == {("1", 1): 3, ("2", 5): 3, ("3", 2): 3}
    with pytest.raises(Exception, match="boom"):
        store.replace_parts({"heads": heads("1"), "lines": lines(9, "1").withColumn("v", F.raise_error("boom").cast("int"))}, "id", overwrite=True)
    assert Counter((r.id, r.v) for r in store.read("lines").collect()) == {("1", 1): 3, ("2", 5): 3, ("3", 2): 3}
    with pytest.raises(ValueError, match="no table other"):
        store.read("other")


def test_scans(spark, tmp_path):
    spark.createDataFrame([(1, 2.0)], "a int, b double").write.parquet(f"{tmp_path}/p/y=1")
    spark.createDataFrame([(3, "x")], "a int, c string").write.parquet(f"{tmp_path}/p/y=2")
    rows = scans.read_parts(spark, f"{tmp_path}/p")
    assert scans.available(rows, ["c", "q", "b"]) == ["c", "b"]
    assert Counter(map(tuple, rows.select("a", "b", "c", "y").collect())) == {(1, 2.0, None, 1): 1, (3, None, "x", 2): 1}
    assert "ReadSchema: struct<b:double>" in rows.select("b")._jdf.queryExecution().toString()
    with pytest.raises(ValueError, match="missing columns: q, z"):
        scans.required(rows, ["z", "a", "q"])
    with pytest.raises(ValueError, match="unsupported"):
        scans.read_table(spark, f"{tmp_path}/x.xlsx")
    raw = spark.createDataFrame([("2024-01-02", " A-B ", "3"), ("2024-01-02", "A-B", "x"), ("2024-03-01", "A-B", "1"), ("soon", "A-B", "1")], "PickDate string, SKU string, PickUnits string")
    raw.write.option("header", True).csv(f"{tmp_path}/a.csv")
    raw.drop("PickUnits").write.parquet(f"{tmp_path}/a.parquet")
    assert [tuple(r) for r in scans.portable_actuals(spark, f"{tmp_path}/a.csv", DAY, DAY + dt.timedelta(30)).collect()] == [(dt.date(2024, 1, 2), "A-B", 3.0)]
    with pytest.raises(ValueError, match=r"SoldUnits \(SoldUnits or PickUnits or Units\)"):
        scans.portable_actuals(spark, f"{tmp_path}/a.parquet", DAY, DAY)


def wide(sku, start, first=1.0, putaway="1"):
    return (sku, "A", putaway, start, first, *[0.0] * 12, 2.0)


def test_wide_files(spark):
    a = [wide("s1", "2024-01-02"), wide("s2", "2024-01-02", "bad", "x"), wide(" s3 ", "never"), wide("s4", "2024-01-09")]
    files = {"a.csv": a, "b.csv": a[::-1], "c.csv": [*a, wide("s1", "2024-01-02")], "d.csv": [wide("s1", None)], "e.csv": a[:2]}
    raw = spark.createDataFrame([(f, *[None if v is None else str(v) for v in r]) for f, rs in files.items() for r in rs], ["f", *vintages.COLUMNS])
    rows = vintages.typed(raw, F.col("f"))
    meta = {r.SourceFile: r for r in vintages.file_metadata(rows).collect()}
    assert {f: r.Status for f, r in meta.items()} == {"a.csv": "imported", "b.csv": "skipped_content", "c.csv": "duplicate_skus", "d.csv": "no_start", "e.csv": "imported"}
    one = meta["a.csv"]
    assert (one.RowsImported, one.DistinctSKUs, one.TotalForecastUnits, one.FilledStarts, one.ActiveSKUCount) == (4, 4, 11.0, 1, 3)
    assert (str(one.ForecastStartDateMin), str(one.ForecastStartDateMax)) == ("2024-01-02", "2024-01-09") and one.ContentId == meta["b.csv"].ContentId != meta["e.csv"].ContentId
    long = vintages.by_day(rows, vintages.file_metadata(rows))
    assert {(r.SKU, r.ForecastDayOffset, str(r.ForecastDate), r.ForecastQty) for r in long.where(F.col("SnapshotId") == one.SnapshotId).collect()} == {
        ("s1", 1, "2024-01-02", 1.0), ("s1", 14, "2024-01-15", 2.0), ("s2", 14, "2024-01-15", 2.0), ("s3", 1, "2024-01-02", 1.0), ("s3", 14, "2024-01-15", 2.0),
        ("s4", 1, "2024-01-09", 1.0), ("s4", 14, "2024-01-22", 2.0)}
    known = spark.createDataFrame([(one.SnapshotId, "other"), ("other", meta["e.csv"].ContentId)], "SnapshotId string, ContentId string")
    assert {r.SourceFile: r.Status for r in vintages.file_metadata(rows, known).collect()} == {
        "a.csv": "skipped", "b.csv": "imported", "c.csv": "duplicate_skus", "d.csv": "no_start", "e.csv": "skipped_content"}
    with pytest.raises(ValueError, match="FD14"):
        vintages.typed(raw.drop("FD14"), F.col("f"))
