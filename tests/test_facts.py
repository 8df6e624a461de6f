"""The views over base tables whose keys are larger than those of the test data."""

from __future__ import annotations

from collections import Counter

import duckdb
from pyspark.sql import functions as F

from tidemark.plans import catalog
from tidemark.sources.facts import BASE, fact, with_views

SF = "/root/testdata/sf0.001"


def test_skus_of_long_part_keys(spark, tmp_path):
    """Parts whose keys share their first six digits are SKUs of their own, in Spark and in the SQL; short keys are filled to six."""
    keys = [7, 123456, 1234567, 1234568, 12345678]
    part = spark.read.parquet(f"{SF}/part.parquet").limit(1).drop("p_partkey").crossJoin(spark.createDataFrame([(k,) for k in keys], "p_partkey long"))
    part.withColumn("p_partkey", F.col("p_partkey")).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    for t in set(BASE) - {"part"}:
        spark.read.parquet(f"{SF}/{t}.parquet").coalesce(1).write.parquet(f"{tmp_path}/{t}.parquet")
    got = {r.pk: (r.Item, r.SKU) for r in fact(spark, str(tmp_path), "dim_product").collect()}
    con = duckdb.connect()
    for t in BASE:
        con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    want = {k: (item, sku) for k, item, sku in con.execute(with_views("select pk, Item, SKU from dim_product")).fetchall()}
    assert got == want
    assert [got[k][0] for k in keys] == ["I000007", "I123456", "I1234567", "I1234568", "I12345678"] and len({s for _, s in got.values()}) == len(keys)


def test_category_pool_of_long_part_keys(spark, tmp_path):
    """The pool is the same as its SQL where part keys have eight digits, with one row for each SKU and day."""
    for t in BASE:
        rows = spark.read.parquet(f"{SF}/{t}.parquet")
        rows = rows.withColumns({k: F.col(k) + 10_000_000 for k in ("p_partkey", "l_partkey") if k in rows.columns})
        rows.coalesce(1).write.parquet(f"{tmp_path}/{t}.parquet")
    got = [tuple(r) for r in catalog.queries()["category_pool"](spark, str(tmp_path)).collect()]
    con = duckdb.connect()
    for t in BASE:
        con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    want = con.execute(f"select Origin, SKU, ForecastDate, Units from ({catalog.oracle_sql()['category_pool']})").fetchall()
    assert got and Counter(got) == Counter(want) and len({r[:3] for r in got}) == len(got)
