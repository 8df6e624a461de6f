"""Every registered query gives rows at the smallest size, and they are those of its SQL."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points
from compare_oracle import _cell
from tidemark.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_without_training_data_operators():
    assert set(catalog.queries()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_columns_and_rows(spark, name):
    df = entry_points.queries()[name](spark, SF)
    if name not in entry_points.oracle_sql():
        assert df.count() > 0
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    cur = con.execute(entry_points.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    want = Counter(tuple(_cell(r[columns.index(c)]) for c in df.columns) for r in cur.fetchall())
    assert Counter(tuple(map(_cell, r)) for r in df.collect()) == want
