"""Dates, kinds and events of sheets as cells."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import sheets

RANGES = [
    ("7/4/98 - 7/9/1998", 2024, (2098, 7, 4), (2098, 7, 4)), ("12/28 - 1/3", 2024, (2024, 12, 28), (2025, 1, 3)), ("2/29", 2024, (2024, 2, 29), (2024, 2, 29)),
    ("2/29", 2023, None, None), ("from 3.5 to 13/40", 2024, (2024, 3, 5), (2024, 3, 5)), ("", 2024, None, None), (None, 2024, None, None), ("no 12 dates 345/6", 2024, None, None),
    ("3/9 - 3/5/2023", 2024, (2024, 3, 9), (2023, 3, 5)), ("2/28 - 2/29", 2023, (2023, 2, 28), (2023, 2, 28)),
]


def test_date_range(spark):
    rows = spark.createDataFrame([(k, t, y) for k, (t, y, *_) in enumerate(RANGES)], "k int, t string, y int")
    got = {r.k: (r.d["first"], r.d["last"]) for r in rows.select("k", sheets.date_range(F.col("t"), F.col("y")).alias("d")).collect()}
    day = lambda x: x and dt.date(*x)
    want = {k: (day(a), day(b)) for k, (_, _, a, b) in enumerate(RANGES)}
    # 7/9/1998 lies before 7/4/2098, and has its own year
    want[0] = (dt.date(2098, 7, 4), dt.date(1998, 7, 9))
    assert got == want


def test_events(spark):
    cells = [(1, "Sheet 3/5-3/9", 0, 0, "Event Name:"), (1, "Sheet 3/5-3/9", 0, 3, "Big Sale"), (1, "Sheet 3/5-3/9", 1, 0, "Effective Date(s)"), (1, "Sheet 3/5-3/9", 1, 1, "1/2-1/5"),
        (1, "Sheet 3/5-3/9", 4, 0, "Offer"), (1, "Sheet 3/5-3/9", 4, 1, "Style ID"), (1, "Sheet 3/5-3/9", 4, 2, "Dept"), (1, "Plain 4/6", 0, 0, "text"), (2, "Data", 9, 4, "x")]
    frame = spark.createDataFrame(cells, "file_id int, sheet_name string, rw int, cl int, val string")
    files = spark.createDataFrame([(1, "Coupon list.xlsx", dt.date(2024, 11, 1)), (2, None, None)], "file_id int, source_file string, file_date date")
    got = {r.sheet_name: r.asDict() for r in sheets.sheet_events(frame, files, sheets.ALIASES).collect()}
    one, plain, data = got["Sheet 3/5-3/9"], got["Plain 4/6"], got["Data"]
    # a file of November that names January means the next one
    assert (one["event"], one["start_date"], one["end_date"], one["header_row"], one["height"], one["width"]) == ("Big Sale", dt.date(2025, 1, 2), dt.date(2025, 1, 5), 4, 5, 4)
    assert one["kind"] == plain["kind"] == "coupon" and data["kind"] == "support"
    assert (plain["start_date"], plain["event"], data["start_date"]) == (dt.date(2024, 4, 6), None, None)


@pytest.mark.parametrize(("label", "key"), [("Dept", "department"), ("Style ID", "style"), ("Orig MSRP", "original_msrp"), ("Avail Inv ", "avail_inv"), ("% Off MSRP", "pct_off_msrp"), ("", "")])
def test_header_keys(spark, label, key):
    assert spark.createDataFrame([(label,)], "c string").select(sheets.header_key(F.col("c"), sheets.ALIASES)).first()[0] == key
