"""Scans by path: required columns, parts whose columns differ, columns under one of several names, formats by suffix."""

from __future__ import annotations

import os
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import normal_sku


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet or CSV (with header) table, by the suffix of its path."""
    suffix = os.path.splitext(urlparse(path).path.rstrip("/"))[1].lower()
    if suffix == ".parquet":
        return spark.read.parquet(path)
    if suffix == ".csv":
        return spark.read.option("header", True).csv(path)
    raise ValueError(f"unsupported table: {path}")


def required(df: DataFrame, columns: list[str]) -> DataFrame:
    """These columns alone; an error names those that are absent."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*columns)


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """A folder of Parquet parts whose columns differ: all columns of all parts, null where a part lacks one. Only columns that are used are read."""
    return spark.read.option("mergeSchema", True).parquet(path)


def available(df: DataFrame, wanted: list[str]) -> list[str]:
    """Those of the wanted columns that there are, in their order."""
    return [c for c in wanted if c in df.columns]


def under_common_names(df: DataFrame, alternatives: dict[str, tuple[str, ...]]) -> DataFrame:
    """One column for each name, from the first of its alternatives that there is; an error says for which there is none."""
    found = {name: next((c for c in names if c in df.columns), None) for name, names in alternatives.items()}
    missing = [f"{name} ({' or '.join(alternatives[name])})" for name, c in found.items() if c is None]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[F.col(c).alias(name) for name, c in found.items()])


#: The names under which exports have their day and units.
PORTABLE = {"ActualDate": ("ActualDate", "PickDate", "Date"), "SKU": ("SKU",), "SoldUnits": ("SoldUnits", "PickUnits", "Units")}


def portable_actuals(spark: SparkSession, path: str, first, last) -> DataFrame:
    """(ActualDate, SKU, SoldUnits) between two days, from a table of either format under either name; SKUs in normal form, bad units 0, bad days gone."""
    rows = under_common_names(read_table(spark, path), PORTABLE)
    text = rows.select(F.col("ActualDate").cast("string").try_cast("date").alias("ActualDate"), normal_sku(F.col("SKU").cast("string")).alias("SKU"),
        F.coalesce(F.col("SoldUnits").cast("string").try_cast("double"), F.lit(0.0)).alias("SoldUnits"))
    return text.where(F.col("ActualDate").between(first, last)).groupBy("ActualDate", "SKU").agg(F.sum("SoldUnits").alias("SoldUnits"))
