"""Writers with manifests read back from what was written, and typed CSV readers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared ``spark.checkpoint.dir``; a temporary one of this machine only in local mode, where that may be unset."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        base = "file://" + tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("TMPDIR", "/tmp"))
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of the work folder: computed once, its lineage cut, its size known to Spark."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_shards(rows: DataFrame, path: str, by: dict, overwrite: bool = False) -> DataFrame:
    """Write zstd Parquet in one folder for each value of ``by`` and read it again; an existing path is an error unless asked."""
    shards = rows.withColumns(by)
    shards.write.partitionBy(*by).option("compression", "zstd").mode("overwrite" if overwrite else "errorifexists").parquet(path)
    return rows.sparkSession.read.schema(shards.schema).parquet(path)


def write_twins(rows: DataFrame, path: str) -> tuple[str, str]:
    """The same rows as zstd Parquet and as CSV with header, computed once; the two paths."""
    rows.write.option("compression", "zstd").parquet(f"{path}.parquet")
    rows.sparkSession.read.schema(rows.schema).parquet(f"{path}.parquet").write.option("header", True).csv(f"{path}.csv")
    return f"{path}.parquet", f"{path}.csv"


def manifest(rows: DataFrame, by: list[str], day: str, sku: str, units: str) -> DataFrame:
    """Rows, distinct SKUs, units and date span of each part."""
    return rows.groupBy(*by).agg(F.count("*").alias("Rows"), F.countDistinct(sku).alias("SKUs"), F.sum(units).alias("Units"), F.min(day).alias("FirstDay"), F.max(day).alias("LastDay"))


def read_typed_csv(spark: SparkSession, path: str, types: dict[str, str]) -> DataFrame:
    """A CSV with header: a missing column is an error, a value that is not of its type is null."""
    raw = spark.read.option("header", True).csv(path)
    missing = sorted(set(types) - set(raw.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return raw.select(*[F.col(c).try_cast(t).alias(c) for c, t in types.items()])
