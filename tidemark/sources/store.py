"""Tables of parts with a manifest: a write puts files beside the old ones, and counts only when its manifest is there.

A part (a month, a vintage) is replaced as a whole; parts that a write doesn't touch keep their files. Readers see the parts of the newest
manifest, so a failed write changes nothing, and several tables change together. One writer at a time: a second one that
commits the same version fails.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "table string, part string, write string, rows long"


class PartStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def version(self) -> int:
        """The newest committed version, 0 for none."""
        try:
            versions = self.spark.read.parquet(f"{self.root}/manifest").select(F.max("version"))
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return 0
        return versions.first()[0] or 0

    def manifest(self) -> DataFrame:
        """(table, part, write, rows) of the newest version."""
        n = self.version()
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest/version={n}") if n else self.spark.createDataFrame([], MANIFEST)

    def read(self, table: str) -> DataFrame:
        """The rows of a table, without the part; one scan for each write that still has parts, pruned to these."""
        live: dict[str, list[str]] = {}
        for r in self.manifest().where(F.col("table") == table).orderBy("write", "part").collect():
            live.setdefault(r["write"], []).append(f"_{r['part']}")
        if not live:
            raise ValueError(f"the store has no table {table}")
        scans = [self.spark.read.parquet(f"{self.root}/{table}/{w}").where(F.col("_part").isin(parts)).drop("_part") for w, parts in live.items()]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)

    def _write(self, table: str, rows: DataFrame, part: Column) -> DataFrame:
        """Files of a new write, and the manifest rows of its parts."""
        write = uuid.uuid4().hex
        # the mark keeps Spark from taking a part for a number or a date
        rows = rows.withColumn("_part", F.concat(F.lit("_"), part.cast("string"))).hint("rebalance", "_part")
        rows.write.partitionBy("_part").option("compression", "zstd").parquet(f"{self.root}/{table}/{write}")
        counts = self.spark.read.parquet(f"{self.root}/{table}/{write}").groupBy("_part").agg(F.count("*").alias("rows"))
        return counts.select(F.lit(table).alias("table"), F.substring("_part", 2, 1 << 20).alias("part"), F.lit(write).alias("write"), "rows")

    def _commit(self, kept: DataFrame, new: list[DataFrame]) -> None:
        after = reduce(DataFrame.unionByName, new, kept)
        # one file, so that the version appears at once
        after.coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/manifest/version={self.version() + 1}")

    def replace_range(self, table: str, rows: DataFrame, day: str, part) -> tuple | None:
        """Replace all days from the first to the last of ``rows``, and return these; no rows change nothing.

        ``part`` makes the part of a day, and must not fall as days rise. What lies outside the span in its first and last part is kept.
        """
        span = rows.agg(F.min(day), F.max(day)).first()
        if span[0] is None:
            return None
        first, last = self.spark.range(1).select(part(F.lit(span[0])).cast("string"), part(F.lit(span[1])).cast("string")).first()
        now = self.manifest()
        mine = (F.col("table") == table) & F.col("part").between(first, last)
        if not now.where(mine).isEmpty():
            old = self.read(table)
            old = old.where(part(F.col(day)).cast("string").between(first, last) & ~F.coalesce(F.col(day).between(*span), F.lit(False)))
            rows = old.unionByName(rows)
        self._commit(now.where(~mine), [self._write(table, rows, part(F.col(day)))])
        return tuple(span)

    def replace_parts(self, tables: dict[str, DataFrame], by: str, overwrite: bool = False) -> DataFrame:
        """Import parts of several tables together: (part, status), which is ``imported``, or ``skipped`` for one that is there unless asked to overwrite."""
        asked = reduce(DataFrame.union, [df.select(F.col(by).cast("string").alias("part")) for df in tables.values()]).distinct()
        now = self.manifest()
        there = now.where(F.col("table").isin(*tables)).select("part").distinct()
        known = sorted(r["part"] for r in asked.join(there, "part").collect())  # a row for each part
        given = asked.select("part", F.when(F.col("part").isin(known) & F.lit(not overwrite), "skipped").otherwise("imported").alias("status"))
        given = self.spark.createDataFrame(given.orderBy("part").collect(), "part string, status string")
        new = [self._write(t, df if overwrite else df.where(~F.col(by).cast("string").isin(known)), F.col(by)) for t, df in tables.items()]
        gone = F.col("table").isin(*tables) & F.col("part").isin(known) & F.lit(overwrite)
        self._commit(now.where(~gone), new)
        return given
