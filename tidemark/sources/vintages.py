"""Wide vintage files (a row for each SKU, a column for each day of the horizon): checks, metadata with a content digest, rows by day.

A file is known by an order-free digest: its row count and the sums of two hashes of its rows. The sums are taken by Spark's partial
aggregation, so files of any size, and in any order of rows, are compared without a list of their rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.scans import required
from tidemark.sources.sinks import kept

DAYS = [f"FD{k}" for k in range(1, 15)]
TEXTS, NUMBERS = ["SKU", "Velocity"], ["PutawayIndicator"]
COLUMNS = [*TEXTS, *NUMBERS, "ForecastStartDate", *DAYS]


def typed(raw: DataFrame, file: Column) -> DataFrame:
    """The columns of a vintage with their types: texts trimmed, bad numbers 0 or null; a bad start is the file's most common one (the earliest of equals)."""
    rows = required(raw.withColumn("SourceFile", file), ["SourceFile", *COLUMNS])
    number = lambda c: F.col(c).cast("string").try_cast("double")
    rows = rows.select("SourceFile", *[F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in TEXTS],
        *[number(c).cast("int").alias(c) for c in NUMBERS], F.col("ForecastStartDate").cast("string").try_cast("date").alias("_start"),
            *[F.coalesce(number(c), F.lit(0.0)).alias(c) for c in DAYS])
    rows = kept(rows, "typed")  # texts are parsed once; what follows reads the rows several times
    starts = rows.where("_start is not null").groupBy("SourceFile", "_start").agg(F.count("*").alias("n"))
    common = starts.groupBy("SourceFile").agg(F.min(F.struct((-F.col("n")).alias("n"), "_start"))["_start"].alias("_mode"))
    rows = rows.join(common, "SourceFile", "left")
    return rows.select("SourceFile", *TEXTS, *NUMBERS, F.coalesce("_start", "_mode").alias("ForecastStartDate"), F.col("_start").isNull().alias("Filled"), *DAYS)


def row_text() -> Column:
    """A row of a vintage as text, the same for equal rows."""
    amounts = [F.col(c).cast("decimal(18,4)").cast("string") for c in DAYS]
    return F.concat_ws("|", *TEXTS, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in NUMBERS], F.col("ForecastStartDate").cast("string"), *amounts)


def digest(text: Column) -> Column:
    """An aggregate: the same for the same rows in any order, rows that repeat counted."""
    part = lambda at: F.sum(F.conv(F.substring(F.md5(text.cast("binary")), at, 15), 16, 10).cast("decimal(20,0)"))
    return F.sha2(F.concat_ws(":", F.count("*").cast("string"), part(1).cast("string"), part(17).cast("string")).cast("binary"), 256)


def file_metadata(rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """A row for each file: counts, spans, digest, id, and its status.

    ``duplicate_skus`` and ``no_start`` files are rejected; ``skipped`` has the id of a vintage in ``known`` (SnapshotId, ContentId), ``skipped_content`` the
    content of one, or of a file of an earlier name; others are ``imported``.
    """
    total = sum((F.col(c) for c in DAYS[1:]), F.col(DAYS[0]))
    skus = rows.groupBy("SourceFile", "SKU").agg(F.count("*").alias("_n")).groupBy("SourceFile").agg(F.count("*").alias("DistinctSKUs"), F.max("_n").alias("_most"))
    files = rows.withColumns({"_total": total, "_text": row_text()}).groupBy("SourceFile").agg(
        F.count("*").alias("RowsImported"), F.min("ForecastStartDate").alias("ForecastStartDateMin"), F.max("ForecastStartDate").alias("ForecastStartDateMax"),
        F.sum("_total").alias("TotalForecastUnits"), F.count_if(F.col("_total") > 0).alias("ForecastedSKUs"), F.count_if(F.col("_total") == 0).alias("ZeroForecastSKUs"),
        *[F.count_if(F.col("PutawayIndicator") == k).alias(n) for n, k in (("ActiveSKUCount", 1), ("ReserveSKUCount", 0), ("OffsiteSKUCount", 2))],
        F.count_if("Filled").alias("FilledStarts"), F.count_if(F.col("ForecastStartDate").isNull()).alias("_no_start"), digest(F.col("_text")).alias("ContentId"),
    )
    files = files.join(skus, "SourceFile").withColumn("SnapshotId", F.sha2(F.concat(F.lower("SourceFile"), F.lit("|"), F.col("ContentId")).cast("binary"), 256))
    bad = F.when(F.col("_most") > 1, "duplicate_skus").when(F.col("_no_start") > 0, "no_start")
    if known is not None:
        ids, contents = known.select("SnapshotId", F.lit(True).alias("_id")).distinct(), known.select("ContentId", F.lit(True).alias("_content")).distinct()
        files = files.join(ids, "SnapshotId", "left").join(contents, "ContentId", "left")
        bad = F.coalesce(bad, F.when(F.col("_id"), "skipped").when(F.col("_content"), "skipped_content"))
    files = files.withColumn("_bad", bad)
    # a row for each file of the import
    place = F.row_number().over(Window.partitionBy("ContentId").orderBy(F.col("_bad").isNotNull(), "SourceFile"))
    status = F.coalesce("_bad", F.when(place > 1, "skipped_content").otherwise("imported"))
    return files.withColumn("Status", status).drop(*[c for c in ("_most", "_no_start", "_bad", "_id", "_content") if c in (*files.columns, "_bad")])


def by_day(rows: DataFrame, files: DataFrame, zero_days: bool = False) -> DataFrame:
    """(SnapshotId, SKU, ForecastStartDate, ForecastDayOffset, ForecastDate, ForecastQty) of the imported files; days of 0 only if asked."""
    chosen = files.where("Status = 'imported'").select("SourceFile", "SnapshotId")
    days = F.posexplode(F.array(*map(F.col, DAYS))).alias("k", "ForecastQty")
    long = rows.join(chosen, "SourceFile").select("SnapshotId", "SKU", "ForecastStartDate", days)
    long = long if zero_days else long.where("ForecastQty <> 0")
    return long.select("SnapshotId", "SKU", "ForecastStartDate", (F.col("k") + 1).alias("ForecastDayOffset"), F.date_add("ForecastStartDate", F.col("k")).alias("ForecastDate"), "ForecastQty")
