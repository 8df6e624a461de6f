"""As-of, interval, lagged and seasonal joins as equi joins and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in the given order, which must end in a tie-break."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rank = 1").drop("_rank")


def upserted(old: DataFrame, new: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Old and new rows, the new one where both have a key, with ``replaced``; a key is once in each table."""
    held = F.struct(*values)
    both = old.select(*keys, F.lit(1).alias("_rank"), held.alias("_v")).unionByName(new.select(*keys, F.lit(0).alias("_rank"), held.alias("_v")))
    return both.groupBy(*keys).agg(F.min(F.struct("_rank", "_v")).alias("_x"), (F.count("*") > 1).alias("replaced")).select(*keys,
        *[F.col(f"_x._v.{v}").alias(v) for v in values], "replaced")


def full_outer_zero(left: DataFrame, right: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Full outer join in which missing measures are 0."""
    return left.join(right, keys, "full").withColumns({m: F.coalesce(m, F.lit(0.0)) for m in measures})


def asof_latest(events: DataFrame, history: DataFrame, keys: list[str], at: str, known: str, tolerance: int | None = None, strict: bool = False) -> DataFrame:
    """Each event row with the latest history row of its key known at that time; no row is lost.

    Both sides are sorted together inside a key, so no pairs are made. With ``tolerance`` a latest row that is more
    days old counts as none; there is no fallback to an older one. ``strict`` asks for rows known before the time.
    """
    held = [c for c in history.columns if c not in keys]
    a = events.withColumns({"_at": F.col(at), "_side": F.lit(0 if strict else 1), "_row": F.lit(None).cast(history.select(F.struct(*held)).schema[0].dataType)})
    b = history.select(*keys, F.col(known).alias("_at"), F.lit(1 if strict else 0).alias("_side"), F.struct(*held).alias("_row"))
    both = a.unionByName(b, allowMissingColumns=True).withColumn("_event", F.col("_row").isNull())
    last = F.last("_row", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = both.withColumn("_last", last).where("_event")
    fresh = F.lit(True) if tolerance is None else F.datediff("_at", F.col("_last")[known]) <= tolerance
    return rows.select(*events.columns, *[F.when(fresh, F.col("_last")[c]).alias(c) for c in held if c not in events.columns])


def latest_snapshot(history: DataFrame, origins: DataFrame, origin: str, known: str, lag: int = 1) -> DataFrame:
    """For each origin the whole latest snapshot of at most ``lag`` days before; the choice is by date, not by key."""
    dates = history.select(known).distinct()
    chosen = asof_latest(origins.select(F.col(origin), F.lit(1).alias("_one"), F.date_sub(origin, lag).alias("_limit")), dates.withColumn("_one", F.lit(1)),
        ["_one"], "_limit", known)
    return history.join(chosen.select(origin, known), known)


def _near_sums(asks: DataFrame, facts: DataFrame, keys: list[str], at: str, day: str, measure: str, first: int, last: int, out: str) -> DataFrame:
    """``asks`` with the sum of a measure over the days from ``at`` + first to ``at`` + last; null where there is none.

    Asks and facts are sorted together inside a key and summed in a frame of days: one row for each of them, no row for each day.
    """
    a = asks.withColumns({"_n": F.unix_date(at), "_m": F.lit(None).cast("double"), "_ask": F.lit(True)})
    b = facts.select(*keys, F.unix_date(day).alias("_n"), F.col(measure).cast("double").alias("_m"))
    near = F.sum("_m").over(Window.partitionBy(*keys).orderBy("_n").rangeBetween(first, last))
    return a.unionByName(b, allowMissingColumns=True).withColumn(out, near).where("_ask").drop("_n", "_m", "_ask")


def in_window(starts: DataFrame, facts: DataFrame, keys: list[str], start: str, day: str, days: int, measure: str, out: str) -> DataFrame:
    """Rows of ``starts`` with the sum of a measure in [start, start + days)."""
    return _near_sums(starts, facts, keys, start, day, measure, 0, days - 1, out).withColumn(out, F.coalesce(out, F.lit(0.0)))


def days_later(df: DataFrame, day: str, days: int = 1) -> DataFrame:
    return df.withColumn(day, F.date_add(day, days))


def seasonal_mean(targets: DataFrame, facts: DataFrame, keys: list[str], day: str, fact_day: str, measure: str, years: int, radius: int, out: str) -> DataFrame:
    """Mean of a measure over the days within ``radius`` of the same day in each of ``years`` prior years; the divisor is fixed.

    Targets that repeat are one row.
    """
    asks = targets.withColumn("_y", F.explode(F.sequence(F.lit(1), F.lit(years)))).withColumn("_day", F.expr(f"add_months(`{day}`, -12 * _y)"))
    rows = _near_sums(asks, facts, keys, "_day", fact_day, measure, -radius, radius, "_sum")
    mean = F.coalesce(F.sum("_sum"), F.lit(0.0)) / (years * (2 * radius + 1))
    return rows.groupBy(*targets.columns).agg(mean.alias(out))


def set_difference(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Counts of keys that only one side has or both have."""
    both = old.select(key).distinct().withColumn("_o", F.lit(1)).join(new.select(key).distinct().withColumn("_n", F.lit(1)), key, "full")
    return both.agg(F.count_if(F.col("_n").isNull()).alias("old_only"), F.count_if(F.col("_o").isNull()).alias("new_only"),
        F.count_if(F.col("_o").isNotNull() & F.col("_n").isNotNull()).alias("shared"))
