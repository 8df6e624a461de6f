"""URL filters: captures are judged by the list entries that were active when they were fetched.

Dated entries (list, pattern, add or remove, time) become validity intervals: an addition holds until the next removal
of the same pattern from the same list. A pattern is a host with all hosts below it (``example.com``), or an exact host
with a path prefix of whole segments (``www.example.com/a/b``). Each capture asks for all its patterns at its time.

The as-of join runs on distinct (pattern, time) questions, so the captures of a very common host are asked once for
each time. Intervals are cut at time buckets and a question meets, inside (pattern, list, bucket), the last piece that
began at or before it: the work is a sort, never all pairs, and a pattern's work is spread over its buckets, of which the
span of the questions makes PIECES, in whatever unit times are.

A URL asks for no more labels and path segments than the longest pattern of the lists has, so a URL of very many
segments costs no more than its length.

Defined results: a null or hostless URL, and a null time, match nothing and the row stays; several entries for one pattern,
list and time count as an addition if one of them is; removals without an addition do nothing; repeated captures get a
row each; list entries with a null in any column are void; very long URLs are judged whole; an empty list leaves every
capture free and empty captures give no rows; other columns of both tables are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.files import shared_dir, written

#: Time buckets that the span of all questions is cut into.
PIECES = 64


def host_of(url: Column) -> Column:
    """Lower-case host without port; null where there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", F.rtrim(host, F.lit(".")))


def patterns_of(url: Column, labels: int, segments: int) -> Column:
    """The patterns that match a URL and have at most so many labels or, behind the host, segments."""

    def own(x: Column) -> Column:
        host, names, path = x["host"], x["names"], x["path"]
        parents = F.transform(F.sequence(F.lit(1), F.size(names)), lambda i: F.array_join(F.slice(names, i, F.size(names)), "."))
        prefixes = F.transform(path, lambda s, i: F.concat(host, F.lit("/"), F.array_join(F.slice(path, F.lit(1), i + 1), "/")))
        return F.array_distinct(F.concat(parents, prefixes))

    host = host_of(url)
    names = F.split(host, r"\.")
    path = F.filter(F.split(F.regexp_extract(url, r"^[^:]+://[^/?#]*/([^?#]*)", 1), "/"), lambda s: s != "")
    last = F.slice(names, F.greatest(F.lit(1), F.size(names) - labels + 1), F.lit(labels))
    # one step over one struct: its parts are computed once, and not again for each pattern
    parts = F.struct(host.alias("host"), last.alias("names"), F.slice(path, 1, segments).alias("path"))
    return F.when(host.isNotNull(), F.get(F.transform(F.array(parts), own), F.lit(0)))


def longest(intervals: DataFrame) -> tuple[int, int]:
    """The most labels of a host pattern and the most segments behind the host of a path pattern."""
    slashes = F.size(F.split("pattern", "/")) - 1
    got = intervals.agg(F.max(F.when(slashes == 0, F.size(F.split("pattern", r"\.")))), F.max(slashes)).first()
    return max(1, got[0] or 0), max(0, got[1] or 0)


def validity(entries: DataFrame) -> DataFrame:
    """(list, pattern, begin, until) of the times in which a pattern is on a list; until is null for ever.

    ``entries`` has list, pattern, added (boolean) and at (a number of seconds or days).
    """
    known = entries.where("list is not null and pattern is not null and added is not null and at is not null")
    states = known.groupBy("list", "pattern", "at").agg(F.max("added").alias("added"))
    later = Window.partitionBy("list", "pattern").orderBy("at")
    turns = states.withColumn("was", F.lag("added").over(later)).where("added <> coalesce(was, false)")
    return turns.withColumn("until", F.lead("at").over(later)).where("added").select("list", "pattern", F.col("at").alias("begin"), "until")


def active_lists(questions: DataFrame, intervals: DataFrame, bucket: int | None = None) -> DataFrame:
    """(pattern, at, list) for the distinct questions (pattern, at) whose pattern is on a list at that time.

    ``bucket`` is a length of time; without it the span of the questions is cut into PIECES.
    """
    span = questions.agg(F.min("at"), F.max("at")).first()
    if span[0] is None:
        return questions.select("pattern", "at", F.lit("").alias("list")).limit(0)
    low, high = int(span[0]), int(span[1])
    bucket = bucket or max(1, -(-(high - low + 1) // PIECES))
    near = intervals.where((F.col("begin") <= high) & (F.coalesce("until", F.lit(high + 1)) > low))
    first, last = F.greatest("begin", F.lit(low)), F.least(F.coalesce("until", F.lit(high + 1)) - 1, F.lit(high))
    place = lambda c: F.floor(c / bucket)
    pieces = near.withColumn("b", F.explode(F.sequence(place(first), place(last))))
    pieces = pieces.select("list", "pattern", "b", F.greatest("begin", F.col("b") * bucket).cast("long").alias("at"), F.coalesce("until", F.lit(high + 1)).cast("long").alias("until"))
    pairs = near.select("list", "pattern").distinct()
    asked = questions.join(pairs, "pattern").select("list", "pattern", place(F.col("at")).alias("b"), "at", F.lit(None).cast("long").alias("until"))
    before = Window.partitionBy("list", "pattern", "b").orderBy("at", F.asc("asks")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = pieces.withColumn("asks", F.lit(0)).unionByName(asked.withColumn("asks", F.lit(1)))
    rows = rows.withColumn("holds", F.last("until", ignorenulls=True).over(before))
    return rows.where("asks = 1 and holds > at").select("pattern", "at", "list")


def judge(captures: DataFrame, entries: DataFrame, bucket: int | None = None, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """One row for each row of ``captures``: (id_col, url, fetched, lists, blocked); lists is sorted."""
    at = shared_dir(captures.sparkSession, "lists")
    rows = captures.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(time_col).cast("long").alias("at"))
    intervals = written(validity(entries), f"{at}/intervals")
    patterns = patterns_of(F.col("url"), *longest(intervals))
    # the questions are written once: what follows reads them three times
    asks = written(rows.where("at is not null").select("url", "at").distinct().select("url", "at", F.explode(patterns).alias("pattern")), f"{at}/asks")
    active = active_lists(asks.select("pattern", "at").distinct(), intervals, bucket)
    found = asks.join(active, ["pattern", "at"]).groupBy("url", "at").agg(F.sort_array(F.collect_set("list")).alias("lists"))
    lists = F.coalesce("lists", F.array().cast("array<string>"))
    return rows.join(found, ["url", "at"], "left").select(F.col("id").alias(id_col), "url", F.col("at").alias("fetched"), lists.alias("lists"), (F.size(lists) > 0).alias("blocked"))
