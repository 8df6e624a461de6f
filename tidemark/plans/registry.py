"""Queries register themselves with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from tidemark.sources.facts import fact, with_views

#: About so many line items are in a partition of ``Facts.dealt``.
LINES = 250_000

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


class Facts:
    """The views by name: ``t.work_lines``."""

    def __init__(self, spark, sf_dir):
        self._at = spark, sf_dir

    def base(self, name):
        """A base table as it is."""
        return self._at[0].read.parquet(f"{self._at[1]}/{name}.parquet")

    def dealt(self, rows, *keys):
        """``rows``, some for each line item, by ``keys`` in partitions that do not grow with the table: their number does. It is read from the files' footers."""
        lines = self.base("lineitem").count()
        return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, -(-lines // LINES)), *keys)

    def __getattr__(self, name):
        return fact(*self._at, name)


def query(sql: str | None = None):
    """Register a function of the facts; ``sql`` is the same over the views, None where SQL cannot say it."""

    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Facts(spark, sf_dir))
        if sql:
            ORACLES[f.__name__] = with_views(sql)
        return f

    return register
