"""The registered queries and their DuckDB SQL."""

from __future__ import annotations

from tidemark.plans import adjust, churn, evaluation, exports, forecasts, imports, lifts, modelling, origins, panel, rollups, shaping  # noqa: F401
from tidemark.plans.registry import ORACLES, QUERIES

FLAGSHIP = "window_scorecard"


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
