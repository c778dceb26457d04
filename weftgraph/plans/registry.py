"""Every registered query of the graph engine and its SQL."""

from __future__ import annotations

from weftgraph.plans import graph_queries, page_queries, resolve_queries, run_queries, sample_queries, text_queries  # noqa: F401
from weftgraph.plans.base import QUERIES, SQL

FLAGSHIP = "graph_stats"


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
