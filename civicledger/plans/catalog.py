"""All registered queries."""

from __future__ import annotations

from civicledger.plans import (  # noqa: F401  (importing registers the queries)
    kpi_queries,
    link_queries,
    manifest_queries,
    statement_queries,
    stream_queries,
)
from civicledger.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
