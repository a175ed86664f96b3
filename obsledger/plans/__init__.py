"""Runnable queries over the ledger operators."""

from obsledger.plans import (  # noqa: F401
    canonical_queries,
    graph_queries,
    item_queries,
    metric_queries,
    model_queries,
    rule_queries,
    source_queries,
    stored_queries,
)
from obsledger.plans.canonical_queries import flagship
from obsledger.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]
