"""All named queries."""

from opinara.plans import cluster, eda, evaluate, graph, loading, lookups, quality, recommend, similarity, text  # noqa: F401
from opinara.plans.registry import callables, oracles

__all__ = ["callables", "oracles"]
