"""All registered queries."""

from marquee.plans import (  # noqa: F401
    queries_features,
    queries_graph,
    queries_io,
    queries_models,
    queries_samples,
    queries_vectors,
)
from marquee.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
