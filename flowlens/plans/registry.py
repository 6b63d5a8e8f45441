"""All named queries; importing the modules registers them."""

from flowlens.plans import data_queries, drift_queries, flow_queries, learning_queries, model_queries, stream_queries  # noqa: F401
from flowlens.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
