"""Query plans over the shared test tables: domain views, and the registry of queries with
their DuckDB oracles."""

from . import q_core, q_forecast, q_fraud, q_labels, q_recsys, q_stream, q_text  # noqa: F401  (register queries)
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
