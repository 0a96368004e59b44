"""Driver queries by survey section; importing the package fills the registry."""

from . import q_activity, q_joins, q_matrix, q_functions, q_network, q_population, q_safety, q_sources, q_summaries, q_transit, q_windows  # noqa: F401
from .registry import QUERIES, Tables, finish_sql, runner

__all__ = ["QUERIES", "Tables", "finish_sql", "runner"]
