"""Queries on the driver tables: each operator family registers its
queries (with DuckDB oracle SQL) in ``registry``."""

from featuremart.plans import basics, cleaning, customer, customer_month, features, joins, layers, layers2, layers3, lookups, nodes, nodes_whole, pivots, profiling, quality, sinks, transform, windows  # noqa: F401  (registers queries)
from featuremart.plans.registry import HEADLINE, ORACLES, QUERIES  # noqa: F401
