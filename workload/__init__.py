"""The registered queries: the engine's operators on the given tables, each with its oracle."""

from workload.registry import ORACLES, QUERIES
from workload import (  # noqa: F401  (registered on import)
    cleaning_queries, profile_queries, quality_queries, star_queries, storage_queries,
)

__all__ = ["ORACLES", "QUERIES"]
