"""Registered queries over the driver's tables, and the SQL they are compared with."""

from catalogue.registry import ENTRIES
from catalogue import (  # noqa: F401  (each registers its queries)
    star_queries, profile_queries, quality_queries, investor_queries, history_queries,
)

__all__ = ["ENTRIES"]
