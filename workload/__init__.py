"""Queries that exercise the package on the driver tables, each paired with independent SQL."""

from workload import (  # noqa: F401
    column_queries,
    load_queries,
    operator_queries,
    reports,
    source_queries,
    table_queries,
)
from workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
