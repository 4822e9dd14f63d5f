"""Registered queries: each operator on the stand-in tables, with its SQL twin."""

from pricelab.plans import (  # noqa: F401
    blends, features, fitted, jobs, lines, measures, profiles, ranking, scans, tables,
)
from pricelab.plans.registry import oracle_sql, queries

__all__ = ["queries", "oracle_sql"]
