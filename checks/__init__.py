"""Registered queries and their SQL oracles."""

from checks import (  # noqa: F401
    queries_dataset,
    queries_features,
    queries_modeling,
    queries_reports,
    queries_scoring,
)
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
