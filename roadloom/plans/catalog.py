"""All registered traffic queries."""

from roadloom.plans import queries_clean, queries_speed  # noqa: F401
from roadloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
