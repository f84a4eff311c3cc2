"""Importing this module registers every query."""

from millrace.plans import q_changes, q_functions, q_joins, q_quality, q_rows, q_sources, q_streams, q_windows
from millrace.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
