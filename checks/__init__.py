"""Queries over the given tables and the SQL that must agree with them."""

from . import feature_checks, forecast_checks, history_checks, raw_checks, stored_checks, tree_checks  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
