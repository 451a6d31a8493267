"""Registered queries and the pipelines over operators."""

from __future__ import annotations


def load() -> tuple[dict, dict]:
    """(queries, SQL twins) of the warehouse."""
    from . import forecast_queries, market_queries  # noqa: F401
    from .registry import ORACLES, QUERIES

    return QUERIES, ORACLES
