"""Scores between 0 and 1 for platform quality."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Caps at which a score reaches 0, and the weights of the parts.
CAPS = {"min_latency_ms": 1000.0, "avg_latency_ms": 10000.0, "max_latency_ms": 600000.0, "disconnect_count": 10.0}
WEIGHTS = {"min_latency_ms": 0.15, "avg_latency_ms": 0.35, "max_latency_ms": 0.30, "update_frequency_hz": 0.10, "disconnect_count": 0.08, "symbols_covered": 0.02}


def capped_score(value: Column, cap: float) -> Column:
    """1 at 0 or less, falling to 0 at the cap; 0 for null."""
    return F.when(value.isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - value / cap)))


def minmax_score(value: Column, low: Column, high: Column) -> Column:
    """The place of value between low and high; 1 where they are equal, 0 for null."""
    return F.when(value.isNull(), 0.0).when(low == high, 1.0).otherwise((value - low) / (high - low))


def weighted(scores: dict[str, Column], weights: dict[str, float] = WEIGHTS) -> Column:
    """The weighted sum, added in the order of weights, to 6 digits, halves up."""
    total = None
    for name, weight in weights.items():
        part = scores[name] * weight
        total = part if total is None else total + part
    return F.floor(total * 1e6 + 0.5) / 1e6
