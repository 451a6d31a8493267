"""Price rules of a tick."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def effective_price() -> Column:
    return F.coalesce("price", "last")


def training_price() -> Column:
    return F.coalesce(F.col("price"), F.col("last"), (F.col("bid") + F.col("ask")) / 2.0)
