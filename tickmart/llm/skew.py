"""Hot keys: keys with very many rows are dealt into parts, so that no join or sort meets all of them in one task.

A key is hot with more rows than threshold(), so there are never more than MOST_HOT hot keys: the table that says into how
many parts each goes has a proven bound, and is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_HOT = 100_000
#: The rows of one key that a task may have: of rows with sets or bitmaps, and of thin ones, a few numbers each.
MOST_ROWS = 4096
MOST_THIN_ROWS = 1 << 18


def threshold(n: int, thin: bool = False) -> int:
    """The most rows of one key that n rows may have before it is hot."""
    return max(MOST_THIN_ROWS if thin else MOST_ROWS, -(-n // MOST_HOT))


def hot_keys(rows: DataFrame, keys: list[str], n: int, thin: bool = False) -> DataFrame | None:
    """(keys, parts) of the hot keys of rows, of which there are n; None if they are too few for one."""
    most = threshold(n, thin)
    if n <= most:
        return None
    many = rows.groupBy(*keys).agg(F.count("*").alias("parts")).where(F.col("parts") > most)
    return F.broadcast(many.withColumn("parts", F.ceil(F.col("parts") / most).cast("int")))


def dealt(rows: DataFrame, hot: DataFrame | None, keys: list[str], *by: Column | str) -> DataFrame:
    """rows with part: 0 but for hot keys, whose rows are dealt by a hash of ``by``."""
    if hot is None:
        return rows.withColumn("part", F.lit(0))
    return rows.join(hot, keys, "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64(*by), F.col("parts")), F.lit(0)).cast("int")).drop("parts")


def copied(rows: DataFrame, hot: DataFrame | None, keys: list[str]) -> DataFrame:
    """rows with part: each once for every part of its key, to be joined with what dealt() gives."""
    if hot is None:
        return rows.withColumn("part", F.lit(0))
    return rows.join(hot, keys, "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1))).drop("parts")
