"""Bounded extracts of the vault for later stages."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.filters import filter_exchanges, filter_symbols
from .manifest import FOLDERS


def bounds(window: DataFrame) -> tuple[int, int] | None:
    """(start_s, end_s) of the window's one row; None if it has none, as that of an empty vault."""
    row = window.first()
    return None if row is None or row["end_s"] is None else (row["start_s"], row["end_s"])


def _folder(second: int) -> tuple[str, str]:
    at = datetime.datetime.fromtimestamp(second, datetime.UTC)
    return at.strftime("%Y-%m-%d"), at.strftime("%H")


def _extract(vault: DataFrame, window: DataFrame, partitions: DataFrame | None, layer: str, exchanges: str | None, symbols: str | None) -> DataFrame:
    """Rows in the window and scope, with provenance. The window's two numbers are fetched first, so that layer, exchange
    and hours pick folders and the rest is pushed into their files."""
    rows = vault.select("*", F.col("_metadata.file_path").alias("source_path"))
    found = bounds(window)
    if found is None:
        return with_provenance(rows.where("false"))
    (first_day, first_hour), (last_day, last_hour) = map(_folder, found)
    day, hour = F.col("date"), F.col("hour")
    rows = filter_exchanges(rows.where(F.col("layer") == layer), exchanges, defaults=(), column="exchange")
    rows = rows.where((day >= first_day) & (day <= last_day) & ((day > first_day) | (hour >= first_hour)) & ((day < last_day) | (hour <= last_hour)))
    rows = rows.where(F.col("epoch_s").between(*found))
    rows = filter_symbols(rows, symbols) if symbols else rows
    return with_provenance(rows if partitions is None else rows.join(partitions.select("partition_id"), "partition_id", "left_semi"))


def extract_ticks(vault: DataFrame, window: DataFrame, partitions: DataFrame | None = None, layer: str = "raw", exchanges: str | None = None, symbols: str | None = None) -> DataFrame:
    """Ticks of a vault (of sources.staging.read_vault()) in the window (start_s, end_s; one row, both ends included) and,
    if given, in the partitions, with provenance. An empty window gives no rows."""
    return _extract(vault, window, partitions, layer, exchanges, symbols)


def extract_events(vault: DataFrame, window: DataFrame, partitions: DataFrame | None = None, layer: str = "raw", exchanges: str | None = None, include: bool = True) -> DataFrame:
    """Connection events likewise; none if include is false."""
    found = _extract(vault, window, partitions, layer, exchanges, None)
    return found if include else found.where("false")


def with_provenance(rows: DataFrame) -> DataFrame:
    """rows (partition_id, id, source_path, ...) with source_partition_id, source_path (the file) and source_row_id."""
    return rows.withColumn("source_row_id", F.col("id")).withColumnRenamed("partition_id", "source_partition_id").drop(*FOLDERS)


def staging_run_metadata(ticks: DataFrame, events: DataFrame, partitions: DataFrame, window: DataFrame, run_id: str) -> DataFrame:
    """One row: the window and what was extracted."""
    counts = [df.agg(F.count("*").alias(n)) for df, n in ((ticks, "tick_rows"), (events, "event_rows"), (partitions, "partitions"))]
    return window.crossJoin(counts[0]).crossJoin(counts[1]).crossJoin(counts[2]).select(F.lit(run_id).alias("run_id"), "*")  # of one row each
