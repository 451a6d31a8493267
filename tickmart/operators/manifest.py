"""The manifest of hourly partitions: what each holds, merged as data arrives, and pruned by window and pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.filters import filter_exchanges, filter_symbols
from ..functions.timing import HOUR_S, SECOND_US, day_key

REGISTRY_KEYS = ("partition_id", "layer", "exchange_id")
PAIR_KEYS = ("partition_id", "exchange_id", "symbol", "asset_norm")


#: The folders of the vault, outermost first.
FOLDERS = ("layer", "exchange", "date", "hour")


def hour_of_day(us: Column) -> Column:
    return F.lpad(F.pmod(F.floor(us / (HOUR_S * SECOND_US)), F.lit(24)).cast("string"), 2, "0")


def with_partition(rows: DataFrame, layer: str = "raw") -> DataFrame:
    """rows (ts_us, exchange_id, ...) with layer, exchange, date and hour, and partition_id layer:exchange:YYYYMMDD_HH."""
    us = F.col("ts_us")
    placed = rows.withColumn("layer", F.lit(layer)).withColumn("exchange", F.lower("exchange_id")).withColumn("date", day_key(us)).withColumn("hour", hour_of_day(us))
    return placed.withColumn("partition_id", F.concat_ws(":", "layer", "exchange", F.concat_ws("_", F.replace("date", F.lit("-"), F.lit("")), "hour")))


def _stats() -> list[Column]:
    return [F.min("epoch_s").alias("ts_min_epoch_s"), F.max("epoch_s").alias("ts_max_epoch_s"), F.count("*").alias("row_count")]


def partition_registry(ticks: DataFrame, events: DataFrame, layer: str = "raw") -> DataFrame:
    """First and last second and rows of each partition, over ticks and events."""
    slim = [with_partition(df, layer).select("partition_id", "layer", F.col("exchange").alias("exchange_id"), "epoch_s") for df in (ticks, events)]
    return slim[0].unionByName(slim[1]).groupBy(*REGISTRY_KEYS).agg(*_stats())


def partition_pairs(ticks: DataFrame, events: DataFrame, layer: str = "raw") -> DataFrame:
    """As partition_registry(), for each symbol in a partition; events without symbol have no pair."""
    slim = [with_partition(df, layer).where(F.coalesce("symbol", F.lit("")) != "").select("partition_id", F.col("exchange").alias("exchange_id"), F.lower("symbol").alias("symbol"), "asset_norm", "epoch_s") for df in (ticks, events)]
    return slim[0].unionByName(slim[1]).groupBy(*PAIR_KEYS).agg(*_stats())


def merge_manifest(old: DataFrame, delta: DataFrame, keys: tuple[str, ...] = REGISTRY_KEYS) -> DataFrame:
    """One row for each key: the least start, the greatest end, the sum of rows."""
    return old.unionByName(delta).groupBy(*keys).agg(F.min("ts_min_epoch_s").alias("ts_min_epoch_s"), F.max("ts_max_epoch_s").alias("ts_max_epoch_s"), F.sum("row_count").alias("row_count"))


def _scoped(registry: DataFrame, pairs: DataFrame, layer: str | None, exchanges: str | None, symbols: str | None, assets: str | None) -> tuple[DataFrame, DataFrame]:
    if layer is not None:
        registry = registry.where(F.col("layer") == layer)
    pairs = filter_symbols(filter_exchanges(pairs, exchanges, defaults=()), symbols)
    if assets is not None:
        pairs = pairs.where(F.col("asset_norm").isin([a.strip().lower() for a in assets.split(",")]))
    return filter_exchanges(registry, exchanges, defaults=()), pairs


def source_max_epoch(registry: DataFrame, pairs: DataFrame, layer: str | None = None, exchanges: str | None = None, symbols: str | None = None, assets: str | None = None) -> DataFrame:
    """(max_epoch_s): one row, the last second of the pairs in scope."""
    registry, pairs = _scoped(registry, pairs, layer, exchanges, symbols, assets)
    return pairs.join(registry.select("partition_id").distinct(), "partition_id", "left_semi").agg(F.max("ts_max_epoch_s").alias("max_epoch_s"))


def relative_window(maximum: DataFrame, hours: float, offset_h: float = 0) -> DataFrame:
    """(start_s, end_s): one row, a window of so many hours that ends offset_h before the maximum; both ends belong to it."""
    end = F.col("max_epoch_s") - int(offset_h * HOUR_S)
    return maximum.select((end - int(hours * HOUR_S)).alias("start_s"), end.alias("end_s"))


def prune_partitions(registry: DataFrame, pairs: DataFrame, window: DataFrame, layer: str | None = None, exchanges: str | None = None, symbols: str | None = None, assets: str | None = None) -> DataFrame:
    """The partitions that overlap the window (one row) and hold a pair in scope that does."""
    registry, pairs = _scoped(registry, pairs, layer, exchanges, symbols, assets)
    overlaps = (F.col("ts_max_epoch_s") >= F.col("start_s")) & (F.col("ts_min_epoch_s") <= F.col("end_s"))
    one = F.broadcast(window)  # one row
    near = pairs.join(one, overlaps).select("partition_id").distinct()
    return registry.join(one, overlaps).drop("start_s", "end_s").join(near, "partition_id", "left_semi")


def list_scope(registry: DataFrame, pairs: DataFrame, window: DataFrame, **filters: str | None) -> DataFrame:
    """The window, and how many partitions and rows it selects; nothing is copied."""
    picked = prune_partitions(registry, pairs, window, **filters)
    return window.crossJoin(picked.agg(F.count("*").alias("partitions"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows")))  # of one row each
