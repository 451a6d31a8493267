"""Parameterised queries behind dashboards. Windows are closed ranges of bucket epochs; None leaves an end open."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .kpi import deviation, valid_prices
from .marts import symbol_deviation_bucket
from .stretches import gaps

BANDS = ("0-50%", "50-75%", "75-90%", "90-100%")


def in_window(df: DataFrame, run_id: str | None = None, start: int | None = None, end: int | None = None, symbol: str | None = None) -> DataFrame:
    for column, value, test in (("run_id", run_id, "eq"), ("symbol", symbol, "eq"), ("bucket_epoch_s", start, "ge"), ("bucket_epoch_s", end, "le")):
        if value is not None:
            df = df.where({"eq": F.col(column) == value, "ge": F.col(column) >= value, "le": F.col(column) <= value}[test])
    return df


def runs(cleansed: DataFrame) -> DataFrame:
    """Runs with their window and rows, newest first."""
    return cleansed.groupBy("run_id").agg(F.min("bucket_start_utc").alias("min_bucket_start_utc"), F.max("bucket_start_utc").alias("max_bucket_start_utc"), F.count("*").alias("row_count")).orderBy(F.desc("run_id"))


def run_range(cleansed: DataFrame, run_id: str) -> DataFrame:
    """One row: the run's first and last bucket, its rows, and how many are valid."""
    valid = F.col("price").isNotNull() & (F.col("is_missing") == 0) & (F.col("is_stale") == 0)
    return in_window(cleansed, run_id).agg(F.min("bucket_start_utc").alias("min_bucket_start_utc"), F.max("bucket_start_utc").alias("max_bucket_start_utc"), F.count("*").alias("row_count"), F.count_if(valid).alias("valid_row_count"))


def symbols_in(cleansed: DataFrame, run_id: str, start: int | None = None, end: int | None = None) -> DataFrame:
    return valid_prices(in_window(cleansed, run_id, start, end)).select("symbol").distinct().orderBy("symbol")


def price_curve(cleansed: DataFrame, run_id: str, symbol: str | None = None, start: int | None = None, end: int | None = None) -> DataFrame:
    """Valid prices of one symbol, or all, at every exchange, in time order."""
    rows = valid_prices(in_window(cleansed, run_id, start, end, symbol))
    return rows.select("run_id", "exchange_id", "symbol", "bucket_start_utc", "bucket_epoch_s", F.round("price", 12).alias("price_close")).orderBy("symbol", "bucket_epoch_s", "exchange_id")


def deviation_series(cleansed: DataFrame, run_id: str, symbol: str, start: int | None = None, end: int | None = None) -> DataFrame:
    return symbol_deviation_bucket(in_window(cleansed, run_id, start, end, symbol)).orderBy("bucket_epoch_s")


def spread_points(cleansed: DataFrame, run_id: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """Spread in percent of each symbol and bucket."""
    rows = valid_prices(in_window(cleansed, run_id, start, end)).where("symbol is not null")
    low = F.min("price")
    wide = rows.groupBy("run_id", "symbol", "bucket_start_utc", "bucket_epoch_s").agg(F.count("*").alias("exchange_count"), F.round(F.when(low > 0, (F.max("price") - low) / low * 100.0), 9).alias("price_diff_pct"))
    return wide.where("exchange_count >= 2 and price_diff_pct is not null").orderBy("symbol", "bucket_epoch_s")


def observed_coverage(base: DataFrame, run_id: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """Observed points of each pair against the symbol's best exchange, and the band that the share falls in."""
    points = in_window(base, run_id, start, end).groupBy("symbol", "exchange_id").agg(F.count("*").alias("total_points"), F.sum("observed_flag").alias("observed_points"))
    most = F.max("observed_points").over(W.partitionBy("symbol"))
    share = F.when(F.col("max_observed_points_for_symbol") > 0, 100.0 * F.col("observed_points") / F.col("max_observed_points_for_symbol")).otherwise(0.0)
    order = F.when(share < 50, 0).when(share < 75, 1).when(share < 90, 2).otherwise(3)
    wide = points.withColumn("max_observed_points_for_symbol", most)
    return wide.select("*", F.round(share, 4).alias("observed_vs_max_pct"), F.element_at(F.array(*map(F.lit, BANDS)), order + 1).alias("observed_quality_band"), order.alias("band_order"))


def eligible_symbols(coverage: DataFrame, bands: list[str]) -> DataFrame:
    """Symbols with more than one exchange in the bands. Apply with a left semi join."""
    return coverage.where(F.col("observed_quality_band").isin(bands)).groupBy("symbol").agg(F.countDistinct("exchange_id").alias("exchanges")).where("exchanges > 1").select("symbol")


def _complete(curve: DataFrame, *more: str) -> DataFrame:
    return curve.dropna(subset=["bucket_start_utc", "bucket_epoch_s", "price_close", "exchange_id", *more]).withColumnRenamed("price_close", "price")


def deviation_from_curve(curve: DataFrame) -> DataFrame:
    """Spread of each bucket of one symbol's curve, counting distinct exchanges."""
    wide = deviation(_complete(curve), ["bucket_start_utc", "bucket_epoch_s"], F.countDistinct("exchange_id"))
    return wide.where("price_diff_pct is not null").drop("max_price_exchange_id", "min_price_exchange_id").orderBy("bucket_epoch_s")


def spread_from_curve(curve: DataFrame) -> DataFrame:
    """Spread in percent of each symbol and bucket of curves, counting distinct exchanges."""
    wide = deviation(_complete(curve, "symbol"), ["symbol", "bucket_start_utc", "bucket_epoch_s"], F.countDistinct("exchange_id"))
    return wide.where("price_diff_pct is not null").select("symbol", "bucket_start_utc", "bucket_epoch_s", "exchange_count", "price_diff_pct").orderBy("symbol", "bucket_epoch_s")


def symbol_spread_stats(points: DataFrame) -> DataFrame:
    """Points, mean and largest spread of each symbol, ranked by the largest. There are as many rows as symbols."""
    stats = points.groupBy("symbol").agg(F.count("*").alias("points"), F.round(F.avg("price_diff_pct"), 6).alias("avg_price_diff_pct"), F.max("price_diff_pct").alias("max_price_diff_pct"))
    return stats.withColumn("spread_rank", F.row_number().over(W.orderBy(F.desc("max_price_diff_pct"), "symbol")))


def bucket_step(curve: DataFrame) -> DataFrame:
    """(start, end): the curve's first bucket, and its last one moved on by the median step, 60 seconds if there is none."""
    step = gaps(curve).agg(F.median("gap").alias("step"))
    ends = curve.agg(F.min("bucket_epoch_s").alias("start"), F.max("bucket_epoch_s").alias("last"))
    return ends.crossJoin(step).select("start", (F.col("last") + F.coalesce("step", F.lit(60.0))).alias("end"))  # of one row each


def raw_overlay(ticks: DataFrame, curve: DataFrame, symbol: str) -> DataFrame:
    """Raw ticks of a symbol at the curve's exchanges, from its first bucket to a step past its last."""
    own = curve.where(F.col("symbol") == symbol)
    window = F.broadcast(bucket_step(own))  # one row
    rows = ticks.where((F.col("symbol") == symbol) & F.col("price").isNotNull()).join(own.select("exchange_id").distinct(), "exchange_id", "left_semi")
    inside = rows.join(window, (F.col("ts_us") >= F.col("start") * 1_000_000) & (F.col("ts_us") <= F.col("end") * 1_000_000))
    return inside.select("ts_us", "exchange_id", F.col("price").alias("price_close"), F.concat("exchange_id", F.lit("_raw")).alias("series_name"))


def exchange_point_counts(curve: DataFrame) -> DataFrame:
    return curve.groupBy("exchange_id").agg(F.count("*").alias("points")).orderBy(F.desc("points"), "exchange_id")


def deviation_summary(series: DataFrame) -> DataFrame:
    """One row: largest and mean spread, points, and the bucket and pair of the largest absolute spread."""
    peak = F.min_by(F.struct("bucket_start_utc", "max_diff_exchange_pair"), F.struct(-F.col("price_diff_abs"), "bucket_epoch_s"))
    one = series.agg(F.max("price_diff_pct").alias("max_price_diff_pct"), F.max("price_diff_abs").alias("max_price_diff_abs"), F.round(F.avg("price_diff_pct"), 6).alias("avg_price_diff_pct"), F.count("*").alias("compared_points"), peak.alias("peak"))
    return one.select("max_price_diff_pct", "max_price_diff_abs", "avg_price_diff_pct", "compared_points", F.col("peak.bucket_start_utc").alias("peak_bucket_start_utc"), F.col("peak.max_diff_exchange_pair").alias("peak_exchange_pair"))


def forecast_configs(predictions: DataFrame, run_id: str, symbol: str) -> DataFrame:
    """Configurations that have forecasts of a symbol in a run, with counts, mean error and range."""
    rows = predictions.where((F.col("cleansing_run_id") == run_id) & (F.col("symbol") == symbol))
    return rows.groupBy("training_run_id", "exchange_id", "symbol", "model_name", "horizon_seconds").agg(
        F.count("*").alias("prediction_count"), F.count("actual_price").alias("actual_count"), F.round(F.avg("abs_error"), 6).alias("mean_abs_error"), F.min("target_bucket_epoch_s").alias("min_target_bucket_epoch_s"), F.max("target_bucket_epoch_s").alias("max_target_bucket_epoch_s")
    ).orderBy(F.desc("training_run_id"), "exchange_id", "model_name", "horizon_seconds")


def forecast_series(predictions: DataFrame, key: dict[str, object]) -> DataFrame:
    """Forecasts of one configuration, by target time."""
    for column, value in key.items():
        predictions = predictions.where(F.col(column) == value)
    return predictions.orderBy("target_bucket_epoch_s", "generated_bucket_epoch_s")


def registry_row(registry: DataFrame, key: dict[str, object]) -> DataFrame:
    """The latest trained registry row of a configuration, or none."""
    for column, value in key.items():
        registry = registry.where(F.col(column) == value)
    return registry.where("status = 'trained'").orderBy(F.desc("created_utc")).limit(1)
