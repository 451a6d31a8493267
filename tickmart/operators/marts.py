"""Marts: platform quality scores and ranks, deviation ranks, spread by bucket, curves, and their caches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scores import CAPS, capped_score, minmax_score, weighted
from ..functions.timing import DAY_S, GRAINS
from .kpi import deviation, valid_prices


def symbol_coverage(ex_sym_kpi: DataFrame, grain: str) -> DataFrame:
    return ex_sym_kpi.groupBy(GRAINS[grain], "exchange_id").agg(F.countDistinct("symbol").alias("symbols_covered"))


def quality_score(kpi: DataFrame, grain: str) -> DataFrame:
    """kpi with default_quality_score: capped scores, and places within each period."""
    period = W.partitionBy(GRAINS[grain])
    scores = {c: capped_score(F.col(c), cap) for c, cap in CAPS.items()} | {c: minmax_score(F.col(c), F.min(c).over(period), F.max(c).over(period)) for c in ("update_frequency_hz", "symbols_covered")}
    return kpi.withColumn("default_quality_score", weighted(scores))


def platform_quality(ex_kpi: DataFrame, ex_sym_kpi: DataFrame, grain: str) -> DataFrame:
    """Every period and exchange with its KPIs, score and rank (1 is best). Equal scores go by latency, then disconnects."""
    base = ex_kpi.join(symbol_coverage(ex_sym_kpi, grain), [GRAINS[grain], "exchange_id"], "left").fillna(0, ["symbols_covered", "disconnect_count"])
    far = lambda c: F.coalesce(F.col(c), F.lit(1e12))
    best_first = W.partitionBy(GRAINS[grain]).orderBy(F.desc("default_quality_score"), far("avg_latency_ms"), far("max_latency_ms"), "disconnect_count", far("min_latency_ms"), "exchange_id")
    return quality_score(base, grain).withColumn("default_quality_rank", F.dense_rank().over(best_first))


def rank_price_deviation(kpi: DataFrame, grain: str) -> DataFrame:
    """kpi with default_deviation_rank: the widest spread of each period first."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0)).desc()
    return kpi.withColumn("default_deviation_rank", F.dense_rank().over(W.partitionBy(GRAINS[grain]).orderBy(zero("max_price_diff_pct"), zero("max_price_diff_abs"), "symbol")))


def symbol_deviation_bucket(cleansed: DataFrame) -> DataFrame:
    """Spread over exchanges for each run, symbol and bucket, where it has a percentage."""
    rows = valid_prices(cleansed).where("run_id is not null and symbol is not null")
    wide = deviation(rows, ["run_id", "symbol", "bucket_start_utc", "bucket_epoch_s"], F.count("*"))
    return wide.where("price_diff_pct is not null").withColumnsRenamed({"max_price": "max_price_close", "min_price": "min_price_close"})


def observed_quality_base(cleansed: DataFrame) -> DataFrame:
    """Valid rows with a mark for those observed rather than filled."""
    rows = valid_prices(cleansed).dropna(subset=["run_id", "symbol", "exchange_id", "bucket_start_utc", "bucket_epoch_s"])
    return rows.select("run_id", "symbol", "exchange_id", "bucket_start_utc", "bucket_epoch_s", (F.col("fill_method") == "observed").cast("int").alias("observed_flag"))


def latest_run(cleansed: DataFrame) -> DataFrame:
    """(latest_run_id): one row, or none without runs."""
    return cleansed.agg(F.max("run_id").alias("latest_run_id")).where("latest_run_id is not null")


def price_curve_24h(cleansed: DataFrame, exchange: str = "binance") -> DataFrame:
    """Each symbol's last day of its latest run at one exchange, numbered in time order."""
    rows = valid_prices(cleansed).where((F.col("exchange_id") == exchange) & F.col("run_id").isNotNull())
    symbol = W.partitionBy("symbol")
    newest = rows.withColumn("_run", F.max("run_id").over(symbol)).where("run_id = _run")
    recent = newest.withColumn("_last", F.max("bucket_epoch_s").over(symbol)).where(F.col("_last") - F.col("bucket_epoch_s") <= DAY_S)
    return recent.select("run_id", "exchange_id", "symbol", "bucket_start_utc", "bucket_epoch_s", F.round("price", 12).alias("price_close"), F.row_number().over(symbol.orderBy("bucket_epoch_s")).alias("point_index_asc"))


def latest_period(df: DataFrame, period_col: str) -> DataFrame:
    """Rows of the last period."""
    return df.join(F.broadcast(df.agg(F.max(period_col).alias(period_col))), period_col)  # one row


def cache_tables(cleansed: DataFrame, quality_daily: DataFrame, deviation_daily: DataFrame, exchange: str = "binance") -> dict[str, DataFrame]:
    """The five tables that dashboards read: latest quality and deviation, last day's curves, spread buckets, symbols."""
    quality, ranked = latest_period(quality_daily, "kpi_date_utc"), latest_period(deviation_daily, "kpi_date_utc")
    curve, buckets = price_curve_24h(cleansed, exchange).drop("bucket_epoch_s"), symbol_deviation_bucket(cleansed)
    quality = quality.drop("latency_sample_count", "interval_count", "avg_update_interval_s", "min_update_interval_s", "max_update_interval_s")
    symbols = curve.select("symbol").union(ranked.select("symbol")).union(buckets.select("symbol")).distinct().where("symbol is not null")
    return {"platform_quality_daily_latest": quality, "price_deviation_daily_latest": ranked, "price_curve_24h_latest": curve, "symbol_deviation_bucket": buckets, "symbols": symbols}


def build_caches(tables: dict[str, DataFrame], path: str) -> dict[str, DataFrame]:
    """Write each table below path, in place of an older one, and read them from there."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    return {name: df.sparkSession.read.schema(df.schema).parquet(f"{path}/{name}") for name, df in tables.items()}


def cache_metadata(caches: dict[str, DataFrame]) -> DataFrame:
    """(cache, row_count) of every cache table."""
    out: DataFrame | None = None
    for name, df in sorted(caches.items()):
        one = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("cache"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


#: Quality bands: name, least score, and the score below which it ends (the highest holds 1 as well).
BANDS = (("high", 0.75, 1.0), ("medium", 0.5, 0.75), ("low", 0.0, 0.5))


def with_quality_band(quality: DataFrame) -> DataFrame:
    """quality with quality_band_key, the band of its default_quality_score; null for no score."""
    score, key = F.col("default_quality_score"), F.lit(None).cast("string")
    for name, low, _ in reversed(BANDS):
        key = F.when(score >= low, name).otherwise(key)
    return quality.withColumn("quality_band_key", key)


def dimensions(quality: DataFrame, ranked: DataFrame) -> dict[str, DataFrame]:
    """Date, exchange, symbol and quality-band dimensions of the daily quality and deviation facts."""
    days = quality.select("kpi_date_utc").union(ranked.select("kpi_date_utc")).distinct()
    part = lambda i: F.split_part("kpi_date_utc", F.lit("-"), F.lit(i)).cast("int")
    side = lambda i: F.split_part("symbol", F.lit("/"), F.lit(i))
    spark = quality.sparkSession
    return {
        "date": days.select(F.col("kpi_date_utc").alias("date_key"), part(1).alias("year_num"), part(2).alias("month_num"), part(3).alias("day_num")),
        "exchange": quality.select(F.col("exchange_id").alias("exchange_key"), "exchange_id", F.lit("exchange").alias("platform_type")).distinct(),
        "symbol": ranked.select(F.col("symbol").alias("symbol_key"), "symbol", side(1).alias("base_asset"), side(2).alias("quote_asset")).distinct(),
        "quality_band": spark.createDataFrame([(name, name, f"{low:g}-{high:g}") for name, low, high in BANDS], "quality_band_key string, quality_band_name string, score_interval string"),
    }
