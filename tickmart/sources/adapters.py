"""Ticks, connection events, envelopes and cleansed prices derived from the star-schema tables.

All rules are deterministic in event_id and user_id, so the same rows can be written in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timing import epoch_s, iso_seconds, wall_us

EXCHANGES = ("binance", "kraken", "coinbase", "okx", "bybit")
SYMBOLS = {"view": "BTC/USDT", "click": "ETH/USDT", "purchase": "SOL/USDT", "signup": "ADA/USDT"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _exchange() -> F.Column:
    return F.element_at(F.array(*map(F.lit, EXCHANGES)), (F.pmod(F.col("user_id"), F.lit(5)) + 1).cast("int"))


def _symbol() -> F.Column:
    symbol = F.lit(None).cast("string")
    for kind, name in SYMBOLS.items():
        symbol = F.when(F.col("event_type") == kind, name).otherwise(symbol)
    return symbol


def market_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events but errors, as ticks."""
    e, value = table(spark, sf_dir, "events").where("event_type <> 'error'"), F.col("value")
    every = lambda n: F.col("event_id") % n == 0
    us, k = wall_us(F.col("ts")), F.get_json_object("props", "$.k").cast("double")
    exch = F.when(every(89), F.lit(None)).when(every(83), us + 250_000).otherwise(us - (F.col("event_id") * 37) % 1500 * 1000)
    symbol = _symbol()
    return e.select(
        F.col("event_id").alias("id"), us.alias("ts_us"), epoch_s(us).alias("epoch_s"), _exchange().alias("exchange_id"), symbol.alias("symbol"),
        F.lower(symbol).alias("symbol_norm"), F.lower(F.split_part(symbol, F.lit("/"), F.lit(1))).alias("asset_norm"),
        F.when(every(97), F.lit(None)).when(every(101), -value).otherwise(value).alias("price"), F.when(every(103), value * 1.001).otherwise(value * 0.999).alias("bid"),
        F.when(every(103), value * 0.999).otherwise(value * 1.001).alias("ask"), F.when(~every(194), value).alias("last"), k.alias("base_volume"), (k * value).alias("quote_volume"),
        exch.alias("exch_us"), F.col("props").alias("raw_json"),
    )


def connection_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors in events, as disconnects and reconnects."""
    us = wall_us(F.col("ts"))
    return table(spark, sf_dir, "events").where("event_type = 'error'").select(
        F.col("event_id").alias("id"), us.alias("ts_us"), epoch_s(us).alias("epoch_s"), _exchange().alias("exchange_id"), F.lit(None).cast("string").alias("symbol"), F.lit(None).cast("string").alias("symbol_norm"), F.lit(None).cast("string").alias("asset_norm"),
        F.when(F.col("event_id") % 3 == 2, "reconnected").otherwise("disconnect").alias("event_type"), F.col("props").alias("details_json"),
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream messages (stream_id, event_json) made of events; one in 7 comes twice, one in 50 is damaged in some way."""
    e = table(spark, sf_dir, "events")
    i, us = F.col("event_id"), wall_us(F.col("ts"))
    ms, tick = F.floor(us / 1000), F.col("event_type") != "error"
    symbol = F.coalesce(_symbol(), F.lit(""))
    payload = F.when(tick, F.struct(F.col("value").alias("price"), F.col("value").alias("last"), (ms - 5).alias("exchange_ts_ms"), F.col("props").alias("raw_json"), F.lit(None).cast("string").alias("event_name"))).otherwise(
        F.struct(F.lit(None).cast("double").alias("price"), F.lit(None).cast("double").alias("last"), F.lit(None).cast("long").alias("exchange_ts_ms"), F.lit(None).cast("string").alias("raw_json"), F.when(i % 2 == 0, "disconnect").alias("event_name"))
    )
    kind = F.when(i % 50 == 1, "trade").when(tick, "tick").otherwise("connection_event")
    json = F.to_json(F.struct(
        i.cast("string").alias("event_id"), kind.alias("event_type"), F.lit("1").alias("schema_version"), F.when(i % 50 == 2, " ").otherwise(F.concat(F.lit(" "), F.upper(_exchange()))).alias("exchange_id"), symbol.alias("symbol"), F.lower(symbol).alias("symbol_norm"), F.lit("").alias("asset_norm"),
        ms.alias("event_ts_ms"), (ms + 20).alias("ingestion_ts_ms"), F.when(i % 50 == 3, "").otherwise(F.concat(F.lit("key-"), i)).alias("dedup_key"), payload.alias("payload"),
    ))
    json = F.when(i % 50 == 4, "[1]").when(i % 50 == 5, "{not json").when(i % 50 == 6, F.replace(json, F.lit('"schema_version"'), F.lit('"other"'))).otherwise(json)
    once = e.select((i * 2).alias("stream_id"), json.alias("event_json"))
    return once.unionByName(e.where(i % 7 == 0).select((i * 2 + 1).alias("stream_id"), json.alias("event_json")))


def lineitem_cleansed(spark: SparkSession, sf_dir: str, run_id: str = "lineitem") -> DataFrame:
    """Cleansed daily prices of many symbols: of each exchange, symbol and day the last lineitem's price."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("ex"), F.col("l_suppkey") % 8).alias("exchange_id"), F.concat(F.lit("S"), F.col("l_partkey") % 20, F.lit("/USD")).alias("symbol"), F.col("l_shipdate").cast("date").alias("day"),
        F.struct("l_orderkey", "l_linenumber").alias("place"), (F.col("l_extendedprice") / F.col("l_quantity")).cast("double").alias("price"))
    last = rows.groupBy("exchange_id", "symbol", "day").agg(F.max_by("price", "place").alias("price"))
    epoch = F.unix_date("day").cast("long") * 86_400
    return last.select(F.lit(run_id).alias("run_id"), epoch.alias("bucket_epoch_s"), iso_seconds(epoch).alias("bucket_start_utc"), "exchange_id", "symbol", "price", F.lit("observed").alias("fill_method"), F.lit(0).alias("is_stale"), F.lit(0).alias("is_missing"))
