"""Core KPIs of ticks (ts_us, exch_us, exchange_id, symbol, id), connection events and cleansed prices, by day and hour."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.timing import GRAINS, SECOND_US, day_key, period_key

PAIR = ("exchange_id", "symbol")


def latency_samples(ticks: DataFrame) -> DataFrame:
    """Ticks with both times whose latency is not negative."""
    latency = F.col("ts_us") - F.col("exch_us")
    return ticks.where(latency >= 0).select(day_key(F.col("ts_us")).alias("kpi_date_utc"), *PAIR, "ts_us", "exch_us", (latency / 1000.0).alias("latency_ms"))


def _mean_us(us: str) -> Column:
    """The mean of whole micros to the nearest whole one, halves up: whole-number arithmetic, whatever the order."""
    return F.expr(f"(2 * sum({us}) + count(*)) div (2 * count(*))")


def _latency(keys: list[Column | str], samples: DataFrame) -> DataFrame:
    us = F.col("ts_us") - F.col("exch_us")
    return samples.groupBy(*keys).agg(
        F.count("*").alias("latency_sample_count"), (_mean_us("ts_us - exch_us") / 1000.0).alias("avg_latency_ms"), F.round(F.min(us) / 1000.0, 3).alias("min_latency_ms"), F.round(F.max(us) / 1000.0, 3).alias("max_latency_ms"))


def latency_kpi(samples: DataFrame, grain: str) -> DataFrame:
    return _latency([period_key(F.col("ts_us"), grain), *PAIR], samples)


def _with_previous(ticks: DataFrame) -> DataFrame:
    """ticks with a time, with prev_us, the time of the pair's tick before it (null for its first).

    No task has all ticks of a pair: one sorts the ticks of a pair and day, and each day's first tick gets the last tick
    before it from a window over days. Ticks of equal times have the same intervals in any order.
    """
    days = ticks.where("ts_us is not null").withColumn("_day", F.floor(F.col("ts_us") / (86_400 * SECOND_US)))
    ends = days.groupBy(*PAIR, "_day").agg(F.max("ts_us").alias("_last"))
    ends = ends.withColumn("_carried", F.lag("_last").over(W.partitionBy(*PAIR).orderBy("_day"))).drop("_last")
    inner = days.withColumn("_lag", F.lag("ts_us").over(W.partitionBy(*PAIR, "_day").orderBy("ts_us", "id"))).join(ends, [*PAIR, "_day"])
    return inner.withColumn("prev_us", F.coalesce("_lag", "_carried")).drop("_day", "_lag", "_carried")


def update_intervals(ticks: DataFrame) -> DataFrame:
    """Positive gaps between successive ticks of a pair; a gap belongs to the later tick's period, however long it is."""
    return _with_previous(ticks).where("ts_us > prev_us").select(day_key(F.col("ts_us")).alias("kpi_date_utc"), *PAIR, "ts_us", "prev_us", ((F.col("ts_us") - F.col("prev_us")) / float(SECOND_US)).alias("update_interval_s"))


def _frequency(keys: list[Column | str], intervals: DataFrame) -> DataFrame:
    us = F.col("ts_us") - F.col("prev_us")
    mean = F.sum(us) / F.count("*") / float(SECOND_US)
    return intervals.groupBy(*keys).agg(
        F.count("*").alias("interval_count"), (_mean_us("ts_us - prev_us") / float(SECOND_US)).alias("avg_update_interval_s"), F.round(F.min(us) / float(SECOND_US), 6).alias("min_update_interval_s"),
        F.round(F.max(us) / float(SECOND_US), 6).alias("max_update_interval_s"), F.round(F.when(mean > 0, 1.0 / mean), 6).alias("update_frequency_hz"))


def update_frequency_kpi(intervals: DataFrame, grain: str) -> DataFrame:
    return _frequency([period_key(F.col("ts_us"), grain), *PAIR], intervals)


def connection_drops(events: DataFrame, grain: str) -> DataFrame:
    return events.where("event_type = 'disconnect' and ts_us is not null").groupBy(period_key(F.col("ts_us"), grain), "exchange_id").agg(F.count("*").alias("disconnect_count"))


def valid_prices(cleansed: DataFrame) -> DataFrame:
    return cleansed.where("price is not null and is_missing = 0 and is_stale = 0")


def deviation(rows: DataFrame, keys: list[str], count: Column) -> DataFrame:
    """Spread of price over exchanges for each key with at least two; ties of extremes go to the first exchange name.

    One aggregation finds the extremes and who has them.
    """
    high, low = F.max("price"), F.min("price")
    wide = rows.groupBy(*keys).agg(
        count.alias("exchange_count"), high.alias("_high"), low.alias("_low"), F.min_by("exchange_id", F.struct(-F.col("price"), "exchange_id")).alias("max_price_exchange_id"), F.min_by("exchange_id", F.struct("price", "exchange_id")).alias("min_price_exchange_id"))
    gap = F.col("_high") - F.col("_low")
    return wide.where("exchange_count >= 2").select(
        *keys, "exchange_count", F.round("_high", 12).alias("max_price"), F.round("_low", 12).alias("min_price"), F.round(gap, 12).alias("price_diff_abs"), F.round(F.when(F.col("_low") > 0, gap / F.col("_low") * 100.0), 9).alias("price_diff_pct"),
        "max_price_exchange_id", "min_price_exchange_id", F.concat_ws("|", "max_price_exchange_id", "min_price_exchange_id").alias("max_diff_exchange_pair"))


def price_deviation_aligned(cleansed: DataFrame, by_run: bool = False) -> DataFrame:
    """Spread for each bucket and symbol. Without by_run, rows of several runs mix and count as if of one."""
    rows = valid_prices(cleansed).where("bucket_start_utc is not null").withColumn("kpi_date_utc", F.substring("bucket_start_utc", 1, 10))
    return deviation(rows, [*(["run_id"] if by_run else []), "kpi_date_utc", "bucket_start_utc", "bucket_epoch_s", "symbol"], F.count("*"))


def price_deviation_kpi(aligned: DataFrame, grain: str) -> DataFrame:
    """Spread for each period and symbol, and where it peaks: the first bucket with the largest difference."""
    key = F.col("kpi_date_utc") if grain == "day" else F.concat(F.substring("bucket_start_utc", 1, 13), F.lit(":00:00Z"))
    peak = F.min_by(F.struct("bucket_start_utc", "max_diff_exchange_pair"), F.struct(-F.col("price_diff_abs"), "bucket_epoch_s"))
    wide = aligned.groupBy(key.alias(GRAINS[grain]), "symbol").agg(
        F.count("*").alias("aligned_points_compared"), F.max("price_diff_abs").alias("max_price_diff_abs"), F.max("price_diff_pct").alias("max_price_diff_pct"), F.round(F.avg("price_diff_abs"), 12).alias("avg_price_diff_abs"), F.round(F.avg("price_diff_pct"), 9).alias("avg_price_diff_pct"), peak.alias("_peak"))
    return wide.select(*wide.columns[:-1], F.col("_peak.bucket_start_utc").alias("max_diff_bucket_start_utc"), F.col("_peak.max_diff_exchange_pair").alias("max_diff_exchange_pair"))


def exchange_symbol_kpi(latency: DataFrame, frequency: DataFrame, drops: DataFrame, grain: str) -> DataFrame:
    """KPIs of each period and pair. An exchange's disconnects repeat on each of its symbols: never add them up."""
    return latency.join(frequency, [GRAINS[grain], *PAIR], "full_outer").join(drops, [GRAINS[grain], "exchange_id"], "left")


def exchange_kpi(samples: DataFrame, intervals: DataFrame, events: DataFrame, grain: str) -> DataFrame:
    """KPIs of each period and exchange, from the samples themselves."""
    keys = [GRAINS[grain], "exchange_id"]
    by = [period_key(F.col("ts_us"), grain), "exchange_id"]
    return _latency(by, samples).join(_frequency(by, intervals), keys, "full_outer").join(connection_drops(events, grain), keys, "full_outer")


def scope_core(ticks: DataFrame, events: DataFrame, cleansed: DataFrame, kpi_date: str | None = None, run_id: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three inputs of one day (all days without a date), and cleansed prices of one run (all without a run)."""
    if kpi_date is not None:
        ticks, events = (df.where(day_key(F.col("ts_us")) == kpi_date) for df in (ticks, events))
        cleansed = cleansed.where(F.col("bucket_start_utc").startswith(kpi_date))
    return ticks, events, cleansed if run_id is None else cleansed.where(F.col("run_id") == run_id)


def require_columns(df: DataFrame, needed: list[str], name: str = "input") -> DataFrame:
    """df, if it has all needed columns; an error before any work is planned otherwise."""
    if missing := [c for c in needed if c not in df.columns]:
        raise ValueError(f"{name} lacks the columns {', '.join(missing)}")
    return df


def core_kpis(ticks: DataFrame, events: DataFrame, cleansed: DataFrame, store: Callable[[dict[str, DataFrame]], dict[str, DataFrame]] = dict, counted: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """All fifteen KPI tables by name. store may write tables, so that those made of them do not start from the sources.

    counted may name tables that are made of another form of their input, with the same rows (as one that counts them).
    """
    own = counted or {}
    out = store({"latency_samples": latency_samples(own.get("latency_samples", ticks)), "update_intervals": update_intervals(ticks), "price_deviation_aligned": price_deviation_aligned(own.get("price_deviation_aligned", cleansed))})
    samples, intervals, aligned = out.values()
    grains = {"day": "daily", "hour": "hourly"}
    first: dict[str, DataFrame] = {}
    for grain, name in grains.items():
        first |= {f"latency_{name}": latency_kpi(samples, grain), f"update_frequency_{name}": update_frequency_kpi(intervals, grain), f"connection_drops_{name}": connection_drops(own.get(f"connection_drops_{name}", events), grain), f"price_deviation_{name}": price_deviation_kpi(aligned, grain)}
    out |= store(first)
    wide: dict[str, DataFrame] = {}
    for grain, name in grains.items():
        wide |= {f"{name}_exchange_symbol": exchange_symbol_kpi(out[f"latency_{name}"], out[f"update_frequency_{name}"], out[f"connection_drops_{name}"], grain), f"{name}_exchange": exchange_kpi(samples, intervals, events, grain)}
    return out | store(wide)


def core_build_metadata(ticks: DataFrame, events: DataFrame, cleansed: DataFrame, kpi_date: str | None = None, run_id: str | None = None) -> DataFrame:
    """One row: input rows, filters and the number of KPI tables."""
    counts = [df.agg(F.count("*").alias(n)) for df, n in ((ticks, "market_tick_rows"), (events, "connection_event_rows"), (cleansed, "cleansed_rows"))]
    one = counts[0].crossJoin(counts[1]).crossJoin(counts[2])  # of one row each
    return one.select(F.lit(kpi_date).cast("string").alias("kpi_date"), F.lit(run_id).cast("string").alias("run_id"), "*", F.lit(15).alias("view_count"))


def metadata_row(spark: SparkSession, ticks: int, events: int, cleansed: int, kpi_date: str | None = None, run_id: str | None = None) -> DataFrame:
    """core_build_metadata() of inputs that were counted otherwise."""
    return spark.createDataFrame([(kpi_date, run_id, ticks, events, cleansed, 15)], "kpi_date string, run_id string, market_tick_rows bigint, connection_event_rows bigint, cleansed_rows bigint, view_count int")


def disconnects_by_exchange(events: DataFrame) -> DataFrame:
    return events.where("event_type = 'disconnect'").groupBy("exchange_id").agg(F.count("*").alias("disconnect_count")).orderBy(F.desc("disconnect_count"), "exchange_id")


def update_interval_stats(ticks: DataFrame, exchange: str | None = None) -> DataFrame:
    """Shortest, mean and longest gap of each pair in seconds; gaps of zero count here."""
    rows = ticks if exchange is None else ticks.where(F.col("exchange_id") == exchange)
    gaps = _with_previous(rows).select(*PAIR, (F.col("ts_us") - F.col("prev_us")).alias("us")).where("us is not null")
    return gaps.groupBy(*PAIR).agg(
        F.count("*").alias("interval_count"), F.round(F.min("us") / float(SECOND_US), 3).alias("min_interval_s"), F.round(F.sum("us") / F.count("*") / float(SECOND_US), 3).alias("avg_interval_s"), F.round(F.max("us") / float(SECOND_US), 3).alias("max_interval_s")).orderBy(*PAIR)


