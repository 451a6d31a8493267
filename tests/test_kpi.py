"""Core KPIs on a small hand-made day, with values worked out by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tickmart.functions.timing import parse_us
from tickmart.operators import checks, kpi, marts
from tickmart.plans.core import run_core

DAY = "2026-02-21"


@pytest.fixture(scope="module")
def inputs(spark):
    t = [(1, "10:00:01", "10:00:00", "binance", "BTC/USDT"), (2, "10:00:03", "10:00:01", "binance", "BTC/USDT"), (3, "11:00:03", "11:00:02", "binance", "BTC/USDT"), (4, "10:00:05", "10:00:04", "binance", "ETH/USDT"), (5, "10:00:04", "10:00:03", "kraken", "BTC/USDT")]
    ticks = spark.createDataFrame([(i, f"{DAY}T{a}Z", f"{DAY}T{b}Z", e, s) for i, a, b, e, s in t], "id long, a string, b string, exchange_id string, symbol string").select("id", parse_us(F.col("a")).alias("ts_us"), parse_us(F.col("b")).alias("exch_us"), "exchange_id", "symbol")
    e = [("10:05:00", "disconnect"), ("10:20:00", "connect"), ("11:05:00", "disconnect")]
    events = spark.createDataFrame([(f"{DAY}T{a}Z", "binance", k) for a, k in e], "a string, exchange_id string, event_type string").select(parse_us(F.col("a")).alias("ts_us"), "exchange_id", "event_type")
    c = [("10", 1761300000, "binance", 100.0, 0), ("10", 1761300000, "kraken", 101.0, 0), ("11", 1761303600, "binance", 102.0, 0), ("11", 1761303600, "kraken", 104.0, 0), ("11", 1761303600, "coinbase", 150.0, 1)]
    rows = [("run", f"{DAY}T{h}:00:00Z", n, x, "BTC/USDT", p, "observed", 0, stale) for h, n, x, p, stale in c] + [("run", f"{DAY}T10:00:00Z", 1761300000, "binance", "ETH/USDT", 2500.0, "observed", 0, 0)]
    cleansed = spark.createDataFrame(rows, "run_id string, bucket_start_utc string, bucket_epoch_s long, exchange_id string, symbol string, price double, fill_method string, is_missing int, is_stale int")
    return ticks, events, cleansed


def one(df, **where):
    for k, v in where.items():
        df = df.where(F.col(k) == v)
    (row,) = df.collect()
    return row.asDict()


def test_latency_and_frequency(inputs):
    k = kpi.core_kpis(*inputs)
    day = one(k["latency_daily"], exchange_id="binance", symbol="BTC/USDT")
    assert (day["latency_sample_count"], day["avg_latency_ms"], day["min_latency_ms"], day["max_latency_ms"]) == (3, 1333.333, 1000.0, 2000.0)
    day = one(k["update_frequency_daily"], exchange_id="binance")
    assert (day["interval_count"], day["avg_update_interval_s"], day["update_frequency_hz"]) == (2, 1801.0, 0.000555)
    first = one(k["update_frequency_hourly"], exchange_id="binance", kpi_hour_utc=f"{DAY}T10:00:00Z")
    assert (first["avg_update_interval_s"], first["update_frequency_hz"]) == (2.0, 0.5)
    later = one(k["update_frequency_hourly"], exchange_id="binance", kpi_hour_utc=f"{DAY}T11:00:00Z")
    assert (later["avg_update_interval_s"], later["update_frequency_hz"]) == (3600.0, 0.000278)


def test_disconnects_deviation_and_joins(inputs):
    k = kpi.core_kpis(*inputs)
    assert one(k["connection_drops_daily"])["disconnect_count"] == 2
    spread = one(k["price_deviation_daily"])
    assert (spread["aligned_points_compared"], spread["max_price_diff_abs"], spread["avg_price_diff_abs"]) == (2, 2.0, 1.5)
    assert (spread["max_diff_bucket_start_utc"], spread["max_diff_exchange_pair"]) == (f"{DAY}T11:00:00Z", "kraken|binance")
    assert one(k["daily_exchange_symbol"], symbol="ETH/USDT")["avg_update_interval_s"] is None
    day = one(k["daily_exchange"], exchange_id="binance")
    assert (day["latency_sample_count"], day["interval_count"], day["disconnect_count"]) == (4, 2, 2)
    hour = one(k["hourly_exchange"], exchange_id="binance", kpi_hour_utc=f"{DAY}T10:00:00Z")
    assert (hour["latency_sample_count"], hour["interval_count"], hour["disconnect_count"]) == (3, 1, 1)


def test_intervals_by_day_equal_a_loop_over_a_pairs_ticks(inputs):
    ticks = inputs[0].unionByName(inputs[0].withColumn("ts_us", F.col("ts_us") - 90_000_000_000).withColumn("id", F.col("id") + 10))
    got = sorted((r["exchange_id"], r["symbol"], r["prev_us"], r["ts_us"], r["update_interval_s"]) for r in kpi.update_intervals(ticks).collect())
    rows = sorted((r["exchange_id"], r["symbol"], r["ts_us"]) for r in ticks.where("ts_us is not null").collect())
    want = [(*a, b[2], (b[2] - a[2]) / 1e6) for a, b in zip(rows, rows[1:]) if a[:2] == b[:2] and b[2] > a[2]]
    assert got == want and len(got) > 4


def test_pipeline_phases_and_gate(inputs):
    out = run_core(*inputs, phase="both", kpi_date=DAY, run_id="run")
    assert out["full"]["assertions"].count() == 20 and checks.gate(out["full"]["assertions"])
    assert {r["severity"]: r["total"] for r in out["full"]["summary"].collect()} == {"error": 14, "warn": 6}
    assert "row_counts" not in out["fast"] and out["full"]["row_counts"].count() == 15
    with pytest.raises(RuntimeError, match="latency_upper_bound"):
        run_core(*inputs, limits=checks.Limits(max_latency_ms=1.0))
    with pytest.raises(ValueError, match="lacks the columns"):
        run_core(inputs[0].drop("exch_us"), *inputs[1:])


def test_coverage_warnings_on_empty_inputs(inputs):
    results = checks.run_assertions(kpi.core_kpis(*(df.where("false") for df in inputs)))
    assert results.where("is_failed = 1").count() == 6 and checks.gate(results)


def test_quality_rank_is_best_first(inputs):
    k = kpi.core_kpis(*inputs)
    ranked = marts.platform_quality(k["daily_exchange"], k["daily_exchange_symbol"], "day").orderBy("default_quality_rank").collect()
    assert [r["default_quality_rank"] for r in ranked] == [1, 2]
    assert ranked[0]["default_quality_score"] >= ranked[1]["default_quality_score"]
