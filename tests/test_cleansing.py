"""Bins, fills, flags and quality counters on hand-made series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickmart.operators import cleansing, dq

MINUTE = cleansing.Config(bin_seconds=60, max_forward_fill_s=120, stale_after_s=90)


def ticks(spark, rows):
    """rows: (second, price[, last])."""
    data = [(i, r[0] * 1_000_000 if r[0] is not None else None, "x", "A/B", r[1], r[2] if len(r) > 2 else None, 1.0, 2.0, 1.0, 1.0) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "id long, ts_us long, exchange_id string, symbol string, price double, last double, bid double, ask double, base_volume double, quote_volume double")


def cleansed(spark, rows, config=MINUTE):
    return [(r["bucket_epoch_s"], r["fill_method"], r["price"], r["age_seconds"], r["is_stale"]) for r in cleansing.cleanse(ticks(spark, rows), config, "r").orderBy("bucket_epoch_s").collect()]


def test_fill_limit_and_stale_boundary(spark):
    got = cleansed(spark, [(0, 1.0), (300, 2.0)])
    assert got == [(0, "observed", 1.0, 0, 0), (60, "forward_fill", 1.0, 60, 0), (120, "forward_fill", 1.0, 120, 1), (180, "missing", None, None, 1), (240, "missing", None, None, 1), (300, "observed", 2.0, 0, 0)]


def test_last_tick_of_a_bin_wins_and_last_price_stands_in(spark):
    assert cleansed(spark, [(5, 1.0), (50, 2.0), (50, None, 3.0)])[0][:3] == (0, "observed", 3.0)


def test_interpolation_runs_between_ticks_and_falls_back(spark):
    line = cleansing.Config(60, 120, 90, "interpolation")
    got = cleansed(spark, [(0, 0.0), (30, 10.0), (150, 30.0), (170, 99.0)], line)
    assert got[1] == (60, "interpolation", 15.0, 30, 0)  # from 10 at 30 s to 30 at 150 s
    far = cleansed(spark, [(0, 1.0), (600, 2.0)], line)
    assert far[1][1] == "forward_fill" and far[3][1] == "missing"


def test_bins_total_is_the_sum_of_kinds(spark):
    rows = ticks(spark, [(0, 1.0), (130, 2.0), (900, 3.0)])
    out = cleansing.cleanse(rows, MINUTE, "r")
    (s,) = cleansing.pair_summary(out, cleansing.pair_profiles(rows)).collect()
    assert s["bins_total"] == s["bins_observed"] + s["bins_forward_fill"] + s["bins_interpolation"] + s["bins_missing"] == 16
    assert out.where("(fill_method = 'observed') <> (tick_count_in_bin > 0)").count() == 0


def test_unreadable_times_count_in_profiles_only(spark):
    rows = ticks(spark, [(0, 1.0), (None, 2.0), (None, 3.0)]).withColumn("ts_text", F.when(F.col("id") == 2, F.lit(None)).otherwise("t"))
    (p,) = cleansing.pair_profiles(rows).collect()
    assert (p["min_epoch_s"], p["source_tick_count"]) == (0, 2)
    (c,) = dq.dq_source(rows).collect()
    assert (c["null_ingestion_ts_count"], c["invalid_ingestion_ts_count"]) == (1, 1)
    assert cleansing.observed_bins(rows, 60).count() == 1


def test_duplicates_count_beyond_the_first_and_nulls_are_equal(spark):
    rows = ticks(spark, [(0, 1.0), (0, 1.0), (0, 1.0), (None, None), (None, None)])
    assert dq.dq_duplicates(rows).first()["duplicate_tick_count"] == 3


def test_outliers_look_at_observed_bins_only(spark):
    out = cleansing.cleanse(ticks(spark, [(0, 100.0), (130, 121.0), (190, 122.0)]), MINUTE, "r")
    assert dq.dq_outliers(out, 0.2).first()["outlier_return_count"] == 1
