"""Data-quality counters of ticks and cleansed prices."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.pricing import effective_price

PAIR = ("exchange_id", "symbol")
ISSUES = ("null_ingestion_ts_count", "invalid_ingestion_ts_count", "null_effective_price_count", "non_positive_effective_price_count", "rows_with_negative_values_count", "bid_gt_ask_count", "duplicate_tick_count", "outlier_return_count")


def dq_source(ticks: DataFrame) -> DataFrame:
    """Rows of each pair, and how many have no time, an unreadable time (ts_text without ts_us), no price, a price of 0 or
    less, a negative figure, or a bid over the ask."""
    text = F.col("ts_text") if "ts_text" in ticks.columns else F.col("ts_us")
    price = effective_price()
    negative = reduce(or_, [F.coalesce(F.col(c) < 0, F.lit(False)) for c in ("price", "bid", "ask", "last", "base_volume", "quote_volume")])
    return ticks.groupBy(*PAIR).agg(
        F.count("*").alias("source_row_count"), F.count_if(text.isNull()).alias("null_ingestion_ts_count"), F.count_if(text.isNotNull() & F.col("ts_us").isNull()).alias("invalid_ingestion_ts_count"),
        F.count_if(price.isNull()).alias("null_effective_price_count"), F.count_if(price <= 0).alias("non_positive_effective_price_count"), F.count_if(negative).alias("rows_with_negative_values_count"), F.count_if(F.col("bid") > F.col("ask")).alias("bid_gt_ask_count"))


def dq_duplicates(ticks: DataFrame) -> DataFrame:
    """Ticks of each pair beyond the first of those equal in time and price; nulls are equal. Pairs without any are left out."""
    text = "ts_text" if "ts_text" in ticks.columns else "ts_us"
    same = ticks.groupBy(*PAIR, text, effective_price().alias("price")).agg(F.count("*").alias("n")).where("n > 1")
    return same.groupBy(*PAIR).agg(F.sum(F.col("n") - 1).alias("duplicate_tick_count"))


def dq_outliers(cleansed: DataFrame, threshold: float = 0.2) -> DataFrame:
    """Observed bins of each run and pair whose price moved by more than threshold of the observed one before."""
    seen = cleansed.where("fill_method = 'observed' and price is not null")
    before = F.lag("price").over(W.partitionBy("run_id", *PAIR).orderBy("bucket_epoch_s"))
    moved = seen.withColumn("before", before).where("before <> 0")
    return moved.groupBy("run_id", *PAIR).agg(F.count_if(F.abs((F.col("price") - F.col("before")) / F.col("before")) > threshold).alias("outlier_return_count"))


def dq_summary(source: DataFrame, duplicates: DataFrame, outliers: DataFrame) -> DataFrame:
    """All counters of the pairs in source, and their sum. Outliers must be of one run."""
    wide = source.join(duplicates, list(PAIR), "left").join(outliers.drop("run_id"), list(PAIR), "left").fillna(0, ["duplicate_tick_count", "outlier_return_count"])
    return wide.withColumn("total_issue_count", reduce(add, map(F.col, ISSUES)))


def dq_run_summary(summary: DataFrame) -> DataFrame:
    """One row: pairs, pairs with an issue, and the sum of each counter."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("source_row_count", *ISSUES, "total_issue_count")]
    return summary.agg(F.count("*").alias("pair_count"), F.count_if(F.col("total_issue_count") > 0).alias("pairs_with_issues"), *sums)
