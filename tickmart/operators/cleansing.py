"""Resampling of tick series onto a fixed grid of bins, with fills and quality flags.

Raw ticks are reduced to bins by one partial aggregation, so windows and fills only ever sort bins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.filters import filter_exchanges, filter_symbols
from ..functions.pricing import effective_price
from ..functions.timing import DAY_S, SECOND_US, bin_epoch, iso_seconds
from ..sources.scratch import written
from .stretches import last_known, next_known

PAIR = ("exchange_id", "symbol")


@dataclass(frozen=True)
class Config:
    bin_seconds: int = 60
    max_forward_fill_s: int = 300
    stale_after_s: int = 90
    fill_method: str = "forward_fill"
    outlier_return: float = 0.2

    def __post_init__(self) -> None:
        if self.fill_method not in ("forward_fill", "interpolation"):
            raise ValueError(f"no such fill method: {self.fill_method}")


def scope(ticks: DataFrame, include: str | None = None, exclude: str | None = None, symbols: str | None = None) -> DataFrame:
    """Ticks with non-blank keys, of the exchanges and symbols asked for."""
    named = ticks.where((F.trim("exchange_id") != "") & (F.trim("symbol") != ""))
    return filter_symbols(filter_exchanges(named, include, exclude, defaults=()), symbols)


def pair_profiles(ticks: DataFrame, limit: int | None = None) -> DataFrame:
    """First and last whole second and tick count of each pair, over ticks with a price and any time text.

    A time that cannot be parsed has no ts_us: it counts, if ticks hold ts_text, but does not move the ends.
    """
    timed = F.col("ts_text").isNotNull() if "ts_text" in ticks.columns else F.col("ts_us").isNotNull()
    seconds = F.floor(F.col("ts_us") / SECOND_US)
    found = ticks.where(timed & effective_price().isNotNull()).groupBy(*PAIR).agg(F.min(seconds).alias("min_epoch_s"), F.max(seconds).alias("max_epoch_s"), F.count("*").alias("source_tick_count"))
    return found if limit is None else found.orderBy(*PAIR).limit(limit)


def observed_bins(ticks: DataFrame, bin_seconds: int) -> DataFrame:
    """For each pair and bin with ticks: their count, and the price and second of the first and last one."""
    place = F.struct("ts_us", "id")
    what = F.struct(effective_price().alias("price"), F.floor(F.col("ts_us") / SECOND_US).alias("epoch_s"))
    rows = ticks.where(F.col("ts_us").isNotNull() & effective_price().isNotNull())
    start = bin_epoch(F.floor(F.col("ts_us") / SECOND_US), bin_seconds).alias("bucket_epoch_s")
    return rows.groupBy(*PAIR, start).agg(F.count("*").alias("tick_count_in_bin"), F.min_by(what, place).alias("first"), F.max_by(what, place).alias("last"))


def bin_grid(profiles: DataFrame, bin_seconds: int) -> DataFrame:
    """Every bin from a pair's first to its last tick. Days come first, and then each day's bins: no row holds a pair's bins."""
    low, high, step = bin_epoch(F.col("min_epoch_s"), bin_seconds), bin_epoch(F.col("max_epoch_s"), bin_seconds), F.lit(bin_seconds).cast("long")
    days = profiles.where("min_epoch_s is not null").select(*PAIR, low.alias("_low"), high.alias("_high"), F.explode(F.sequence(F.floor(low / DAY_S), F.floor(high / DAY_S))).alias("_day"))
    # a bin belongs to the day that it starts in
    first = F.greatest(F.col("_low"), F.ceil(F.col("_day") * DAY_S / bin_seconds) * bin_seconds)
    last = F.least(F.col("_high"), F.floor((F.col("_day") * DAY_S + DAY_S - 1) / bin_seconds) * bin_seconds)
    return days.where(first <= last).select(*PAIR, F.explode(F.sequence(first, last, step)).alias("bucket_epoch_s"))


def forward_fill(grid: DataFrame) -> DataFrame:
    """grid (pair, bucket_epoch_s, last) with before, the last tick up to each bin, and its age at the bin's start.

    The grid is written once: a bin looks for its tick in its own stretch of time, and then in summaries of the ones before.
    """
    filled = last_known(written(grid), PAIR, "last").withColumnRenamed("known", "before")
    return filled.withColumn("before_age", F.col("bucket_epoch_s") - F.col("before.epoch_s"))


def interpolate(filled: DataFrame) -> DataFrame:
    """forward_fill() with after, the first tick of the next observed bin, its distance, and the straight line's price."""
    wide = next_known(written(filled), PAIR, "first").withColumnRenamed("known", "after").withColumn("after_distance", F.col("after.epoch_s") - F.col("bucket_epoch_s"))
    share = F.try_divide(F.col("before_age"), F.col("after.epoch_s") - F.col("before.epoch_s"))
    return wide.withColumn("line_price", F.col("before.price") + (F.col("after.price") - F.col("before.price")) * share)


def quality_flags(grid: DataFrame, config: Config) -> DataFrame:
    """The chosen fill of each bin: method, price, source time, age, and stale and missing marks."""
    observed = F.col("tick_count_in_bin").isNotNull()
    near = F.col("before_age") <= config.max_forward_fill_s
    line = near & (F.col("after_distance") <= config.max_forward_fill_s) & F.col("line_price").isNotNull() if config.fill_method == "interpolation" else F.lit(False)
    method = F.when(observed, "observed").when(line, "interpolation").when(near, "forward_fill").otherwise("missing")
    is_ = lambda name: F.col("fill_method") == name
    source = F.when(is_("observed"), F.col("last.epoch_s")).when(is_("forward_fill"), F.col("before.epoch_s"))
    line_price = F.col("line_price") if config.fill_method == "interpolation" else F.lit(None).cast("double")
    line_age = F.least("before_age", "after_distance") if config.fill_method == "interpolation" else F.lit(None).cast("long")
    aged = grid.withColumn("fill_method", method).withColumn("age_seconds", F.when(is_("observed"), 0).when(is_("interpolation"), line_age).when(is_("forward_fill"), F.col("before_age")).cast("long"))
    return aged.select(
        *PAIR, "bucket_epoch_s", F.when(is_("observed"), F.col("last.price")).when(is_("interpolation"), line_price).when(is_("forward_fill"), F.col("before.price")).alias("price"),
        source.alias("source_ingestion_epoch_s"), F.coalesce("tick_count_in_bin", F.lit(0).cast("long")).alias("tick_count_in_bin"), "fill_method", "age_seconds",
        F.when(is_("observed"), 0).when(is_("missing") | (F.col("age_seconds") > config.stale_after_s), 1).otherwise(0).alias("is_stale"), is_("missing").cast("int").alias("is_missing"))


def cleanse(ticks: DataFrame, config: Config, run_id: str) -> DataFrame:
    """The cleansed market of a run: one row for each pair and bin of its grid."""
    grid = bin_grid(pair_profiles(ticks), config.bin_seconds).join(observed_bins(ticks, config.bin_seconds), [*PAIR, "bucket_epoch_s"], "left")
    filled = forward_fill(grid)
    if config.fill_method == "interpolation":
        filled = interpolate(filled)
    source: Column = F.col("source_ingestion_epoch_s")
    return quality_flags(filled, config).select(
        F.lit(run_id).alias("run_id"), iso_seconds(F.col("bucket_epoch_s")).alias("bucket_start_utc"), "bucket_epoch_s", *PAIR, F.lit(config.bin_seconds).alias("bin_seconds"), F.lit(config.max_forward_fill_s).alias("max_forward_fill_s"),
        F.lit(config.fill_method).alias("fill_method_mode"), "price", iso_seconds(source).alias("source_ingestion_ts_utc"), "source_ingestion_epoch_s", "tick_count_in_bin", "fill_method", "age_seconds", "is_stale", "is_missing")


def _kinds() -> list[Column]:
    return [F.count("*").alias("bins_total"), *[F.count_if(F.col("fill_method") == k).alias(f"bins_{k}") for k in ("observed", "forward_fill", "interpolation", "missing")]]


def pair_summary(cleansed: DataFrame, profiles: DataFrame) -> DataFrame:
    """Bins of each kind of every pair, with its profile."""
    return profiles.join(cleansed.groupBy("run_id", *PAIR).agg(*_kinds()), list(PAIR))


def cleansing_run_metadata(cleansed: DataFrame, profiles: DataFrame, config: Config) -> DataFrame:
    """One row for each run: totals and parameters. A run without bins has no row."""
    totals = cleansed.groupBy("run_id").agg(F.countDistinct(*PAIR).alias("pair_count"), *_kinds())
    ticks = profiles.agg(F.coalesce(F.sum("source_tick_count"), F.lit(0)).cast("long").alias("source_tick_count"))
    one = totals.crossJoin(ticks)  # with one row
    return one.select("*", F.lit(config.bin_seconds).alias("bin_seconds"), F.lit(config.max_forward_fill_s).alias("max_forward_fill_s"), F.lit(config.stale_after_s).alias("stale_after_s"), F.lit(config.fill_method).alias("fill_method_mode"))


def export_run(tables: dict[str, DataFrame], run_id: str, path: str) -> None:
    """The rows of one run of each table as JSON below path, a folder for each table; tables without runs go whole."""
    for name, df in tables.items():
        (df.where(F.col("run_id") == run_id) if "run_id" in df.columns else df).write.mode("overwrite").json(f"{path}/{name}")
