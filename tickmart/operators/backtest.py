"""Back-tests of forecasters that see only a bounded context of past prices.

A forecaster is either a function of two columns, or a model in Python. The first takes context, an array of past prices,
oldest first, and steps, the horizon, and returns an array of that many prices. The second is a Batched: its model is loaded
once in a worker and called with many contexts at a time, which are views of one array of a series' prices.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .models import METRICS, regression_metrics
from .stretches import BLOCK, numbered

PAIR = ("exchange_id", "symbol")
#: The model of a Batched: contexts of one length (rows, prices), and steps, to prices (rows, steps).
Model = Callable[[np.ndarray, int], np.ndarray]

_LOADED: dict[str, Model] = {}


@dataclass(frozen=True)
class Batched:
    """name: the model that load() makes is kept in a worker under this name. batch: contexts for each call."""

    name: str
    load: Callable[[], Model]
    batch: int = 256

    def model(self) -> Model:
        if self.name not in _LOADED:
            _LOADED[self.name] = self.load()
        return _LOADED[self.name]

    def forecast(self, prices: np.ndarray, ends: np.ndarray, most: int, steps: int) -> np.ndarray:
        """(ends, steps): forecasts from the up to `most` prices before each end. Contexts are cut out of prices, not copied."""
        model, out = self.model(), np.zeros((len(ends), steps))
        lengths = np.minimum(ends, most)
        for n in np.unique(lengths):
            views, own = np.lib.stride_tricks.sliding_window_view(prices, n), np.flatnonzero(lengths == n)
            for at in range(0, len(own), self.batch):
                some = own[at : at + self.batch]
                out[some] = np.asarray(model(views[ends[some] - n], steps), np.float64).reshape(len(some), steps)
        return out


Forecaster = Callable[[Column, int], Column] | Batched


def repeat_last() -> Model:
    """last_value() as a model."""
    return lambda contexts, steps: np.repeat(contexts[:, -1:], steps, axis=1)


@dataclass(frozen=True)
class Config:
    horizon_steps: int = 1
    horizon_seconds: int = 60
    test_size: float = 0.2
    min_context: int = 60
    max_context: int = 512
    cv_windows: int = 3


def last_value(context: Column, steps: int) -> Column:
    return F.array_repeat(F.element_at(context, -1), steps)


def drift(context: Column, steps: int) -> Column:
    """The straight line through the context's first and last price."""
    slope = (F.element_at(context, -1) - F.element_at(context, 1)) / F.greatest(F.size(context) - 1, F.lit(1))
    return F.transform(F.sequence(F.lit(1), F.lit(steps)), lambda i: F.element_at(context, -1) + slope * i)


def ema(n: int = 10) -> Forecaster:
    alpha = 2.0 / (n + 1)
    return lambda context, steps: F.array_repeat(F.aggregate(context, F.element_at(context, 1), lambda y, x: y + alpha * (x - y)), steps)


def _in_blocks(series: DataFrame, config: Config) -> DataFrame:
    """(pair, block, row, bucket_epoch_s, price): rows dealt into blocks, each with the context of its first row before it."""
    at, home = F.col("row") - 1, F.floor((F.col("row") - 1) / BLOCK)
    rows = numbered(series.select(*PAIR, "bucket_epoch_s", "price"), PAIR)
    return rows.withColumn("block", F.explode(F.when(F.pmod(at, F.lit(BLOCK)) > BLOCK - config.max_context, F.array(home, home + 1)).otherwise(F.array(home))))


def _by_model(series: DataFrame, forecaster: Batched, config: Config) -> DataFrame:
    """(pair, bucket_epoch_s, price) with the forecast at the horizon from each row with min_context rows up to it."""
    if config.max_context > BLOCK:
        raise ValueError(f"contexts of more than {BLOCK} prices")

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)).sort_by("row")
        row, prices = rows["row"].to_numpy(), rows["price"].to_numpy().astype(np.float64)
        own = np.flatnonzero(((row - 1) // BLOCK == key[-1].as_py()) & (row >= config.min_context))
        ahead = forecaster.forecast(prices, own + 1, config.max_context, config.horizon_steps)[:, -1]
        yield from rows.select([*PAIR, "bucket_epoch_s"]).take(own).append_column("price", pa.array(ahead)).to_batches()

    run.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return _in_blocks(series, config).groupBy(*PAIR, "block").applyInArrow(run, "exchange_id string, symbol string, bucket_epoch_s bigint, price double")


def _by_columns(series: DataFrame, forecaster: Callable[[Column, int], Column], config: Config) -> DataFrame:
    """Likewise, by a function of columns. A row's context is a slice of its block's prices."""
    blocks = _in_blocks(series, config).groupBy(*PAIR, "block").agg(F.array_sort(F.collect_list(F.struct("row", "bucket_epoch_s", "price"))).alias("rows"))
    prices = blocks.withColumn("prices", F.transform("rows", lambda r: r["price"].cast("double")))
    each = prices.select(*PAIR, "block", "prices", F.posexplode("rows").alias("i", "r")).where((F.floor((F.col("r.row") - 1) / BLOCK) == F.col("block")) & (F.col("r.row") >= config.min_context))
    n = F.least(F.col("i") + 1, F.lit(config.max_context))
    contexts = each.select(*PAIR, F.col("r.bucket_epoch_s").alias("bucket_epoch_s"), F.slice("prices", F.col("i") + 2 - n, n).alias("context"))
    return contexts.select(*PAIR, "bucket_epoch_s", F.element_at(forecaster(F.col("context"), config.horizon_steps), config.horizon_steps).alias("price"))


def rolling_origin_backtest(series: DataFrame, forecaster: Forecaster, config: Config) -> DataFrame:
    """For each pair: the forecaster's metrics at the hold-out's start, and their means at origins before it.

    The hold-out is test_size of the rows, at least a horizon, and leaves min_context rows; earlier origins step back by
    a horizon, as long as they leave min_context rows, cv_windows at most. Pairs with too few rows are marked skipped.
    """
    h = config.horizon_steps
    rows = numbered(series.select(*PAIR, "bucket_epoch_s", "price"), PAIR).drop("bucket_epoch_s")
    held = F.least(F.greatest(F.lit(h), F.floor(F.col("rows") * config.test_size + 1e-9)), F.col("rows") - config.min_context)
    sizes = series.groupBy(*PAIR).agg(F.count("*").alias("rows")).withColumn("start", F.col("rows") - held)
    # an origin is the last row before a forecast; only rows near an origin are gathered
    back, origin = F.col("back"), F.col("origin")
    usable = sizes.where((F.col("rows") >= config.min_context + h) & (held >= h)).withColumn("back", F.explode(F.sequence(F.lit(0), F.lit(config.cv_windows))))
    origins = usable.withColumn("origin", F.col("start") - back * h).where(((back == 0) | (origin >= config.min_context)) & (origin >= 1) & (origin + h <= F.col("rows"))).drop("rows")
    near = rows.join(origins, list(PAIR)).where((F.col("row") > origin - config.max_context) & (F.col("row") <= origin + h))
    side = lambda when: F.transform(F.sort_array(F.collect_list(F.when(when, F.struct("row", "price")))), lambda x: x["price"])
    grouped = near.groupBy(*PAIR, "back", "start").agg(side(F.col("row") <= origin).alias("context"), side(F.col("row") > origin).alias("ahead"))
    ahead = _of_groups(forecaster, h) if isinstance(forecaster, Batched) else forecaster(F.col("context"), h)
    points = grouped.select(*PAIR, "back", "start", F.explode(F.arrays_zip(F.col("ahead").alias("actual"), ahead.alias("predicted"))).alias("p")).select(*PAIR, "back", "start", F.col("p.actual").alias("actual"), F.col("p.predicted").alias("predicted_price"))
    metrics = regression_metrics(points, [*PAIR, "back", "start"])
    hold = metrics.where("back = 0").select(*PAIR, F.col("start").alias("train_rows"), F.col("rows").alias("test_rows"), *[F.col(m).alias(f"holdout_{m}") for m in METRICS])
    cv = metrics.where("back > 0").groupBy(*PAIR).agg(F.count("*").alias("cv_fold_count"), *[F.avg(m).alias(f"cv_mean_{m}") for m in METRICS])
    pairs = series.groupBy(*PAIR).agg(F.count("*").alias("series_rows"))
    found = pairs.join(hold, list(PAIR), "left").join(cv, list(PAIR), "left").fillna(0, ["cv_fold_count", "train_rows", "test_rows"])
    return found.withColumn("status", F.when(F.col("test_rows") > 0, "trained").otherwise("skipped"))


def _of_groups(forecaster: Batched, steps: int) -> Column:
    """The forecasts from the column context, by the model: contexts of one length are called together."""

    @F.arrow_udf("array<double>")
    def run(contexts: pa.Array) -> pa.Array:
        held = [np.asarray(c.as_py(), np.float64) for c in contexts]
        out: list[list[float]] = [[]] * len(held)
        for n in {len(c) for c in held}:
            own = [i for i, c in enumerate(held) if len(c) == n]
            for at in range(0, len(own), forecaster.batch):
                some = own[at : at + forecaster.batch]
                for i, row in zip(some, np.asarray(forecaster.model()(np.array([held[i] for i in some]), steps)).reshape(len(some), steps), strict=True):
                    out[i] = row.tolist()
        return pa.array(out, pa.list_(pa.float64()))

    return run(F.col("context"))


def rolling_forecast(series: DataFrame, forecaster: Forecaster, config: Config) -> DataFrame:
    """A forecast from each row with min_context rows up to it, with the actual price at its target second, if there is one.

    Series are dealt into blocks of rows with the contexts of their first rows, so no task has all of one.
    """
    made = (_by_model if isinstance(forecaster, Batched) else _by_columns)(series, forecaster, config)
    made = made.select(*PAIR, F.col("bucket_epoch_s").alias("generated_bucket_epoch_s"), (F.col("bucket_epoch_s") + config.horizon_seconds).alias("target_bucket_epoch_s"), F.col("price").alias("predicted_price"))
    actual = series.select(*PAIR, F.col("bucket_epoch_s").alias("target_bucket_epoch_s"), F.col("price").alias("actual_price"))
    return made.join(actual, [*PAIR, "target_bucket_epoch_s"], "left").withColumn("abs_error", F.abs(F.col("actual_price") - F.col("predicted_price")))
