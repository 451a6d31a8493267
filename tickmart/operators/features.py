"""Features of price series (exchange_id, symbol, bucket_epoch_s, price), all from prices before the row's own.

Conventions where several are in use: an exponential mean starts from the plain mean of its first n values; relative
strength smooths with 1/14 from the plain mean of the first 14 moves; Bollinger bands take the population deviation.
"""

from __future__ import annotations

from collections.abc import Callable
from math import pi

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from ..functions.filters import filter_exchanges, filter_symbols
from ..functions.pricing import training_price
from ..functions.timing import DAY_S, SECOND_US, bin_epoch
from ..sources.scratch import written
from .stretches import affine_scan, gaps, numbered, windowed

PAIR = ("exchange_id", "symbol")
LAGS = (1, 2, 3, 5, 10, 15, 30)
WINDOWS = (3, 5, 10, 30)


def scope_pairs(ticks: DataFrame, cutoff_s: int | None = None, limit: int | None = None, exchanges: str | None = None, symbols: str | None = None) -> DataFrame:
    """Pairs with a training price before the cutoff, most rows first; the first `limit` of them."""
    rows = filter_symbols(filter_exchanges(ticks, exchanges, defaults=()), symbols).where(training_price().isNotNull())
    if cutoff_s is not None:
        rows = rows.where(F.col("epoch_s") < cutoff_s)
    found = rows.groupBy(*PAIR).agg(F.count("*").alias("row_count")).orderBy(F.desc("row_count"), *PAIR)
    return found if limit is None else found.limit(limit)


def training_cutoff(ticks: DataFrame, requested_s: int | None = None) -> DataFrame:
    """(cutoff_s): one row, as requested or a second past the last tick. Training uses what is strictly before it."""
    return ticks.agg((F.lit(requested_s) if requested_s is not None else F.max("epoch_s") + 1).cast("long").alias("cutoff_s"))


def merge_series(ticks: DataFrame, cutoff_s: int | None = None) -> DataFrame:
    """One price for each pair and time: that of the greatest id."""
    rows = ticks if cutoff_s is None else ticks.where(F.col("epoch_s") < cutoff_s)
    return rows.select(*PAIR, "ts_us", "id", training_price().alias("price")).where("price is not null").groupBy(*PAIR, "ts_us").agg(F.max_by("price", "id").alias("price"))


def resample_last(series: DataFrame, bin_seconds: int) -> DataFrame:
    """The last price of each bin; bins without ticks are left out, and so are those whose last price is not positive."""
    start = bin_epoch(F.floor(F.col("ts_us") / SECOND_US), bin_seconds).alias("bucket_epoch_s")
    return series.groupBy(*PAIR, start).agg(F.max_by("price", "ts_us").alias("price")).where("price > 0")


def cleansed_series(cleansed: DataFrame, run_id: str) -> DataFrame:
    """Valid positive prices of a run."""
    return cleansed.where((F.col("run_id") == run_id) & (F.col("price") > 0)).where("is_missing = 0 and is_stale = 0").select(*PAIR, "bucket_epoch_s", "price")


def infer_bin(cleansed: DataFrame, run_id: str) -> DataFrame:
    """(bin_seconds): the commonest gap between a run's distinct buckets, the shortest of several; no row for under two."""
    found = gaps(cleansed.where(F.col("run_id") == run_id)).where("gap > 0")
    return found.groupBy(F.col("gap").alias("bin_seconds")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "bin_seconds").limit(1).select("bin_seconds")


def resolve_run(cleansed: DataFrame, run_id: str | None = None) -> DataFrame:
    """(run_id): the run asked for, if it exists, or the latest one."""
    found = cleansed.where("run_id is not null") if run_id is None else cleansed.where(F.col("run_id") == run_id)
    return found.agg(F.max("run_id").alias("run_id")).where("run_id is not null")


def run_start(cleansed: DataFrame, run_id: str) -> DataFrame:
    return cleansed.where(F.col("run_id") == run_id).agg(F.min("bucket_epoch_s").alias("start_epoch_s"))


def _turn(part: Column, whole: float) -> list[Column]:
    return [F.sin(2.0 * pi * part / whole), F.cos(2.0 * pi * part / whole)]


def add_calendar(series: DataFrame) -> DataFrame:
    """Sine and cosine of the minute of the day and of the day of the week, Monday first."""
    minute = F.floor(F.pmod(F.col("bucket_epoch_s"), F.lit(DAY_S)) / 60)
    weekday = F.pmod(F.floor(F.col("bucket_epoch_s") / DAY_S) + 3, F.lit(7))
    names = ("tod_sin", "tod_cos", "dow_sin", "dow_cos")
    return series.select("*", *[c.alias(n) for c, n in zip([*_turn(minute, 1440.0), *_turn(weekday, 7.0)], names, strict=True)])


#: Adds columns to rows (pair, bucket_epoch_s, price, _row) of a block, by the block's window. _row is the row's number in its pair.
_Adder = Callable[[DataFrame, WindowSpec], DataFrame]


def _added(series: DataFrame, back: int, *adders: _Adder) -> DataFrame:
    """series with what adders add from the `back` rows before a row: all of them share one window."""

    def add(rows: DataFrame, over: WindowSpec) -> DataFrame:
        for adder in adders:
            rows = adder(rows, over)
        return rows

    return windowed(numbered(series, PAIR, name="_row"), PAIR, back, 0, add).drop("_row")


def _lags(lags: tuple[int, ...]) -> _Adder:
    def add(rows: DataFrame, over: WindowSpec) -> DataFrame:
        wide = rows.select("*", *[F.lag("price", k).over(over).alias(f"lag_{k}") for k in lags])
        return wide.select("*", *[(F.col("lag_1") - F.col(f"lag_{k}")).alias(f"momentum_lag1_lag{k}") for k in (5, 10) if {1, k} <= set(lags)])

    return add


def add_lags(series: DataFrame, lags: tuple[int, ...] = LAGS) -> DataFrame:
    """Prices k rows before, and momentum from the fifth and tenth to the last, where these lags are asked for."""
    return _added(series, max(lags), _lags(lags))


def _before(what: Column, n: int, over: WindowSpec) -> Column:
    """what over the n rows before the row's own; null until there are so many."""
    return F.when(F.col("_row") > n, what.over(over.rowsBetween(-n, -1)))


def _rolling(windows: tuple[int, ...]) -> _Adder:
    return lambda rows, over: rows.select("*", *[c for n in windows for c in (_before(F.avg("price"), n, over).alias(f"roll_mean_{n}"), _before(F.stddev_samp("price"), n, over).alias(f"roll_std_{n}"))])


def add_rolling(series: DataFrame, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    return _added(series, max(windows), _rolling(windows))


def _sma(windows: tuple[int, ...]) -> _Adder:
    return lambda rows, over: rows.select("*", *[_before(F.avg("price"), n, over).alias(f"ta_sma_{n}") for n in windows])


def add_sma(series: DataFrame, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    return _added(series, max(windows), _sma(windows))


def _roc(n: int) -> _Adder:
    def add(rows: DataFrame, over: WindowSpec) -> DataFrame:
        old = F.lag("price", n + 1).over(over)
        return rows.withColumn(f"ta_roc_{n}", 100.0 * F.try_divide(F.lag("price", 1).over(over) - old, old))

    return add


def add_roc(series: DataFrame, n: int = 10) -> DataFrame:
    """Percentage change over n rows."""
    return _added(series, n + 1, _roc(n))


def _bbands(n: int, width: float) -> _Adder:
    def add(rows: DataFrame, over: WindowSpec) -> DataFrame:
        tag = f"{n}_{width:g}"
        wide = rows.withColumn("_m", _before(F.avg("price"), n, over)).withColumn("_s", width * _before(F.stddev_pop("price"), n, over))
        bands = {"lower": F.col("_m") - F.col("_s"), "middle": F.col("_m"), "upper": F.col("_m") + F.col("_s"), "bandwidth": 100.0 * F.try_divide(2.0 * F.col("_s"), F.col("_m"))}
        return wide.select("*", *[c.alias(f"ta_bbands_{name}_{tag}") for name, c in bands.items()]).drop("_m", "_s")

    return add


def add_bbands(series: DataFrame, n: int = 20, width: float = 2.0) -> DataFrame:
    return _added(series, n, _bbands(n, width))


def _smoothed(rows: DataFrame, means: dict[str, tuple[str, int, int, float]]) -> DataFrame:
    """(pair, bucket_epoch_s) with a column for each of means, name: (value, skip, n, alpha).

    It is null before the n-th value, the first n values' mean there, and takes alpha of each new one after. rows (pair,
    bucket_epoch_s, _row, values) have no value in their first `skip` rows, and one in every other.
    """
    place = {name: F.col("_row") - skip for name, (_, skip, _, _) in means.items()}
    early = rows.where(F.col("_row") <= max(skip + n for _, skip, n, _ in means.values()))
    starts = early.groupBy(*PAIR).agg(*[F.avg(F.when(place[name].between(1, n), F.col(value))).alias(f"_start_{name}") for name, (value, _, n, _) in means.items()])
    fed = {name: F.when(place[name] < n, 0.0).when(place[name] == n, F.col(f"_start_{name}")).otherwise(alpha * F.col(value)) for name, (value, _, n, alpha) in means.items()}
    scanned = affine_scan(rows.join(starts, list(PAIR)), PAIR, "_row", {name: (1.0 - means[name][3], b) for name, b in fed.items()})
    return scanned.select(*_KEY, *[F.when(place[name] >= n, F.col(name)).alias(name) for name, (_, _, n, _) in means.items()])


def _moved(series: DataFrame) -> DataFrame:
    """(pair, bucket_epoch_s, _row, last, up, down): the price before each row, and how far it rose or fell to get there."""
    move = F.col("last") - F.col("_second")
    rows = windowed(numbered(series.select(*PAIR, "bucket_epoch_s", "price"), PAIR, name="_row"), PAIR, 2, 0, lambda r, over: r.select("*", F.lag("price", 1).over(over).alias("last"), F.lag("price", 2).over(over).alias("_second")))
    return written(rows.select(*PAIR, "bucket_epoch_s", "_row", "last", F.when(move.isNotNull(), F.greatest(move, F.lit(0.0))).alias("up"), F.when(move.isNotNull(), F.greatest(-move, F.lit(0.0))).alias("down")))


_KEY = [*PAIR, "bucket_epoch_s"]


def _emas(windows: tuple[int, ...]) -> dict[str, tuple[str, int, int, float]]:
    return {f"ta_ema_{n}": ("last", 1, n, 2.0 / (n + 1)) for n in windows}


def _strength(n: int) -> dict[str, tuple[str, int, int, float]]:
    return {"_up": ("up", 2, n, 1.0 / n), "_down": ("down", 2, n, 1.0 / n)}


def _rsi(n: int) -> Column:
    return (100.0 * F.try_divide(F.col("_up"), F.col("_up") + F.col("_down"))).alias(f"ta_rsi_{n}")


def add_ema(series: DataFrame, n: int) -> DataFrame:
    """Exponential mean, of weight 2 / (n + 1), of the prices before each row."""
    return series.join(_smoothed(_moved(series), _emas((n,))), _KEY, "left")


def add_rsi(series: DataFrame, n: int = 14) -> DataFrame:
    """Relative strength of the prices before each row, 0 to 100."""
    return series.join(_smoothed(_moved(series), _strength(n)).select(*_KEY, _rsi(n)), _KEY, "left")


def feature_table(series: DataFrame, lags: tuple[int, ...] = LAGS, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """All features. The windows share one numbering and one sort of blocks, and all recurrences are one scan."""
    series = written(series.select(*_KEY, "price"))
    back = max(*lags, *windows, 20, 11)
    wide = _added(add_calendar(series), back, _lags(lags), _rolling(windows), _sma(windows), _roc(10), _bbands(20, 2.0))
    means = _smoothed(_moved(series), _emas(windows) | _strength(14))
    return written(wide.join(means.select(*_KEY, *_emas(windows), _rsi(14)), _KEY, "left"))


def feature_names(features: DataFrame) -> list[str]:
    return [c for c in features.columns if c not in (*PAIR, "bucket_epoch_s", "price", "target")]


def training_frames(features: DataFrame, horizons: tuple[int, ...]) -> list[DataFrame]:
    """For each horizon, features with target, the price that many rows ahead; rows that lack a feature or the target are left out."""
    narrow = numbered(features.select(*_KEY, "price"), PAIR, name="_row")
    ahead = lambda h: windowed(narrow, PAIR, 0, h, lambda rows, over: rows.withColumn("target", F.lead("price", h).over(over)))
    return [features.join(ahead(h).where("target is not null").select(*_KEY, "target"), _KEY).select(*features.columns, "target").dropna() for h in horizons]


def training_frame(features: DataFrame, horizon: int) -> DataFrame:
    return training_frames(features, (horizon,))[0]


def max_training_rows(ticks: DataFrame, bin_seconds: int, cutoff_s: int | None = None, lags: tuple[int, ...] = LAGS, windows: tuple[int, ...] = WINDOWS, horizons: tuple[int, ...] = (1, 30)) -> DataFrame:
    """One row: an upper bound of a pair's training rows, from the span of ticks before the cutoff."""
    warm_up, ahead = max(20, *lags, *windows), max(horizons)
    span = F.greatest(F.lit(0), (F.lit(cutoff_s) if cutoff_s is not None else F.max("epoch_s") + 1) - F.min("epoch_s")).cast("long")
    one = ticks.agg(span.alias("available_seconds")).withColumn("max_resampled_rows", F.floor(F.col("available_seconds") / bin_seconds))
    return one.select("*", F.lit(warm_up).alias("indicator_warmup_rows"), F.lit(ahead).alias("max_horizon_steps"), F.greatest(F.lit(0), F.col("max_resampled_rows") - warm_up - ahead).alias("max_trainable_rows"))


def holdout_split(frame: DataFrame, test_size: float = 0.2, keys: tuple[str, ...] = PAIR) -> DataFrame:
    """frame with row, rows and is_train: the first rows of each key train, at least one, and at least one is held out."""
    wide = numbered(frame, keys, total="rows")
    cut = F.greatest(F.lit(1), F.least(F.col("rows") - 1, F.floor(F.col("rows") * (1.0 - test_size) + 1e-9)))
    return wide.withColumn("is_train", F.col("row") <= cut)


def cv_folds(split: DataFrame, folds: int = 5, keys: tuple[str, ...] = PAIR) -> DataFrame:
    """Training rows of holdout_split() with fold: 1 to `folds` where the row validates that fold, 0 where it only trains.

    Folds expand: fold k trains on all rows before those it validates. With fewer than three training rows all are 0. rows is
    the number of the key's training rows, as these come first.
    """
    train = split.where("is_train")
    wide = train.drop("rows").join(train.groupBy(*keys).agg(F.count("*").alias("rows")), list(keys)).select(*split.columns)
    k = F.least(F.lit(folds), F.col("rows") - 1)
    size = F.floor(F.col("rows") / (k + 1))
    first = F.col("rows") - k * size
    return wide.withColumn("fold", F.when((k < 2) | (F.col("row") <= first), 0).otherwise(F.floor((F.col("row") - first - 1) / size) + 1).cast("int"))
