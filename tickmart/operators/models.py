"""Training and scoring of price models over all pairs at once.

Ridge: one pass adds up the moments of each pair, horizon and fold, and one small system is solved for each of them.
Trees: one model for each pair and horizon (see trees), on prices relative to the current one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.filters import filter_exchanges, filter_symbols
from ..sources.scratch import delete, written
from ..sources.session import prepare
from . import trees
from .features import LAGS, PAIR, WINDOWS, cv_folds, feature_names, feature_table, holdout_split, merge_series, resample_last, training_frames

METRICS = ("mae", "rmse", "mape", "r2")
SLOT = (*PAIR, "horizon_steps")


@dataclass(frozen=True)
class Config:
    bin_seconds: int = 60
    horizons: tuple[int, ...] = (1, 30)
    lags: tuple[int, ...] = LAGS
    windows: tuple[int, ...] = WINDOWS
    test_size: float = 0.2
    folds: int = 5
    alpha: float = 1.0
    min_train_rows: int = 500
    trees: trees.Params = trees.Params()


def with_level(frame: DataFrame) -> DataFrame:
    """frame with level, the mean price of each pair: what price-like features are measured from."""
    return frame.join(frame.groupBy(*PAIR).agg(F.avg("price").alias("level")), list(PAIR))


def _is_price(name: str) -> bool:
    return name.startswith(("lag_", "roll_mean", "ta_sma", "ta_ema")) or name.startswith(("ta_bbands_lower", "ta_bbands_middle", "ta_bbands_upper"))


def design(frame: DataFrame, names: list[str]) -> DataFrame:
    """frame with x, the features in order; price-like ones are measured from the pair's level."""
    return frame.withColumn("x", F.array(*[(F.col(n) - F.col("level")).cast("double") if _is_price(n) else F.col(n).cast("double") for n in names]))


def fit_ridge(rows: DataFrame, names: list[str], alpha: float = 1.0) -> DataFrame:
    """A fit of each slot and fold: (pair, horizon_steps, fold, coefficients, intercept, train_rows, error).

    rows are training rows of cv_folds() with x of design(), level, target and horizon_steps. Fold 0 is fitted on all of
    them, fold k on the rows before those that it validates. Features are scaled to unit deviation, as the penalty
    expects; coefficients are for x as given, and predict target - level. A system that cannot be solved gives a row with
    its error and no coefficients.
    """
    size = len(names) + 2  # one, features, target

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = pd.MultiIndex.from_arrays([b.column(c).to_pandas() for c in (*SLOT, "fold")])
            x = np.column_stack([np.ones(b.num_rows), np.stack(b.column("x").to_numpy(zero_copy_only=False)), b.column("target").to_numpy() - b.column("level").to_numpy()])
            out = []
            for key, at in pd.Series(np.arange(b.num_rows)).groupby(keys).groups.items():
                own = x[at]
                out.append((*key, (own.T @ own).tobytes()))
            if out:
                yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=[*SLOT, "fold", "moments"]), schema=pa.schema([("exchange_id", pa.string()), ("symbol", pa.string()), ("horizon_steps", pa.int32()), ("fold", pa.int32()), ("moments", pa.binary())]))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        by_fold = {int(f): sum(np.frombuffer(m, np.float64).reshape(size, size) for m in g["moments"]) for f, g in pdf.groupby("fold")}
        out = []
        for fold in sorted({0, *by_fold}):
            m = sum((v for f, v in by_fold.items() if not fold or f < fold), np.zeros((size, size)))
            n = m[0, 0]
            if n < 2:
                continue
            mean = m[0, 1:] / n
            cov = m[1:, 1:] / n - np.outer(mean, mean)
            scale = np.sqrt(np.maximum(np.diag(cov)[:-1], 0))
            use = scale > 1e-9 * (1 + np.abs(mean[:-1]))
            z = cov[:-1, :-1][np.ix_(use, use)] / np.outer(scale[use], scale[use])
            w = np.zeros(size - 2)
            slot = (*(pdf[c].iloc[0] for c in SLOT), fold)
            try:
                w[use] = np.linalg.solve(z + alpha / n * np.eye(use.sum()), cov[:-1, -1][use] / scale[use]) / scale[use]
                if not np.isfinite(w).all():
                    raise ValueError("coefficients that are not finite")
                out.append((*slot, w.tolist(), float(mean[-1] - w @ mean[:-1]), int(n), None))
            except (ValueError, np.linalg.LinAlgError) as e:
                out.append((*slot, None, None, int(n), f"{type(e).__name__}: {e}"))
        return pd.DataFrame(out, columns=[*SLOT, "fold", "coefficients", "intercept", "train_rows", "error"])

    sums = rows.select(*SLOT, "fold", "x", "target", "level").mapInArrow(add_up, "exchange_id string, symbol string, horizon_steps int, fold int, moments binary")
    return sums.groupBy(*SLOT).applyInPandas(solve, "exchange_id string, symbol string, horizon_steps int, fold int, coefficients array<double>, intercept double, train_rows bigint, error string")


def predicted(fits: str = "coefficients") -> Column:
    """The price that a fit predicts for a row of design()."""
    return F.col("level") + F.col("intercept") + F.aggregate(F.zip_with("x", fits, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)


def regression_metrics(scored: DataFrame, by: list[str]) -> DataFrame:
    """mae, rmse, mape (percent, of actuals that are not 0) and r2 (null under two rows or without variance), and rows."""
    y, p = F.col("actual"), F.col("predicted_price")
    error, spread = y - p, F.var_pop(y) * F.count("*")
    return scored.where(y.isNotNull() & p.isNotNull()).groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"), (100.0 * F.avg(F.when(F.abs(y) > 1e-9, F.abs(error / y)))).alias("mape"),
        F.when((F.count("*") >= 2) & (F.stddev_pop(y) > 1e-12), 1.0 - F.sum(error * error) / spread).alias("r2"), F.count("*").alias("rows"))


def slots(series: DataFrame, config: Config) -> tuple[DataFrame, list[str]]:
    """Split training frames of every pair and horizon, with features as x, and the features' names."""
    features = feature_table(series, config.lags, config.windows)
    names = feature_names(features)
    frames = [f.withColumn("horizon_steps", F.lit(h)) for h, f in zip(config.horizons, training_frames(features, config.horizons), strict=True)]
    split = holdout_split(reduce(DataFrame.unionByName, frames), config.test_size, SLOT)
    return written(design(with_level(split), names)), names


def _measured(checked: DataFrame, of_slot: DataFrame) -> DataFrame:
    """of_slot (slot, ...) with hold-out metrics and means of fold metrics, of checked rows (slot, fold, actual, predicted_price).

    Fold 0 is the hold-out.
    """
    per_fold = regression_metrics(checked, [*SLOT, "fold"])
    holdout = per_fold.where("fold = 0").drop("fold").withColumnsRenamed({m: f"holdout_{m}" for m in METRICS} | {"rows": "test_rows"})
    cv = per_fold.where("fold > 0").groupBy(*SLOT).agg(F.count("*").alias("cv_fold_count"), *[F.avg(m).alias(f"cv_mean_{m}") for m in METRICS])
    return of_slot.join(holdout, list(SLOT), "left").join(cv, list(SLOT), "left")


def folded(table: DataFrame, config: Config) -> DataFrame:
    """Rows of slots() whose slot has enough rows, with fold (0 for held-out rows) and slot_rows, the rows of the slot."""
    rows = table.where(F.col("rows") >= config.min_train_rows).withColumn("slot_rows", F.col("rows"))
    return cv_folds(rows, config.folds, SLOT).unionByName(rows.where("not is_train").withColumn("fold", F.lit(0)))


def train_trees(table: DataFrame, names: list[str], config: Config) -> DataFrame:
    """trees.fit_slots() of every slot in table (of folded())."""
    return written(trees.fit_slots(relative_design(table, names), config.trees))


def train_series(series: DataFrame, config: Config) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ridge fits, tree fits, registry): both models of every slot with enough rows, and a registry row of every slot and model.

    A slot with under min_train_rows is recorded as skipped, one whose fit fails as failed with the error.
    """
    table, names = slots(series, config)
    rows = written(folded(table, config))
    sizes = table.groupBy(*SLOT).agg(F.max("rows").alias("rows"))
    train = rows.where("is_train")

    fits = written(fit_ridge(train, names, config.alpha))
    final = fits.where("fold = 0").select(*SLOT, F.when(F.col("error").isNull(), F.col("train_rows")).alias("train_rows"), "error")
    checked = rows.where("not is_train or fold > 0").join(fits.where("error is null"), [*SLOT, "fold"]).select(*SLOT, "fold", F.col("target").alias("actual"), predicted().alias("predicted_price"))
    ridge = registry_rows(_measured(checked, sizes.join(final, list(SLOT), "left")), config)

    grown = train_trees(rows, names, config)
    one = grown.where(~trees.is_check()).select(*SLOT, "train_rows", "error")
    boosted = registry_rows(_measured(grown.where(trees.is_check()), sizes.join(one, list(SLOT), "left")), config, model_name="gbt")
    return fits, grown.where(~trees.is_check()), ridge.unionByName(boosted)


def registry_rows(results: DataFrame, config: Config, training_run_id: str = "train1", model_name: str = "ridge") -> DataFrame:
    """Registry rows of slots: trained where there is a fit, failed where there is an error, skipped with the reason otherwise."""
    trained, failed = F.col("train_rows").isNotNull(), F.col("error").isNotNull()
    return results.select(
        F.lit(training_run_id).alias("training_run_id"), *PAIR, F.lit(model_name).alias("model_name"), "horizon_steps", (F.col("horizon_steps") * config.bin_seconds).alias("horizon_seconds"), F.coalesce("train_rows", F.lit(0)).alias("train_rows"), F.coalesce("test_rows", F.lit(0)).alias("test_rows"),
        F.coalesce("cv_fold_count", F.lit(0)).alias("cv_fold_count"), *[f"{p}_{m}" for p in ("holdout", "cv_mean") for m in METRICS], F.when(failed, "failed").when(trained, "trained").otherwise("skipped").alias("status"), F.when(failed, F.col("error")).when(~trained, F.concat(F.lit("insufficient_rows:"), F.col("rows"))).alias("error_message"))


def model_artifacts(registry: DataFrame) -> DataFrame:
    """What each trained slot offers to inference."""
    return registry.where("status = 'trained'").select("training_run_id", *PAIR, "model_name", "horizon_steps", "horizon_seconds", "train_rows", "test_rows", "cv_fold_count", "holdout_mae", "holdout_rmse", "holdout_mape", "holdout_r2", "cv_mean_mae", "cv_mean_rmse", "cv_mean_mape", "cv_mean_r2")


def train_all(ticks: DataFrame, config: Config, cutoff_s: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """train_series() of every pair in ticks before the cutoff."""
    return train_series(resample_last(merge_series(ticks, cutoff_s), config.bin_seconds), config)


def relative_design(table: DataFrame, names: list[str]) -> DataFrame:
    """table with x in which price-like features are shares of the current price."""
    return table.withColumn("x", F.array(*[(F.col(n) / F.col("price") - 1.0).cast("double") if _is_price(n) else F.col(n).cast("double") for n in names]))


def inference_frame(features: DataFrame, horizon_seconds: int) -> DataFrame:
    """Complete feature rows with the second that they forecast: seconds ahead, whatever bins are missing."""
    return features.dropna().withColumn("horizon_seconds", F.lit(horizon_seconds)).withColumn("target_bucket_epoch_s", F.col("bucket_epoch_s") + horizon_seconds)


def score_forecasts(frame: DataFrame, fits: DataFrame, series: DataFrame, names: list[str], levels: DataFrame, config: Config) -> DataFrame:
    """Forecasts of every row whose slot has a fit, with the actual price at the target and the absolute error, if known."""
    final = fits.where("fold = 0 and error is null").withColumn("horizon_seconds", F.col("horizon_steps") * config.bin_seconds).drop("fold", "train_rows", "horizon_steps", "error")
    rows = design(frame.join(levels, list(PAIR)), names).join(final, [*PAIR, "horizon_seconds"])
    actual = series.select(*PAIR, F.col("bucket_epoch_s").alias("target_bucket_epoch_s"), F.col("price").alias("actual_price"))
    scored = rows.withColumn("predicted_price", predicted()).join(actual, [*PAIR, "target_bucket_epoch_s"], "left")
    return scored.select(*PAIR, "horizon_seconds", F.col("bucket_epoch_s").alias("generated_bucket_epoch_s"), "target_bucket_epoch_s", "predicted_price", "actual_price", F.abs(F.col("actual_price") - F.col("predicted_price")).alias("abs_error"))


def score_tree_forecasts(frame: DataFrame, grown: DataFrame, series: DataFrame, names: list[str], config: Config) -> DataFrame:
    """score_forecasts() for the trees of train_series()."""
    rows = relative_design(frame, names).withColumn("horizon_steps", (F.col("horizon_seconds") / config.bin_seconds).cast("int"))
    scored = trees.score(rows, grown, config.trees.depth, bin_seconds=config.bin_seconds)
    scored = scored.withColumn("horizon_seconds", F.col("horizon_steps") * config.bin_seconds).withColumn("target_bucket_epoch_s", F.col("bucket_epoch_s") + F.col("horizon_seconds")).drop("price")
    actual = series.select(*PAIR, F.col("bucket_epoch_s").alias("target_bucket_epoch_s"), F.col("price").alias("actual_price"))
    found = scored.join(actual, [*PAIR, "target_bucket_epoch_s"], "left")
    return found.select(*PAIR, "horizon_seconds", F.col("bucket_epoch_s").alias("generated_bucket_epoch_s"), "target_bucket_epoch_s", "predicted_price", "actual_price", F.abs(F.col("actual_price") - F.col("predicted_price")).alias("abs_error"))


def latest_training_run(runs: DataFrame, requested: str | None = None) -> DataFrame:
    """(training_run_id) of runs (see ledger.training_runs()): the run asked for, or the last one completed."""
    if requested is not None:
        return runs.where(F.col("training_run_id") == requested).select("training_run_id").limit(1)
    return runs.where("status = 'completed'").orderBy(F.desc("started_us"), F.desc("training_run_id")).select("training_run_id").limit(1)


def inference_tasks(registry: DataFrame, training_run_id: str, exchanges: str | None = None, symbols: str | None = None, limit_pairs: int | None = None) -> DataFrame:
    """Trained slots of a run, of the exchanges and symbols asked for; those of the first limit_pairs pairs."""
    rows = filter_symbols(filter_exchanges(registry, exchanges, defaults=()), symbols).where((F.col("training_run_id") == training_run_id) & (F.col("status") == "trained"))
    if limit_pairs is not None:
        rows = rows.join(rows.select(*PAIR).distinct().orderBy(*PAIR).limit(limit_pairs), list(PAIR), "left_semi")
    return rows.orderBy(*PAIR, "model_name", "horizon_seconds")


#: The folders of stored predictions, outermost first.
SCOPE = ("training_run_id", "cleansing_run_id", *PAIR)


def replace_predictions(new: DataFrame, path: str, training_run_id: str, cleansing_run_id: str, exchanges: str | None = None, symbols: str | None = None) -> None:
    """Put new (SCOPE, ...) in place of all predictions below path that the runs and filters select, in folders of SCOPE.

    Pairs in scope without a new row lose theirs. Folders out of scope are not touched, nor read. New folders come first, so
    a run that is stopped may leave stale ones, which the next one removes. Only names of stale folders reach the driver.
    """
    spark = new.sparkSession
    prepare(spark)
    chosen = lambda df: filter_symbols(filter_exchanges(df, exchanges, defaults=()), symbols).where((F.col("training_run_id") == training_run_id) & (F.col("cleansing_run_id") == cleansing_run_id))
    own = written(chosen(new))
    own.repartition(*SCOPE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*SCOPE).parquet(path)
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    here = chosen(read_predictions(spark, path, own)).select(*SCOPE, folder.alias("_folder")).distinct()
    for row in here.join(own.select(*SCOPE).distinct(), list(SCOPE), "left_anti").select("_folder").distinct().toLocalIterator():
        delete(spark, unquote(row["_folder"]))  # files are named as URIs


def read_predictions(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """What replace_predictions() has stored, with the columns of like; folders stay texts."""
    return spark.read.schema(like.schema).parquet(path)
