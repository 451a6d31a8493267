"""Training runs: an append-only table of states, a registry of what each run trained, and its models.

A run appends a row when it starts and another when it ends, completed with its counts or failed with its error; what a run's
state is follows from its rows. Nothing is rewritten, so runs may go side by side, and one that was stopped stays started.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import exists
from ..sources.session import prepare
from . import models
from .features import PAIR

STATES = ("started", "completed", "failed")
_STATE = "training_run_id string, status string, recorded_us bigint, training_cutoff_epoch_s bigint, bin_seconds int, horizons array<int>, series_total bigint, series_trained bigint, models_trained bigint, error_message string"


def append_states(states: DataFrame, path: str) -> None:
    """Append rows of _STATE; columns that states lacks are null."""
    wanted = [f.split() for f in _STATE.split(", ")]
    rows = states.select(*[(F.col(c) if c in states.columns else F.lit(None)).cast(t).alias(c) for c, t in wanted])
    rows.write.mode("append").parquet(f"{path}/states")


def training_runs(spark: SparkSession, path: str) -> DataFrame:
    """One row for each run: its last state, with started_us and, if it has ended, finished_us. Empty before the first run.

    Of states recorded at the same time an ended one counts, completed before failed.
    """
    if not exists(spark, f"{path}/states"):
        states = spark.createDataFrame([], _STATE)
    else:
        states = spark.read.schema(_STATE).parquet(f"{path}/states")
    rank = F.when(F.col("status") == "completed", 2).when(F.col("status") == "failed", 1).otherwise(0)
    last = F.max_by(F.struct(*[c for c in states.columns if c not in ("training_run_id", "recorded_us")]), F.struct("recorded_us", rank))
    ended = F.col("last.status") != "started"
    found = states.groupBy("training_run_id").agg(last.alias("last"), F.min("recorded_us").alias("started_us"), F.max("recorded_us").alias("_last_us"))
    return found.select("training_run_id", "last.*", "started_us", F.when(ended, F.col("_last_us")).alias("finished_us"))


def registry(spark: SparkSession, path: str) -> DataFrame:
    """Registry rows of all runs that have written theirs."""
    return spark.read.parquet(f"{path}/registry").drop("run")


def artifacts(spark: SparkSession, path: str) -> DataFrame:
    """Trained slots of completed runs, with when their run started: what inference may use."""
    runs = training_runs(spark, path).where("status = 'completed'").select("training_run_id", "started_us")
    return models.model_artifacts(registry(spark, path)).join(runs, "training_run_id")


def train_run(ticks: DataFrame, config: models.Config, path: str, training_run_id: str, started_us: int, cutoff_s: int | None = None, finished_us: int | None = None) -> DataFrame:
    """Train every pair and horizon of ticks before the cutoff as a run, and return its state.

    The registry, ridge fits and trees of a run go to folders of its own and replace what an earlier try of that run left;
    the completed state is appended last. An error is recorded as the run's state, and raised.
    """
    spark = ticks.sparkSession
    prepare(spark)
    given = {"training_run_id": training_run_id, "training_cutoff_epoch_s": cutoff_s, "bin_seconds": config.bin_seconds, "horizons": list(config.horizons)}

    def record(status: str, at: int, **more: object) -> None:
        row = given | {"status": status, "recorded_us": at} | more
        append_states(spark.createDataFrame([tuple(row.get(f.split()[0]) for f in _STATE.split(", "))], _STATE), path)

    record("started", started_us)
    try:
        fits, grown, rows = models.train_all(ticks, config, cutoff_s)
        for name, df in {"registry": rows, "ridge": fits, "trees": grown}.items():
            df.withColumn("training_run_id", F.lit(training_run_id)).write.mode("overwrite").parquet(f"{path}/{name}/run={training_run_id}")
        own = spark.read.parquet(f"{path}/registry/run={training_run_id}")
        trained = F.col("status") == "trained"
        n = own.agg(F.countDistinct(*PAIR).alias("total"), F.countDistinct(*[F.when(trained, F.col(c)) for c in PAIR]).alias("trained"), F.count_if(trained).alias("models")).first()
        record("completed", finished_us or started_us, series_total=n["total"], series_trained=n["trained"], models_trained=n["models"])
    except Exception as e:
        record("failed", finished_us or started_us, error_message=f"{type(e).__name__}: {e}"[:2000])
        raise
    return training_runs(spark, path).where(F.col("training_run_id") == training_run_id)
