"""Reading and replacing tables of stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.manifest import FOLDERS


def read_staging(spark: SparkSession, paths: list[str], exclude: list[str] = ()) -> DataFrame:
    """All exports in paths but those in exclude, each path once, as one table."""
    wanted = [p for p in dict.fromkeys(paths) if p not in set(exclude)]
    if not wanted:
        raise ValueError("no export is left to read")
    return spark.read.parquet(*wanted)


#: So few rows are written by as many tasks as there are cores: most of the work is in opening files.
FEW_ROWS = 1_000_000


def by_folder(rows: DataFrame, n: int) -> DataFrame:
    """The n rows, dealt so that a folder's rows meet in a task; of many rows, those of a large folder in several."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, *FOLDERS) if n <= FEW_ROWS else rows.hint("rebalance", *FOLDERS)


def write_vault(rows: DataFrame, path: str) -> None:
    """Append rows of manifest.with_partition() in hourly partitions."""
    by_folder(rows, rows.count()).write.mode("append").partitionBy(*FOLDERS).parquet(path)


def read_vault(spark: SparkSession, path: str, columns: StructType) -> DataFrame:
    """What write_vault() has written, with the columns it was given; folders stay texts, as 05 is not 5."""
    return spark.read.schema(columns).parquet(path)


def append_run(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").partitionBy("run_id").parquet(path)
