"""A folder for tables between steps: below spark.checkpoint.dir, which a cluster's executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .session import prepare


def scratch_path(spark: SparkSession) -> str:
    """A new path below the shared folder."""
    prepare(spark)
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/tickmart-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    for made in _OPEN:
        made.append(path)
    return path


#: The paths made in each temporaries() that is open.
_OPEN: list[list[str]] = []


@contextmanager
def temporaries(spark: SparkSession) -> Iterator[list[str]]:
    """The paths that are made meanwhile, deleted at the end; those that are to stay are taken out of the list."""
    made: list[str] = []
    _OPEN.append(made)
    try:
        yield made
    finally:
        _OPEN.remove(made)
        for path in made:
            delete(spark, path)


def written(df: DataFrame) -> DataFrame:
    """The same rows from a table in that folder, so that later steps start from it and not from df's plan."""
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """df, and how many rows went through it, once an action has run over all of it: counted on the way, not by a scan."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), lambda: seen.get["rows"]


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def clear(spark: SparkSession) -> None:
    """Delete what this application has written there. Call it once its results are stored elsewhere."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is not None:
        delete(spark, f"{root.rstrip('/')}/tickmart-{spark.sparkContext.applicationId}")
