"""A setting that results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> None:
    """Keep unions from claiming their inputs' partitioning.

    With it, Spark 4.1.2 leaves out the shuffle of an aggregation over a union of inputs that are dealt by the same keys,
    although equal keys of different inputs lie apart, and gives a row for each input.
    """
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")
