"""Shared by the classifiers: the rows they may learn from, held-out marks, and bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(folds: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % folds


def held_out(folds: int, fold: int) -> Column:
    """A null doc_id is not held out; it has no label either."""
    return F.coalesce(remainder(folds) == fold, F.lit(False))


def sampled_ids(labels: DataFrame, label: str, folds: int, fold: int, most_per_class: int) -> DataFrame:
    """(doc_id, label) of at most most_per_class labelled rows of each class 0 and 1, picked by a hash of doc_id.

    Null ids or labels and held-out rows are left out. The result has a proven bound, 2 * most_per_class rows.
    """
    rows = labels.where(~held_out(folds, fold) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("label"))
    picked = [rows.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_per_class) for k in (0, 1)]
    return picked[0].unionByName(picked[1])


def labelled_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, label, text): one row for each of ids (doc_id, label) that docs has, however often.

    Of several texts of one doc_id the first in order counts, null last.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(ids), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
