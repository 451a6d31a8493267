"""A corpus in five stages: quality, language, line deduplication, near duplicates, packing.

Each stage takes (spark, docs, sf_dir), works on every row that its predecessor kept, and returns the columns of
documents; the last returns placed token pieces. In every stage but the last, other columns are carried along, also those
that are named like a column the operator makes, and an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmart.llm import language, lines, ngram_join, packing, quality
from tickmart.llm.textbatch import small_batches
from tickmart.sources.scratch import delete, temporaries, written

#: The least share that a document's first language must have.
LEAST_LANGUAGE_SHARE = 0.4
#: Near duplicates share at least four fifths of their five-word shingles.
NEAR_GRAM, NEAR_PERCENT = 5, 80


def _aside(docs: DataFrame, names: tuple[str, ...], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """stage(docs), with columns of these names out of its way meanwhile; only the columns of docs are returned."""
    moved = {c: f"_own_{c}" for c in docs.columns if c in names}
    kept = stage(docs.withColumnsRenamed(moved))
    return kept.select(*[F.col(moved.get(c, c)).alias(c) for c in docs.columns])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose quality score is under the classifier's threshold.

    Null and empty texts are scored as texts without words. Repeated rows share one fate; a score at the threshold stays.
    Without labels of both classes no score tells documents apart: all have the same.
    """
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return _aside(docs, ("score", "predicted"), lambda own: quality.score(own, quality.fit(own, labels)).where("predicted = 1"))


def keep_one_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents in which no language is found, or none has LEAST_LANGUAGE_SHARE.

    Texts that are null, empty or without a letter go. Repeated rows share one fate. Languages are learned from the rows at
    hand; if none of them names its language, no document has one.
    """
    small_batches(spark)
    found = (F.col("lang_pred") != language.NO_LANGUAGE) & (F.col("score") >= LEAST_LANGUAGE_SHARE)
    return _aside(docs, ("lang_pred", "score", "shares"), lambda own: language.identify(own, language.fit(own)).where(found))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines found on many sites; a document with no other text goes. n_chars follows the text.

    Null and empty texts have no such lines and stay. Of a line's occurrences that of the smallest doc_id stays, null ids
    last; rows equal in doc_id and text are treated alike. A null source is a site of its own.
    """
    small_batches(spark)

    def cleaned(own: DataFrame) -> DataFrame:
        left = lines.deduplicate(own).where((F.col("n_removed") == 0) | (F.length(F.btrim("text", F.lit(" \t\n\x0b\x0c\r"))) > 0))
        return left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))

    return _aside(docs, ("n_lines", "n_removed"), cleaned)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the smallest doc_id.

    Texts that are null, empty or blank are nobody's duplicates, and rows without doc_id stay. Rows that repeat a doc_id
    are one document: they stay or go together.
    """
    small_batches(spark)
    groups = ngram_join.cluster(docs, NEAR_GRAM, NEAR_PERCENT)
    return docs.join(groups.where("doc_id <> component_id").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as pieces of full token sequences; a null or empty text is its end token, repeated rows are packed each."""
    small_batches(spark)
    specials = packing.special_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, specials)


STAGES = [
    ("quality classifier", keep_good),
    ("language ID", keep_one_language),
    ("line dedup", without_boilerplate),
    ("n-gram Jaccard join", one_of_each_group),
    ("best-fit packing", packed),
]

#: The classifiers' scores cannot be expressed in SQL. Tests compare each stage with a plain loop over its input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage has written goes once its result is a table, and so does the table it started from."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for i, (_, stage) in enumerate(STAGES):
        if i == len(STAGES) - 1:
            return stage(spark, docs, sf_dir)
        with temporaries(spark) as made:
            docs = written(stage(spark, docs, sf_dir))
            kept = made.pop()
        if before:
            delete(spark, before)
        before = kept
    return docs
