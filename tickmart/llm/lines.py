"""Line deduplication by distinct-site spread, in DataFrame functions only.

One HyperLogLog sketch of sites per line hash is merged by aggregation, so a line on every page costs a task one
sketch. Lines whose estimate is within the sketch's error of the threshold get an exact distinct count. A line found on
enough sites is boilerplate: it stays where it first occurs and goes everywhere else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import written

MIN_SITES = 10
MIN_CHARS = 20
LG_K = 12

_BLANK = " \t\n\x0b\x0c\r"


def _lines(docs: DataFrame) -> DataFrame:
    # hashes come first: beside the generator they would be computed again for each line, and each line carry its text
    once = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.xxhash64(F.coalesce("source", F.lit(""))).alias("site"), F.split("text", "\n").alias("lines"))
    return once.select("doc_id", "text_hash", "site", F.posexplode("lines").alias("pos", "line"))


def _hashed(docs: DataFrame, min_chars: int) -> DataFrame:
    bare = F.btrim("line", F.lit(_BLANK))
    return _lines(docs).where(F.length(bare) >= min_chars).select("doc_id", "text_hash", "site", "pos", F.xxhash64(bare).alias("line_hash"))


def boilerplate_hashes(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """line_hash of every line in lines (line_hash, site) that is on min_sites distinct sites or more, exactly."""
    margin = 3 * 1.04 / 2 ** (lg_k / 2)
    spread = lines.groupBy("line_hash").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("sites"))
    spread = written(spread.where(F.col("sites") >= min_sites * (1 - margin) - 0.5))
    near = F.col("sites") <= min_sites * (1 + margin) + 0.5
    exact = lines.join(spread.where(near).select("line_hash"), "line_hash", "left_semi").groupBy("line_hash", "site").agg(F.count("*").alias("n")).groupBy("line_hash").agg(F.count("*").alias("sites")).where(F.col("sites") >= min_sites)
    return spread.where(~near).select("line_hash").unionByName(exact.select("line_hash"))


def _without(lines: Column, removed: Column) -> Column:
    """The lines but those at the removed places (in order): what lies between them is copied run by run, each line once."""

    def run(every: Column, k: Column) -> Column:
        first = F.when(k == 0, 0).otherwise(F.get(removed, k - 1) + 1)
        return F.slice(every, first + 1, F.coalesce(F.get(removed, k), F.size(every)) - first)

    runs = lambda every: F.flatten(F.transform(F.sequence(F.lit(0), F.size(removed)), lambda k: run(every, k)))
    # in an array of one, so that the text is split once
    return F.array_join(F.get(F.transform(F.array(lines), runs), F.lit(0)), "\n")


def deduplicate(docs: DataFrame, min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS) -> DataFrame:
    """docs (doc_id, text, source, ...) with the text of each row without boilerplate, and n_lines and n_removed (long).

    Lines are compared without surrounding white space; lines under min_chars characters are never boilerplate. A null
    source is a site of its own. Of a boilerplate line the occurrence in the smallest doc_id (null ids last), at the
    smallest place, stays. Rows equal in doc_id and text are treated alike. A null text stays null, with no lines.
    """
    docs = docs.drop("n_lines", "n_removed")
    lines = _hashed(docs, min_chars)
    hits = written(lines.join(written(boilerplate_hashes(lines, min_sites)), "line_hash", "left_semi").select("line_hash", "doc_id", "text_hash", "pos"))
    place: Column = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "pos")
    first = hits.groupBy("line_hash").agg(F.min(place).alias("place"))
    gone = hits.withColumn("place", place).join(first, ["line_hash", "place"], "left_anti")
    removed = gone.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("_removed"))
    removed = removed.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "_removed")
    found = docs.join(removed, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash")), "left")
    count = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long")
    kept = F.when(F.col("_removed").isNull(), F.col("text")).otherwise(_without(F.split("text", "\n"), F.col("_removed")))
    return found.select(*[kept.alias(c) if c == "text" else F.col(c) for c in docs.columns], count.alias("n_lines"), F.coalesce(F.size("_removed"), F.lit(0)).cast("long").alias("n_removed"))
