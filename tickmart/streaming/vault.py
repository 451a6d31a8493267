"""Streaming ingest into the vault with Structured Streaming.

A batch's data, keys, key filters, dead letters and manifest go to folders named by its number and overwrite what an earlier
try of the same batch left, so a retried batch neither loses nor repeats events. A batch's mark is written last; readers of
committed() see whole batches only.

Batches land in a few files each. compact() moves the rows of whole batches into hourly folders, a generation at a time,
whose mark says which batches it covers: until that is there, readers take these from where they landed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.ingest import dead_letters, dedup_events, flat_envelopes, parse_envelopes, split_envelopes, to_connection_events, to_market_ticks, validate_envelopes, with_details
from ..operators.manifest import FOLDERS, REGISTRY_KEYS, partition_registry, with_partition
from ..sources.scratch import exists
from ..sources.session import prepare
from ..sources.staging import by_folder
from . import keyindex

#: The tables of events.
EVENTS = ("market_ticks", "connection_events")
#: Stored keys lie in so many buckets by their hash; a file has the keys of a batch and bucket.
KEY_BUCKETS = 64
#: A batch of no more events than this broadcasts its keys, so that the keys of earlier batches are not shuffled.
FEW_EVENTS = 200_000
#: Key files that are named one by one; of more, all batches and buckets that occur among them are read.
FEW_FILES = 1000
#: Rows of a file that a batch lands in.
LANDED_ROWS = 1_000_000


def recent_events(messages: DataFrame, watermark: str = "1 hour", provider: str = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider") -> DataFrame:
    """Valid events of a stream with event_time, each dedup_key once: keys are kept in keyed state for the watermark's length.

    Events older than the watermark are dropped, copies and others alike; so state is bounded by the keys of that length. A
    null event_ts_ms is dropped, too. State lies in the provider's store, on disk for the default one; which it is is a setting
    of the session, and stays.
    """
    spark = messages.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
    events, _ = validate_envelopes(parse_envelopes(messages))
    timed = events.withColumn("event_time", F.timestamp_millis(F.col("event_ts_ms").cast("long"))).where("event_time is not null")
    return timed.withColumn("dedup_key", F.trim("dedup_key")).withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(["dedup_key"])


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What earlier batches have stored below path; empty before the first."""
    if not exists(spark, path):
        return spark.createDataFrame([], f"{schema}, batch_id bigint")
    return spark.read.schema(f"{schema}, batch_id bigint").parquet(path)


def _marks(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id) of the batches that are complete."""
    return _stored(spark, f"{path}/commits", "layer string").select("batch_id")


def _generations(spark: SparkSession, path: str) -> DataFrame:
    """(gen, batch_id): the batches that each complete generation covers."""
    if not exists(spark, f"{path}/generations"):
        return spark.createDataFrame([], "batch_id bigint, gen bigint")
    return spark.read.schema("batch_id bigint, gen bigint").parquet(f"{path}/generations")


def committed(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """The rows of a table of the vault (schema names its columns and folders), of batches that are complete.

    Marks of batches and generations are small tables, of a row for each batch: they are broadcast, since rows dealt by
    batch would meet in a task for each.
    """
    covered = _generations(spark, path)
    landed = _stored(spark, f"{path}/{name}", schema).join(F.broadcast(_marks(spark, path)), "batch_id", "left_semi").join(F.broadcast(covered), "batch_id", "left_anti")
    if not exists(spark, f"{path}/compacted/{name}"):
        return landed
    moved = spark.read.schema(f"{schema}, batch_id bigint, gen bigint").parquet(f"{path}/compacted/{name}")
    return landed.unionByName(moved.join(F.broadcast(covered.select("gen").distinct()), "gen", "left_semi").select(*landed.columns))


def compact(spark: SparkSession, path: str) -> int | None:
    """Move the rows of all complete batches not yet covered into hourly folders, as a new generation; its number, if there is one.

    A generation that was stopped before its mark is written over by the next. Files of covered batches may be deleted.
    """
    prepare(spark)
    covered = _generations(spark, path)
    fresh = _marks(spark, path).join(covered, "batch_id", "left_anti").distinct().persist()
    try:
        if fresh.isEmpty():
            return None
        gen = (covered.agg(F.max("gen")).first()[0] or 0) + 1
        for name in EVENTS:
            if exists(spark, f"{path}/{name}"):
                rows = spark.read.parquet(f"{path}/{name}").join(F.broadcast(fresh), "batch_id", "left_semi")  # a number for each batch
                by_folder(rows, rows.count()).write.mode("overwrite").partitionBy(*FOLDERS).parquet(f"{path}/compacted/{name}/gen={gen}")
        fresh.coalesce(1).write.mode("overwrite").parquet(f"{path}/generations/gen={gen}")
        return gen
    finally:
        fresh.unpersist()


def _hashed(events: DataFrame) -> DataFrame:
    key = F.trim("dedup_key")
    return events.select(key.alias("dedup_key"), F.xxhash64(key).alias("hash")).withColumn("bucket", F.pmod(F.col("hash"), F.lit(KEY_BUCKETS)).cast("int"))


def key_history(spark: SparkSession, path: str, keys: DataFrame, batch_id: int) -> DataFrame:
    """(dedup_key, bucket, batch_id) of the stored files of batches before batch_id that may hold one of keys (bucket, hash).

    The filters of all files are looked at, two bytes for each key ever stored; keys themselves only where a filter says so.
    """
    stored = _stored(spark, f"{path}/keys", "dedup_key string, bucket int").where(F.col("batch_id") < batch_id)
    index = _stored(spark, f"{path}/key_index", "bucket int, n bigint, bloom binary").where(F.col("batch_id") < batch_id)
    hits = keyindex.files_for(keys, index).persist()
    try:
        found = hits.limit(FEW_FILES + 1).collect()
        if len(found) <= FEW_FILES:
            return stored.where(F.struct("batch_id", "bucket").isin([F.struct(F.lit(r["batch_id"]).cast("long"), F.lit(r["bucket"])) for r in found])) if found else stored.where("false")
        buckets = [r["bucket"] for r in hits.select("bucket").distinct().collect()]  # at most KEY_BUCKETS numbers
        return stored.where(F.col("bucket").isin(buckets)).join(F.broadcast(hits.select("batch_id").distinct()), "batch_id", "left_semi")  # a number for each batch
    finally:
        hits.unpersist()


def _unseen(events: DataFrame, path: str, batch_id: int) -> DataFrame:
    """Events whose key no earlier batch has stored."""
    keys = _hashed(events)
    stored = key_history(events.sparkSession, path, keys, batch_id)
    own = F.broadcast(keys) if keys.count() <= FEW_EVENTS else keys
    again = stored.join(own.select("dedup_key"), "dedup_key", "left_semi").select(F.col("dedup_key").alias("_seen")).distinct()
    return events.join(again, F.trim("dedup_key") == F.col("_seen"), "left_anti")


def ingest_batch(messages: DataFrame, batch_id: int, path: str, layer: str = "raw", source_stream: str = "stream") -> None:
    """One batch of messages (stream_id, event_json): keys that any earlier batch has stored are skipped, for ever."""
    spark = messages.sparkSession
    prepare(spark)
    flat = flat_envelopes(parse_envelopes(messages)).persist()  # parsed once, for events and dead letters
    events, failed = split_envelopes(flat)
    once, later = dedup_events(events), exists(spark, f"{path}/keys")
    if later:
        once.persist()
    fresh = with_details(_unseen(once, path, batch_id) if later else once).persist()  # nothing is stored before the first batch
    n, ticks, conn = fresh.count(), to_market_ticks(fresh), to_connection_events(fresh)
    try:
        dead_letters(failed, source_stream).write.mode("overwrite").parquet(f"{path}/dead_letters/batch_id={batch_id}")
        for df in (once, flat):
            df.unpersist()
        for name, rows in zip(EVENTS, (ticks, conn), strict=True):
            placed = with_partition(rows, layer).repartition(-(-n // LANDED_ROWS) or 1, *FOLDERS).sortWithinPartitions(*FOLDERS)
            placed.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")
        partition_registry(ticks, conn, layer).write.mode("overwrite").parquet(f"{path}/manifest/batch_id={batch_id}")
        keys = _hashed(fresh)
        keys.select("dedup_key", "bucket").repartition(min(KEY_BUCKETS, spark.sparkContext.defaultParallelism), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/keys/batch_id={batch_id}")
        keyindex.filters(keys).write.mode("overwrite").parquet(f"{path}/key_index/batch_id={batch_id}")  # by the tasks that make them
        spark.createDataFrame([(layer,)], "layer string").coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/batch_id={batch_id}")
    finally:
        for df in (fresh, once, flat):
            df.unpersist()


def start_ingest(messages: DataFrame, path: str, layer: str = "raw") -> StreamingQuery:
    """Run a stream of messages through ingest_batch() until what is available is done."""
    return messages.writeStream.foreachBatch(lambda df, n: ingest_batch(df, n, path, layer)).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The registry over all complete batches."""
    parts = _stored(spark, f"{path}/manifest", "partition_id string, layer string, exchange_id string, ts_min_epoch_s bigint, ts_max_epoch_s bigint, row_count bigint").join(_marks(spark, path), "batch_id", "left_semi")
    return parts.groupBy(*REGISTRY_KEYS).agg(F.min("ts_min_epoch_s").alias("ts_min_epoch_s"), F.max("ts_max_epoch_s").alias("ts_max_epoch_s"), F.sum("row_count").alias("row_count"))
