"""A Bloom filter for each file of stored keys, so that a batch opens only the files that may hold its keys.

A filter has BITS bits for a key and answers for HASHES places; about 1 in 1,000 keys that are not in a file seem to be.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS, HASHES = 16, 6


def _places(keys: np.ndarray, size: int) -> np.ndarray:
    """The bits of each key in a filter of so many bits."""
    x = keys.astype(np.uint64)[:, None] + np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) % np.uint64(size)


def bloom(keys: np.ndarray) -> bytes:
    """The filter of 64-bit keys."""
    bits = np.zeros(8 * max(8, -(-len(keys) * BITS // 8)), bool)
    bits[_places(keys, len(bits)).ravel()] = True
    return np.packbits(bits).tobytes()


def may_hold(content: bytes, keys: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(content, np.uint8)).astype(bool)
    return bits[_places(keys, len(bits))].all(1)


def filters(keys: DataFrame) -> DataFrame:
    """(bucket, n, bloom) for each bucket of keys (bucket, hash): a group has the hashes of one batch and bucket."""

    def make(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        hashes = rows.column("hash").to_numpy().view(np.uint64)
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "n": pa.array([len(hashes)], pa.int64()), "bloom": pa.array([bloom(hashes)], pa.binary())})

    return keys.select("bucket", "hash").groupBy("bucket").applyInArrow(make, "bucket int, n bigint, bloom binary")


def files_for(keys: DataFrame, index: DataFrame) -> DataFrame:
    """(batch_id, bucket) of the files in index (batch_id, bucket, bloom) that may hold one of keys (bucket, hash)."""

    def test(left: pa.Table, right: pa.Table) -> pa.Table:
        own = left.column("hash").to_numpy().view(np.uint64)
        hit = [bool(len(own)) and bool(may_hold(b.as_py(), own).any()) for b in right.column("bloom")]
        return right.select(["batch_id", "_bucket"]).rename_columns(["batch_id", "bucket"]).filter(pa.array(hit, pa.bool_()))

    test.__annotations__ = {"left": pa.Table, "right": pa.Table, "return": pa.Table}
    stored = index.select("batch_id", F.col("bucket").alias("_bucket"), "bloom")
    return keys.select("bucket", "hash").groupBy("bucket").cogroup(stored.groupBy("_bucket")).applyInArrow(test, "batch_id bigint, bucket int")
