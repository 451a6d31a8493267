"""Nearest neighbours by block matrix join.

Vectors and queries are packed into blocks and rounded to int8 steps of each vector's own scale. Every pair of blocks
meets in a task as int8 codes alone. A product tile of the codes gives distances of the rounded vectors, and the lengths
of the rounding errors bound how far each is from the true one. A task walks its share of the vector blocks with each
query's bound so far, and passes on what can be among the nearest. Only of these pairs are the original vectors fetched,
distances computed in double precision, and the results merged by bounded heaps.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import written

BLOCK_VECTORS = 4096
QUERY_BLOCK = 2048
#: The vector blocks that one task walks for a block of queries.
BLOCKS_PER_TASK = 32

_BLOCK = "dim int, block int, ids binary, codes binary, steps binary, errors binary"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, dim, embedding) of the rows that take part, one for each vec_id.

    Null vectors, zero ones and those with a null or non-finite component take no part, nor do rows without vec_id. Of
    rows that repeat a vec_id, the one whose embedding is the least (component by component) counts.
    """
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    rows = written(vectors.select(F.col("vec_id").cast("long"), "embedding").where(F.col("vec_id").isNotNull() & x.isNotNull() & finite & F.exists(x, lambda v: v != 0)))
    repeated = written(rows.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1").select("vec_id"))
    least = rows.join(repeated, "vec_id", "left_semi").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    return rows.join(repeated, "vec_id", "left_anti").unionByName(least).select("vec_id", F.size("embedding").alias("dim"), "embedding")


def _fewer_copies(x: DataFrame, most: int) -> DataFrame:
    """x without rows that ``most`` rows of smaller ids and the same vector stand before: they are nobody's nearest."""
    h = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2")]
    keyed = x.select("*", *h)
    crowded = written(x.select(*h).groupBy("h1", "h2").agg(F.count("*").alias("n")).where(F.col("n") > most).select("h1", "h2"))
    first = keyed.join(crowded, ["h1", "h2"], "left_semi").withColumn("k", F.row_number().over(W.partitionBy("h1", "h2").orderBy("vec_id"))).where(F.col("k") <= most)
    return keyed.join(crowded, ["h1", "h2"], "left_anti").select(*x.columns).unionByName(first.select(*x.columns))


def _lengths(m: np.ndarray) -> np.ndarray:
    """Euclidean lengths of rows, whatever their scale."""
    top = np.maximum(np.abs(m).max(1, initial=0), np.finfo(np.float64).tiny)
    return top * np.sqrt(((m / top[:, None]) ** 2).sum(1))


def quantised(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, the step of each row, and the length of each row's rounding error (a little more, for float error)."""
    step = np.maximum(np.abs(m).max(1) / 127, np.finfo(np.float64).tiny)
    codes = np.clip(np.rint(m / step[:, None]), -127, 127).astype(np.int8)
    return codes, step, _lengths(m - codes * step[:, None]) * (1 + 1e-9) + 1e-12 * _lengths(m)


def _blocks(rows: DataFrame, blocks: int) -> DataFrame:
    """_BLOCK rows: the ids and codes of vectors of one dimension and block."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[tuple[np.ndarray, ...]]] = {}
        for b in batches:
            dims, parts, ids = (b.column(c).to_numpy() for c in ("dim", "block", "vec_id"))
            values, offsets = b.column("embedding").values.to_numpy(), b.column("embedding").offsets.to_numpy()
            for key in set(zip(dims.tolist(), parts.tolist(), strict=True)):
                at = np.flatnonzero((dims == key[0]) & (parts == key[1]))
                held.setdefault(key, []).append((ids[at], *quantised(values[offsets[at][:, None] + np.arange(key[0])].astype(np.float64))))
        for (dim, block), got in held.items():
            ids, codes, steps, errors = (np.concatenate(g) for g in zip(*got, strict=True))
            order = np.argsort(ids, kind="stable")
            yield pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), "block": pa.array([block], pa.int32())} | {c: [v[order].tobytes()] for c, v in (("ids", ids), ("codes", codes), ("steps", steps), ("errors", errors))})

    keyed = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    return keyed.repartitionById(blocks, "block").mapInArrow(pack, _BLOCK)


class Block:
    """The codes of one block of vectors."""

    def __init__(self, dim: int, ids: np.ndarray, codes: np.ndarray, steps: np.ndarray, errors: np.ndarray):
        self.ids, self.codes, self.steps, self.errors = ids, codes.reshape(-1, dim), steps, errors
        self.squares = (self.codes.astype(np.int32) ** 2).sum(1).astype(np.float64)

    @staticmethod
    def of(b: pa.RecordBatch, i: int) -> Block:
        kinds = {"ids": np.int64, "codes": np.int8, "steps": np.float64, "errors": np.float64}
        return Block(b.column("dim")[i].as_py(), *[np.frombuffer(b.column(c)[i].as_buffer(), kind) for c, kind in kinds.items()])


def tile(q: Block, x: Block, limits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs that can be among the nearest, as (query rows, vector rows, low, high) with bounds of the true distance.

    limits (queries x k, ascending) holds each query's smallest upper bounds so far, and takes up those of this tile.
    Bounds are computed in units of the largest step, so that no vector is too long to square.
    """
    unit = max(q.steps.max(), x.steps.max())
    k = limits.shape[1]
    qs, xs = q.steps / unit, x.steps / unit
    x_codes, x_square = x.codes.astype(np.float32), x.squares * xs**2
    for at in range(0, len(q.ids), 256):
        own = slice(at, at + 256)
        # sums of int8 products are whole numbers under 2**24 for up to 1040 dimensions, so exact in float32
        product = q.codes[own].astype(np.float32) @ x_codes.T if x.codes.shape[1] <= 1040 else q.codes[own].astype(np.float64) @ x.codes.T.astype(np.float64)
        q_square = q.squares[own] * qs[own] ** 2
        rounded = np.sqrt(np.maximum(q_square[:, None] + x_square - 2 * product * (qs[own, None] * xs), 0))
        # cancellation in the squares is bounded by the lengths' own rounding
        slack = (q.errors[own] / unit + 1e-7 * np.sqrt(q_square))[:, None] + (x.errors / unit + 1e-7 * np.sqrt(x_square)) + 1e-290
        same = q.ids[own, None] == x.ids
        high = np.where(same, np.inf, (rounded + slack) * unit)
        least = np.partition(high, k - 1, axis=1)[:, :k] if high.shape[1] > k else high
        limits[own] = np.sort(np.concatenate([limits[own], least], axis=1), axis=1)[:, :k]
        low = np.maximum(rounded - slack, 0) * unit
        i, j = np.nonzero((low <= limits[own, -1:]) & ~same)
        yield i + at, j, low[i, j], high[i, j]


def bounded(x: DataFrame, q: DataFrame, k: int, block_vectors: int, query_block: int) -> DataFrame:
    """(query_block, query_id, vec_id, low, high) of all pairs that the bounds of one task's tiles leave open."""
    n_x, n_q = max(1, -(-x.count() // block_vectors)), max(1, -(-q.count() // query_block))
    tasks = -(-n_x // BLOCKS_PER_TASK)
    vectors = _blocks(x, n_x).select(F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))).alias("query_block"), (F.col("block") % tasks).alias("share"), F.lit(1).alias("kind"), "*")
    queries = _blocks(q, n_q).select(F.col("block").alias("query_block"), F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("share"), F.lit(0).alias("kind"), "*")
    met = vectors.unionByName(queries).repartition(n_q * tasks, "query_block", "share").sortWithinPartitions("query_block", "share", "dim", "kind", "block")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, queries, limits = None, None, None
        for b in batches:
            for i in range(b.num_rows):
                key = tuple(b.column(c)[i].as_py() for c in ("query_block", "share", "dim"))
                if b.column("kind")[i].as_py() == 0:
                    now, queries = key, Block.of(b, i)
                    limits = np.full((len(queries.ids), k), np.inf)
                    continue
                if key != now:
                    continue  # no query of this block has that dimension
                vectors = Block.of(b, i)
                for rows, columns, low, high in tile(queries, vectors, limits):
                    if len(rows):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), key[0], np.int32)), pa.array(queries.ids[rows]), pa.array(vectors.ids[columns]), pa.array(low), pa.array(high)], names=["query_block", "query_id", "vec_id", "low", "high"])

    return met.mapInArrow(walk, "query_block int, query_id long, vec_id long, low double, high double")


def surviving(pairs: DataFrame, k: int) -> DataFrame:
    """The pairs whose lower bound is not above the k-th smallest upper bound of their query, read as a sorted stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, seen, limit = None, 0, np.inf
        for b in batches:
            ids, low, high = (b.column(c).to_numpy() for c in ("query_id", "low", "high"))
            keep = np.zeros(b.num_rows, bool)
            cuts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1], [True]))) if b.num_rows else []
            for first, last in zip(cuts[:-1], cuts[1:], strict=True):
                if ids[first] != query:
                    query, seen, limit = ids[first], 0, np.inf
                if seen < k <= seen + last - first:
                    limit = high[first + k - 1 - seen]
                seen += last - first
                keep[first:last] = low[first:last] <= limit
            yield b.filter(pa.array(keep))

    ordered = pairs.repartition("query_id").sortWithinPartitions("query_id", "high", "vec_id")
    return ordered.mapInArrow(run, pairs.schema).select("query_block", "query_id", "vec_id")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, block_vectors: int = BLOCK_VECTORS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): the k nearest by Euclidean distance, ties to the smaller vec_id.

    queries and vectors hold vec_id and embedding (other columns are ignored); a query's own id is not its neighbour.
    usable() tells which rows take part and which of several rows of one vec_id counts; vectors of another dimension
    than the query's are not its neighbours. The result is exact: every vector is compared in a tile, and bounds only
    spare the double-precision step. Empty tables give an empty result.
    """
    x, q = written(usable(vectors)), written(usable(queries))
    open_ = written(surviving(bounded(_fewer_copies(x, k + 1), q, k, block_vectors, query_block), k))
    # a vector that is near to very many queries is fetched once for each block of them
    wanted = open_.select("vec_id", "query_block").distinct()
    fetched = x.join(wanted, "vec_id").select("vec_id", "query_block", F.col("embedding").cast("array<double>").alias("v"))
    both = open_.join(fetched, ["vec_id", "query_block"]).join(q.select(F.col("vec_id").alias("query_id"), F.col("embedding").cast("array<double>").alias("u")), "query_id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = b.column("u").value_lengths().to_numpy()
            u, v, score = b.column("u").flatten().to_numpy(), b.column("v").flatten().to_numpy(), np.zeros(b.num_rows)
            at = np.concatenate(([0], np.cumsum(sizes)))
            for n in np.unique(sizes):
                rows = np.flatnonzero(sizes == n)
                cells = at[rows][:, None] + np.arange(n)
                apart = u[cells] - v[cells]
                direct = np.sqrt((apart**2).sum(1))
                score[rows] = np.where((direct > 1e-100) & (direct < 1e100), direct, _lengths(apart))
            yield pa.RecordBatch.from_arrays([b.column("query_id"), b.column("vec_id"), pa.array(score)], names=["query_id", "vec_id", "score"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, list[tuple[float, int]]] = {}
        for b in batches:
            for query, v, d in zip(*(b.column(c).to_pylist() for c in ("query_id", "vec_id", "score")), strict=True):
                heap = heaps.setdefault(query, [])
                if len(heap) < k:
                    heapq.heappush(heap, (-d, -v))
                elif (-d, -v) > heap[0]:
                    heapq.heapreplace(heap, (-d, -v))
        rows = [(query, rank, -v, -d) for query, heap in sorted(heaps.items()) for rank, (d, v) in enumerate(sorted(heap, reverse=True), 1)]
        for at in range(0, len(rows), 8192):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at : at + 8192], strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.float64()), strict=True)], names=["query_id", "rank", "vec_id", "score"])

    scored = both.select("query_id", "vec_id", "u", "v").mapInArrow(measure, "query_id long, vec_id long, score double")
    return scored.repartition("query_id").mapInArrow(merge, "query_id long, rank int, vec_id long, score double")
