"""Merkle manifest of a dataset: checkpoints of a hash tree, and proofs recomputed from them.

Nodes of every third level are stored, and nothing between. A node's proof is put together top down: each aligned subtree
of a stored level is read once, its missing levels are regenerated from the nodes stored below it, the siblings of each of
these nodes go in front of the path of the subtree's root, and what was regenerated is dropped. All hashing of a subtree
happens in the task that has its (at most 512) nodes, so neither a language of any size nor a tree of any height meets in
one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import written

#: Children of a node, and levels between stored ones.
FANOUT, STEP = 8, 3
SUBTREE = FANOUT**STEP
#: So few rows of counts (one for each task and tree) are broadcast.
FEW_COUNTS = 200_000

_PATH = T.ArrayType(T.StructType([T.StructField("before", T.StringType()), T.StructField("after", T.StringType())]))
_ARROW_PATH = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def leaf_digest(*values: Column) -> Column:
    """SHA-256 of the values in order, each as its UTF-8 byte count, a colon and its text, or - for null."""
    text = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text]), 256)


def numbered(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """rows with pos, from 0 in each tree by order, and size, the rows of the tree.

    Rows are sorted by ranges; each task's first place in a tree is the sum of what the tasks before it have of the tree. Rows
    equal in everything keep some order, by a number that says where they were read.
    """
    own = rows.columns
    placed = rows.withColumn("_copy", F.monotonically_increasing_id())
    by = [tree, *order, "_copy"]
    stored = written(placed.repartitionByRange(*by).sortWithinPartitions(*by).select(*own, F.monotonically_increasing_id().alias("_id")))
    task = F.shiftright("_id", 33).alias("_task")
    parts = stored.groupBy(F.col(tree).alias("_tree"), task).agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    whole = W.partitionBy("_tree")
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_task").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = written(parts.select("_tree", "_task", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("size")))
    offsets = F.broadcast(offsets) if offsets.count() <= FEW_COUNTS else offsets
    found = stored.withColumn("_at", task).join(offsets, F.col(tree).eqNullSafe(F.col("_tree")) & (F.col("_at") == F.col("_task")))
    return found.select(*own, (F.col("_id") + F.col("_shift")).alias("pos"), "size")


def _levels(digests: list[str]) -> list[list[str]]:
    """digests and the levels above them, STEP at most, up to a single node that is all there is."""
    made = [digests]
    while len(made) <= STEP and len(made[-1]) > 1:
        below = made[-1]
        made.append([hashlib.sha256("".join(below[i : i + FANOUT]).encode()).hexdigest() for i in range(0, len(below), FANOUT)])
    return made


def _top(digests: list[str], whole: bool) -> list[list[str]]:
    """_levels() of a subtree. One that is not its whole tree has STEP levels above its nodes, even if it has one node."""
    made = _levels(digests)
    while not whole and len(made) <= STEP:
        made.append([hashlib.sha256(made[-1][0].encode()).hexdigest()])
    return made


def _subtrees(nodes: DataFrame, tree: str, extra: list[str] = ()) -> DataFrame:
    """(tree, size, block, nodes): the nodes (pos, digest, extra) of each aligned subtree in order. size is that of the level."""
    block = F.floor(F.col("pos") / SUBTREE).alias("block")
    return nodes.groupBy(tree, "size", block).agg(F.array_sort(F.collect_list(F.struct("pos", "digest", *extra))).alias("nodes"))


@dataclass(frozen=True)
class Manifest:
    """levels[k] has the nodes (tree, pos, size, digest) of level STEP * k, of the trees that are that high; size is the
    number of the tree's nodes there. roots (tree, digest) has the root of every tree."""

    tree: str
    levels: tuple[DataFrame, ...]
    roots: DataFrame


def build(leaves: DataFrame, tree: str) -> Manifest:
    """The manifest of leaves (tree, pos, size, digest, ...) of numbered(). Every level kept is a written table.

    A tree of one leaf has that as its root. Without leaves there are no levels above and no roots.
    """
    levels, roots, now = [leaves], [], leaves
    kind = leaves.schema[tree].dataType
    schema = T.StructType([T.StructField(tree, kind), T.StructField("size", T.LongType()), T.StructField("block", T.LongType()), T.StructField("digest", T.StringType())])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, nodes = b.column("size").to_pylist(), b.column("nodes")
            found = [_top(nodes[i].values.field("digest").to_pylist(), n <= SUBTREE)[-1][0] for i, n in enumerate(sizes)]
            yield pa.RecordBatch.from_arrays([b.column(tree), b.column("size"), b.column("block"), pa.array(found, pa.string())], names=[tree, "size", "block", "digest"])

    while True:
        above = written(_subtrees(now, tree).mapInArrow(close, schema))
        roots.append(above.where(F.col("size") <= SUBTREE).select(tree, "digest"))
        taller = above.where(F.col("size") > SUBTREE)
        if taller.isEmpty():
            break
        now = taller.select(tree, F.col("block").alias("pos"), F.ceil(F.col("size") / SUBTREE).alias("size"), "digest")
        levels.append(now)
    every = roots[0]
    for more in roots[1:]:
        every = every.unionByName(more)
    return Manifest(tree, tuple(levels), every)


def proofs(manifest: Manifest, tops: DataFrame, extra: list[str] = ()) -> DataFrame:
    """(tree, pos, digest, extra, subroot and what else tops has, path) for every leaf of the manifest.

    tops (tree, path, ...) has for each tree the path from its root upwards. A path has for each level the siblings (digests
    in one text) before and after the node; folded() climbs it.
    """
    tree, more = manifest.tree, [c for c in tops.columns if c not in (manifest.tree, "path")]
    tops = tops.withColumnRenamed(tree, "_tree")
    found: DataFrame | None = None
    for k in range(len(manifest.levels) - 1, -1, -1):
        carried = list(extra) if k == 0 else []
        blocks = _subtrees(manifest.levels[k], tree, carried)
        # a subtree that is its whole tree continues with the tree's own path, another one with that of the node above it
        whole = blocks.where(F.col("size") <= SUBTREE).join(tops, F.col(tree).eqNullSafe(F.col("_tree"))).drop("_tree")
        if found is not None:
            above = found.select(F.col(tree).alias("_tree"), F.col("pos").alias("_pos"), *more, "path")
            part = blocks.where(F.col("size") > SUBTREE).join(above, F.col(tree).eqNullSafe(F.col("_tree")) & (F.col("block") == F.col("_pos"))).drop("_tree", "_pos")
            whole = whole.unionByName(part)
        found = _extended(whole, tree, manifest.levels[k], carried, more)
        if k:
            found = written(found)
    return found


def _extended(blocks: DataFrame, tree: str, level: DataFrame, extra: list[str], more: list[str]) -> DataFrame:
    """(tree, pos, digest, extra, more, path) of every node of blocks (..., path of the subtree's root)."""
    kinds = {f.name: f.dataType for f in [*level.schema.fields, *blocks.schema.fields]}
    own = ["pos", "digest", *extra]
    schema = T.StructType([T.StructField(tree, kinds[tree]), *[T.StructField(c, kinds[c]) for c in (*own, *more)], T.StructField("path", _PATH)])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                nodes = b.column("nodes")[i].values
                made = _top(nodes.field("digest").to_pylist(), b.column("size")[i].as_py() <= SUBTREE)
                upper, paths = b.column("path")[i].as_py(), []
                for at in range(len(nodes)):
                    path, p = [], at
                    for level_ in made[:-1]:
                        first = p // FANOUT * FANOUT
                        path.append({"before": "".join(level_[first:p]), "after": "".join(level_[p + 1 : first + FANOUT])})
                        p //= FANOUT
                    paths.append(path + upper)
                same = [pa.repeat(b.column(c)[i], len(nodes)) for c in (tree, *more)]
                yield pa.RecordBatch.from_arrays([same[0], *[nodes.field(c) for c in own], *same[1:], pa.array(paths, _ARROW_PATH)], names=[tree, *own, *more, "path"])

    return blocks.select(tree, "size", "nodes", *more, "path").mapInArrow(extract, schema)


def folded(digest: Column, path: str = "path") -> Column:
    """The root that a leaf's digest and its path give."""
    return F.aggregate(path, digest, lambda node, level: F.sha2(F.concat(level["before"], node, level["after"]), 256))


def siblings(path: str = "path") -> Column:
    """All digests of a path in one text, level by level, left to right."""
    return F.array_join(F.transform(path, lambda level: F.concat(level["before"], level["after"])), "")


def manifest_of(docs: DataFrame, leaf: Column, tree: str, order: list[str], extra: dict[str, Column] | None = None) -> tuple[Manifest, DataFrame]:
    """(manifest, proofs) of docs: a tree for each value of the column tree (null is one), and one tree over their roots.

    proofs has for each row tree, order, leaf, the columns extra, subroot, root and path. Rows equal in tree and order are
    in order of their leaves, nulls come first.
    """
    extra = extra or {}
    rows = written(docs.select(F.col(tree).alias("tree"), *order, leaf.alias("digest"), *[c.alias(name) for name, c in extra.items()]))
    kept = [*order, *extra]
    base = build(numbered(rows, "tree", [*order, "digest", *extra]), "tree")
    upper = build(numbered(base.roots.select(F.lit(0).alias("all"), F.col("tree"), "digest"), "all", ["tree"]), "all")
    root = upper.roots.select("all", F.col("digest").alias("root"), F.array().cast(_PATH).alias("path"))
    tops = written(proofs(upper, root, ["tree"]).select("tree", F.col("digest").alias("subroot"), "root", "path"))
    return base, proofs(base, tops, kept).withColumnRenamed("digest", "leaf")


def documents_manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of docs (doc_id, source, lang, n_chars, text, ...).

    A leaf is a document's five columns, a tree a language. Where 3 divides the CRC-32 of doc_id, the text is tampered with
    (A-Z in lower case) before its leaf is folded; a text without such letters, and a row without doc_id, verifies. Repeated
    rows are a leaf each. An empty table gives no rows.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.translate("text", upper, lower)).otherwise(F.col("text"))
    leaf = lambda text: leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)
    _, found = manifest_of(docs, leaf(F.col("text")), "lang", ["doc_id"], {"claimed": leaf(tampered)})
    checked = found.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(), 256).alias("proof_sha256"), folded(F.col("claimed")).alias("folded_root"))
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))
