"""Boosted regression trees on histograms, one model for each slot (pair and horizon) and fold.

A tree is a complete binary tree in arrays: the children of node i are 2i + 1 and 2i + 2, and a node that is not split sends
all to its left. Trees grow level by level from histograms of residuals, and keep the splits that a best-first search for so
many leaves would take.

Two plans give the same trees. A slot of at most task_rows rows is grown in one task. A longer one lies in packed blocks of
rows all over the cluster: for each level of a tree every task adds up histograms of its blocks, these are merged for each
model by an aggregation, which picks the splits, and only splits reach the driver. No task holds such a slot, and none of
its rows is left out.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written
from .features import PAIR

SLOT = (*PAIR, "horizon_steps")
_SLOT_TYPES = (pa.string(), pa.string(), pa.int32())


@dataclass(frozen=True)
class Params:
    """task_rows: the most rows of a slot that one task grows. edge_rows: bins come from about so many rows of a longer slot.

    block_rows and wave bound what a task has at once: rows of a block, and models that grow side by side.
    """

    rounds: int = 300
    rate: float = 0.05
    depth: int = 6
    leaves: int = 31
    min_leaf: int = 20
    bins: int = 255
    task_rows: int = 500_000
    edge_rows: int = 200_000
    block_rows: int = 1 << 16
    wave: int = 64

    @property
    def inner(self) -> int:
        return 2**self.depth - 1


# a tree


def edges_of(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """The cuts of each feature: its quantiles, or fewer where these repeat."""
    return [np.unique(q) for q in np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], axis=0).T]


def cells_of(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """The bin of each value: the number of cuts below it."""
    kind = np.uint8 if max((len(e) for e in edges), default=0) < 256 else np.uint16
    return np.column_stack([np.searchsorted(e, x[:, j], "left").astype(kind) for j, e in enumerate(edges)]) if len(edges) else np.zeros((len(x), 0), kind)


class Tree:
    """A tree that grows by levels, from histograms (node, feature, bin); widths are the bins of each feature."""

    def __init__(self, widths: np.ndarray, params: Params) -> None:
        self.params, self.level = params, 0
        self.shape = (len(widths), int(widths.max()))
        self.feature, self.cut, self.gain = np.zeros(params.inner, np.int32), np.full(params.inner, -1), np.zeros(params.inner)
        self.n, self.sum = np.zeros(2 * params.inner + 1), np.zeros(2 * params.inner + 1)
        self.open = np.array([0])
        # a feature's last bin has no cut above it
        self.barred = np.arange(self.shape[1]) >= widths[:, None] - 1

    def grow(self, many: np.ndarray, sums: np.ndarray) -> bool:
        """Split the open nodes by their histograms; whether any node may be split further."""
        shape = (len(self.open), *self.shape)
        left_n, left_sum = many.reshape(shape).cumsum(2, np.float64), sums.reshape(shape).cumsum(2)
        if not self.level:
            self.n[0], self.sum[0] = left_n[0, 0, -1], left_sum[0, 0, -1]
        n_all, s_all = self.n[self.open][:, None, None], self.sum[self.open][:, None, None]
        right_n, right_sum = n_all - left_n, s_all - left_sum
        barred = (left_n < self.params.min_leaf) | (right_n < self.params.min_leaf) | self.barred
        gain, other = left_sum * left_sum, right_sum * right_sum
        gain /= np.maximum(left_n, 1)
        other /= np.maximum(right_n, 1)
        gain += other
        gain -= s_all**2 / n_all
        gain[barred] = 0
        left_n, left_sum, right_n, right_sum, gain = (a.reshape(len(self.open), -1) for a in (left_n, left_sum, right_n, right_sum, gain))
        best = gain.argmax(1)
        take = np.flatnonzero(gain[np.arange(len(best)), best] > 1e-12 * (1 + np.abs(s_all[:, 0, 0])))
        node, best = self.open[take], best[take]
        self.feature[node], self.cut[node], self.gain[node] = best // self.shape[1], best % self.shape[1], gain[take, best]
        for side, (n, s) in enumerate(((left_n, left_sum), (right_n, right_sum)), 1):
            self.n[2 * node + side], self.sum[2 * node + side] = n[take, best], s[take, best]
        self.level += 1
        children = np.sort(np.concatenate([2 * node + 1, 2 * node + 2]))
        self.open = children[self.n[children] >= 2 * self.params.min_leaf] if self.level < self.params.depth else children[:0]
        return len(self.open) > 0

    def close(self) -> np.ndarray:
        """Keep the splits of a best-first search for params.leaves leaves; the leaves' values."""
        params, kept, leaves = self.params, set(), 1
        front = [(-self.gain[0], 0)] if self.cut[0] >= 0 else []
        while front and leaves < params.leaves:
            _, i = heapq.heappop(front)
            kept.add(i)
            leaves += 1
            for c in (2 * i + 1, 2 * i + 2):
                if c < params.inner and self.cut[c] >= 0:
                    heapq.heappush(front, (-self.gain[c], c))
        drop = [i for i in range(params.inner) if i not in kept]
        self.feature[drop], self.cut[drop] = 0, -1
        value = np.zeros(params.inner + 1)
        ends = [0]
        while ends:
            i = ends.pop()
            if i < params.inner and self.cut[i] >= 0:
                ends += [2 * i + 1, 2 * i + 2]
            else:
                v = params.rate * self.sum[i] / max(self.n[i], 1)
                while i < params.inner:
                    i = 2 * i + 1
                value[i - params.inner] = v
        return value

    def threshold(self, edges: list[np.ndarray]) -> np.ndarray:
        return np.array([edges[f][c] if c >= 0 else np.inf for f, c in zip(self.feature, self.cut, strict=True)])


def _down(cells: np.ndarray, node: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The children that rows at nodes go to; a node without a cut sends all to its left."""
    at = cut[node]
    return 2 * node + 1 + ((cells[np.arange(len(node)), feature[node]] > at) & (at >= 0))


def _leaf_of(cells: np.ndarray, feature: np.ndarray, cut: np.ndarray, inner: int) -> np.ndarray:
    node = np.zeros(len(cells), np.int64)
    while len(node) and node[0] < inner:
        node = _down(cells, node, feature, cut)
    return node - inner


def _histogram(flat: np.ndarray, rest: np.ndarray, node: np.ndarray, open_: np.ndarray, shape: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(rows, sums of rest) in each bin of each open node. flat has for each row the places of its bins in a histogram."""
    place = np.full(int(open_.max()) + 1, -1)
    place[open_] = np.arange(len(open_))
    at = np.where(node < len(place), place[np.minimum(node, len(place) - 1)], -1)
    rows = np.flatnonzero(at >= 0)
    if len(rows) < len(at):
        at, flat, rest = at[rows], flat[rows], rest[rows]
    size = shape[0] * shape[1]
    spots = (at[:, None] * size + flat).ravel()
    return np.bincount(spots, minlength=len(open_) * size), np.bincount(spots, np.repeat(rest, flat.shape[1]), len(open_) * size)


def grow(x: np.ndarray, y: np.ndarray, params: Params) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """(base, feature, threshold, leaf) of trees for the squared loss; a row goes right if its feature is above the threshold."""
    if not len(x):
        raise ValueError("no rows to learn from")
    edges = edges_of(x, params.bins)
    cells, widths = cells_of(x, edges), np.array([len(e) + 1 for e in edges])
    flat = cells + np.arange(len(widths)) * widths.max()
    base, out = float(y.mean()), []
    total = np.full(len(y), base)
    for _ in range(params.rounds):
        tree, rest, node, growing = Tree(widths, params), y - total, np.zeros(len(y), np.int64), True
        while growing:
            growing = tree.grow(*_histogram(flat, rest, node, tree.open, tree.shape))
            node = _down(cells, node, tree.feature, tree.cut) if growing else node
        leaf = tree.close()
        total += leaf[_leaf_of(cells, tree.feature, tree.cut, params.inner)]
        out.append((tree.feature, tree.threshold(edges), leaf))
    return base, *(np.array(c).reshape(params.rounds, -1) for c in zip(*out, strict=True))


def predict(x: np.ndarray, base: float, feature: np.ndarray, threshold: np.ndarray, leaf: np.ndarray) -> np.ndarray:
    total, rows, inner = np.full(len(x), base), np.arange(len(x)), feature.shape[1]
    for t in range(len(feature)):
        node = np.zeros(len(x), np.int64)
        while node.size and node[0] < inner:
            node = 2 * node + 1 + (x[rows, feature[t, node]] > threshold[t, node])
        total += leaf[t, node - inner]
    return total


_MODEL = {"base": pa.float64(), "feature": pa.list_(pa.int32()), "threshold": pa.list_(pa.float64()), "leaf": pa.list_(pa.float64()), "train_rows": pa.int64(), "error": pa.string()}
_CHECK = {"fold": pa.int32(), "bucket_epoch_s": pa.int64(), "actual": pa.float64(), "predicted_price": pa.float64()}
_OUT = "exchange_id string, symbol string, horizon_steps int, base double, feature array<int>, threshold array<double>, leaf array<double>, train_rows bigint, error string, fold int, bucket_epoch_s bigint, actual double, predicted_price double"


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """An array column as a matrix, without a Python object for each number."""
    flat = [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]
    return np.concatenate(flat or [np.zeros(0)]).astype(np.float64, copy=False).reshape(len(column), -1)


def _label() -> Column:
    """The relative change to the target; null where there is none."""
    return F.try_divide(F.col("target"), F.col("price")) - 1.0


def fit_slots(table: DataFrame, params: Params = Params()) -> DataFrame:
    """Fits and checks of every slot in table (slot, x, price, target, is_train, fold, row, slot_rows).

    x are features relative to the price (see models.relative_design), and the label is the relative change to the target.
    fold 0 is fitted on all training rows; fold k is fitted on the rows before those that it validates. A slot gives one
    model row (actual is null; error tells why there is no model) and a row with predicted_price for each validated row
    (fold k) and each held-out row (fold 0). A slot that fails is a row with its error, not a failed job. row numbers a slot's
    rows in order from 1, slot_rows is how many there are.
    """
    typed = table.select(*[F.col(c).cast("int") if c == "horizon_steps" else c for c in SLOT], "bucket_epoch_s", "x", F.col("price").cast("double"), F.col("target").cast("double"), "is_train", F.col("fold").cast("int"), "row", "slot_rows")
    in_tasks = _fit_in_tasks(typed.where(F.col("slot_rows") <= params.task_rows), params)
    long = typed.where(F.col("slot_rows") > params.task_rows)
    return in_tasks if long.isEmpty() else in_tasks.unionByName(_fit_in_blocks(long, params))


def _fit_in_tasks(table: DataFrame, params: Params) -> DataFrame:
    def fit(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)).sort_by("bucket_epoch_s")

        def out(n: int, values: dict[str, list | np.ndarray]) -> pa.RecordBatch:
            columns = {c: values.get(c, [None] * n) for c in (*_MODEL, *_CHECK)}
            return pa.RecordBatch.from_arrays([*[pa.array([k.as_py()] * n, t) for k, t in zip(key, _SLOT_TYPES, strict=True)], *[pa.array(columns[c], t) for c, t in (_MODEL | _CHECK).items()]], names=[*SLOT, *columns])

        try:
            price, target, train, fold = (rows.column(c).to_numpy() for c in ("price", "target", "is_train", "fold"))
            x, label = _matrix(rows.column("x")), target / price - 1
            if not (np.isfinite(x).all() and np.isfinite(label).all()):
                raise ValueError("features or targets that are not finite")
            for k in sorted({0, *fold[train & (fold > 0)].tolist()}):
                learn, check = (train, ~train) if k == 0 else (train & (fold < k), train & (fold == k))
                model = grow(x[learn], label[learn], params)
                if k == 0:
                    yield out(1, {"base": [model[0]], **{c: [m.ravel()] for c, m in zip(("feature", "threshold", "leaf"), model[1:], strict=True)}, "train_rows": [int(learn.sum())], "fold": [0]})
                if check.any():
                    n = int(check.sum())
                    yield out(n, {"fold": np.full(n, k, np.int32), "bucket_epoch_s": rows.column("bucket_epoch_s").to_numpy()[check], "actual": target[check], "predicted_price": price[check] * (1 + predict(x[check], *model))})
        except Exception as e:  # whatever it is, it is this slot's own
            yield out(1, {"error": [f"{type(e).__name__}: {e}"], "fold": [0]})

    fit.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return table.drop("row", "slot_rows").groupBy(*SLOT).applyInArrow(fit, _OUT)


# slots of more rows than a task grows

_OWN = (*SLOT, "model")
#: After so many trees the rows' predictions are stored; in between, tasks add up the trees since.
_KEEP = 10


def _learning(long: DataFrame) -> DataFrame:
    """Rows of long with model: 0, and each fold that learns from the row."""
    folds = long.where("is_train").groupBy(*SLOT).agg(F.max("fold").alias("_folds"))
    later = F.when(F.col("fold") < F.col("_folds"), F.sequence(F.col("fold") + 1, F.col("_folds"))).otherwise(F.array())
    return long.where("is_train").join(folds, list(SLOT)).withColumn("model", F.explode(F.concat(F.array(F.lit(0)), later))).withColumn("label", _label())


def _edges(rows: DataFrame, models: DataFrame, params: Params) -> DataFrame:
    """(slot, model, edges): cuts from all rows of a model, or from about edge_rows of more, picked by a hash of their time."""

    def cuts(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        found = edges_of(_matrix(group.sort_by("bucket_epoch_s").column("x")), params.bins)
        return pa.table({**{c: pa.array([k.as_py()], t) for c, k, t in zip(_OWN, key, (*_SLOT_TYPES, pa.int32()), strict=True)}, "edges": pa.array([[e.tolist() for e in found]], pa.list_(pa.list_(pa.float64())))})

    near = F.pmod(F.xxhash64("bucket_epoch_s"), F.col("n")) < params.edge_rows
    return rows.join(models.select(*_OWN, "n"), list(_OWN)).where(near).select(*_OWN, "bucket_epoch_s", "x").groupBy(*_OWN).applyInArrow(cuts, "exchange_id string, symbol string, horizon_steps int, model int, edges array<array<double>>")


def _blocks(rows: DataFrame, edges: DataFrame, params: Params) -> DataFrame:
    """(slot, model, block, widths, cells, label, total): packed rows, in which total is what the trees so far predict."""
    keys = [*_OWN, "block"]
    placed = rows.withColumn("block", F.floor((F.col("row") - 1) / params.block_rows)).select(*keys, "bucket_epoch_s", "x", "label", "base")
    copies = edges.join(placed.select(*keys).distinct(), list(_OWN)).withColumnsRenamed({k: f"_of_{k}" for k in keys})

    def pack(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("bucket_epoch_s")
        own = [np.array(e) for e in right.column("edges")[0].as_py()]
        label = left.column("label").to_numpy()
        made = {"widths": [[len(e) + 1 for e in own]], "cells": [cells_of(_matrix(left.column("x")), own).astype(np.uint16).tobytes()], "label": [label.tobytes()], "total": [left.column("base").to_numpy().tobytes()]}
        return pa.table({**{k: left.column(k).slice(0, 1) for k in keys}, **made}).cast(pa.schema([(k, left.schema.field(k).type) for k in keys] + [("widths", pa.list_(pa.int32())), ("cells", pa.binary()), ("label", pa.binary()), ("total", pa.binary())]))

    pack.__annotations__ = {"left": pa.Table, "right": pa.Table, "return": pa.Table}
    return placed.groupBy(*keys).cogroup(copies.groupBy(*[f"_of_{k}" for k in keys])).applyInArrow(pack, "exchange_id string, symbol string, horizon_steps int, model int, block bigint, widths array<int>, cells binary, label binary, total binary")


@dataclass
class _Grown:
    """The trees of one model since its rows' predictions were stored, all trees, and the one that grows."""

    recent: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    every: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    now: Tree | None = None


def _unpacked(b: pa.RecordBatch, i: int, state: _Grown, inner: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cells, label, total) of a block, the recent trees included."""
    label, total = (np.frombuffer(b.column(c)[i].as_py(), np.float64) for c in ("label", "total"))
    cells = np.frombuffer(b.column("cells")[i].as_py(), np.uint16).reshape(len(label), -1)
    for feature, cut, leaf in state.recent:
        total = total + leaf[_leaf_of(cells, feature, cut, inner)]
    return cells, label, total


def _level(blocks: DataFrame, state: dict[int, _Grown], params: Params) -> None:
    """Grow the open nodes of all trees by a level: histograms add up in tasks, and are merged for each model."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int, np.ndarray, np.ndarray] | None = None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"mid": pa.array([held[0]], pa.int32()), "many": pa.array([held[1].tobytes()], pa.binary()), "sums": pa.array([held[2].tobytes()], pa.binary())})

        for b in batches:
            for i, mid in enumerate(b.column("mid").to_pylist()):
                own = state[mid]
                if own.now is None or not len(own.now.open):
                    continue
                cells, label, total = _unpacked(b, i, own, params.inner)
                node = np.zeros(len(label), np.int64)
                for _ in range(own.now.level):
                    node = _down(cells, node, own.now.feature, own.now.cut)
                flat = cells + np.arange(own.now.shape[0]) * own.now.shape[1]
                many, sums = _histogram(flat, label - total, node, own.now.open, own.now.shape)
                if held is not None and held[0] == mid:
                    held = (mid, held[1] + many, held[2] + sums)
                    continue
                if held is not None:
                    yield out()
                held = (mid, many, sums)
        if held is not None:
            yield out()

    def split(key: tuple[pa.Scalar, ...], pieces: pa.Table) -> pa.Table:
        mid = key[0].as_py()
        tree = state[mid].now
        # whole sums in a fixed order, as tasks may come in any
        many = sum(np.frombuffer(x.as_py(), np.int64) for x in pieces.column("many"))
        sums = np.sort(np.array([np.frombuffer(x.as_py(), np.float64) for x in pieces.column("sums")]), axis=0).sum(0)
        tree.grow(many, sums)
        kept = {"feature": tree.feature, "cut": tree.cut, "gain": tree.gain, "n": tree.n, "sum": tree.sum, "open": tree.open}
        return pa.table({"mid": pa.array([mid], pa.int32()), **{k: pa.array([v.astype(np.float64)], pa.list_(pa.float64())) for k, v in kept.items()}})

    merged = blocks.mapInArrow(add_up, "mid int, many binary, sums binary").groupBy("mid").applyInArrow(split, "mid int, feature array<double>, cut array<double>, gain array<double>, n array<double>, sum array<double>, open array<double>")
    seen = set()
    for r in merged.collect():  # a tree's splits for each model of the wave
        tree = state[r["mid"]].now
        seen.add(r["mid"])
        tree.feature, tree.cut, tree.open = (np.array(r[c]).astype(np.int64) for c in ("feature", "cut", "open"))
        tree.gain, tree.n, tree.sum = (np.array(r[c]) for c in ("gain", "n", "sum"))
        tree.level += 1
    for mid, own in state.items():
        if mid not in seen and own.now is not None:
            own.now.open = own.now.open[:0]


def _kept(blocks: DataFrame, state: dict[int, _Grown], params: Params) -> DataFrame:
    """blocks with the recent trees in total, as a written table."""
    at = blocks.columns.index("total")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = [_unpacked(b, i, state[mid], params.inner)[2].tobytes() for i, mid in enumerate(b.column("mid").to_pylist())]
            yield b.set_column(at, "total", pa.array(new, pa.binary()))

    return written(blocks.mapInArrow(add, blocks.schema))


def _grow_wave(blocks: DataFrame, widths: dict[int, np.ndarray], params: Params) -> dict[int, _Grown]:
    """All trees of the models mid in blocks (mid, block, cells, label, total); jobs for each level of a round, not for each model."""
    state = {mid: _Grown([], []) for mid in widths}
    placed = lambda rows: rows.repartitionByRange("mid", "block").sortWithinPartitions("mid", "block").persist()
    rows = placed(blocks)
    try:
        for t in range(params.rounds):
            for mid, own in state.items():
                own.now = Tree(widths[mid], params)
            while any(len(own.now.open) for own in state.values()):
                _level(rows, state, params)
            for own in state.values():
                leaf = own.now.close()
                own.recent.append((own.now.feature, own.now.cut, leaf))
                own.every.append(own.recent[-1])
            if t % _KEEP == _KEEP - 1 and t + 1 < params.rounds:
                stored = _kept(rows, state, params)
                rows.unpersist()
                rows = placed(stored)
                for own in state.values():
                    own.recent = []
    finally:
        rows.unpersist()
    return state


def _fit_in_blocks(long: DataFrame, params: Params) -> DataFrame:
    spark = long.sparkSession
    rows = _learning(long)
    finite = F.col("label").isNotNull() & ~F.isnan("label") & (F.abs("label") < float("inf")) & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    models = written(rows.groupBy(*_OWN).agg(F.count("*").alias("n"), F.avg("label").alias("base"), F.count_if(~finite).alias("bad")))
    # the rows checked, too, must be finite
    odd = long.withColumn("label", _label()).groupBy(*SLOT).agg(F.count_if(~finite).alias("bad")).where("bad > 0").select(*SLOT)
    good, no_model = models.join(odd, list(SLOT), "left_anti"), [F.lit(None).cast(t).alias(c) for c, t in (("base", "double"), ("feature", "array<int>"), ("threshold", "array<double>"), ("leaf", "array<double>"), ("train_rows", "bigint"))]
    no_check = [F.lit(0).alias("fold"), *[F.lit(None).cast(t).alias(c) for c, t in (("bucket_epoch_s", "bigint"), ("actual", "double"), ("predicted_price", "double"))]]
    failed = odd.select(*SLOT, *no_model, F.lit("ValueError: features or targets that are not finite").alias("error"), *no_check)
    good = written(good)
    if good.isEmpty():
        return failed
    learn = rows.join(good.select(*_OWN, "base"), list(_OWN))
    edges = written(_edges(learn, good, params))
    blocks = written(_blocks(learn, edges, params))
    waves: list[DataFrame] = []
    wave: list = []
    named = good.join(edges.select(*_OWN, F.transform("edges", lambda e: F.size(e) + 1).alias("widths")), list(_OWN)).orderBy(*_OWN).toLocalIterator()
    while wave := [r for _, r in zip(range(params.wave), named, strict=False)]:
        mids = spark.createDataFrame([(i, *(r[c] for c in _OWN)) for i, r in enumerate(wave)], "mid int, exchange_id string, symbol string, horizon_steps int, model int")
        own = blocks.join(F.broadcast(mids), list(_OWN)).select("mid", "block", "cells", "label", "total")  # of params.wave rows
        grown = _grow_wave(own, {i: np.array(r["widths"]) for i, r in enumerate(wave)}, params)
        out = [(*(r[c] for c in _OWN), r["base"], r["n"], *([v for tree in grown[i].every for v in tree[k].tolist()] for k in range(3))) for i, r in enumerate(wave)]
        waves.append(written(spark.createDataFrame(out, "exchange_id string, symbol string, horizon_steps int, model int, base double, train_rows bigint, feature array<int>, cut array<int>, leaf array<double>")))
    cut_at = F.zip_with("feature", "cut", lambda f, c: F.when(c < 0, float("inf")).otherwise(F.get(F.get("edges", f), c)))
    fits = written(reduce(DataFrame.unionByName, waves).join(edges, list(_OWN)).select(*_OWN, "base", "feature", cut_at.alias("threshold"), "leaf", "train_rows", F.lit(None).cast("string").alias("error")))
    checks = long.withColumn("model", F.when(F.col("is_train"), F.col("fold")).otherwise(0)).where("not is_train or fold > 0")
    scored = score(checks, fits, params.depth, keys=_OWN, chunk_rows=params.block_rows, extra=("target",))
    checked = scored.select(*SLOT, *no_model, F.lit(None).cast("string").alias("error"), F.col("model").alias("fold"), "bucket_epoch_s", F.col("target").alias("actual"), "predicted_price")
    return fits.where("model = 0").select(*SLOT, "base", "feature", "threshold", "leaf", "train_rows", "error", *no_check).unionByName(checked).unionByName(failed)


def is_check() -> Column:
    """Whether a row of fit_slots() is a validated or held-out row."""
    return F.col("predicted_price").isNotNull()


def score(frame: DataFrame, fits: DataFrame, depth: int = Params.depth, chunk_rows: int = 4096, bin_seconds: int = 60, keys: tuple[str, ...] = SLOT, extra: tuple[str, ...] = ()) -> DataFrame:
    """frame (keys, bucket_epoch_s, x, price, extra) with predicted_price, for keys with a model in fits (model rows of fit_slots()).

    A task takes the rows of a model a chunk of time at a time, with a copy of the model for each chunk.
    """
    rows = frame.withColumn("_chunk", F.floor(F.col("bucket_epoch_s") / (bin_seconds * chunk_rows)))
    models = fits.where("error is null").select(*keys, "base", "feature", "threshold", "leaf").join(rows.select(*keys, "_chunk").distinct(), list(keys))
    models = models.withColumnsRenamed({k: f"_of_{k}" for k in (*keys, "_chunk")})
    by, names = [*keys, "_chunk"], [*keys, "bucket_epoch_s", "price", *extra, "predicted_price"]
    given = rows.select(*by, "bucket_epoch_s", "x", F.col("price").cast("double"), *extra)
    kinds = dict(given.dtypes) | {"predicted_price": "double"}

    def walk(left: pa.Table, right: pa.Table) -> pa.Table:
        own = left.select([c for c in names if c != "predicted_price"])
        if not left.num_rows or not right.num_rows:
            return own.slice(0, 0).append_column("predicted_price", pa.array([], pa.float64()))
        inner = 2**depth - 1
        feature, threshold, leaf = (np.array(right.column(c)[0].as_py()) for c in ("feature", "threshold", "leaf"))
        change = predict(_matrix(left.column("x")), right.column("base")[0].as_py(), feature.reshape(-1, inner), threshold.reshape(-1, inner), leaf.reshape(-1, inner + 1))
        return own.append_column("predicted_price", pa.array(left.column("price").to_numpy() * (1 + change)))

    walk.__annotations__ = {"left": pa.Table, "right": pa.Table, "return": pa.Table}
    return given.groupBy(*by).cogroup(models.groupBy(*[f"_of_{k}" for k in by])).applyInArrow(walk, ", ".join(f"{c} {kinds[c]}" for c in names))
