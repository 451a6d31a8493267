"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from numpy passes over whole texts; the trees are grown on histograms of a bounded sample of labelled
rows, and flattened into arrays that a whole batch walks at once, level by level.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbatch as tb
from .learn import held_out, labelled_texts, sampled_ids

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
#: The most labelled rows of each class that the trees learn from.
SAMPLE_PER_CLASS = 10_000

STATISTICS = (
    "log_words", "word_bytes", "word_bytes_sd", "symbols", "upper", "digits", "punctuation", "exclaims", "non_ascii", "repeated_words",
    "repeated_windows", "repeated_lines", "words_per_line", "words_with_symbol", "one_byte_words", "commonest_word", "short_lines",
)

_CLASS = {name: np.isin(np.arange(256), list(chars)) for name, chars in {
    "symbols": b"#*$%&|<>", "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digits": b"0123456789", "punctuation": b".,;:?", "exclaims": b"!", "non_ascii": bytes(range(128, 256)),
}.items()}


def _repeats(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text: how many of its hashes equal an earlier one, and how often the commonest occurs."""
    again, most = np.zeros(len(first) - 1), np.zeros(len(first) - 1)
    for i, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
        if b > a:
            own = np.sort(hashes[a:b])
            edges = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1], [True])))
            again[i], most[i] = b - a - (len(edges) - 1), np.diff(edges).max()
    return again, most


def statistics(column: pa.Array) -> np.ndarray:
    """A row of STATISTICS for each text; null and empty texts have zeros."""
    out = []
    for t in tb.chunks(column):
        starts, ends, first = tb.words(t)
        n, size = np.diff(first), np.maximum(np.diff(t.at), 1)
        lengths = (ends - starts).astype(np.float64)
        by_word = lambda x: tb.per_text(x, first) / np.maximum(n, 1)
        count = {k: tb.per_text(v[t.data], t.at) for k, v in _CLASS.items()}
        hashes = tb.span_hashes(t.data, starts, ends)
        again, most = _repeats(hashes, first)
        windows = hashes.copy()
        for k in range(1, min(5, len(hashes))):
            windows[: len(hashes) - k] = tb.mix(windows[: len(hashes) - k] * np.uint64(3) + hashes[k:])
        texts = np.repeat(np.arange(len(n)), n)
        whole = np.arange(len(hashes)) + 5 <= first[texts + 1]
        window_first = np.concatenate(([0], np.cumsum(tb.per_text(whole, first))))
        rewound, _ = _repeats(windows[whole], window_first)
        line_starts, line_ends, line_first = tb.spans(t.data != 10, t.at)
        lines = np.diff(line_first)
        again_lines, _ = _repeats(tb.span_hashes(t.data, line_starts, line_ends), line_first)
        symbols = np.flatnonzero(_CLASS["symbols"][t.data])
        mean = by_word(lengths)
        out.append(np.column_stack([
            np.log1p(n), mean, np.sqrt(np.maximum(by_word(lengths**2) - mean**2, 0)), count["symbols"] / size, count["upper"] / np.maximum(count["upper"] + count["lower"], 1), count["digits"] / size,
            count["punctuation"] / size, count["exclaims"] / size, count["non_ascii"] / size, again / np.maximum(n, 1), rewound / np.maximum(np.diff(window_first), 1), again_lines / np.maximum(lines, 1),
            n / np.maximum(lines, 1), by_word((np.searchsorted(symbols, ends) > np.searchsorted(symbols, starts)).astype(float)), by_word((lengths == 1).astype(float)), most / np.maximum(n, 1),
            tb.per_text(line_ends - line_starts < 20, line_first) / np.maximum(lines, 1),
        ]))
    return np.concatenate(out) if out else np.zeros((0, len(STATISTICS)))


@dataclass
class Forest:
    """Complete binary trees of one depth: the children of node i are 2i + 1 and 2i + 2. base is the log odds to add to."""

    base: float
    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, penalty: float = 1.0, least: float = 5.0) -> Forest:
    """Boosted trees for the logistic loss on quantile histograms. With one class or no rows the score is a constant."""
    weight = np.ones(len(y)) if weight is None else weight
    share = (weight @ y + 0.5) / (weight.sum() + 1.0) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    if len(np.unique(y)) < 2:
        return Forest(base, depth, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)])
    total, features, thresholds, values = np.full(len(y), base), [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        slope, curve = weight * (p - y), weight * p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        cut = np.full(inner, bins, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            here = node - first
            best = np.full(width, 1e-9)
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                cells = here * bins + binned[:, j]
                g, h = (np.bincount(cells, v, width * bins).reshape(width, bins).cumsum(1) for v in (slope, curve))
                gl, hl, gt, ht = g[:, : len(e)], h[:, : len(e)], g[:, -1:], h[:, -1:]
                gain = gl**2 / (hl + penalty) + (gt - gl) ** 2 / (ht - hl + penalty) - gt**2 / (ht + penalty)
                gain[(hl < least / 4) | (ht - hl < least / 4)] = 0
                k = gain.argmax(1)
                for i in np.flatnonzero(gain[np.arange(width), k] > best):
                    best[i], feature[first + i], threshold[first + i], cut[first + i] = gain[i, k[i]], j, e[k[i]], k[i]
            node = 2 * node + 1 + (binned[np.arange(len(y)), feature[node]] > cut[node])
        g, h = (np.bincount(node - inner, v, leaves) for v in (slope, curve))
        leaf = -rate * g / (h + penalty)
        total = total + leaf[node - inner]
        features.append(feature), thresholds.append(threshold), values.append(leaf)
    return Forest(base, depth, np.array(features), np.array(thresholds), np.array(values))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, fold: int = HELD_OUT, sample_per_class: int = SAMPLE_PER_CLASS) -> Forest:
    """Trees from at most 2 * sample_per_class labelled rows that are not held out; only their statistics reach the driver.

    A doc_id counts once, see labelled_texts().
    """
    rows = labelled_texts(docs, sampled_ids(labels, label, folds, fold, sample_per_class))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"), pa.array([*statistics(b.column("text"))], pa.list_(pa.float64()))], names=["doc_id", "label", "x"])

    got = rows.mapInArrow(measure, "doc_id long, label int, x array<double>").toArrow().sort_by("doc_id")
    x = np.array(got.column("x").to_pylist(), dtype=np.float64).reshape(-1, len(STATISTICS))
    return grow(x, got.column("label").to_numpy().astype(np.float64))


def score(docs: DataFrame, forest: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """docs with score (0 to 1) and predicted, whatever other columns it has; columns of those two names are replaced.

    A null or empty text gets the score of statistics that are all zero. Repeated rows are scored alike.
    """
    docs = docs.drop("score", "predicted")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = forest.score(statistics(b.column("text")))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())], names=[*names, "score", "predicted"])

    from pyspark.sql import types as T

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs."""
    docs = docs.select("doc_id", "text")
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", held_out(FOLDS, HELD_OUT).alias("held_out"), "score", "predicted")
