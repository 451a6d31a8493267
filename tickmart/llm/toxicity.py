"""Toxicity by compression distance: which of two zstandard dictionaries shortens a window more.

Two dictionaries are trained. That of ordinary text is trained on the windows of ordinary documents. Toxic documents are
mostly ordinary prose too, so that of toxic text is trained on the passages in which they differ: byte n-grams are
contrasted by document frequency, and a passage is a run that n-grams cover which toxic documents hold and ordinary ones
seldom do. A window of words is compressed with the ordinary dictionary alone, and with the toxic one in front of it; the
bytes that the toxic one saves are the window's distance. The distances of a document's windows are summarised and
calibrated to a probability on the labelled sample, and so is the size of the toxic dictionary.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .learn import held_out, labelled_texts, sampled_ids
from .scratch import written

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.5
#: The most labelled rows of each class that the dictionaries learn from, by their whole texts.
SAMPLE_PER_CLASS = 2000
#: A dictionary is trained on about so many bytes at a time; what several times give is trained on once more.
TRAIN_BYTES = 16 << 20
#: Calibration sees a text with dictionaries from the other half of the sample; later texts with those from all of it.
HALVES, ALL = (0, 1), 2
WINDOW_WORDS = 8
#: Windows that are compressed at a time: a long text is never held as a list of words.
AT_ONCE = 4096
GRAM = 5
ORDINARY_BYTES = 8192
#: The sizes tried for the toxic dictionary: a small one holds what is common in toxic text, a large one also what is rare.
TOXIC_BYTES = (512, 1024, 2048, 4096)
#: The length of the segments that a dictionary is put together from.
ORDINARY_SEGMENT, TOXIC_SEGMENT = 64, 32
#: An n-gram of a passage is in at least this share of a part's toxic documents, but in 4 of few and 30 of many; and its
#: least log odds.
LEAST_SHARE, LEAST_COUNTS, LEAST_ODDS = 2 / 15, (4, 30), 3.0
FEATURES = 5

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _words(text: str | None) -> Iterator[bytes]:
    return (m.group() for m in _WORD.finditer((text or "").lower().encode()))


def normalised(text: str | None) -> list[bytes]:
    return [*_words(text)]


def windows(words: Iterable[bytes], n: int = WINDOW_WORDS) -> Iterator[bytes]:
    """Every word is in exactly one window. A text without words has none."""
    words = iter(words)
    while some := [*islice(words, n)]:
        yield b" " + b" ".join(some) + b" "


def _grams(word: bytes) -> list[bytes]:
    w = b" " + word
    return [w[i : i + GRAM] for i in range(max(1, len(w) - GRAM + 1))]


def passages(words: list[bytes], marked: set[bytes]) -> Iterator[bytes]:
    """The parts of words that runs of marked n-grams cover."""
    for w in words:
        at = [i for i, g in enumerate(_grams(w)) if g in marked]
        runs = [at[k:] for k in range(len(at)) if not k or at[k] > at[k - 1] + 1]
        for run in runs:
            last = next((x for x, y in zip(run, run[1:], strict=False) if y > x + 1), run[-1])
            yield (b" " + w)[run[0] : last + GRAM]


def _train(samples: list[bytes], size: int, segment: int) -> bytes:
    """The content of a trained dictionary; of samples that are too few to train on, the last of the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=6 if segment < 64 else 8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


@dataclass
class Model:
    """The dictionaries, and the calibration of one toxic dictionary's distances."""

    ordinary: bytes
    toxic: tuple[bytes, ...]
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    _compressors: tuple = field(default=(), repr=False, compare=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_compressors": ()}

    def _both(self) -> tuple:
        if not self._compressors:
            made = []
            for content in (self.ordinary, *[t + self.ordinary for t in self.toxic]):
                how = zstandard.ZstdCompressionParameters(compression_level=1, window_log=16, hash_log=14, chain_log=14, search_log=4, min_match=5, strategy=zstandard.STRATEGY_GREEDY, write_content_size=0, write_dict_id=0, write_checksum=0)
                d = zstandard.ZstdCompressionDict(content or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(compression_params=how)
                made.append(zstandard.ZstdCompressor(dict_data=d, compression_params=how))
            self._compressors = tuple(made)
        return self._compressors

    def distances(self, texts: list[str | None]) -> np.ndarray:
        """For each text and toxic dictionary: largest, mean of the two largest, mean, share of at least 3 and log count of at least 3 of its windows' distances in bytes; zeros without words."""
        out, saved, text_of = np.zeros((len(texts), FEATURES * len(self.toxic))), [], []

        def compress(flat: list[bytes]) -> None:
            sizes = []
            for c in self._both():
                done = c.multi_compress_to_buffer(flat)
                sizes.append(np.array([len(done[i]) for i in range(len(flat))], np.int32))
            saved.append(np.column_stack([sizes[0] - x for x in sizes[1:]]))
            flat.clear()

        flat: list[bytes] = []
        for i, text in enumerate(texts):
            n = 0
            for w in windows(_words(text)):
                flat.append(w)
                n += 1
                if len(flat) == AT_ONCE:
                    compress(flat)
            text_of.append(np.full(n, i))
        if flat:
            compress(flat)
        if saved:
            every, ends = np.concatenate(saved), np.searchsorted(np.concatenate(text_of), np.arange(len(texts) + 1))
            for i, (first, last) in enumerate(zip(ends, ends[1:], strict=False)):
                own = np.sort(every[first:last], axis=0)
                if len(own):
                    high = (own >= 3).sum(0)
                    out[i] = np.column_stack([own[-1], own[-2:].mean(0), own.mean(0), high / len(own), np.log1p(high)]).ravel()
        return out

    def score(self, texts: list[str | None]) -> np.ndarray:
        x = (self.distances(texts) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + x @ self.weights[1:], -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 0.3, steps: int = 30) -> np.ndarray:
    x1 = np.column_stack([np.ones(len(x)), x])
    w, ridge = np.zeros(x1.shape[1]), penalty * np.eye(x1.shape[1])
    ridge[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        w = w - np.linalg.solve((x1 * (weight * p * (1 - p))[:, None]).T @ x1 + ridge, x1.T @ (weight * (p - y)) + ridge @ w)
    return w


def _marked(rows: DataFrame, n: dict[tuple[int, int], int]) -> dict[int, set[bytes]]:
    """For each part of the sample (a half or all), the n-grams of toxic texts that are rare in ordinary ones.

    n has the rows of each (part, label).
    """
    least = {p: min(max(LEAST_COUNTS[0], int(LEAST_SHARE * n[p, 1])), LEAST_COUNTS[1] if p == ALL else LEAST_COUNTS[1] // 2) for p in (*HALVES, ALL)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: Counter = Counter()
            for half, label, text in zip(*(b.column(c).to_pylist() for c in ("half", "label", "text")), strict=True):
                found.update({(half, label, g) for w in set(normalised(text)) for g in _grams(w)})
            yield pa.RecordBatch.from_pydict({"half": pa.array([k[0] for k in found], pa.int32()), "label": pa.array([k[1] for k in found], pa.int32()), "gram": pa.array([k[2] for k in found], pa.binary()), "n": pa.array(found.values(), pa.int64())})

    def total(part: int, label: int) -> Column:
        here = F.col("label") == label if part == ALL else (F.col("label") == label) & (F.col("half") == part)
        return F.sum(F.when(here, F.col("n")).otherwise(0)).alias(f"n{part}{label}")

    grams = rows.mapInArrow(count, "half int, label int, gram binary, n long").groupBy("gram").agg(*[total(p, k) for p in (*HALVES, ALL) for k in (0, 1)])
    odds = {p: F.log((F.col(f"n{p}1") + 0.5) / (n[p, 1] + 1)) - F.log((F.col(f"n{p}0") + 0.5) / (n[p, 0] + 1)) for p in (*HALVES, ALL)}
    named = [((odds[p] > LEAST_ODDS) & (F.col(f"n{p}1") >= least[p])).alias(f"m{p}") for p in odds]
    got = grams.select("gram", *named).where(" or ".join(f"m{p}" for p in odds)).toArrow().to_pydict()
    return {p: {g for g, m in zip(got["gram"], got[f"m{p}"], strict=True) if m} for p in odds}


def _samples(rows: DataFrame, marked: dict[int, set[bytes]]) -> DataFrame:
    """(part, label, doc_id, place, sample): what each document gives the dictionary of its label, in all parts it is in.

    An ordinary document gives its windows; a toxic one gives its passages, as one sample, or its windows in a part in
    which no passage is told.
    """

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"part": pa.int32(), "label": pa.int32(), "doc_id": pa.int64(), "place": pa.int32(), "sample": pa.binary()}
        for b in batches:
            for half, label, doc_id, text in zip(*(b.column(c).to_pylist() for c in ("half", "label", "doc_id", "text")), strict=True):
                words, out = normalised(text), []
                for part in (half, ALL):
                    own = [b"".join(p + b" " for p in passages(words, marked[part]))] if label and marked[part] else windows(words, 24)
                    out += [(part, label, doc_id, k, x) for k, x in enumerate(own) if x]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds.values(), strict=True)], names=[*kinds])

    return rows.mapInArrow(give, "part int, label int, doc_id long, place int, sample binary")


def _trained(samples: DataFrame) -> dict[tuple[int, int, int], bytes]:
    """For each part, label and size, a dictionary trained on all samples, in the order of doc_id."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size, made = None, [], 0, []

        def train(label: int) -> dict[int, bytes]:
            return {n: _train(held, n, TOXIC_SEGMENT if label else ORDINARY_SEGMENT) for n in (TOXIC_BYTES if label else (ORDINARY_BYTES,))}

        def close() -> pa.RecordBatch:
            if held or not made:
                made.append(train(key[1]))
            whole = {n: made[0][n] if len(made) == 1 else _train([m[n][i : i + 64] for m in made for i in range(0, len(m[n]), 64)], n, TOXIC_SEGMENT if key[1] else ORDINARY_SEGMENT) for n in made[0]}
            return pa.RecordBatch.from_pydict({"part": pa.array([key[0]] * len(whole), pa.int32()), "label": pa.array([key[1]] * len(whole), pa.int32()), "size": pa.array(whole, pa.int32()), "content": pa.array(whole.values(), pa.binary())})

        for b in batches:
            for part, label, sample in zip(*(b.column(c).to_pylist() for c in ("part", "label", "sample")), strict=True):
                if key != (part, label):
                    if key is not None:
                        yield close()
                    key, size = (part, label), 0
                    held, made = [], []
                held.append(sample)
                size += len(sample)
                if size >= TRAIN_BYTES:
                    made.append(train(label))
                    held, size = [], 0
        if key is not None:
            yield close()

    ordered = samples.repartition("part", "label").sortWithinPartitions("part", "label", "doc_id", "place")
    got = ordered.select("part", "label", "sample").mapInArrow(learn, "part int, label int, size int, content binary").collect()
    return {(r["part"], r["label"], r["size"]): bytes(r["content"]) for r in got}


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS, fold: int = HELD_OUT, sample_per_class: int = SAMPLE_PER_CLASS) -> Model:
    """A model from the whole texts of at most 2 * sample_per_class labelled rows that are not held out.

    Dictionaries come from all of them. Each half is calibrated with dictionaries from the other half, so that
    calibration sees texts as new as later ones are; of TOXIC_BYTES, the largest size is taken whose
    loss there is within a hundredth of the least. Texts
    stay in tasks: counts, n-grams, dictionaries and distances reach the driver. With few toxic rows a passage needs only
    4 of them, and of fewer whole windows are learned from; without labelled texts of both classes in both halves (so with 1 toxic row at most)
    the score is the smoothed share of toxic rows. A doc_id counts once, see labelled_texts().
    """
    ids = sampled_ids(labels, label, folds, fold, sample_per_class)
    toxic_share = labels.where(~held_out(folds, fold) & F.col(label).isin(0, 1)).agg(F.avg(label)).first()[0]
    rows = written(labelled_texts(docs, ids).withColumn("half", F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)).cast("int")))
    n = {(p, k): 0 for p in (*HALVES, ALL) for k in (0, 1)}
    for r in rows.groupBy("half", "label").count().collect():
        n[r["half"], r["label"]] += r["count"]
        n[ALL, r["label"]] += r["count"]
    share = (n[ALL, 1] + 0.5) / (n[ALL, 0] + n[ALL, 1] + 1.0) if toxic_share is None else min(max(toxic_share, 1e-4), 1 - 1e-4)
    constant = np.array([np.log(share / (1 - share)), *[0] * FEATURES])
    if not all(n.values()):
        return Model(b"", (b"",), constant, np.zeros(FEATURES), np.ones(FEATURES))
    trained = _trained(_samples(rows, _marked(rows, n)))
    models = {p: Model(trained.get((p, 0, ORDINARY_BYTES), b""), tuple(trained.get((p, 1, size), b"") for size in TOXIC_BYTES), constant, np.zeros(FEATURES), np.ones(FEATURES)) for p in (*HALVES, ALL)}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            half, texts, x = np.array(b.column("half").to_pylist(), int), b.column("text").to_pylist(), np.zeros((b.num_rows, FEATURES * len(TOXIC_BYTES)))
            for p in HALVES:
                own = np.flatnonzero(half == p)
                x[own] = models[1 - p].distances([texts[i] for i in own])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"), pa.array([*x], pa.list_(pa.float64()))], names=["doc_id", "label", "x"])

    got = rows.mapInArrow(measure, "doc_id long, label int, x array<double>").toArrow().sort_by("doc_id")
    every, y = np.array(got.column("x").to_pylist(), dtype=np.float64).reshape(len(got), -1), got.column("label").to_numpy().astype(np.float64)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    tried: list[tuple[float, Model]] = []
    for k in range(len(TOXIC_BYTES)):
        x = every[:, FEATURES * k : FEATURES * (k + 1)]
        mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
        weights = _logistic((x - mean) / scale, y, weight)
        p = 1 / (1 + np.exp(-np.clip(weights[0] + (x - mean) / scale @ weights[1:], -30, 30)))
        loss = float(-(weight * np.log(np.where(y == 1, p, 1 - p))).sum())
        tried.append((loss, Model(models[ALL].ordinary, models[ALL].toxic[k : k + 1], weights, mean, scale)))
    least = min(loss for loss, _ in tried)
    return next(m for loss, m in reversed(tried) if loss <= 1.01 * least)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """docs with score (0 to 1) and predicted, whatever other columns it has; columns of those two names are replaced.

    Whole texts are scored; a null, empty or blank text gets the score of a document without toxic windows. Repeated rows
    are scored alike.
    """
    docs = docs.drop("score", "predicted")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                s = model.score(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())], names=[*names, "score", "predicted"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs."""
    docs = docs.select("doc_id", "text")
    return score(docs, fit(docs, labels)).select("doc_id", held_out(FOLDS, HELD_OUT).alias("held_out"), "score", "predicted")
