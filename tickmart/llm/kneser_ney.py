"""Bigram language model with interpolated modified Kneser-Ney smoothing, counted in Spark and looked up in mapped files.

Tasks count the word pairs of their texts and hand them on in packed shards. A shard's task merges them, writes the shard as
sorted hash arrays to the shared folder, and hands on what its pairs say about single words, which are merged and stored
the same way. Scoring maps these files and looks up sorted keys, so a worker holds the pages that its texts touch, and
neither the driver nor any task has the model. Files have names that follow from the model, are written aside and moved, and
hold the same bytes whoever writes them: a task may be tried again, or twice at once.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import learn
from .rules import sampled
from .scratch import folder, written
from .textbatch import LOWER, Texts, chunks, mix, span_hashes, words

FOLDS, HELD_OUT = 7, 2
#: Marks beside the words of a text.
START, END = mix(np.array([1, 2], np.uint64))
#: A shard of pairs stands for about so many bytes of text, one of words for so many shards of pairs.
SHARD_BYTES, WORDS_PER_SHARD = 16 << 20, 8
#: A task hands on its pairs from so many on.
HELD_PAIRS = 2 << 20
#: Words with a larger share of all than this, in a sample, have their pairs dealt over all shards: under 1,024 words.
HOT_SHARE, HOT_SAMPLE = 1 / 1024, 2000
#: Bytes of text, and pairs, that are scored at a time.
SCORED_BYTES, SCORED_PAIRS = 2 << 20, 1 << 19
#: Files that a worker keeps mapped.
MAPPED = 4096

_PAIR = ("count",)
_WORD = ("count", "before", "one", "two", "more")


# storage: sorted keys and columns of whole numbers, each as narrow as its largest value


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def _store(path: str, keys: np.ndarray, columns: list[np.ndarray]) -> None:
    """A file of a head (rows, then bytes of each column's values) and the arrays, each from a multiple of 8 bytes on."""
    where, at = pafs.FileSystem.from_uri(path)
    arrays = [keys, *map(_narrow, columns)]
    with where.open_output_stream(own := f"{at}.{uuid.uuid4().hex}") as out:
        out.write(np.array([len(keys), *[a.itemsize for a in arrays[1:]]], np.int64).tobytes())
        for a in arrays:
            out.write(a.tobytes() + bytes(-a.nbytes % 8))
    where.move(own, at)


@lru_cache(MAPPED)
def _mapped(path: str, columns: int) -> tuple[np.ndarray, ...]:
    """The arrays of a stored file, mapped: where the folder is not a mounted one, from a copy without a name."""
    where, at = pafs.FileSystem.from_uri(path)
    if isinstance(where, pafs.LocalFileSystem):
        data = np.memmap(at, np.uint8, "r")
    else:
        with tempfile.NamedTemporaryFile() as copy, where.open_input_stream(at) as source:
            while block := source.read(8 << 20):
                copy.write(block)
            copy.flush()
            data = np.memmap(copy.name, np.uint8, "r")
    head = data[: 8 * (columns + 1)].view(np.int64)
    out, first = [], head.nbytes
    for size in (8, *head[1:]):
        out.append(data[first : first + head[0] * size].view(f"u{size}"))
        first += -(-head[0] * size // 8) * 8
    return tuple(out)


def _look_up(keys: np.ndarray, shard: np.ndarray, name: str, columns: tuple[str, ...]) -> list[np.ndarray]:
    """For each key its columns in its shard's file, 0 where it is not there."""
    out, order = [np.zeros(len(keys), np.int64) for _ in columns], np.lexsort((keys, shard))
    sorted_keys, sorted_shards = keys[order], shard[order]
    cuts = np.flatnonzero(np.diff(sorted_shards, prepend=-1, append=-1))
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        known, *values = _mapped(f"{name}-{sorted_shards[lo]}", len(columns))
        if not len(known):
            continue
        own = sorted_keys[lo:hi]
        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
        hit = known[at] == own
        where, at = order[lo:hi][hit], at[hit]
        for o, v in zip(out, values, strict=True):
            o[where] = v[at]
    return out


# texts as sequences of hashes


def _sequence(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """START, the word hashes and END of each text, one after the other, and the place of each text's START (and the end)."""
    low = Texts(t.first, t.last, LOWER[t.data], t.at)
    starts, ends, first = words(low)
    hashes = span_hashes(low.data, starts, ends)
    at = first + 2 * np.arange(len(first))
    out = np.full(at[-1], START, np.uint64)
    out[at[1:] - 1] = END
    out[np.arange(len(hashes)) + 2 * np.repeat(np.arange(len(first) - 1), np.diff(first)) + 1] = hashes
    return out, at


def _key(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(v * np.uint64(0x9E3779B97F4A7C15) + w)


def _pair_shard(v: np.ndarray, w: np.ndarray, n: int, hot: np.ndarray) -> np.ndarray:
    """A pair's shard: that of its first word, or its own if that is hot."""
    spread = mix(v ^ np.uint64(0x5851F42D4C957F2D))
    if len(hot):
        spread = np.where(np.isin(v, hot), _key(v, w), spread)
    return (spread % np.uint64(n)).astype(np.int64)


def _word_shard(w: np.ndarray, n: int) -> np.ndarray:
    return (mix(w) % np.uint64(n)).astype(np.int64)


# counting


def _summed(v: np.ndarray, w: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, with their sums."""
    order = np.lexsort((w, v))
    v, w, n = v[order], w[order], n[order]
    new = np.flatnonzero((np.diff(v, prepend=~v[:1]) != 0) | (np.diff(w, prepend=~w[:1]) != 0)) if len(v) else np.zeros(0, int)
    return v[new], w[new], np.add.reduceat(n, new) if len(new) else n


def _runs(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of sorted v and the length of each one's run."""
    new = np.flatnonzero(np.diff(v, prepend=~v[:1]) != 0) if len(v) else np.zeros(0, int)
    return v[new], np.diff(np.append(new, len(v)))


def _packed(*arrays: np.ndarray) -> list[bytes]:
    return [a.tobytes() for a in arrays]


@dataclass(frozen=True)
class Model:
    """What scoring needs beside the files: tokens N, distinct ones V, distinct pairs, and discounts of pairs and words."""

    path: str
    pair_shards: int
    word_shards: int
    hot: np.ndarray
    tokens: int = 0
    distinct: int = 0
    pairs: int = 0
    pair_discounts: tuple[float, float, float] = (0.5, 1.0, 1.5)
    word_discounts: tuple[float, float, float] = (0.5, 1.0, 1.5)
    word_kinds: tuple[int, int, int] = (0, 0, 0)
    ends: int = 0


def discounts(kinds: list[int]) -> tuple[float, float, float]:
    """Of counts 1, 2 and more, from how many n-grams have counts 1, 2, 3 and 4: the modified Kneser-Ney estimates.

    Where these cannot be estimated (a number is 0, or a discount is not between 0 and its count), 0.5, 1 and 1.5.
    """
    if all(kinds):
        share = kinds[0] / (kinds[0] + 2 * kinds[1])
        found = tuple(k - (k + 1) * share * kinds[k] / kinds[k - 1] for k in (1, 2, 3))
        if all(0 < d <= k for k, d in enumerate(found, 1)):
            return found
    return (0.5, 1.0, 1.5)


def _hot_words(docs: DataFrame) -> np.ndarray:
    """Words that are likely to be hot; which they are moves pairs between shards and changes no count."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in chunks(b.column("text")):
                w, n = np.unique(_sequence(t)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n)], names=["w", "n"])

    each = written(sampled(docs.select("text"), HOT_SAMPLE).mapInArrow(count, "w bigint, n bigint").groupBy("w").agg(F.sum("n").alias("n")))
    total = each.agg(F.sum("n")).first()[0] or 0
    return np.array([r["w"] for r in each.where(F.col("n") > total * HOT_SHARE).collect()], np.int64).view(np.uint64)


def _counted_pairs(docs: DataFrame, model: Model) -> DataFrame:
    """(shard, v, runs, w, n): the pairs that a task has met, packed: each first word, how many follow it, these, and counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out() -> Iterator[pa.RecordBatch]:
            v, w = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            v, w, n = _summed(v, w, np.ones(len(v), np.int64))
            shard = _pair_shard(v, w, model.pair_shards, model.hot)
            order = np.argsort(shard, kind="stable")
            v, w, n, shard = v[order], w[order], n[order], shard[order]
            cuts = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard))
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                first, runs = _runs(v[lo:hi])
                yield pa.RecordBatch.from_pydict({"shard": pa.array([shard[lo]], pa.int64()), **{k: pa.array([x], pa.binary()) for k, x in zip(("v", "runs", "w", "n"), _packed(first, runs.astype(np.uint32), w[lo:hi], n[lo:hi].astype(np.uint32)), strict=True)}})

        for b in batches:
            for t in chunks(b.column("text")):
                seq, at = _sequence(t)
                inside = np.ones(len(seq) - 1, bool)
                inside[at[1:-1] - 1] = False
                held.append((seq[:-1][inside], seq[1:][inside]))
                if sum(len(v) for v, _ in held) >= HELD_PAIRS:
                    yield from out()
        if held:
            yield from out()

    return docs.select("text").mapInArrow(count, "shard bigint, v binary, runs binary, w binary, n binary")


_STATS = "kind string, shard bigint, w binary, count binary, before binary, one binary, two binary, more binary, kinds array<bigint>"


def _stats_row(kind: str, shard: int, arrays: list[np.ndarray], kinds: list[int]) -> pa.Table:
    names = ("w", *_WORD)
    return pa.table({"kind": [kind], "shard": pa.array([shard], pa.int64()), **{k: pa.array([x.tobytes()], pa.binary()) for k, x in zip(names, arrays, strict=True)}, "kinds": pa.array([kinds], pa.list_(pa.int64()))})


def _kinds(n: np.ndarray) -> list[int]:
    return [int((n == k).sum()) for k in (1, 2, 3, 4)]


def _store_pairs(pieces: DataFrame, model: Model) -> DataFrame:
    """Merge and store every shard of pairs; what they say about words, packed by shards of words, and a row of totals each."""

    def merge(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        got = {c: [x.as_py() for x in rows.column(c)] for c in ("v", "runs", "w", "n")}
        v = np.concatenate([np.repeat(np.frombuffer(a, np.uint64), np.frombuffer(r, np.uint32)) for a, r in zip(got["v"], got["runs"], strict=True)])
        v, w, n = _summed(v, np.concatenate([np.frombuffer(x, np.uint64) for x in got["w"]]), np.concatenate([np.frombuffer(x, np.uint32) for x in got["n"]]).astype(np.int64))
        keys = _key(v, w)
        order = np.argsort(keys)
        _store(f"{model.path}/pair-{key[0].as_py()}", keys[order], [n[order]])
        # words as followers: occurrences and distinct words before; as first words: how many followers came 1, 2, 3 and more times
        word, at = np.unique(np.concatenate([w, v]), return_inverse=True)
        as_w, as_v = at[: len(w)], at[len(w) :]
        sums = [np.bincount(as_w, n, len(word)).astype(np.int64), np.bincount(as_w, minlength=len(word)), *[np.bincount(as_v[x], minlength=len(word)) for x in (n == 1, n == 2, n > 2)]]
        shard = _word_shard(word, model.word_shards)
        out = [_stats_row("pair", key[0].as_py(), [np.zeros(0, np.int64)] * 6, [len(v), *_kinds(n)])]
        for s in np.unique(shard):
            own = shard == s
            out.append(_stats_row("word", int(s), [word[own], *[x[own].astype(np.uint32 if x.max(initial=0) < 1 << 32 else np.int64) for x in sums]], []))
        return pa.concat_tables(out)

    return pieces.groupBy("shard").applyInArrow(merge, _STATS)


def _store_words(pieces: DataFrame, model: Model) -> DataFrame:
    """Merge and store every shard of words; (kinds) has for each its totals."""

    def merge(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        def column(name: str) -> np.ndarray:
            own = [(x.as_py(), len(w.as_py()) // 8) for x, w in zip(rows.column(name), rows.column("w"), strict=True)]
            return np.concatenate([np.frombuffer(x, f"u{len(x) // n if n else 8}").astype(np.uint64) for x, n in own])

        word, at = np.unique(column("w"), return_inverse=True)
        sums = []
        for c in _WORD:
            total = np.zeros(len(word), np.int64)
            np.add.at(total, at, column(c).astype(np.int64))
            sums.append(total)
        _store(f"{model.path}/word-{key[0].as_py()}", word, sums)
        count, before = sums[:2]
        kinds = [int(count.sum()), int((count > 0).sum()), int(count[word == END].sum()), *[int(x) for x in ((before == 1).sum(), (before == 2).sum(), (before > 2).sum())], *_kinds(before)]
        return pa.table({"kinds": pa.array([kinds], pa.list_(pa.int64()))})

    return pieces.groupBy("shard").applyInArrow(merge, "kinds array<bigint>")


def _added(rows: DataFrame, n: int) -> list[int]:
    return [r or 0 for r in rows.agg(*[F.sum(F.col("kinds")[i]) for i in range(n)]).first()]


def fit(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> Model:
    """A model of all texts of docs (text, ...), stored below the shared folder. A null text counts as an empty one.

    Words are compared by 64-bit hashes. Repeated rows count as often as they occur. Without rows the model knows no word,
    and every token has probability 1 / (V + 1) = 1.
    """
    docs = docs.select("text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    model = Model(folder(docs.sparkSession), shards, max(1, shards // WORDS_PER_SHARD), _hot_words(docs))
    where, at = pafs.FileSystem.from_uri(model.path)
    where.create_dir(at, recursive=True)
    for name, n, columns in (("pair", shards, _PAIR), ("word", model.word_shards, _WORD)):
        _fill(docs, model, name, n, columns)
    stats = written(_store_pairs(_counted_pairs(docs, model), model))
    pairs, *pair_kinds = _added(stats.where("kind = 'pair'"), 5)
    totals = written(_store_words(stats.where("kind = 'word'").select("shard", "w", *_WORD), model))
    tokens, distinct, ends, *kinds = _added(totals, 10)
    return replace(model, tokens=tokens, distinct=distinct, pairs=pairs, pair_discounts=discounts(pair_kinds), word_discounts=discounts(kinds[3:]), word_kinds=tuple(kinds[:3]), ends=ends)


def _fill(docs: DataFrame, model: Model, name: str, n: int, columns: tuple[str, ...]) -> None:
    """An empty file for every shard, for those that get no rows."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in b.column("id").to_pylist():
                _store(f"{model.path}/{name}-{i}", np.zeros(0, np.uint64), [np.zeros(0, np.int64)] * len(columns))
            yield b

    docs.sparkSession.range(n).mapInArrow(fill, "id bigint").count()


# scoring


def _discount(n: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
    return n - np.array([0.0, *by])[np.minimum(n, 3)]


def _scores(t: Texts, model: Model) -> dict[str, np.ndarray]:
    """n_tokens, n_known, base_score and score of each text."""
    seq, at = _sequence(t)
    out = {k: np.zeros(len(at) - 1) for k in ("n_known", "base_score", "score")} | {"n_tokens": np.diff(at) - 1}
    d1, d2, d3 = model.pair_discounts
    spare = float(np.dot(model.word_discounts, model.word_kinds)) / model.pairs if model.pairs else 1.0
    for first in range(0, len(seq) - 1, SCORED_PAIRS):
        part = seq[first : first + SCORED_PAIRS + 1]
        word, back = np.unique(part, return_inverse=True)
        count, before, one, two, more = _look_up(word, _word_shard(word, model.word_shards), f"{model.path}/word", _WORD)
        base = np.log10((count + 1) / (model.tokens + model.distinct + 1))
        p1 = _discount(before, model.word_discounts) / max(model.pairs, 1) + spare / (model.distinct + 1)
        total = np.where(word == START, model.ends, count)
        mass = d1 * one + d2 * two + d3 * more
        text = np.searchsorted(at, np.arange(first, first + len(part) - 1), "right") - 1
        inside = np.arange(first + 1, first + len(part)) < at[text + 1]
        text, v, w = text[inside], back[:-1][inside], back[1:][inside]
        pair = _look_up(_key(word[v], word[w]), _pair_shard(word[v], word[w], model.pair_shards, model.hot), f"{model.path}/pair", _PAIR)[0]
        known = total[v] > 0
        p = np.where(known, (_discount(pair, model.pair_discounts) + mass[v] * p1[w]) / np.maximum(total[v], 1), p1[w])
        for name, values in (("n_known", count[w] > 0), ("base_score", base[w]), ("score", np.log10(p))):
            out[name] += np.bincount(text, values, len(at) - 1)
    return out


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs (text, ...) with n_tokens, n_known, train_tokens, base_score, score and perplexity; columns of these names are
    replaced.

    score is the log10 probability of a text's words and its end, perplexity 10 ** (-score / n_tokens). A null, empty or
    blank text is its end alone. Words that the model does not know share one probability.
    """
    kinds = {"n_tokens": (pa.int64(), T.LongType()), "n_known": (pa.int64(), T.LongType()), "train_tokens": (pa.int64(), T.LongType()), "base_score": (pa.float64(), T.DoubleType()), "score": (pa.float64(), T.DoubleType()), "perplexity": (pa.float64(), T.DoubleType())}
    docs = docs.drop(*kinds)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in chunks(b.column("text"), SCORED_BYTES):
                found = _scores(t, model)
                found |= {"train_tokens": np.full(t.last - t.first, model.tokens), "perplexity": 10 ** (-found["score"] / found["n_tokens"])}
                made = [pa.array(found[k].astype(np.int64 if kind == pa.int64() else np.float64), kind) for k, (kind, _) in kinds.items()]
                yield pa.RecordBatch.from_arrays([*b.slice(t.first, t.last - t.first).columns, *made], names=[*names, *kinds])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *[T.StructField(k, kind) for k, (_, kind) in kinds.items()]]))


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) of docs (doc_id, text, ...).

    The model learns from the rows that are not held out, those without doc_id among them.
    """
    docs = docs.select("doc_id", "text").withColumn("held_out", learn.held_out(FOLDS, HELD_OUT))
    return score(docs, fit(docs.where("not held_out"))).drop("text")
