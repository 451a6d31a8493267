"""Language mixtures: the share of each language in a document, by expectation-maximisation over n-gram likelihoods.

Counts of hashed byte trigrams of every learning document give each language a smoothed n-gram model. A document is a
bag of words, each drawn from one of the languages; a word's likelihood is that of its trigrams. Expectation-
maximisation estimates the shares, and languages are dropped, least share first, while the penalised likelihood gains.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbatch as tb
from .learn import held_out, remainder

FOLDS, HELD_OUT = 4, 2
SLOTS = 1 << 16
BLOCK = 1 << 12
#: Numbers that likelihoods take at a time: bytes of text times languages.
CELLS = 8 << 20
NO_LANGUAGE = "und"

#: Letters and bytes of longer characters have a code; everything else is 0 and ends a word.
_CODE = np.zeros(256, np.int64)
_CODE[97:123] = np.arange(1, 27)
_CODE[65:91] = np.arange(1, 27)
_CODE[128:] = np.arange(27, 155)


#: A longer text is read in steps of so many bytes.
STEP = 1 << 20
#: Languages whose sums a task holds at a time, half a MB each.
HELD_LANGUAGES = 256
_FOLD = np.where(_CODE > 0, tb.LOWER, 0).astype(np.uint8)


def _steps(data: np.ndarray, step: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(slots, codes, place) of one text, a step at a time; trigrams at a step's ends are those of the whole text."""
    step = step or STEP
    for at in range(0, len(data), step):
        low, high = max(0, at - 1), min(len(data), at + step + 1)
        slot, _, (_, _, code) = _trigrams(tb.Texts(0, 1, data[low:high], np.array([0, high - low])))
        own = slice(at - low, min(at + step, len(data)) - low)
        yield slot[own], code[own], at


def _trigrams(t: tb.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The slot of the trigram around each byte, and the spans of words: starts, ends and first word of each text."""
    code = _CODE[t.data]
    before, after = np.zeros_like(code), np.zeros_like(code)
    before[1:], after[:-1] = code[:-1], code[1:]
    inner = t.at[1:-1][(t.at[1:-1] > 0) & (t.at[1:-1] < len(code))]
    before[inner], after[inner - 1] = 0, 0
    number = ((before * 155 + code) * 155 + after).astype(np.uint64)
    slot = ((number * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)
    starts, ends, first = tb.spans(code > 0, t.at)
    return slot, starts, (ends, first, code)


@dataclass
class Model:
    languages: list[str]
    log_share: np.ndarray  # SLOTS x languages

    def _most(self) -> int:
        """Bytes of text whose likelihoods in all languages are held at a time."""
        return max(1, min(STEP, CELLS // max(1, len(self.languages))))

    def mixtures(self, column: pa.Array, penalty: float = 3.0, steps: int = 12) -> tuple[np.ndarray, np.ndarray]:
        """For each text: the shares of the languages (zeros where it has no letter), and the certainty of the first one.

        penalty times the log of the number of words is what each language beyond the first must gain in log
        likelihood.
        """
        shares, sure, most = [], [], self._most()
        for t in tb.chunks(column, min(tb.CHUNK_BYTES, most)):
            if len(t.data) > 2 * most and len(t.at) == 2:
                share, certainty = self._long(t.data, penalty, steps)
                shares.append(share), sure.append(certainty)
                continue
            slot, starts, (ends, first, code) = _trigrams(t)
            n, k = np.diff(first), len(self.languages)
            w = np.zeros((len(starts), k), np.float32)
            if len(starts) and k:
                by_byte = np.where((code > 0)[:, None], self.log_share[slot], np.float32(0))
                w = np.add.reduceat(by_byte, starts, axis=0)
            share, certainty = _mixture(w, np.ones(len(w), np.float32), n, first, penalty, steps)
            silent = n == 0
            ascii_letter = tb.per_text((code > 0) & (code < 27), t.at) > 0
            for i in np.flatnonzero(~silent & ~ascii_letter):  # bytes of longer characters need not be letters
                silent[i] = not any(map(str.isalpha, t.data[t.at[i] : t.at[i + 1]].tobytes().decode("utf-8", "replace")))
            share[silent], certainty[silent] = 0, 0
            shares.append(share), sure.append(certainty)
        return (np.concatenate(shares), np.concatenate(sure)) if shares else (np.zeros((0, len(self.languages))), np.zeros(0))

    def _long(self, data: np.ndarray, penalty: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
        """mixtures() of one long text: its distinct words, each with its count, are what is held of it."""
        k = len(self.languages)
        key, count, likely = np.zeros(0, np.uint64), np.zeros(0, np.float32), np.zeros((0, k), np.float32)
        opened: np.ndarray | None = None  # what is known of a word that goes on in the next step
        across: list[np.ndarray] = []
        heard = False
        for slot, code, at in _steps(data, self._most()):
            inside = code > 0
            heard = heard or bool((inside & (code < 27)).any())
            starts, ends, _ = tb.spans(inside, np.array([0, len(code)]))
            if not len(starts):
                if opened is not None:
                    across.append(opened)
                    opened = None
                continue
            w = np.add.reduceat(np.where(inside[:, None], self.log_share[slot], np.float32(0)), starts, axis=0)
            first, last = 0, len(starts)
            if opened is not None:
                if starts[0] == 0:
                    opened, first = opened + w[0], 1
                if first == 0 or ends[0] < len(code):
                    across.append(opened)
                    opened = None
            if last > first and ends[-1] == len(code) and at + len(code) < len(data):
                opened, last = w[-1], last - 1
            if last > first:
                word = tb.span_hashes(_FOLD[data[at : at + len(code)]], starts[first:last], ends[first:last])
                key, count, likely = np.concatenate([key, word]), np.concatenate([count, np.ones(len(word), np.float32)]), np.concatenate([likely, w[first:last]])
                key, place, where = np.unique(key, return_index=True, return_inverse=True)
                count, likely = np.bincount(where, count, len(key)).astype(np.float32), likely[place]
        if opened is not None:
            across.append(opened)
        if across:
            count, likely = np.concatenate([count, np.ones(len(across), np.float32)]), np.concatenate([likely, np.array(across, np.float32)])
        if not heard and not any(map(str.isalpha, data.tobytes().decode("utf-8", "replace"))):
            return np.zeros((1, k)), np.zeros(1)
        return _mixture(likely, count, np.array([len(likely)]), np.array([0, len(likely)]), penalty, steps)


def _fit(w: np.ndarray, weight: np.ndarray, text: np.ndarray, first: np.ndarray, allowed: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares and log likelihoods of texts (all with words) whose languages are restricted to allowed.

    A row of w is a word's log likelihood in each language, and weight how often the text has it.
    """
    top = np.where(allowed[text], w, -np.inf).max(1, keepdims=True)
    p = np.exp(w - top, where=allowed[text], out=np.zeros_like(w))
    share = allowed / allowed.sum(1, keepdims=True)
    total = np.add.reduceat(weight, first, dtype=np.float64)[:, None]
    for _ in range(steps):
        r = p * share[text].astype(np.float32)
        r *= (weight / r.sum(1))[:, None]
        share = np.add.reduceat(r, first, axis=0, dtype=np.float64) / total
    likely = weight * (np.log(np.maximum((p * share[text]).sum(1), 1e-30)) + top[:, 0])
    return share, np.add.reduceat(likely, first, dtype=np.float64)


def _mixture(w: np.ndarray, weight: np.ndarray, n: np.ndarray, first: np.ndarray, penalty: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares and certainty of texts; text i has the n[i] rows of w and weight from first[i] on."""
    share, certainty = np.zeros((len(n), w.shape[1])), np.zeros(len(n))
    if not w.shape[1] or not len(w):
        return share, certainty
    rows = np.flatnonzero(n > 0)
    at = first[:-1][rows]
    single = np.add.reduceat(w * weight[:, None], at, axis=0, dtype=np.float64)
    best = single.argmax(1)
    odds = np.exp(single - single.max(1, keepdims=True))
    certainty[rows] = 1 / odds.sum(1)
    share[rows, best] = 1
    gain = penalty * np.log(np.add.reduceat(weight, at, dtype=np.float64) + 1)
    # no mixture is likelier than each word in its own best language
    open_ = np.add.reduceat(w.max(1) * weight, at, dtype=np.float64) - single[np.arange(len(rows)), best] > gain
    rows, most, gain = rows[open_], single[open_].max(1), gain[open_]
    allowed = np.ones((len(rows), w.shape[1]), bool)
    while len(rows):
        words = np.concatenate([np.arange(first[i], first[i + 1]) for i in rows])
        own = n[rows]
        at = np.concatenate(([0], np.cumsum(own)[:-1]))
        now, likely = _fit(w[words], weight[words], np.repeat(np.arange(len(rows)), own), at, allowed, steps)
        value = likely - gain * (allowed.sum(1) - 1)
        better = value > most
        share[rows[better]], most = now[better], np.maximum(value, most)
        allowed[np.arange(len(rows)), np.where(allowed, now, np.inf).argmin(1)] = False
        allowed &= (now > 0.01) | (now == now.max(1, keepdims=True))
        go = allowed.sum(1) > 1
        rows, most, gain, allowed = rows[go], most[go], gain[go], allowed[go]
    return share, certainty


def fit(docs: DataFrame, folds: int = FOLDS, fold: int = HELD_OUT) -> Model:
    """A model of every non-null lang in docs (doc_id, text, lang), from all rows that are not held out.

    Each task adds up its trigrams of each language, and sums of blocks of slots are merged in a second step; what
    reaches the driver is SLOTS numbers for each language.
    """
    rows = docs.where((remainder(folds) != fold) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")

    def out(lang: str, sums: np.ndarray) -> pa.RecordBatch:
        cells = sums.reshape(-1, BLOCK)
        return pa.RecordBatch.from_pydict({"lang": [lang] * len(cells), "block": pa.array(range(len(cells)), pa.int32()), "sums": [c.tobytes() for c in cells]})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            langs = np.array(b.column("lang").to_pylist(), dtype=object)
            for t in tb.chunks(b.column("text")):
                if len(t.at) == 2:
                    sums = total.setdefault(langs[t.first], np.zeros(SLOTS, np.int64))
                    for slot, code, _ in _steps(t.data):
                        sums += np.bincount(slot[code > 0], minlength=SLOTS)
                    continue
                slot, _, (_, _, code) = _trigrams(t)
                text = np.repeat(np.arange(len(t.at) - 1), np.diff(t.at))
                own = langs[t.first : t.last]
                for lang in set(own):
                    use = (own == lang)[text] & (code > 0)
                    total.setdefault(lang, np.zeros(SLOTS, np.int64))
                    total[lang] += np.bincount(slot[use], minlength=SLOTS)
            # many languages are handed on as they come, so that a task holds a bounded number of sums
            while len(total) > HELD_LANGUAGES:
                yield out(*total.popitem())
        for lang, sums in total.items():
            yield out(lang, sums)

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BLOCK, np.int64)
        for b in batches:
            for x in b.column("sums"):
                total += np.frombuffer(x.as_buffer(), np.int64)
        yield pa.RecordBatch.from_pydict({"lang": pa.array([key[0].as_py()], pa.string()), "block": pa.array([key[1].as_py()], pa.int32()), "sums": [total.tobytes()]})

    schema = "lang string, block int, sums binary"
    add.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    got = rows.mapInArrow(count, schema).groupBy("lang", "block").applyInArrow(add, schema).toArrow().to_pylist()
    languages = sorted({x["lang"] for x in got})
    counts = np.zeros((SLOTS, len(languages)))
    for x in got:
        counts[x["block"] * BLOCK : (x["block"] + 1) * BLOCK, languages.index(x["lang"])] = np.frombuffer(x["sums"], np.int64)
    # each model is smoothed with all languages' counts together
    pooled = (counts.sum(1, keepdims=True) + 0.1) / (counts.sum() + 0.1 * SLOTS)
    share = (counts + 500 * pooled) / (counts.sum(0, keepdims=True) + 500)
    return Model(languages, np.log(share).astype(np.float32))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred, score (0 to 1) and shares (language to share, above 0), whatever other columns it has.

    lang_pred is the language with the largest share, score that share times the certainty that no other single
    language explains the text better. A null text, or one without a letter, is ``und`` with score 0 and no shares; so
    is every text if no language was learned. Columns of these names are replaced.
    """
    docs = docs.drop("lang_pred", "score", "shares")
    names = docs.columns
    share = docs.sparkSession.sparkContext.broadcast(model)  # SLOTS numbers (256 KB) for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = share.value
        languages = [*own.languages, NO_LANGUAGE]
        for b in batches:
            mixed, sure = own.mixtures(b.column("text"))
            mixed = np.column_stack([mixed, np.where(mixed.sum(1) > 0, 0.0, 1e-12)])
            top = mixed.argmax(1)
            score = np.where(top < len(own.languages), mixed[np.arange(len(top)), top] * np.where(mixed[:, :-1].max(1, initial=0) == 1, sure, 1), 0.0)
            maps = [[(languages[j], float(m[j])) for j in np.flatnonzero(m > 1e-9)] for m in mixed]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([languages[j] for j in top], pa.string()), pa.array(np.clip(score, 0, 1), pa.float64()), pa.array(maps, pa.map_(pa.string(), pa.float64()))], names=[*names, "lang_pred", "score", "shares"])

    out = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("shares", T.MapType(T.StringType(), T.DoubleType()))])
    return docs.mapInArrow(run, out)


def classify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, shares) for every row of docs (doc_id, text, lang)."""
    model = fit(docs)
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out(FOLDS, HELD_OUT).alias("held_out"), "lang_pred", "score", "shares")
