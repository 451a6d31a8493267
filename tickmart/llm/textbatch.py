"""Arrow text columns as flat byte arrays, so that word and line statistics are a few numpy passes over many texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

from ..sources.session import prepare

#: The bytes between words: [\x20\x09-\x0D].
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

CHUNK_BYTES = 512 << 10
#: Of a longer text, at most so many bytes at a time are widened to numbers.
SEGMENT = 2 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)
_RANDOM = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of a few MB, whatever their lengths: several are in flight in each task.

    These are settings of the session, and stay for later queries.
    """
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2048")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


@dataclass
class Texts:
    """rows [first, last) of a batch: data holds their bytes, text i is data[at[i]:at[i + 1]]."""

    first: int
    last: int
    data: np.ndarray
    at: np.ndarray


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[Texts]:
    """Runs of whole texts of about ``most`` bytes; a longer text is a run of its own. Null texts are empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        last = min(last, len(column))
        yield Texts(first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def spans(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of true within each text: starts, ends, and for each text the place of its first run (and a last entry)."""
    n = len(inside)
    before = np.empty(n + 1, bool)
    before[0], before[1:] = False, inside
    after = np.append(inside, False)
    cut = np.zeros(n + 1, bool)
    cut[at] = True
    starts = np.flatnonzero(after & (~before | cut))
    ends = np.flatnonzero(before & (~after | cut))
    return starts, ends, np.searchsorted(starts, at)


def words(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return spans(~SEPARATOR[t.data], t.at)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 65536)
        for key, base in (("up", int(_MULTIPLIER)), ("down", pow(int(_MULTIPLIER), -1, 2**64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[key] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _power(len(data) + 1)
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_RANDOM[data] * up[: len(data)], out=running[1:])
    return mix((running[ends] - running[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def _long_hash(data: np.ndarray) -> np.uint64:
    """The hash of all of data, a segment at a time."""
    up, total = _power(SEGMENT)[0], 0
    for at in range(0, len(data), SEGMENT):
        part = _RANDOM[data[at : at + SEGMENT]] * up[: min(SEGMENT, len(data) - at)]
        total += int(part.sum(dtype=np.uint64)) * pow(int(_MULTIPLIER), at, 2**64)
    return mix(np.array([(total + len(data)) % 2**64], np.uint64))[0]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each span, by one running polynomial over the bytes.

    Spans of more than a segment of data must be in order and apart.
    """
    if len(data) <= SEGMENT:
        return _hashes(data, starts, ends)
    out, first = np.empty(len(starts), np.uint64), 0
    while first < len(starts):
        base = starts[first]
        last = int(np.searchsorted(ends, base + SEGMENT, "right"))
        if last <= first:
            out[first] = _long_hash(data[base : ends[first]])
            first += 1
        else:
            out[first:last] = _hashes(data[base : ends[last - 1]], starts[first:last] - base, ends[first:last] - base)
            first = last
    return out


def per_text(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of values over [at[i], at[i + 1])."""
    if len(at) == 2:
        return values[at[0] : at[1]].sum(dtype=np.float64 if values.dtype.kind == "f" else np.int64, keepdims=True)
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[at[1:]] - total[at[:-1]]
