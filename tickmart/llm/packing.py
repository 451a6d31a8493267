"""Best-fit packing of documents into token sequences of a fixed capacity.

Documents become token pieces, pieces are dealt evenly over packing tasks, and each task packs its share by
best-two-fit: fill a bin greedily with the longest piece that fits, then, if a gap is left, replace the bin's
smallest piece by the two unpacked pieces that fill the gap it leaves most tightly.  A task sees tens of thousands
of sequences, so at most one of them is left part empty for want of pieces.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import written

CAPACITY = 1024
END_ID = 2
PIECES_PER_TASK = 65_536

_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: From the second white-space character on: there the published pattern's lookahead always breaks the text.
_BREAK = re.compile(f"[{_SPACE}](?=[{_SPACE}][^{_SPACE}])")


class ByteBPE:
    """Ids of a byte-level BPE vocabulary given as ranks.

    The published split pattern holds one lookahead, which keeps its engine on the slow path. Texts are broken first
    where that lookahead would break them; what remains needs the plain alternatives only and gives the same ids.
    specials are texts that are one id wherever they occur; the text on either side is encoded on its own.
    """

    def __init__(self, ranks_path: str, pattern: str, specials: dict[str, int] | None = None):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        plain = pattern.replace(r"|\s+(?!\S)", "")
        self._plain = tiktoken.Encoding("plain", pat_str=plain, mergeable_ranks=ranks, special_tokens={})
        self._specials = specials or {}
        longest_first = sorted(self._specials, key=len, reverse=True)
        self._special = re.compile("|".join(map(re.escape, longest_first))) if longest_first else None

    def encode(self, text: str) -> list[int]:
        if self._special is None or not (found := [*self._special.finditer(text)]):
            return self._between(text)
        ids, at = [], 0
        for m in found:
            ids += self._between(text[at : m.start()])
            ids.append(self._specials[m.group()])
            at = m.end()
        return ids + self._between(text[at:])

    def _between(self, text: str) -> list[int]:
        cuts = [m.end() for m in _BREAK.finditer(text)]
        if not cuts:
            return self._plain.encode_ordinary(text)
        ids: list[int] = []
        for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True):
            ids += self._plain.encode_ordinary(text[a:b])
        return ids


@lru_cache(2)
def _tokenizer(path: str, pattern: str, specials: tuple[tuple[str, int], ...]) -> ByteBPE:
    return ByteBPE(path, pattern, dict(specials))


def special_tokens(path: str) -> dict[str, int]:
    """The special tokens, text to id, of a tokenizer file in JSON."""
    with open(path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"] if t["special"]}


def token_pieces(docs: DataFrame, ranks_path: str, pattern: str, specials: dict[str, int] | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32[, ids]) of every row of docs (doc_id, text).

    A null or empty text is the end id alone. A document longer than the capacity is cut from its end, so only its
    first piece may be shorter. Repeated rows each give their own pieces; a null doc_id is carried along. The text of
    one of specials is its single id; without specials such texts are ordinary.
    """
    named = tuple(sorted((specials or {}).items()))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(ranks_path, pattern, named)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows: list[tuple] = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    ids = np.array([*tokenizer.encode(text or ""), end_id], dtype="<u4")
                    start, end, k = 0, (len(ids) - 1) % capacity + 1, 0
                    while start < len(ids):
                        own = ids[start:end]
                        rows.append((doc_id, k, start, end - start, zlib.crc32(own.tobytes()), *([own.astype(np.int32)] if with_ids else [])))
                        start, end, k = end, end + capacity, k + 1
                columns = list(zip(*rows, strict=True))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=False)], names=schema.names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, schema)


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each length (1 to capacity): the number of its bin, and its offset there. Ties go to the earlier row.

    Unpacked pieces are held as a stack for each length. Two bit sets over the lengths that are left, one of them
    reversed, answer both questions in one word-parallel step each: the longest length up to a gap, and a pair of
    lengths with a given sum.
    """
    lengths = np.asarray(lengths, dtype=np.int64)
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    stack = np.lexsort((-np.arange(len(lengths)), lengths))
    left = np.bincount(lengths, minlength=capacity + 1)
    top = np.cumsum(left).tolist()
    left = left.tolist()
    stack = stack.tolist()
    have = sum(1 << n for n, k in enumerate(left) if k)
    mirrored = sum(1 << (capacity - n) for n, k in enumerate(left) if k)

    def take(n: int) -> int:
        nonlocal have, mirrored
        left[n] -= 1
        top[n] -= 1
        if not left[n]:
            have ^= 1 << n
            mirrored ^= 1 << (capacity - n)
        return stack[top[n]]

    def give_back(n: int) -> None:
        nonlocal have, mirrored
        if not left[n]:
            have |= 1 << n
            mirrored |= 1 << (capacity - n)
        left[n] += 1
        top[n] += 1

    def pair(total: int) -> tuple[int, int] | None:
        both = have & (mirrored >> (capacity - total))
        if both and not total % 2 and left[total // 2] == 1:
            both &= ~(1 << (total // 2))
        return (n := both.bit_length() - 1, total - n) if both else None

    number = 0
    while have:
        gap, own, taken = capacity, [], []
        while fits := have & ((1 << (gap + 1)) - 1):
            n = fits.bit_length() - 1
            own.append(n)
            taken.append(take(n))
            gap -= n
        if gap:
            smallest = own[-1]
            for total in range(smallest + gap, smallest, -1):
                if two := pair(total):
                    own[-1:] = two
                    taken[-1:] = []
                    give_back(smallest)
                    taken += [take(two[0]), take(two[1])]
                    break
        at = 0
        for n, i in zip(own, taken, strict=True):
            bins[i], offsets[i] = number, at
            at += n
        number += 1
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY, pieces_per_task: int = PIECES_PER_TASK) -> DataFrame:
    """pieces (doc_id, piece, length, ...) with sequence_id and offset (gapless from 0 in each sequence).

    The number of packing tasks follows the number of pieces, so each packs thousands of sequences from rows of fixed
    size. Rows are dealt in turn, so repeated or null ids do not gather in one task. They are dealt from a stored table
    and put in a fixed order within a task, so a task that runs again gives the same placements. An empty table gives an
    empty result.
    """
    pieces = written(pieces)
    tasks = max(1, -(-pieces.count() // pieces_per_task))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        table = table.sort_by([(c, "ascending") for c in ("doc_id", "piece", "start", "length", "ids_crc32") if c in table.column_names])
        bins, offsets = best_two_fit(table.column("length").to_numpy(), capacity)
        first = TaskContext.get().partitionId() << 33
        yield from table.append_column("sequence_id", pa.array(bins + first)).append_column("offset", pa.array(offsets)).to_batches(8192)

    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return pieces.repartition(tasks).mapInArrow(place, schema)


def pack_documents(docs: DataFrame, ranks_path: str, pattern: str, specials: dict[str, int] | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Every row of docs (doc_id, text; other columns are ignored) as placed pieces."""
    return pack(token_pieces(docs, ranks_path, pattern, specials, capacity, end_id, with_ids), capacity)
