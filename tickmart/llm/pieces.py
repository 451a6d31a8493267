"""Piece encoding and decoding of a SentencePiece BPE model by streaming Viterbi.

The lattice has a node for each boundary between characters and an edge for each piece. The model at hand scores pieces
by merge order, and its encoding is not the path of the largest sum of scores; it is the only path whose neighbouring
pieces all stay apart when they are merged alone. So an edge from boundary i costs nothing if its piece and the piece
that ends the best path to i stay apart, and is closed otherwise; each boundary keeps one backpointer. A boundary
survives as long as the text after it is the start of some piece, so the window of text is never longer than the longest
piece. With every character, the backpointer paths of the boundaries that survive are followed back, and ids are
committed up to the boundary in which they converge.

What is left of the lattice after a commit is small, and the same again and again, so steps are remembered: a state of the
lattice and a character give the next state and the ids committed. The memory has a bounded size and changes no id.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPACE = "▁"


class Pieces:
    """The normal pieces of a model with their merge scores, and its byte pieces."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(n)]
        self.byte_id = {int(self.text[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.is_byte = np.isin(np.arange(n), [*self.byte_of])
        self.unknown = model.unk_id()
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.id = {self.text[i]: i for i in plain}
        self.score = {self.text[i]: model.get_score(i) for i in plain}
        self.longest = max(map(len, self.id))
        #: Of the pieces, those that merging their own characters gives.
        self.made = {t: i for t, i in self.id.items() if len(self.merged(t)) == 1}
        #: The pieces as a tree: from node and character to node, and for each node its piece, or -1, and whether it goes on.
        self.go: dict[int, int] = {}
        self.piece_at, self.goes_on, self.depth = [-1], [True], [0]
        for t, i in self.made.items():
            node = 0
            for c in t:
                self.goes_on[node] = True
                if (key := node << 21 | ord(c)) not in self.go:
                    self.go[key] = len(self.piece_at)
                    self.piece_at.append(-1)
                    self.goes_on.append(False)
                    self.depth.append(self.depth[node] + 1)
                node = self.go[key]
            self.piece_at[node] = i
        self.known_apart: dict[int, bool] = {}

    def merged(self, text: str) -> list[str]:
        """Merge the adjacent pair of the best score, the leftmost of several, until none is a piece. For short texts."""
        parts = list(text)
        while True:
            best = max(((self.score[x], -i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if (x := a + b) in self.score), default=None)
            if best is None:
                return parts
            i = -best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def apart(self, a: int, b: int) -> bool:
        """Whether pieces a and b, side by side, are what merging their characters gives."""
        known = self.known_apart.get(a << 32 | b)
        if known is None:
            if len(self.known_apart) >= 1_000_000:
                self.known_apart.clear()
            known = self.known_apart[a << 32 | b] = self.merged(self.text[a] + self.text[b]) == [self.text[a], self.text[b]]
        return known


class State:
    """The lattice after the last committed boundary, which is boundary 0; the last boundary is the end of the text so far.

    start and piece are the backpointer of each boundary that a surviving path crosses: where its last piece starts, and
    which it is. Of boundary 0 the piece is that before, or -1 if nothing can be merged across. live has the boundaries
    that survive, the last one first, with the tree's node of the text from there on.
    """

    __slots__ = ("live", "piece", "start", "to")

    def __init__(self, start: tuple[int, ...], piece: tuple[int, ...], live: tuple[tuple[int, int], ...]):
        self.start, self.piece, self.live = start, piece, live
        self.to: dict[str, tuple[State, list[int]]] = {}

    def ids(self) -> list[int]:
        """The ids of the path to the last boundary."""
        return _path(self.start, self.piece, len(self.start) - 1)


def _path(start: list[int] | tuple[int, ...], piece: list[int] | tuple[int, ...], end: int) -> list[int]:
    ids = []
    while end:
        ids.append(piece[end])
        end = start[end]
    return ids[::-1]


def _converged(start: list[int], live: list[tuple[int, int]]) -> int:
    """The boundary in which the paths of all that survive converge."""
    ends = {at for at, _ in live}
    while len(ends) > 1:  # the last of them cannot be where they meet: follow it back
        end = max(ends)
        ends.remove(end)
        ends.add(start[end])
    return ends.pop()


class Lattice:
    """Steps from state to state, remembered for at most ``most`` states at a time."""

    def __init__(self, pieces: Pieces, most: int = 250_000):
        self.pieces, self.most = pieces, most
        self._known: dict[tuple, State] = {}
        self.root = State((0,), (-1,), ((0, 0),))

    def _state(self, start: tuple[int, ...], piece: tuple[int, ...], live: tuple[tuple[int, int], ...]) -> State:
        if len(start) == 1:
            return self.root
        key = (start, piece, live)
        state = self._known.get(key)
        if state is None:
            if len(self._known) >= self.most:
                self._known.clear()
                self.root.to.clear()
            state = self._known[key] = State(start, piece, live)
        return state

    def step(self, state: State, c: str) -> tuple[State, list[int]]:
        """The state after one more character, and the ids that it commits."""
        p = self.pieces
        if c not in p.made:  # no piece holds it
            found = self.root, state.ids() + ([p.byte_id[b] for b in c.encode()] if p.byte_id else [p.unknown])
        else:
            found = self._advanced(state, ord(c))
        if self.most:
            state.to[c] = found
        return found

    def _advanced(self, state: State, code: int) -> tuple[State, list[int]]:
        p = self.pieces
        start, piece, last = [*state.start], [*state.piece], len(state.start) - 1
        live, crossed, open_ = [(last + 1, 0)], False, True
        for at, node in state.live:
            node = p.go.get(node << 21 | code)
            if node is None:
                continue
            crossed |= at != last
            if open_ and (i := p.piece_at[node]) >= 0 and (piece[at] < 0 or p.apart(piece[at], i)):
                start.append(at)
                piece.append(i)
                open_ = False
            if p.goes_on[node]:
                live.append((at, node))
        if open_:
            raise AssertionError("a boundary without a path")
        end = _converged(start, live)
        ids = _path(start, piece, end)
        # what is left: the boundaries on the surviving paths, from the committed one on
        used = {end}
        for at, _ in live:
            while at not in used:
                used.add(at)
                at = start[at]
        number = {at: k for k, at in enumerate(sorted(used))}
        kept = sorted(used)[1:]
        before = -1 if end == last and not crossed else piece[end] if any(at == end for at, _ in live) else -1
        return self._state((0, *[number[start[at]] for at in kept]), (before, *[piece[at] for at in kept]), tuple((number[at], node) for at, node in live)), ids


class Stream:
    """Feed text in parts of any length, get ids: push() returns those committed so far, finish() the rest."""

    def __init__(self, lattice: Lattice):
        self.lattice, self.state, self.commits = lattice, lattice.root, 0

    @property
    def held(self) -> int:
        """The number of boundaries on surviving paths after the last committed one."""
        return len(self.state.start) - 1

    @property
    def window(self) -> int:
        """The number of characters after the first boundary that survives."""
        return max(self.lattice.pieces.depth[node] for _, node in self.state.live)

    def push(self, text: str) -> list[int]:
        out: list[int] = []
        state, commits, step = self.state, 0, self.lattice.step
        for c in text:
            found = state.to.get(c)
            state, ids = found if found is not None else step(state, c)
            if ids:
                out += ids
                commits += 1
        self.state = state
        self.commits += commits
        return out

    def finish(self) -> list[int]:
        """Nothing follows: only the last boundary survives."""
        ids, self.state = self.state.ids(), self.lattice.root
        return ids


class Codec:
    """Encodes and decodes whole texts, each as one stream."""

    def __init__(self, path: str, most_states: int = 250_000):
        self.pieces = Pieces(path)
        self.lattice = Lattice(self.pieces, most_states)

    def encode(self, text: str) -> list[int]:
        """An empty text has no ids. Spaces become marks, and one mark is put in front."""
        if not text:
            return []
        stream = Stream(self.lattice)
        ids = stream.push(_SPACE + text.replace(" ", _SPACE))
        return ids + stream.finish()

    def decode(self, ids: list[int]) -> str:
        """Byte pieces are joined and read as UTF-8; marks become spaces, but for the one in front."""
        p, out, at = self.pieces, [], 0
        own = np.asarray(ids, np.int64)
        in_bytes = np.flatnonzero(p.is_byte[own])
        for some in np.split(in_bytes, np.flatnonzero(np.diff(in_bytes) > 1) + 1) if len(in_bytes) else []:
            out += [p.text[i] for i in ids[at : some[0]]]
            out.append(bytes(p.byte_of[i] for i in ids[some[0] : some[-1] + 1]).decode("utf-8", "replace"))
            at = some[-1] + 1
        text = "".join([*out, *[p.text[i] for i in ids[at:]]]).replace(_SPACE, " ")
        return text[1:] if text.startswith(" ") else text


@lru_cache(2)
def _codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """docs with ids (array of int) of text, whatever other columns it has: null for a null text, empty for an empty one."""
    docs = docs.drop("ids")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                ids = [None if t is None else codec.encode(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.list_(pa.int32()))], names=[*names, "ids"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(rows: DataFrame, path: str) -> DataFrame:
    """rows with decoded (string) of ids, whatever other columns it has: null for null ids."""
    rows = rows.drop("decoded")
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                texts = [None if i is None else codec.decode(i) for i in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*names, "decoded"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())]))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_ids, ids_crc32, n_byte_ids, decoded_crc32, round_trip) of every row of docs (doc_id, text).

    ids_crc32 is over little-endian unsigned 32-bit ids, decoded_crc32 over the decoded text in UTF-8; a null text counts
    as empty. round_trip tells whether the decoded text is the text; a text that holds the space mark itself is not.
    Encoding and decoding share one pass, so ids need not leave the task.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for b in batches:
            rows = []
            for text in b.column("text").to_pylist():
                ids = codec.encode(text or "")
                own, decoded = np.array(ids, "<u4"), codec.decode(ids)
                rows.append((len(ids), zlib.crc32(own.tobytes()), int(codec.pieces.is_byte[own].sum()), zlib.crc32(decoded.encode()), decoded == (text or "")))
            n, crc, in_bytes, back, same = zip(*rows, strict=True) if rows else ([], [], [], [], [])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(in_bytes, pa.int64()), pa.array(back, pa.int64()), pa.array(same, pa.bool_())], names=["doc_id", "n_ids", "ids_crc32", "n_byte_ids", "decoded_crc32", "round_trip"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(digest, "doc_id long, n_ids long, ids_crc32 long, n_byte_ids long, decoded_crc32 long, round_trip boolean")
