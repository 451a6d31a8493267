"""Exact n-gram Jaccard join by grouped prefixes.

1. A document's set is its distinct word shingles, as 64-bit hashes. A table of fixed size holds how many documents
   have the shingles of each of its slots; by it, rarer shingles come first in every set.
2. Documents with equal sets are one class. Two sets similar enough share a shingle among their first tenth or so
   (their prefixes), so classes with equal prefix and size collapse into one group.
3. Groups meet where they share a prefix shingle. Size, and bitmaps in which each shingle flips one bit, bound the
   similarity of all members of two groups from above; pairs that cannot pass are dropped in numpy blocks.
4. Where few groups meet, all their pairs are tried; elsewhere first each group with its nearest one only. What these
   pairs verify is merged into components. Between different components that are left, members of groups are tried in
   the same way: of large groups first each member with its nearest one, and then every pair that is left. So a large
   group of near copies costs few pairs, and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbatch as tb
from .components import components
from .scratch import written
from .skew import copied, dealt, hot_keys, threshold

GRAM = 3
PERCENT = 90
SLOT_BITS = 20
SLOT_BLOCK = 1 << 14
#: Groups that meet at a shingle are compared in blocks of about so many.
BLOCK_ROWS = 2048
#: Where no more groups than this meet, all their pairs are tried at once.
FEW = 4
#: In larger blocks a group looks for its nearest one only where the shingle is among so many of its prefix, picked by hash.
LEADS = 4
#: Two groups with no more pairs of members than this have all of them verified; of larger ones, members are compared in blocks.
FEW_MEMBERS = 64
#: Ids of so many pairs are broadcast to find their texts.
FEW_PAIRS = 200_000


def shingle_sets(t: tb.Texts, gram: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text. With fewer words, all of them are one shingle; without, none."""
    data = tb.LOWER[t.data]
    starts, ends, first = tb.words(t)
    word = tb.span_hashes(data, starts, ends)
    joined = word.copy()
    for k in range(1, min(gram, len(word))):
        joined[: len(word) - k] = tb.mix(joined[: len(word) - k] * np.uint64(0x9E3779B97F4A7C15) + word[k:])
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= gram:
            own = np.sort(joined[a : b - gram + 1])
            out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif b > a:
            x = word[a]
            with np.errstate(over="ignore"):
                for w in word[a + 1 : b]:
                    x = tb.mix(x * np.uint64(0x9E3779B97F4A7C15) + w)
                out.append(tb.mix(np.array([x ^ np.uint64(b - a)])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def slot_counts(docs: DataFrame, gram: int) -> np.ndarray:
    """For each slot of shingle hashes, the documents with a shingle in it, over all of docs; 2**SLOT_BITS numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SLOT_BITS, np.int64)
        for b in batches:
            for t in tb.chunks(b.column("text")):
                total += np.bincount((np.concatenate(shingle_sets(t, gram)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64), minlength=len(total))
        for k, part in enumerate(total.reshape(-1, SLOT_BLOCK)):
            at = np.flatnonzero(part)
            if len(at):
                yield pa.RecordBatch.from_pydict({"block": pa.array([k], pa.int32()), "at": [at.astype(np.uint16).tobytes()], "n": [part[at].astype(np.uint32).tobytes()]})

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOT_BLOCK, np.int64)
        for b in batches:
            for at, n in zip(b.column("at"), b.column("n"), strict=True):
                total[np.frombuffer(at.as_buffer(), np.uint16)] += np.frombuffer(n.as_buffer(), np.uint32)
        yield pa.RecordBatch.from_pydict({"block": pa.array([key[0].as_py()], pa.int32()), "sums": [total.tobytes()]})

    add.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    got = docs.select("text").mapInArrow(count, "block int, at binary, n binary").groupBy("block").applyInArrow(add, "block int, sums binary").toArrow().to_pylist()
    counts = np.zeros(1 << SLOT_BITS, np.int64)
    for x in got:
        counts[x["block"] * SLOT_BLOCK : (x["block"] + 1) * SLOT_BLOCK] = np.frombuffer(x["sums"], np.int64)
    return counts


def _bitmap(own: np.ndarray) -> bytes:
    """At least as many bits as shingles; each shingle flips one."""
    bits = max(64, 1 << int(len(own) - 1).bit_length())
    place = (tb.mix(own ^ np.uint64(0xD6E8FEB86659FD93)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=bits) & 1).astype(np.uint8).tobytes()


def sketches(docs: DataFrame, gram: int, percent: int) -> DataFrame:
    """(doc_id, n, f1, f2, prefix, bitmap) of every row: size, 128-bit fingerprint, prefix and bitmap of its set."""
    counts = slot_counts(docs, gram)
    rank = docs.sparkSession.sparkContext.broadcast(np.minimum(255, 8 * np.log2(1.0 + counts)).astype(np.uint64))  # 2**SLOT_BITS numbers

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = rank.value
        for b in batches:
            for t in tb.chunks(b.column("text")):
                n, prints, prefixes, bitmaps = [], [], [], []
                for own in shingle_sets(t, gram):
                    size = len(own)
                    n.append(size)
                    prints.append((int(np.bitwise_xor.reduce(tb.mix(own + np.uint64(size)))), int(tb.mix(own ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64))) if size else (0, 0))
                    key = (ranks[own >> np.uint64(64 - SLOT_BITS)] << np.uint64(56)) | (own >> np.uint64(8))
                    length = size - -(-percent * size // 100) + 1 if size else 0
                    prefixes.append(own[np.argsort(key, kind="stable")[:length]].view(np.int64))
                    bitmaps.append(_bitmap(own) if size else b"")
                f = np.array(prints, np.uint64).reshape(-1, 2).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(t.first, t.last - t.first), pa.array(n, pa.int64()), pa.array(f[:, 0]), pa.array(f[:, 1]), pa.array(prefixes, pa.list_(pa.int64())), pa.array(bitmaps, pa.binary())], names=["doc_id", "n", "f1", "f2", "prefix", "bitmap"])

    return written(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sketch, "doc_id long, n long, f1 long, f2 long, prefix array<bigint>, bitmap binary"))


def collapse(classes: DataFrame) -> DataFrame:
    """One row for each class (gid, node, no prefix) and, after them, one for each group (gid, n, prefix, bitmap, radius).

    gid is the smallest node with that prefix and size. radius is the most bits by which a member's bitmap differs from
    the group's. A group is read as a sorted stream; one of very many classes is dealt into several groups.
    """
    keyed = classes.withColumn("key", F.xxhash64("n", "prefix"))
    ordered = dealt(keyed, hot_keys(keyed, ["key"], keyed.count()), ["key"], "node").repartition("key", "part").sortWithinPartitions("key", "part", "n", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, group = None, None
        rows: list[tuple] = []

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.int64())
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["gid", "node", "n", "prefix", "bitmap", "radius"])
            rows.clear()
            return out

        for b in batches:
            prefixes = b.column("prefix")
            for i, (key, part, node, n, bitmap) in enumerate(zip(*(b.column(c).to_pylist() for c in ("key", "part", "node", "n", "bitmap")), strict=True)):
                if (key, part, n) != last:
                    if group is not None:
                        rows.append(tuple(group))
                    last, group = (key, part, n), [node, None, n, prefixes[i].values.to_numpy(), bitmap, 0]
                else:
                    group[5] = max(group[5], int(np.bitwise_count(np.frombuffer(group[4], np.uint64) ^ np.frombuffer(bitmap, np.uint64)).sum()))
                rows.append((group[0], node, n, None, bitmap, None))
                if len(rows) >= 4096:
                    yield flushed()
        if group is not None:
            rows.append(tuple(group))
        if rows:
            yield flushed()

    return written(ordered.mapInArrow(run, "gid long, node long, n long, prefix array<bigint>, bitmap binary, radius long"))


def meetings(groups: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(token, lead, left, right, part, gid, size) for groups that meet at a prefix shingle, in blocks of about 2 * block_rows at most.

    A shingle of very many groups is cut into chunks, and each pair of chunks is a block of its own. lead marks LEADS
    shingles of each group, mostly the same ones in similar groups.
    """
    picked = F.slice(F.array_sort(F.transform("prefix", lambda x: F.struct(F.xxhash64(x).alias("h"), x.alias("x")))), 1, LEADS)
    known = groups.select("gid", "prefix", F.transform(picked, lambda y: y["x"]).alias("leads"))
    tokens = known.select("gid", "leads", F.explode("prefix").alias("token")).select("gid", "token", F.array_contains("leads", F.col("token")).alias("lead"))
    shared = written(tokens.groupBy("token").agg(F.count("*").alias("size")).where("size > 1"))
    rows = tokens.join(shared, "token").withColumn("parts", F.ceil(F.col("size") / block_rows).cast("int"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("gid"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return written(rows.select("token", "lead", F.least("part", "other").alias("left"), F.greatest("part", "other").alias("right"), "part", "gid", "size"))


def _apart(i: np.ndarray, j: np.ndarray, lanes: np.ndarray, at: np.ndarray, width: np.ndarray) -> np.ndarray:
    """How many bits differ between rows i and j; the wider of two bitmaps is folded to the other's width."""
    out = np.zeros(len(i), np.int64)
    wide, thin = np.where(width[i] >= width[j], i, j), np.where(width[i] >= width[j], j, i)
    for w, v in {*zip(width[wide].tolist(), width[thin].tolist(), strict=True)}:
        for some in np.array_split(pick := np.flatnonzero((width[wide] == w) & (width[thin] == v)), 1 + len(pick) * w // 1_000_000):
            x = np.bitwise_xor.reduce(lanes[at[wide[some]][:, None] + np.arange(w)].reshape(len(some), w // v, v), axis=1)
            out[some] = np.bitwise_count(x ^ lanes[at[thin[some]][:, None] + np.arange(v)]).sum(1)
    return out


def block_pairs(x: pa.Table, percent: int, nearest: bool) -> np.ndarray:
    """Pairs (a, b), a < b, of groups that may hold a link, in a table of whole blocks, each sorted by n.

    All pairs of all blocks at one distance between rows are compared in one step. A row whose partner at that distance
    is too small for it needs no farther one.
    """
    n, gid, radius, label, part, size, lead = (x.column(c).to_numpy() for c in ("n", "gid", "radius", "label", "part", "size", "lead"))
    key = np.column_stack([x.column(c).to_numpy() for c in ("token", "left", "right")])
    block = np.concatenate(([0], np.cumsum((key[1:] != key[:-1]).any(1))))
    bitmaps = x.column("bitmap").combine_chunks()
    bitmaps = bitmaps if isinstance(bitmaps, pa.Array) else pa.concat_arrays(bitmaps.chunks)
    ends = np.frombuffer(bitmaps.buffers()[1], np.int32)[bitmaps.offset : bitmaps.offset + len(bitmaps) + 1].astype(np.int64)
    lanes = np.frombuffer(bitmaps.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(np.uint64)
    at, width = (ends[:-1] - ends[0]) // 8, np.diff(ends) // 8
    one_nearest = nearest & (size > FEW)
    best, best_of = np.full(len(n), np.iinfo(np.int64).max), np.full(len(n), -1)
    found: list[np.ndarray] = []
    rows, step = np.flatnonzero(~one_nearest | lead), 0
    while True:
        step += 1
        rows = rows[rows >= step]
        rows = rows[(block[rows - step] == block[rows]) & (100 * n[rows - step] >= percent * n[rows])]
        if not len(rows):
            break
        i, j = rows, rows - step
        use = ((label[i] != label[j]) | (label[i] < 0)) & ((key[i, 1] == key[i, 2]) | (part[i] != part[j]))
        i, j = i[use], j[use]
        apart = _apart(i, j, lanes, at, width) - radius[i] - radius[j]
        # sets of sizes p and q are similar enough if they differ in at most (p + q)(100 - t) / (100 + t) shingles
        ok = apart * (100 + percent) <= (n[i] + n[j]) * (100 - percent)
        i, j, apart = i[ok], j[ok], apart[ok]
        every = ~one_nearest[i]
        found.append(np.column_stack([gid[i[every]], gid[j[every]]]))
        closer = ~every & (apart < best[i])
        best[i[closer]], best_of[i[closer]] = apart[closer], j[closer]
    got = np.flatnonzero(best_of >= 0)
    found.append(np.column_stack([gid[got], gid[best_of[got]]]))
    return np.unique(np.sort(np.concatenate(found), axis=1), axis=0)


def candidates(met: DataFrame, groups: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """(a, b), a < b: pairs of groups (gid, n, bitmap, radius, label) that may hold a link between different labels.

    A label under 0 stands for several. nearest keeps of the pairs in large blocks only that of each group with the one
    before it whose bitmap differs least, in the blocks of its lead shingles.
    """
    columns = ["token", "lead", "left", "right", "part", "size", "gid", "n", "bitmap", "radius", "label"]
    rows = met.join(groups.select("gid", "n", "bitmap", "radius", "label"), "gid").select(columns).repartition("token", "left", "right").sortWithinPartitions("token", "left", "right", "n", "gid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def emit(x: pa.Table) -> Iterator[pa.RecordBatch]:
            if x.num_rows > 1 and len(pairs := block_pairs(x, percent, nearest)):
                yield pa.RecordBatch.from_pydict({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

        for b in batches:
            held.append(b)
            if sum(h.num_rows for h in held) < 20_000:
                continue
            x = pa.Table.from_batches(held)
            last = x.slice(x.num_rows - 1)
            same = np.ones(x.num_rows, bool)
            for c in ("token", "left", "right"):
                same &= x.column(c).to_numpy() == last.column(c)[0].as_py()
            cut = int(np.flatnonzero(same)[0])
            yield from emit(x.slice(0, cut))
            held = x.slice(cut).combine_chunks().to_batches()
        if held:
            yield from emit(pa.Table.from_batches(held))

    return rows.mapInArrow(run, "a long, b long").distinct()


def verified(pairs: DataFrame, docs: DataFrame, gram: int, percent: int) -> DataFrame:
    """The pairs (a, b) of doc_ids whose whole sets are similar enough, counted exactly.

    The set of each b travels with its pair; that of a is sent once to each task that has pairs of it. Ids with very many
    pairs are dealt over several tasks.
    """
    pairs = written(pairs)
    n = pairs.count()
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    ids = F.broadcast(ids) if n <= FEW_PAIRS else ids

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in tb.chunks(b.column("text")):
                own = pa.array([s.view(np.int64) for s in shingle_sets(t, gram)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(t.first, t.last - t.first), own], names=["doc_id", "set"])

    used = docs.select(F.col("doc_id").cast("long"), "text").join(ids, "doc_id", "left_semi")
    known = written(used.mapInArrow(sets, "doc_id long, set array<bigint>").dropDuplicates(["doc_id"]))
    hot_a, hot_b = hot_keys(pairs, ["a"], n), hot_keys(pairs, ["b"], n)
    of_b = dealt(pairs, hot_b, ["b"], "a").join(copied(known.toDF("b", "set"), hot_b, ["b"]), ["b", "part"]).select("a", "b", "set")
    of_a = known.join(pairs.select(F.col("a").alias("doc_id")).distinct(), "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.lit(None).cast("long").alias("b"), "set")
    met = dealt(of_b, hot_a, ["a"], "b").unionByName(copied(of_a, hot_a, ["a"])).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = None, np.zeros(0, np.int64)
        for b in batches:
            ids, partners, flat, ends = b.column("a").to_pylist(), b.column("b").to_pylist(), b.column("set").values.to_numpy(), b.column("set").offsets.to_numpy()
            linked = []
            for i, (a, partner) in enumerate(zip(ids, partners, strict=True)):
                one = flat[ends[i] : ends[i + 1]].view(np.uint64)
                if partner is None:
                    now, own = a, one.copy()
                elif a == now and len(one) and len(own):
                    less, more = (one, own) if len(one) < len(own) else (own, one)
                    common = int((more[np.minimum(np.searchsorted(more, less), len(more) - 1)] == less).sum())
                    if 100 * common >= percent * (len(one) + len(own) - common):
                        linked.append((a, partner))
            if linked:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*linked, strict=True)], names=["a", "b"])

    return written(met.select("a", "b", "set").mapInArrow(compare, "a long, b long"))


def differing(pairs: DataFrame, labelled: DataFrame) -> DataFrame:
    """Of pairs of groups (a, b; a = b for a group's own), those with members (gid, node, label) of different labels.

    With the numbers of their members, size_a and size_b.
    """
    of_group = labelled.groupBy("gid").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size"))
    label = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(-1)
    n = pairs.count()
    for side in ("a", "b"):
        own, hot = of_group.select(F.col("gid").alias(side), F.col("size").alias(f"size_{side}"), label.alias(f"label_{side}")), hot_keys(pairs, [side], n, thin=True)
        pairs = dealt(pairs, hot, [side], "b" if side == "a" else "a").join(copied(own, hot, [side]), [side, "part"]).drop("part")
    return written(pairs.where("label_a < 0 or label_b < 0 or label_a <> label_b").select("a", "b", "size_a", "size_b"))


def member_pairs(pairs: DataFrame, labelled: DataFrame) -> DataFrame:
    """(a, b), a < b: all pairs of members of different labels of the groups in pairs (a, b)."""
    n = pairs.count()
    hot_a, hot_b = hot_keys(pairs, ["a"], n, thin=True), hot_keys(pairs, ["b"], n, thin=True)
    left, right = labelled.select(F.col("gid").alias("a"), F.col("node").alias("na"), F.col("label").alias("la")), labelled.select(F.col("gid").alias("b"), F.col("node").alias("nb"), F.col("label").alias("lb"))
    half = dealt(pairs.select("a", "b"), hot_a, ["a"], "b").join(copied(left, hot_a, ["a"]), ["a", "part"]).drop("part")
    full = dealt(half, hot_b, ["b"], "a").join(copied(right, hot_b, ["b"]), ["b", "part"]).where("la <> lb")
    return full.select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")).distinct()


def near_members(pairs: DataFrame, table: DataFrame, labelled: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """(a, b), a < b: pairs of members of the groups in pairs (a, b) that may link different labels, by their own bitmaps.

    Members are compared in blocks, as groups are; see candidates() for nearest.
    """
    involved = written(pairs.select(F.explode(F.array("a", "b")).alias("gid")).distinct())
    prefix = table.where("prefix is not null").select("gid", "prefix").join(involved, "gid")
    own = table.where("node is not null").select("gid", "node", "n", "bitmap").join(prefix, "gid").join(labelled.select("node", "label"), "node")
    members = written(own.select(F.col("node").alias("gid"), "n", "bitmap", F.lit(0).cast("long").alias("radius"), "label", "prefix"))
    return candidates(meetings(members), members, percent, nearest)


def cluster(docs: DataFrame, gram: int = GRAM, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs (doc_id, text; other columns are ignored).

    component_id is the smallest doc_id that links reach, the row's own without links. Rows without words (or text) link
    with nothing, not even each other. Equal sets always link. A doc_id names one document: rows that repeat it are
    taken to repeat its text. A row without doc_id has its size but no component. An empty table gives an empty result.
    """
    sketch = sketches(docs, gram, percent)
    named = sketch.where("n > 0 and doc_id is not null")
    classes = written(named.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("node"), F.first("prefix").alias("prefix"), F.first("bitmap").alias("bitmap"), F.count("*").alias("copies")))
    table = collapse(classes.select("node", "n", "prefix", "bitmap"))
    groups = table.where("prefix is not null").select("gid", "n", "prefix", "bitmap", "radius")
    members = table.where("node is not null").select("gid", "node", "n")
    met = meetings(groups)

    near = written(candidates(met, groups.withColumn("label", F.lit(-1).cast("long")), percent, nearest=True))
    star = members.where("gid <> node").select(F.col("gid").alias("a"), F.col("node").alias("b"))
    tried = written(near.unionByName(star))
    edges = verified(tried, docs, gram, percent)
    found = written(components(edges))

    def labelled_by(found: DataFrame) -> DataFrame:
        return written(members.join(found, "node", "left").select("gid", "node", F.coalesce("component", "node").alias("label")))

    def merged(found: DataFrame, more: DataFrame) -> DataFrame:
        return written(components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)))

    def of_groups(labelled: DataFrame) -> DataFrame:
        spread = labelled.groupBy("gid").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        return written(spread.select("gid", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(-1).alias("label")))

    # in large blocks once more with the nearest group of another component, before all that are left are tried
    large_blocks = met.where(F.col("size") > FEW)
    of_group = of_groups(labelled_by(found))
    again = written(candidates(large_blocks, groups.join(of_group.where("label >= 0"), "gid"), percent, nearest=True).join(tried, ["a", "b"], "left_anti"))
    if again.limit(1).count():
        more = verified(again, docs, gram, percent)
        tried = written(tried.unionByName(again))
        if more.limit(1).count():
            found = merged(found, more)
            of_group = of_groups(labelled_by(found))
    labelled = labelled_by(found)
    left_over = candidates(large_blocks, groups.join(of_group, "gid"), percent, nearest=False)
    mixed = of_group.where("label < 0").select(F.col("gid").alias("a"), F.col("gid").alias("b"))
    # pairs tried above were tried between the groups' first members only
    pairs = differing(written(left_over.unionByName(near).unionByName(again).distinct().unionByName(mixed)), labelled)
    many = F.col("size_a") * F.col("size_b") > FEW_MEMBERS
    if pairs.limit(1).count():
        large = written(pairs.where(many).select("a", "b"))
        apart = member_pairs(pairs.where(~many), labelled)
        if large.limit(1).count():
            apart = apart.unionByName(near_members(large, table, labelled, percent, nearest=True)).distinct()
        apart = written(apart.join(tried, ["a", "b"], "left_anti"))
        more = verified(apart, docs, gram, percent)
        if more.limit(1).count():
            found = merged(found, more)
        labelled = labelled_by(found)
        large = differing(large, labelled)
        if large.limit(1).count():
            rest = near_members(large, table, labelled, percent, nearest=False).join(tried.unionByName(apart), ["a", "b"], "left_anti")
            more = verified(rest, docs, gram, percent)
            if more.limit(1).count():
                found = merged(found, more)
    by_class = written(classes.select("node", "f1", "f2", "n", "copies").join(found, "node", "left").select("f1", "f2", "n", "copies", F.coalesce("component", "node").alias("component_id")))
    return _of_rows(sketch.select("doc_id", "n", "f1", "f2"), by_class).select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id"))).otherwise(F.col("doc_id")).alias("component_id"))


def _of_rows(rows: DataFrame, by_class: DataFrame) -> DataFrame:
    """rows (doc_id, n, f1, f2) with the component_id of their class.

    Rows without words or id need no join; classes of very many copies are broadcast (their number has a bound, see skew).
    """
    keys, n = ["f1", "f2", "n"], rows.count()
    joined = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    alone, rows = rows.where(~joined).withColumn("component_id", F.lit(None).cast("long")), rows.where(joined)
    most = threshold(n, thin=True)
    if n <= most:
        return alone.unionByName(rows.join(by_class.drop("copies"), keys))
    few, others = F.broadcast(by_class.where(F.col("copies") > most).drop("copies")), by_class.where(F.col("copies") <= most).drop("copies")
    return alone.unionByName(rows.join(few, keys)).unionByName(rows.join(few, keys, "left_anti").join(others, keys))
