"""Source divergence audit: how far the term shares of each source are from those of other sources and of its language.

Terms are counted by Arrow kernels inside tasks (ascii_lower, split_pattern_regex, dictionary_encode, group_by), so a
task hands on one row for each language, source and term it has met. The merged counts of kept terms are dealt into
columnar shards of terms, and each shard compares blocks of sources in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import written

#: What lies between terms: ASCII other than letters.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCUMENTS = 3
TOP_TERMS = 200
#: Texts are split about so many bytes at a time, and so are longer ones.
STEP = 2 << 20
#: A task merges its counts from so many rows on, and hands them on if they are still more than half.
HELD_ROWS = 400_000
#: Counts of a shard, and sources of a block: what a task compares at a time.
SHARD_ROWS, BLOCK = 1 << 17, 256
#: So few groups are broadcast to their counts.
FEW_GROUPS = 200_000
#: Terms of a shard that are compared at a time.
STRIPE = 2048

_LETTER = np.array([not chr(b).isascii() or chr(b).isalpha() for b in range(256)])
_COUNTS = {"lang": pa.string(), "source": pa.string(), "term": pa.string(), "n": pa.int64(), "docs": pa.int64()}


def _segments(text: str) -> Iterator[str]:
    """text in parts of about STEP bytes; none cuts a term unless that is as long as a part, and then it does not either."""
    data, at = text.encode(), 0
    while at < len(data):
        end = at + STEP
        while end < len(data) and _LETTER[data[end]]:
            end += 1
        yield data[at:end].decode()
        at = end


def _terms(texts: pa.Array) -> pa.Table:
    """(row, term, n): how often each term occurs in each text."""
    split = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=BETWEEN)
    rows, coded = pc.list_parent_indices(split), split.flatten().dictionary_encode()
    found = pa.table({"row": rows, "code": coded.indices}).group_by(["row", "code"]).aggregate([([], "count_all")])
    named = pa.table({"row": found["row"].cast(pa.int64()), "term": coded.dictionary.take(found["code"].combine_chunks()), "n": found["count_all"].cast(pa.int64())})
    return named.filter(pc.not_equal(named["term"], ""))


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """[first, last) of rows of about STEP bytes."""
    ends, first = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)), 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + STEP, "right")))
        yield first, last
        first = last


def _merged(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts).group_by(["group", "term"]).aggregate([("n", "sum"), ("docs", "sum")]).rename_columns(["group", "term", "n", "docs"])


def partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts (lang, source, term, n, docs) of batches (lang, source, text), and a row with a null term for each group met."""
    groups: dict[tuple[str, str], int] = {}
    held: list[pa.Table] = []

    def out(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        names = [pa.array([k[i] for k in groups], pa.string()) for i in (0, 1)]
        at = rows["group"].combine_chunks()
        yield from pa.table({"lang": names[0].take(at), "source": names[1].take(at), "term": rows["term"], "n": rows["n"], "docs": rows["docs"]}).cast(pa.schema(_COUNTS)).to_batches(65_536)

    for b in batches:
        texts = pc.fill_null(b.column("text"), "")
        own = np.array([groups.setdefault(k, len(groups)) for k in zip(*(pc.fill_null(b.column(c), "").to_pylist() for c in ("lang", "source")), strict=True)], np.int64)
        for first, last in _slices(texts):
            some = texts.slice(first, last - first)
            if last - first == 1 and pc.binary_length(some)[0].as_py() > STEP:
                pieces = [_terms(pa.array([s])) for s in _segments(some[0].as_py())]
                found = pa.concat_tables(pieces).group_by("term").aggregate([("n", "sum")]).rename_columns(["term", "n"])
                found = found.append_column("row", pa.array(np.zeros(len(found), np.int64)))
            else:
                found = _terms(some)
            group = pa.array(own[first + found["row"].to_numpy()])
            held.append(pa.table({"group": group, "term": found["term"], "n": found["n"]}).group_by(["group", "term"]).aggregate([("n", "sum"), ("n", "count")]).rename_columns(["group", "term", "n", "docs"]))
            if sum(map(len, held)) > HELD_ROWS:
                held = [_merged(held)]
                if len(held[0]) > HELD_ROWS // 2:
                    yield from out(held.pop())
    if held:
        yield from out(_merged(held))
    if groups:
        yield from out(pa.table({"group": pa.array(range(len(groups)), pa.int64()), "term": pa.nulls(len(groups), pa.string()), "n": pa.array([0] * len(groups), pa.int64()), "docs": pa.array([0] * len(groups), pa.int64())}))


def counts(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> tuple[DataFrame, DataFrame]:
    """(counts, groups) of docs (lang, source, text, ...); both are written tables.

    counts (lang, source, term, n, total): how often each term kept occurs in the source and in its language. A language
    keeps the terms that at least least_documents of its rows hold. groups (lang, source, n, kept, lang_n, place, sources,
    shards): every (lang, source) that occurs, with its occurrences of kept terms, the language's terms and occurrences,
    and the source's place in it. One shuffle merges what tasks have counted, by language and term.
    """
    rows = docs.select("lang", "source", "text").mapInArrow(partial_counts, "lang string, source string, term string, n bigint, docs bigint")
    each = rows.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    spread = W.partitionBy("lang", "term")
    first = F.row_number().over(spread.orderBy("source")) == 1
    wide = each.select("lang", "source", "term", "n", F.sum("n").over(spread).alias("total"), F.sum("docs").over(spread).alias("docs"), first.alias("first"))
    both = written(wide.where(F.col("term").isNull() | (F.col("docs") >= least_documents)).drop("docs"))
    kept = both.where("term is not null")
    # each of a language's terms is counted at the first of its sources
    per_lang = kept.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.count("*").alias("_rows"), F.count_if("first").alias("kept"))
    found = both.groupBy("lang", "source").agg(F.sum("n").alias("n")).join(per_lang, "lang", "left").fillna(0, ["lang_n", "_rows", "kept"])
    own = W.partitionBy("lang")
    place = (F.row_number().over(own.orderBy("source")) - 1).alias("place")
    groups = found.select("lang", "source", "n", "kept", "lang_n", place, F.count("*").over(own).alias("sources"), F.greatest(F.lit(1), F.ceil(F.col("_rows") / SHARD_ROWS)).cast("int").alias("shards"))
    return kept.drop("first"), written(groups)


def share(count: str, total: str, kept: str) -> Column:
    """1 + floor(10^9 * (count + 1) / (total + kept)) by long division in base 1000: exact for totals up to 9 * 10^15."""
    d, r = f"({total} + {kept})", f"(({count} + 1) * 1000)"
    s = f"({r} % {d} * 1000)"
    t = f"({s} % {d} * 1000)"
    return F.expr(f"1 + {r} div {d} * 1000000 + {s} div {d} * 1000 + {t} div {d}")


def shares(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """As share(), of counts against whole = total + kept."""
    out, rest = np.zeros(np.broadcast_shapes(count.shape, whole.shape), np.int64), count + 1
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + more
    return out + 1


def _compare(shard: pa.Table) -> pa.Table:
    """Sums of f for each ordered pair of the sources of two blocks, over the terms of a shard.

    Terms that neither source has all give the same f: shard 0 adds it for every kept term, and every shard adds what its
    own terms give beyond that.
    """
    is_source = pc.is_null(shard["term"])
    heads, rows = shard.filter(is_source).sort_by("place"), shard.filter(pc.invert(is_source))
    places, whole, kept = heads["place"].to_numpy(), heads["whole"].to_numpy(), heads["kept"][0].as_py()
    first, other = shard["low"][0].as_py(), shard["high"][0].as_py()
    block = heads["block"].to_numpy()
    value = np.zeros((len(places), len(places)), np.int64)
    if kept:
        rest = shares(np.zeros(1, np.int64), whole)
        base = (rest[:, None] - rest[None]) ** 2 // rest[None]
        if shard["shard"][0].as_py() == 0:
            value += base * kept
        term = rows["term"].combine_chunks().dictionary_encode().indices.to_numpy()
        at, n, order = np.searchsorted(places, rows["place"].to_numpy()), rows["n"].to_numpy(), np.argsort(term, kind="stable")
        at, n, term = at[order], n[order], term[order]
        for start in range(0, int(term.max(initial=-1)) + 1, STRIPE):
            lo, hi = np.searchsorted(term, (start, start + STRIPE))
            count = np.zeros((len(places), int(term[hi - 1]) + 1 - start), np.int64)
            count[at[lo:hi], term[lo:hi] - start] = n[lo:hi]
            p = shares(count, whole[:, None])
            for i in range(len(places)):
                off = p[i] - p
                value[i] += (off * off // p).sum(1) - base[i] * p.shape[1]
    wanted = ~np.eye(len(places), dtype=bool) & ((block[:, None] != block[None]) | (first == other))
    left, right = np.nonzero(wanted)
    names = heads["source"].combine_chunks()
    return pa.table({"lang": pa.repeat(heads["lang"][0], len(left)), "source": names.take(pa.array(left)), "item": names.take(pa.array(right)), "value": pa.array(value[left, right])})


def pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): for each source and each other source of its language, the sum of f over kept terms.

    The result has a row for each pair of sources, as asked for. A group of tasks' rows is a shard of terms and two blocks
    of sources, of a bounded size; sources are copied to the blocks that they are compared with.
    """
    other = F.explode(F.sequence(F.lit(0), F.floor((F.col("sources") - 1) / BLOCK)))
    placed = lambda rows: rows.withColumn("_b", F.floor(F.col("place") / BLOCK)).withColumn("_o", other).withColumn("low", F.least("_b", "_o")).withColumn("high", F.greatest("_b", "_o")).select("lang", "shard", "low", "high", F.col("_b").alias("block"), "place", "source", "term", "n", "whole", "kept")
    heads = groups.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).withColumn("whole", F.col("n") + F.col("kept")).withColumn("term", F.lit(None).cast("string"))
    rows = _with_groups(kept, groups, "place", "sources", "shards").withColumn("shard", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int")).withColumn("whole", F.lit(None).cast("long")).withColumn("kept", F.lit(None).cast("long"))
    shards = placed(heads).unionByName(placed(rows)).groupBy("lang", "shard", "low", "high")
    parts = shards.applyInArrow(_compare, "lang string, source string, item string, value bigint")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _with_groups(kept: DataFrame, groups: DataFrame, *columns: str) -> DataFrame:
    """kept with columns of its group."""
    own = groups.select("lang", "source", *columns)
    return kept.join(F.broadcast(own) if groups.count() <= FEW_GROUPS else own, ["lang", "source"])


def telling_terms(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): the terms whose share in a source is above that in its language, with f."""
    wide = _with_groups(kept.where("n > 0"), groups.withColumnRenamed("n", "whole"), "whole", "kept", "lang_n")
    both = wide.select("lang", "source", F.col("term").alias("item"), share("n", "whole", "kept").alias("p"), share("total", "lang_n", "kept").alias("q"))
    return both.where("p > q").select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value"))


def audit(docs: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) of docs (text, lang, source, ...), every column null or empty alike as ''.

    part 'pair' has every other source of a language with its divergence, 'term' the `top` terms by which a source stands
    out. Ties go to the smaller item. A language without kept terms has pairs of value 0, an empty table no rows. Repeated
    rows count as often as they occur; other columns are not looked at.
    """
    kept, groups = counts(docs)
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return ranked(pairs(kept, groups), "pair").unionByName(ranked(telling_terms(kept, groups), "term").where(F.col("rank") <= top))
