"""Windows over long series without a task that sorts a whole one.

A series is the rows of a key in order of whole seconds. It is cut into stretches of time. What a row needs from before or
after its stretch comes from summaries of one row for each stretch, or from copies of the few rows next to a cut.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import written

#: Seconds of a stretch, and rows of a block of numbered rows.
STRETCH = 7 * 86_400
BLOCK = 8192


def _cut(rows: DataFrame, order: str, stretch: int) -> DataFrame:
    return rows.withColumn("_t", F.floor(F.col(order) / stretch))


def numbered(rows: DataFrame, keys: Sequence[str], order: str = "bucket_epoch_s", name: str = "row", total: str | None = None, stretch: int = STRETCH) -> DataFrame:
    """rows with their number (from 1) in their key by order, and, if asked for, how many rows the key has.

    Rows are numbered inside stretches and written; the stretches' counts are then added up in order.
    """
    own = rows.columns
    inner = F.row_number().over(W.partitionBy(*keys, "_t").orderBy(order))
    stored = written(_cut(rows, order, stretch).withColumn("_n", inner))
    every = W.partitionBy(*keys)
    counts = stored.groupBy(*keys, "_t").agg(F.max("_n").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(every.orderBy("_t").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before")
    offsets = counts.select(*keys, "_t", before, *([F.sum("_rows").over(every).alias(total)] if total else []))
    return stored.join(offsets, [*keys, "_t"]).select(*own, (F.col("_n") + F.col("_before")).alias(name), *([total] if total else []))


def windowed(rows: DataFrame, keys: Sequence[str], back: int, ahead: int, add: Callable[[DataFrame, WindowSpec], DataFrame], order: str = "bucket_epoch_s", row: str = "_row", block: int = BLOCK) -> DataFrame:
    """add(rows, window), where add may look back and ahead so many rows of its window.

    rows have their numbers in row (of numbered()). They are dealt into blocks, with copies of the last `back` rows before a
    block and the first `ahead` rows after it; only a block's own rows are returned. add must keep the column row, and the
    window orders by it.
    """
    if max(back, ahead) > block:
        block = max(back, ahead)
    at, home = F.col(row) - 1, F.floor((F.col(row) - 1) / block)
    blocks = F.concat(F.array(home), F.when(F.pmod(at, F.lit(block)) >= block - back, F.array(home + 1)).otherwise(F.array()), F.when((F.pmod(at, F.lit(block)) < ahead) & (home > 0), F.array(home - 1)).otherwise(F.array()))
    spread = rows.withColumn("_b", F.explode(blocks))
    made = add(spread, W.partitionBy(*keys, "_b").orderBy(row))
    return made.where(F.col("_b") == home).drop("_b")


def known_before(rows: DataFrame, keys: Sequence[str], value: str, order: str = "bucket_epoch_s", stretch: int = STRETCH) -> DataFrame:
    """(keys, _t, carried): for each stretch of rows the last value that is not null in any stretch before it."""
    ends = _cut(rows, order, stretch).groupBy(*keys, "_t").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("_end"))
    return ends.select(*keys, "_t", F.last("_end", ignorenulls=True).over(W.partitionBy(*keys).orderBy("_t").rowsBetween(W.unboundedPreceding, -1)).alias("carried"))


def known_after(rows: DataFrame, keys: Sequence[str], value: str, order: str = "bucket_epoch_s", stretch: int = STRETCH) -> DataFrame:
    """(keys, _t, carried): likewise the first value in any stretch after it."""
    ends = _cut(rows, order, stretch).groupBy(*keys, "_t").agg(F.min_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("_end"))
    return ends.select(*keys, "_t", F.first("_end", ignorenulls=True).over(W.partitionBy(*keys).orderBy("_t").rowsBetween(1, W.unboundedFollowing)).alias("carried"))


def last_known(rows: DataFrame, keys: Sequence[str], value: str, order: str = "bucket_epoch_s", stretch: int = STRETCH) -> DataFrame:
    """rows with known, the last value up to the row that is not null. rows are read twice: they should be a table."""
    inner = F.last(value, ignorenulls=True).over(W.partitionBy(*keys, "_t").orderBy(order).rowsBetween(W.unboundedPreceding, 0))
    wide = _cut(rows, order, stretch).withColumn("_inner", inner).join(known_before(rows, keys, value, order, stretch), [*keys, "_t"])
    return wide.select(*rows.columns, F.coalesce("_inner", "carried").alias("known"))


def next_known(rows: DataFrame, keys: Sequence[str], value: str, order: str = "bucket_epoch_s", stretch: int = STRETCH) -> DataFrame:
    """rows with known, the first value after the row that is not null. rows are read twice: they should be a table."""
    inner = F.first(value, ignorenulls=True).over(W.partitionBy(*keys, "_t").orderBy(order).rowsBetween(1, W.unboundedFollowing))
    wide = _cut(rows, order, stretch).withColumn("_inner", inner).join(known_after(rows, keys, value, order, stretch), [*keys, "_t"])
    return wide.select(*rows.columns, F.coalesce("_inner", "carried").alias("known"))


def gaps(times: DataFrame, order: str = "bucket_epoch_s", stretch: int = STRETCH) -> DataFrame:
    """(gap): the distance of each distinct time to the one before it; none for the first.

    Times are merged and compared inside stretches; a stretch's first time gets the last one of the stretches before it.
    """
    distinct = written(_cut(times.select(order).distinct(), order, stretch))
    before = known_before(distinct.withColumn("_all", F.lit(0)), ["_all"], order, order, stretch).select("_t", "carried")
    inner = distinct.withColumn("_lag", F.lag(order).over(W.partitionBy("_t").orderBy(order))).join(before, "_t")
    return inner.select((F.col(order) - F.coalesce("_lag", "carried")).alias("gap")).where("gap is not null")


# affine scans

#: Rows of a chunk, and chunks (or chunks of chunks) that are scanned in one row.
CHUNK, WIDTH = 64, 64


def _carries(ends: DataFrame, keys: Sequence[str], a: Column) -> DataFrame:
    """ends (keys, c, size, end) with carry, what the chunks before c (from 0, without holes) leave to it; end and carry have a
    number for each scan, and a is the array of their factors.

    A chunk turns y into a ** size * y + end, and so do several in a row: WIDTH of them are put together, level by level, until
    a key has no more than WIDTH, and carries come down again.
    """
    group = F.floor(F.col("c") / WIDTH)
    grouped = ends.groupBy(*keys, group.alias("g")).agg(F.array_sort(F.collect_list(F.struct("c", "size", "end"))).alias("chunks"))
    zero = F.transform(a, lambda _: F.lit(0.0))
    over = lambda y, x: F.transform(y, lambda v, i: F.pow(F.get(a, i), x["size"]) * v + F.get(x["end"], i))
    if (ends.agg(F.max("c")).first()[0] or 0) < WIDTH:
        started = grouped.withColumn("y", zero)
    else:
        grouped = written(grouped)
        whole = grouped.select(*keys, F.col("g").alias("c"), F.aggregate("chunks", F.lit(0).cast("long"), lambda n, x: n + x["size"]).alias("size"), F.aggregate("chunks", zero, over).alias("end"))
        started = grouped.join(_carries(whole, keys, a).select(*keys, F.col("c").alias("g"), F.col("carry").alias("y")), [*keys, "g"])
    start = F.struct(F.col("y"), F.array().cast("array<array<double>>").alias("seen"))
    scanned = F.aggregate("chunks", start, lambda s, x: F.struct(over(s["y"], x).alias("y"), F.array_append(s["seen"], s["y"]).alias("seen")))["seen"]
    return started.select(*keys, F.explode(F.arrays_zip(F.col("chunks.c").alias("c"), scanned.alias("carry"))).alias("p")).select(*keys, F.col("p.c").alias("c"), F.col("p.carry").alias("carry"))


def affine_scan(rows: DataFrame, keys: Sequence[str], row: str, scans: dict[str, tuple[float, Column]], chunk: int = CHUNK) -> DataFrame:
    """rows with a column for each of scans, name: (a, b), where it is a * (that of the row before) + b within each key.

    It is 0 before the first row, and 0 < a < 1. row numbers each key's rows from 1, without holes. Rows are cut into chunks. A
    chunk is summed by a window as if nothing came before it, the chunks' ends are put together by levels, and each row adds
    what the chunks before its own carry over. All scans go through the same steps together.
    """
    factors = F.array(*[F.lit(a) for a, _ in scans.values()])
    placed = rows.withColumn("c", F.floor((F.col(row) - 1) / chunk)).withColumn("_k", F.pmod(F.col(row) - 1, F.lit(chunk)))
    power = [F.pow(F.lit(a), F.col("_k")) for a, _ in scans.values()]
    over = W.partitionBy(*keys, "c").orderBy("_k").rowsBetween(W.unboundedPreceding, 0)
    local = written(placed.withColumn("_y", F.array(*[p * F.sum(b / p).over(over) for p, (_, b) in zip(power, scans.values(), strict=True)])))
    ends = local.groupBy(*keys, "c").agg(F.count("*").alias("size"), F.max_by("_y", "_k").alias("end"))
    carried = [(F.get("_y", F.lit(i)) + p * a * F.get("carry", F.lit(i))).alias(name) for i, (p, (name, (a, _))) in enumerate(zip(power, scans.items(), strict=True))]
    return local.join(_carries(ends, keys, factors), [*keys, "c"]).select(*rows.columns, *carried)
