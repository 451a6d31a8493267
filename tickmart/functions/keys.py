"""Deduplication keys of events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once for all its uses."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _shortened(digits: Column, point: Column, x: Column) -> Column:
    """digits without the last one (the rest rounded either way), if that still reads as x; as they are otherwise.

    x = 0.digits * 10 ** point. Java's text of a double has now and then a digit more than needed.
    """
    n = F.length(digits)
    less = F.substring(digits, F.lit(1), n - 1)
    more = (less.cast("decimal(20,0)") + 1).cast("decimal(20,0)").cast("string")
    reads = lambda d: F.concat(F.lit("0."), d, F.lit("E"), point.cast("string")).cast("double") == x
    return F.when(n < 16, digits).when(reads(less), less).when((F.length(more) == n - 1) & reads(more), more).otherwise(digits)


def _written_out(digits: Column, point: Column) -> Column:
    """0.digits * 10 ** point, with an exponent below 0.0001 and from 1e+16 on."""
    n, power = F.length(digits), point - 1
    fixed = (
        F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
        .when(point >= n, F.concat(digits, F.repeat(F.lit("0"), point - n), F.lit(".0")))
        .otherwise(F.concat(F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, n)))
    )
    size = F.abs(power).cast("string")
    exponent = F.concat(F.when(power < 0, "e-").otherwise("e+"), F.when(F.length(size) < 2, F.concat(F.lit("0"), size)).otherwise(size))
    short = F.concat(F.substring(digits, 1, 1), F.when(n > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), n))).otherwise(""), exponent)
    return F.when((power >= -4) & (power < 16), fixed).otherwise(short)


def float_text(x: Column) -> Column:
    """The shortest text that reads as the double x, as producers of events write it: 0.0001, 1e-05, 10000000.0, 1e+16."""
    size, java = F.abs(x), x.cast("string")

    def parsed(text: Column) -> Column:
        return F.struct(F.split_part(text, F.lit("E"), F.lit(1)).alias("base"), F.coalesce(F.nullif(F.split_part(text, F.lit("E"), F.lit(2)), F.lit("")).cast("int"), F.lit(0)).alias("exponent"))

    def placed(p: Column) -> Column:
        every, whole = F.replace(p["base"], F.lit("."), F.lit("")), F.length(F.split_part(p["base"], F.lit("."), F.lit(1)))
        digits = F.ltrim(every, F.lit("0"))
        return F.struct(F.rtrim(digits, F.lit("0")).alias("digits"), (whole - F.length(every) + F.length(digits) + p["exponent"]).alias("point"))

    long = _let(size, lambda v: _let(_let(_let(v.cast("string"), parsed), placed), lambda d: _let(F.rtrim(_shortened(d["digits"], d["point"], v), F.lit("0")), lambda digits: _written_out(digits, d["point"]))))
    plain = (size == 0) | ((size >= 1e-3) & (size < 1e7) & (F.length(java) < 17))
    return F.when(plain, java).when(F.isnan(x), "nan").when(size == float("inf"), F.when(x > 0, "inf").otherwise("-inf")).otherwise(F.concat(F.when(x < 0, "-").otherwise(""), long))


def _hashed(*parts: Column) -> Column:
    """SHA-256 of the texts with bars between them; a missing one reads None."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts]), 256)


def _name(c: str) -> Column:
    """A missing name is empty, not None."""
    return F.lower(F.trim(F.coalesce(F.col(c), F.lit(""))))


def tick_dedup_key() -> Column:
    """Doubles above 2 ** 53 may read otherwise than at the producer, in their last digit."""
    c = F.col
    return _hashed(_name("exchange_id"), _name("symbol"), c("event_ts_ms"), *[float_text(c(p).cast("double")) for p in ("price", "bid", "ask", "last")])


def event_dedup_key() -> Column:
    """The message is empty, not None, where there is none."""
    c = F.col
    return _hashed(_name("exchange_id"), _name("symbol"), c("event_name"), c("severity"), F.floor(c("event_ts_ms") / 1000), F.coalesce(c("message"), F.lit("")))
