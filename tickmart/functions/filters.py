"""Row filters given as short texts: comma lists of symbols, exchanges, terms and number ranges."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Exchanges left out unless a caller says otherwise.
EXCLUDED_EXCHANGES = ("alpaca", "arkham", "bequant", "bitfinex", "bitmex", "bitopro", "blockchaincom", "oxfun", "probit")


def tokens(spec: str | None) -> list[str]:
    """The parts of a comma list, trimmed and lower-cased, each once, in order."""
    return list(dict.fromkeys(t.strip().lower() for t in (spec or "").split(",") if t.strip()))


def symbol_condition(spec: str | None, column: str = "symbol") -> Column:
    """True for symbols that equal a token, or match one that holds % or _ as a LIKE pattern; for all without tokens."""
    parts = tokens(spec)
    exact = [t for t in parts if "%" not in t and "_" not in t]
    patterns = [t for t in parts if t not in exact]
    value = F.lower(column)
    any_of = ([value.isin(exact)] if exact else []) + [F.like(value, F.lit(t), F.lit("\\")) for t in patterns]
    return reduce(or_, any_of) if any_of else F.lit(True)


def filter_symbols(df: DataFrame, spec: str | None, column: str = "symbol") -> DataFrame:
    return df.where(symbol_condition(spec, column))


def filter_exchanges(df: DataFrame, include: str | None = None, exclude: str | None = None, defaults: tuple[str, ...] = EXCLUDED_EXCHANGES, column: str = "exchange_id") -> DataFrame:
    """Rows of the included exchanges (all, without a list) that neither exclude nor defaults name, whatever their case."""
    value, wanted, unwanted = F.lower(column), tokens(include), [*defaults, *tokens(exclude)]
    if wanted:
        df = df.where(value.isin(wanted))
    return df.where(~value.isin(unwanted)) if unwanted else df


def contains_filter(df: DataFrame, column: str, spec: str | None) -> DataFrame:
    """Rows whose column holds any of the terms, whatever their case. Terms are plain texts, not patterns."""
    terms = tokens(spec)
    return df.where(reduce(or_, [F.contains(F.lower(F.col(column).cast("string")), F.lit(t)) for t in terms])) if terms else df


def number_ranges(spec: str | None) -> tuple[list[tuple[float, float]], list[str]]:
    """Closed ranges for >=a, >a, <=a, <a, a-b and a, and the tokens that are none of these.

    Strict bounds move by 1e-12. A leading minus reads as a range without a low end, so it is refused.
    """
    ranges, refused = [], []
    inf = float("inf")
    for token in (t.strip() for t in (spec or "").split(",") if t.strip()):
        sign = next((s for s in (">=", "<=", ">", "<") if token.startswith(s)), "")
        try:
            if sign:
                bound = float(token[len(sign) :])
                bound += {">": 1e-12, "<": -1e-12}.get(sign, 0.0)
                ranges.append((bound, inf) if sign[0] == ">" else (-inf, bound))
            else:
                ends = sorted(float(part) for part in token.split("-", 1))
                ranges.append((ends[0], ends[-1]))
        except ValueError:
            refused.append(token)
    return ranges, refused


def numeric_filter(df: DataFrame, column: str, spec: str | None) -> tuple[DataFrame, list[str]]:
    """Rows whose column is in any of the ranges (all rows without ranges), and the tokens that were refused."""
    ranges, refused = number_ranges(spec)
    value = F.col(column)
    return (df.where(reduce(or_, [value.between(low, high) for low, high in ranges])) if ranges else df), refused
