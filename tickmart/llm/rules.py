"""Quality rules in SQL functions only: word statistics of whole texts, and a short-circuit cascade of rules.

A cascade estimates each rule's cost and rejection rate on a sample, orders the rules by rejection per cost, and chains
them in one CASE expression, so a text rejected by an early rule never reaches the later ones.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SEPARATORS = r"[\x20\x09-\x0D]+"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
#: Rules that take less for a row are equally cheap.
LEAST_SECONDS = 2.5e-7


def with_statistics(docs: DataFrame) -> DataFrame:
    """docs (text, ...) with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words, all long.

    Words are runs of characters outside U+0020 and U+0009 to U+000D; a null or empty text has none. n_repeat_words
    counts the words in windows of five that occur twice or more in the text, found by sorting 64-bit window hashes
    within the row. The work of a row is in proportion to its text, but for that sort. Columns of the names used here
    are replaced.
    """
    taken = ["_words", "_lines", "_windows", "_sorted", "_places", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    own = docs.drop(*taken)
    keep = own.columns
    text = F.coalesce(F.col("text"), F.lit(""))
    split = own.select(
        *keep,
        F.array_remove(F.split(text, _SEPARATORS), "").alias("_words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
    )
    counted = split.select(
        *keep, "n_symbols", F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("_words") < WINDOW, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.size("_words") - WINDOW), lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(WINDOW)]))
        ).alias("_windows"),
    )
    pairs = counted.select(
        *keep, "n_symbols", "n_words", "word_chars", "n_dup_lines",
        F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_sorted"),
    )
    same = lambda x, k: F.get("_sorted", k)["h"] == x["h"]
    places = pairs.select(
        *keep, "n_symbols", "n_words", "word_chars", "n_dup_lines",
        F.when(F.col("_sorted").isNotNull(), F.array_sort(F.transform(F.filter("_sorted", lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))).alias("_places"),
    )
    covered = F.aggregate(F.transform("_places", lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_places", k + 1) - i, F.lit(WINDOW)))), F.lit(0).cast("long"), lambda a, x: a + x)
    # a filter on these columns must not be moved below: it would copy whole expressions into each other's inner loops,
    # and Spark moves none past a column that it cannot compute twice
    words = (F.col("n_words") + 0 * F.monotonically_increasing_id()).alias("n_words")
    return places.select(*keep, words, "word_chars", "n_symbols", "n_dup_lines", F.when(F.col("_places").isNotNull(), covered).otherwise(F.lit(0).cast("long")).alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """rejects: true for a row to reject. Null counts as false."""

    name: str
    rejects: Column


def document_rules() -> list[Rule]:
    """Rules over the text and with_statistics(): each is meant to spare plain prose of any language."""
    text, words = F.coalesce(F.col("text"), F.lit("")), F.col("n_words")
    letters, capitals = F.regexp_count(text, F.lit(r"\p{L}")), F.regexp_count(text, F.lit(r"\p{Lu}"))
    marks = F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))
    return [
        Rule("symbols", 100 * F.col("n_symbols") > 25 * words),
        Rule("word_length", (F.col("word_chars") < 2 * words) | (F.col("word_chars") > 40 * words)),
        Rule("duplicate_lines", 100 * F.col("n_dup_lines") > 30 * F.size(F.split(text, "\n"))),
        Rule("exclamations", 100 * marks > 30 * words),
        Rule("capitals", 100 * capitals > 50 * letters),
        Rule("few_letters", 100 * letters < 50 * F.col("word_chars")),
    ]


@dataclass(frozen=True)
class Measured:
    """seconds for a row, and the share of rows rejected."""

    rule: Rule
    seconds: float
    rejected: float

    def gain(self) -> float:
        """Rejection per cost. Costs are told apart by powers of two only, so that timing noise seldom changes an order."""
        return self.rejected / 2.0 ** round(math.log2(max(self.seconds, LEAST_SECONDS)))


def sampled(docs: DataFrame, rows: int) -> DataFrame:
    """About that many rows, or all of fewer, each drawn on its own, whatever its text; no partition gives many."""
    n = docs.count()
    return docs.sample(min(1.0, rows / n), seed=17) if n > rows else docs


def measure(docs: DataFrame, rules: list[Rule], sample_rows: int = 2000, repeats: int = 2) -> list[Measured]:
    """Each rule's cost and share of rejected rows over a sample of docs (text, ...), most rejection per cost first.

    One branch evaluates all rules: a row of the sample comes once for each rule and repeat, a task has the rows of a rule one
    after the other, and the clock is read after each, so what is timed is the work inside a task. A rule that only reads the
    size of the text gives the time to subtract. The sample decides the order of the rules only, never a row's verdict.
    Rules of equal gain, and those of an empty table, stay in the order given.
    """
    from .scratch import written

    sample = written(with_statistics(sampled(docs.select("text"), sample_rows)))
    every = [Rule("", F.octet_length("text") < 0), *rules]
    turns = sample.withColumn("rule", F.explode(F.array(*[F.lit(i) for i in range(len(every)) for _ in range(repeats)]))).sortWithinPartitions("rule")
    verdict = reduce(lambda chain, i: chain.when(F.col("rule") == i, every[i].rejects), range(1, len(every)), F.when(F.col("rule") == 0, every[0].rejects))
    now = F.java_method(F.lit("java.lang.System"), F.lit("nanoTime")).cast("long")
    timed = turns.select("rule", F.spark_partition_id().alias("task"), F.coalesce(verdict, F.lit(False)).alias("hit"), now.alias("at"))
    spans = timed.groupBy("rule", "task").agg((F.max("at") - F.min("at")).alias("nanos"), F.count("*").alias("n"), F.count_if("hit").alias("hits"))
    got = {r["rule"]: r for r in spans.groupBy("rule").agg(F.sum("nanos").alias("nanos"), F.sum("n").alias("n"), F.sum("hits").alias("hits")).collect()}
    if not got:
        return [Measured(r, 0.0, 0.0) for r in rules]
    idle_time = got[0]["nanos"] / got[0]["n"]
    found = [Measured(r, max(0.0, got[i]["nanos"] / got[i]["n"] - idle_time) / 1e9, got[i]["hits"] / got[i]["n"]) for i, r in enumerate(rules, 1)]
    return sorted(found, key=lambda m: -m.gain())


def cascade(rules: list[Rule]) -> Column:
    """The name of the first rule that rejects, or null. Later rules are not evaluated for that row."""
    first, *rest = rules
    chain = F.when(first.rejects, F.lit(first.name))
    for r in rest:
        chain = chain.when(r.rejects, F.lit(r.name))
    return chain


def judge(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = 2000) -> DataFrame:
    """docs (text, ...) with its statistics, base_failed, rejected_by (null for a kept row) and kept.

    Columns of these names are replaced. A null text counts as an empty one, and fails the base; repeated rows are judged
    alike. Which of several failing rules is named depends on the order measured; kept does not. An empty table gives an
    empty result.
    """
    docs = docs.drop("base_failed", "rejected_by", "kept")
    counted = with_statistics(docs)
    order = [m.rule for m in measure(docs, rules or document_rules(), sample_rows)]
    named = F.when(base_failed(), F.lit("base")).otherwise(cascade(order))
    return counted.withColumn("base_failed", base_failed()).withColumn("rejected_by", named).withColumn("kept", F.col("rejected_by").isNull())
