"""Quality rules as a cascade that stops at the first rule a document breaks.

The rules are independent tests of one text, so their order changes the work but not the verdict.
Each rule's cost (time) and selectivity (share rejected) are measured on a bounded sample of the
rows; the rules then run by rejections per unit of cost, the highest first. CASE WHEN evaluates
its branches in order and no further than needed, so a document pays only for the rules up to the
one that rejects it. Everything is column expressions: one scan, no shuffle.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popflow.llm.common import WORD, SPACE, let, words_of
from popflow.session import cut

SYMBOLS = r"[^#*$%&|<>]+"
WINDOW = 5


class Rule(NamedTuple):
    """``rejects`` is true for the texts that break the rule; null texts are empty ones."""

    name: str
    rejects: Callable[[Column], Column]


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def word_chars(text: Column) -> Column:
    """Code points inside words."""
    return F.length(F.regexp_replace(text, SPACE, "")).cast("bigint")


def n_symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(text, SYMBOLS, "")).cast("bigint")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    return let(lines, lambda v: (F.size(v) - F.size(F.array_distinct(v))).cast("bigint"))


def n_stutters(text: Column) -> Column:
    """Words equal to the word before them."""
    return let(words_of(text), lambda w: F.size(F.filter(
        w, lambda x, i: x.eqNullSafe(F.get(w, i - 1)))).cast("bigint"))


def n_repeat_words(text: Column) -> Column:
    """Words that lie in a window of five words found at least twice in the text.

    Windows are told apart by 64-bit hashes and sorted, so that equal ones are neighbours: time
    grows as n log n and no window leaves its row.
    """
    def windows(h: Column) -> Column:
        last = F.size(h) - WINDOW
        # The sequence must be valid for short texts too; their windows are filtered out.
        starts = F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: i <= last)
        return F.sort_array(F.transform(starts, lambda i: F.struct(
            F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]).alias("key"), i.alias("at"))))

    def repeated(s: Column) -> Column:
        return F.sort_array(F.transform(F.filter(s, lambda x, j: (
            x["key"].eqNullSafe(F.get(s, j - 1)["key"])
            | x["key"].eqNullSafe(F.get(s, j + 1)["key"]))), lambda x: x["at"]))

    def covered(at: Column) -> Column:
        start = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("bigint").alias("n"))
        return F.aggregate(at, start, lambda acc, p: F.struct(
            (p + WINDOW).alias("upto"),
            (acc["n"] + p + WINDOW - F.greatest(p, acc["upto"])).alias("n")))["n"]

    hashes = F.transform(words_of(text), lambda w: F.xxhash64(w))
    return let(let(hashes, windows), lambda s: covered(repeated(s)))


def upper_share(text: Column) -> Column:
    """Upper-case letters among all letters; 0 without letters."""
    letters = F.length(F.regexp_replace(text, r"\P{L}+", ""))
    return F.coalesce(F.try_divide(F.length(F.regexp_replace(text, r"\P{Lu}+", "")), letters),
                      F.lit(0.0))


def too_short(words: Column) -> Column:
    return words < 10


def too_repetitive(repeats: Column, words: Column) -> Column:
    return 100 * repeats > 20 * words


def rules_over(measures: Mapping[str, Column]) -> tuple[Rule, ...]:
    """The rules, with the measures that are already columns taken from there."""
    def of(measure: Callable[[Column], Column]) -> Callable[[Column], Column]:
        have = measures.get(measure.__name__)
        return measure if have is None else lambda text: have

    words, symbols, repeats = of(n_words), of(n_symbols), of(n_repeat_words)
    stutters, lines = of(n_stutters), of(n_dup_lines)
    return (
        Rule("few_words", lambda t: too_short(words(t))),
        Rule("repeated_windows", lambda t: too_repetitive(repeats(t), words(t))),
        Rule("symbols", lambda t: 10 * symbols(t) > words(t)),
        Rule("shouting", lambda t: upper_share(t) > 0.5),
        Rule("stutter", lambda t: 5 * stutters(t) > words(t)),
        Rule("repeated_lines", lambda t: 2 * lines(t) > F.size(F.split(t, "\n"))),
    )


RULES = rules_over({})


def measure_rules(
    df: DataFrame, text: str, rules: Sequence[Rule], sample_rows: int = 2000, seed: int = 0,
) -> dict[str, tuple[float, float]]:
    """(seconds, share rejected) of each rule alone on a sample of about ``sample_rows`` texts."""
    rows = df.count()
    # Dealt anew, not coalesced: one task would hold the readers of all its files until it ends.
    sample = cut(df.select(F.coalesce(F.col(text), F.lit("")).alias("t")).sample(
        False, min(1.0, sample_rows / max(1, rows)), seed).repartition(4))

    def timed(rejects: Column) -> tuple[float, float]:
        best, share = float("inf"), 0.0
        for _ in range(2):
            started = time.perf_counter()
            share = sample.agg(F.avg(rejects.cast("double"))).first()[0] or 0.0
            best = min(best, time.perf_counter() - started)
        return best, share

    base, _ = timed(F.length("t") < 0)
    out = {}
    for rule in rules:
        seconds, share = timed(rule.rejects(F.col("t")))
        out[rule.name] = (max(seconds - base, 1e-4), share)
    return out


def in_order(rules: Sequence[Rule], figures: Mapping[str, tuple[float, float]]) -> list[Rule]:
    """Rules by rejections per second, the cheaper first among those that reject nothing."""
    return sorted(rules, key=lambda r: (-figures[r.name][1] / figures[r.name][0],
                                        figures[r.name][0], r.name))


def first_broken(text: Column, ordered: Sequence[Rule]) -> Column:
    """Name of the first rule in order that rejects the text, null if none does."""
    text = F.coalesce(text, F.lit(""))
    chain = None
    for rule in ordered:
        test = rule.rejects(text)
        chain = (F.when(test, rule.name) if chain is None else chain.when(test, rule.name))
    return chain if chain is not None else F.lit(None).cast("string")


def apply_rules(
    df: DataFrame, text: str = "text", measures: Mapping[str, Column] | None = None,
    sample_rows: int = 2000,
) -> DataFrame:
    """``df`` with ``broken_rule``: the rule that stopped the cascade, null for kept rows.

    Null and empty texts have no words and break the shortest-text rule. Which of several broken
    rules is named depends on the measured order; whether one is named does not. ``measures`` maps
    names of measures to columns of ``df`` that hold them already. An input column
    ``broken_rule`` is replaced. Texts are read whole, however long; repeated rows are judged each
    and alike; a table without rows stays so, with the rules in order of their cost alone.
    """
    order = [r.name for r in in_order(RULES, measure_rules(df, text, RULES, sample_rows))]
    by_name = {r.name: r for r in rules_over(measures or {})}
    return df.withColumn(
        "broken_rule", first_broken(F.col(text), [by_name[n] for n in order]))
