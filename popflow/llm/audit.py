"""Audit of filters that interact: what each of five removes, in every order of applying them.

Four filters look at a text alone; the fifth removes a text that some row with a smaller id holds
too. That one is an existential self-join: a left-semi join on the text's hash, the exact text and
a smaller id. Only rows whose hash occurs more than once bring their texts to it; the other side
has one row per different text, the one with the smallest id, repeated over as many salts as the
rows of its hash need, so that a group of copies is spread however large it is.

The ids found are united with the ids the other filters fail. Every row then has one number whose
bits are the filters it fails, and all that the orders ask for follows from the counts of these
numbers per part: with k filters failed, a row is removed by the first of them, so each of them
removes it in one k-th of the orders.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popflow.llm.common import let, words_of
from popflow.session import cut

FILTERS = "ABCDE"
LEAST_WORDS = 200
ROWS_PER_SALT = 4096


def failures_of_text(text: Column) -> Column:
    """Bits 1, 2, 4 and 8 for the filters A to D that a text fails; null counts as empty."""
    text = F.coalesce(text, F.lit(""))

    def of_words(words: Column) -> Column:
        n = F.size(words)
        few_different = 100 * F.size(F.array_distinct(words)) < 50 * n
        return (F.when(n < LEAST_WORDS, 1).otherwise(0)
                + F.when(few_different, 2).otherwise(0))

    capitals = 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("bigint") > 3 * F.length(text)
    return (let(words_of(text), of_words) + F.when(capitals, 4).otherwise(0)
            + F.when(text.rlike(r"[#$%&*|]"), 8).otherwise(0))


def repeated_texts(df: DataFrame, hashes: DataFrame, keep: tuple[str, ...] = (),
                   key: str = "doc_id", text: str = "text",
                   rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """(id, hash, size, *keep) of the rows whose exact text some row with a smaller key holds.

    ``hashes`` has (id, hash) of all rows. A null text equals an empty one; a null key is neither
    smaller nor larger than another, so such rows neither are found nor find others. Rows that
    share key and text are all found, or none.
    """
    often = cut(
        hashes.filter("id IS NOT NULL").groupBy("hash")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("id").alias("first"), F.max("id").alias("last"))
        .filter("first < last")
        .select("hash", "first", F.ceil(F.col("rows") / rows_per_salt).alias("salts")))
    kept = [F.col(c).alias(f"__{c}") for c in keep]
    rows = (
        df.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"), *kept)
        .filter("id IS NOT NULL").withColumn("hash", F.xxhash64("t")).join(often, "hash"))
    # Copies of a text are one row before they are dealt out.
    first = rows.groupBy("hash", "t", "salts").agg(F.min("id").alias("id")).withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)))
    later = rows.filter(F.col("id") > F.col("first")).withColumn(
        "salt", F.pmod(F.xxhash64("id"), F.col("salts")))
    a, b = later.alias("a"), first.alias("b")
    found = a.join(b, (F.col("a.hash") == F.col("b.hash")) & (F.col("a.salt") == F.col("b.salt"))
                   & (F.col("a.t") == F.col("b.t")) & (F.col("b.id") < F.col("a.id")), "left_semi")
    return found.select("id", "hash", F.octet_length("t").alias("size"),
                        *[F.col(f"__{c}").alias(c) for c in keep])


def failures(df: DataFrame, part: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, part, failed, rows): the bits of the failed filters, and how many rows are alike.

    Rows with one key, part and text are alike. Other columns, whatever their names, are not read.
    """
    same = F.coalesce(F.col(text), F.lit(""))
    facts = cut(df.select(
        F.col(key).alias("id"), F.col(part).alias("part"),
        F.xxhash64(same).alias("hash"), F.octet_length(same).alias("size"),
        failures_of_text(F.col(text)).cast("int").alias("failed")))
    again = repeated_texts(df, facts.select("id", "hash"), (part,), key, text)
    marked = facts.withColumn("rows", F.lit(1)).unionByName(again.select(
        "id", F.col(part).alias("part"), "hash", "size", F.lit(16).alias("failed"),
        F.lit(0).alias("rows")))
    return marked.groupBy(
        "id", F.coalesce("part", F.lit("")).alias("part"), "hash", "size").agg(
            F.bit_or("failed").alias("failed"), F.sum("rows").alias("rows"),
        ).select("id", "part", "failed", "rows")


def _orders() -> Column:
    """(filter_order, step, bit, before) of the five steps of all orders; a fixed 600 entries."""
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for i, letter in enumerate(order):
            bit = 1 << FILTERS.index(letter)
            steps.append(f"struct('{''.join(order)}' AS filter_order, {i + 1} AS step, "
                         f"{bit} AS bit, {before} AS before)")
            before |= bit
    return F.expr(f"array({', '.join(steps)})")


def audit_orders(counts: DataFrame) -> DataFrame:
    """One row per part, order and step from (part, failed, rows, good, toxic).

    ``rows`` counts the rows that fail exactly these filters, ``good`` and ``toxic`` those of them
    that are labelled so. A combination that does not occur counts as zero.
    """
    failed, bit, before = F.col("failed"), F.col("bit"), F.col("before")
    hit, gone = failed.bitwiseAND(bit) != 0, failed.bitwiseAND(before) != 0

    def total(what: Column, of: str = "rows") -> Column:
        return F.sum(F.when(what, F.col(of)).otherwise(0)).cast("bigint")

    every = factorial(len(FILTERS))
    share = F.element_at(F.array(*[F.lit(every // k) for k in range(1, len(FILTERS) + 1)]),
                         F.greatest(F.bit_count("failed"), F.lit(1)))
    return (
        counts.select("part", "failed", "rows", "good", "toxic", F.inline(_orders()))
        .groupBy("part", "filter_order", "step").agg(
            total(~hit & ~gone).alias("kept"), total(hit & ~gone).alias("removed"),
            total(hit & gone).alias("redundant"), total(failed == bit).alias("unique_fails"),
            total(hit & ~gone, "good").alias("good_lost"),
            total(hit & ~gone, "toxic").alias("toxic_lost"),
            F.sum(F.when(hit, F.col("rows") * share).otherwise(0)).cast("bigint").alias("shapley"))
    )


def audit(df: DataFrame, labels: DataFrame, part: str = "lang", key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """What each filter keeps, removes and would have removed, per part, order and step.

    Nulls: an empty text or part; a null key has no label. Empty texts fail A, and E after the
    first one. A row is good or toxic if any of its key's labels says so. Repeated rows count each.
    An empty table has no parts and gives no rows; columns of any other name are not read.
    """
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("is_good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("is_toxic"))
    counts = (
        failures(df, part, key, text).join(marks, "id", "left").groupBy("part", "failed").agg(
            F.sum("rows").alias("rows"),
            F.sum(F.col("rows") * F.coalesce("is_good", F.lit(0))).alias("good"),
            F.sum(F.col("rows") * F.coalesce("is_toxic", F.lit(0))).alias("toxic")))
    return audit_orders(counts)
