"""Mixing of sources to target weights by systematic sampling.

Every document of a source expects target / size copies. Along the source's documents the
expectations are summed, one offset is added, and a document is taken once for each whole number
its step crosses. All steps of a source are equal, so the sum before a document is its rank times
the step: the rank is all that has to be known, and it comes from counts of hash parts and a
window inside each part, so that a source with a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from popflow.session import cut

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3


def source_targets(sizes: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """Targets of ``(source, source_size)``: shares by weight, ``most`` times the size at most.

    What exceeds a cap is shared out again by weight. In order of size per weight the capped
    sources are a prefix: the first source whose cap is not below its share of the rest ends it.
    One row per source is ordered in one task.
    """
    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]),
                               (F.pmod(F.row_number().over(by_source) - 1, F.lit(len(WEIGHTS)))
                                + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.col("source_size").cast("double") * most)
    order = Window.orderBy(
        F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    return (
        ranked
        .withColumn("level", (F.sum(F.col("source_size").cast("double")).over(every)
                              - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                    / F.sum("weight").over(rest))
        .withColumn("open", F.col("level") * F.col("weight") <= F.col("cap"))
        .withColumn("level", F.min(F.when(F.col("open"), F.struct(
            F.col("cap") / F.col("weight"), F.col("source").isNull(), "source", "level"))
        ).over(every)["level"])
        .select("source", "source_size", F.least(
            "cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))
    )


def copies(rank: Column, step: Column, offset: Column) -> Column:
    """Whole numbers crossed by the step of the row with this 0-based rank."""
    crossed = F.floor((rank + 1) * step + offset) - F.floor(rank * step + offset)
    return F.least(crossed, F.lit(MOST_COPIES)).cast("bigint")


def mix_sources(
    df: DataFrame, size: str, source: str = "source", key: tuple[str, ...] = ("doc_id",),
    seed: str = "mix", rows_per_part: int = 4096,
) -> DataFrame:
    """``df`` with ``source_size``, ``target`` and ``copies`` of each row (0 to 3).

    Rows are ordered inside a source by hash part, then size, so that documents of all sizes are
    taken evenly; md5 of the key breaks ties. Rows alike in size and key are interchangeable. A
    null source is a source of its own, and last; null sizes count as 0. Input columns with the
    names of the results are replaced. The same rows give the same result.
    """
    rows = df.drop("source_size", "target", "copies")
    name = F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))  # null apart from empty
    tie = F.md5(F.concat_ws("|", F.lit(seed), *[
        F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]).cast("binary"))

    def number(digest: Column) -> Column:
        return F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")

    rows = rows.withColumns({
        size: F.coalesce(F.col(size), F.lit(0)).cast("bigint"), "__name": name, "__tie": tie})
    sums = cut(rows.groupBy("__name", F.col(source).alias("source")).agg(
        F.sum(size).alias("source_size"), F.count(F.lit(1)).alias("__rows")))
    unit = number(F.md5(F.concat_ws("|", F.lit(seed), "__name").cast("binary")))
    # Written, so that the join knows its size: below the broadcast threshold the rows stay where
    # they are, above it no source is large.
    plan = cut(
        source_targets(sums.select("source", "source_size"))
        .withColumn("__name", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
        .join(sums.select("__name", "__rows"), "__name")
        .select("__name", "source_size", "target",
                (unit.cast("double") / float(1 << 48)).alias("__offset"),
                F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                .otherwise(0.0).alias("__step"),
                F.ceil(F.col("__rows") / F.lit(rows_per_part)).alias("__parts")))

    def placed(columns: DataFrame) -> DataFrame:
        return columns.join(plan, "__name").withColumn(
            "__part", F.pmod(number(F.col("__tie")), F.col("__parts")).cast("int")).drop("__parts")

    counts = placed(rows.select("__name", "__tie")).groupBy("__name", "__part").agg(
        F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__name").orderBy("__part").rowsBetween(
        Window.unboundedPreceding, -1)
    counts = counts.select("__name", "__part", F.coalesce(
        F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__name", "__part").orderBy(size, "__tie")
    return (
        placed(rows).withColumn("__rank", F.row_number().over(inside) - 1)
        .join(counts, ["__name", "__part"])
        .withColumn("copies", copies(
            F.col("__before") + F.col("__rank"), F.col("__step"), F.col("__offset")))
        .drop("__name", "__part", "__tie", "__rank", "__before", "__step", "__offset")
    )
