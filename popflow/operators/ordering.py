"""Ranks, running totals, dense keys, batches and exact quantiles without a one-task window.

All of them start from one range-partitioned, sorted and written copy of the rows. A range
partition holds a bounded slice of the order whatever the distribution of the grouping key, so a
group that owns a third of the rows is spread over a third of the tasks. What crosses partitions
is one row per (partition, group).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from popflow.functions.columns import as_col
from popflow.session import cut

_SLOT, _PART, _ROW, _CARRY, _FIRST, _SIZE = (
    "__slot", "__part", "__row", "__carry", "__first", "__size")
_ROW_BITS = 33  # layout of monotonically_increasing_id: partition number above the row number


def _placed(df: DataFrame, by: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Rows with the number of their range partition and their position inside it."""
    keys = [F.col(c) for c in by] + [as_col(c) for c in order]
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn(_SLOT, F.monotonically_increasing_id())
    )
    # The sampled range bounds are not repeatable, so the placement is written before it is used.
    stored = cut(placed)
    return stored.withColumns({
        _PART: F.shiftright(_SLOT, _ROW_BITS),
        _ROW: F.col(_SLOT).bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
    })


def _carried(
    per_part: DataFrame, by: Sequence[str], value: str, totals: Sequence[str]
) -> DataFrame:
    """Total of ``value`` in the earlier partitions of the same group, and the group's ``totals``.

    The window sees at most one row per range partition and group.
    """
    earlier = (
        Window.partitionBy(*by).orderBy(_PART)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    zero = F.lit(0).cast(per_part.schema[value].dataType)
    carried = per_part.withColumns({
        _CARRY: F.coalesce(F.sum(value).over(earlier), zero),
        **{t: F.sum(t).over(Window.partitionBy(*by)) for t in totals},
    })
    # Without groups this is one row per range partition.
    return carried if by else F.broadcast(carried)


def rank_rows(
    df: DataFrame, order: Sequence[str | Column], by: Sequence[str] = (), out: str = "rank",
    totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """1-based ``row_number`` over ``order`` inside each ``by`` group.

    ``order`` should end in a unique column, which makes the result repeatable and lets ties be
    split between tasks. ``by`` columns must not be null. ``totals`` maps further output columns
    to SQL summed over the group; they travel with the rank at no extra shuffle.
    """
    by, totals = list(by), totals or {}
    rows = _placed(df, by, order)
    per_part = rows.groupBy(*by, _PART).agg(
        F.count(F.lit(1)).alias(_SIZE), F.min(_ROW).alias(_FIRST),
        *[F.expr(f"sum({e}) AS {t}") for t, e in totals.items()])
    # Joined on group and partition: no key owns more rows than a range partition holds.
    ranked = rows.join(_carried(per_part, by, _SIZE, list(totals)).drop(_SIZE), [*by, _PART])
    return ranked.withColumn(
        out, F.col(_CARRY) + F.col(_ROW) - F.col(_FIRST) + F.lit(1)
    ).select(*df.columns, out, *totals)


def running_total(
    df: DataFrame,
    value: str,
    order: Sequence[str | Column],
    by: Sequence[str] = (),
    out: str = "running",
    total: str | None = None,
) -> DataFrame:
    """Inclusive running sum of ``value`` over ``order`` inside each ``by`` group.

    ``total`` names an extra column for the sum over the whole group.
    """
    by, extra = list(by), [total] if total else []
    rows = _placed(df, by, order)
    per_part = rows.groupBy(*by, _PART).agg(
        F.sum(value).alias(_SIZE), *[F.sum(value).alias(t) for t in extra])
    local = (
        Window.partitionBy(_PART, *by).orderBy(_SLOT)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = rows.withColumn(out, F.sum(value).over(local)).join(
        _carried(per_part, by, _SIZE, extra).drop(_SIZE), [*by, _PART])
    return summed.withColumn(out, F.col(_CARRY) + F.col(out)).select(*df.columns, out, *extra)


def dense_key(df: DataFrame, cols: Sequence[str], out: str = "key") -> DataFrame:
    """Number the distinct values of ``cols`` 1, 2, 3 ... in sorted order and attach the number."""
    keys = rank_rows(df.select(*cols).distinct(), cols, out=out)
    return df.join(keys, list(cols))


def batch_ids(
    df: DataFrame, n: int, order: Sequence[str | Column], out: str = "batch"
) -> DataFrame:
    """Consecutive batches of ``n`` rows, numbered from 0; the last may be shorter."""
    if n < 1:
        raise ValueError("n must be at least one")
    ranked = rank_rows(df, order, out=out)
    return ranked.withColumn(out, F.floor((F.col(out) - 1) / F.lit(n)).cast("bigint"))


def keep_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row of each ``key`` by ``order``: an aggregate, so it combines map-side."""
    rest = [c for c in df.columns if c != key]
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(key).agg(first.alias("__row")).select(key, "__row.*").select(*df.columns)


def quantile_edges(
    df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] = (), out: str = "edges"
) -> DataFrame:
    """Exact linearly interpolated quantiles, one array per group.

    Values are counted first, so a value shared by many rows is one row; the counts are then
    accumulated in order and only the values at the wanted positions are kept.
    """
    by = list(by)
    counts = (
        df.filter(F.col(col).isNotNull())
        .groupBy(*by, col).agg(F.count(F.lit(1)).alias("__n"))
    )
    placed = running_total(counts, "__n", [col], by, out="__upto", total="__total")
    # Position p*(n-1) lies between the rows at its floor and its ceiling.
    wanted = F.array(*[
        F.struct(F.lit(i).alias("i"), (F.lit(float(p)) * (F.col("__total") - 1)).alias("h"))
        for i, p in enumerate(probs)
    ])
    lowest = F.col("__upto") - F.col("__n")

    def share(w: Column) -> Column:
        lower, upper = F.floor(w["h"]), F.ceil(w["h"])
        frac = w["h"] - lower
        holds_lower = (lower >= lowest) & (lower < F.col("__upto"))
        holds_upper = (upper >= lowest) & (upper < F.col("__upto"))
        return (F.when(holds_lower, F.lit(1.0) - frac).otherwise(0.0)
                + F.when(holds_upper, frac).otherwise(0.0))

    parts = (
        placed.select(*by, F.col(col).cast("double").alias("__v"), "__upto", "__n",
                      F.explode(wanted).alias("__w"))
        .select(*by, "__v", F.col("__w.i").alias("__i"), share(F.col("__w")).alias("__share"))
        .filter(F.col("__share") > 0)
    )
    edges = parts.groupBy(*by, "__i").agg(F.sum(F.col("__v") * F.col("__share")).alias("__edge"))
    # One element per probability and group.
    ordered = F.array_sort(F.collect_list(F.struct("__i", "__edge")))
    return edges.groupBy(*by).agg(F.transform(ordered, lambda e: e["__edge"]).alias(out))
