"""Consistency checks. Each returns a report; none stops the job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popflow.functions.columns import is_close, quoted
from popflow.session import cut
from popflow.specs import CHECK_RTOL, CONTROLS, TOTAL_TARGETS, Control


def _unpivoted(row: DataFrame, meta: Mapping[str, Sequence[str]], value: str) -> DataFrame:
    """A one-row table with one column per target as (meta..., value) rows."""
    entries = [
        ", ".join([*[f"'{v}'" for v in values], quoted(values[0])])
        for values in zip(*meta.values())
    ]
    return row.selectExpr(
        f"stack({len(entries)}, {', '.join(entries)}) AS ({', '.join(meta)}, {value})")


def _meta(controls: Sequence[Control]) -> dict[str, list[str]]:
    return {
        "target": [c.target for c in controls],
        "seed_table": [c.seed_table for c in controls],
        "control_group": [c.control_group for c in controls],
    }


def control_counts(
    households: DataFrame, persons: DataFrame, controls: Sequence[Control] = CONTROLS
) -> DataFrame:
    """Number of seed records that satisfy each control: one scan per seed table."""
    counts = None
    for table, df in (("households", households), ("persons", persons)):
        mine = [c for c in controls if c.seed_table == table]
        if not mine:
            continue
        row = df.agg(*[F.expr(f"count_if({c.expression}) AS {c.target}") for c in mine])
        part = _unpivoted(row, _meta(mine), "n")
        counts = part if counts is None else counts.unionByName(part)
    return counts


def check_groups(
    values: DataFrame,
    totals: DataFrame,
    value: str = "n",
    rtol: float = CHECK_RTOL,
    keys: Sequence[str] = ("seed_table", "control_group"),
) -> DataFrame:
    """Compare each control group with the total of its seed table.

    ``totals`` has ``seed_table`` and ``total``.
    """
    groups = values.groupBy(*keys).agg(F.sum(value).alias("group_sum"))
    return groups.join(totals, "seed_table").select(
        *keys, "group_sum", "total", is_close("group_sum", "total", rtol).alias("ok"))


def check_seeds(
    households: DataFrame, persons: DataFrame, controls: Sequence[Control] = CONTROLS,
    rtol: float = CHECK_RTOL,
) -> DataFrame:
    """Groups of seed controls against the record totals of their tables."""
    counts = cut(control_counts(households, persons, controls))  # one row per control
    totals = counts.filter(F.col("target").isin(list(TOTAL_TARGETS.values()))).select(
        "seed_table", F.col("n").alias("total"))
    return check_groups(counts, totals, "n", rtol)


def check_targets(
    tables: Mapping[str, DataFrame], controls: Sequence[Control] = CONTROLS,
    rtol: float = CHECK_RTOL,
) -> DataFrame:
    """Groups of published controls against the published totals."""
    sums = None
    for geography, df in tables.items():
        mine = [c for c in controls if c.geography == geography and c.control_field in df.columns]
        if not mine:
            continue
        row = df.agg(*[
            F.expr(f"CAST(sum({c.control_field}) AS DOUBLE) AS {c.target}") for c in mine])
        meta = _meta(mine) | {"geography": [c.geography for c in mine]}
        part = _unpivoted(row, meta, "value")
        sums = part if sums is None else sums.unionByName(part)
    sums = cut(sums)  # one row per control
    totals = sums.filter(F.col("target").isin(list(TOTAL_TARGETS.values()))).select(
        "seed_table", F.col("value").alias("total"))
    return check_groups(sums, totals, "value", rtol,
                        ("geography", "seed_table", "control_group"))


def unique_check(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    """Row count, distinct key count and whether they agree."""
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    return counted.agg(
        F.coalesce(F.sum("__n"), F.lit(0).cast("bigint")).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
    ).withColumn("is_unique", F.col("n_rows") == F.col("n_keys"))


def set_difference(left: DataFrame, right: DataFrame, col: str) -> DataFrame:
    """Values on one side only, with the side that holds them."""
    a, b = left.select(col).distinct(), right.select(col).distinct()
    return (
        a.join(b, col, "left_anti").withColumn("side", F.lit("left"))
        .unionByName(b.join(a, col, "left_anti").withColumn("side", F.lit("right")))
    )
