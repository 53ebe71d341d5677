"""Re-basing of weights and controls from a five-year to a one-year survey.

Every ratio is keyed by STATE, so all states are re-based in one job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popflow.functions.columns import (
    null_skipping_sum, quoted, ratio, ratio_sql, replaced, round_to_long, sums,
)
from popflow.operators.ordering import keep_first
from popflow.session import cut
from popflow.specs import CONTROL_ORDER, ESTIMATED_VARIABLES


def ordered_projection(df: DataFrame, order: Sequence[str] = CONTROL_ORDER) -> DataFrame:
    """The columns of ``order`` that exist, in that order; all columns if none does."""
    kept = [c for c in order if c in df.columns]
    return df.select(*kept) if kept else df


def weight_factor(
    df1: DataFrame, df5: DataFrame, weight: str, by: Sequence[str] = ("STATE", "PUMA"),
    out: str = "factor",
) -> DataFrame:
    """Ratio of one-year to five-year weight sums per zone of the five-year data."""
    by = list(by)
    sum5 = df5.groupBy(*by).agg(F.sum(weight).alias("sum_5yr"))
    sum1 = df1.groupBy(*by).agg(F.sum(weight).alias("sum_1yr"))
    return sum5.join(sum1, by, "left").withColumn(out, ratio("sum_1yr", "sum_5yr"))


def zone_and_state_factors(
    df1: DataFrame, df5: DataFrame, weight: str, out: str, state: str = "STATE",
    zone: str = "PUMA",
) -> tuple[DataFrame, DataFrame]:
    """Zone factors and state factors from one written table of zone sums.

    A zone that only the one-year data have counts in its state but has no factor.
    """
    sum5 = df5.groupBy(state, zone).agg(F.sum(weight).alias("sum_5yr"))
    sum1 = df1.groupBy(state, zone).agg(F.sum(weight).alias("sum_1yr"))
    zones = cut(sum5.join(sum1, [state, zone], "full_outer"))
    states = zones.groupBy(state).agg(*sums(["sum_5yr", "sum_1yr"]))
    by_zone, by_state = (
        df.filter("sum_5yr IS NOT NULL").withColumn(out, ratio("sum_1yr", "sum_5yr"))
        for df in (zones, states))
    return by_zone.select(state, zone, out), by_state.select(state, out)


def apply_factor(
    df: DataFrame, factors: DataFrame, on: str | Sequence[str], cols: Sequence[str],
    factor: str = "factor", default: float | None = None,
) -> DataFrame:
    """Scale ``cols`` by the factor of their zone; unmatched rows get ``default`` or null.

    The factors, one row per zone, are written first: the planner then knows their size and
    broadcasts them below its threshold, so ``df`` is not shuffled by a key as coarse as a state.
    """
    joined = df.join(cut(factors), [on] if isinstance(on, str) else list(on), "left")
    by = factor if default is None else f"coalesce({factor}, {float(default)}D)"
    return joined.selectExpr(*replaced(df, {c: f"{quoted(c)} * {by}" for c in cols}))


def zone_factors(
    xwalk: DataFrame, zone: str, hh: DataFrame, per: DataFrame, seed_zone: str = "PUMA",
) -> DataFrame:
    """Household and person factors of each zone, through one seed zone per zone.

    A zone listed under several seed zones keeps the one of its first block group. The result is
    written, as every control table of the zone is scaled by it.
    """
    order = ["BG"] if "BG" in xwalk.columns and zone != "BG" else [seed_zone]
    link = keep_first(
        xwalk.select(zone, seed_zone, *[c for c in order if c != seed_zone]), zone, order)
    return cut(
        link.select(zone, seed_zone)
        .join(hh.select(seed_zone, "ADJ_FACTOR_HH"), seed_zone, "left")
        .join(per.select(seed_zone, "ADJ_FACTOR_PER"), seed_zone, "left")
        .select(zone, "ADJ_FACTOR_HH", "ADJ_FACTOR_PER")
    )


def scale_controls(
    zones: DataFrame, factors: DataFrame, zone: str | Sequence[str],
    hh_cols: Sequence[str], per_cols: Sequence[str],
) -> DataFrame:
    """Scale zone controls by household and person factors.

    Every null left after the join becomes 1, in control columns and factors alike.
    """
    joined = zones.join(factors, [zone] if isinstance(zone, str) else list(zone), "left")
    filled = joined.fillna(1).fillna("1")
    scaled = {c: f"{quoted(c)} * ADJ_FACTOR_HH" for c in hh_cols}
    scaled |= {c: f"{quoted(c)} * ADJ_FACTOR_PER" for c in per_cols}
    return filled.selectExpr(*replaced(zones, scaled))


def scale_by_state(
    states: DataFrame, hh_state: DataFrame, per_state: DataFrame,
    hh_cols: Sequence[str], per_cols: Sequence[str], state: str = "STATE",
) -> DataFrame:
    """Scale state-level controls by the state factors."""
    factors = hh_state.join(per_state, state, "full_outer")
    new = {c: f"{quoted(c)} * ADJ_FACTOR_HH" for c in hh_cols}
    new |= {c: f"{quoted(c)} * ADJ_FACTOR_PER" for c in per_cols}
    return states.join(factors, state, "left").selectExpr(*replaced(states, new))


def derive_targets(
    wide: DataFrame, mapping: Mapping[str, Sequence[str]] = ESTIMATED_VARIABLES,
    keys: Sequence[str] = ("STATE",),
) -> DataFrame:
    """One-year controls as sums of published variables, a missing variable counting as 1."""
    totals = [
        f"CAST({null_skipping_sum(variables, fill=1)} AS BIGINT) AS {quoted(control)}"
        for control, variables in mapping.items()
    ]
    return wide.selectExpr(*keys, *totals)


def match_total(
    df: DataFrame, weight: str, targets: DataFrame, target: str, by: str = "STATE"
) -> DataFrame:
    """Scale ``weight`` so that its sum per ``by`` equals the target."""
    totals = df.groupBy(by).agg(F.sum(weight).alias("__sum"))
    factors = targets.join(totals, by).select(by, ratio(target, "__sum").alias("__factor"))
    return apply_factor(df, factors, by, [weight], "__factor")


def remainder_targets(targets: DataFrame, keys: Sequence[str] = ("STATE",)) -> DataFrame:
    """One-year values of the remainder controls."""
    modes = ["P_MODE_AUTO_OTHER", "P_MODE_TRANSIT", "P_MODE_WALK_BIKE", "P_MODE_WFH"]
    non_na = F.col("P_TOTAL")
    for mode in modes:
        non_na = non_na - F.col(mode)
    return targets.select(
        *keys,
        (F.col("P_TOTAL") - F.col("P_FULL_TIME") - F.col("P_PART_TIME")).alias("P_NON_WORKER"),
        (F.col("P_TOTAL") - F.col("P_UNIVERSITY")).alias("P_NON_UNIVERSITY"),
        non_na.alias("P_MODE_NA"),
    )


def control_ratios(
    targets: DataFrame, totals: DataFrame, cols: Sequence[str], key: str = "STATE"
) -> DataFrame:
    """Target over current total for each control, aligned by name.

    A control missing on either side has a null ratio.
    """
    both = [c for c in cols if c in targets.columns and c in totals.columns]
    joined = targets.alias("t").join(totals.alias("c"), key)
    ratios = [
        (ratio_sql(f"t.{quoted(c)}", f"c.{quoted(c)}") if c in both else "CAST(NULL AS DOUBLE)")
        + f" AS {quoted(c)}"
        for c in cols
    ]
    return joined.selectExpr(key, *ratios)


def ratio_adjust(
    df: DataFrame, ratios: DataFrame, on: str = "STATE",
    include: Sequence[str] | None = None, exclude: Sequence[str] = (),
) -> DataFrame:
    """Multiply each column by the ratio of the same name.

    The ratios are written first, so that the join knows their size: below the broadcast
    threshold the zones are not dealt out by a key that a few states share.
    """
    cols = [
        c for c in df.columns
        if c in ratios.columns and c != on and c not in exclude
        and (include is None or c in include)
    ]
    renamed = cut(ratios.selectExpr(on, *[f"{quoted(c)} AS {quoted('__' + c)}" for c in cols]))
    return df.join(renamed, on, "left").selectExpr(
        *replaced(df, {c: f"{quoted(c)} * {quoted('__' + c)}" for c in cols}))


def round_controls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Round the controls half to even as bigint; a null control raises."""
    return df.selectExpr(*replaced(df, {c: round_to_long(c) for c in cols}))
