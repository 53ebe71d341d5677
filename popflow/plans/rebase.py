"""Re-base: five-year seeds and controls of all states to one-year totals, in one job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popflow.functions.columns import sums
from popflow.operators import rebase as ops
from popflow.session import cut
from popflow.specs import (
    BG_PERSON_COLS, ESTIMATED_VARIABLES, HOUSEHOLD_COLS, MODE_COLS, PERSON_COLS, REGION,
    REMAINDER_COLS, TRACT_PERSON_COLS,
)


def rebase_seeds(
    seed_hh: DataFrame, seed_per: DataFrame,
    hh1: DataFrame, hh5: DataFrame, per1: DataFrame, per5: DataFrame, acs1: DataFrame,
    mapping: Mapping[str, Sequence[str]] = ESTIMATED_VARIABLES,
) -> tuple[DataFrame, DataFrame]:
    """Seed weights scaled by PUMA factors, then to the one-year totals of their state."""
    totals = ops.derive_targets(acs1, {c: mapping[c] for c in ("H_TOTAL", "P_TOTAL")})
    out = []
    for seed, one, five, weight, total in (
            (seed_hh, hh1, hh5, "WGTP", "H_TOTAL"), (seed_per, per1, per5, "PWGTP", "P_TOTAL")):
        zones, _ = ops.zone_and_state_factors(one, five, weight, "factor")
        scaled = ops.apply_factor(seed, zones.drop("STATE"), "PUMA", [weight])
        out.append(ops.match_total(scaled, weight, totals, total))
    return out[0], out[1]


def rebase_controls(
    controls: Mapping[str, DataFrame], xwalk: DataFrame,
    hh1: DataFrame, hh5: DataFrame, per1: DataFrame, per5: DataFrame, acs1: DataFrame,
    mapping: Mapping[str, Sequence[str]] = ESTIMATED_VARIABLES,
) -> dict[str, DataFrame]:
    """BG, TRACT, STATE and REGION controls scaled by factors, matched to the one-year controls.

    ``controls`` holds BG, TRACT and STATE tables. The region is the sum of its re-based states.
    """
    zone_hh, state_hh = ops.zone_and_state_factors(hh1, hh5, "WGTP", "ADJ_FACTOR_HH")
    zone_per, state_per = ops.zone_and_state_factors(per1, per5, "PWGTP", "ADJ_FACTOR_PER")
    target = ops.derive_targets(acs1, mapping)

    bg = ops.scale_controls(
        ops.ordered_projection(controls["BG"]), ops.zone_factors(xwalk, "BG", zone_hh, zone_per),
        "BG", HOUSEHOLD_COLS, BG_PERSON_COLS)
    tract = ops.scale_controls(
        ops.ordered_projection(controls["TRACT"]),
        ops.zone_factors(xwalk, "TRACT", zone_hh, zone_per), "TRACT", [], TRACT_PERSON_COLS)
    state = ops.scale_by_state(
        ops.ordered_projection(controls["STATE"]), state_hh, state_per,
        HOUSEHOLD_COLS, PERSON_COLS)

    # One row per state; everything after this reads the ratios, not their derivation.
    direct = ops.control_ratios(target, state, list(mapping))
    rest = ops.remainder_targets(target)
    bg_rest = bg.groupBy("STATE").agg(*sums(["P_NON_WORKER", "P_NON_UNIVERSITY"]))
    tract_rest = tract.groupBy("STATE").agg(*sums(["P_MODE_NA"]))
    ratios = cut(direct.join(
        ops.control_ratios(rest, bg_rest.join(tract_rest, "STATE"), REMAINDER_COLS), "STATE"))

    state = ops.ratio_adjust(state, ratios, exclude=REMAINDER_COLS)
    bg = ops.ratio_adjust(bg, ratios, exclude=MODE_COLS)
    tract = ops.ratio_adjust(tract, ratios, include=MODE_COLS)
    totals = [c for c in state.columns if c in HOUSEHOLD_COLS + PERSON_COLS]
    region = state.agg(*sums(totals)).select(F.lit(REGION).alias("REGION"), *totals)
    return {
        "control_totals_BG": ops.round_controls(bg, HOUSEHOLD_COLS + BG_PERSON_COLS),
        "control_totals_TRACT": ops.round_controls(tract, TRACT_PERSON_COLS),
        "control_totals_STATE": ops.round_controls(state, HOUSEHOLD_COLS + PERSON_COLS),
        "scaled_control_totals_meta": ops.round_controls(region, HOUSEHOLD_COLS + PERSON_COLS),
    }


def surveyed_states(zones: DataFrame, *surveys: DataFrame) -> DataFrame:
    """(STATE, surveyed): every state of the zones, and whether all one-year tables have it."""
    states = zones.select("STATE").distinct()
    for survey in surveys:
        have = survey.select("STATE").distinct().withColumn("__in", F.lit(True))
        flag = F.coalesce("__in", F.lit(False))
        states = states.join(have, "STATE", "left").select(
            "STATE", (flag & F.col("surveyed") if "surveyed" in states.columns else flag
                      ).alias("surveyed"))
    return states


def rebase(
    seed_hh: DataFrame, seed_per: DataFrame,
    controls: Mapping[str, DataFrame], xwalk: DataFrame,
    hh1: DataFrame, hh5: DataFrame, per1: DataFrame, per5: DataFrame, acs1: DataFrame,
    mapping: Mapping[str, Sequence[str]] = ESTIMATED_VARIABLES,
) -> dict[str, DataFrame]:
    """Re-based seeds and controls; every input has a STATE column.

    A state that a one-year table lacks cannot be re-based. It is left out of every result, the
    region among them, and named in ``states_left_out``.
    """
    states = cut(surveyed_states(controls["STATE"], hh1, per1, acs1))
    have = states.filter("surveyed").select("STATE")  # one row per state

    def kept(df: DataFrame) -> DataFrame:
        if "STATE" not in df.columns:
            return df
        return df.join(have, "STATE", "left_semi").select(*df.columns)

    surveys = (hh1, hh5, per1, per5, acs1, mapping)
    households, persons = rebase_seeds(kept(seed_hh), kept(seed_per), *surveys)
    return {"seed_households": households, "seed_persons": persons,
            **rebase_controls({name: kept(df) for name, df in controls.items()}, kept(xwalk),
                              *surveys),
            "states_left_out": states.filter("NOT surveyed").select("STATE")}
