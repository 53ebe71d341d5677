"""Prepare: seeds, control totals, crosswalk and the reports on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popflow.functions.geoid import compose_geoids
from popflow.operators import checks, seeds, spatial, targets
from popflow.session import cut
from popflow.sources.geometry import strip_vintage
from popflow.specs import CONTROLS, FIXED_RENAMES, REMAINDERS, SUB_GEOGRAPHIES, Remainder


def prepare_targets(
    acs: Mapping[str, DataFrame], agg: Mapping[str, Mapping[str, Sequence[str]]],
    states: Sequence[str] | None = None, remainders: Mapping[str, Remainder] = REMAINDERS,
) -> dict[str, DataFrame]:
    """Control totals per geography, STATE and REGION.

    ``acs`` and ``agg`` are keyed by geography; state and region totals are taken before the
    remainder controls are added, so they do not hold them. The controls are written once per
    geography; the wide published tables are scanned only for that.
    """
    tables = {
        geo: cut(targets.aggregate_controls(seeds.select_states(df, states, "state"), agg[geo]))
        for geo, df in acs.items()
    }
    by_state, region = targets.state_and_region_totals(
        {geo: (df, list(agg[geo])) for geo, df in tables.items()})
    for name, spec in remainders.items():
        tables[spec.geography] = targets.remainder_control(tables, name, spec)
    out = {geo: targets.format_targets(df) for geo, df in tables.items()}
    out["STATE"] = by_state.withColumn("STATE", F.col("STATE").cast("bigint"))
    out["REGION"] = region
    return out


def prepare_crosswalk(
    bg: DataFrame, tract: DataFrame, puma: DataFrame, data: Mapping[str, DataFrame],
    states: Sequence[str] | None = None,
) -> DataFrame:
    """Crosswalk of the block groups that have data, with one PUMA per BG and TRACT.

    ``data`` maps BG, TRACT and PUMA to tables with composed identifiers.
    """
    bg, tract, puma = (
        seeds.select_states(strip_vintage(z), states, "STATEFP") for z in (bg, tract, puma))
    xwalk = spatial.build_crosswalk(bg, puma)
    areas = compose_geoids(puma.select(
        F.col("STATEFP").alias("STATE"), F.substring("GEOID", 3, 5).alias("PUMA"),
        "STATEFP", "rings")).select("PUMA", "STATEFP", "rings")
    centres = {
        "BG": spatial.centroids(bg, keep=("GEOID", "STATEFP")),
        "TRACT": spatial.centroids(tract, keep=("GEOID", "STATEFP")),
    }
    for zone, df in data.items():
        xwalk = spatial.prune_crosswalk(xwalk, df, zone)
        if zone in SUB_GEOGRAPHIES:
            points = centres[zone].select(
                F.col("GEOID").cast("bigint").alias(zone), "STATEFP", "lon", "lat")
            xwalk = spatial.dedupe_crosswalk(xwalk, points, areas, zone)
    return xwalk


def prepare(
    hh: DataFrame, per: DataFrame, acs: Mapping[str, DataFrame],
    agg: Mapping[str, Mapping[str, Sequence[str]]],
    bg: DataFrame | None = None, tract: DataFrame | None = None, puma: DataFrame | None = None,
    states: Sequence[str] | None = None, remainders: Mapping[str, Remainder] = REMAINDERS,
) -> dict[str, DataFrame]:
    """All inputs of the synthesis, with the check reports under ``check_*``."""
    numbers = None if states is None else [int(s) for s in states]
    seed = seeds.build_seeds(hh, per, numbers)
    out = {"seed_households": seed.households, "seed_persons": seed.persons}
    out["check_seeds"] = checks.check_seeds(seed.households, seed.persons)
    totals = prepare_targets(acs, agg, states, remainders)
    out |= {f"control_totals_{geo}": df for geo, df in totals.items() if geo != "REGION"}
    out["scaled_control_totals_meta"] = totals["REGION"]
    present = {c for df in totals.values() for c in df.columns}
    out["check_targets"] = checks.check_targets(
        totals, [c for c in CONTROLS if c.control_field in present])
    if bg is not None:
        data = {geo: totals[geo] for geo in ("BG", "TRACT") if geo in totals}
        data["PUMA"] = compose_geoids(
            seeds.select_states(hh, numbers).withColumnsRenamed(FIXED_RENAMES))
        out["geo_cross_walk"] = prepare_crosswalk(
            bg, tract, puma, data, None if states is None else list(states))
    return out
