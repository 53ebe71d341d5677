"""Queries on re-basing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popflow.catalog.registry import query
from popflow.catalog.roles import BG_CONTROLS, Roles, row_sum
from popflow.functions.geoid import compose_geoids
from popflow.operators import ordering, rebase as ops, targets
from popflow.plans.rebase import rebase, rebase_controls, rebase_seeds, surveyed_states
from popflow.specs import (
    BG_PERSON_COLS, ESTIMATED_VARIABLES, FIXED_RENAMES, HOUSEHOLD_COLS, MODE_COLS, PERSON_COLS,
)

ONE_YEAR = 2000


def surveys(t: Roles) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Weights of the one-year and the five-year survey: households, then persons."""
    hh = compose_geoids(
        t.hh_raw().select("ST", "PUMA", "WGTP", "YR").withColumnsRenamed(FIXED_RENAMES))
    per = compose_geoids(
        t.per_raw().select("ST", "PUMA", "PWGTP", "YR").withColumnsRenamed(FIXED_RENAMES))
    one = F.col("YR") == ONE_YEAR
    return hh.filter(one), hh, per.filter(one), per


_PUMA = "ST * 100000 + PUMA % 100000"
_FACTOR_CTES = f"""
WITH hz AS (
  SELECT ST AS STATE, {_PUMA} AS PUMA, CAST(sum(WGTP) AS BIGINT) AS sum_5yr,
         CAST(sum(WGTP) FILTER (WHERE YR = {ONE_YEAR}) AS BIGINT) AS sum_1yr
  FROM hh_raw GROUP BY ALL),
pz AS (
  SELECT ST AS STATE, {_PUMA} AS PUMA, CAST(sum(PWGTP) AS BIGINT) AS sum_5yr,
         CAST(sum(PWGTP) FILTER (WHERE YR = {ONE_YEAR}) AS BIGINT) AS sum_1yr
  FROM per_raw GROUP BY ALL),
hf AS (SELECT STATE, PUMA, sum_1yr / nullif(CAST(sum_5yr AS DOUBLE), 0) AS f FROM hz),
pf AS (SELECT STATE, PUMA, sum_1yr / nullif(CAST(sum_5yr AS DOUBLE), 0) AS f FROM pz),
hs AS (SELECT STATE, CAST(sum(sum_1yr) AS DOUBLE) / CAST(sum(sum_5yr) AS DOUBLE) AS f
       FROM hz GROUP BY STATE),
ps AS (SELECT STATE, CAST(sum(sum_1yr) AS DOUBLE) / CAST(sum(sum_5yr) AS DOUBLE) AS f
       FROM pz GROUP BY STATE)
"""


@query("adj_factor_by_zone", _FACTOR_CTES + """
SELECT STATE, PUMA, sum_5yr, sum_1yr, round(f, 9) AS factor FROM hz JOIN hf USING (STATE, PUMA)""")
def adj_factor_by_zone(t: Roles) -> DataFrame:
    hh1, hh5, _, _ = surveys(t)
    return ops.weight_factor(hh1, hh5, "WGTP").withColumn("factor", F.round("factor", 9))


@query("adj_factor_state", _FACTOR_CTES + """
SELECT STATE, round(hs.f, 9) AS hh_factor, round(ps.f, 9) AS per_factor
FROM hs JOIN ps USING (STATE)""")
def adj_factor_state(t: Roles) -> DataFrame:
    hh1, hh5, per1, per5 = surveys(t)
    _, hh = ops.zone_and_state_factors(hh1, hh5, "WGTP", "hh_factor")
    _, per = ops.zone_and_state_factors(per1, per5, "PWGTP", "per_factor")
    return hh.join(per, "STATE").select(
        "STATE", F.round("hh_factor", 9).alias("hh_factor"),
        F.round("per_factor", 9).alias("per_factor"))


@query("seed_rebase", _FACTOR_CTES + """
SELECT SERIALNO, h.ST AS STATE, hf.PUMA, round(WGTP * f, 6) AS WGTP
FROM hh h LEFT JOIN hf ON hf.PUMA = h.ST * 100000 + h.PUMA % 100000""")
def seed_rebase(t: Roles) -> DataFrame:
    hh1, hh5, _, _ = surveys(t)
    zones, _ = ops.zone_and_state_factors(hh1, hh5, "WGTP", "f")
    seeds = compose_geoids(
        t.hh().select("SERIALNO", "ST", "PUMA", "WGTP").withColumnsRenamed(FIXED_RENAMES))
    return ops.apply_factor(seeds, zones.drop("STATE"), "PUMA", ["WGTP"], "f").select(
        "SERIALNO", "STATE", "PUMA", F.round("WGTP", 6).alias("WGTP"))


@query("seed_match_total", """
SELECT SERIALNO, ST AS STATE,
       round(WGTP * (H_TOTAL / CAST(sum(WGTP) OVER (PARTITION BY ST) AS DOUBLE)), 6) AS WGTP
FROM hh h JOIN acs1_targets a ON a.STATE = h.ST""")
def seed_match_total(t: Roles) -> DataFrame:
    seeds = t.hh().select("SERIALNO", F.col("ST").alias("STATE"), "WGTP")
    goals = ops.derive_targets(t.acs1(), {"H_TOTAL": ESTIMATED_VARIABLES["H_TOTAL"]})
    return ops.match_total(seeds, "WGTP", goals, "H_TOTAL").withColumn(
        "WGTP", F.round("WGTP", 6))


def _bg_factors(t: Roles) -> DataFrame:
    hh1, hh5, per1, per5 = surveys(t)
    hh, _ = ops.zone_and_state_factors(hh1, hh5, "WGTP", "ADJ_FACTOR_HH")
    per, _ = ops.zone_and_state_factors(per1, per5, "PWGTP", "ADJ_FACTOR_PER")
    return ops.zone_factors(t.xwalk(), "BG", hh, per)


_BG_SCALED = (
    "bg_scaled AS (SELECT b.COUNTY, b.BG, b.TRACT, b.STATE, b.NAME, "
    + ", ".join(f"b.{c} * coalesce(hf.f, 1) AS {c}" for c in HOUSEHOLD_COLS) + ", "
    + ", ".join(f"b.{c} * coalesce(pf.f, 1) AS {c}" for c in BG_PERSON_COLS)
    + """ FROM bg_controls b JOIN xwalk x USING (BG)
    LEFT JOIN hf ON hf.PUMA = x.PUMA LEFT JOIN pf ON pf.PUMA = x.PUMA)""")
_TRACT_SCALED = (
    "tract_puma AS (SELECT TRACT, min_by(PUMA, BG) AS PUMA FROM xwalk GROUP BY TRACT), "
    "tract_scaled AS (SELECT c.COUNTY, c.TRACT, c.STATE, "
    + ", ".join(f"c.{m} * coalesce(pf.f, 1) AS {m}" for m in MODE_COLS)
    + """ FROM tract_controls c JOIN tract_puma x USING (TRACT)
    LEFT JOIN pf ON pf.PUMA = x.PUMA)""")
_STATE_SCALED = (
    "state_scaled AS (SELECT STATE, "
    + ", ".join(f"{c} * hs.f AS {c}" for c in HOUSEHOLD_COLS) + ", "
    + ", ".join(f"{c} * ps.f AS {c}" for c in PERSON_COLS)
    + " FROM state_controls JOIN hs USING (STATE) JOIN ps USING (STATE))")
_SCALED = _FACTOR_CTES.rstrip() + ",\n" + ",\n".join([_BG_SCALED, _TRACT_SCALED, _STATE_SCALED])
_RATIOS = (
    "ratios AS (SELECT a.STATE, "
    + ", ".join(f"a.{c} / nullif(s.{c}, 0) AS {c}" for c in ESTIMATED_VARIABLES)
    + """, (a.P_TOTAL - a.P_FULL_TIME - a.P_PART_TIME) / nullif(b.P_NON_WORKER, 0) AS P_NON_WORKER,
    (a.P_TOTAL - a.P_UNIVERSITY) / nullif(b.P_NON_UNIVERSITY, 0) AS P_NON_UNIVERSITY,
    (a.P_TOTAL - a.P_MODE_AUTO_OTHER - a.P_MODE_TRANSIT - a.P_MODE_WALK_BIKE - a.P_MODE_WFH)
      / nullif(m.P_MODE_NA, 0) AS P_MODE_NA
    FROM acs1_targets a JOIN state_scaled s USING (STATE)
    JOIN (SELECT STATE, sum(P_NON_WORKER) AS P_NON_WORKER,
                 sum(P_NON_UNIVERSITY) AS P_NON_UNIVERSITY FROM bg_scaled GROUP BY STATE) b
      USING (STATE)
    JOIN (SELECT STATE, sum(P_MODE_NA) AS P_MODE_NA FROM tract_scaled GROUP BY STATE) m
      USING (STATE))""")
_REBASED = _SCALED + ",\n" + _RATIOS


def _rounded(cols: list[str], left: str, right: str = "r") -> str:
    return ", ".join(
        f"CAST(round_even({left}.{c} * {right}.{c}, 0) AS BIGINT) AS {c}" for c in cols)


@query("controls_scale_zone", _SCALED + " SELECT BG, STATE, "
       + ", ".join(f"round({c}, 6) AS {c}" for c in HOUSEHOLD_COLS + BG_PERSON_COLS)
       + " FROM bg_scaled")
def controls_scale_zone(t: Roles) -> DataFrame:
    scaled = ops.scale_controls(
        ops.ordered_projection(t.prepared("BG")["BG"]), _bg_factors(t), "BG",
        HOUSEHOLD_COLS, BG_PERSON_COLS)
    return scaled.select(
        "BG", "STATE", *[F.round(c, 6).alias(c) for c in HOUSEHOLD_COLS + BG_PERSON_COLS])


@query("controls_scale_parent", _SCALED + " SELECT STATE, "
       + ", ".join(f"round({c}, 6) AS {c}" for c in HOUSEHOLD_COLS + PERSON_COLS)
       + " FROM state_scaled")
def controls_scale_parent(t: Roles) -> DataFrame:
    hh1, hh5, per1, per5 = surveys(t)
    _, hh = ops.zone_and_state_factors(hh1, hh5, "WGTP", "ADJ_FACTOR_HH")
    _, per = ops.zone_and_state_factors(per1, per5, "PWGTP", "ADJ_FACTOR_PER")
    scaled = ops.scale_by_state(t.prepared("STATE")["STATE"], hh, per, HOUSEHOLD_COLS, PERSON_COLS)
    return scaled.select(
        "STATE", *[F.round(c, 6).alias(c) for c in HOUSEHOLD_COLS + PERSON_COLS])


@query("derive_targets", "SELECT NAME, "
       + ", ".join(f"{row_sum(f, 1)} AS {c}" for c, f in ESTIMATED_VARIABLES.items())
       + " FROM acs_bg")
def derive_targets(t: Roles) -> DataFrame:
    return ops.derive_targets(t.acs_bg(), ESTIMATED_VARIABLES, ["NAME"])


@query("ratio_adjust_round", _REBASED + ", adjusted AS (SELECT b.BG, "
       + ", ".join(f"b.{c} * r.{c} AS {c}" for c in ("H_TOTAL", "P_TOTAL", "P_NON_WORKER"))
       + """ FROM bg_scaled b JOIN ratios r USING (STATE))
SELECT BG, round(H_TOTAL, 4) AS h_exact, round(P_TOTAL, 4) AS p_exact,
       round(P_NON_WORKER, 4) AS nw_exact,
       CAST(round_even(H_TOTAL, 0) AS BIGINT) AS H_TOTAL,
       CAST(round_even(P_TOTAL, 0) AS BIGINT) AS P_TOTAL,
       CAST(round_even(P_NON_WORKER, 0) AS BIGINT) AS P_NON_WORKER FROM adjusted""")
def ratio_adjust_round(t: Roles) -> DataFrame:
    cols = ["H_TOTAL", "P_TOTAL", "P_NON_WORKER"]
    prepared = t.prepared("BG", "STATE")
    hh1, hh5, per1, per5 = surveys(t)
    _, hh = ops.zone_and_state_factors(hh1, hh5, "WGTP", "ADJ_FACTOR_HH")
    _, per = ops.zone_and_state_factors(per1, per5, "PWGTP", "ADJ_FACTOR_PER")
    bg = ops.scale_controls(
        prepared["BG"].select("BG", "STATE", *cols), _bg_factors(t), "BG",
        ["H_TOTAL"], ["P_TOTAL", "P_NON_WORKER"])
    state = ops.scale_by_state(
        prepared["STATE"].select("STATE", "H_TOTAL", "P_TOTAL"), hh, per,
        ["H_TOTAL"], ["P_TOTAL"])
    goals = ops.derive_targets(t.acs1())
    left = bg.groupBy("STATE").agg(F.sum("P_NON_WORKER").alias("P_NON_WORKER"))
    ratios = ops.control_ratios(goals, state, cols[:2]).join(
        ops.control_ratios(ops.remainder_targets(goals), left, cols[2:]), "STATE")
    exact = ops.ratio_adjust(bg, ratios)
    named = exact.select(
        "BG", F.round("H_TOTAL", 4).alias("h_exact"), F.round("P_TOTAL", 4).alias("p_exact"),
        F.round("P_NON_WORKER", 4).alias("nw_exact"), *cols)
    return ops.round_controls(named, cols)


def _rebased_seeds(t: Roles) -> tuple[DataFrame, DataFrame]:
    seeds = compose_geoids(
        t.hh().select("SERIALNO", "ST", "PUMA", "WGTP").withColumnsRenamed(FIXED_RENAMES))
    persons = compose_geoids(
        t.per().select("SERIALNO", "SPORDER", "ST", "PUMA", "PWGTP", "AGEP")
        .withColumnsRenamed(FIXED_RENAMES))
    return rebase_seeds(seeds, persons, *surveys(t), t.acs1())


def _rebased_controls(t: Roles) -> dict[str, DataFrame]:
    return rebase_controls(
        t.prepared("BG", "TRACT", "STATE"), t.xwalk(), *surveys(t), t.acs1())


_SEED_SQL = """
, scaled AS (SELECT s.*, s.{w} * f.f AS w2 FROM seeds s LEFT JOIN {f} f ON f.PUMA = s.PUMA)
SELECT {cols}, s.STATE, s.PUMA, round(w2 * ({total} / sum(w2) OVER (PARTITION BY s.STATE)), 4) AS {w}
FROM scaled s JOIN acs1_targets a ON a.STATE = s.STATE"""


@query("rebase_seed_households", _FACTOR_CTES.rstrip() + f"""
, seeds AS (SELECT SERIALNO, ST AS STATE, {_PUMA} AS PUMA, WGTP FROM hh)"""
       + _SEED_SQL.format(w="WGTP", f="hf", cols="SERIALNO", total="H_TOTAL"))
def rebase_seed_households(t: Roles) -> DataFrame:
    return _rebased_seeds(t)[0].select(
        "SERIALNO", "STATE", "PUMA", F.round("WGTP", 4).alias("WGTP"))


@query("rebase_seed_persons", _FACTOR_CTES.rstrip() + f"""
, seeds AS (SELECT SERIALNO, SPORDER, AGEP, ST AS STATE, {_PUMA} AS PUMA, PWGTP FROM per)"""
       + _SEED_SQL.format(w="PWGTP", f="pf", cols="SERIALNO, SPORDER, AGEP", total="P_TOTAL"))
def rebase_seed_persons(t: Roles) -> DataFrame:
    return _rebased_seeds(t)[1].select(
        "SERIALNO", "SPORDER", "AGEP", "STATE", "PUMA", F.round("PWGTP", 4).alias("PWGTP"))


@query("rebase_controls_bg", _REBASED + " SELECT b.COUNTY, b.BG, b.TRACT, b.STATE, b.NAME, "
       + _rounded(HOUSEHOLD_COLS + BG_PERSON_COLS, "b")
       + " FROM bg_scaled b JOIN ratios r USING (STATE)")
def rebase_controls_bg(t: Roles) -> DataFrame:
    return _rebased_controls(t)["control_totals_BG"].drop("REGION")


@query("rebase_controls_tract", _REBASED + " SELECT c.COUNTY, c.TRACT, c.STATE, "
       + _rounded(MODE_COLS, "c") + " FROM tract_scaled c JOIN ratios r USING (STATE)")
def rebase_controls_tract(t: Roles) -> DataFrame:
    return _rebased_controls(t)["control_totals_TRACT"].drop("REGION")


@query("rebase_controls_state", _REBASED + " SELECT s.STATE, "
       + _rounded(HOUSEHOLD_COLS + PERSON_COLS, "s")
       + " FROM state_scaled s JOIN ratios r USING (STATE)")
def rebase_controls_state(t: Roles) -> DataFrame:
    return _rebased_controls(t)["control_totals_STATE"]


@query("rebase_controls_region", _REBASED + " SELECT 1 AS REGION, "
       + ", ".join(f"CAST(round_even(sum(s.{c} * r.{c}), 0) AS BIGINT) AS {c}"
                   for c in HOUSEHOLD_COLS + PERSON_COLS)
       + " FROM state_scaled s JOIN ratios r USING (STATE)")
def rebase_controls_region(t: Roles) -> DataFrame:
    return _rebased_controls(t)["scaled_control_totals_meta"]


def _whole_job(t: Roles) -> dict[str, DataFrame]:
    """The whole re-basing; the one-year table lacks state 3."""
    seeds = compose_geoids(
        t.hh().select("SERIALNO", "ST", "PUMA", "WGTP").withColumnsRenamed(FIXED_RENAMES))
    persons = compose_geoids(
        t.per().select("SERIALNO", "SPORDER", "ST", "PUMA", "PWGTP", "AGEP")
        .withColumnsRenamed(FIXED_RENAMES))
    return rebase(seeds, persons, t.prepared("BG", "TRACT", "STATE"), t.xwalk(), *surveys(t),
                  t.acs1().filter("STATE <> 3"))


@query("rebase_job_bg", _REBASED + " SELECT b.COUNTY, b.BG, b.TRACT, b.STATE, b.NAME, "
       + _rounded(HOUSEHOLD_COLS + BG_PERSON_COLS, "b")
       + " FROM bg_scaled b JOIN ratios r USING (STATE) WHERE STATE <> 3")
def rebase_job_bg(t: Roles) -> DataFrame:
    return _whole_job(t)["control_totals_BG"].drop("REGION")


@query("rebase_job_region", _REBASED + " SELECT 1 AS REGION, "
       + ", ".join(f"CAST(round_even(sum(s.{c} * r.{c}), 0) AS BIGINT) AS {c}"
                   for c in HOUSEHOLD_COLS + PERSON_COLS)
       + " FROM state_scaled s JOIN ratios r USING (STATE) WHERE STATE <> 3")
def rebase_job_region(t: Roles) -> DataFrame:
    return _whole_job(t)["scaled_control_totals_meta"]


@query("rebase_job_states", "SELECT DISTINCT STATE, STATE <> 3 AS surveyed FROM xwalk")
def rebase_job_states(t: Roles) -> DataFrame:
    hh1, _, per1, _ = surveys(t)
    return surveyed_states(t.xwalk(), hh1, per1, t.acs1().filter("STATE <> 3"))


@query("keep_first_zone", """
SELECT TRACT, min_by(BG, BG) AS BG, min_by(PUMA, BG) AS PUMA FROM xwalk GROUP BY TRACT""")
def keep_first_zone(t: Roles) -> DataFrame:
    return ordering.keep_first(t.xwalk().select("TRACT", "BG", "PUMA"), "TRACT", ["BG"])


@query("ordered_projection", """
SELECT COUNTY, BG, TRACT, STATE, NAME, H_TOTAL, P_TOTAL, P_MALE FROM bg_controls""")
def ordered_projection(t: Roles) -> DataFrame:
    some = {c: BG_CONTROLS[c] for c in ("P_MALE", "P_TOTAL", "H_TOTAL")}
    bg = t.acs_bg_raw(some).withColumnRenamed("block_group", "block group")
    named = targets.format_targets(targets.aggregate_controls(bg.drop("puma"), some))
    return ops.ordered_projection(named.drop("REGION"))
