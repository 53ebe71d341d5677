"""Queries on control totals, specs and checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popflow.catalog.registry import query
from popflow.catalog.roles import (
    BG_CONTROLS, COMPOSED_BG, Roles, row_sum,
)
from popflow.operators import checks, spatial, targets
from popflow.specs import CONTROLS, HOUSEHOLD_COLS, PERSON_COLS, REMAINDERS

_BG_LIST = list(BG_CONTROLS)


@query("control_aggregate", "SELECT state, county, tract, block_group, "
       + ", ".join(f"{row_sum(f)} AS {c}" for c, f in BG_CONTROLS.items()) + " FROM acs_bg")
def control_aggregate(t: Roles) -> DataFrame:
    return targets.aggregate_controls(t.acs_bg_raw().drop("puma", "NAME"), BG_CONTROLS)


@query("state_region_rollup", "SELECT STATE AS state, "
       + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _BG_LIST)
       + " FROM bg_controls GROUP BY ROLLUP (STATE)")
def state_region_rollup(t: Roles) -> DataFrame:
    zones = targets.aggregate_controls(t.acs_bg_raw(), BG_CONTROLS)
    return targets.rollup_totals(
        zones.withColumn("state", F.col("state").cast("bigint")), _BG_LIST)


@query("control_totals_state", "SELECT STATE, "
       + ", ".join(HOUSEHOLD_COLS + PERSON_COLS) + " FROM state_controls")
def control_totals_state(t: Roles) -> DataFrame:
    return t.prepared("STATE")["STATE"]


@query("control_totals_region", "SELECT 1 AS REGION, "
       + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in HOUSEHOLD_COLS + PERSON_COLS)
       + " FROM state_controls")
def control_totals_region(t: Roles) -> DataFrame:
    return t.prepared("REGION")["REGION"]


@query("control_totals_bg", "SELECT COUNTY, BG, TRACT, STATE, NAME, 1 AS REGION, "
       + ", ".join([*_BG_LIST, "P_NON_UNIVERSITY", "P_NON_WORKER"]) + " FROM bg_controls")
def control_totals_bg(t: Roles) -> DataFrame:
    return t.prepared("BG")["BG"]


@query("remainder_control", "SELECT COUNTY, TRACT, STATE, 1 AS REGION, P_MODE_AUTO_OTHER, "
       "P_MODE_TRANSIT, P_MODE_WALK_BIKE, P_MODE_WFH, P_MODE_NA FROM tract_controls")
def remainder_control(t: Roles) -> DataFrame:
    return t.prepared("TRACT")["TRACT"]


@query("remainder_negative", "SELECT BG AS zone, P_NON_UNIVERSITY AS remainder, "
       "'P_NON_UNIVERSITY' AS name FROM bg_controls WHERE P_NON_UNIVERSITY <= 0 "
       "UNION ALL SELECT BG, P_NON_WORKER, 'P_NON_WORKER' FROM bg_controls "
       "WHERE P_NON_WORKER <= 0 "
       "UNION ALL SELECT TRACT, P_MODE_NA, 'P_MODE_NA' FROM tract_controls WHERE P_MODE_NA <= 0")
def remainder_negative(t: Roles) -> DataFrame:
    made = t.prepared("BG", "TRACT")
    return reduce(DataFrame.unionByName, [
        targets.negative_remainders(made[spec.geography], name, [spec.geography]).select(
            F.col(spec.geography).alias("zone"), F.col(name).alias("remainder"),
            F.lit(name).alias("name"))
        for name, spec in REMAINDERS.items()])


@query("drop_empty_zones", """
SELECT block_group, tract, H_TOTAL FROM (
  SELECT block_group, tract, coalesce("B11005_001E", 0) AS H_TOTAL FROM acs_bg)
WHERE H_TOTAL <> 0""")
def drop_empty_zones(t: Roles) -> DataFrame:
    some = {"H_TOTAL": BG_CONTROLS["H_TOTAL"]}
    zones = targets.aggregate_controls(
        t.acs_bg_raw(some).select("block_group", "tract", *some["H_TOTAL"]), some)
    return targets.drop_empty_zones(zones)


@query("zone_unique_check", """
SELECT count(*) AS n_rows, count(DISTINCT (state, county, tract, block_group)) AS n_keys,
       count(*) = count(DISTINCT (state, county, tract, block_group)) AS is_unique,
       'BG' AS zone FROM acs_bg
UNION ALL
SELECT count(*), count(DISTINCT (l_orderkey, l_linenumber)),
       count(*) = count(DISTINCT (l_orderkey, l_linenumber)), 'line' FROM lineitem""")
def zone_unique_check(t: Roles) -> DataFrame:
    bg = checks.unique_check(t.acs_bg(), ["state", "county", "tract", "block_group"])
    lines = checks.unique_check(t.table("lineitem"), ["l_orderkey", "l_linenumber"])
    return bg.withColumn("zone", F.lit("BG")).unionByName(
        lines.withColumn("zone", F.lit("line")))


_COUNTS = " UNION ALL ".join(
    f"SELECT '{c.target}' AS target, '{c.seed_table}' AS seed_table, "
    f"'{c.control_group}' AS control_group, count(*) FILTER (WHERE {c.expression}) AS n "
    f"FROM {'hh' if c.seed_table == 'households' else 'per'}"
    for c in CONTROLS)


@query("control_counts", _COUNTS)
def control_counts(t: Roles) -> DataFrame:
    return checks.control_counts(t.hh(), t.per())


@query("check_seed_groups", f"""
WITH counts AS ({_COUNTS}),
totals AS (SELECT seed_table, n AS total FROM counts WHERE target IN ('h_total', 'p_total'))
SELECT seed_table, control_group, CAST(sum(n) AS BIGINT) AS group_sum, total,
       abs(sum(n) - total) <= 1e-8 + 0.01 * abs(total) AS ok
FROM counts JOIN totals USING (seed_table) GROUP BY seed_table, control_group, total""")
def check_seed_groups(t: Roles) -> DataFrame:
    return checks.check_seeds(t.hh(), t.per())


_TARGET_SUMS = " UNION ALL ".join(
    f"SELECT '{c.geography}' AS geography, '{c.target}' AS target, '{c.seed_table}' AS seed_table,"
    f" '{c.control_group}' AS control_group, CAST(sum({c.control_field}) AS DOUBLE) AS v "
    f"FROM {'bg_controls' if c.geography == 'BG' else 'tract_controls'}"
    for c in CONTROLS)


@query("check_target_groups", f"""
WITH sums AS ({_TARGET_SUMS}),
totals AS (SELECT seed_table, v AS total FROM sums WHERE target IN ('h_total', 'p_total'))
SELECT geography, seed_table, control_group, sum(v) AS group_sum, total,
       abs(sum(v) - total) <= 1e-8 + 0.01 * abs(total) AS ok
FROM sums JOIN totals USING (seed_table) GROUP BY geography, seed_table, control_group, total""")
def check_target_groups(t: Roles) -> DataFrame:
    return checks.check_targets(t.prepared())


@query("field_set_diff", """
WITH a AS (SELECT DISTINCT o_custkey AS field FROM orders),
b AS (SELECT DISTINCT c_custkey * 2 AS field FROM customer)
SELECT field, 'left' AS side FROM a WHERE field NOT IN (SELECT field FROM b)
UNION ALL
SELECT field, 'right' AS side FROM b WHERE field NOT IN (SELECT field FROM a)""")
def field_set_diff(t: Roles) -> DataFrame:
    a = t.table("orders").select(F.col("o_custkey").alias("field"))
    b = t.table("customer").select((F.col("c_custkey") * 2).alias("field"))
    return checks.set_difference(a, b, "field")


# A spec played by parts: brand names the control, type the geography, size the field.
_SPEC = """spec AS (
  SELECT p_type AS geography,
         CASE WHEN p_size = 13 THEN '  ' WHEN p_size = 14 THEN NULL ELSE p_brand END
           AS control_field,
         concat('F', lpad(CAST(p_size AS VARCHAR), 3, '0')) AS field,
         CASE WHEN p_size % 2 = 0 THEN 'int' ELSE 'str' END AS type, p_partkey AS pos FROM part)"""


def _spec(t: Roles) -> DataFrame:
    size = F.col("p_size")
    return t.table("part").select(
        F.col("p_type").alias("geography"),
        F.when(size == 13, "  ").when(size != 14, F.col("p_brand")).alias("control_field"),
        F.concat(F.lit("F"), F.lpad(size.cast("string"), 3, "0")).alias("field"),
        F.when(size % 2 == 0, "int").otherwise("str").alias("type"),
        F.col("p_partkey").alias("pos"))


@query("spec_field_lists", f"""
WITH {_SPEC}, f AS (
  SELECT geography, control_field, field, min(pos) AS pos FROM spec
  WHERE trim(control_field) <> '' GROUP BY geography, control_field, field)
SELECT geography, control_field, string_agg(field, ',' ORDER BY pos) AS fields
FROM f GROUP BY geography, control_field""")
def spec_field_lists(t: Roles) -> DataFrame:
    return targets.field_lists(_spec(t)).withColumn("fields", F.array_join("fields", ","))


@query("spec_expression_fields", """
SELECT DISTINCT p_brand AS field FROM part
WHERE p_name NOT LIKE '%red%' AND p_brand <> 'Brand#1'""")
def spec_expression_fields(t: Roles) -> DataFrame:
    target = F.when(F.contains("p_name", F.lit("red")), F.concat(F.lit("#"), "p_name"))
    spec = t.table("part").select(
        target.otherwise(F.col("p_name")).alias("target"),
        F.concat(F.lit("(households."), "p_brand", F.lit(" <= 4) & (households.WGTP > 0)"))
        .alias("expression"))
    return targets.expression_fields(spec, ignore=["Brand#1"])


@query("spec_type_map", f"""
WITH {_SPEC}, f AS (
  SELECT geography, field, max_by(type, pos) AS type FROM spec
  WHERE trim(control_field) <> '' GROUP BY geography, field)
SELECT geography, string_agg(field || '=' || type, ',' ORDER BY field) AS types,
       count(*) AS n FROM f GROUP BY geography""")
def spec_type_map(t: Roles) -> DataFrame:
    maps = targets.type_maps(_spec(t))
    entries = F.transform(
        F.map_entries("types"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return maps.select("geography", F.array_join(F.array_sort(entries), ",").alias("types"),
                       F.size("types").cast("bigint").alias("n"))


def _thin_data(t: Roles, bg: Column) -> DataFrame:
    """Household counts by block group."""
    return t.acs_bg().select(
        bg.cast("bigint").alias("BG"), F.lit(1).alias("REGION"), F.col("B11005_001E").alias("n"))


@query("crosswalk_prune", f"""
SELECT BG, TRACT, PUMA FROM xwalk
WHERE BG IN (SELECT {COMPOSED_BG} FROM acs_bg WHERE coalesce("B11005_001E", 0) <> 0)""")
def crosswalk_prune(t: Roles) -> DataFrame:
    return spatial.prune_crosswalk(
        t.xwalk(), _thin_data(t, F.expr(COMPOSED_BG)), "BG").select("BG", "TRACT", "PUMA")


@query("data_without_crosswalk", f"""
SELECT {COMPOSED_BG} + 2 AS BG FROM acs_bg
WHERE coalesce("B11005_001E", 0) <> 0 AND {COMPOSED_BG} + 2 NOT IN (SELECT BG FROM xwalk)""")
def data_without_crosswalk(t: Roles) -> DataFrame:
    return spatial.data_without_crosswalk(
        t.xwalk().select("BG"), _thin_data(t, F.expr(COMPOSED_BG) + 2), "BG").select("BG")
