"""Control totals: aggregation of published fields, roll-ups and remainder controls."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popflow.functions.columns import null_skipping_sum, quoted, sums
from popflow.functions.geoid import compose_geoids
from popflow.functions.text import first_field
from popflow.specs import FIXED_RENAMES, GEOID_STRUCTURE, REGION, REMAINDERS, Remainder


def non_blank(spec: DataFrame, col: str = "control_field") -> DataFrame:
    """Spec rows whose ``col`` holds more than blanks."""
    return spec.filter(F.trim(col) != "")


def without_comments(spec: DataFrame, col: str = "target") -> DataFrame:
    """Spec rows whose ``col`` does not start with ``#``."""
    return spec.filter(~F.startswith(col, F.lit("#")))


def expression_fields(
    spec: DataFrame, expression: str = "expression", ignore: Sequence[str] = ("SERIALNO",)
) -> DataFrame:
    """The seed fields that the expressions of a spec name first, comments left out."""
    fields = without_comments(spec).select(first_field(expression).alias("field")).distinct()
    return fields.filter(F.col("field").isNotNull() & ~F.col("field").isin(list(ignore)))


def field_lists(spec: DataFrame, order: str = "pos") -> DataFrame:
    """Source fields of each (geography, control), in spec order.

    Repeated fields are merged first, so a list is no longer than the set of fields.
    """
    fields = (
        non_blank(spec).groupBy("geography", "control_field", "field")
        .agg(F.min(order).alias("__pos"))
    )
    in_order = F.array_sort(F.collect_list(F.struct("__pos", "field")))
    return fields.groupBy("geography", "control_field").agg(
        F.transform(in_order, lambda e: e["field"]).alias("fields"))


def type_maps(spec: DataFrame, order: str = "pos") -> DataFrame:
    """Map from field to declared type per geography; the last declaration of a field wins."""
    fields = (
        non_blank(spec).groupBy("geography", "field")
        .agg(F.max_by("type", order).alias("type"))
    )
    entries = F.array_sort(F.collect_list(F.struct("field", "type")))
    return fields.groupBy("geography").agg(F.map_from_entries(entries).alias("types"))


def aggregate_controls(zones: DataFrame, agg: Mapping[str, Sequence[str]]) -> DataFrame:
    """Each control is the null-skipping row sum of its fields; consumed fields are dropped.

    A field may feed several controls.
    """
    consumed = {f for fields in agg.values() for f in fields} - set(agg)
    kept = [quoted(c) for c in zones.columns if c not in consumed and c not in agg]
    totals = [f"{null_skipping_sum(fields)} AS {quoted(c)}" for c, fields in agg.items()]
    return zones.selectExpr(*kept, *totals)


def rollup_totals(
    zones: DataFrame, controls: Sequence[str], state: str = "state"
) -> DataFrame:
    """State totals and, in the row where ``state`` is null, the regional total."""
    return zones.rollup(state).agg(*sums(controls))


def state_and_region_totals(
    tables: Mapping[str, tuple[DataFrame, Sequence[str]]], state: str = "state"
) -> tuple[DataFrame, DataFrame]:
    """Totals of all controls by state and over the region, from tables of several geographies."""
    by_state = [
        df.groupBy(state).agg(*sums(controls))
        for df, controls in tables.values() if controls
    ]
    states = reduce(lambda a, b: a.join(b, state, "full_outer"), by_state)
    controls = [c for c in states.columns if c != state]
    region = states.agg(*sums(controls)).select(
        F.lit(REGION).alias("REGION"), *controls)
    return states.withColumnRenamed(state, "STATE"), region


def _located(tables: Mapping[str, DataFrame], cols: Sequence[str]) -> str:
    holding = [geo for geo, df in tables.items() if set(cols) <= set(df.columns)]
    if not holding:
        raise ValueError(f"no geography holds all of {list(cols)}")
    return holding[-1]


def remainder_control(
    tables: Mapping[str, DataFrame],
    name: str,
    spec: Remainder | None = None,
    keys: Sequence[str] | None = None,
    structure: Mapping[str, Sequence[str]] = GEOID_STRUCTURE,
) -> DataFrame:
    """The table of the target geography with the remainder ``sum(add) - sum(subtract)``.

    Both sides are taken from the last geography that holds all their columns and summed to the
    target geography. A zone found on one side only has a null remainder.
    """
    spec = spec or REMAINDERS[name]
    add_geo, sub_geo = _located(tables, spec.add), _located(tables, spec.subtract)
    if spec.geography not in structure[add_geo] or spec.geography not in structure[sub_geo]:
        raise ValueError(f"{add_geo} or {sub_geo} does not nest in {spec.geography}")
    target = tables[spec.geography]
    if keys is None:
        parts = {p.lower() for p in structure[spec.geography]} | {"block group"}
        keys = [c for c in target.columns if c.lower() in parts]
    keys = list(keys)

    if add_geo == sub_geo == spec.geography:
        # Zones are unique rows of their table, so nothing has to be summed or joined.
        return target.selectExpr(
            "*", f"{null_skipping_sum(spec.add)} - ({null_skipping_sum(spec.subtract)}) "
                 f"AS {quoted(name)}")
    added = tables[add_geo].groupBy(*keys).agg(
        F.expr(f"sum({null_skipping_sum(spec.add)}) AS __add"))
    taken = tables[sub_geo].groupBy(*keys).agg(
        F.expr(f"sum({null_skipping_sum(spec.subtract)}) AS __sub"))
    sides = added.join(taken, keys, "full_outer")
    remainder = sides.select(*keys, (F.col("__add") - F.col("__sub")).alias(name))
    return target.join(remainder, keys).select(*target.columns, name)


def negative_remainders(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """Zones whose remainder is not positive."""
    return df.filter(F.col(name) <= 0).select(*keys, name)


def format_targets(df: DataFrame, region: int = REGION) -> DataFrame:
    """Upper-case names, standard geography names, composed identifiers and the region."""
    renamed = {}
    for c in df.columns:
        renamed[c] = FIXED_RENAMES.get(c.upper(), c.upper())
    return compose_geoids(df.withColumnsRenamed(renamed)).withColumn("REGION", F.lit(region))


IDENTIFIERS = ("BG", "TRACT", "COUNTY", "PUMA", "STATE", "ST", "REGION", "BLKGRP")


def drop_empty_zones(df: DataFrame, ignore: Sequence[str] = IDENTIFIERS) -> DataFrame:
    """Remove zones whose numeric columns sum to zero; identifiers are not counted."""
    numeric = [
        f.name for f in df.schema.fields
        if f.dataType.typeName() in ("integer", "long", "double", "float", "short")
        and f.name not in ignore
    ]
    return df.filter(f"{null_skipping_sum(numeric)} <> 0")
