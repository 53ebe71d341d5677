"""Seed tables: households and persons of the selected states under one household key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popflow.functions.geoid import compose_geoids
from popflow.operators.ordering import rank_rows
from popflow.specs import HH_ID_SHIFT, REGION

JOIN_KEYS = ["SERIALNO", "ST", "PUMA"]


@dataclass(frozen=True)
class Seeds:
    households: DataFrame
    persons: DataFrame


def select_states(df: DataFrame, states: Sequence[int | str] | None, col: str = "ST") -> DataFrame:
    """Rows of the wanted states; prunes partitions when ``col`` is a partition column."""
    return df if states is None else df.filter(F.col(col).isin(list(states)))


def first_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with a non-null value of every other column.

    The columns are constant within a key, so the smallest value stands for the first and makes
    the result repeatable.
    """
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(*[F.min(c).alias(c) for c in rest]).select(*df.columns)


def num_adults(persons: DataFrame, keys: Sequence[str], out: str = "NP_ADULTS") -> DataFrame:
    """Number of persons aged 18 or more per key, zero included."""
    return persons.groupBy(*keys).agg(F.count_if(F.col("AGEP") >= 18).alias(out))


def with_num_adults(households: DataFrame, persons: DataFrame, key: str = "hh_id") -> DataFrame:
    """Attach the number of adults; households without any get zero."""
    counted = households.join(num_adults(persons, [key]), key, "left")
    return counted.withColumn("NP_ADULTS", F.coalesce("NP_ADULTS", F.lit(0).cast("bigint")))


def build_seeds(
    hh: DataFrame, per: DataFrame, states: Sequence[int] | None = None, region: int = REGION
) -> Seeds:
    """Households that have persons, and their persons, keyed by ``hh_id``.

    ``hh_id`` is the composed PUMA followed by the dense rank of (SERIALNO, PUMA). Persons are
    reduced to one row per household before they meet the household table; that single join
    drops households without persons and brings the number of adults along.
    """
    hh = select_states(hh, states)
    per = select_states(per, states)
    adults = num_adults(per, JOIN_KEYS)
    kept = first_by_key(hh, JOIN_KEYS).join(adults, JOIN_KEYS)

    keyed = compose_geoids(kept.withColumn("STATE", F.col("ST")))
    ranked = rank_rows(
        keyed.withColumn("REGION", F.lit(region)), ["SERIALNO", "PUMA"], out="__n")
    ranked = ranked.withColumn(
        "hh_id", F.col("PUMA") * F.lit(HH_ID_SHIFT) + F.col("__n")).drop("__n")
    household_cols = [c for c in hh.columns if c != "ST"]
    households = ranked.select("hh_id", *household_cols, "REGION", "STATE", "NP_ADULTS")

    formatted = compose_geoids(per.withColumn("STATE", F.col("ST")))
    link = ranked.select("SERIALNO", "STATE", "PUMA", "hh_id", "REGION")
    person_cols = [c for c in per.columns if c != "ST"]
    persons = (
        formatted.join(link, ["SERIALNO", "STATE", "PUMA"])
        .select("hh_id", *person_cols, "REGION", "STATE")
    )
    return Seeds(households, persons)
