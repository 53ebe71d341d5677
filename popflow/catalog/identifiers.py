"""Queries on geographic identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popflow.catalog.registry import query
from popflow.catalog.roles import Roles
from popflow.functions.geoid import compose_geoids, pad_concat, zfill
from popflow.sources.listing import state_abbr, state_lookup
from popflow.specs import STATES


@query("geoid_compose", "SELECT BG, TRACT, COUNTY, STATE, PUMA FROM xwalk")
def geoid_compose(t: Roles) -> DataFrame:
    return t.xwalk().drop("REGION")


@query("geoid_idempotent", """
SELECT count(*) AS n, count(*) AS n_same FROM xwalk""")
def geoid_idempotent(t: Roles) -> DataFrame:
    ids = ["BG", "TRACT", "COUNTY", "STATE", "PUMA"]
    once = t.xwalk().select(*ids)
    before = once.select(*ids, F.xxhash64(*ids).alias("h"))
    twice = compose_geoids(before)
    return twice.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.xxhash64(*ids) == F.col("h")).alias("n_same"))


@query("geoid_pad_concat", """
SELECT SERIALNO, lpad(CAST(ST AS VARCHAR), 2, '0') AS ST,
       lpad(CAST(ST AS VARCHAR), 2, '0') || lpad(CAST(PUMA AS VARCHAR), 5, '0') AS PUMA
FROM hh_raw""")
def geoid_pad_concat(t: Roles) -> DataFrame:
    raw = t.hh_raw()
    return raw.select(
        "SERIALNO", zfill("ST", 2).alias("ST"), pad_concat({"ST": 2, "PUMA": 5}).alias("PUMA"))


_LOOKUP = ", ".join(f"('{f}', '{a}', '{n}')" for f, a, n in STATES)


@query("state_lookup", f"""
WITH s(fips, abbr, name) AS (VALUES {_LOOKUP}),
k AS (SELECT c_custkey, lpad(CAST(c_custkey % 60 AS VARCHAR), 2, '0') AS fips FROM customer)
SELECT c_custkey, k.fips, coalesce(abbr, 'Unknown') AS abbr, name
FROM k LEFT JOIN s ON s.fips = k.fips""")
def state_names(t: Roles) -> DataFrame:
    coded = t.table("customer").select(
        "c_custkey", zfill(F.col("c_custkey") % 60, 2).alias("fips"))
    names = F.broadcast(state_lookup(t.spark).select("fips", "name"))  # at most 51 rows
    return coded.withColumn("abbr", state_abbr("fips")).join(names, "fips", "left").select(
        "c_custkey", "fips", "abbr", "name")
