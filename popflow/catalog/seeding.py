"""Queries on seed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popflow.catalog.registry import query
from popflow.catalog.roles import Roles
from popflow.operators import ordering, seeds
from popflow.specs import PUMS_HH, PUMS_PER

_KEYS = seeds.JOIN_KEYS


@query("seed_join_inner", """
SELECT SERIALNO, ST, PUMA, SPORDER, AGEP, PWGTP, WGTP, NP
FROM hh JOIN per USING (SERIALNO, ST, PUMA)""")
def seed_join_inner(t: Roles) -> DataFrame:
    hh = t.hh().select(*_KEYS, "WGTP", "NP")
    per = t.per().select(*_KEYS, "SPORDER", "AGEP", "PWGTP")
    return hh.join(per, _KEYS).select(
        *_KEYS, "SPORDER", "AGEP", "PWGTP", "WGTP", "NP")


@query("seed_hh_id", "SELECT hh_id, SERIALNO, PUMA, STATE FROM seed_hh")
def seed_hh_id(t: Roles) -> DataFrame:
    seed = seeds.build_seeds(t.hh(), t.per())
    return seed.households.select("hh_id", "SERIALNO", "PUMA", "STATE")


@query("seed_households", "SELECT hh_id, SERIALNO, PUMA, " + ", ".join(
    c for c in PUMS_HH if c not in ("SERIALNO", "PUMA", "ST"))
    + ", REGION, STATE, NP_ADULTS FROM seed_hh")
def seed_households(t: Roles) -> DataFrame:
    return seeds.build_seeds(t.hh(), t.per()).households


@query("seed_persons", "SELECT hh_id, SERIALNO, SPORDER, PUMA, " + ", ".join(
    c for c in PUMS_PER if c not in ("SERIALNO", "SPORDER", "PUMA", "ST"))
    + ", REGION, STATE FROM seed_per")
def seed_persons(t: Roles) -> DataFrame:
    return seeds.build_seeds(t.hh(), t.per()).persons


@query("seed_first_household", """
SELECT SERIALNO, ST, PUMA, any_value(NP) AS NP, any_value(HINCP) AS HINCP,
       any_value(TEN) AS TEN
FROM hh_raw JOIN per_raw USING (SERIALNO, ST, PUMA) GROUP BY ALL""")
def seed_first_household(t: Roles) -> DataFrame:
    per = t.per_raw().select(*_KEYS)
    joined = t.hh_raw().select(*_KEYS, "NP", "HINCP", "TEN").join(per, _KEYS)
    return seeds.first_by_key(joined, _KEYS)


@query("seed_num_adults", """
SELECT SERIALNO, NP, (SELECT count(*) FROM per p
                      WHERE p.SERIALNO = h.SERIALNO AND p.AGEP >= 18) AS NP_ADULTS
FROM hh h""")
def seed_num_adults(t: Roles) -> DataFrame:
    return seeds.with_num_adults(
        t.hh().select("SERIALNO", "NP"), t.per().select("SERIALNO", "AGEP"), "SERIALNO")


@query("seed_state_selection", "SELECT ST, count(*) AS n FROM hh WHERE ST IN (2, 4) GROUP BY ST")
def seed_state_selection(t: Roles) -> DataFrame:
    return seeds.select_states(t.hh(), [2, 4]).groupBy("ST").agg(F.count(F.lit(1)).alias("n"))


@query("dense_key", """
SELECT o_orderkey, o_custkey, dense_rank() OVER (ORDER BY o_custkey, o_orderpriority) AS key
FROM orders""")
def dense_key(t: Roles) -> DataFrame:
    orders = t.table("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return ordering.dense_key(orders, ["o_custkey", "o_orderpriority"]).select(
        "o_orderkey", "o_custkey", "key")


@query("batch_ids", """
SELECT s_suppkey, s_name, CAST(floor((row_number() OVER (ORDER BY s_name) - 1) / 5) AS BIGINT)
       AS batch
FROM supplier""")
def batch_ids(t: Roles) -> DataFrame:
    return ordering.batch_ids(t.table("supplier").select("s_suppkey", "s_name"), 5, ["s_name"])
