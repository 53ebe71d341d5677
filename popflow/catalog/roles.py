"""The domain tables played by the star schema.

Orders are households and line items their persons; customers are block groups. Thirty customers
and the three hundred orders of the same key range share a PUMA, so the number of zones grows
with the data. Every role is a projection of a whole table, stated once as SQL expressions that
both engines read alike.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popflow.functions.columns import sums
from popflow.sources.microdata import fill_sentinel
from popflow.specs import ESTIMATED_VARIABLES, MODE_COLS, PUMS_HH, PUMS_PER, REMAINDERS

FIELDS = sorted({f for fields in ESTIMATED_VARIABLES.values() for f in fields})


def _long(expression: str) -> str:
    return f"CAST(floor({expression}) AS BIGINT)"


def _zone(key: str) -> dict[str, str]:
    return {"PUMA": _long(f"{key} / 300"), "ST": f"1 + {_long(f'{key} / 300')} % 5"}


HOUSEHOLD = {
    "SERIALNO": "concat('H', o_orderkey)",
    **_zone("o_orderkey"),
    "WGTP": _long("o_totalprice / 1000"),
    "NP": "1 + o_orderkey % 7",
    "HINCP": _long("o_totalprice / 2"),
    "VEH": "o_custkey % 7",
    "HUPAC": "nullif(1 + o_orderkey % 5, 5)",
    "TEN": "nullif(1 + o_custkey % 5, 5)",
    "MRGP": "nullif(o_orderkey * 29 % 3500, 0)",
    "SMOCP": "nullif(o_orderkey * 37 % 4000, 0)",
    "RNTP": "nullif(o_orderkey * 41 % 2500, 0)",
    "GRNTP": "nullif(o_orderkey * 53 % 3000, 0)",
    "YR": "CAST(year(o_orderdate) AS BIGINT)",
}
PERSON = {
    "SERIALNO": "concat('H', l_orderkey)",
    "SPORDER": "CAST(l_linenumber AS BIGINT)",
    **_zone("l_orderkey"),
    "PWGTP": _long("l_extendedprice / 1000"),
    "JWTRNS": "nullif(l_partkey % 14, 13)",
    "ESR": "nullif(l_suppkey % 7, 0)",
    "SCH": "1 + l_partkey % 3",
    "SCHG": "nullif(l_partkey % 17, 0)",
    "AGEP": _long("l_quantity * 1.8"),
    "SEX": "1 + l_partkey % 2",
    "RAC1P": "1 + l_suppkey % 9",
    "HISP": "1 + l_partkey % 3",
    "WKHP": "nullif(CAST(l_quantity AS BIGINT), 50)",
    "YR": "CAST(year(l_shipdate) AS BIGINT)",
}


def _field_value(i: int, field: str) -> str:
    spread = f"(c_custkey * {2 * i + 3} + {_long('abs(c_acctbal)')}) % {40 + 7 * (i % 5)}"
    total = " + 600" if field == "B01001_001E" else ""
    return f"nullif({spread}, 0){total}"


BLOCK_GROUP = {
    "state": f"lpad(CAST(1 + {_long('c_custkey / 30')} % 5 AS STRING), 2, '0')",
    "county": f"lpad(CAST(1 + {_long('c_custkey / 30')} % 900 AS STRING), 3, '0')",
    "tract": f"lpad(CAST({_long('c_custkey / 3')} AS STRING), 6, '0')",
    "block_group": "CAST(1 + c_custkey % 3 AS STRING)",
    "puma": f"lpad(CAST({_long('c_custkey / 30')} AS STRING), 5, '0')",
    "NAME": "c_name",
    **{f: _field_value(i, f) for i, f in enumerate(FIELDS)},
}
BG_CONTROLS = {c: f for c, f in ESTIMATED_VARIABLES.items() if c not in MODE_COLS}
TRACT_CONTROLS = {c: f for c, f in ESTIMATED_VARIABLES.items() if c in MODE_COLS}
TRACT_FIELDS = sorted({f for fields in TRACT_CONTROLS.values() for f in fields})

_S = "CAST(state AS BIGINT)"
COMPOSED = {
    "STATE": _S,
    "COUNTY": f"{_S} * 1000 + CAST(county AS BIGINT)",
    "TRACT": f"({_S} * 1000 + CAST(county AS BIGINT)) * 1000000 + CAST(tract AS BIGINT)",
}
COMPOSED_BG = f"({COMPOSED['TRACT']}) * 10 + CAST(block_group AS BIGINT)"
COMPOSED_PUMA = f"{_S} * 100000 + CAST(puma AS BIGINT)"


def quoted(name: str) -> str:
    return f'"{name}"'


def _select(columns: dict[str, str], table: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {quoted(n)}" for n, e in columns.items()) + (
        f" FROM {table}")


def row_sum(fields: list[str], fill: int = 0) -> str:
    return " + ".join(f"coalesce({quoted(f)}, {fill})" for f in fields)


def _filled(raw: str, fields: dict[str, str]) -> str:
    cols = [c if c == "SERIALNO" else f"coalesce({c}, 995) AS {c}" for c in fields]
    return f"SELECT {', '.join(cols)}, YR FROM {raw}"


_PUMA = "ST * 100000 + PUMA % 100000"
_SEED_HH = [c for c in PUMS_HH if c not in ("PUMA", "ST")]
_SEED_PER = [c for c in PUMS_PER if c not in ("PUMA", "ST")]

# Role tables in SQL, in dependency order.
ROLE_SQL = {
    "hh_raw": _select(HOUSEHOLD, "orders"),
    "per_raw": _select(PERSON, "lineitem"),
    "hh": _filled("hh_raw", PUMS_HH),
    "per": _filled("per_raw", PUMS_PER),
    "adults": "SELECT SERIALNO, ST, PUMA, count(*) FILTER (WHERE AGEP >= 18) AS NP_ADULTS "
              "FROM per GROUP BY ALL",
    "seed_hh": f"""
        SELECT ({_PUMA}) * 100000000 + dense_rank() OVER (ORDER BY SERIALNO, {_PUMA}) AS hh_id,
               {', '.join('h.' + c for c in _SEED_HH)}, {_PUMA} AS PUMA, 1 AS REGION,
               ST AS STATE, CAST(NP_ADULTS AS BIGINT) AS NP_ADULTS
        FROM hh h JOIN adults USING (SERIALNO, ST, PUMA)""",
    "seed_per": f"""
        SELECT s.hh_id, {', '.join('p.' + c for c in _SEED_PER)}, s.PUMA, s.REGION, s.STATE
        FROM per p JOIN seed_hh s
          ON p.SERIALNO = s.SERIALNO AND p.ST = s.STATE
         AND p.ST * 100000 + p.PUMA % 100000 = s.PUMA""",
    "acs_bg": _select(BLOCK_GROUP, "customer"),
    "acs_tract": "SELECT state, county, tract, min(puma) AS puma, "
                 + ", ".join(f"CAST(sum({quoted(f)}) AS BIGINT) AS {quoted(f)}"
                             for f in TRACT_FIELDS)
                 + " FROM acs_bg GROUP BY state, county, tract",
    "bg_controls": f"SELECT {COMPOSED['COUNTY']} AS COUNTY, {COMPOSED_BG} AS BG, "
                   f"{COMPOSED['TRACT']} AS TRACT, {_S} AS STATE, NAME, "
                   + ", ".join(f"{row_sum(f)} AS {c}" for c, f in BG_CONTROLS.items())
                   + f", ({row_sum(['B01001_001E'])})"
                   f" - ({row_sum(ESTIMATED_VARIABLES['P_UNIVERSITY'])}) AS P_NON_UNIVERSITY"
                   f", ({row_sum(['B01001_001E'])}) - ({row_sum(ESTIMATED_VARIABLES['P_FULL_TIME'])})"
                   f" - ({row_sum(ESTIMATED_VARIABLES['P_PART_TIME'])}) AS P_NON_WORKER"
                   " FROM acs_bg",
    "tract_total": "SELECT TRACT, CAST(sum(P_TOTAL) AS BIGINT) AS P_TOTAL FROM bg_controls "
                   "GROUP BY TRACT",
    "tract_modes": f"SELECT {COMPOSED['COUNTY']} AS COUNTY, {COMPOSED['TRACT']} AS TRACT, "
                   f"{_S} AS STATE, "
                   + ", ".join(f"{row_sum(f)} AS {c}" for c, f in TRACT_CONTROLS.items())
                   + " FROM acs_tract",
    "tract_controls": "SELECT m.*, t.P_TOTAL - ("
                      + " + ".join(f"m.{c}" for c in TRACT_CONTROLS)
                      + ") AS P_MODE_NA FROM tract_modes m JOIN tract_total t USING (TRACT)",
    "state_controls": "SELECT * FROM (SELECT STATE, "
                      + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in BG_CONTROLS)
                      + " FROM bg_controls GROUP BY STATE) JOIN (SELECT STATE, "
                      + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in TRACT_CONTROLS)
                      + " FROM tract_modes GROUP BY STATE) USING (STATE)",
    "xwalk": f"SELECT {COMPOSED_BG} AS BG, {COMPOSED['TRACT']} AS TRACT, "
             f"{COMPOSED['COUNTY']} AS COUNTY, {_S} AS STATE, {COMPOSED_PUMA} AS PUMA, "
             "1 AS REGION FROM acs_bg",
    "acs1": "SELECT CAST(state AS BIGINT) AS STATE, "
            + ", ".join(f"nullif(CAST(sum({quoted(f)}) AS BIGINT) % 9973, 0) AS {quoted(f)}"
                        for f in FIELDS)
            + " FROM acs_bg GROUP BY 1",
    "acs1_targets": "SELECT STATE, "
                    + ", ".join(f"{row_sum(f, 1)} AS {c}" for c, f in ESTIMATED_VARIABLES.items())
                    + " FROM acs1",
}


def with_roles(sql: str) -> str:
    """Prefix ``sql`` with the role tables it names, directly or through other roles."""
    wanted: set[str] = set()
    pending = [sql]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for name in words & set(ROLE_SQL) - wanted:
            wanted.add(name)
            pending.append(ROLE_SQL[name])
    ctes = [f"{name} AS ({ROLE_SQL[name]})" for name in ROLE_SQL if name in wanted]
    body = sql.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ", ".join(ctes) + ", " + body[5:]
    return "WITH " + ", ".join(ctes) + " " + body


class Roles:
    """The role tables as DataFrames over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _projected(self, columns: dict[str, str], table: str) -> DataFrame:
        return self.table(table).selectExpr(*[f"{e} AS `{n}`" for n, e in columns.items()])

    def hh_raw(self) -> DataFrame:
        return self._projected(HOUSEHOLD, "orders")

    def per_raw(self) -> DataFrame:
        return self._projected(PERSON, "lineitem")

    def hh(self) -> DataFrame:
        return fill_sentinel(self.hh_raw(), PUMS_HH)

    def per(self) -> DataFrame:
        return fill_sentinel(self.per_raw(), PUMS_PER)

    def acs_bg(self) -> DataFrame:
        return self._projected(BLOCK_GROUP, "customer")

    def acs_bg_raw(self, controls: dict[str, list[str]] = BG_CONTROLS) -> DataFrame:
        """Block-group table with raw names and the fields of ``controls``."""
        fields = sorted({f for fs in controls.values() for f in fs})
        return self.acs_bg().select("state", "county", "tract", "block_group", "puma", "NAME",
                                    *fields)

    def acs_tract(self) -> DataFrame:
        return self.acs_bg().groupBy("state", "county", "tract").agg(
            F.min("puma").alias("puma"), *sums(TRACT_FIELDS))

    def xwalk(self) -> DataFrame:
        from popflow.functions.geoid import compose_geoids
        parts = self.acs_bg().select(
            F.col("state").alias("STATE"), F.col("county").alias("COUNTY"),
            F.col("tract").alias("TRACT"), F.col("block_group").alias("BG"),
            F.col("puma").alias("PUMA"))
        return compose_geoids(parts).select(
            "BG", "TRACT", "COUNTY", "STATE", "PUMA", F.lit(1).alias("REGION"))

    def acs1(self) -> DataFrame:
        """One row per state with every published one-year variable."""
        return self.acs_bg().groupBy(F.col("state").cast("bigint").alias("STATE")).agg(
            *[F.expr(f"nullif(sum({f}) % 9973, 0) AS {f}") for f in FIELDS])

    def prepared(self, *wanted: str) -> dict[str, DataFrame]:
        """Control totals made by the preparation job; all of them unless some are named."""
        from popflow.plans.prepare import prepare_targets
        bg = self.acs_bg_raw(BG_CONTROLS).drop("puma").withColumnRenamed(
            "block_group", "block group")
        acs, agg = {"BG": bg}, {"BG": BG_CONTROLS}
        if set(wanted) != {"BG"}:
            acs["TRACT"], agg["TRACT"] = self.acs_tract().drop("puma"), TRACT_CONTROLS
        return prepare_targets(acs, agg, remainders={
            name: spec for name, spec in REMAINDERS.items() if spec.geography in acs})
