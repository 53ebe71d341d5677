"""Queries on validation. A customer plays one zone of a summary table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popflow.catalog.registry import query
from popflow.catalog.roles import Roles
from popflow.operators import fit
from popflow.specs import CONTROLS

PAIRS = [(c.target, c.control_field) for c in CONTROLS]


def _summary_columns() -> dict[str, str]:
    cols = {"id": "c_custkey"}
    for i, (target, _) in enumerate(PAIRS):
        base = f"CAST(floor(abs(c_acctbal)) AS BIGINT)"
        cols[f"{target}_control"] = f"(c_custkey * {i + 3} + {base}) % {50 + i}"
        cols[f"{target}_result"] = f"nullif((c_custkey * {i + 4} + {base}) % {50 + i}, 7)"
    return cols


_COLUMNS = _summary_columns()
_SUMMARY = "summary AS (SELECT {id} AS id, c_nationkey, " + ", ".join(
    f"{e} AS {n}" for n, e in _COLUMNS.items() if n != "id") + " FROM customer)"
_ENTRIES = ", ".join(
    f"{{'control_name': '{name}', 'c': CAST(coalesce({t}_control, 0) AS DOUBLE), "
    f"'s': CAST(coalesce({t}_result, 0) AS DOUBLE)}}" for t, name in PAIRS)
_EDGES = ("edges AS (SELECT quantile_cont(CAST(h_total_control AS DOUBLE), [0.25, 0.5, 0.75]) "
          "AS e FROM summary), "
          "cut AS (SELECT *, CASE WHEN h_total_control <= e[1] THEN 'Q1' "
          "WHEN h_total_control <= e[2] THEN 'Q2' WHEN h_total_control <= e[3] THEN 'Q3' "
          "ELSE 'Q4' END AS geo_quantiles FROM summary, edges)")


def _long_sql(source: str = "cut", key: str = "c_custkey") -> str:
    return (f"WITH {_SUMMARY.format(id=key)}, {_EDGES}, "
            f"long AS (SELECT id, geo_quantiles, e2.control_name AS control_name, e2.c AS c, "
            f"e2.s AS s FROM (SELECT id, geo_quantiles, unnest([{_ENTRIES}]) AS e2 "
            f"FROM {source}))")


_STATS = """
  sum(c) AS observed, sum(s) AS predicted, sum(s) - sum(c) AS difference,
  round((sum(s) - sum(c)) / nullif(sum(c), 0) * 100, 6) AS pct_difference,
  count(*) FILTER (WHERE c > 0) AS N,
  CASE WHEN count(*) > 1 THEN round(sqrt(sum((c - s) * (c - s))
       / nullif(count(*) FILTER (WHERE c > 0) - 1, 0)) / nullif(sum(c), 0)
       * count(*) FILTER (WHERE s > 0) * 100, 4) ELSE 0 END AS prmse,
  round(avg(CASE WHEN c > 0 THEN (s - c) / c * 100 END), 6) AS mean_pct_diff,
  round(stddev_samp(CASE WHEN c > 0 THEN (s - c) / c * 100 END), 6) AS sdev"""


def _summary(t: Roles, *keep: str) -> DataFrame:
    return t.table("customer").selectExpr(*[f"{e} AS {n}" for n, e in _COLUMNS.items()], *keep)


def _rounded(stats: DataFrame) -> DataFrame:
    return stats.withColumns({
        "pct_difference": F.round("pct_difference", 6), "prmse": F.round("prmse", 4),
        "mean_pct_diff": F.round("mean_pct_diff", 6), "sdev": F.round("sdev", 6)})


@query("fit_stats", f"{_long_sql()} SELECT control_name, {_STATS} FROM long GROUP BY control_name")
def fit_stats(t: Roles) -> DataFrame:
    return _rounded(fit.fit_stats(fit.summary_long(_summary(t), PAIRS)))


@query("fit_stats_by_quartile", f"{_long_sql()} SELECT control_name, geo_quantiles, {_STATS} "
       "FROM long GROUP BY control_name, geo_quantiles")
def fit_stats_by_quartile(t: Roles) -> DataFrame:
    labelled = fit.qcut_labels(_summary(t), "h_total_control")
    long = fit.summary_long(labelled, PAIRS, ["geo_quantiles"])
    return _rounded(fit.fit_stats(long, ["control_name", "geo_quantiles"]))


@query("fit_stats_merged_ids", f"""{_long_sql(key='c_nationkey')},
merged AS (SELECT id, control_name, sum(c) AS c, sum(s) AS s FROM long GROUP BY id, control_name)
SELECT control_name, {_STATS} FROM merged GROUP BY control_name""")
def fit_stats_merged_ids(t: Roles) -> DataFrame:
    zones = _summary(t, "c_nationkey").drop("id").withColumnRenamed("c_nationkey", "id")
    return _rounded(fit.fit_stats(fit.merge_ids(fit.summary_long(zones, PAIRS))))


@query("qcut_labels", f"""{_long_sql()}
SELECT id, h_total_control, geo_quantiles FROM cut""")
def qcut_labels(t: Roles) -> DataFrame:
    return fit.qcut_labels(_summary(t).select("id", "h_total_control"), "h_total_control")


@query("qcut_labels_by_zone", """
WITH z AS (SELECT c_custkey AS id, c_mktsegment, c_acctbal, quantile_cont(c_acctbal,
  [0.25, 0.5, 0.75]) OVER (PARTITION BY c_mktsegment) AS e FROM customer)
SELECT id, c_mktsegment, c_acctbal, CASE WHEN c_acctbal <= e[1] THEN 'Q1'
  WHEN c_acctbal <= e[2] THEN 'Q2' WHEN c_acctbal <= e[3] THEN 'Q3' ELSE 'Q4' END AS geo_quantiles
FROM z""")
def qcut_labels_by_zone(t: Roles) -> DataFrame:
    zones = t.table("customer").select(
        F.col("c_custkey").alias("id"), "c_mktsegment", "c_acctbal")
    return fit.qcut_labels(zones, "c_acctbal", ["c_mktsegment"])


@query("quantile_ties", """
WITH e AS (SELECT quantile_cont(CAST(l_linenumber AS DOUBLE), [0, 0.25, 0.5, 0.75, 1]) AS q
           FROM lineitem)
SELECT q[1] AS q0, q[2] AS q1, q[3] AS q2, q[4] AS q3, q[5] AS q4,
       q[1] = q[2] OR q[2] = q[3] OR q[3] = q[4] OR q[4] = q[5] AS tied FROM e""")
def quantile_ties(t: Roles) -> DataFrame:
    edges = fit.tied_edges(t.table("lineitem").select("l_linenumber"), "l_linenumber")
    return edges.select(*[F.col("edges")[i].alias(f"q{i}") for i in range(5)], "tied")


_EF = """
WITH used AS (SELECT l_orderkey, count(*) AS z FROM lineitem GROUP BY l_orderkey),
ef AS (SELECT o_orderkey AS hh_id, CAST(floor(o_orderkey / 300) AS BIGINT) AS PUMA,
              1 + CAST(floor(o_orderkey / 300) AS BIGINT) % 5 AS STATE,
              CAST(floor(o_totalprice / 1000) AS BIGINT) AS w, coalesce(z, 0) AS z,
              coalesce(z, 0) / nullif(CAST(floor(o_totalprice / 1000) AS DOUBLE), 0) AS ef
       FROM orders LEFT JOIN used ON l_orderkey = o_orderkey),
g AS (SELECT {geo}, CAST(sum(w) AS DOUBLE) / sum(z) AS ex FROM ef GROUP BY {geo})"""
_UNIFORMITY = _EF + """
SELECT {geo}, CAST(sum(w) AS BIGINT) AS W, CAST(sum(z) AS BIGINT) AS Z, count(*) AS N,
       round(any_value(ex), 6) AS EXP, round(min(ef), 6) AS EXP_MIN, round(max(ef), 6) AS EXP_MAX,
       round(sqrt(avg((ef - ex) * (ef - ex))), 6) AS NRMSE,
       round(CAST(sum(z) AS DOUBLE) / sum(w), 6) AS EXP_SYNTH
FROM ef JOIN g USING ({geo}) GROUP BY {geo}"""


def _factors(t: Roles) -> DataFrame:
    seeds = t.hh_raw().select(
        F.substring("SERIALNO", 2, 20).cast("bigint").alias("hh_id"), "PUMA",
        F.col("ST").alias("STATE"), "WGTP")
    expanded = t.table("lineitem").select(F.col("l_orderkey").alias("hh_id"))
    return fit.expansion_factors(seeds, expanded)


def _uniformity(t: Roles, geo: str) -> DataFrame:
    rounded = ["EXP", "EXP_MIN", "EXP_MAX", "NRMSE", "EXP_SYNTH"]
    return fit.uniformity(_factors(t), geo).withColumns({c: F.round(c, 6) for c in rounded})


@query("uniformity", _UNIFORMITY.format(geo="PUMA"))
def uniformity(t: Roles) -> DataFrame:
    return _uniformity(t, "PUMA")


@query("uniformity_state", _UNIFORMITY.format(geo="STATE"))
def uniformity_state(t: Roles) -> DataFrame:
    return _uniformity(t, "STATE")


@query("ef_histogram", _EF.format(geo="PUMA") + """
SELECT PUMA, floor(ef / 0.5) * 0.5 AS bin_start, count(*) AS n FROM ef
WHERE ef IS NOT NULL GROUP BY ALL""")
def ef_histogram(t: Roles) -> DataFrame:
    return fit.histogram(_factors(t), "EXPANSIONFACTOR", 0.5, ["PUMA"])


@query("size_histogram", """
SELECT CAST(floor(o_totalprice / 100.0) * 100.0 AS DOUBLE) AS bin_start, count(*) AS n
FROM orders GROUP BY ALL""")
def size_histogram(t: Roles) -> DataFrame:
    return fit.histogram(t.table("orders"), "o_totalprice", 100.0)


@query("diff_frequency", f"""{_long_sql()}
SELECT control_name, s - c AS "DIFFERENCE", count(*) AS "FREQUENCY" FROM long
WHERE c > 0 GROUP BY ALL""")
def diff_frequency(t: Roles) -> DataFrame:
    return fit.frequency(fit.summary_long(_summary(t), PAIRS))


@query("rmse_metrics", """
WITH p AS (SELECT l_returnflag, l_extendedprice AS a,
  CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity * 1000 END AS e FROM lineitem)
SELECT l_returnflag, round(sqrt(avg((a - e) * (a - e))), 4) AS rmse,
       round(sqrt(avg((a - e) * (a - e))) / avg(e), 8) AS nrmse FROM p GROUP BY l_returnflag""")
def rmse_metrics(t: Roles) -> DataFrame:
    expected = F.when(F.col("l_linenumber") != 3, F.col("l_quantity") * 1000)
    pairs = t.table("lineitem").select("l_returnflag", "l_extendedprice", expected.alias("e"))
    return pairs.groupBy("l_returnflag").agg(
        F.round(fit.rmse("l_extendedprice", "e"), 4).alias("rmse"),
        F.round(fit.nrmse("l_extendedprice", "e"), 8).alias("nrmse"))
