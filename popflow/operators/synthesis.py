"""Synthesis: incidence, raking, integerizing and expansion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from popflow.functions.columns import quoted, ratio_sql, replaced, sums
from popflow.operators.ordering import rank_rows, running_total
from popflow.operators.rounds import (
    doubles, incidence_array, packed, rounds, unbounded, unpacked,
)
from popflow.session import cut
from popflow.specs import (
    CONTROLS, MAX_EXPANSION, SYNTHETIC_HOUSEHOLD_COLS, SYNTHETIC_PERSON_COLS, Control,
)


# --------------------------------------------------------------------------
# Incidence
# --------------------------------------------------------------------------
def incidence(
    hh: DataFrame, per: DataFrame, controls: Sequence[Control] = CONTROLS,
    keep: Sequence[str] = ("PUMA", "WGTP"), key: str = "hh_id",
) -> DataFrame:
    """How much each household adds to each control: 0/1 for household targets, persons else.

    Persons are counted per household before the join. Households without weight are left out.
    """
    mine = [c for c in controls if c.seed_table == "households"]
    theirs = [c for c in controls if c.seed_table == "persons"]
    flags = [f"CAST({c.expression} AS BIGINT) AS {c.target}" for c in mine]
    households = hh.filter(F.col("WGTP") > 0).selectExpr(key, *keep, *flags)
    if theirs:
        counts = per.groupBy(key).agg(
            *[F.expr(f"count_if({c.expression}) AS {c.target}") for c in theirs])
        households = households.join(unbounded(counts), key, "left")
    return households.selectExpr(
        key, *keep, *[f"coalesce({c.target}, 0L) AS {c.target}" for c in controls])


def signatures(
    inc: DataFrame, targets: Sequence[str], by: str = "PUMA", weight: str = "WGTP",
    key: str = "hh_id",
) -> DataFrame:
    """Households with equal incidence inside a zone, as one row with their total weight.

    ``signature`` is a hash for reference; grouping compares the incidence itself.
    """
    x = F.expr(f"array({', '.join(f'CAST({t} AS BIGINT)' for t in targets)})")
    return (
        inc.groupBy(by, x.alias("x"))
        .agg(F.count(F.lit(1)).alias("n_households"), F.sum(weight).alias("weight"),
             F.min(key).alias("first_hh_id"))
        .withColumn("signature", F.xxhash64("x"))
    )


def controls_to_zone(
    controls: DataFrame, xwalk: DataFrame, child: str, zone: str, cols: Sequence[str]
) -> DataFrame:
    """Child controls summed to the zone the crosswalk assigns them to."""
    link = xwalk.select(child, zone).distinct()
    return controls.join(link, child).groupBy(zone).agg(*sums(cols))


# --------------------------------------------------------------------------
# Raking
# --------------------------------------------------------------------------
def _moments(cap: float):
    """Sums of w, w*x and w*x*x' of a block at the multipliers of its zone."""
    def sums(block: tuple[np.ndarray, np.ndarray], now: dict) -> list[np.ndarray]:
        x, w0 = block
        factor = np.exp(np.minimum(x @ doubles(now["lam"]), 700.0))
        w = w0 * np.minimum(factor, cap)
        return [w.sum(keepdims=True), x.T @ w, (x * (w * (factor < cap))[:, None]).T @ x]
    return sums


def _newton_step(tol: float):
    """One damped Newton step of a zone on the penalised dual."""
    def step(now: dict, totals: Sequence[np.ndarray], held: dict | None = None) -> dict:
        total, made, spread = totals
        lam, goal, ridge = (doubles(now[c]) for c in ("lam", "goal", "ridge"))
        k = len(lam)
        spread = spread.reshape(k, k)
        gap = goal - made - ridge * lam
        err = float(np.max(np.abs(gap) / np.maximum(goal, 1.0)))
        norm = float(np.sum(gap * gap / np.maximum(goal, 1.0)))
        if norm <= now["best_norm"]:
            # Met, or no longer gaining.
            done = err < tol or norm > 0.999 * now["best_norm"]
            h = spread + np.diag(ridge)
            # Rows and columns are scaled alike, so totals and small cells weigh the same.
            s = 1.0 / np.sqrt(np.maximum(np.diag(h), 1e-12))
            delta = s * np.linalg.lstsq(h * s[:, None] * s, gap * s, rcond=1e-14)[0]
            # No step changes the logarithms of the weights by more than 2 on average.
            change = np.sqrt(max(float(delta @ spread @ delta), 0.0) / max(total[0], 1e-12))
            delta = delta * min(1.0, 2.0 / change) if change > 0 else delta
            best, size, found = lam, 1.0, {"best_norm": norm, "best_err": err}
        else:
            done = now["step"] < 1e-6  # the line has no better point
            best, delta, size, found = doubles(now["best"]), doubles(now["delta"]), now["step"] / 2, {}
        return {"lam": (best + size * delta).tobytes(), "best": best.tobytes(),
                "delta": delta.tobytes(), "step": size, "rounds": now["rounds"] + 1, "done": done,
                **found}

    return step


def as_bytes(column: Column) -> Column:
    """Doubles of an array as the bytes that ``rounds`` works on."""
    @F.pandas_udf("binary")
    def convert(values: pd.Series) -> pd.Series:
        return values.map(lambda v: np.asarray(v, np.float64).tobytes())
    return convert(column)


def rake_multipliers(
    inc: DataFrame,
    controls: DataFrame,
    targets: Sequence[str],
    by: str = "PUMA",
    weight: str = "WGTP",
    importance: Mapping[str, float] | None = None,
    tol: float = 1e-6,
    max_expansion: float = MAX_EXPANSION,
) -> DataFrame:
    """Multipliers of every zone: (``by``, multipliers, error, rounds).

    Generalized raking (Deville, Saerndal and Sautory 1993) by Newton steps on the dual.
    Targets that contradict each other are met in proportion to their importance through a small
    ridge. A zone leaves when its penalised gap is below ``tol``, or when neither a step nor any
    shorter one gains; the rounds go on with the other zones only, so one with contradictions
    costs no more than itself. ``error`` is the largest relative gap that is left.

    Equal incidence rows are merged and packed into blocks once. A round sums the moments of the
    blocks in numpy and solves one small system per zone, see ``rounds``. A zone without seeds keeps multipliers of 0.
    """
    k = len(targets)
    imp = [float((importance or {}).get(t, 1000.0)) for t in targets]
    blocks = packed(
        inc.select(F.col(by).alias("zone"), incidence_array(targets).alias("x"),
                   F.col(weight).cast("double").alias("w"))
        .groupBy("zone", "x").agg(F.sum("w").alias("w")), k)
    goal = F.expr(
        f"array({', '.join(f'coalesce(CAST({t} AS DOUBLE), 0D)' for t in targets)})")
    weights = F.expr(f"array({', '.join(f'{v}D' for v in imp)})")
    ridge = F.zip_with(goal, weights, lambda c, i: F.greatest(c, F.lit(1.0)) * F.lit(1e-3) / i)
    zeros = F.lit(bytes(8 * k))
    state = cut(controls.select(
        F.col(by).alias("zone"), *[zeros.alias(c) for c in ("lam", "best", "delta")],
        F.lit(1.0).alias("step"), F.lit(float("inf")).alias("best_norm"),
        F.lit(float("inf")).alias("best_err"), as_bytes(goal).alias("goal"),
        as_bytes(ridge).alias("ridge"), F.lit(0).alias("rounds"), F.lit(False).alias("done")))
    found = rounds(blocks, state, ["lam"], _moments(max_expansion), _newton_step(tol),
                   ready=lambda row: unpacked(row, k), keep=["zone", "best", "best_err", "rounds"])
    as_array = F.pandas_udf(lambda v: v.map(lambda b: np.frombuffer(b, np.float64)),
                            "array<double>")
    return found.select(F.col("zone").alias(by), as_array("best").alias("multipliers"),
                        F.col("best_err").alias("error"), "rounds")


def rake_weights(
    inc: DataFrame,
    controls: DataFrame,
    targets: Sequence[str],
    by: str = "PUMA",
    weight: str = "WGTP",
    importance: Mapping[str, float] | None = None,
    tol: float = 1e-6,
    max_expansion: float = MAX_EXPANSION,
    key: str = "hh_id",
    out: str = "final_weight",
) -> DataFrame:
    """Weights ``weight * exp(x.lambda)``, capped, that meet the zone controls.

    ``controls`` has ``by`` and one column per target; see ``rake_multipliers``.
    Returns ``key``, ``by``, ``weight`` and ``out``.
    """
    found = rake_multipliers(
        inc, controls, targets, by, weight, importance, tol, max_expansion).select(
            by, F.col("multipliers").alias("__lam"))
    dot = F.aggregate(F.zip_with(incidence_array(targets), "__lam", lambda a, b: a * b),
                      F.lit(0.0), lambda acc, v: acc + v)
    capped = F.least(F.exp(dot), F.lit(float(max_expansion)))
    return inc.join(found, by).select(
        key, by, weight, (F.col(weight) * capped).alias(out))


def residuals(
    weights: DataFrame, inc: DataFrame, controls: DataFrame, targets: Sequence[str],
    by: str = "PUMA", weight: str = "final_weight", key: str = "hh_id",
) -> DataFrame:
    """(``by``, target, control, result, relative_gap) of every zone and target after raking."""
    made = weights.select(key, by, weight).join(
        unbounded(inc.select(key, *targets)), key).groupBy(by).agg(
        *[F.expr(f"sum({weight} * {t}) AS {t}") for t in targets])

    def long(df: DataFrame, name: str) -> DataFrame:
        return df.select(by, F.explode(F.array(*[
            F.struct(F.lit(t).alias("target"), F.col(t).cast("double").alias(name))
            for t in targets])).alias("e")).select(by, "e.*")

    both = long(controls.select(by, *targets), "control").join(
        unbounded(long(made, "result")), [by, "target"], "left")
    gap = F.abs(F.coalesce("result", F.lit(0.0)) - F.coalesce("control", F.lit(0.0)))
    return both.withColumn("relative_gap", gap / F.greatest(
        F.coalesce("control", F.lit(0.0)), F.lit(1.0)))


def scale_to_parent(
    df: DataFrame, cols: Sequence[str], parent: str, totals: DataFrame
) -> DataFrame:
    """Scale zone columns so that their sums meet the parent's columns of the same name.

    The factors are written first: the join knows their size and need not deal the zones out by
    a key that few parents share.
    """
    current = df.groupBy(parent).agg(*sums(cols))
    factors = cut(totals.alias("t").join(current.alias("c"), parent).selectExpr(
        parent, *[f"{ratio_sql(f't.{quoted(c)}', f'c.{quoted(c)}')} AS {quoted('__' + c)}"
                  for c in cols]))
    return df.join(factors, parent, "left").selectExpr(
        *replaced(df, {c: f"{quoted(c)} * {quoted('__' + c)}" for c in cols}))


# --------------------------------------------------------------------------
# Integer weights
# --------------------------------------------------------------------------
def integerize(
    df: DataFrame, weight: str, by: Sequence[str] = ("PUMA",), key: Sequence[str] = ("hh_id",),
    out: str = "int_weight", total: str | None = None,
) -> DataFrame:
    """Largest-remainder rounding: each group keeps its rounded total.

    Rows are ranked by fraction, then key, over range partitions, so a group of any size is
    ranked by many tasks. ``total`` names a column with the group's wanted integer total; the
    default is the rounded sum of the weights, which are added as decimals of 10 places, so that it
    does not depend on the order in which tasks add them.
    """
    by, key = list(by), list(key)
    whole = F.floor(weight).cast("bigint")
    split = df.withColumns({"__whole": whole, "__frac": F.col(weight) - whole})
    ranked = rank_rows(
        split, [F.col("__frac").desc(), *key], by, out="__rank",
        totals={
            "__sum": f"CAST({quoted(weight)} AS DECIMAL(28, 10))", "__whole_sum": "__whole"})
    wanted = F.bround("__sum", 0).cast("bigint") if total is None else F.col(total)
    bump = (F.col("__rank") <= wanted - F.col("__whole_sum")).cast("bigint")
    return ranked.withColumn(out, F.col("__whole") + bump).select(*df.columns, out)


# --------------------------------------------------------------------------
# Copies
# --------------------------------------------------------------------------
def slots(
    df: DataFrame, n: str, order: Sequence[str], by: Sequence[str], spread: bool = False
) -> DataFrame:
    """Repeat each row ``n`` times and number the copies 1, 2, 3 ... inside each ``by`` group.

    ``spread`` is for tables of few rows with large counts: the pieces of a row are then
    generated by different tasks.
    """
    used = df.filter(F.col(n) > 0)
    ends = running_total(used, n, order, by, out="__end")
    return repeated(ends, n, spread).withColumn(
        "slot", F.col("__end") - F.col(n) + F.col("__copy")).drop("__end", "__copy")


def repeated(df: DataFrame, n: str, spread: bool, chunk: int = 4096) -> DataFrame:
    """``n`` copies of each row with ``__copy`` = 1..n, generated in bounded pieces."""
    pieces = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(n) - 1) / chunk).cast("bigint"))
    last = F.least(F.lit(chunk).cast("bigint"), F.col(n) - F.col("__piece") * chunk)
    in_pieces = df.withColumn("__piece", F.explode(pieces))
    if spread:
        in_pieces = in_pieces.repartition("__piece", *df.columns)
    return (
        in_pieces
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), last)))
        .withColumn("__copy", F.col("__piece") * chunk + F.col("__copy"))
        .drop("__piece")
    )


# --------------------------------------------------------------------------
# Expansion, summaries, outputs
# --------------------------------------------------------------------------
def expand(df: DataFrame, n: str, order: Sequence[str], out: str = "household_id") -> DataFrame:
    """One row per synthetic household; ids run 1, 2, 3 ... over the whole table."""
    return slots(df, n, order, ()).withColumnRenamed("slot", out).drop(n)


def summarize(
    weights: DataFrame, inc: DataFrame, controls: DataFrame, zone: str, targets: Sequence[str],
    fields: Mapping[str, str], weight: str = "int_weight", key: str = "hh_id",
) -> DataFrame:
    """Published and synthesised value of each target per zone.

    ``fields`` maps a target to its column in ``controls``.
    """
    results = (
        weights.select(key, zone, weight).join(unbounded(inc.select(key, *targets)), key)
        .groupBy(zone).agg(*[F.expr(f"sum({weight} * {t}) AS {t}_result") for t in targets])
    )
    published = controls.selectExpr(
        zone, *[f"{fields[t]} AS {t}_control" for t in targets])
    cols = [c for t in targets for c in (f"{t}_control", f"{t}_result")]
    return published.join(unbounded(results), zone, "left").select(F.col(zone).alias("id"), *cols)


def super_summary(
    summary: DataFrame, xwalk: DataFrame, child: str, parent: str, targets: Sequence[str]
) -> DataFrame:
    """A child summary summed to a coarser geography."""
    link = xwalk.select(child, parent).distinct()
    cols = [c for t in targets for c in (f"{t}_control", f"{t}_result")]
    return (
        summary.join(unbounded(link), F.col("id") == F.col(child))
        .groupBy(F.col(parent).alias("id")).agg(*sums(cols))
    )


def super_summaries(
    summary: DataFrame, xwalk: DataFrame, child: str, parents: Sequence[str],
    targets: Sequence[str],
) -> DataFrame:
    """(geo, id, ...): a child summary summed to every coarser geography in one pass.

    The crosswalk is turned into one row per child, geography and zone, so a child counts once in
    each zone it lies in, and one join and one aggregate serve all of them.
    """
    link = xwalk.select(child, F.explode(F.array(*[
        F.struct(F.lit(p).alias("geo"), F.col(p).cast("bigint").alias("__zone"))
        for p in parents])).alias("e")).select(child, "e.geo", "e.__zone").distinct()
    cols = [c for t in targets for c in (f"{t}_control", f"{t}_result")]
    return (
        summary.join(unbounded(link), F.col("id") == F.col(child))
        .groupBy("geo", F.col("__zone").alias("id")).agg(*sums(cols))
    )


def synthetic_households(
    expanded: DataFrame, households: DataFrame, keep: Sequence[str] = (), key: str = "hh_id",
) -> DataFrame:
    """Synthetic household records."""
    cols = [c for c in SYNTHETIC_HOUSEHOLD_COLS if c in households.columns]
    return expanded.join(unbounded(households.select(key, *cols)), key).select(
        "household_id", *keep, *cols)


def synthetic_persons(
    expanded: DataFrame, persons: DataFrame, keep: Sequence[str] = (), key: str = "hh_id",
) -> DataFrame:
    """Synthetic person records: the persons of a seed household once per copy."""
    named = persons.withColumnsRenamed({"SPORDER": "per_num"})
    cols = [c for c in SYNTHETIC_PERSON_COLS if c in named.columns]
    return expanded.join(unbounded(named.select(key, *cols)), key).select("household_id", *keep, *cols)


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: type, values present, missing values, smallest and largest value."""
    plain = [f for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    row = df.agg(*[
        F.struct(
            F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
            F.count(f.name).alias("n_values"),
            F.count_if(F.col(f.name).isNull()).alias("n_missing"),
            F.min(f.name).cast("string").alias("min_value"),
            F.max(f.name).cast("string").alias("max_value")).alias(f.name)
        for f in plain
    ])
    return row.select(F.explode(F.array(*[F.col(f.name) for f in plain])).alias("e")).select("e.*")
