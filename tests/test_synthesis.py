import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from popflow.operators import allocation, synthesis as ops
from popflow.operators.allocation import allocate_to_children
from popflow.plans.synthesize import synthesize
from popflow.plans.validate import validate
from popflow.specs import CONTROLS


@pytest.fixture(scope="module")
def population(spark):
    """Households of four zones, one of which holds more than half of them."""
    rng = np.random.default_rng(11)
    n = 1200
    zone = np.where(rng.random(n) < 0.55, 100, rng.integers(101, 104, n))
    size, income = rng.integers(0, 3, n), rng.integers(0, 2, n)
    pdf = pd.DataFrame({"hh_id": np.arange(n), "PUMA": zone, "WGTP": rng.integers(1, 20, n)})
    for k in range(3):
        pdf[f"s{k}"] = (size == k).astype(int)
    for k in range(2):
        pdf[f"i{k}"] = (income == k).astype(int)
    pdf["h"], pdf["p"] = 1, rng.integers(1, 6, n)
    pdf["true"] = pdf["WGTP"] * rng.integers(1, 4, n)
    return pdf


TARGETS = ["h", "p", "s0", "s1", "s2", "i0", "i1"]


def goals(pdf):
    return pd.DataFrame({
        "PUMA": sorted(pdf["PUMA"].unique()),
        **{t: (pdf["true"] * pdf[t]).groupby(pdf["PUMA"]).sum().to_numpy() for t in TARGETS}})


def test_raked_weights_meet_consistent_controls(spark, population):
    want = goals(population)
    got = ops.rake_weights(
        spark.createDataFrame(population), spark.createDataFrame(want), TARGETS).toPandas()
    assert len(got) == len(population)
    assert (got["final_weight"] >= 0).all()
    assert (got["final_weight"] <= 30 * got["WGTP"] + 1e-9).all()
    both = population.merge(got[["hh_id", "final_weight"]], on="hh_id")
    for t in TARGETS:
        sums = (both["final_weight"] * both[t]).groupby(both["PUMA"]).sum().to_numpy()
        np.testing.assert_allclose(sums, want[t], rtol=1e-4)


def test_raking_survives_contradicting_controls(spark, population):
    want = goals(population)
    want["s0"] *= 3  # the classes no longer add up to the total
    got = ops.rake_weights(
        spark.createDataFrame(population), spark.createDataFrame(want), TARGETS,
        importance={"h": 100000.0}).toPandas()
    assert np.isfinite(got["final_weight"]).all()
    assert (got["final_weight"] <= 30 * got["WGTP"] + 1e-9).all()
    total = got.groupby("PUMA")["final_weight"].sum().to_numpy()
    np.testing.assert_allclose(total, want["h"], rtol=0.05)


def test_raking_respects_the_cap(spark, population):
    want = goals(population)
    want[TARGETS] *= 40  # out of reach at thirty times the weight
    got = ops.rake_weights(spark.createDataFrame(population), spark.createDataFrame(want), TARGETS
                           ).toPandas()
    assert (got["final_weight"] <= 30 * got["WGTP"] + 1e-9).all()
    assert got["final_weight"].sum() > 20 * got["WGTP"].sum()


def test_integer_weights_keep_the_total(spark, population):
    df = population.assign(w=population["true"] * 0.37)
    got = ops.integerize(spark.createDataFrame(df), "w").toPandas()
    assert (abs(got["int_weight"] - got["w"]) < 1).all()
    for _, part in got.groupby("PUMA"):
        assert part["int_weight"].sum() == round(part["w"].sum())
        up = part[part["int_weight"] > np.floor(part["w"])]
        down = part[(part["int_weight"] == np.floor(part["w"])) & (part["w"] % 1 > 0)]
        if len(up) and len(down):
            assert (up["w"] % 1).min() >= (down["w"] % 1).max() - 1e-12


def test_totals_do_not_depend_on_partitions(spark):
    """Fractions that add up to one half exactly, in any order of addition."""
    df = spark.createDataFrame([(i, 1, 0.1) for i in range(25)] + [(100 + i, 2, 0.7) for i in range(5)],
                               "hh_id long, PUMA long, w double")
    made = {tuple(sorted(tuple(r) for r in ops.integerize(df.repartition(n), "w").groupBy("PUMA").agg(
        F.sum("int_weight")).collect())) for n in (1, 3, 7)}
    assert made == {((1, 2), (2, 4))}  # 2.5 and 3.5, halves to even


def test_ties_are_rounded_by_id(spark, rows):
    df = spark.createDataFrame([(i, 1, 0.5) for i in range(4)], "hh_id long, PUMA long, w double")
    assert rows(ops.integerize(df, "w"), "hh_id", "int_weight") == [(0, 1), (1, 1), (2, 0), (3, 0)]


def test_expansion_numbers_every_copy(spark, population):
    df = spark.createDataFrame(population[["hh_id", "WGTP"]].assign(WGTP=lambda d: d["WGTP"] % 5))
    got = ops.expand(df, "WGTP", ["hh_id"]).toPandas()
    assert sorted(got["household_id"]) == list(range(1, (population["WGTP"] % 5).sum() + 1))
    counts = got["hh_id"].value_counts()
    want = population.set_index("hh_id")["WGTP"] % 5
    assert counts.sort_index().to_dict() == want[want > 0].to_dict()
    assert got.sort_values("household_id")["hh_id"].is_monotonic_increasing


@pytest.mark.parametrize("spread", [False, True])
def test_large_counts_are_generated_in_pieces(spark, spread):
    df = spark.createDataFrame([(1, 10000), (2, 0), (3, 4096), (4, 1)], "k long, n long")
    got = ops.slots(df, "n", ["k"], [], spread).groupBy("k").agg(
        F.min("slot"), F.max("slot"), F.count_distinct("slot")).collect()
    assert sorted(tuple(r) for r in got) == [
        (1, 1, 10000, 10000), (3, 10001, 14096, 4096), (4, 14097, 14097, 1)]


def test_allocation_keeps_households_and_meets_children(spark, population):
    pdf = population.assign(
        n=population["true"], child=population["PUMA"] * 10 + population["hh_id"] % 4,
        group=population["PUMA"] * 10 + population["hh_id"] % 2)

    def sums(zone, targets):
        return pd.DataFrame({f"C_{t}": (pdf["n"] * pdf[t]).groupby(pdf[zone]).sum()
                             for t in targets}).rename_axis(zone).reset_index()

    own, upper = ["h", "s0", "s1"], ["s2"]
    children = sums("child", own).merge(pdf[["child", "PUMA", "group"]].drop_duplicates())
    got = allocate_to_children(
        spark.createDataFrame(pdf[["hh_id", "PUMA", "n"]]), spark.createDataFrame(population),
        spark.createDataFrame(children), "child", {t: f"C_{t}" for t in own},
        "group", spark.createDataFrame(sums("group", upper)), {t: f"C_{t}" for t in upper},
        weight="n").toPandas()
    assert got.groupby("hh_id")["n"].sum().to_dict() == pdf.set_index("hh_id")["n"].to_dict()
    assert (got["child"] // 10 == got["PUMA"]).all()
    both = got.merge(population[["hh_id", *own, *upper]], on="hh_id").merge(
        pdf[["child", "group"]].drop_duplicates())
    for zone, targets in (("child", own), ("group", upper)):
        want = sums(zone, targets).set_index(zone)
        for t in targets:
            made = (both["n"] * both[t]).groupby(both[zone]).sum()
            off = (made.reindex(want.index).fillna(0) - want[f"C_{t}"]).abs()
            assert (off <= 3 + 0.005 * want[f"C_{t}"]).all()


def test_zones_with_contradicting_controls_do_not_spoil_others(spark, population):
    want = goals(population)
    first = want["PUMA"].min()
    want.loc[want["PUMA"] == first, "s0"] *= 3
    inc, controls = spark.createDataFrame(population), spark.createDataFrame(want)
    found = ops.rake_multipliers(inc, controls, TARGETS).toPandas()
    assert sorted(found["PUMA"]) == sorted(want["PUMA"])
    weights = ops.rake_weights(inc, controls, TARGETS)
    left = ops.residuals(weights, inc, controls, TARGETS).toPandas()
    assert left[left["PUMA"] == first]["relative_gap"].max() > 0.05
    assert left[left["PUMA"] != first]["relative_gap"].max() < 1e-4


def test_signatures_merge_equal_households(spark):
    inc = spark.createDataFrame(
        [(1, 5, 10, 1, 0), (2, 5, 20, 1, 0), (3, 5, 1, 0, 1), (4, 6, 1, 1, 0)],
        "hh_id long, PUMA long, WGTP long, a long, b long")
    got = {(r.PUMA, tuple(r.x)): (r.n_households, r.weight, r.first_hh_id)
           for r in ops.signatures(inc, ["a", "b"]).collect()}
    assert got == {(5, (1, 0)): (2, 30, 1), (5, (0, 1)): (1, 1, 3), (6, (1, 0)): (1, 1, 4)}


def test_scale_to_parent(spark, rows):
    df = spark.createDataFrame([(1, 9, 2.0), (2, 9, 6.0), (3, 8, 1.0)], "z long, s long, x double")
    parent = spark.createDataFrame([(9, 4), (8, 5)], "s long, x long")
    assert rows(ops.scale_to_parent(df, ["x"], "s", parent)) == [
        (1, 9, 1.0), (2, 9, 3.0), (3, 8, 5.0)]


def test_a_child_counts_once_in_every_coarser_zone(spark, rows):
    summary = spark.createDataFrame([(1, 4, 5), (2, 10, 20)], "id long, t_control long, t_result long")
    xwalk = spark.createDataFrame(
        [(1, 7, 3), (1, 8, 3), (2, 8, 3), (2, 8, 3)], "TRACT long, PUMA int, STATE int")
    assert rows(ops.super_summaries(summary, xwalk, "TRACT", ["PUMA", "STATE"], ["t"])) == [
        ("PUMA", 7, 4, 5), ("PUMA", 8, 14, 25), ("STATE", 3, 14, 25)]


def test_schema_report(spark):
    df = spark.createDataFrame([(1, "b"), (None, "a")], "n long, s string")
    got = {r.column: tuple(r)[1:] for r in ops.schema_report(df).collect()}
    assert got == {"n": ("bigint", 1, 1, "1", "1"), "s": ("string", 2, 0, "a", "b")}


@pytest.fixture(scope="module")
def synthesized(spark):
    """Sixty households of two zones, each zone with two tracts of two block groups."""
    rng = np.random.default_rng(5)
    n = 60
    hh = pd.DataFrame({
        "hh_id": np.arange(n), "PUMA": np.arange(n) // 30, "STATE": 9, "REGION": 1,
        "WGTP": rng.integers(2, 9, n), "NP": rng.integers(1, 4, n),
        "HINCP": rng.integers(0, 200000, n), "VEH": 1, "HUPAC": 4, "TEN": 1, "SMOCP": 900,
        "RNTP": 995, "GRNTP": 995})
    per = pd.DataFrame([
        {"hh_id": h, "SPORDER": k + 1, "PWGTP": w, "AGEP": 40, "SEX": 1 + k % 2, "RAC1P": 1,
         "HISP": 1, "WKHP": 40, "JWTRNS": 1 + 10 * (k % 2), "SCH": 1, "SCHG": 995, "ESR": 1}
        for h, size, w in zip(hh["hh_id"], hh["NP"], hh["WGTP"]) for k in range(size)])
    wanted = [c for c in CONTROLS if c.control_group in (
        "h_total", "p_total", "h_size", "p_sex", "p_mode")]
    households, persons = spark.createDataFrame(hh), spark.createDataFrame(per)
    inc = ops.incidence(households, persons, wanted).withColumns({
        "TRACT": F.floor(F.col("hh_id") / 15).cast("long"),
        "BG": F.floor(F.col("hh_id") * 2 / 15).cast("long")})
    tables = {
        geo: inc.groupBy(geo).agg(*[
            F.expr(f"sum(2 * WGTP * {c.target}) AS {c.control_field}")
            for c in wanted if c.geography == geo]) for geo in ("BG", "TRACT")}
    xwalk = inc.select("BG", "TRACT", "PUMA").distinct().withColumns({
        "STATE": F.lit(9), "REGION": F.lit(1)})
    out = synthesize(households, persons, xwalk, tables["BG"], tables["TRACT"], wanted)
    return out, hh, per, households, wanted


def test_synthesis_meets_totals_everywhere(synthesized):
    out, hh, *_ = synthesized
    for name in ("summary_BG", "summary_TRACT", "summary_BG_PUMA", "summary_BG_REGION"):
        got = out[name].toPandas()
        assert (got["h_total_control"] - got["h_total_result"]).abs().max() <= 2, name
    region = out["summary_BG_REGION"].first()
    assert region["h_total_result"] == 2 * hh["WGTP"].sum()
    assert {"p_mode_wfh_control", "h_total_control"} <= set(out["summary_TRACT"].columns)


def test_synthetic_records(synthesized):
    out, hh, per, *_ = synthesized
    n = int(2 * hh["WGTP"].sum())
    made = out["synthetic_households"].toPandas()
    assert sorted(made["household_id"]) == list(range(1, n + 1))
    assert out["synthetic_households"].columns == [
        "household_id", "NP", "HINCP", "VEH", "HUPAC", "TEN", "SMOCP", "RNTP", "GRNTP"]
    people = out["synthetic_persons"].toPandas()
    assert list(people.columns) == [
        "household_id", "per_num", "AGEP", "SEX", "RAC1P", "HISP", "WKHP", "JWTRNS", "SCH",
        "SCHG", "ESR"]
    assert people.groupby("household_id").size().sort_index().tolist() == (
        made.sort_values("household_id")["NP"].tolist())


def test_validation_reports(synthesized):
    out, _, _, households, wanted = synthesized
    reports = validate(out, households, out["expanded_household_ids"], wanted)
    total = [r for r in reports["stats_BG-TRACT"].collect() if r.control_name == "H_TOTAL"][0]
    assert total.geography == "BG" and total.N == 8 and abs(total.difference) <= 1
    assert {r.geography for r in reports["stats_PUMA"].collect()} == {"BG_PUMA", "TRACT_PUMA"}
    assert {r.geo_quantiles for r in reports["stats_quantiles"].collect()} == {
        "Q1", "Q2", "Q3", "Q4"}
    region = reports["NRMSE_REGION"].first()
    assert region.EXP_SYNTH == pytest.approx(2.0) and region.N == 60
    assert reports["ef_histogram_STATE"].count() >= 1


def test_zones_of_few_blocks_write_nothing_between_rounds(spark, monkeypatch):
    """One task goes through all rounds of such a zone; a larger one takes the same steps."""
    from popflow.operators import rounds as module

    rng = np.random.default_rng(5)
    inc = spark.createDataFrame(
        [(i, i % 3, 1.0 + i % 4, *map(int, rng.integers(0, 4, 3))) for i in range(90)],
        "hh_id long, PUMA long, WGTP double, a long, b long, c long")
    goals = inc.groupBy("PUMA").agg(*[
        F.sum(F.col("WGTP") * (1 + F.col("hh_id") % 2) * F.col(t)).alias(t) for t in "abc"])
    written, cut = [], module.cut
    monkeypatch.setattr(module, "cut", lambda df: written.append(1) or cut(df))

    def made(few):
        monkeypatch.setattr(module.rounds, "__defaults__", (
            *module.rounds.__defaults__[:-1], few))
        written.clear()
        found = ops.rake_multipliers(inc, goals, ["a", "b", "c"]).orderBy("PUMA").collect()
        return found, len(written)

    (one, few_written), (many, many_written) = made(8), made(0)
    assert max(r["rounds"] for r in one) >= 3 and few_written < many_written
    assert [r["rounds"] for r in one] == [r["rounds"] for r in many]
    for a, b in zip(one, many):
        assert np.allclose(a["multipliers"], b["multipliers"])


def test_incidence_is_not_broadcast(spark):
    inc = spark.createDataFrame([(1, 7, 2, 3)], "hh_id long, PUMA long, n long, a long")
    controls = spark.createDataFrame([(7, 5)], "PUMA long, A long")
    made = ops.summarize(inc, inc, controls, "PUMA", ["a"], {"a": "A"}, "n")
    assert "Broadcast" not in made._jdf.queryExecution().sparkPlan().toString()


def test_rounds_in_one_task_take_the_same_steps():
    """What a zone keeps from round to round, and whole curvatures, change no step."""
    rng = np.random.default_rng(5)
    k, dim, n, children, parents = 6, 8, 120, 5, 2
    x = rng.integers(0, 3, (n, dim)).astype(np.int32)
    goal = rng.integers(1, 9, n).astype(float)
    placed = goal[:, None] * rng.dirichlet(np.ones(children), n)
    parent = np.array([0.0, 0, 0, 1, 1])
    upper = np.stack([placed[:, parent == p].sum(axis=1) @ x[:, k:] for p in range(parents)])
    row = {"x": x.tobytes(), "w": goal.tobytes(), "own": (placed.T @ x[:, :k]).tobytes(),
           "upper": upper.tobytes(), "parent": parent.tobytes()}
    cells = allocation._cells(k, dim)(row)

    def solved(held, **alone):
        size = 8 * (children * k + parents * (dim - k))
        now = {**row, "some": row["x"], "at": bytes(size), "best": bytes(size),
               "towards": bytes(size), "gap": b"", "past": b"", "dual": -np.inf, "size": 1.0,
               "slope": 0.0, "left": np.inf, "mark": np.inf, "since": 0, "rounds": 0,
               "done": False}
        while not now["done"]:
            totals = [np.ravel(a) for a in allocation._moments(k)(cells, {**now, **alone})]
            now = {**now, **allocation._next_point(k, dim, 1e-4)(now, totals, held)}
        assert now["left"] < 1e-4
        return now["rounds"], np.frombuffer(now["best"])

    (turns, best), (again, other) = solved(None), solved({}, alone=True)
    assert turns == again and (other == best).all()


def test_whole_places_match_a_plain_loop():
    rng = np.random.default_rng(6)
    share = rng.dirichlet(np.full(7, 0.3), 40)
    x = rng.integers(0, 2, (40, 9)).astype(float)
    goal = rng.integers(1, 50, 40).astype(float)
    want = np.floor(share * goal[:, None] + 1e-9)
    short = np.zeros((7, 9))
    for s in sorted(range(40), key=lambda s: (-goal[s], s)):
        n, rest = share[s] * goal[s], int(goal[s] - want[s].sum())
        score = n - want[s] + short @ x[s] / (x[s] @ x[s] + 1)
        want[s, np.argsort(-score, kind="stable")[:rest]] += 1
        short += np.outer(n - want[s], x[s])
    assert (allocation._whole_places(share, x, goal) == want).all()
