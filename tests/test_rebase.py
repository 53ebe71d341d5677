import pytest
from pyspark.errors import PySparkException

from popflow import specs
from popflow.operators import rebase as ops
from popflow.plans.rebase import rebase, surveyed_states


def weights(spark, values):
    return spark.createDataFrame(values, "STATE long, PUMA long, WGTP long")


def test_weight_factor(spark, rows):
    five = weights(spark, [(9, 1, 10), (9, 1, 30), (9, 2, 5), (9, 3, 0)])
    one = weights(spark, [(9, 1, 20), (9, 4, 7), (9, 3, 2)])
    zones, states = ops.zone_and_state_factors(one, five, "WGTP", "f")
    assert {r.PUMA: r.f for r in zones.collect()} == {1: 0.5, 2: None, 3: None}
    # The state keeps the one-year zone that the five-year data lack.
    assert rows(states) == [(9, 29 / 45)]


def test_unmatched_seed_weight_is_null_unless_defaulted(spark, rows):
    seed = spark.createDataFrame([(1, 10), (2, 10)], "PUMA long, WGTP long")
    factors = spark.createDataFrame([(1, 0.5)], "PUMA long, factor double")
    assert {r.PUMA: r.WGTP for r in ops.apply_factor(seed, factors, "PUMA", ["WGTP"]).collect()} \
        == {1: 5.0, 2: None}
    assert rows(ops.apply_factor(seed, factors, "PUMA", ["WGTP"], default=1)) == [
        (1, 5.0), (2, 10.0)]


def test_scaled_controls_fill_every_null_with_one(spark):
    zones = spark.createDataFrame(
        [(1, 10, None, "n"), (2, 4, 8, None)], "BG long, H long, P long, NAME string")
    factors = spark.createDataFrame(
        [(1, 2.0, 3.0)], "BG long, ADJ_FACTOR_HH double, ADJ_FACTOR_PER double")
    got = {r.BG: tuple(r) for r in ops.scale_controls(zones, factors, "BG", ["H"], ["P"]).collect()}
    assert got == {1: (1, 20.0, 3.0, "n"), 2: (2, 4.0, 8.0, "1")}


def test_zone_factor_takes_the_first_block_group(spark, rows):
    xwalk = spark.createDataFrame(
        [(7, 72, 200), (7, 71, 100), (8, 81, 300)], "TRACT long, BG long, PUMA long")
    hh = spark.createDataFrame([(100, 2.0), (200, 5.0)], "PUMA long, ADJ_FACTOR_HH double")
    per = spark.createDataFrame([(100, 3.0)], "PUMA long, ADJ_FACTOR_PER double")
    got = {r.TRACT: tuple(r)[1:] for r in ops.zone_factors(xwalk, "TRACT", hh, per).collect()}
    assert got == {7: (2.0, 3.0), 8: (None, None)}


def test_targets_count_a_missing_variable_as_one(spark):
    wide = spark.createDataFrame([(9, 5, None)], "STATE long, a long, b long")
    assert tuple(ops.derive_targets(wide, {"X": ["a", "b"], "Y": ["b"]}).first()) == (9, 6, 1)


def test_match_total(spark, rows):
    seed = spark.createDataFrame([(9, 1.0), (9, 3.0), (36, 2.0)], "STATE long, WGTP double")
    goal = spark.createDataFrame([(9, 8), (36, 1)], "STATE long, H_TOTAL long")
    assert rows(ops.match_total(seed, "WGTP", goal, "H_TOTAL")) == [
        (9, 2.0), (9, 6.0), (36, 1.0)]


def test_ratios_align_by_name(spark):
    goal = spark.createDataFrame([(9, 10, 4)], "STATE long, A long, B long")
    now = spark.createDataFrame([(9, 5, 0)], "STATE long, A long, C long")
    ratios = ops.control_ratios(goal, now, ["A", "B", "C"])
    assert tuple(ratios.first()) == (9, 2.0, None, None)
    zones = spark.createDataFrame([(9, 3, 3)], "STATE long, A long, Z long")
    assert tuple(ops.ratio_adjust(zones, ratios.select("STATE", "A")).first()) == (9, 6.0, 3)
    assert tuple(ops.ratio_adjust(zones, ratios.select("STATE", "A"), exclude=["A"]).first()) == (
        9, 3, 3)


def test_rounding_rejects_nulls(spark):
    df = spark.createDataFrame([(1, 2.5), (2, 3.5)], "k long, x double")
    assert [r.x for r in ops.round_controls(df, ["x"]).orderBy("k").collect()] == [2, 4]
    with pytest.raises(PySparkException):
        ops.round_controls(spark.createDataFrame([(1, None)], "k long, x double"), ["x"]).collect()


def test_ordered_projection(spark):
    df = spark.createDataFrame([(1, 2, 3)], "P_TOTAL int, odd int, BG int")
    assert ops.ordered_projection(df).columns == ["BG", "P_TOTAL"]
    assert ops.ordered_projection(df.select("odd")).columns == ["odd"]


@pytest.fixture(scope="module")
def whole(spark):
    """Two states, two PUMAs each, every control present."""
    def frame(records):
        names = list(records[0])
        kinds = ["string" if n == "NAME" else "long" for n in names]
        return spark.createDataFrame(
            [tuple(r.values()) for r in records], ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))

    def zones(cols):
        out = []
        for s in (9, 36):
            for p in (1, 2):
                base = {"COUNTY": s * 1000 + p, "TRACT": (s * 1000 + p) * 10**6 + 1,
                        "BG": ((s * 1000 + p) * 10**6 + 1) * 10 + 1, "STATE": s, "NAME": "z"}
                out.append(base | {c: 100 + 7 * i + 13 * p + s for i, c in enumerate(cols)})
        return out

    bg = zones(specs.HOUSEHOLD_COLS + specs.BG_PERSON_COLS)
    tract = [{k: v for k, v in z.items() if k not in ("BG", "NAME")}
             for z in zones(specs.TRACT_PERSON_COLS)]
    cols = specs.HOUSEHOLD_COLS + specs.PERSON_COLS
    state = [{"STATE": s} | {
        c: sum(z.get(c, 0) for z in bg + tract if z["STATE"] == s) for c in cols} for s in (9, 36)]
    acs1 = [{"STATE": s} | {
        v: 50 + 3 * i + s for i, v in enumerate(sorted(
            {f for fs in specs.ESTIMATED_VARIABLES.values() for f in fs}))} for s in (9, 36)]
    xwalk = frame([{"BG": z["BG"], "TRACT": z["TRACT"], "PUMA": z["COUNTY"]} for z in bg])
    hh5 = [(9, 9001, 10), (9, 9002, 20), (36, 36001, 30), (36, 36002, 40)]
    hh1 = [(s, p, w + 4) for s, p, w in hh5]
    hh = "STATE long, PUMA long, WGTP long"
    per = "STATE long, PUMA long, PWGTP long"
    return rebase(
        spark.createDataFrame(hh5, hh), spark.createDataFrame(hh5, per),
        {"BG": frame(bg), "TRACT": frame(tract), "STATE": frame(state)}, xwalk,
        spark.createDataFrame(hh1, hh), spark.createDataFrame(hh5, hh),
        spark.createDataFrame(hh1, per), spark.createDataFrame(hh5, per), frame(acs1)), acs1


def test_rebased_states_meet_the_one_year_controls(whole):
    out, acs1 = whole
    for row in out["control_totals_STATE"].collect():
        one = next(a for a in acs1 if a["STATE"] == row["STATE"])
        for control, fields in specs.ESTIMATED_VARIABLES.items():
            assert row[control] == sum(one[f] for f in fields)


def test_rebased_remainders_meet_the_one_year_remainders(whole):
    out, acs1 = whole
    one = next(a for a in acs1 if a["STATE"] == 9)
    want = {c: sum(one[f] for f in fs) for c, fs in specs.ESTIMATED_VARIABLES.items()}
    bg = out["control_totals_BG"].filter("STATE = 9").groupBy().sum("P_NON_WORKER").first()[0]
    assert abs(bg - (want["P_TOTAL"] - want["P_FULL_TIME"] - want["P_PART_TIME"])) <= 2


def test_region_is_the_sum_of_its_states(whole):
    out, _ = whole
    region = out["scaled_control_totals_meta"].first()
    totals = out["control_totals_STATE"].groupBy().sum("H_TOTAL", "P_MALE").first()
    assert (region["H_TOTAL"], region["P_MALE"]) == tuple(totals)


def test_rebased_seeds_meet_the_totals(whole):
    out, acs1 = whole
    for row in out["seed_households"].groupBy("STATE").sum("WGTP").collect():
        one = next(a for a in acs1 if a["STATE"] == row["STATE"])
        assert row[1] == pytest.approx(one["B11005_001E"])


def test_states_that_a_survey_lacks(spark, rows):
    zones = spark.createDataFrame([(1, 10), (2, 20), (2, 21), (3, 30)], "STATE long, BG long")
    one = spark.createDataFrame([(1, 5), (2, 5), (2, 6)], "STATE long, WGTP long")
    other = spark.createDataFrame([(2, 5), (3, 5), (9, 1)], "STATE long, PWGTP long")
    assert rows(surveyed_states(zones, one, other)) == [(1, False), (2, True), (3, False)]
