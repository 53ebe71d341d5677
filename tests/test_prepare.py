import pytest

from popflow import specs
from popflow.operators import checks, seeds, targets
from popflow.plans.prepare import prepare_targets

HH = ", ".join(f"{c} {t}" for c, t in specs.PUMS_HH.items())
PER = ", ".join(f"{c} {t}" for c, t in specs.PUMS_PER.items())


def household(serial, puma, st, weight=10, **more):
    row = dict.fromkeys(specs.PUMS_HH, 995) | {
        "SERIALNO": serial, "PUMA": puma, "ST": st, "WGTP": weight, "NP": 2} | more
    return tuple(row.values())


def person(serial, number, puma, st, age, weight=10, **more):
    row = dict.fromkeys(specs.PUMS_PER, 995) | {
        "SERIALNO": serial, "SPORDER": number, "PUMA": puma, "ST": st, "AGEP": age,
        "PWGTP": weight} | more
    return tuple(row.values())


@pytest.fixture
def microdata(spark):
    hh = spark.createDataFrame([
        household("2019HU9", 100, 9), household("2019HU10", 100, 9), household("2019GQ1", 100, 9),
        household("2019HU7", 200, 36), household("2019HU8", 100, 9, HINCP=25000)], HH)
    per = spark.createDataFrame([
        person("2019HU9", 1, 100, 9, 17), person("2019HU9", 2, 100, 9, 18),
        person("2019HU10", 1, 100, 9, 70), person("2019HU7", 1, 200, 36, 40),
        person("2019HU8", 1, 100, 9, 4)], PER)
    return hh, per


def test_seeds(microdata, rows):
    seed = seeds.build_seeds(*microdata, states=[9])
    # Households without persons and of other states are gone; ids follow text order.
    assert rows(seed.households, "hh_id", "SERIALNO", "PUMA", "STATE", "REGION", "NP_ADULTS") == [
        (900100 * 10**8 + 1, "2019HU10", 900100, 9, 1, 1),
        (900100 * 10**8 + 2, "2019HU8", 900100, 9, 1, 0),
        (900100 * 10**8 + 3, "2019HU9", 900100, 9, 1, 1)]
    assert rows(seed.persons, "hh_id", "SPORDER", "AGEP", "PUMA") == [
        (900100 * 10**8 + 1, 1, 70, 900100), (900100 * 10**8 + 2, 1, 4, 900100),
        (900100 * 10**8 + 3, 1, 17, 900100), (900100 * 10**8 + 3, 2, 18, 900100)]
    assert "ST" not in seed.households.columns and "ST" not in seed.persons.columns


def test_adults_joined_by_id(spark, rows):
    hh = spark.createDataFrame([(1,), (2,)], "hh_id long")
    per = spark.createDataFrame([(1, 18), (1, 17), (1, 44)], "hh_id long, AGEP int")
    assert rows(seeds.with_num_adults(hh, per)) == [(1, 2), (2, 0)]


BG = 'NAME string, state string, county string, tract string, `block group` string, f1 long, ' \
     'f2 long, f3 long'


@pytest.fixture
def acs(spark):
    bg = spark.createDataFrame([
        ("a", "09", "001", "000100", "1", 10, None, 4),
        ("b", "09", "001", "000100", "2", 5, 5, 20),
        ("c", "36", "003", "000200", "1", 0, 7, 7)], BG)
    tract = spark.createDataFrame([
        ("t", "09", "001", "000100", 6), ("u", "36", "003", "000300", 1)],
        "NAME string, state string, county string, tract string, g1 long")
    return {"BG": bg, "TRACT": tract}


def test_a_field_may_feed_two_controls(acs, rows):
    out = targets.aggregate_controls(acs["BG"], {"A": ["f1", "f2"], "B": ["f1"]})
    assert rows(out, "A", "B", "f3") == [(7, 0, 7), (10, 5, 20), (10, 10, 4)]
    assert "f1" not in out.columns


def test_remainders_between_geographies(acs, rows):
    tables = {
        "BG": targets.aggregate_controls(acs["BG"], {"T": ["f1", "f2"], "U": ["f3"]}),
        "TRACT": targets.aggregate_controls(acs["TRACT"], {"M": ["g1"]})}
    spec = specs.Remainder("TRACT", ("T",), ("M",))
    out = targets.remainder_control(tables, "NA_", spec)
    # The tract without block groups has no remainder.
    assert {r["tract"]: r["NA_"] for r in out.collect()} == {"000100": 14, "000300": None}
    own = targets.remainder_control(tables, "R", specs.Remainder("BG", ("T",), ("U",)))
    assert rows(own, "NAME", "R") == [("a", 6), ("b", -10), ("c", 0)]
    assert rows(targets.negative_remainders(own, "R", ["NAME"])) == [("b", -10), ("c", 0)]
    with pytest.raises(ValueError, match="no geography holds"):
        targets.remainder_control(tables, "R", specs.Remainder("BG", ("X",), ("U",)))
    with pytest.raises(ValueError, match="does not nest"):
        targets.remainder_control(tables, "R", specs.Remainder("BG", ("T",), ("M",)))


def test_rollup_and_state_totals(acs, rows):
    zones = targets.aggregate_controls(acs["BG"], {"A": ["f1", "f2"], "B": ["f3"]})
    got = {r["state"]: (r["A"], r["B"]) for r in targets.rollup_totals(zones, ["A", "B"]).collect()}
    assert got == {"09": (20, 24), "36": (7, 7), None: (27, 31)}
    tract = targets.aggregate_controls(acs["TRACT"], {"M": ["g1"]})
    states, region = targets.state_and_region_totals({"BG": (zones, ["A"]), "TRACT": (tract, ["M"])})
    assert rows(states, "STATE", "A", "M") == [("09", 20, 6), ("36", 7, 1)]
    assert tuple(region.first()) == (1, 27, 7)


def test_prepared_targets(acs, rows):
    out = prepare_targets(
        acs, {"BG": {"A": ["f1", "f2"], "B": ["f3"]}, "TRACT": {"M": ["g1"]}}, ["09"],
        {"REST": specs.Remainder("BG", ("A",), ("B",))})
    assert rows(out["BG"], "STATE", "COUNTY", "TRACT", "BG", "A", "B", "REST", "REGION") == [
        (9, 9001, 9001000100, 90010001001, 10, 4, 6, 1),
        (9, 9001, 9001000100, 90010001002, 10, 20, -10, 1)]
    assert rows(out["STATE"], "STATE", "A", "B", "M") == [(9, 20, 24, 6)]
    assert "REST" not in out["STATE"].columns and "REST" not in out["REGION"].columns


def test_empty_zones(spark, rows):
    df = spark.createDataFrame([("a", 0, None), ("b", 0, 1), ("c", -1, 1)],
                               "BG string, x long, y long")
    assert rows(targets.drop_empty_zones(df), "BG") == [("b",)]


def test_specs_as_lists_and_maps(spark):
    spec = spark.createDataFrame([
        ("BG", "A", "f2", "int", 0), ("BG", "A", "f1", "int", 1), ("BG", " ", "f9", "int", 2),
        ("TRACT", "M", "g", "str", 3), ("BG", None, "f8", "int", 4), ("BG", "B", "f1", "str", 5)],
        "geography string, control_field string, field string, type string, pos long")
    lists = {(r.geography, r.control_field): r.fields for r in targets.field_lists(spec).collect()}
    assert lists == {("BG", "A"): ["f2", "f1"], ("BG", "B"): ["f1"], ("TRACT", "M"): ["g"]}
    maps = {r.geography: r.types for r in targets.type_maps(spec).collect()}
    assert maps == {"BG": {"f1": "str", "f2": "int"}, "TRACT": {"g": "str"}}


def test_fields_named_by_expressions(spark, rows):
    spec = spark.createDataFrame([
        ("p_a", "(persons.AGEP <= 4) & (persons.PWGTP > 0)"), ("#p_b", "(persons.SEX == 1)"),
        ("p_c", "(persons.SERIALNO != 1)"), ("p_d", "(persons.AGEP > 4)"), ("p_e", "true")],
        "target string, expression string")
    assert rows(targets.expression_fields(spec)) == [("AGEP",)]


def test_seed_groups_report(spark, microdata):
    hh, per = microdata
    report = {r.control_group: r for r in checks.check_seeds(hh, per).collect()}
    assert len(report) == 15
    assert report["h_income"].group_sum == 5 and report["h_income"].ok
    # 995 vehicles are in no class.
    assert report["h_veh"].group_sum == 0 and not report["h_veh"].ok
    assert report["p_mode"].ok and report["p_emp"].group_sum == 5


def test_target_groups_report(spark):
    bg = spark.createDataFrame([(100, 60, 40, 200), (50, 20, 29, 10)],
                               "H_TOTAL long, H_CHILDREN long, H_NO_CHILDREN long, P_TOTAL long")
    report = {r.control_group: (r.group_sum, r.total, r.ok)
              for r in checks.check_targets({"BG": bg}).collect()}
    assert report["h_children"] == (149.0, 150.0, True)
    assert report["p_total"] == (210.0, 210.0, True)


def test_uniqueness_and_differences(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "k int, v string")
    assert tuple(checks.unique_check(df, ["k"]).first()) == (3, 2, False)
    assert tuple(checks.unique_check(df, ["k", "v"]).first()) == (3, 3, True)
    a = spark.createDataFrame([("x",), ("y",)], "f string")
    b = spark.createDataFrame([("y",), ("z",)], "f string")
    assert rows(checks.set_difference(a, b, "f")) == [("x", "left"), ("z", "right")]
