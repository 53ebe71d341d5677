import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from popflow import specs
from popflow.functions import columns, text
from popflow.functions.geoid import compose_geoids, pad_concat, zfill

IDS = "STATE string, COUNTY string, TRACT string, BG string, PUMA string"


def test_compose_geoids_keeps_leading_zero_parts(spark):
    df = spark.createDataFrame([("09", "001", "000150", "2", "00701")], IDS)
    assert tuple(compose_geoids(df).first()) == (9, 9001, 9001000150, 90010001502, 900701)


def test_compose_geoids_twice_changes_nothing(spark):
    df = spark.createDataFrame(
        [("48", "453", "001904", "1", "05303"), ("01", "003", "010100", "3", "02600")], IDS)
    once = compose_geoids(df)
    assert compose_geoids(once).collect() == once.collect()


def test_compose_geoids_uses_the_last_digits(spark):
    df = spark.createDataFrame([(9, 1234567)], "STATE int, PUMA long")
    assert compose_geoids(df).first()["PUMA"] == 934567


def test_compose_geoids_rejects_missing_parts(spark):
    df = spark.createDataFrame([(9, None)], "STATE int, PUMA long")
    with pytest.raises(PySparkException, match="PUMA has missing values"):
        compose_geoids(df).collect()
    with pytest.raises(ValueError, match="needs the columns"):
        compose_geoids(spark.createDataFrame([(1,)], "TRACT int"))
    with pytest.raises(ValueError, match="no geoid columns"):
        compose_geoids(spark.createDataFrame([(1,)], "x int"))


def test_padding_keeps_longer_values(spark):
    df = spark.createDataFrame([(6, 100), (36, 123456)], "ST int, PUMA int")
    assert [r[0] for r in df.select(pad_concat({"ST": 2, "PUMA": 5})).collect()] == [
        "0600100", "36123456"]
    assert df.select(zfill("PUMA", 2)).first()[0] == "100"


def test_sums_and_rounding(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a long, b long")
    assert [r[0] for r in df.selectExpr(columns.null_skipping_sum(["a", "b"])).collect()] == [1, 0]
    assert [r[0] for r in df.selectExpr(
        columns.null_skipping_sum(["a", "b"], 1)).collect()] == [2, 2]
    halves = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,)], "x double")
    assert [r[0] for r in halves.selectExpr(columns.round_to_long("x")).collect()] == [0, 2, 2, 0]
    gap = spark.createDataFrame([(None,)], "x double")
    with pytest.raises(PySparkException, match="cannot round a null"):
        gap.selectExpr(columns.round_to_long("x")).collect()


def test_ratio_and_closeness(spark):
    df = spark.createDataFrame([(3, 4), (1, 0), (None, 2)], "a long, b long")
    assert [r[0] for r in df.select(columns.ratio("a", "b")).collect()] == [0.75, None, None]
    near = spark.createDataFrame([(99.0, 100.0), (98.9, 100.0), (0.0, 0.0)], "a double, b double")
    assert [r[0] for r in near.select(columns.is_close("a", "b", 0.01)).collect()] == [
        True, False, True]


def test_text_helpers(spark):
    df = spark.createDataFrame(
        [("(persons.AGEP <= 4) & (persons.PWGTP > 0)",), ("persons['X'] == 1",),
         ("x.\"B\" >= 2",)], "e string")
    assert [r[0] for r in df.select(text.first_field("e")).collect()] == ["AGEP", None, "B"]
    names = spark.createDataFrame(
        [("tl_2021_09_bg.zip",), ("a.b/c",), (".profile",), ("x.tar.gz",)], "n string")
    assert [r[0] for r in names.select(text.strip_extension("n")).collect()] == [
        "tl_2021_09_bg", "a.b/c", ".profile", "x.tar"]
    assert names.select(text.name_piece("n", 3)).first()[0] == "09"
    assert names.select(text.name_piece("n", 9)).first()[0] is None
    page = spark.createDataFrame(
        [('<a href="x.zip">1</a><A class="k" HREF = "y.txt">2</A><a name="z">3</a>',)], "h string")
    assert page.select(text.hrefs("h")).first()[0] == ["x.zip", "y.txt"]


def test_control_catalog():
    assert len(specs.CONTROLS) == 57
    assert len({c.control_group for c in specs.CONTROLS}) == 15
    assert len(specs.HOUSEHOLD_CONTROLS) == 32 and len(specs.PERSON_CONTROLS) == 25
    assert sum(c.geography == "TRACT" for c in specs.CONTROLS) == 5
    assert {c.target: c.importance for c in specs.CONTROLS if c.importance > 1000} == {
        "h_total": 100000, "p_total": 100000}
    published = set(specs.ESTIMATED_VARIABLES) | set(specs.REMAINDERS)
    assert published == {c.control_field for c in specs.CONTROLS}
    assert len(specs.ESTIMATED_VARIABLES) == 54
    assert len(specs.STATES) == 51 and specs.STATE_ABBR["11"] == "DC"
    assert set(specs.CONTROL_ORDER) >= published


@pytest.mark.parametrize("target, columns_, hits", [
    ("p_age_0_4", "AGEP", {4: True, 5: False}),
    ("p_age_5_17", "AGEP", {4: False, 5: True, 17: True, 18: False}),
    ("p_age_65plus", "AGEP", {64: False, 65: True}),
    ("h_income_0_25", "HINCP", {25000: True, 25001: False, 995: True, -5: True}),
    ("h_income_25_50", "HINCP", {25000: False, 25001: True, 50000: True}),
    ("p_hispanic", "HISP", {1: False, 2: True, None: True}),
    ("p_race_other", "RAC1P", {6: False, 3: True, None: True}),
    ("p_mode_na", "JWTRNS", {995: True, None: True, 1: False}),
    ("h_children", "HUPAC", {4: False, 995: True, None: True}),
    ("p_non_university", "SCHG", {15: False, 16: False, 14: True, None: True}),
])
def test_control_predicates(spark, target, columns_, hits):
    control = next(c for c in specs.CONTROLS if c.target == target)
    df = spark.createDataFrame([(v, 5) for v in hits], f"{columns_} int, {control.weight} int")
    got = [r[0] for r in df.select(F.expr(control.expression)).collect()]
    assert got == list(hits.values())


def test_controls_need_a_finite_positive_weight(spark):
    control = next(c for c in specs.CONTROLS if c.target == "h_total")
    df = spark.createDataFrame(
        [(1.0,), (0.0,), (-1.0,), (float("inf"),), (None,)], "WGTP double")
    assert [r[0] for r in df.select(F.expr(control.expression)).collect()] == [
        True, False, False, False, False]


def test_tenure_four_counts_as_payment_without_mortgage(spark):
    df = spark.createDataFrame([(4, 995, 995, 1), (4, 995, 700, 1), (3, 995, 995, 1)],
                               "TEN int, SMOCP int, GRNTP int, WGTP int")
    by = {c.target: c.expression for c in specs.HOUSEHOLD_CONTROLS}
    got = df.selectExpr(f"{by['h_no_mortgage_800_1499']} a", f"{by['h_rent_0_799']} b",
                        f"{by['h_rent_800_1249']} c").collect()
    assert [tuple(r) for r in got] == [
        (True, False, False), (True, True, False), (False, False, True)]
