import pytest
from pyspark.sql import functions as F
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from popflow import session
from popflow.sources import census, files, listing, microdata
from popflow.specs import INPUT_RENAMES


def test_json_tables_and_rejoin(spark, tmp_path, rows):
    (tmp_path / "a.json").write_text('[["NAME","f1","state"],["x","1","09"],["y",null,"36"]]')
    (tmp_path / "b.json").write_text('[["NAME","f2","state"],["x","2","09"],\n["z","3","36"]]')
    a = census.read_json_table(spark, str(tmp_path / "a.json"),
                               {"NAME": "string", "f1": "bigint", "state": "string"})
    b = census.read_json_table(spark, str(tmp_path / "b.json"),
                               {"NAME": "string", "f2": "bigint", "state": "string"})
    assert {tuple(r) for r in a.collect()} == {("x", 1, "09"), ("y", None, "36")}
    joined = census.natural_rejoin([a, b])
    assert rows(joined, "NAME", "state", "f1", "f2") == [("x", "09", 1, 2)]
    with pytest.raises(ValueError, match="no columns in common"):
        census.natural_rejoin([a.select("f1"), b.select("f2")])
    bad = census.read_json_table(spark, str(tmp_path / "a.json"), {"NAME": "bigint"})
    with pytest.raises(PySparkException):
        bad.collect()
    absent = census.read_json_table(spark, str(tmp_path / "a.json"), {"NAME": "string",
                                                                      "f9": "bigint"})
    with pytest.raises(PySparkException, match="f9"):
        absent.collect()


def test_column_groups():
    assert census.field_chunks(["a", "b", "c", "k"], 2, ["k"]) == [["a", "b", "k"], ["c", "k"]]
    with pytest.raises(ValueError):
        census.field_chunks(["a"], 0)


def test_projection_and_casts(spark):
    df = spark.createDataFrame([("1", "2", "3")], "b string, z string, a string")
    assert census.extras_first(df, ["z"]).columns == ["a", "b", "z"]
    assert dict(census.cast_columns(df, {"a": "bigint", "q": "int"}).dtypes)["a"] == "bigint"


def test_best_effort_numbers(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "x", None, 5), ("02", None, "3", None, 6)],
        "i string, d string, s string, n string, k int")
    got = census.best_effort_numeric(df)
    assert got.dtypes == [("i", "bigint"), ("d", "double"), ("s", "string"), ("n", "bigint"),
                          ("k", "int")]
    assert {r.i for r in got.collect()} == {1, 2}


def test_microdata_csv(spark, tmp_path):
    (tmp_path / "h.csv").write_text(
        "RT,SERIALNO,WGTP,ST,EXTRA\nH,2019HU1,5,09,zz\nH,,,36,\n")
    fields = {"SERIALNO": "string", "ST": "bigint", "WGTP": "bigint"}
    got = microdata.read_microdata(spark, str(tmp_path), fields)
    assert {tuple(r) for r in got.collect()} == {("2019HU1", 9, 5), ("995", 36, 995)}
    with pytest.raises(ValueError, match="NOPE"):
        microdata.read_microdata(spark, str(tmp_path), {"NOPE": "bigint"})


def test_files_with_other_column_orders(spark, tmp_path):
    (tmp_path / "a.csv").write_text("WGTP,ST\n5,9\n")
    (tmp_path / "b.csv").write_text("ST,WGTP\n36,7\n")
    fields = {"ST": "bigint", "WGTP": "bigint"}
    paths = [str(tmp_path / n) for n in ("a.csv", "b.csv")]
    got = microdata.read_microdata(spark, paths, fields)
    assert {tuple(r) for r in got.collect()} == {(9, 5), (36, 7)}
    # One path with both: the job stops instead of binding by position.
    with pytest.raises((PySparkException, Py4JJavaError)):
        microdata.read_microdata(spark, str(tmp_path), fields).collect()


def test_cache_grows_by_state_and_rebuilds_on_new_columns(spark, tmp_path):
    path = str(tmp_path / "cache")
    first = spark.createDataFrame([(9, 1), (9, 2)], "ST int, x int")
    assert microdata.append_states(spark, first, path, cached=False).count() == 2
    more = spark.createDataFrame([(9, 7), (36, 3)], "ST int, x int")
    for _ in range(2):  # a repeated run adds nothing
        got = microdata.append_states(spark, more, path)
        assert {tuple(r) for r in got.select("ST", "x").collect()} == {(9, 1), (9, 2), (36, 3)}
    wider = spark.createDataFrame([(9, 1, 5)], "ST int, x int, y int")
    with pytest.raises(ValueError, match="36"):
        microdata.append_states(spark, wider, path)
    assert microdata.read_cache(spark, path).count() == 3
    both = spark.createDataFrame([(9, 1, 5), (36, 3, 6)], "ST int, x int, y int")
    got = microdata.append_states(spark, both, path)
    assert {tuple(r) for r in got.select("ST", "x", "y").collect()} == {(9, 1, 5), (36, 3, 6)}
    assert microdata.read_cache(spark, path, 2).count() == 3  # the version before
    assert microdata.drop_versions(spark, path) == 2
    assert microdata.read_cache(spark, path).count() == 2
    assert len(list((tmp_path / "cache" / "parts").iterdir())) == 1


def test_a_stopped_job_leaves_the_cache_as_it_was(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "cache")
    first = spark.createDataFrame([(9, 1)], "ST int, x int")
    microdata.append_states(spark, first, path, cached=False)
    # The part is written, its version is not.
    (tmp_path / "cache" / "versions" / "2").mkdir()
    first.withColumn("x", F.lit(7)).write.partitionBy("ST").parquet(f"{path}/parts/part=stopped")
    assert [tuple(r) for r in microdata.read_cache(spark, path).select("ST", "x").collect()] == [(9, 1)]
    more = spark.createDataFrame([(36, 3)], "ST int, x int")
    got = microdata.append_states(spark, more, path)
    assert {tuple(r) for r in got.select("ST", "x").collect()} == {(9, 1), (36, 3)}
    with pytest.raises(ValueError, match="no cache"):
        microdata.read_cache(spark, str(tmp_path / "none"))


def test_coverage(spark):
    have = spark.createDataFrame([("09", 1)], "state string, f1 int")
    want = spark.createDataFrame([("09",), ("36",)], "state string")
    got = microdata.coverage(have, want, "state", ["f1", "f2"]).first()
    assert tuple(got) == (1, ["f2"], False)
    assert microdata.coverage(have, want.limit(1), "state", ["f1"]).first().complete


def test_combined_states(spark, tmp_path):
    for state, body in {"CT": "hh_id,WGTP\n1,5\n2,6\n", "NY": "WGTP,hh_id\n7,3\n",
                        "ZZ": "hh_id,WGTP\n9,9\n"}.items():
        (tmp_path / state).mkdir()
        (tmp_path / state / "seed_households.csv").write_text(body)
    (tmp_path / "DC").mkdir()
    got, missing = files.combine_states(
        spark, str(tmp_path), "seed_households.csv", ["CT", "NY", "DC"])
    assert {tuple(r) for r in got.collect()} == {(1, 5), (2, 6), (3, 7)}
    assert [r[0] for r in missing.collect()] == ["DC"]


def test_summaries_inputs_and_outputs(spark, tmp_path):
    (tmp_path / "final_summary_BG.csv").write_text("id,t_control,t_result\n1,4,5\n")
    got = files.read_summaries(spark, str(tmp_path), ["BG"])["BG"]
    assert tuple(got.first()) == (1, 4.0, 5.0)
    for name in files.INPUT_FILES.values():
        (tmp_path / name).write_text("hhnum,NAME\n1,n\n")
    tables = files.read_inputs(spark, str(tmp_path))
    assert set(tables) == set(files.INPUT_FILES)
    assert tables["BG"].dtypes == [("hhnum", "bigint"), ("NAME", "string")]
    assert files.map_inputs(tables["BG"]).columns == ["hh_id", "NAME"]
    assert INPUT_RENAMES["SPORDER"] == "per_num"
    df = spark.createDataFrame([(9, 1), (36, 2)], "STATE int, x int")
    files.write_tables({"seeds": df}, str(tmp_path / "out"), "STATE")
    assert (tmp_path / "out" / "seeds" / "STATE=36").exists()
    with pytest.raises(PySparkException):
        files.write_csv(df, str(tmp_path / "out" / "seeds"))


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3,)], "x int")
    assert {tuple(r) for r in files.union_tables([a, b]).collect()} == {(1, 2), (3, None)}


def test_listings(spark):
    page = spark.createDataFrame([("https://h", """
        <a href="../">up</a> <a name="k">k</a> <a href="tl_2021_09_bg.zip">a</a>
        <a href="tl_2021_36_bg.zip">b</a> <a href="tl_2021_09_bg.txt">c</a> <a href="odd.zip">d</a>
        <a href="csv_hct.zip">e</a> <a href="csv_pct.zip">f</a> <a href="csv_hny.zip">g</a>""")],
        "url string, html string")
    found = listing.links(page)
    got = listing.geography_files(found, ["09"], "raw").collect()
    assert [tuple(r) for r in got] == [
        ("09", "raw/tl_2021_09_bg.zip", "https://h/tl_2021_09_bg.zip", "bg")]
    lookup = listing.state_lookup(spark)
    made = listing.microdata_files(found, lookup, ["CT"], "raw")
    assert {(r.fips, r.path, r.level) for r in made.collect()} == {
        ("09", "raw/csv_hct.zip", "hh"), ("09", "raw/csv_pct.zip", "per")}
    wrong = spark.createDataFrame([("u", "csv_xct.zip")], "url string, href string")
    with pytest.raises(PySparkException, match="unknown level"):
        listing.microdata_files(wrong, lookup, ["CT"], "raw").collect()
    assert spark.range(1).select(listing.state_abbr(
        __import__("pyspark.sql.functions", fromlist=["lit"]).lit("99"))).first()[0] == "Unknown"


def test_shared_folder(spark, tmp_path):
    class Conf:
        def get(self, key, default=None):
            return str(tmp_path / "named") if key == "spark.checkpoint.dir" else default

    class Named:
        conf = Conf()

    assert session.shared_folder(Named()) == str(tmp_path / "named")

    class Cluster:
        conf = type("Unset", (), {"get": lambda self, key, default=None: default})()
        sparkContext = type("Context", (), {
            "master": "yarn", "getCheckpointDir": lambda self: None})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Cluster())


def test_cut_tables_have_no_lineage(spark):
    df = session.cut(spark.range(3))
    assert df.count() == 3
    assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert session.release(spark) >= 1


def test_missing_keys_joins_distinct_keys_only(spark, rows):
    """A state of millions of rows reaches the join as one row a task, not as all of them."""
    cached = spark.range(4000).select((F.col("id") % 2).alias("ST"))
    wanted = spark.createDataFrame([(1,), (3,), (3,)], "ST long")
    missing = microdata.missing_keys(cached, wanted, "ST")
    assert rows(missing) == [(3,)]
    plan = missing._jdf.queryExecution().analyzed().toString()
    assert plan.count("Join LeftAnti") == 1 and plan.count("Deduplicate") == 2, plan
