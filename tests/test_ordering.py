import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from popflow.operators import ordering


@pytest.fixture(scope="module")
def skewed():
    """Two thirds of the rows in one group, many ties in v."""
    rng = np.random.default_rng(7)
    n = 6000
    group = np.where(rng.random(n) < 0.66, 0, rng.integers(1, 40, n))
    return pd.DataFrame({
        "id": rng.permutation(n), "g": group, "v": rng.integers(0, 50, n).astype(float),
        "w": rng.integers(0, 9, n)})


def test_rank_matches_a_sort(spark, skewed):
    df = spark.createDataFrame(skewed)
    got = ordering.rank_rows(
        df, [F.col("v").desc(), "id"], ["g"], totals={"s": "w"}).toPandas()
    want = skewed.sort_values(["g", "v", "id"], ascending=[True, False, True])
    want["rank"] = want.groupby("g").cumcount() + 1
    want["s"] = want.groupby("g")["w"].transform("sum")
    merged = got.merge(want, on="id", suffixes=("", "_want"))
    assert len(merged) == len(skewed)
    assert (merged["rank"] == merged["rank_want"]).all() and (merged["s"] == merged["s_want"]).all()


def test_rank_without_groups(spark, skewed):
    got = ordering.rank_rows(spark.createDataFrame(skewed), ["v", "id"]).toPandas()
    want = skewed.sort_values(["v", "id"]).reset_index(drop=True)
    assert got.sort_values("rank")["id"].tolist() == want["id"].tolist()
    assert sorted(got["rank"]) == list(range(1, len(skewed) + 1))


def test_a_hot_group_is_spread_over_partitions(spark, skewed):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # too few rows for it
    try:
        placed = ordering._placed(spark.createDataFrame(skewed), ["g"], ["v", "id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot = placed.filter("g = 0").groupBy("__part").count().toPandas()
    assert len(hot) >= 2 and hot["count"].max() < len(skewed) / 2


def test_running_total(spark, skewed):
    got = ordering.running_total(
        spark.createDataFrame(skewed), "w", ["v", "id"], ["g"], "run", "all").toPandas()
    want = skewed.sort_values(["g", "v", "id"])
    want["run"] = want.groupby("g")["w"].cumsum()
    want["all"] = want.groupby("g")["w"].transform("sum")
    merged = got.merge(want, on="id", suffixes=("", "_want"))
    assert (merged["run"] == merged["run_want"]).all()
    assert (merged["all"] == merged["all_want"]).all()


def test_dense_key_is_sorted_and_dense(spark):
    df = spark.createDataFrame(
        [("2019HU10", 1), ("2019HU9", 1), ("2019HU10", 2), ("2019HU10", 1)], "s string, p int")
    got = {(r.s, r.p): r.key for r in ordering.dense_key(df, ["s", "p"]).collect()}
    assert got == {("2019HU10", 1): 1, ("2019HU10", 2): 2, ("2019HU9", 1): 3}


def test_batches(spark):
    df = spark.range(7)
    got = {r.id: r.batch for r in ordering.batch_ids(df, 3, ["id"]).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 1, 4: 1, 5: 1, 6: 2}
    with pytest.raises(ValueError):
        ordering.batch_ids(df, 0, ["id"])


def test_keep_first(spark, rows):
    df = spark.createDataFrame([(1, 12, 7), (1, 11, 8), (2, 21, 9)], "TRACT int, BG int, PUMA int")
    assert rows(ordering.keep_first(df, "TRACT", ["BG"])) == [(1, 11, 8), (2, 21, 9)]


@pytest.mark.parametrize("probs", [(0.25, 0.5, 0.75), (0.0, 0.1, 0.333, 1.0)])
def test_quantiles_match_linear_interpolation(spark, skewed, probs):
    df = spark.createDataFrame(skewed)
    got = ordering.quantile_edges(df, "v", probs, ["g"]).toPandas().set_index("g")["edges"]
    for g, part in skewed.groupby("g"):
        np.testing.assert_allclose(got[g], np.quantile(part["v"], probs))
    whole = ordering.quantile_edges(df, "v", probs).first()["edges"]
    np.testing.assert_allclose(whole, np.quantile(skewed["v"], probs))


def test_quantiles_skip_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "v double")
    assert ordering.quantile_edges(df, "v", (0.5,)).first()["edges"] == [2.0]
