"""Column scores: rank bins and level sums against numpy."""
import numpy as np
import pytest

from panelforge.operators import quantiles, scoring


def rank_bins(v):
    s = np.sort(v)
    cuts = [s[int(np.floor(i / 10 * (len(s) - 1)))] for i in range(1, 10)]
    return (v[:, None] > np.array(cuts)).sum(1)


def information(x, y):
    joint = np.zeros((10, 10))
    np.add.at(joint, (rank_bins(x), rank_bins(y)), 1)
    p = joint / joint.sum()
    with np.errstate(all="ignore"):
        t = p * np.log(p / np.outer(p.sum(1), p.sum(0)))
    return np.nansum(t)


def test_mutual_information_of_rank_bins_and_one_outlier(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=3000)
    y = x + rng.normal(size=3000)
    ties = rng.integers(0, 4, 3000).astype(float)
    rows = [(float(a), float(t), float(b)) for a, t, b in zip(x, ties, y)]
    holes = [(None, 1.0, 2.0), (3.0, None, 1.0), (5.0, 2.0, None)]
    schema = "x double, t double, y double"

    def mi(data):
        return {r["feature"]: r["mutual_info"] for r in scoring.binned_mutual_info(spark.createDataFrame(data, schema), "y", ["x", "t"]).collect()}
    got = mi(rows + holes)
    both = lambda k: np.array([(r[k], r[2]) for r in rows + holes if r[k] is not None and r[2] is not None])
    assert got["x"] == pytest.approx(information(*both(0).T)) and got["t"] == pytest.approx(information(*both(1).T))
    assert mi(rows + [(1e12, 0.0, 1e15)])["x"] == pytest.approx(mi(rows)["x"], rel=0.01)
    assert mi([(r[0], r[1], float(np.exp(r[2]))) for r in rows])["x"] == pytest.approx(mi(rows)["x"], rel=1e-12)
    assert mi([(None, 1.0, None)]) == {}


def test_cut_points_are_values_of_the_column(spark):
    df = spark.createDataFrame([(float(v % 7), None if v % 2 else float(v)) for v in range(100)], "a double, b double")
    found = quantiles.cut_points(df.withColumn("c", df["b"] * 0 + None), ["a", "b", "c"], 10)
    assert set(found) == {"a", "b"} and len(found["a"]) == 9
    assert found["b"] == [list(range(0, 100, 2))[int(i / 10 * 49)] for i in range(1, 10)]


def test_correlation_ratio_of_large_values(spark):
    rng = np.random.default_rng(1)
    level = rng.choice(list("abc"), 300)
    y = 1e9 + 2.0 * (level == "a") + rng.normal(size=300)
    df = spark.createDataFrame([(str(k), float(v)) for k, v in zip(level, y)] + [(None, 1e9), ("a", None)], "k string, y double")
    got = scoring.categorical_scores(df, "y", ["k"]).first()
    between = sum((level == k).sum() * (y[level == k].mean() - y.mean()) ** 2 for k in "abc")
    assert got["eta"] == pytest.approx(np.sqrt(between / ((y - y.mean()) ** 2).sum()), rel=1e-6)
