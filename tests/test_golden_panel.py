"""Golden cases for panel, lookup, quantile, scoring and selection operators."""
import math

import pytest
from pyspark.sql import functions as F

from panelforge.operators.lookup import asof_reference, best_per_window, delta_to_price, hydrate
from panelforge.operators.panel import build_segments, missing_months
from panelforge.operators.quantiles import exact_quantiles, quantiles_of
from panelforge.operators.scoring import feature_scores
from panelforge.operators.selection import Trail, apply_overrides, family_rules


def test_future_targets_and_smoothing(spark):
    rows = [(0, 202301, "A", 100.0, 101.0), (1, 202302, "A", 102.0, 103.0), (2, 202303, "A", 104.0, 105.0),
            (3, 202304, "A", 106.0, 107.0)]
    df = spark.createDataFrame(rows, "row_id long, saleYearMonth int, suburb string, current_price_median double, salePrice double")
    seg = build_segments(df, ["suburb"], "saleYearMonth",
                         metrics=[{"name": "current_price_median", "source": "current_price_median", "agg": "mean"}],
                         future_targets=[{"name": "price_future_1m", "source": "salePrice", "agg": "mean", "horizon": 1,
                                          "window": 1, "smooth": {"window": 2, "min_periods": 1}}])
    r = seg.orderBy("saleYearMonth").collect()
    assert [x["price_future_1m"] for x in r] == [103.0, 105.0, 107.0, None]
    assert [x["price_future_1m_diff"] for x in r] == [3.0, 3.0, 3.0, None]
    assert [x["price_future_1m_smooth"] for x in r] == [103.0, 104.0, 106.0, 107.0]
    assert {"price_future_1m_delta", "price_future_1m_smooth_delta", "price_future_1m_smooth_diff",
            "observingYearMonth"} <= set(seg.columns)


def test_carry_and_activity_filter(spark):
    rows = [(0, "A", 202301, "r1", 1.0), (1, "A", 202301, None, 2.0), (2, "A", 202302, "r1", 3.0),
            (3, "B", 202301, "x", 4.0), (4, "B", 202301, "y", 5.0)]
    df = spark.createDataFrame(rows, "row_id long, g string, ym int, region string, v double")
    seg = build_segments(df, ["g"], "ym", metrics=[{"name": "m", "source": "v", "agg": "mean"}],
                         carry={"columns": ["region"], "max_unique": 2}, min_months=2)
    out = {(r["g"], r["ym"]): r for r in seg.collect()}
    assert set(out) == {("A", 202301), ("A", 202302)}          # B has one month only
    assert out[("A", 202301)]["region"] == "r1"                 # first non-NULL value


def test_missing_months(spark):
    df = spark.createDataFrame([("A", 202211), ("A", 202302), ("B", 202301), ("B", 202302)], "g string, saleYearMonth int")
    r = missing_months(df, ["g"]).collect()
    assert len(r) == 1 and r[0]["g"] == "A"
    assert r[0]["missing_months"] == [202212, 202301]
    assert r[0]["total_months_span"] == 4 and r[0]["months_with_data"] == 2


def test_asof_lookup_exact_prior_latest_and_fallback(spark):
    store = spark.createDataFrame(
        [(0, "Mitcham", 202301, "House", 10.0), (1, "Mitcham", 202303, "House", 30.0),
         (2, "Mitcham", 202303, "House", 31.0), (3, "Mitcham", 202302, "Unit", 20.0)],
        "row_id long, suburb string, saleYearMonth int, propertyType string, v double")
    req = spark.createDataFrame(
        [(1, " mitcham", 202303, "House"), (2, "MITCHAM", 202302, "House"), (3, "Mitcham", 202212, "House"),
         (4, "Mitcham", 202305, "Flat"), (5, "Nowhere", 202301, "House")],
        "request_id long, suburb string, saleYearMonth int, propertyType string")
    out = {r["request_id"]: r["v"] for r in asof_reference(req, store, ["v"], filters=["propertyType"]).collect()}
    assert out[1] == 31.0          # exact month, last row of that month
    assert out[2] == 10.0          # latest earlier month among matching rows
    assert out[3] == 31.0          # nothing earlier: latest overall
    assert out[4] == 31.0          # no row matches the filter: suburb-only candidates
    assert out[5] is None


def test_hydrate_only_nulls(spark):
    req = spark.createDataFrame([(1, None), (2, 5.0)], "request_id long, v double")
    ref = spark.createDataFrame([(1, 9.0), (2, 9.0)], "request_id long, v double")
    assert {r["request_id"]: r["v"] for r in hydrate(req, ref, ["v"]).collect()} == {1: 9.0, 2: 5.0}


def test_delta_to_price(spark):
    df = spark.createDataFrame([(0.05, 1000.0, None)], "raw double, b1 double, b2 double")
    r = df.select(delta_to_price(F.col("raw"), [F.col("b2"), F.col("b1")], True).alias("p")).first()
    assert math.isclose(r["p"], 1050.0)


def test_best_per_window(spark):
    rows = [("price_future_12m_alpha", "price_future_12m_delta", "12m", 0.9, 0),
            ("price_future_12m_beta", "price_future_12m_delta", "12m", 0.4, 1)]
    df = spark.createDataFrame(rows, "name string, target string, forecast_window string, val_r2 double, ord long")
    r = best_per_window(df).collect()
    assert len(r) == 1 and r[0]["name"] == "price_future_12m_alpha"


def test_exact_quantiles_match_interpolation(spark):
    import numpy as np
    vals = [float(x) for x in np.random.default_rng(3).normal(100, 20, 5000).round(2)] + [100.0] * 2000
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = exact_quantiles(df, "x", [0.25, 0.5, 0.75])
    want = list(np.quantile(np.array(vals), [0.25, 0.5, 0.75]))
    assert all(math.isclose(a, b, rel_tol=0, abs_tol=1e-9) for a, b in zip(got, want))
    assert quantiles_of(df.where("x > 1e9"), {"x": [0.5]})["x"] == [None]


def test_feature_scores_ranges_and_exclusion(spark):
    rows = [(100000, 2, 1, "House"), (120000, 3, 2, "Unit"), (150000, 3, 2, "House"), (200000, 4, 3, "House"),
            (210000, 5, 3, "Unit")]
    df = spark.createDataFrame(rows, "target int, bed int, bath int, propertyType string")
    sc = {r["feature"]: r for r in feature_scores(df, "target", exclude=["bath"]).collect()}
    assert set(sc) == {"bed", "propertyType"}
    assert 0 <= sc["bed"]["pearson_abs"] <= 1 and 0 <= sc["bed"]["mutual_info"] <= 1
    assert 0 <= sc["propertyType"]["eta"] <= 1


def test_overrides_and_family_rules():
    assert apply_overrides(["a", "b", "c"], include=["x"], exclude=["b"]) == ["x", "a", "c"]
    t = Trail(["a", "b", "c"])
    assert family_rules(["a", "b", "c"], t, {"fam": {"columns": ["a", "b"], "keep": ["b"]}}, []) == ["b", "c"]
    assert t.selected["a"] is False and "dropped: family(fam)" in t.reason["a"]


def test_future_target_calendar_option(spark):
    rows = [(0, 202301, "A", 100.0), (1, 202302, "A", 110.0), (2, 202304, "A", 130.0)]
    df = spark.createDataFrame(rows, "row_id long, saleYearMonth int, suburb string, salePrice double")
    spec = {"name": "f1", "source": "salePrice", "agg": "mean", "horizon": 1, "window": 1, "derived": [{"type": "copy"}]}
    obs = {r["saleYearMonth"]: r["f1"] for r in build_segments(df, ["suburb"], future_targets=[spec]).collect()}
    cal = {r["saleYearMonth"]: r["f1"] for r in
           build_segments(df, ["suburb"], future_targets=[dict(spec, calendar=True)]).collect()}
    assert obs == {202301: 110.0, 202302: 130.0, 202304: None}     # next observed month
    assert cal == {202301: 110.0, 202302: None, 202304: None}      # next calendar month


def test_scores_constant_column_and_single_level(spark):
    rows = [(float(i * 10), 5.0, "only", "a" if i % 2 else "b") for i in range(20)]
    df = spark.createDataFrame(rows, "y double, const double, one string, two string")
    sc = {r["feature"]: r for r in feature_scores(df, "y").collect()}
    assert sc["const"]["pearson_abs"] is None and sc["const"]["bic_improvement"] == 0.0
    assert sc["one"]["bic_improvement"] == 0.0 and sc["one"]["eta"] == 0.0
    assert sc["two"]["eta"] is not None and sc["two"]["best_metric"] in ("eta", "bic_improvement")


def test_registry_resolves_alias_reference_and_path(spark, tmp_path):
    from panelforge.sources.files import Registry
    df = spark.createDataFrame([(1,)], "a int")
    p = str(tmp_path / "t.parquet")
    df.write.parquet(p)
    reg = Registry(spark, {"x": df, "y": "{x}", "z": p})
    assert reg.resolve("{y}").count() == 1 and reg.resolve("z").count() == 1 and reg.resolve(p).count() == 1


def test_carry_prefix_auto_detect_and_mixed(spark):
    rows = [(0, "A", 202301, "x", "p1", 1.0), (1, "A", 202301, "y", "p1", 2.0), (2, "A", 202302, "x", None, 3.0)]
    df = spark.createDataFrame(rows, "row_id long, g string, ym int, mixed string, geo_code string, v double")
    m = [{"name": "m", "source": "v", "agg": "mean"}]
    seg = build_segments(df, ["g"], "ym", metrics=m, carry={"prefixes": ["geo_"]})
    assert "geo_code" in seg.columns and "mixed" not in seg.columns
    seg2 = build_segments(df, ["g"], "ym", metrics=m, carry={"auto_detect": True})
    assert "mixed" not in seg2.columns and "geo_code" in seg2.columns      # 'mixed' has 2 values in a group
    seg3 = build_segments(df, ["g"], "ym", metrics=m, carry={"auto_detect": True, "allow_mixed": True})
    got = {r["ym"]: r["mixed"] for r in seg3.collect()}
    assert got == {202301: "x", 202302: "x"}                                # first non-NULL in row order


def test_select_targets_modes(spark):
    from panelforge.operators.lookup import select_targets
    rows = [("a", "t1", "20250101_000000", 0.5, 0), ("b", "t1", "20250102_000000", 0.4, 1),
            ("c", "t2", "20250101_000000", 0.9, 2)]
    rep = spark.createDataFrame(rows, "name string, target string, timestamp string, val_r2 double, ord long")
    assert select_targets(rep, "best").first()["name"] == "c"
    assert {r["name"] for r in select_targets(rep, "latest").collect()} == {"b", "c"}
    assert {r["name"] for r in select_targets(rep, "named", ["t2"]).collect()} == {"c"}
    assert select_targets(rep, "all").count() == 3


def test_select_for_targets_merges_config(spark):
    from panelforge.operators.selection import select_for_targets
    rows = [(float(i), float(2 * i + (i % 3)), float(i % 5), float(-i)) for i in range(60)]
    df = spark.createDataFrame(rows, "x double, t1 double, noise double, t2 double")
    res = select_for_targets(df, {"threshold": 0.5, "include": ["noise"]},
                             {"t1": {"exclude": ["x"]}, "t2": {}})
    assert set(res) == {"t1", "t2"}
    assert "x" not in res["t1"][0] and "noise" in res["t1"][0]
    assert "x" in res["t2"][0] and "t1" not in res["t2"][0]
