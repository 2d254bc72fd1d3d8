"""Golden cases for scoring preparation (F12) and the seasonal autoregression (F14)."""
import math

import numpy as np
from pyspark.sql import functions as F

from panelforge.operators.lookup import prepare_requests
from panelforge.operators.modelling import fit_seasonal_ar, forecast_seasonal_ar, fold_masks, n_splits_for


def test_prepare_requests_metadata_order_and_imputation(spark):
    req = spark.createDataFrame(
        [(1, 202506, "Mitcham", 4, 3, 2, 500.0, 220.0, "House", 2000),
         (2, 202501, "Mitcham", 3, 2, 1, None, None, "Unit", None)],
        "request_id long, saleYearMonth int, suburb string, bed int, bath int, car int, landSize double, "
        "floorSize double, propertyType string, yearBuilt int")
    store = spark.createDataFrame([(0, "Mitcham", 202412, 410.0)], "row_id long, suburb string, saleYearMonth int, landSizeM2 double")
    meta = {"impute": {"numeric": {"bed": 3, "bath": 2, "car": 1, "landSizeM2": 400.0, "floorSizeM2": 180.0,
                                   "propertyAge": 20.0, "saleYearMonth": 202501},
                       "categorical": {"propertyType": "House", "propertyAgeBand": "6-20"}},
            "bands": {"propertyAgeBand": {"source": "propertyAge", "edges": [5, 20], "labels": ["0-5", "6-20", "21+"]}},
            "columns": ["saleYearMonth", "bed", "bath", "car", "landSizeM2", "floorSizeM2", "propertyAge",
                        "propertyType", "propertyAgeBand"]}
    out = prepare_requests(req, store, meta, aliases={"landSize": "landSizeM2", "floorSize": "floorSizeM2"},
                           reference_columns=["landSizeM2"])
    rows = {r["request_id"]: r for r in out.collect()}
    assert out.columns == ["request_id"] + meta["columns"]
    assert len(rows) == 2
    assert rows[1]["propertyAge"] == 25.0 and rows[1]["propertyAgeBand"] == "21+"
    assert rows[2]["landSizeM2"] == 410.0            # hydrated from the as-of store row
    assert rows[2]["floorSizeM2"] == 180.0 and rows[2]["propertyAge"] == 20.0
    assert all(rows[2][c] is not None for c in ["bed", "bath", "car", "landSizeM2", "floorSizeM2", "propertyAge"])


def test_seasonal_autoregression_forecast(spark):
    rng = np.random.default_rng(0)
    t = np.arange(60)
    y = np.linspace(100, 140, 60) + 5 * np.sin(2 * np.pi * t / 30) + rng.normal(0, 0.5, 60)
    x1, x2 = rng.normal(0, 1, 60), rng.normal(0, 1, 60)
    rows = [("s", int(i), float(y[i]), float(x1[i]), float(x2[i])) for i in t]
    df = spark.createDataFrame(rows, "g string, t long, y double, x1 double, x2 double")
    train = df.where(F.col("t") < 45)
    model = fit_seasonal_ar(train, ["g"], "t", "y", p=2, seasonal=12, seasonal_p=1, exog=["x1", "x2"])
    fc = forecast_seasonal_ar(model, train, ["g"], "t", "y", horizon=15, p=2, seasonal=12, seasonal_p=1,
                              exog=["x1", "x2"], future_exog=df.where(F.col("t") >= 45)).collect()
    assert len(fc) == 15 and all(math.isfinite(r["forecast"]) for r in fc)
    assert sorted(r["step_ordinal"] for r in fc) == list(range(45, 60))


def test_expanding_folds():
    assert n_splits_for(10) == 2 and n_splits_for(300) == 2 and n_splits_for(6000) == 5
    folds = fold_masks(600, 5)
    assert folds[0] == (100, 200) and folds[-1] == (500, 600)
