"""Registered queries: modelling, promotion, as-of lookup and scoring (MOD-*, PRO-*, PRE-01..04, JON-07/08, AGG-16)."""
from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.functions.dates import month_ordinal
from panelforge.functions.nulls import rnd
from panelforge.operators import modelling as M
from panelforge.operators.groups import grouped
from panelforge.operators.lookup import (asof_reference, best_per_window, delta_to_price, hydrate, prepare_requests,
                                         select_targets, with_interval)
from panelforge.plans.registry import query
from panelforge.plans.sqlkit import R, sales_with
from panelforge.plans.views import sales


def model_input(spark, sf_dir):
    s = sales(spark, sf_dir)
    return s.select("row_id", "saleYearMonth", "salePrice", "landSizeM2", "yearBuilt",
                    F.month("saleDate").cast("double").alias("saleMonth"), "propertyType", "region", "street")


@query("mod_01_month_split_counts", sales_with() + """
SELECT (SELECT max(saleYearMonth) FROM sales) AS validation_month,
  (SELECT count(*) FROM sales WHERE saleYearMonth < (SELECT max(saleYearMonth) FROM sales)) AS train_rows,
  (SELECT count(*) FROM sales WHERE saleYearMonth = (SELECT max(saleYearMonth) FROM sales)) AS validation_rows""")
def mod_01(spark, sf_dir):
    df = model_input(spark, sf_dir)
    tr, va, v = M.month_split(df, "saleYearMonth")
    return df.limit(1).select(F.lit(v).alias("validation_month"), tr.select(F.count(F.lit(1))).scalar().alias("train_rows"),
                              va.select(F.count(F.lit(1))).scalar().alias("validation_rows"))


_FOLDS_SQL = sales_with("""tr AS (SELECT *, row_number() OVER (ORDER BY saleYearMonth, row_id) - 1 AS pos FROM sales
   WHERE saleYearMonth < (SELECT max(saleYearMonth) FROM sales)),
n AS (SELECT count(*) AS n, CASE WHEN count(*) <= 10 THEN 2 ELSE least(5, greatest(2, count(*) // 120)) END AS k FROM tr),
f AS (SELECT unnest(range(1, k + 1)) AS fold, n, k, n // (k + 1) AS ts FROM n),
b AS (SELECT fold, n - (k - fold + 1) * ts AS s, n - (k - fold + 1) * ts + ts AS e FROM f)""")


@query("mod_02_expanding_fold_sizes", _FOLDS_SQL + """
SELECT CAST(fold AS INTEGER) AS fold, CAST(s AS BIGINT) AS train_rows, CAST(e - s AS BIGINT) AS test_rows,
  (SELECT min(saleYearMonth) FROM tr WHERE pos >= s AND pos < e) AS test_first_month,
  (SELECT max(saleYearMonth) FROM tr WHERE pos >= s AND pos < e) AS test_last_month FROM b""")
def mod_02(spark, sf_dir):
    df = model_input(spark, sf_dir)
    tr, _, _ = M.month_split(df, "saleYearMonth")
    pos = M.with_positions(tr, "saleYearMonth")
    n = tr.count()
    folds = M.fold_masks(n, M.n_splits_for(n))
    parts = []
    for i, (s, e) in enumerate(folds, start=1):
        t = pos.where((F.col("__pos") >= s) & (F.col("__pos") < e))
        parts.append(t.agg(F.lit(i).alias("fold"), F.lit(s).cast("bigint").alias("train_rows"),
                           F.count(F.lit(1)).alias("test_rows"), F.min("saleYearMonth").alias("test_first_month"),
                           F.max("saleYearMonth").alias("test_last_month")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("agg_16_impute_table", sales_with("""m AS (SELECT propertyType AS v, count(*) AS c FROM sales GROUP BY 1),
st AS (SELECT street AS v, count(*) AS c FROM sales GROUP BY 1)""") + """
SELECT 'landSizeM2' AS feature, 'numeric' AS kind, CAST(coalesce(median(landSizeM2), 0.0) AS VARCHAR) AS value FROM sales
UNION ALL SELECT 'yearBuilt', 'numeric', CAST(coalesce(median(CAST(yearBuilt AS DOUBLE)), 0.0) AS VARCHAR) FROM sales
UNION ALL SELECT 'propertyType', 'categorical', (SELECT v FROM m ORDER BY c DESC, v LIMIT 1)
UNION ALL SELECT 'street', 'categorical', (SELECT v FROM st ORDER BY c DESC, v LIMIT 1)""")
def agg_16(spark, sf_dir):
    return M.impute_table(model_input(spark, sf_dir), ["landSizeM2", "yearBuilt"], ["propertyType", "street"])


@query("mod_04_linear_regression_coefficients", sales_with() + f"""
SELECT {R('regr_intercept(salePrice, yearBuilt)', 4)} AS intercept, {R('regr_slope(salePrice, yearBuilt)', 4)} AS slope FROM sales""")
def mod_04(spark, sf_dir):
    terms = M.linear_coefficients(model_input(spark, sf_dir), ["yearBuilt"], "salePrice")
    return terms.agg(rnd(F.max(F.when(F.col("term") == "intercept", F.col("value"))), 4).alias("intercept"),
                     rnd(F.max(F.when(F.col("term") == "yearBuilt", F.col("value"))), 4).alias("slope"))


#: Penalised slopes of one centred column in closed form: S = variance, C = covariance (per row).
_PENALISED = {"ridge": ("Ridge", {"alpha": 50000.0}, "c / (v + 50000.0 / n)"),
              "lasso": ("Lasso", {"alpha": 20000.0}, "sign(c) * greatest(abs(c) - 20000.0, 0) / v"),
              "elastic_net": ("ElasticNet", {"alpha": 20000.0, "l1_ratio": 0.25},
                              "sign(c) * greatest(abs(c) - 5000.0, 0) / (v + 15000.0)")}


@query("mod_05_06_07_penalised_slopes", sales_with("""m AS (SELECT var_pop(landSizeM2) AS v, covar_pop(salePrice, landSizeM2) AS c,
  count(*) AS n, avg(landSizeM2) AS mx, avg(salePrice) AS my FROM sales WHERE landSizeM2 IS NOT NULL AND salePrice IS NOT NULL)""")
       + " UNION ALL ".join(f"SELECT '{k}' AS model, {R(f'({w})', 6)} AS slope, {R(f'my - ({w}) * mx', 3)} AS intercept FROM m"
                            for k, (_, _, w) in _PENALISED.items()))
def mod_05_07(spark, sf_dir):
    df = model_input(spark, sf_dir)
    out = None
    for name, (model, params, _) in _PENALISED.items():
        terms = M.linear_coefficients(df, ["landSizeM2"], "salePrice", model, **params)
        row = terms.agg(F.lit(name).alias("model"),
                        rnd(F.max(F.when(F.col("term") == "landSizeM2", F.col("value"))), 6).alias("slope"),
                        rnd(F.max(F.when(F.col("term") == "intercept", F.col("value"))), 3).alias("intercept"))
        out = row if out is None else out.unionByName(row)
    return out


FOLD_ALPHAS = [0.01, 0.1, 1.0, 10.0, 1000.0, 100000.0]


@query("mod_11_ridge_scores_of_every_fold", _FOLDS_SQL + f""",
a AS (SELECT unnest({FOLD_ALPHAS}) AS alpha),
med AS (SELECT fold, median(landSizeM2) AS md FROM b JOIN tr ON pos < s GROUP BY fold),
x AS (SELECT b.fold, pos < s AS fits, coalesce(landSizeM2, md) AS x, salePrice AS y FROM b JOIN med USING (fold) JOIN tr ON pos < e),
t AS (SELECT fold, count(*) AS n, avg(x) AS mx, stddev_pop(x) AS sx, avg(y) AS my, covar_pop(x, y) AS c FROM x WHERE fits GROUP BY fold),
p AS (SELECT fold, alpha, y, my + n * c / sx / (n + alpha) * (x - mx) / sx AS p FROM x JOIN t USING (fold), a WHERE NOT fits)
SELECT CAST(fold AS INTEGER) AS fold, CAST(alpha AS DOUBLE) AS alpha, {R('1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))', 6)} AS r2
FROM p GROUP BY fold, alpha""")
def mod_11_folds(spark, sf_dir):
    train, _, _ = M.month_split(M.label_frame(model_input(spark, sf_dir), "salePrice"), "saleYearMonth")
    train = M.with_positions(train, "saleYearMonth")
    n = train.count()
    scores = M.fold_scores(train, M.fold_masks(n, M.n_splits_for(n)), ["landSizeM2"], [],
                           {"Ridge": M.grid_points("Ridge", {"alpha": FOLD_ALPHAS})})
    rows = [(i + 1, a, r2) for a, own in zip(FOLD_ALPHAS, scores["Ridge"]) for i, r2 in enumerate(own)]
    return spark.createDataFrame(rows, "fold int, alpha double, r2 double").withColumn("r2", rnd("r2", 6))


_LOG_SQL = sales_with("""v AS (SELECT max(saleYearMonth) AS vm FROM sales),
tr AS (SELECT * FROM sales, v WHERE saleYearMonth < vm AND salePrice > 0),
co AS (SELECT regr_intercept(ln(1 + salePrice), yearBuilt) AS a, regr_slope(ln(1 + salePrice), yearBuilt) AS b FROM tr),
va AS (SELECT salePrice AS y, exp(a + b * yearBuilt) - 1 AS p FROM sales, v, co WHERE saleYearMonth = vm)""")


@query("mod_12_13_flt_05_log_target_metrics", _LOG_SQL + f"""
SELECT {R('avg(abs(p - y))', 2)} AS mae, {R('sqrt(avg((p - y) * (p - y)))', 2)} AS rmse,
  CASE WHEN var_pop(y) = 0 THEN NULL ELSE {R('1 - sum((p - y) * (p - y)) / (var_pop(y) * count(*))', 4)} END AS r2 FROM va""")
def mod_12_13(spark, sf_dir):
    tr, va, _ = M.month_split(M.label_frame(model_input(spark, sf_dir), "salePrice", log_target=True), "saleYearMonth")
    fit = {r["term"]: r["value"] for r in M.linear_coefficients(tr, ["yearBuilt"], "label").collect()}   # two terms
    pred = va.withColumn("prediction", F.expm1(F.lit(fit["intercept"]) + F.lit(fit["yearBuilt"]) * F.col("yearBuilt")))
    met = M.regression_metrics(pred, label="salePrice")
    r2 = F.lit(met["r2"]).cast("double")
    return spark.range(1).select(rnd(F.lit(met["mae"]), 2).alias("mae"), rnd(F.lit(met["rmse"]), 2).alias("rmse"),
                                 rnd(r2, 4).alias("r2"))


#: The linear models' whole grid costs no pass of its own; trees are fitted per fold and point.
GRID = {"LinearRegression": {}, "Ridge": {"alpha": [0.01, 0.1, 1.0, 10.0]}, "Lasso": {"alpha": [0.001, 0.01, 0.1, 1.0]},
        "ElasticNet": {"alpha": [0.01, 0.1, 1.0], "l1_ratio": [0.1, 0.5, 0.9]},
        "SARIMAX": {"order": [[1, 0, 0], [2, 0, 1]], "seasonal_order": [[0, 0, 0, 0], [1, 0, 0, 12]], "trend": ["c"]},
        "GradientBoostingRegressor": {"n_estimators": [5], "max_depth": [3], "learning_rate": [0.1]}}


@query("mod_03_11_14_grid_search_scores")
def mod_03_14(spark, sf_dir):
    table, _ = M.train_models(model_input(spark, sf_dir), "salePrice", "saleYearMonth", GRID,
                              numeric=["landSizeM2", "yearBuilt", "saleMonth"],
                              categorical=["propertyType", "region", "street"])
    return table


@query("mod_15_pro_01_02_report_and_promotion")
def mod_15(spark, sf_dir):
    df = model_input(spark, sf_dir)
    small = {"LinearRegression": {}, "Ridge": {"alpha": [1.0]}}
    t12, _ = M.train_models(df, "salePrice", "saleYearMonth", small, numeric=["landSizeM2", "yearBuilt"],
                            categorical=["propertyType"])
    tlog, _ = M.train_models(df, "salePrice", "saleYearMonth", small, numeric=["landSizeM2", "yearBuilt"],
                             categorical=["propertyType"], log_target=True)
    report = M.training_report({"price_future_12m_delta": t12, "price_log_6m": tlog})
    report = report.withColumns({"name": F.concat(F.col("target"), F.lit("_"), F.col("model")),
                                 "forecast_window": F.regexp_extract("target", r"(\d+)m", 0),
                                 # the second target was trained a day later: the latest one is taken
                                 "timestamp": F.when(F.col("target") == "price_log_6m", "20250102_000000").otherwise("20250101_000000"),
                                 "ord": F.monotonically_increasing_id()})
    best = best_per_window(report)
    latest = select_targets(best, "latest")
    return latest.select("target", "model", "forecast_window", "best_overall", rnd("val_r2", 4).alias("val_r2"))


@query("mod_10_seasonal_ar_forecast")
def mod_10(spark, sf_dir):
    s = sales(spark, sf_dir)
    series = grouped(s.withColumn("t", month_ordinal("saleYearMonth")), ["region", "t"], [("median", "salePrice", "y")])
    model = M.fit_seasonal_ar(series, ["region"], "t", "y", p=2, seasonal=12, seasonal_p=1)
    return M.forecast_seasonal_ar(model, series, ["region"], "t", "y", horizon=6, p=2, seasonal=12, seasonal_p=1)


# --- JON-07 / JON-08 as-of lookup and hydration -----------------------------------------------------
_REF_COLS = ["salePrice", "landSizeM2", "yearBuilt"]


def _requests(spark, sf_dir):
    s = sales(spark, sf_dir)
    return s.select(F.col("row_id").alias("request_id"), F.lower("suburb").alias("suburb"), "saleYearMonth",
                    F.when(F.col("row_id") % 10 == 0, F.lit("NOPE")).otherwise(F.col("propertyType")).alias("propertyType"),
                    F.when(F.col("row_id") % 3 == 0, F.lit(None).cast("double")).otherwise(F.col("landSizeM2")).alias("landSizeM2"),
                    F.when(F.col("row_id") % 4 != 1, F.col("street")).alias("street"))


#: Two filters, of which a request may leave out the second; the store is all sales.
_ASOF_SQL = sales_with("""req AS (SELECT row_id AS request_id, lower(suburb) AS suburb, saleYearMonth AS ym,
   CASE WHEN row_id % 10 = 0 THEN 'NOPE' ELSE propertyType END AS ptype, CASE WHEN row_id % 4 <> 1 THEN street END AS rstreet,
   CASE WHEN row_id % 3 = 0 THEN NULL ELSE landSizeM2 END AS landSizeM2 FROM sales),
full_ AS (SELECT row_id, upper(suburb) AS su, propertyType, street, saleYearMonth, salePrice, landSizeM2, yearBuilt FROM sales
   QUALIFY row_number() OVER (PARTITION BY upper(suburb), propertyType, street, saleYearMonth ORDER BY row_id DESC) = 1),
lat AS (SELECT row_id, su, propertyType AS p, street AS s, saleYearMonth, 3 AS use_, salePrice, landSizeM2, yearBuilt FROM full_
  UNION ALL SELECT row_id, su, propertyType, NULL, saleYearMonth, 1, salePrice, landSizeM2, yearBuilt FROM full_
  UNION ALL SELECT row_id, su, NULL, NULL, saleYearMonth, 0, salePrice, landSizeM2, yearBuilt FROM full_),
st AS (SELECT * FROM lat QUALIFY row_number() OVER (PARTITION BY su, use_, p, s, saleYearMonth ORDER BY row_id DESC) = 1),
rq AS (SELECT r.*, upper(trim(r.suburb)) AS su, CASE WHEN rstreet IS NULL THEN 1 ELSE 3 END AS use_ FROM req r),
has AS (SELECT DISTINCT su, use_, p, s FROM st),
rh AS (SELECT rq.*, CASE WHEN EXISTS (SELECT 1 FROM has h WHERE h.su = rq.su AND h.use_ = rq.use_ AND h.p = rq.ptype
   AND h.s IS NOT DISTINCT FROM rq.rstreet) THEN rq.use_ ELSE 0 END AS u FROM rq),
ref AS (SELECT rh.request_id, st.salePrice, st.landSizeM2, st.yearBuilt FROM rh JOIN st ON rh.su = st.su AND rh.u = st.use_
   WHERE rh.u = 0 OR (st.p = rh.ptype AND st.s IS NOT DISTINCT FROM rh.rstreet)
   QUALIFY row_number() OVER (PARTITION BY rh.request_id ORDER BY (st.saleYearMonth <= rh.ym) DESC, st.saleYearMonth DESC) = 1)""")


@query("jon_07_asof_reference_lookup", _ASOF_SQL + "SELECT request_id, salePrice, landSizeM2, yearBuilt FROM ref")
def jon_07(spark, sf_dir):
    return asof_reference(_requests(spark, sf_dir), sales(spark, sf_dir), _REF_COLS, filters=["propertyType", "street"])


@query("jon_08_hydrate_null_cells", _ASOF_SQL + """
SELECT req.request_id, coalesce(req.landSizeM2, ref.landSizeM2) AS landSizeM2, ref.yearBuilt AS yearBuilt
FROM req LEFT JOIN ref USING (request_id)""")
def jon_08(spark, sf_dir):
    req = _requests(spark, sf_dir)
    ref = asof_reference(req, sales(spark, sf_dir), _REF_COLS, filters=["propertyType", "street"])
    return hydrate(req, ref, ["landSizeM2", "yearBuilt"]).select("request_id", "landSizeM2", "yearBuilt")


#: The store is all sales; its last row per (suburb, type, month) stands for the month.
_ASOF_ALL_SQL = sales_with("""req AS (SELECT row_id AS request_id, lower(suburb) AS suburb, saleYearMonth AS ym,
   CASE WHEN row_id % 10 = 0 THEN 'NOPE' ELSE propertyType END AS ptype,
   CASE WHEN row_id % 3 = 0 THEN NULL ELSE landSizeM2 END AS landSizeM2 FROM sales),
st AS (SELECT row_id, upper(suburb) AS su, propertyType, saleYearMonth, salePrice, landSizeM2, yearBuilt FROM sales
   QUALIFY row_number() OVER (PARTITION BY upper(suburb), propertyType, saleYearMonth ORDER BY row_id DESC) = 1),
has AS (SELECT DISTINCT su, propertyType FROM st),
rq AS (SELECT r.*, upper(trim(r.suburb)) AS su, EXISTS (SELECT 1 FROM has h WHERE h.su = upper(trim(r.suburb)) AND h.propertyType = r.ptype) AS use_f FROM req r),
ref AS (SELECT rq.request_id, st.salePrice, st.landSizeM2, st.yearBuilt FROM rq JOIN st ON rq.su = st.su
   WHERE NOT rq.use_f OR st.propertyType = rq.ptype
   QUALIFY row_number() OVER (PARTITION BY rq.request_id ORDER BY (st.saleYearMonth <= rq.ym) DESC, st.saleYearMonth DESC, st.row_id DESC) = 1)""")


@query("jon_07_asof_reference_lookup_all_sales", _ASOF_ALL_SQL + "SELECT request_id, salePrice, landSizeM2, yearBuilt FROM ref")
def jon_07_all(spark, sf_dir):
    return asof_reference(_requests(spark, sf_dir), sales(spark, sf_dir), _REF_COLS, filters=["propertyType"])


@query("jon_08_hydrate_null_cells_all_sales", _ASOF_ALL_SQL + """
SELECT req.request_id, coalesce(req.landSizeM2, ref.landSizeM2) AS landSizeM2, ref.yearBuilt AS yearBuilt
FROM req LEFT JOIN ref USING (request_id)""")
def jon_08_all(spark, sf_dir):
    req = _requests(spark, sf_dir)
    ref = asof_reference(req, sales(spark, sf_dir), _REF_COLS, filters=["propertyType"])
    return hydrate(req, ref, ["landSizeM2", "yearBuilt"]).select("request_id", "landSizeM2", "yearBuilt")


@query("pre_03_04_delta_to_price_interval", sales_with("sd AS (SELECT stddev_samp(salePrice) / 1e6 AS rmse FROM sales)") + f"""
SELECT row_id, {R('coalesce(landSizeM2, yearBuilt * 100.0) * (1 + (row_id % 21 - 10) / 100.0)', 4)} AS price,
  {R('coalesce(landSizeM2, yearBuilt * 100.0) * (1 + (row_id % 21 - 10) / 100.0) - 1.96 * rmse * coalesce(landSizeM2, yearBuilt * 100.0)', 4)} AS lower,
  {R('coalesce(landSizeM2, yearBuilt * 100.0) * (1 + (row_id % 21 - 10) / 100.0) + 1.96 * rmse * coalesce(landSizeM2, yearBuilt * 100.0)', 4)} AS upper
FROM sales, sd""")
def pre_03_04(spark, sf_dir):
    s = sales(spark, sf_dir)
    raw = (F.col("row_id") % 21 - 10) / 100.0
    bases = [F.col("landSizeM2"), F.col("yearBuilt") * 100.0]
    s = s.withColumn("price", delta_to_price(raw, bases, is_delta=True))
    rmse = s.select(F.stddev_samp("salePrice") / 1e6).scalar()
    out = with_interval(s, "price", rmse, 0.95, base=F.coalesce(*bases))
    return out.select("row_id", rnd("price", 4).alias("price"), rnd("lower", 4).alias("lower"), rnd("upper", 4).alias("upper"))


@query("pre_01_02_bin_05_nul_04_batch_prep_and_scoring")
def pre_01_02(spark, sf_dir):
    df = model_input(spark, sf_dir)
    table, fitted = M.train_models(df, "salePrice", "saleYearMonth", {"LinearRegression": {}},
                                   numeric=["landSizeM2", "yearBuilt", "saleMonth"], categorical=["propertyType"])
    model = fitted["models"]["LinearRegression"]
    store = sales(spark, sf_dir)
    meta = {"impute": {"numeric": {"landSizeM2": 400.0, "yearBuilt": 1975, "saleMonth": 6.0},
                       "categorical": {"propertyType": "House"}},
            "bands": {"propertyAgeBand": {"source": "propertyAge", "edges": [5, 20], "labels": ["0-5", "6-20", "21+"]}},
            "columns": ["saleYearMonth", "landSizeM2", "yearBuilt", "saleMonth", "propertyType", "propertyAgeBand"]}
    req = store.select(F.col("row_id").alias("request_id"), "suburb", "saleYearMonth",
                       F.when(F.col("row_id") % 2 == 0, F.col("yearBuilt")).alias("yearBuilt"),
                       F.col("propertyType").alias("type"))
    prepared = prepare_requests(req, store, meta, aliases={"type": "propertyType"},
                                reference_columns=["landSizeM2"], filters=[])
    prepared = prepared.withColumn("saleMonth", (F.col("saleYearMonth") % 100).cast("double"))
    scored = model.transform(prepared)
    return scored.select("request_id", rnd("prediction", 2).alias("prediction"), "propertyAgeBand")
