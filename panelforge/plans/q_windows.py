"""Registered queries: flagship, group transforms (AGG-01..08), windows (WIN-01..06)."""
from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.functions.bins import fixed_bins
from panelforge.functions.nulls import rnd, safe_div
from panelforge.operators.groups import group_transform
from panelforge.operators.windows import rolling, time_range_aggregate
from panelforge.plans.registry import query
from panelforge.plans.sqlkit import R, SALES_T, sales_with
from panelforge.plans.views import sales

PRICE_EDGES = [100000, 200000, 300000]
PRICE_LABELS = ["low", "mid", "high", "top"]


def flagship(spark, sf_dir):
    """DAT-02 -> BIN-01 -> WIN-01/04 trailing-12-month median -> MTH-06 normalised price -> group mean."""
    s = sales(spark, sf_dir).withColumn("price_band", fixed_bins("salePrice", PRICE_EDGES, PRICE_LABELS))
    s = time_range_aggregate(s, "suburb", "saleYearMonth", "salePrice", {"median": "median_12m"},
                             past=11, future=0, include_current=True)
    s = s.withColumn("normalized_price", safe_div("salePrice", "median_12m"))
    return (s.groupBy("suburb", "price_band")
             .agg(F.count(F.lit(1)).alias("n"), rnd(F.avg("normalized_price"), 6).alias("mean_normalized_price")))


FLAGSHIP_SQL = sales_with(f"""f AS (
  SELECT *, CASE WHEN salePrice <= 100000 THEN 'low' WHEN salePrice <= 200000 THEN 'mid'
                 WHEN salePrice <= 300000 THEN 'high' ELSE 'top' END AS price_band,
         median(salePrice) OVER (PARTITION BY suburb ORDER BY {SALES_T}
                                 RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) AS median_12m
  FROM sales)""") + f"""
SELECT suburb, price_band, count(*) AS n, {R("avg(salePrice / nullif(median_12m, 0))", 6)} AS mean_normalized_price
FROM f GROUP BY suburb, price_band"""

query("mth_06_normalised_price_flagship", FLAGSHIP_SQL)(flagship)


# --- AGG-01..08 group transforms -------------------------------------------------------------
def _band(s):
    # NULL group key wherever landSizeM2 is NULL (tests NULL keys as their own group)
    return s.withColumn("lsz_band", F.when(F.col("landSizeM2").isNotNull(),
                                           F.when(F.col("landSizeM2") > 5000, "big").otherwise("small")))


_BAND_SQL = "CASE WHEN landSizeM2 IS NOT NULL THEN CASE WHEN landSizeM2 > 5000 THEN 'big' ELSE 'small' END END"


@query("agg_01_08_group_transform_all_functions", sales_with(f"""b AS (SELECT *, {_BAND_SQL} AS lsz_band FROM sales),
g AS (SELECT suburb, lsz_band, avg(salePrice) AS m, median(salePrice) AS md, coalesce(sum(salePrice), 0) AS s,
             min(salePrice) AS mn, max(salePrice) AS mx, stddev_samp(salePrice) AS sd, count(salePrice) AS c,
             count(DISTINCT street) AS nu
      FROM b GROUP BY suburb, lsz_band)""") + f"""
SELECT row_id, {R('m', 4)} AS grp_mean, {R('md', 4)} AS grp_median, {R('s', 2)} AS grp_sum, mn AS grp_min,
       mx AS grp_max, {R('sd', 4)} AS grp_std, c AS grp_count, nu AS grp_nunique_street
FROM b JOIN g ON b.suburb IS NOT DISTINCT FROM g.suburb AND b.lsz_band IS NOT DISTINCT FROM g.lsz_band""")
def agg_01(spark, sf_dir):
    s = _band(sales(spark, sf_dir))
    s = group_transform(s, ["suburb", "lsz_band"], "salePrice",
                        {"mean": "grp_mean", "median": "grp_median", "sum": "grp_sum", "min": "grp_min",
                         "max": "grp_max", "std": "grp_std", "count": "grp_count"})
    s = group_transform(s, ["suburb", "lsz_band"], "street", {"nunique": "grp_nunique_street"})
    return s.select("row_id", rnd("grp_mean", 4).alias("grp_mean"), rnd("grp_median", 4).alias("grp_median"),
                    rnd("grp_sum", 2).alias("grp_sum"), "grp_min", "grp_max", rnd("grp_std", 4).alias("grp_std"),
                    "grp_count", "grp_nunique_street")


@query("agg_01_group_transform_min_count", sales_with(f"""g AS (
  SELECT suburb, propertyType, street, avg(landSizeM2) AS m, count(landSizeM2) AS c
  FROM sales GROUP BY ALL)""") + f"""
SELECT row_id, CASE WHEN c >= 45 THEN {R('m', 4)} END AS lsz_mean
FROM sales s JOIN g USING (suburb, propertyType, street)""")
def agg_01_min_count(spark, sf_dir):
    s = group_transform(sales(spark, sf_dir), ["suburb", "propertyType", "street"], "landSizeM2",
                        {"mean": "lsz_mean"}, min_count=45)
    return s.select("row_id", rnd("lsz_mean", 4).alias("lsz_mean"))


# --- WIN-01..05 time-range aggregates --------------------------------------------------------
def _w(past, future, exclude=True):
    ex = " EXCLUDE CURRENT ROW" if exclude else ""
    fut = "CURRENT ROW" if future == 0 else f"{future} FOLLOWING"
    return f"(PARTITION BY suburb ORDER BY {SALES_T} RANGE BETWEEN {past} PRECEDING AND {fut}{ex})"


def _nz(expr, w):
    return f"CASE WHEN count(*) OVER {w} = 0 THEN NULL ELSE {expr} END"


_W2 = _w(2, 0)


@query("win_01_02_loo_mean_sum_count_std", sales_with() + f"""
SELECT row_id,
  {_nz(R(f'avg(salePrice) OVER {_W2}', 4), _W2)} AS loo_mean,
  {_nz(R(f'coalesce(sum(salePrice) OVER {_W2}, 0)', 2), _W2)} AS loo_sum,
  {_nz(f'count(salePrice) OVER {_W2}', _W2)} AS loo_count,
  {_nz(R(f'stddev_samp(salePrice) OVER {_W2}', 4), _W2)} AS loo_std
FROM sales""")
def win_02(spark, sf_dir):
    s = time_range_aggregate(sales(spark, sf_dir), "suburb", "saleYearMonth", "salePrice",
                             {"mean": "loo_mean", "sum": "loo_sum", "count": "loo_count", "std": "loo_std"},
                             past=2, future=0, include_current=False)
    return s.select("row_id", rnd("loo_mean", 4).alias("loo_mean"), rnd("loo_sum", 2).alias("loo_sum"),
                    "loo_count", rnd("loo_std", 4).alias("loo_std"))


_W3 = _w(3, 1)


@query("win_03_loo_median_min_max", sales_with() + f"""
SELECT row_id,
  {_nz(R(f'median(salePrice) OVER {_W3}', 4), _W3)} AS loo_median,
  {_nz(f'min(salePrice) OVER {_W3}', _W3)} AS loo_min,
  {_nz(f'max(salePrice) OVER {_W3}', _W3)} AS loo_max
FROM sales""")
def win_03(spark, sf_dir):
    s = time_range_aggregate(sales(spark, sf_dir), "suburb", "saleYearMonth", "salePrice",
                             {"median": "loo_median", "min": "loo_min", "max": "loo_max"},
                             past=3, future=1, include_current=False)
    return s.select("row_id", rnd("loo_median", 4).alias("loo_median"), "loo_min", "loo_max")


_W11 = _w(11, 0, exclude=False)


@query("win_04_range_include_current", sales_with() + f"""
SELECT row_id,
  {R(f'avg(salePrice) OVER {_W11}', 4)} AS m12_mean,
  {R(f'median(salePrice) OVER {_W11}', 4)} AS m12_median,
  {R(f'sum(salePrice) OVER {_W11}', 2)} AS m12_sum,
  count(salePrice) OVER {_W11} AS m12_count,
  {R(f'stddev_samp(salePrice) OVER {_W11}', 4)} AS m12_std,
  min(salePrice) OVER {_W11} AS m12_min,
  max(salePrice) OVER {_W11} AS m12_max
FROM sales""")
def win_04(spark, sf_dir):
    s = time_range_aggregate(sales(spark, sf_dir), "suburb", "saleYearMonth", "salePrice",
                             {"mean": "m12_mean", "median": "m12_median", "sum": "m12_sum", "count": "m12_count",
                              "std": "m12_std", "min": "m12_min", "max": "m12_max"},
                             past=11, future=0, include_current=True)
    return s.select("row_id", rnd("m12_mean", 4).alias("m12_mean"), rnd("m12_median", 4).alias("m12_median"),
                    rnd("m12_sum", 2).alias("m12_sum"), "m12_count", rnd("m12_std", 4).alias("m12_std"),
                    "m12_min", "m12_max")


_WE = f"(PARTITION BY suburb, propertyType, street ORDER BY {SALES_T} RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING EXCLUDE CURRENT ROW)"


@query("win_05_empty_and_null_frames", sales_with() + f"""
SELECT row_id,
  {_nz(f'count(landSizeM2) OVER {_WE}', _WE)} AS nb_count,
  {_nz(R(f'coalesce(sum(landSizeM2) OVER {_WE}, 0)', 2), _WE)} AS nb_sum,
  {_nz(R(f'avg(landSizeM2) OVER {_WE}', 4), _WE)} AS nb_mean,
  {_nz(R(f'median(landSizeM2) OVER {_WE}', 4), _WE)} AS nb_median
FROM sales""")
def win_05(spark, sf_dir):
    s = time_range_aggregate(sales(spark, sf_dir), ["suburb", "propertyType", "street"], "saleYearMonth",
                             "landSizeM2", {"count": "nb_count", "sum": "nb_sum", "mean": "nb_mean",
                                            "median": "nb_median"},
                             past=1, future=1, include_current=False)
    return s.select("row_id", "nb_count", rnd("nb_sum", 2).alias("nb_sum"), rnd("nb_mean", 4).alias("nb_mean"),
                    rnd("nb_median", 4).alias("nb_median"))


# --- WIN-06 rolling ---------------------------------------------------------------------------
def _rw(lo, hi):
    return f"(PARTITION BY suburb ORDER BY saleDate ASC NULLS LAST, row_id ROWS BETWEEN {lo} PRECEDING AND {hi})"


def _roll_sql(name_prefix, lo, hi_txt, minp):
    w = _rw(lo, hi_txt)
    n = f"count(landSizeM2) OVER {w}"
    g = lambda e: f"CASE WHEN {n} >= {minp} THEN {e} END"
    return sales_with() + f"""
SELECT row_id,
  {g(R(f'avg(landSizeM2) OVER {w}', 4))} AS {name_prefix}_mean,
  {g(R(f'median(landSizeM2) OVER {w}', 4))} AS {name_prefix}_median,
  {g(R(f'coalesce(sum(landSizeM2) OVER {w}, 0)', 2))} AS {name_prefix}_sum,
  {g(f'min(landSizeM2) OVER {w}')} AS {name_prefix}_min,
  {g(f'max(landSizeM2) OVER {w}')} AS {name_prefix}_max,
  {g(R(f'stddev_samp(landSizeM2) OVER {w}', 4))} AS {name_prefix}_std,
  {g(f'CAST({n} AS DOUBLE)')} AS {name_prefix}_count,
  {g(f'CAST(count(DISTINCT landSizeM2) OVER {w} AS DOUBLE)')} AS {name_prefix}_nunique
FROM sales"""


def _roll(spark, sf_dir, prefix, window, min_periods, center):
    names = {a: f"{prefix}_{a}" for a in ("mean", "median", "sum", "min", "max", "std", "count", "nunique")}
    s = rolling(sales(spark, sf_dir), "suburb", "saleDate", "landSizeM2", window, names,
                min_periods=min_periods, center=center)
    r = {"mean": 4, "median": 4, "sum": 2, "std": 4}
    return s.select("row_id", *[(rnd(c, r[a]) if a in r else F.col(c)).alias(c) for a, c in names.items()])


query("win_06_rolling_rows", _roll_sql("r3", 2, "CURRENT ROW", 2))(
    lambda spark, sf_dir: _roll(spark, sf_dir, "r3", 3, 2, False))
query("win_06_rolling_centered", _roll_sql("c4", 2, "1 FOLLOWING", 1))(
    lambda spark, sf_dir: _roll(spark, sf_dir, "c4", 4, 1, True))
