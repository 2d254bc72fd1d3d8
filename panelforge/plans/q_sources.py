"""Registered queries: sources/sinks, text folding, generic joins, fills, derive spec, estimators
(SRC-01..04/08/10, STR-01, JON-01/02/05, NUL-03, EXP-01 spec runner, MOD-05..09)."""
from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from panelforge.functions.nulls import rnd
from panelforge.functions.strings import normalize_text
from panelforge.operators import modelling as M
from panelforge.operators.groups import aggregate_join_back
from panelforge.operators.joins import join_step
from panelforge.plans.derive import run_derive
from panelforge.plans.q_macro import MACRO_COLS, MACRO_SQL
from panelforge.plans.registry import query
from panelforge.plans.sqlkit import R, SALES_T, lines_with, sales_with
from panelforge.plans.views import lines, sales
from panelforge.session import scratch_path
from panelforge.sources.files import Registry, load_parquet_or_csv, read_csv_union, read_table, save_parquet_or_csv


def _scratch(spark, sf_dir, name):
    return scratch_path(spark, f"{name}_{zlib.crc32(sf_dir.encode()):08x}")


@query("src_01_csv_directory_union", lines_with() + """
SELECT CAST(l_orderkey AS VARCHAR) AS orderkey, CAST(l_linenumber AS VARCHAR) AS linenumber, CAST(price AS VARCHAR) AS price,
  CASE WHEN flag = 'R' THEN NULL ELSE CAST(landSizeM2 AS VARCHAR) END AS quantity,
  CASE WHEN flag = 'R' THEN partType END AS ptype,
  CASE WHEN flag = 'R' THEN 'group_b' ELSE 'group_a' END AS grp FROM lines""")
def src_01(spark, sf_dir):
    base = _scratch(spark, sf_dir, "csv_union")
    l = lines(spark, sf_dir)
    a = l.where(F.col("flag") != "R").select(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber"),
                                              "price", F.col("landSizeM2").alias("quantity"))
    b = l.where(F.col("flag") == "R").select(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber"),
                                              "price", F.col("partType").alias("ptype"))
    a.write.mode("overwrite").option("header", True).csv(f"{base}/group_a")
    b.write.mode("overwrite").option("header", True).csv(f"{base}/group_b")
    jvm = spark.sparkContext._jvm
    fs_path = jvm.org.apache.hadoop.fs.Path(base)
    fs = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = [str(st.getPath().toString()) for d in ("group_a", "group_b")
             for st in fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{base}/{d}")) if st.getPath().getName().endswith(".csv")]
    u = read_csv_union(spark, files)
    grp = F.when(F.col("sourceFile").isin([f.rsplit("/", 1)[-1] for f in files if "/group_b/" in f]), "group_b").otherwise("group_a")
    return u.select("orderkey", "linenumber", "price", "quantity", "ptype", grp.alias("grp"))


@query("src_02_03_parquet_csv_round_trip", sales_with() + """
SELECT CAST(row_id AS VARCHAR) AS row_id, suburb, CAST(salePrice AS VARCHAR) AS salePrice, 'csv' AS fmt FROM sales
UNION ALL SELECT CAST(row_id AS VARCHAR), suburb, CAST(salePrice AS VARCHAR), 'parquet' FROM sales""")
def src_02_03(spark, sf_dir):
    base = _scratch(spark, sf_dir, "round_trip")
    s = sales(spark, sf_dir).select("row_id", "suburb", "salePrice")
    p = save_parquet_or_csv(s, f"{base}/table.parquet")
    c = save_parquet_or_csv(s, f"{base}/table.csv")
    pq = load_parquet_or_csv(spark, p).select(F.col("row_id").cast("string"), "suburb",
                                              F.col("salePrice").cast("string"), F.lit("parquet").alias("fmt"))
    cs = load_parquet_or_csv(spark, c).select("row_id", "suburb", "salePrice", F.lit("csv").alias("fmt"))
    return pq.unionByName(cs)


@query("src_04_jon_01_registry_join_null_safe", sales_with("""nat AS (SELECT n_name AS suburb_name, n_regionkey AS regionkey,
  CASE WHEN n_nationkey = 0 THEN NULL ELSE n_name END AS k FROM nation),
s2 AS (SELECT row_id, suburb, CASE WHEN custkey % 7 = 0 THEN NULL ELSE suburb END AS k, salePrice FROM sales)""") + """
SELECT s2.row_id, s2.k, nat.suburb_name, nat.regionkey, s2.salePrice FROM s2 LEFT JOIN nat ON s2.k IS NOT DISTINCT FROM nat.k""")
def src_04(spark, sf_dir):
    n = read_table(spark, sf_dir, "nation").select(F.col("n_name").alias("suburb_name"), F.col("n_regionkey").alias("regionkey"),
                                                   F.when(F.col("n_nationkey") != 0, F.col("n_name")).alias("k"))
    reg = Registry(spark, {"nations": n})
    s = sales(spark, sf_dir).select("row_id", "suburb", F.when(F.col("custkey") % 7 != 0, F.col("suburb")).alias("k"),
                                    "salePrice")
    j = join_step(s, reg.resolve("{nations}"), on="k", how="left", select=["suburb_name", "regionkey"],
                  validate="many_to_one")
    return j.select("row_id", "k", "suburb_name", "regionkey", "salePrice")


@query("jon_01_02_outer_join_suffixes_validation", sales_with("""a AS (SELECT suburb, saleType, count(*) AS n, avg(salePrice) AS price FROM sales GROUP BY ALL),
b AS (SELECT n_name AS name, s.saleType, n_regionkey::BIGINT AS n, n_nationkey * 10.0::DOUBLE AS price FROM nation, (VALUES ('O'), ('X')) s(saleType))""") + f"""
SELECT a.suburb, b.name, coalesce(a.saleType, b.saleType) AS saleType, a.n AS n, {R('a.price', 4)} AS price, b.n AS n_right, b.price::DOUBLE AS price_right
FROM a FULL OUTER JOIN b ON a.suburb = b.name AND a.saleType = b.saleType""")
def jon_01_02(spark, sf_dir):
    s = sales(spark, sf_dir).groupBy("suburb", "saleType").agg(F.count(F.lit(1)).alias("n"), F.avg("salePrice").alias("price"))
    r = read_table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("name"), F.explode(F.array(F.lit("O"), F.lit("X"))).alias("saleType"),
        F.col("n_regionkey").cast("bigint").alias("n"), (F.col("n_nationkey") * 10.0).alias("price"))
    j = join_step(s, r, on=[{"left": "suburb", "right": "name"}, "saleType"], how="outer", validate="one_to_one")
    return j.select("suburb", "name", "saleType", "n", rnd("price", 4).alias("price"), "n_right", "price_right")


@query("jon_01_02_outer_join_suffixes_validation_all_rows", sales_with("""a AS (SELECT region, count(*) AS n, avg(salePrice) AS price FROM sales GROUP BY 1),
b AS (SELECT r_name AS region_name, CAST(r_regionkey AS BIGINT) AS n, CAST(r_regionkey * 1000.0 AS DOUBLE) AS price FROM region)""") + f"""
SELECT coalesce(a.region, b.region_name) AS region, a.n AS n, {R('a.price', 4)} AS price, b.region_name, b.n AS n_right, b.price AS price_right
FROM a FULL OUTER JOIN b ON a.region IS NOT DISTINCT FROM b.region_name""")
def jon_01_02_all(spark, sf_dir):
    s = sales(spark, sf_dir).groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.avg("salePrice").alias("price"))
    r = read_table(spark, sf_dir, "region").select(
        F.col("r_name").alias("region_name"), F.col("r_regionkey").cast("bigint").alias("n"),
        (F.col("r_regionkey") * 1000.0).alias("price"))
    j = join_step(s, r, on=[{"left": "region", "right": "region_name"}], how="outer", validate="one_to_one")
    return j.select(F.coalesce("region", "region_name").alias("region"), "n", rnd("price", 4).alias("price"),
                    "region_name", "n_right", "price_right")


@query("jon_05_aggregate_join_back", sales_with("g AS (SELECT street, propertyType, max(salePrice) AS mx FROM sales GROUP BY ALL)") + """
SELECT row_id, mx AS street_type_max, salePrice AS existing FROM sales JOIN g USING (street, propertyType)""")
def jon_05(spark, sf_dir):
    s = sales(spark, sf_dir).withColumn("existing", F.col("salePrice"))
    s = aggregate_join_back(s, ["street", "propertyType"], "salePrice", "max", "street_type_max")
    s = aggregate_join_back(s, ["street"], "salePrice", "min", "existing")      # output exists: skipped
    return s.select("row_id", "street_type_max", "existing")


_FOLD_T = ("replace(upper(replace(regexp_replace(replace(text, '²', '2'), '^\\s+|\\s+$', '', 'g'), 'ß', 'SS')), '  ', ' ')")


@query("str_01_ascii_text_fold", f"SELECT doc_id, strip_accents({_FOLD_T}) AS text_folded FROM documents")
def str_01(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", normalize_text("text", {"²": "2"}).alias("text_folded"))


DERIVE_STEPS = [
    {"type": "simple", "method": "date_parts", "source": "saleDate"},
    {"type": "simple", "method": "expr", "output": "ppsqm", "config": {"expr": "salePrice / nullif(landSizeM2, 0)"}},
    {"type": "bin", "source": "salePrice", "output": "price_band",
     "config": {"edges": [100000, 200000, 300000], "labels": ["low", "mid", "high", "top"]}},
    {"type": "aggregate", "group_by": ["suburb"], "target": "salePrice", "outputs": {"mean": "suburb_mean"}},
    {"type": "time_aggregate", "group_by": ["suburb"], "time_col": "saleYearMonth", "target": "salePrice",
     "window": {"past": 5, "future": 0, "include_current": False}, "outputs": {"median": "med_6m"}},
    {"type": "time_aggregate", "group_by": ["suburb"], "time_col": "saleYearMonth", "target": "salePrice",
     "window": {"past": 5, "future": 0, "include_current": False}, "outputs": {"count": "n_6m"}},
    {"type": "rolling", "group_by": ["suburb"], "sort_by": "saleDate", "target": "salePrice", "window": 3,
     "outputs": {"mean": "roll3"}},
    {"type": "join", "right": "regions", "on": [{"left": "region", "right": "r_name"}], "select": ["r_regionkey"]},
    {"type": "simple", "method": "expr", "output": "norm_price", "config": {"expr": "salePrice / nullif(med_6m, 0)"}},
]
_WD = f"(PARTITION BY suburb ORDER BY {SALES_T} RANGE BETWEEN 5 PRECEDING AND CURRENT ROW EXCLUDE CURRENT ROW)"


@query("exp_01_nul_03_derive_step_list_single_plan", sales_with(f"""d AS (SELECT *, CAST(year(saleDate) AS INTEGER) AS saleYear,
  salePrice / nullif(landSizeM2, 0) AS ppsqm,
  CASE WHEN salePrice <= 100000 THEN 'low' WHEN salePrice <= 200000 THEN 'mid' WHEN salePrice <= 300000 THEN 'high' ELSE 'top' END AS price_band,
  avg(salePrice) OVER (PARTITION BY suburb) AS suburb_mean,
  CASE WHEN count(*) OVER {_WD} = 0 THEN NULL ELSE median(salePrice) OVER {_WD} END AS med_6m,
  CASE WHEN count(*) OVER {_WD} = 0 THEN NULL ELSE count(salePrice) OVER {_WD} END AS n_6m,
  avg(salePrice) OVER (PARTITION BY suburb ORDER BY saleDate, row_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS roll3
  FROM sales)""") + f"""
SELECT row_id, saleYear, price_band, coalesce({R('ppsqm', 4)}, -1.0) AS ppsqm, {R('suburb_mean', 4)} AS suburb_mean,
  coalesce({R('med_6m', 4)}, -1.0) AS med_6m, coalesce(n_6m, -1) AS n_6m, {R('roll3', 4)} AS roll3, r_regionkey,
  coalesce({R('salePrice / nullif(med_6m, 0)', 6)}, -1.0) AS norm_price
FROM d JOIN region ON d.region = region.r_name""")
def exp_01_derive(spark, sf_dir):
    s = sales(spark, sf_dir)
    regions = read_table(spark, sf_dir, "region")
    d = run_derive(s, DERIVE_STEPS, datasets={"regions": regions}, default_fill=-1, materialize=True)
    return d.select("row_id", "saleYear", "price_band", rnd("ppsqm", 4).alias("ppsqm"), rnd("suburb_mean", 4).alias("suburb_mean"),
                   rnd("med_6m", 4).alias("med_6m"), "n_6m", rnd("roll3", 4).alias("roll3"), "r_regionkey",
                   rnd("norm_price", 6).alias("norm_price"))


@query("mod_05_09_estimator_family_holdout")
def mod_05_09(spark, sf_dir):
    from panelforge.plans.q_model import model_input
    grid = {"Ridge": {"alpha": [1.0]}, "Lasso": {"alpha": [10.0]}, "ElasticNet": {"alpha": [10.0], "l1_ratio": [0.5]},
            "RandomForestRegressor": {"n_estimators": [5], "max_depth": [4]},
            "GradientBoostingRegressor": {"n_estimators": [5], "max_depth": [3], "learning_rate": [0.1]}}
    table, _ = M.train_models(model_input(spark, sf_dir), "salePrice", "saleYearMonth", grid,
                              numeric=["landSizeM2", "yearBuilt"], categorical=["propertyType"])
    return table.select("model", rnd("val_r2", 4).alias("val_r2"), "best_params")


@query("src_08_selected_feature_list")
def src_08(spark, sf_dir):
    from panelforge.plans.q_select import SELECT_CFG, TARGET, score_input, scores_of
    from panelforge.operators.selection import select_features
    from panelforge.sources.files import write_lines
    data = score_input(spark, sf_dir)
    chosen, _ = select_features(data, scores_of(data), TARGET, **SELECT_CFG)
    path = write_lines(spark.createDataFrame([(c,) for c in chosen], "feature string"), "feature",
                       _scratch(spark, sf_dir, "selected_features"))
    return spark.read.text(path).withColumnRenamed("value", "feature")


def _macro_outputs(spark, sf_dir):
    """SRC-10: all seven tables, periodic, yearly and joined, written as CSV; (name, path) pairs."""
    from panelforge.plans import q_macro as QM
    base = _scratch(spark, sf_dir, "macro")
    day = F.date_format("date", "yyyy-MM-dd").alias("date")
    tables = {"cpi_quarterly": QM.index_series(spark, sf_dir).select(day, F.col("v").alias("cpi_index")),
              "cpi_annual_avg": QM._cpi_avg(spark, sf_dir), "cpi_annual_december": QM._cpi_dec(spark, sf_dir),
              "rba_cash_daily": QM.rate_series(spark, sf_dir).select(day, F.col("v").alias("cash_rate")),
              "rba_cash_annual": QM._cash(spark, sf_dir), "asx200_yearly": QM._asx(spark, sf_dir),
              "macro_au_annual": QM.macro_table(spark, sf_dir)}
    for name, t in tables.items():
        t.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{base}/{name}.csv")   # calendar-bounded
    return {name: f"{base}/{name}.csv" for name in tables}


_SRC_10 = {"cpi_quarterly": ("(SELECT date, v AS cpi_index FROM idx)", "cpi_index"), "cpi_annual_avg": ("cpi_avg", "cpi_index_avg"),
           "cpi_annual_december": ("cpi_dec", "cpi_index_dec"), "rba_cash_daily": ("(SELECT date, v AS cash_rate FROM rate)", "cash_rate"),
           "rba_cash_annual": ("cash", "cash_rate_avg"), "asx200_yearly": ("asx", "asx200_close"), "macro_au_annual": ("macro", "cpi_index_avg")}


@query("src_10_macro_outputs_written", f"WITH {MACRO_SQL} " + " UNION ALL ".join(
    f"SELECT '{n}' AS output, count(*) AS rows, count({c}) AS present, {R(f'sum({c})', 2)} AS total FROM {t}" for n, (t, c) in _SRC_10.items()))
def src_10(spark, sf_dir):
    out = None
    for name, path in _macro_outputs(spark, sf_dir).items():
        c = F.col(_SRC_10[name][1]).cast("double")
        row = load_parquet_or_csv(spark, path).agg(F.lit(name).alias("output"), F.count(F.lit(1)).alias("rows"),
                                                   F.count(c).alias("present"), rnd(F.sum(c), 2).alias("total"))
        out = row if out is None else out.unionByName(row)
    return out


@query("src_10_joined_macro_output", f"WITH {MACRO_SQL} SELECT CAST(year AS VARCHAR) AS year, " + ", ".join(f"{R(c, 6)} AS {c}" for c in MACRO_COLS) + " FROM macro")
def src_10_joined(spark, sf_dir):
    out = load_parquet_or_csv(spark, _macro_outputs(spark, sf_dir)["macro_au_annual"])
    return out.select("year", *[rnd(F.col(c).cast("double"), 6).alias(c) for c in MACRO_COLS])
