"""Registered queries: reporting operators (FLT-07..10, AGG-17..23/26/27, WIN-13/14, TOP-*, SRT-01, SMP-01, SET-*, PRJ-*)."""
from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.functions.dates import quarter_label
from panelforge.functions.nulls import rnd
from panelforge.operators import insights as I
from panelforge.operators.joins import anti_by_keys, distinct_lookup, semi_by_activity
from panelforge.plans.registry import query
from panelforge.plans.sqlkit import R, SALES_T, sales_with
from panelforge.plans.views import sales


@query("flt_07_equality_filters_all_wildcard", sales_with() + """
SELECT row_id, salePrice FROM sales WHERE propertyType = 'BUILDING' AND street = '2-HIGH'
  AND year(saleDate) BETWEEN 1996 AND 1999""")
def flt_07(spark, sf_dir):
    s = sales(spark, sf_dir).withColumn("saleYear", F.year("saleDate"))
    out = I.equality_filters(s, {"propertyType": "BUILDING", "street": "2-HIGH", "saleType": "All", "region": "All"},
                             "saleYear", (1996, 1999), date_col="saleDate")
    return out.select("row_id", "salePrice")


@query("flt_08_membership_filters", sales_with() + """
SELECT row_id, suburb, propertyType FROM sales WHERE suburb IN ('NATION_1', 'NATION_7', 'NATION_19')
  AND year(saleDate) BETWEEN 1997 AND 2000""")
def flt_08(spark, sf_dir):
    s = sales(spark, sf_dir).withColumn("saleYear", F.year("saleDate"))
    out = I.membership_filters(s, {"suburb": ["NATION_1", "NATION_7", "NATION_19"], "propertyType": []},
                               "saleYear", (1997, 2000), date_col="saleDate")
    return out.select("row_id", "suburb", "propertyType")


@query("flt_09_10_dropna_and_unknown", sales_with("""s2 AS (SELECT *, CASE WHEN row_id % 4 = 3 THEN 'Unknown' ELSE street END AS street2 FROM sales)""") + """
SELECT row_id, landSizeM2, street2 FROM s2 WHERE landSizeM2 IS NOT NULL AND street2 IS DISTINCT FROM 'Unknown'""")
def flt_09_10(spark, sf_dir):
    s = sales(spark, sf_dir).withColumn("street2", F.when(F.col("row_id") % 4 == 3, F.lit("Unknown")).otherwise(F.col("street")))
    return I.drop_unknown(s.dropna(subset=["landSizeM2"]), "street2").select("row_id", "landSizeM2", "street2")


_PROF = ["salePrice", "landSizeM2", "yearBuilt"]


@query("agg_17_numeric_profile", sales_with() + " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS count, {R(f'avg({c})', 4)} AS mean, {R(f'stddev_samp({c})', 4)} AS std,
  CAST(min({c}) AS DOUBLE) AS min, {R(f'quantile_cont({c}, 0.25)', 4)} AS p25, {R(f'quantile_cont({c}, 0.5)', 4)} AS p50,
  {R(f'quantile_cont({c}, 0.75)', 4)} AS p75, CAST(max({c}) AS DOUBLE) AS max FROM sales""" for c in _PROF))
def agg_17(spark, sf_dir):
    p = I.numeric_profile(sales(spark, sf_dir), _PROF)
    return p.select("column", "count", *[rnd(c, 4).alias(c) for c in ("mean", "std")], "min",
                    *[rnd(c, 4).alias(c) for c in ("p25", "p50", "p75")], "max")


@query("agg_18_value_counts", sales_with() + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS count FROM sales GROUP BY {c}"""
    for c in ("propertyType", "street", "saleType")))
def agg_18(spark, sf_dir):
    return I.value_counts(sales(spark, sf_dir), ["propertyType", "street", "saleType"])


_GROWTH = sales_with("""ts AS (SELECT propertyType, saleYearMonth, median(salePrice) AS median_price, count(*) AS txn_count,
   stddev_samp(salePrice) AS volatility FROM sales GROUP BY ALL),
g AS (SELECT *, lag(median_price, 12) OVER (PARTITION BY propertyType ORDER BY saleYearMonth) AS ago FROM ts)""")


@query("agg_19_type_period_stats", _GROWTH + f"""
SELECT propertyType, saleYearMonth, {R('median_price', 4)} AS median_price, txn_count, {R('volatility', 4)} AS volatility FROM ts""")
def agg_19(spark, sf_dir):
    t = I.type_period_stats(sales(spark, sf_dir), "propertyType", "saleYearMonth", "salePrice")
    return t.select("propertyType", "saleYearMonth", rnd("median_price", 4).alias("median_price"), "txn_count",
                    rnd("volatility", 4).alias("volatility"))


@query("win_13_yoy_growth", _GROWTH + f"""
SELECT propertyType, saleYearMonth, {R('(median_price - ago) / nullif(ago, 0)', 6)} AS yoy_growth FROM g""")
def win_13(spark, sf_dir):
    g = I.yoy_growth(I.type_period_stats(sales(spark, sf_dir), "propertyType", "saleYearMonth", "salePrice"),
                     "propertyType", "saleYearMonth")
    return g.select("propertyType", "saleYearMonth", rnd("yoy_growth", 6).alias("yoy_growth"))


@query("agg_20_latest_growth_summary", _GROWTH + f"""
SELECT propertyType, {R('arg_max((median_price - ago) / nullif(ago, 0), saleYearMonth)', 6)} AS latest_growth,
  {R('arg_max(median_price, saleYearMonth)', 4)} AS latest_price, CAST(sum(txn_count) AS BIGINT) AS txn_last12m
FROM g WHERE (median_price - ago) / nullif(ago, 0) IS NOT NULL GROUP BY propertyType""")
def agg_20(spark, sf_dir):
    g = I.yoy_growth(I.type_period_stats(sales(spark, sf_dir), "propertyType", "saleYearMonth", "salePrice"),
                     "propertyType", "saleYearMonth")
    s = I.yoy_summary(g, "propertyType", "saleYearMonth")
    return s.select("propertyType", rnd("latest_growth", 6).alias("latest_growth"),
                    rnd("latest_price", 4).alias("latest_price"), "txn_last12m")


@query("win_14_volume_share", sales_with() + f"""
SELECT suburb, propertyType, count(*) AS txn_count, {R('count(*) / sum(count(*)) OVER (PARTITION BY suburb)', 6)} AS volume_share
FROM sales GROUP BY suburb, propertyType""")
def win_14(spark, sf_dir):
    v = I.volume_share(sales(spark, sf_dir), "suburb", "propertyType")
    return v.select("suburb", "propertyType", "txn_count", rnd("volume_share", 6).alias("volume_share"))


_Q = sales_with("""q AS (SELECT CAST(saleYearMonth // 100 AS VARCHAR) || '-Q' || CAST((saleYearMonth % 100 - 1) // 3 + 1 AS VARCHAR) AS saleYearQuarter,
  avg(salePrice) AS salePrice_mean, median(salePrice) AS salePrice_median FROM sales GROUP BY 1)""")


def _quarterly(spark, sf_dir):
    s = sales(spark, sf_dir).withColumn("saleYearQuarter", quarter_label("saleYearMonth"))
    return I.quarterly_stats(s, "saleYearQuarter", "salePrice")


@query("agg_21_quarterly_mean_median", _Q + f"""
SELECT saleYearQuarter, {R('salePrice_mean', 4)} AS salePrice_mean, {R('salePrice_median', 4)} AS salePrice_median FROM q""")
def agg_21(spark, sf_dir):
    q = _quarterly(spark, sf_dir)
    return q.select("saleYearQuarter", rnd("salePrice_mean", 4).alias("salePrice_mean"),
                    rnd("salePrice_median", 4).alias("salePrice_median"))


@query("set_05_melt_with_labels", _Q + f"""
SELECT saleYearQuarter, 'Average Sale Price' AS metric, {R('salePrice_mean', 4)} AS price FROM q
UNION ALL SELECT saleYearQuarter, 'Median Sale Price' AS metric, {R('salePrice_median', 4)} AS price FROM q""")
def set_05(spark, sf_dir):
    m = I.melt(_quarterly(spark, sf_dir), ["saleYearQuarter"], ["salePrice_mean", "salePrice_median"], "metric",
               "price", I.METRIC_LABELS)
    return m.withColumn("price", rnd("price", 4))


@query("agg_22_top_05_latest_month_street_type", sales_with() + f"""
SELECT saleYearMonth, street, propertyType, {R('avg(salePrice)', 4)} AS salePrice, count(*) AS counts FROM sales
GROUP BY ALL ORDER BY saleYearMonth DESC, avg(salePrice) DESC, street, propertyType LIMIT 10""")
def agg_22(spark, sf_dir):
    g = sales(spark, sf_dir).groupBy("saleYearMonth", "street", "propertyType").agg(
        F.avg("salePrice").alias("salePrice"), F.count(F.lit(1)).alias("counts"))
    top = I.top_k(g, 10, [F.desc("saleYearMonth"), F.desc("salePrice"), "street", "propertyType"])
    return top.withColumn("salePrice", rnd("salePrice", 4))


@query("top_03_top20_streets", sales_with(f"st AS (SELECT {R('avg(salePrice)', 4)} AS mean_sale_price, {R('median(salePrice)', 4)} AS median_sale_price, custkey % 40 AS street_no FROM sales GROUP BY street_no)") + """
SELECT street_no, mean_sale_price, median_sale_price FROM st ORDER BY mean_sale_price DESC, street_no LIMIT 20""")
def top_03(spark, sf_dir):
    from panelforge.operators.groups import grouped
    s = sales(spark, sf_dir).withColumn("street_no", F.col("custkey") % 40)
    g = grouped(s, ["street_no"], [("mean", "salePrice", "mean"), ("median", "salePrice", "median")])
    g = g.select("street_no", rnd("mean", 4).alias("mean_sale_price"), rnd("median", 4).alias("median_sale_price"))
    return I.top_k(g, 20, [F.desc("mean_sale_price"), "street_no"])


@query("agg_23_26_27_latest_mode_bounds", sales_with("""m AS (SELECT suburb, count(*) AS n FROM sales GROUP BY 1)""") + """
SELECT (SELECT max(saleYearMonth) FROM sales) AS latest_year_month,
  (SELECT suburb FROM m ORDER BY n DESC, suburb LIMIT 1) AS suburb_mode,
  (SELECT CAST(min(year(saleDate)) AS INTEGER) FROM sales) AS saleYear_min,
  (SELECT CAST(max(year(saleDate)) AS INTEGER) FROM sales) AS saleYear_max""")
def agg_23_26_27(spark, sf_dir):
    s = sales(spark, sf_dir).withColumn("saleYear", F.year("saleDate").cast("int"))
    latest = I.latest_month(s, ["saleYearMonth", "observingYearMonth"]).select(F.col("latest_year_month"))
    mode = I.most_frequent(s, "suburb")
    b = I.bounds(s, "saleYear")
    return s.limit(1).select(latest.scalar().alias("latest_year_month"), mode.scalar().alias("suburb_mode"),
                             b.select("saleYear_min").scalar().alias("saleYear_min"),
                             b.select("saleYear_max").scalar().alias("saleYear_max"))


@query("srt_01_multi_key_sort_rank", sales_with() + """
SELECT row_id, CAST(row_number() OVER (PARTITION BY suburb ORDER BY landSizeM2 ASC NULLS LAST, saleDate, row_id) AS BIGINT) AS pos
FROM sales""")
def srt_01(spark, sf_dir):
    order = [F.col("landSizeM2").asc_nulls_last(), F.col("saleDate"), F.col("row_id")]
    rows = sales(spark, sf_dir).select("row_id", "suburb", "landSizeM2", "saleDate")
    return I.ordered_positions(rows, ["suburb"], order).select("row_id", "pos")


@query("smp_01_seeded_sample")
def smp_01(spark, sf_dir):
    return I.seeded_sample(sales(spark, sf_dir), 4000, seed=7).select("row_id", "salePrice", "landSizeM2")


@query("set_01_union_by_name", sales_with() + """
SELECT row_id, CASE WHEN propertyType IN ('BUILDING', 'AUTOMOBILE') THEN salePrice END AS salePrice,
  CASE WHEN propertyType IN ('BUILDING', 'AUTOMOBILE') THEN NULL ELSE landSizeM2 END AS landSizeM2,
  CASE WHEN propertyType IN ('BUILDING', 'AUTOMOBILE') THEN 'a' ELSE 'b' END AS part FROM sales""")
def set_01(spark, sf_dir):
    s = sales(spark, sf_dir)
    first = F.coalesce(F.col("propertyType").isin("BUILDING", "AUTOMOBILE"), F.lit(False))
    a = s.where(first).select("row_id", "salePrice", F.lit("a").alias("part"))
    b = s.where(~first).select("row_id", "landSizeM2", F.lit("b").alias("part"))
    return a.unionByName(b, allowMissingColumns=True)


_SEGMENT_PARTS = {"BUILDING": ("a", "salePrice"), "MACHINERY": ("b", "landSizeM2"), "AUTOMOBILE": ("c", "yearBuilt"),
                  "FURNITURE": ("d", "salePrice"), "HOUSEHOLD": ("e", "landSizeM2")}


@query("set_01_union_by_name_all_segments", sales_with() + " UNION ALL ".join(
    "SELECT row_id, " + ", ".join(c if c == col else f"CAST(NULL AS {t}) AS {c}" for c, t in
                                  (("salePrice", "DOUBLE"), ("landSizeM2", "DOUBLE"), ("yearBuilt", "INTEGER")))
    + f", '{part}' AS part FROM sales WHERE propertyType = '{segment}'" for segment, (part, col) in _SEGMENT_PARTS.items()))
def set_01_all(spark, sf_dir):
    s = sales(spark, sf_dir)
    parts = [s.where(F.col("propertyType") == segment).select("row_id", col, F.lit(part).alias("part"))
             for segment, (part, col) in _SEGMENT_PARTS.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.select("row_id", "salePrice", "landSizeM2", "yearBuilt", "part")


@query("set_02_jon_06_distinct_address_lookup", sales_with(
    "a AS (SELECT DISTINCT street, suburb, region FROM sales)",
    "lk AS (SELECT DISTINCT street, suburb, CAST(n_regionkey * 1.5 - 37.0 AS DOUBLE) AS latitude, CAST(n_nationkey * 0.5 + 144.0 AS DOUBLE) AS longitude FROM sales JOIN nation ON suburb = n_name)") + """
SELECT a.street, a.suburb, a.region, lk.latitude, lk.longitude FROM a JOIN lk ON a.street = lk.street AND a.suburb = lk.suburb""")
def set_02(spark, sf_dir):
    from panelforge.sources.files import read_table
    s = sales(spark, sf_dir)
    n = read_table(spark, sf_dir, "nation")
    lookup = (s.select("street", "suburb").distinct()
               .join(n, F.col("suburb") == F.col("n_name"))
               .select("street", "suburb", (F.col("n_regionkey") * 1.5 - 37.0).alias("latitude"),
                       (F.col("n_nationkey") * 0.5 + 144.0).alias("longitude")))
    return distinct_lookup(s, ["street", "suburb", "region"], lookup)


_SUBURB_MONTHS = sales_with(f"""seen AS (SELECT DISTINCT suburb, saleType, {SALES_T} AS o FROM sales),
b AS (SELECT min(o) AS lo, max(o) AS hi FROM seen), g AS (SELECT DISTINCT suburb, saleType FROM seen),
ex AS (SELECT suburb, saleType, unnest(range(lo, hi + 1)) AS o FROM g, b)""")


@query("set_03_jon_10_expected_minus_seen_months", _SUBURB_MONTHS + """
SELECT suburb, saleType, CAST((o // 12) * 100 + o % 12 + 1 AS INTEGER) AS missing_month FROM ex ANTI JOIN seen USING (suburb, saleType, o)""")
def set_03(spark, sf_dir):
    """Months of the whole calendar that a suburb and sale type lack."""
    from panelforge.functions.dates import month_ordinal, ordinal_to_year_month
    keys = ["suburb", "saleType"]
    seen = sales(spark, sf_dir).select(*keys, month_ordinal("saleYearMonth").alias("o")).distinct()
    lo, hi = seen.select(F.min("o")).scalar(), seen.select(F.max("o")).scalar()
    expected = seen.select(*keys).distinct().withColumn("o", F.explode(F.sequence(lo, hi)))
    return anti_by_keys(expected, seen, [*keys, "o"]).select(*keys, ordinal_to_year_month(F.col("o")).alias("missing_month"))


_GROUP_MONTHS = sales_with(f"""seen AS (SELECT DISTINCT suburb, propertyType, street, {SALES_T} AS o FROM sales),
b AS (SELECT suburb, propertyType, street, min(o) AS lo, max(o) AS hi FROM seen GROUP BY ALL),
ex AS (SELECT suburb, propertyType, street, unnest(range(lo, hi + 1)) AS o FROM b)""")


@query("set_03_jon_10_expected_minus_seen_months_all_groups", _GROUP_MONTHS + """
SELECT suburb, propertyType, street, CAST((o // 12) * 100 + o % 12 + 1 AS INTEGER) AS missing_month
FROM ex ANTI JOIN seen USING (suburb, propertyType, street, o)""")
def set_03_all(spark, sf_dir):
    from panelforge.functions.dates import month_ordinal, ordinal_to_year_month
    keys = ["suburb", "propertyType", "street"]
    seen = sales(spark, sf_dir).select(*keys, month_ordinal("saleYearMonth").alias("o")).distinct()
    expected = seen.groupBy(*keys).agg(F.min("o").alias("lo"), F.max("o").alias("hi")).select(
        *keys, F.explode(F.sequence("lo", "hi")).alias("o"))
    return anti_by_keys(expected, seen, [*keys, "o"]).select(*keys, ordinal_to_year_month(F.col("o")).alias("missing_month"))


@query("set_04_jon_09_active_groups", sales_with("""v AS (SELECT suburb, propertyType FROM sales GROUP BY ALL
  HAVING count(*) >= 120 AND count(DISTINCT saleYearMonth) >= 60)""") + """
SELECT row_id FROM sales SEMI JOIN v USING (suburb, propertyType)""")
def set_04(spark, sf_dir):
    s = sales(spark, sf_dir)
    return semi_by_activity(s, ["suburb", "propertyType"], "saleYearMonth", 120, 60).select("row_id")


@query("prj_05_07_08_projection_reindex_rename", sales_with() + """
SELECT row_id AS id, salePrice AS price, saleYearMonth, CAST(NULL AS DOUBLE) AS floorSizeM2, landSizeM2 FROM sales""")
def prj_05_07_08(spark, sf_dir):
    from panelforge.operators.lookup import reindex
    s = sales(spark, sf_dir).withColumnsRenamed({"row_id": "id", "salePrice": "price"})
    return reindex(s, {"id": "bigint", "price": "double", "saleYearMonth": "int", "floorSizeM2": "double",
                       "landSizeM2": "double"})


