"""Registered queries: panel operators (DAT-05, AGG-09..15, AGG-24, WIN-07..12, JON-09, GAP-01)."""
from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.functions.nulls import rnd
from panelforge.operators.panel import (build_segments, gap_share, group_month_table, missing_months, month_index,
                                        relative_pricing, segment_meta, suburb_rollups)
from panelforge.plans.blocks import run_blocks, segment_table
from panelforge.plans.derive import run_derive
from panelforge.plans.registry import query
from panelforge.plans.sqlkit import R, SALES_T, sales_with
from panelforge.plans.views import sales


@query("dat_05_dense_month_index", sales_with() + """
SELECT row_id, CAST(dense_rank() OVER (ORDER BY saleYearMonth) - 1 + 100 AS INTEGER) AS month_id FROM sales""")
def dat_05(spark, sf_dir):
    return month_index(sales(spark, sf_dir), offset=100).select("row_id", F.col("month_id").cast("int"))


@query("agg_11_group_month_table", sales_with() + f"""
SELECT suburb, saleYearMonth, {R('median(salePrice)', 4)} AS median, count(salePrice) AS count,
       {R('stddev_samp(salePrice)', 4)} AS std FROM sales GROUP BY ALL""")
def agg_11(spark, sf_dir):
    t = group_month_table(sales(spark, sf_dir), ["suburb"], "saleYearMonth", "salePrice")
    return t.select("suburb", "saleYearMonth", rnd("median", 4).alias("median"), "count", rnd("std", 4).alias("std"))


def _rollup_sql(group_extra: str = "", where: str = "", prefix: str = "suburb") -> str:
    """Oracle text for WIN-07/08 on a (suburb[, tag]) x month table."""
    part = "suburb" + (f", {group_extra}" if group_extra else "")
    w = f"PARTITION BY {part} ORDER BY saleYearMonth"
    rows = lambda k: f"({w} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
    roll = []
    for k in (3, 6, 12):
        roll.append(f"median(median_prior) OVER {rows(k)} AS {prefix}_price_median_{k}m")
        roll.append(f"CASE WHEN count(count_prior) OVER {rows(k)} > 0 THEN CAST(sum(count_prior) OVER {rows(k)} AS DOUBLE) END AS {prefix}_txn_count_{k}m")
        roll.append(f"avg(std_prior) OVER {rows(k)} AS {prefix}_volatility_{k}m")
    return f"""sm_{prefix} AS (SELECT {part}, saleYearMonth, median(salePrice) AS median, count(salePrice) AS cnt,
                 stddev_samp(salePrice) AS std FROM src_{prefix} {where} GROUP BY ALL),
p_{prefix} AS (SELECT *, lag(median) OVER ({w}) AS median_prior, lag(cnt) OVER ({w}) AS count_prior,
                 lag(std) OVER ({w}) AS std_prior FROM sm_{prefix}),
r_{prefix} AS (SELECT *, {', '.join(roll)},
                 last_value(median_prior IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ff
          FROM p_{prefix}),
d_{prefix} AS (SELECT *, ff / nullif(lag(ff, 3) OVER ({w}), 0) - 1 AS {prefix}_delta_3m,
                 ff / nullif(lag(ff, 12) OVER ({w}), 0) - 1 AS {prefix}_delta_12m FROM r_{prefix})"""


_ROLL_OUT = ["suburb_price_median_current", "count", "std"] + \
    [f"suburb_{m}_{k}m" for k in (3, 6, 12) for m in ("price_median", "txn_count", "volatility")] + \
    ["suburb_delta_3m", "suburb_delta_12m"]


def _r(c):
    return 0 if c in ("count",) or "txn_count" in c else (6 if "delta" in c else 4)


@query("win_07_08_lagged_suburb_rollups_momentum", sales_with("src_suburb AS (SELECT * FROM sales)", _rollup_sql()) + f"""
SELECT row_id, {', '.join((R(('median_prior' if c == 'suburb_price_median_current' else 'count_prior' if c == 'count' else 'std_prior' if c == 'std' else c), _r(c)) if _r(c) else ('count_prior' if c == 'count' else c)) + ' AS ' + c for c in _ROLL_OUT)}
FROM sales s LEFT JOIN d_suburb d ON s.suburb = d.suburb AND s.saleYearMonth = d.saleYearMonth""")
def win_07(spark, sf_dir):
    out = suburb_rollups(sales(spark, sf_dir))
    return out.select("row_id", *[(rnd(c, _r(c)) if _r(c) else F.col(c)).alias(c) for c in _ROLL_OUT])


TYPE_MAP = {"building": "House", "household": "House", "machinery": "Unit", "automobile": "Unit"}
_TAG_SQL = ("CASE upper(trim(coalesce(propertyType, ''))) WHEN 'BUILDING' THEN 'house' WHEN 'HOUSEHOLD' THEN 'house' "
            "WHEN 'MACHINERY' THEN 'unit' WHEN 'AUTOMOBILE' THEN 'unit' ELSE 'other' END")
_TAG_OUT = [("house", "price_median_current"), ("unit", "price_median_6m"), ("other", "txn_count_current"),
            ("house", "volatility_12m"), ("unit", "delta_3m"), ("other", "txn_count_12m")]


def _tag_cols_sql():
    out = []
    for tag, m in _TAG_OUT:
        src = {"price_median_current": "median_prior", "txn_count_current": "count_prior",
               "volatility_current": "std_prior"}.get(m, f"tag_{m}")
        val = f"max(CASE WHEN tag = '{tag}' THEN {src} END)"
        out.append(f"{val} AS suburb_{tag}_{m}")
    return ", ".join(out)


@query("agg_12_per_type_rollups", sales_with(f"src_tag AS (SELECT *, {_TAG_SQL} AS tag FROM sales)",
                                              _rollup_sql("tag", prefix="tag"),
                                              f"wide AS (SELECT suburb, saleYearMonth, {_tag_cols_sql()} FROM d_tag GROUP BY ALL)") + f"""
SELECT row_id, {', '.join((R(f'suburb_{t}_{m}', 6 if 'delta' in m else 4) if 'count' not in m else f'CAST(suburb_{t}_{m} AS DOUBLE)') + f' AS suburb_{t}_{m}' for t, m in _TAG_OUT)}
FROM sales s LEFT JOIN wide w ON s.suburb = w.suburb AND s.saleYearMonth = w.saleYearMonth""")
def agg_12(spark, sf_dir):
    out = suburb_rollups(sales(spark, sf_dir), type_col="propertyType", type_map=TYPE_MAP, type_default="other")
    cols = [f"suburb_{t}_{m}" for t, m in _TAG_OUT]
    return out.select("row_id", *[(rnd(c, 6 if "delta" in c else 4) if "count" not in c else F.col(c).cast("double")).alias(c)
                                  for c in cols])


@query("agg_13_14_15_relative_pricing", sales_with("src_suburb AS (SELECT * FROM sales)", _rollup_sql(), """
rm AS (SELECT region, saleYearMonth, median(salePrice) AS rmed FROM sales GROUP BY ALL),
st AS (SELECT street, sum(salePrice) AS s, count(salePrice) AS n FROM sales GROUP BY ALL),
sb AS (SELECT suburb, sum(salePrice) AS s, count(salePrice) AS n FROM sales GROUP BY ALL)""") + f"""
SELECT row_id, {R('salePrice / nullif(d.median_prior, 0)', 6)} AS rel_price_vs_suburb_median,
       {R('salePrice / nullif(rm.rmed, 0)', 6)} AS rel_price_vs_region_median,
       CASE WHEN st.n >= 5 THEN {R('(CASE WHEN st.n > 1 THEN (st.s - salePrice) / (st.n - 1) END) / nullif(CASE WHEN sb.n > 1 THEN (sb.s - salePrice) / (sb.n - 1) END, 0)', 6)} END AS rel_street_effect
FROM sales s LEFT JOIN d_suburb d ON s.suburb = d.suburb AND s.saleYearMonth = d.saleYearMonth
     JOIN rm ON s.region = rm.region AND s.saleYearMonth = rm.saleYearMonth
     JOIN st ON s.street = st.street JOIN sb ON s.suburb = sb.suburb""")
def agg_13_14_15(spark, sf_dir):
    out = relative_pricing(suburb_rollups(sales(spark, sf_dir)), region_col="region", street_col="street", min_samples=5)
    return out.select("row_id", *[rnd(c, 6).alias(c) for c in ("rel_price_vs_suburb_median",
                                                                "rel_price_vs_region_median", "rel_street_effect")])


SEG_KEYS = ["suburb", "propertyType"]
SEG_SPEC = dict(
    metrics=[{"name": "current_price_median", "source": "salePrice", "agg": "median"},
             {"name": "mean_price", "source": "salePrice", "agg": "mean"},
             {"name": "land_count", "source": "landSizeM2", "agg": "count"}],
    carry={"columns": ["region"]},
    min_rows=40, min_months=50,
    future_targets=[
        {"name": "price_future_3m", "source": "salePrice", "agg": "median", "horizon": 3, "window": 1,
         "smooth": {"window": 4, "min_periods": 2}},
        {"name": "price_future_6m", "source": "salePrice", "agg": "mean", "horizon": 6, "window": 3,
         "min_periods": 2, "derived": [{"type": "ratio"}], "drop_na": True},
    ])
SEG_OUT = {"record_count": 0, "current_price_median": 4, "mean_price": 4, "land_count": 0, "region": None,
           "price_future_3m": 4, "price_future_3m_delta": 6, "price_future_3m_diff": 4, "price_future_3m_smooth": 4,
           "price_future_3m_smooth_delta": 6, "price_future_3m_smooth_diff": 4, "price_future_6m": 4,
           "price_future_6m_ratio": 6, "current_price_median_roll_mean_12m": 4, "current_price_median_roll_std_12m": 4,
           "current_price_median_z_12m": 6, "current_price_median_yoy": 6, "current_price_median_6m_change": 6,
           "observingYearMonth": 0}

_SW = "PARTITION BY suburb, propertyType ORDER BY saleYearMonth"
SEG_SQL = sales_with(f"""
seg0 AS (SELECT suburb, propertyType, saleYearMonth, count(*) AS record_count, median(salePrice) AS current_price_median,
                avg(salePrice) AS mean_price, count(landSizeM2) AS land_count, arg_min(region, row_id) AS region
         FROM sales GROUP BY ALL),
act AS (SELECT suburb, propertyType FROM sales GROUP BY ALL HAVING count(*) >= 40 AND count(DISTINCT saleYearMonth) >= 50),
fv AS (SELECT suburb, propertyType, saleYearMonth, lead(median(salePrice), 3) OVER ({_SW}) AS price_future_3m,
              lead(avg(salePrice), 6) OVER ({_SW}) AS f6 FROM sales GROUP BY suburb, propertyType, saleYearMonth),
fv2 AS (SELECT *, CASE WHEN count(f6) OVER ({_SW} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) >= 2
                      THEN avg(f6) OVER ({_SW} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) END AS price_future_6m FROM fv),
seg1 AS (SELECT seg0.*, fv2.price_future_3m, fv2.price_future_6m FROM seg0 SEMI JOIN act USING (suburb, propertyType)
         LEFT JOIN fv2 USING (suburb, propertyType, saleYearMonth)),
seg2 AS (SELECT *,
   CASE WHEN count(current_price_median) OVER ({_SW} ROWS 11 PRECEDING) >= 3 THEN avg(current_price_median) OVER ({_SW} ROWS 11 PRECEDING) END AS current_price_median_roll_mean_12m,
   CASE WHEN count(current_price_median) OVER ({_SW} ROWS 11 PRECEDING) >= 3 THEN stddev_samp(current_price_median) OVER ({_SW} ROWS 11 PRECEDING) END AS current_price_median_roll_std_12m,
   current_price_median / nullif(lag(current_price_median, 12) OVER ({_SW}), 0) - 1 AS current_price_median_yoy,
   current_price_median / nullif(lag(current_price_median, 6) OVER ({_SW}), 0) - 1 AS current_price_median_6m_change,
   price_future_3m / nullif(current_price_median, 0) - 1 AS price_future_3m_delta,
   price_future_3m - current_price_median AS price_future_3m_diff,
   CASE WHEN count(price_future_3m) OVER ({_SW} ROWS 3 PRECEDING) >= 2 THEN avg(price_future_3m) OVER ({_SW} ROWS 3 PRECEDING) END AS price_future_3m_smooth,
   price_future_6m / nullif(current_price_median, 0) AS price_future_6m_ratio
  FROM seg1)""") + f"""
SELECT suburb, propertyType, saleYearMonth, record_count, {R('current_price_median', 4)} AS current_price_median,
  {R('mean_price', 4)} AS mean_price, land_count, region,
  {R('price_future_3m', 4)} AS price_future_3m, {R('price_future_3m_delta', 6)} AS price_future_3m_delta,
  {R('price_future_3m_diff', 4)} AS price_future_3m_diff, {R('price_future_3m_smooth', 4)} AS price_future_3m_smooth,
  {R('price_future_3m_smooth / nullif(current_price_median, 0) - 1', 6)} AS price_future_3m_smooth_delta,
  {R('price_future_3m_smooth - current_price_median', 4)} AS price_future_3m_smooth_diff,
  {R('price_future_6m', 4)} AS price_future_6m, {R('price_future_6m_ratio', 6)} AS price_future_6m_ratio,
  {R('current_price_median_roll_mean_12m', 4)} AS current_price_median_roll_mean_12m,
  {R('current_price_median_roll_std_12m', 4)} AS current_price_median_roll_std_12m,
  {R('(current_price_median - current_price_median_roll_mean_12m) / nullif(current_price_median_roll_std_12m, 0)', 6)} AS current_price_median_z_12m,
  {R('current_price_median_yoy', 6)} AS current_price_median_yoy,
  {R('current_price_median_6m_change', 6)} AS current_price_median_6m_change,
  saleYearMonth AS observingYearMonth
FROM seg2 WHERE price_future_6m IS NOT NULL AND price_future_6m_ratio IS NOT NULL"""


def segments(spark, sf_dir):
    return build_segments(sales(spark, sf_dir), SEG_KEYS, "saleYearMonth", **SEG_SPEC)


@query("agg_09_10_win_09_12_prj_09_segment_table", SEG_SQL)
def agg_09(spark, sf_dir):
    seg = segments(spark, sf_dir)
    return seg.select(*SEG_KEYS, "saleYearMonth",
                      *[(rnd(c, k) if k else F.col(c)).alias(c) for c, k in SEG_OUT.items()])


#: The segment table above as a spec of named blocks.
SEG_BLOCKS = {"grouping": {"keys": SEG_KEYS, "month_col": "saleYearMonth", "min_rows": SEG_SPEC.get("min_rows", 0),
                           "min_months": SEG_SPEC.get("min_months", 0)},
              "aggregations": {"metrics": SEG_SPEC["metrics"], "carry": SEG_SPEC.get("carry")},
              "future_targets": SEG_SPEC["future_targets"]}


@query("udf_04_segments_from_spec", SEG_SQL)
def udf_04_segments(spark, sf_dir):
    seg = segment_table(run_blocks(sales(spark, sf_dir), SEG_BLOCKS), SEG_BLOCKS)
    return seg.select(*SEG_KEYS, "saleYearMonth", *[(rnd(c, k) if k else F.col(c)).alias(c) for c, k in SEG_OUT.items()])


#: Written in an order that only the blocks' inputs put right.
DERIVE_BLOCKS = {
    "age_bands": {"bands": [5, 20]},
    "buckets": {"land": {"source": "landSizeM2", "bins": [2000, 6000], "labels": ["small", "medium", "large"], "output": "landBand"},
                "urgency": {"source": "street", "mapping": {"1-URGENT": "now", "2-HIGH": "now"}}},
    "per_mean": {"fn": "ratio", "numerator": "salePrice", "denominator": "meanOfType", "output": "vsType", "clip_max": 1.5, "drop_na": True},
    "price_per_area": {"area_col": "landSizeM2", "output": "pricePerSqm", "denominator_min": 100, "clip_min": 1},
    "type_mean": {"group_by": ["propertyType", "saleYear"], "target": "salePrice", "aggregate": "mean", "output": "meanOfType"},
    "property_age": {"min_age": 0},
    "month_cyclical": {"out_prefix": "m"},
    "month_index": {"offset": 1},
    "macro_join": {"path": "yearly"},
    "skipped": {"enabled": False, "fn": "ratio"},
    "region_prefix": {"fn": "price_per_area", "area_col": "landSizeM2", "price_col": "yearBuilt", "output": "yearPerArea"},
}


@query("udf_03_04_named_blocks", sales_with("""d AS (SELECT *, CAST(year(saleDate) AS INTEGER) AS y, avg(salePrice) OVER (
  PARTITION BY propertyType, year(saleDate)) AS mt, dense_rank() OVER (ORDER BY year(saleDate) * 12 + month(saleDate)) AS mi,
  CASE WHEN year(saleDate) - yearBuilt >= 0 THEN year(saleDate) - yearBuilt END AS age FROM sales),
yt AS (SELECT CAST(year(saleDate) AS INTEGER) AS y, count(*) AS n FROM sales WHERE year(saleDate) % 2 = 0 GROUP BY 1)""") + f"""
SELECT row_id, {R('salePrice / mt', 6)} AS vsType, {R("CASE WHEN landSizeM2 >= 100 AND salePrice / landSizeM2 >= 1 THEN salePrice / landSizeM2 END", 6)} AS pricePerSqm,
  {R('yearBuilt / nullif(landSizeM2, 0)', 6)} AS yearPerArea, {R('sin(2 * pi() * month(saleDate) / 12)', 6)} AS m_sin, CAST(mi AS INTEGER) AS month_id,
  CASE WHEN age <= 5 THEN '0–5' WHEN age <= 20 THEN '6–20' WHEN age > 20 THEN '21+' END AS propertyAgeBand, n AS sales_of_year,
  CASE WHEN landSizeM2 IS NULL THEN 'Unknown' WHEN landSizeM2 <= 2000 THEN 'small' WHEN landSizeM2 <= 6000 THEN 'medium' ELSE 'large' END AS landBand,
  CASE street WHEN '1-URGENT' THEN 'now' WHEN '2-HIGH' THEN 'now' ELSE 'Unknown' END AS urgency_bucket
FROM d LEFT JOIN yt USING (y) WHERE salePrice / mt <= 1.5""")
def udf_03_04(spark, sf_dir):
    s = sales(spark, sf_dir)
    yearly = (s.groupBy(F.year("saleDate").cast("int").alias("year")).agg(F.count(F.lit(1)).alias("sales_of_year"))
              .where(F.col("year") % 2 == 0))
    out = run_derive(s, [{"type": "blocks", "blocks": DERIVE_BLOCKS}], datasets={"yearly": yearly})
    return out.select("row_id", rnd("vsType", 6).alias("vsType"), rnd("pricePerSqm", 6).alias("pricePerSqm"),
                      rnd("yearPerArea", 6).alias("yearPerArea"), rnd("m_sin", 6).alias("m_sin"), F.col("month_id").cast("int").alias("month_id"),
                      "propertyAgeBand", "sales_of_year", "landBand", "urgency_bucket")


@query("agg_24_segment_meta", f"WITH s AS ({SEG_SQL}) SELECT count(*) AS rows, "
       "count(DISTINCT (suburb, propertyType)) AS groups, count(price_future_3m) AS nonnull_price_future_3m, "
       "count(price_future_3m_smooth) AS nonnull_price_future_3m_smooth, count(price_future_6m) AS nonnull_price_future_6m FROM s")
def agg_24(spark, sf_dir):
    return segment_meta(segments(spark, sf_dir), SEG_KEYS,
                        ["price_future_3m", "price_future_3m_smooth", "price_future_6m"])


_GAP_G = "suburb, propertyType, street"
GAP_SQL = sales_with(f"""
dm AS (SELECT DISTINCT {_GAP_G}, {SALES_T} AS o FROM sales),
per AS (SELECT {_GAP_G}, min(o) AS lo, max(o) AS hi, count(*) AS seen FROM dm GROUP BY ALL),
ex AS (SELECT {_GAP_G}, lo, hi, seen, unnest(range(lo, hi + 1)) AS o FROM per),
miss AS (SELECT ex.* FROM ex ANTI JOIN dm USING ({_GAP_G}, o))""") + f"""
SELECT {_GAP_G}, list(CAST((o // 12) * 100 + o % 12 + 1 AS INTEGER) ORDER BY o) AS missing_months,
       CAST(count(*) AS INTEGER) AS missing_count, hi - lo + 1 AS total_months_span, CAST(seen AS INTEGER) AS months_with_data,
       CAST((lo // 12) * 100 + lo % 12 + 1 AS INTEGER) AS min_month, CAST((hi // 12) * 100 + hi % 12 + 1 AS INTEGER) AS max_month
FROM miss GROUP BY {_GAP_G}, lo, hi, seen"""


@query("gap_01_missing_months_by_group", GAP_SQL)
def gap_01(spark, sf_dir):
    return missing_months(sales(spark, sf_dir), ["suburb", "propertyType", "street"])


@query("gap_01_overall_gap_share", f"WITH g AS ({GAP_SQL}) SELECT (SELECT count(*) FROM g) AS groups_with_gaps, "
       f"(SELECT count(*) FROM (SELECT DISTINCT n_name, c_mktsegment, o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey "
       "JOIN nation ON c_nationkey = n_nationkey)) AS groups, "
       f"round((SELECT count(*) FROM g) * 100.0 / (SELECT count(*) FROM (SELECT DISTINCT n_name, c_mktsegment, o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)), 1) AS pct_with_gaps")
def gap_01_share(spark, sf_dir):
    return gap_share(sales(spark, sf_dir), ["suburb", "propertyType", "street"])
