"""Registered queries: scalar functions (STR-07..17, DAT-*, MTH-*, EXP-*, BIN-*)."""
from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.functions import arith, bins, dates, strings
from panelforge.functions.nulls import rnd, safe_div
from panelforge.plans.registry import query
from panelforge.plans.sqlkit import R, SALES_T, sales_with
from panelforge.plans.views import sales

LKEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


# --- STR-07 street extraction -------------------------------------------------------------------
def _street_sql(c: str) -> str:
    q = lambda p: p.replace("'", "''")
    s = f"trim(string_split(trim({c}), ',')[-1])"
    s = f"regexp_replace({s}, '(?i){q(strings.UNIT_SLASH_PATTERN)}', '')"
    for p in strings.UNIT_PATTERNS:
        s = f"regexp_replace({s}, '(?i){q(p)}', '')"
    for _ in range(strings.NUMBER_PASSES):
        for p in strings.NUMBER_PATTERNS:
            s = f"regexp_replace({s}, '{q(p)}', '')"
    s = f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"
    s = f"regexp_replace({s}, '^(?:\\S*\\d\\S*(?: |$))+', '')"
    s = f"regexp_replace({s}, '^- +', '')"
    s = f"regexp_replace(trim({s}), ',+$', '')"
    return s


def title_sql(s: str) -> str:
    return (f"array_to_string(list_transform(range(1, length({s}) + 1), lambda i: CASE WHEN i = 1 OR NOT "
            f"regexp_matches(substring({s}, i - 1, 1), '[A-Za-z]') THEN upper(substring({s}, i, 1)) "
            f"ELSE lower(substring({s}, i, 1)) END), '')")


STREET_SQL = sales_with(f"st AS (SELECT row_id, {_street_sql('streetAddress')} AS s FROM sales)") + f"""
SELECT row_id, CASE WHEN s IS NULL OR s = '' THEN 'Unknown' ELSE {title_sql('s')} END AS street_name FROM st"""


@query("str_07_street_extraction", STREET_SQL)
def str_07(spark, sf_dir):
    return sales(spark, sf_dir).select("row_id", strings.extract_street("streetAddress").alias("street_name"))


@query("str_14_clean_distinct_streets", f"WITH x AS ({STREET_SQL}) " + """
SELECT DISTINCT street_name AS street FROM (SELECT trim(street_name) AS street_name FROM x)
WHERE street_name <> '' AND lower(street_name) <> 'unknown' AND NOT regexp_matches(street_name, '\\d')""")
def str_14(spark, sf_dir):
    from panelforge.operators.insights import clean_distinct
    s = sales(spark, sf_dir).select(strings.extract_street("streetAddress").alias("street"))
    return clean_distinct(s, "street", no_digits=True, title=False)


@query("str_08_09_prefix_and_slug", sales_with() + """
SELECT row_id, substring(trim(CAST(3000 + custkey % 250 AS VARCHAR)), 1, 2) AS postcode_prefix,
  coalesce(nullif(regexp_replace(regexp_replace(lower(propertyType || ' / ' || street), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'other') AS type_slug
FROM sales""")
def str_08_09(spark, sf_dir):
    s = sales(spark, sf_dir)
    return s.select("row_id", strings.prefix((F.lit(3000) + F.col("custkey") % 250).cast("string"), 2).alias("postcode_prefix"),
                    strings.slugify(F.concat("propertyType", F.lit(" / "), "street")).alias("type_slug"))


# two synthetic text columns that exercise every classifier rule
_PTYPE = ("HOUSE", "unit: standard", "Flat 2", "HIGH-RISE APARTMENT", "BUSINESS PARK", "other", "VILLA", "")
_LAND = ("DETACHED DWELLING", "TOWNHOUSE", "OFFICE PREMISES", "strata unit or flat  (unspecified)", "", "SHED")


def _pick(col, values):
    e = F.lit(values[-1])
    for i in reversed(range(len(values) - 1)):
        e = F.when(col == i, F.lit(values[i])).otherwise(e)
    return e


def _pick_sql(expr, values):
    parts = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values[:-1]))
    return f"CASE {expr} {parts} ELSE '{values[-1]}' END"


def _cat_sql(p, l):
    P, L = f"upper(trim({p}))", f"upper(trim({l}))"
    return f"""CASE WHEN {P} IN ('HOUSE', 'HOUSE: STANDARD', 'HOUSE: ONE STOREY / LOWSET') THEN 'House'
  WHEN {L} IN ('DETACHED DWELLING', 'DETACHED DWELLING (EXISTING)') THEN 'House'
  WHEN {P} IN ('UNIT', 'UNIT: STANDARD', 'UNIT: TOWNHOUSE/VILLA') THEN 'Unit'
  WHEN {L} IN ('TOWNHOUSE', 'SINGLE STRATA UNIT/VILLA UNIT/TOWNHOUSE', 'OYO UNIT', 'OYO SUBDIVIDED DWELLING') THEN 'Unit'
  WHEN contains({P}, 'FLAT') THEN 'Flat'
  WHEN contains({P}, 'APARTMENT') OR contains({P}, 'HIGH-RISE') OR contains({P}, 'MID-RISE') THEN 'Apartment'
  WHEN {L} IN ('STRATA UNIT OR FLAT  (UNSPECIFIED)', 'OYO SUBDIVIDED FLAT') THEN 'Apartment'
  WHEN starts_with({P}, 'BUSINESS') OR starts_with({P}, 'COMMERCIAL') OR {P} = 'OTHER' THEN 'Other'
  WHEN {L} IN ('UNKNOWN', 'OTHER', 'VACANT RESIDENTIAL DWELLING SITE/SURVEYED LOT', 'RES LAND (WITH BUILDINGS THAT ADD NO VALUE)',
               'GENERAL PURPOSE WAREHOUSE', 'GENERAL PURPOSE FACTORY', 'RETAIL PREMISES (SINGLE OCCUPANCY)', 'OFFICE PREMISES') THEN 'Other'
  ELSE 'Other' END"""


@query("str_10_11_type_classifiers", sales_with(f"""t AS (SELECT row_id, {_pick_sql('row_id % 8', _PTYPE)} AS ptype,
  {_pick_sql('custkey % 6', _LAND)} AS land FROM sales)""") + f"""
SELECT row_id, {_cat_sql('ptype', 'land')} AS propertyCategory,
  CASE WHEN contains(upper(ptype), 'HOUSE') THEN 'House' WHEN contains(upper(ptype), 'UNIT') THEN 'Unit'
       WHEN contains(upper(ptype), 'APARTMENT') THEN 'Apartment' END AS canonType FROM t""")
def str_10_11(spark, sf_dir):
    s = sales(spark, sf_dir)
    t = s.select("row_id", _pick(F.col("row_id") % 8, _PTYPE).alias("ptype"), _pick(F.col("custkey") % 6, _LAND).alias("land"))
    return t.select("row_id", strings.property_category("ptype", "land").alias("propertyCategory"),
                    strings.canon_type("ptype").alias("canonType"))


SEGMENT_TAGS = {"BUILDING": "House", "HOUSEHOLD": "House", "MACHINERY": "Unit"}


@query("str_12_13_map_values_and_tags", sales_with() + """
SELECT row_id,
  CASE propertyType WHEN 'BUILDING' THEN 'House' WHEN 'HOUSEHOLD' THEN 'House' WHEN 'MACHINERY' THEN 'Unit' ELSE 'Other' END AS mapped,
  CASE propertyType WHEN 'BUILDING' THEN 'House' WHEN 'HOUSEHOLD' THEN 'House' WHEN 'MACHINERY' THEN 'Unit' END AS mapped_nodefault,
  CASE WHEN upper(trim(propertyType)) IN ('BUILDING', 'HOUSEHOLD') THEN 'house' WHEN upper(trim(propertyType)) = 'MACHINERY' THEN NULL ELSE 'misc_other' END AS tag
FROM sales""")
def str_12_13(spark, sf_dir):
    s = sales(spark, sf_dir)
    return s.select("row_id", strings.map_values("propertyType", SEGMENT_TAGS, "Other").alias("mapped"),
                    strings.map_values("propertyType", SEGMENT_TAGS).alias("mapped_nodefault"),
                    strings.type_tag("propertyType", {k.lower(): v for k, v in SEGMENT_TAGS.items()}, "Misc Other",
                                     allowed=["house", "misc other"]).alias("tag"))


@query("str_15_address_assembly", sales_with() + """
SELECT row_id, street || ', ' || suburb || ' ' || CAST(3000 + custkey % 250 AS VARCHAR) AS address_full,
  street || ', ' || suburb AS address_short,
  CASE WHEN landSizeM2 IS NULL THEN NULL ELSE street END || ', ' || suburb AS address_nullable FROM sales""")
def str_15(spark, sf_dir):
    s = sales(spark, sf_dir).withColumn("postcode", F.lit(3000) + F.col("custkey") % 250)
    return s.select("row_id", strings.address("street", "suburb", "postcode").alias("address_full"),
                    strings.address("street", "suburb", full=False).alias("address_short"),
                    strings.address(F.when(F.col("landSizeM2").isNotNull(), F.col("street")), "suburb", full=False)
                    .alias("address_nullable"))


_NAME = "'price_future_' || CAST(custkey % 24 AS VARCHAR) || CASE WHEN row_id % 3 = 0 THEN 'm_delta' WHEN row_id % 3 = 1 THEN ' Months' ELSE '_x' END"


@query("str_16_horizon_label", sales_with() + f"""
SELECT row_id, coalesce(CASE WHEN regexp_extract(lower({_NAME}), '(\\d+)\\s*(months?|m)', 1) <> ''
  THEN regexp_extract(lower({_NAME}), '(\\d+)\\s*(months?|m)', 1) || 'm' END,
  CASE WHEN regexp_extract(lower('target_' || street), '(\\d+)\\s*(months?|m)', 1) <> ''
  THEN regexp_extract(lower('target_' || street), '(\\d+)\\s*(months?|m)', 1) || 'm' END) AS forecast_window FROM sales""")
def str_16(spark, sf_dir):
    s = sales(spark, sf_dir)
    name = F.concat(F.lit("price_future_"), (F.col("custkey") % 24).cast("string"),
                    F.when(F.col("row_id") % 3 == 0, F.lit("m_delta")).when(F.col("row_id") % 3 == 1, F.lit(" Months"))
                    .otherwise(F.lit("_x")))
    return s.select("row_id", strings.horizon_label(name, F.concat(F.lit("target_"), F.col("street"))).alias("forecast_window"))


# --- DAT ------------------------------------------------------------------------------------------
@query("dat_01_tolerant_date_parse", sales_with("""t AS (SELECT row_id, CASE row_id % 3 WHEN 0 THEN strftime(saleDate, '%Y-%m-%d')
  WHEN 1 THEN strftime(saleDate, '%d/%m/%Y') ELSE 'not a date' END AS txt FROM sales)""") + """
SELECT row_id, strftime(coalesce(try_strptime(txt, '%Y-%m-%d'), try_strptime(txt, '%d/%m/%Y')), '%Y-%m-%d') AS parsed FROM t""")
def dat_01(spark, sf_dir):
    s = sales(spark, sf_dir)
    txt = (F.when(F.col("row_id") % 3 == 0, F.date_format("saleDate", "yyyy-MM-dd"))
            .when(F.col("row_id") % 3 == 1, F.date_format("saleDate", "dd/MM/yyyy")).otherwise(F.lit("not a date")))
    return s.select("row_id", F.date_format(dates.parse_date(txt, day_first=True), "yyyy-MM-dd").alias("parsed"))


@query("dat_01_month_first_zones_and_fractions", sales_with("""t AS (SELECT *, row_id % 8 AS k FROM sales)""") + """
SELECT row_id, CASE WHEN k = 7 THEN NULL WHEN k IN (4, 5) THEN strftime(saleDate, '%Y-%m-%d') || ' 13:05:09.25'
  WHEN k = 6 THEN strftime(saleDate - INTERVAL 1 DAY, '%Y-%m-%d') || ' 22:35:00.00'
  WHEN k = 3 THEN strftime(saleDate, '%Y-%m-%d') || ' 09:07:00.00' ELSE strftime(saleDate, '%Y-%m-%d') || ' 00:00:00.00' END AS parsed FROM t""")
def dat_01_month_first(spark, sf_dir):
    s, k = sales(spark, sf_dir), F.col("row_id") % 8
    day = F.date_format("saleDate", "yyyy-MM-dd")
    txt = (F.when(k == 0, F.date_format("saleDate", "M/d/yyyy")).when(k == 1, F.date_format("saleDate", "MM/dd/yyyy"))
            .when(k == 2, F.date_format("saleDate", "MMMM d, yyyy")).when(k == 3, F.concat(F.date_format("saleDate", "M/d/yyyy"), F.lit(" 9:07")))
            .when(k == 4, F.concat(day, F.lit("T13:05:09.250Z"))).when(k == 5, F.concat(F.lit(" "), day, F.lit(" 13:05:09.25")))
            .when(k == 6, F.concat(day, F.lit("T04:35:00+06:00"))).otherwise(F.lit("2020-13-45")))
    return s.select("row_id", F.date_format(dates.parse_date(txt), "yyyy-MM-dd HH:mm:ss.SS").alias("parsed"))


@query("dat_02_03_04_parts_ordinal_label", sales_with() + f"""
SELECT row_id, CAST(year(saleDate) AS INTEGER) AS saleYear, CAST(month(saleDate) AS INTEGER) AS saleMonth, saleYearMonth,
  {SALES_T} AS month_ord, {SALES_T} AS month_ord_from_day,
  CAST(year(saleDate) * 12 + month(saleDate) - 1 AS BIGINT) AS month_ord_from_text,
  strftime(saleDate, '%Y-%m') AS month_label, strftime(saleDate, '%Y-%m') AS month_label_from_day,
  strftime(saleDate, '%Y-%m') AS month_label_from_slash FROM sales""")
def dat_02_03_04(spark, sf_dir):
    s = sales(spark, sf_dir)
    p = dates.date_parts("saleDate")
    ymd = F.date_format("saleDate", "yyyyMMdd").cast("int")
    return s.select("row_id", p["year"].alias("saleYear"), p["month"].alias("saleMonth"), "saleYearMonth",
                    dates.month_ordinal("saleYearMonth").alias("month_ord"),
                    dates.month_ordinal(ymd).alias("month_ord_from_day"),
                    dates.month_ordinal_from_text(F.date_format("saleDate", "yyyy-MM")).alias("month_ord_from_text"),
                    dates.month_label("saleYearMonth").alias("month_label"),
                    dates.month_label(ymd).alias("month_label_from_day"),
                    dates.month_label(F.date_format("saleDate", "yyyy/M")).alias("month_label_from_slash"))


@query("dat_06_07_cyclical_and_age", sales_with() + f"""
SELECT row_id, {R('sin(2 * pi() * (month(saleDate) % 12) / 12)', 6)} AS saleMonth_sin,
  {R('cos(2 * pi() * (month(saleDate) % 12) / 12)', 6)} AS saleMonth_cos,
  CASE WHEN year(saleDate) - yearBuilt >= 0 AND year(saleDate) - yearBuilt <= 45 THEN CAST(year(saleDate) - yearBuilt AS DOUBLE) END AS propertyAge
FROM sales""")
def dat_06_07(spark, sf_dir):
    s = sales(spark, sf_dir)
    cyc = dates.cyclical(F.month("saleDate"))
    return s.select("row_id", rnd(cyc["sin"], 6).alias("saleMonth_sin"), rnd(cyc["cos"], 6).alias("saleMonth_cos"),
                    dates.age_at(F.year("saleDate"), "yearBuilt", min_age=0, max_age=45).alias("propertyAge"))


@query("dat_08_09_10_quarter_first_split", sales_with() + """
SELECT row_id, CAST(year(saleDate) AS VARCHAR) || '-Q' || CAST((month(saleDate) - 1) // 3 + 1 AS VARCHAR) AS saleYearQuarter,
  strftime(CAST(date_trunc('month', saleDate) AS DATE), '%Y-%m-%d') AS salePeriod,
  CAST(saleYearMonth // 100 AS INTEGER) AS ym_year, CAST(saleYearMonth % 100 AS INTEGER) AS ym_month,
  CAST(NULL AS VARCHAR) AS invalid_period FROM sales""")
def dat_08_09_10(spark, sf_dir):
    s = sales(spark, sf_dir)
    sp = dates.split_year_month("saleYearMonth")
    return s.select("row_id", dates.quarter_label("saleYearMonth").alias("saleYearQuarter"),
                    F.date_format(dates.first_of_month("saleYearMonth"), "yyyy-MM-dd").alias("salePeriod"),
                    sp["year"].alias("ym_year"), sp["month"].alias("ym_month"),
                    F.date_format(dates.first_of_month(F.col("saleYearMonth") + 50), "yyyy-MM-dd").alias("invalid_period"))


# --- MTH / EXP ------------------------------------------------------------------------------------
_LAT = "(-37.5 - (custkey % 100) / 200.0)"
_LON = "(144.5 + (custkey % 77) / 100.0)"


@query("mth_01_02_03_04_ratios_and_distance", sales_with() + f"""
SELECT row_id, {R('salePrice / nullif(landSizeM2, 0)', 6)} AS price_per_area,
  {R("CASE WHEN abs(landSizeM2 + 10) >= 100 THEN CASE WHEN (salePrice + 1000) / nullif(landSizeM2 + 10, 0) BETWEEN 20 AND 2000 THEN (salePrice + 1000) / nullif(landSizeM2 + 10, 0) END END", 6)} AS ratio_bounded,
  {R(f"6371.0 * 2 * atan2(sqrt(pow(sin(radians(-37.814 - {_LAT}) / 2), 2) + cos(radians({_LAT})) * cos(radians(-37.814)) * pow(sin(radians(144.963 - {_LON}) / 2), 2)), sqrt(1 - (pow(sin(radians(-37.814 - {_LAT}) / 2), 2) + cos(radians({_LAT})) * cos(radians(-37.814)) * pow(sin(radians(144.963 - {_LON}) / 2), 2))))", 6)} AS distance_to_cbd
FROM sales""")
def mth_01_04(spark, sf_dir):
    from panelforge.operators.ratios import price_per_area, ratio_feature
    s = price_per_area(sales(spark, sf_dir), "landSizeM2", "price_per_area")
    s = ratio_feature(s, "salePrice", "landSizeM2", "ratio_bounded", 20, 2000, 1000, 10, 100)
    lat = F.lit(-37.5) - (F.col("custkey") % 100) / 200.0
    lon = F.lit(144.5) + (F.col("custkey") % 77) / 100.0
    return s.select("row_id", rnd("price_per_area", 6).alias("price_per_area"), rnd("ratio_bounded", 6).alias("ratio_bounded"),
                    rnd(arith.haversine_km(lat, lon), 6).alias("distance_to_cbd"))


@query("mth_02_ratio_with_row_drop", sales_with() + f"""
SELECT row_id, {R('salePrice / landSizeM2', 6)} AS ratio FROM sales WHERE landSizeM2 >= 500 AND salePrice / landSizeM2 BETWEEN 20 AND 90""")
def mth_02_drop(spark, sf_dir):
    from panelforge.operators.ratios import ratio_feature
    s = ratio_feature(sales(spark, sf_dir), "salePrice", "landSizeM2", "ratio", 20, 90, denominator_min=500, drop_na=True)
    return s.select("row_id", rnd("ratio", 6).alias("ratio"))


@query("flt_06_factor_filter", sales_with() + f"""
SELECT row_id, {R('salePrice / nullif(landSizeM2, 0)', 6)} AS price_factor FROM sales
WHERE salePrice / nullif(landSizeM2, 0) IS NOT NULL AND salePrice / nullif(landSizeM2, 0) > 50""")
def flt_06(spark, sf_dir):
    from panelforge.operators.insights import factor_filter
    s = factor_filter(sales(spark, sf_dir), "salePrice", "landSizeM2", "price_factor", min_value=50)
    return s.select("row_id", rnd("price_factor", 6).alias("price_factor"))


EXPRS = {
    "log_price": "clip(log(salePrice), 8, 12.5)",
    "land_floor": "maximum(landSizeM2, 1000)",
    "land_cap": "minimum(landSizeM2, 5000)",
    "is_expensive": "where(salePrice > 250000, 1, 0)",
    "root_abs": "sqrt(abs(salePrice - 250000))",
    "growth": "exp(log1p(nullif(landSizeM2, 0) / 10000))",
    "log_signal": "log(salePrice / 100000)",
}


@query("exp_01_08_mth_05_expression_columns", sales_with() + f"""
SELECT row_id,
  {R("CASE WHEN ln(salePrice) < 8 THEN 8 WHEN ln(salePrice) > 12.5 THEN 12.5 ELSE ln(salePrice) END", 6)} AS log_price,
  greatest(landSizeM2, 1000) AS land_floor, least(landSizeM2, 5000) AS land_cap,
  CASE WHEN salePrice > 250000 THEN 1 ELSE 0 END AS is_expensive,
  {R('sqrt(abs(salePrice - 250000))', 6)} AS root_abs,
  {R('exp(ln(1 + nullif(landSizeM2, 0) / 10000))', 6)} AS growth,
  {R('CASE WHEN salePrice / 100000 > 0 THEN ln(salePrice / 100000) END', 6)} AS log_signal
FROM sales""")
def exp_01(spark, sf_dir):
    from panelforge.plans.derive import expr_columns
    s = expr_columns(sales(spark, sf_dir), EXPRS)
    rounded = {"log_price", "root_abs", "growth", "log_signal"}
    return s.select("row_id", *[(rnd(c, 6) if c in rounded else F.col(c)).alias(c) for c in EXPRS])


HARD_EXPRS = {
    "per_unit": "salePrice / (landSizeM2 - landSizeM2)",
    "share": "salePrice / where(row_id % 7 == 0, 0, landSizeM2)",
    "nested": "max(min(landSizeM2, 4000), max(1000, min(yearBuilt, 1990) * 2), 1500.5)",
    "squares": "(salePrice / 1000) ** 2 + yearBuilt ** 0.5",
    "root_of_negative": "(yearBuilt - 1990) ** 0.5",
    "log_of_zero": "np.log10(salePrice * (row_id % 3)) + np.log1p(-1 * (row_id % 2))",
    "chained": "where((1000 < landSizeM2 <= 5000) & ~(yearBuilt == 1980), 1, 0)",
    "not_equal": "where(landSizeM2 != 1234, 1, 0)",
    "halves": "np.round(row_id / 4, 0)",
    "mod_sign": "(5 - row_id) % 3 + (5 - row_id) // 3",
    "np_maximum": "np.maximum(landSizeM2, 1000) + np.fmax(landSizeM2, 1000)",
    "angle": "np.degrees(np.arctan2(np.sin(row_id), np.cos(row_id)))",
    "filled": "landSizeM2.fillna(0).clip(upper=9000) if yearBuilt in [1980, 1990, 2000] else -1.5",
    "open_clip": "clip(landSizeM2, None, 5000)",
}


@query("exp_01_04_08_zero_divisors_nesting_powers", sales_with() + f"""
SELECT row_id, CAST(NULL AS DOUBLE) AS per_unit,
  {R('salePrice / nullif(CASE WHEN row_id % 7 = 0 THEN 0 ELSE landSizeM2 END, 0)', 6)} AS share,
  greatest(least(landSizeM2, 4000), greatest(1000, least(yearBuilt, 1990) * 2), 1500.5)::DOUBLE AS nested,
  {R('(salePrice / 1000) * (salePrice / 1000) + sqrt(yearBuilt)', 4)} AS squares,
  CASE WHEN yearBuilt >= 1990 THEN {R('sqrt(yearBuilt - 1990)', 6)} END AS root_of_negative,
  CASE WHEN salePrice * (row_id % 3) > 0 AND row_id % 2 = 0 THEN {R('log10(salePrice * (row_id % 3))', 6)} END AS log_of_zero,
  CASE WHEN landSizeM2 > 1000 AND landSizeM2 <= 5000 AND yearBuilt <> 1980 THEN 1 ELSE 0 END AS chained,
  CASE WHEN landSizeM2 = 1234 THEN 0 ELSE 1 END AS not_equal,
  round_even(row_id / 4.0, 0)::DOUBLE AS halves,
  ((5 - row_id) - 3 * floor((5 - row_id) / 3.0) + floor((5 - row_id) / 3.0))::DOUBLE AS mod_sign,
  CASE WHEN landSizeM2 IS NOT NULL THEN 2 * greatest(landSizeM2, 1000) END::DOUBLE AS np_maximum,
  {R('degrees(atan2(sin(row_id), cos(row_id)))', 4)} AS angle,
  CASE WHEN yearBuilt IN (1980, 1990, 2000) THEN least(coalesce(landSizeM2, 0), 9000) ELSE -1.5 END::DOUBLE AS filled,
  CASE WHEN landSizeM2 > 5000 THEN 5000 ELSE landSizeM2 END::DOUBLE AS open_clip
FROM sales""")
def exp_hard(spark, sf_dir):
    from panelforge.plans.derive import expr_columns
    s = expr_columns(sales(spark, sf_dir), HARD_EXPRS)
    digits = {"share": 6, "squares": 4, "root_of_negative": 6, "log_of_zero": 6, "angle": 4}
    whole = {"chained", "not_equal"}
    return s.select("row_id", *[(rnd(c, digits[c]) if c in digits else F.col(c) if c in whole else F.col(c).cast("double"))
                                .alias(c) for c in HARD_EXPRS])


# --- BIN --------------------------------------------------------------------------------------------
@query("bin_01_02_03_04_bins", sales_with() + """
SELECT row_id,
  CASE WHEN landSizeM2 IS NULL THEN 'Unknown' WHEN landSizeM2 <= 2000 THEN '(-inf, 2000.0]'
       WHEN landSizeM2 <= 6000.5 THEN '(2000.0, 6000.5]' ELSE '(6000.5, inf]' END AS land_interval,
  CASE WHEN landSizeM2 IS NULL THEN 'Unknown' WHEN landSizeM2 < 2000 THEN 'small' WHEN landSizeM2 < 6000.5 THEN 'medium' ELSE 'large' END AS land_left,
  CASE WHEN salePrice >= 50000 AND salePrice <= 150000 THEN 'entry' WHEN salePrice > 150000 AND salePrice <= 300000 THEN 'core'
       ELSE 'Unknown' END AS price_closed,
  CASE street WHEN '1-URGENT' THEN 'hot' WHEN '2-HIGH' THEN 'hot' ELSE 'Unknown' END AS street_bin,
  CASE WHEN year(saleDate) - yearBuilt <= 5 THEN '0–5' WHEN year(saleDate) - yearBuilt <= 20 THEN '6–20' ELSE '21+' END AS ageBand
FROM sales""")
def bin_01_04(spark, sf_dir):
    s = sales(spark, sf_dir)
    return s.select(
        "row_id",
        bins.fixed_bins("landSizeM2", [2000, 6000.5], labels=["too", "few"]).alias("land_interval"),
        bins.fixed_bins("landSizeM2", [6000.5, 2000], labels=["small", "medium", "large"], right=False).alias("land_left"),
        bins.fixed_bins("salePrice", [50000, 150000, 300000], labels=["entry", "core"], extend_lower=False,
                        extend_upper=False).alias("price_closed"),
        bins.mapping_bins("street", {"1-URGENT": "hot", "2-HIGH": "hot"}).alias("street_bin"),
        bins.age_bands(F.year("saleDate") - F.col("yearBuilt")).alias("ageBand"))


@query("bin_06_equal_width_mean_by_year", sales_with("""b AS (SELECT *, min(landSizeM2) OVER () AS lo, max(landSizeM2) OVER () AS hi FROM sales),
c AS (SELECT *, CASE WHEN landSizeM2 IS NULL THEN NULL WHEN hi = lo THEN 0
   ELSE least(greatest(CAST(ceil((landSizeM2 - lo) / ((hi - lo) / 20.0)) AS BIGINT) - 1, 0), 19) END AS bin FROM b)""") + f"""
SELECT CAST(bin AS INTEGER) AS bin, CAST(year(saleDate) AS INTEGER) AS saleYear, {R('avg(salePrice)', 4)} AS mean_price, count(*) AS n
FROM c WHERE bin IS NOT NULL GROUP BY ALL""")
def bin_06(spark, sf_dir):
    from panelforge.operators.insights import binned_means
    b = binned_means(sales(spark, sf_dir), "landSizeM2", "salePrice", F.year("saleDate").cast("int").alias("saleYear"))
    return b.withColumn("mean_price", rnd("mean_price", 4))
