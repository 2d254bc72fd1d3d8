"""Registered queries: sources, cleaning, projections and filters (SRC-*, PRJ-*, FLT-*, NUL-*, STR-03..06)."""
from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.functions.nulls import rnd
from panelforge.functions.strings import norm_token, null_tokens, to_numeric
from panelforge.operators.cleaning import (bucket_rare, category_mapping, clean, drop_sparse_columns,
                                           impute_median, impute_unknown, keep_columns, non_null_fractions,
                                           rename_camel_case)
from panelforge.plans.registry import query
from panelforge.plans.sqlkit import R, lines_with
from panelforge.plans.views import lines

KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def raw_lines(spark, sf_dir):
    """Text-typed 'raw export' of the lines view, with messy column names."""
    l = lines(spark, sf_dir)
    return l.select(
        F.col("l_orderkey").alias("Order Key"), F.col("l_partkey").alias("Part Key"),
        F.col("l_suppkey").alias("Supp Key"), F.col("l_linenumber").alias("Line Number"),
        F.when(F.col("l_linenumber") == 7, F.lit("n/a"))
         .otherwise(F.concat(F.lit("$"), F.col("price").cast("string"))).alias("Sale Price ($)"),
        F.col("discount").cast("string").alias("Discount %"),
        F.col("tax").cast("string").alias("Tax  Raw"),
        F.col("partName").alias("Part Name"),
        F.concat(F.col("brand"), F.lit("/"), F.col("size").cast("string")).alias("Brand/Size"),
        F.col("landSizeM2").alias("Land Size m²"),
        F.when(F.col("l_linenumber") == 1, F.lit("note")).alias("Agent Notes"),
    )


RAW_SQL = """raw AS (SELECT l_orderkey AS "Order Key", l_partkey AS "Part Key", l_suppkey AS "Supp Key",
  l_linenumber AS "Line Number",
  CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE '$' || CAST(price AS VARCHAR) END AS "Sale Price ($)",
  CAST(discount AS VARCHAR) AS "Discount %", CAST(tax AS VARCHAR) AS "Tax  Raw", partName AS "Part Name",
  brand || '/' || CAST(size AS VARCHAR) AS "Brand/Size", landSizeM2 AS "Land Size m²",
  CASE WHEN l_linenumber = 1 THEN 'note' END AS "Agent Notes" FROM lines)"""

CLEAN_CFG = {
    "special_to_ascii": {"²": "2"},
    "min_non_null_fraction": 0.35,
    "category_mappings": {"propertyType": {"source": "partName", "default": "Unknown", "mode": "contains",
                                           "rules": {"House": ["ring", "widget"], "Unit": ["bolt", "gear"],
                                                     "Apartment": ["small"]}}},
    "numeric_candidates": ["salePrice", "discount", "taxRaw"],
    "normalise_text_columns": ["partName"],
    "primary_target": "salePrice",
    "data_cleaning": [{"type": "drop_na", "columns": ["salePrice", "discount"]},
                      {"type": "drop_zeros", "columns": ["taxRaw"]},
                      {"type": "remove_outliers", "columns": ["salePrice"], "method": "iqr", "iqr_multiplier": 1.5}],
    "bucketing_rules": {"brandSize": 50},
}

_NUM = lambda c: f"COALESCE(TRY_CAST(trim({c}) AS DOUBLE), TRY_CAST(regexp_replace(trim({c}), '[^0-9.\\-]', '', 'g') AS DOUBLE))"
_MAP = ("CASE WHEN upper(partName) LIKE '%SMALL%' THEN 'Apartment' WHEN upper(partName) LIKE '%BOLT%' OR upper(partName) LIKE '%GEAR%' THEN 'Unit' "
        "WHEN upper(partName) LIKE '%RING%' OR upper(partName) LIKE '%WIDGET%' THEN 'House' ELSE 'Unknown' END")
CLEAN_SQL_CTES = RAW_SQL + f""",
c1 AS (SELECT "Order Key" AS orderKey, "Part Key" AS partKey, "Supp Key" AS suppKey, "Line Number" AS lineNumber,
         {_NUM('"Sale Price ($)"')} AS salePrice, {_NUM('"Discount %"')} AS discount, {_NUM('"Tax  Raw"')} AS taxRaw,
         replace(upper(trim(replace("Part Name", '²', '2'))), '  ', ' ') AS partName, "Brand/Size" AS brandSize,
         "Land Size m²" AS landSizeM2, {_MAP.replace('partName', '"Part Name"')} AS propertyType FROM raw),
c2 AS (SELECT orderKey, partKey, suppKey, lineNumber, salePrice,
         coalesce(discount, (SELECT median(discount) FROM c1)) AS discount,
         coalesce(taxRaw, (SELECT median(taxRaw) FROM c1)) AS taxRaw,
         coalesce(landSizeM2, (SELECT median(landSizeM2) FROM c1)) AS landSizeM2,
         partName, brandSize, propertyType FROM c1),
d1 AS (SELECT *, 'salePrice:drop_na' AS _drop_reason FROM c2 WHERE salePrice IS NULL),
k1 AS (SELECT * FROM c2 WHERE salePrice IS NOT NULL),
d3 AS (SELECT *, 'taxRaw:drop_zeros' AS _drop_reason FROM k1 WHERE taxRaw IS NOT DISTINCT FROM 0),
k3 AS (SELECT * FROM k1 WHERE taxRaw IS DISTINCT FROM 0),
b AS (SELECT quantile_cont(salePrice, 0.25) AS q1, quantile_cont(salePrice, 0.75) AS q3 FROM k3),
d4 AS (SELECT k3.*, 'salePrice:remove_outliers_iqr' AS _drop_reason FROM k3, b
       WHERE NOT (salePrice >= q1 - 1.5 * (q3 - q1) AND salePrice <= q3 + 1.5 * (q3 - q1))),
k4 AS (SELECT k3.* FROM k3, b WHERE salePrice >= q1 - 1.5 * (q3 - q1) AND salePrice <= q3 + 1.5 * (q3 - q1)),
bc AS (SELECT brandSize AS v, count(*) AS n FROM k4 GROUP BY 1)"""

_CLEAN_OUT = ["orderKey", "partKey", "suppKey", "lineNumber", "salePrice", "discount", "taxRaw", "landSizeM2",
              "partName", "brandSize", "propertyType"]


def _clean(spark, sf_dir):
    return clean(raw_lines(spark, sf_dir), CLEAN_CFG)


@query("flt_01_04_clean_stage_kept_rows", lines_with(CLEAN_SQL_CTES) + f"""
SELECT orderKey, partKey, suppKey, lineNumber, salePrice, {R('discount', 6)} AS discount, {R('taxRaw', 6)} AS taxRaw,
  landSizeM2, partName, CASE WHEN bc.n >= 50 OR brandSize = 'Unknown' THEN brandSize ELSE 'Other' END AS brandSize,
  propertyType FROM k4 LEFT JOIN bc ON k4.brandSize IS NOT DISTINCT FROM bc.v""")
def flt_01(spark, sf_dir):
    df, _ = _clean(spark, sf_dir)
    return df.select(*[(rnd(c, 6) if c in ("discount", "taxRaw") else F.col(c)).alias(c) for c in _CLEAN_OUT])


@query("src_07_drop_audit", lines_with(CLEAN_SQL_CTES) + """
SELECT orderKey, partKey, suppKey, lineNumber, salePrice, _drop_reason FROM d1
UNION ALL SELECT orderKey, partKey, suppKey, lineNumber, salePrice, _drop_reason FROM d3
UNION ALL SELECT orderKey, partKey, suppKey, lineNumber, salePrice, _drop_reason FROM d4""")
def src_07(spark, sf_dir):
    _, audit = _clean(spark, sf_dir)
    return audit.select("orderKey", "partKey", "suppKey", "lineNumber", "salePrice", "_drop_reason")


@query("prj_01_camel_case_columns", lines_with(RAW_SQL) + """
SELECT "Order Key" AS orderKey, "Part Key" AS partKey, "Supp Key" AS suppKey, "Line Number" AS lineNumber,
  "Sale Price ($)" AS salePrice, "Discount %" AS discount, "Tax  Raw" AS taxRaw, "Part Name" AS partName,
  "Brand/Size" AS brandSize, "Land Size m²" AS landSizeM2, "Agent Notes" AS agentNotes FROM raw""")
def prj_01(spark, sf_dir):
    return rename_camel_case(raw_lines(spark, sf_dir), {"²": "2"})


_FR_COLS = ["Order Key", "Part Key", "Supp Key", "Line Number", "Sale Price ($)", "Discount %", "Tax  Raw",
            "Part Name", "Brand/Size", "Land Size m²", "Agent Notes"]


@query("prj_03_non_null_fractions", lines_with(RAW_SQL) + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {R(f'count("{c}") / count(*)', 6)} AS non_null_fraction,
        count("{c}") / count(*) >= 0.35 AS kept FROM raw""" for c in _FR_COLS))
def prj_03(spark, sf_dir):
    fr = non_null_fractions(raw_lines(spark, sf_dir))
    return fr.select("column", rnd("non_null_fraction", 6).alias("non_null_fraction"),
                     (F.col("non_null_fraction") >= 0.35).alias("kept"))


@query("prj_02_03_keep_and_drop_sparse", lines_with(RAW_SQL) + """
SELECT "Order Key", "Line Number", "Discount %", "Tax  Raw" FROM raw""")
def prj_02_03(spark, sf_dir):
    kept = drop_sparse_columns(raw_lines(spark, sf_dir), 0.35)
    return keep_columns(kept, ["Order Key", "Line Number", "Discount %", "Tax  Raw", "Agent Notes", "missing col"])


@query("str_03_04_null_tokens_and_coercion", lines_with() + """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CASE WHEN trim(t) IN ('', '-', 'nan', 'NaT', 'None') THEN NULL ELSE trim(t) END AS token_clean,
  COALESCE(TRY_CAST(trim(n) AS DOUBLE), TRY_CAST(regexp_replace(trim(n), '[^0-9.\\-]', '', 'g') AS DOUBLE)) AS numeric_clean
FROM (SELECT *, CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN ' - ' WHEN 3 THEN ' nan ' WHEN 4 THEN 'None'
                                  ELSE ' ' || partName || ' ' END AS t,
             CASE l_linenumber WHEN 1 THEN '1e3' WHEN 2 THEN 'n/a' WHEN 3 THEN '$' || CAST(l_orderkey AS VARCHAR) || ',' || lpad(CAST(size AS VARCHAR), 3, '0') || '.5'
                               ELSE CAST(price AS VARCHAR) END AS n FROM lines)""")
def str_03_04(spark, sf_dir):
    l = lines(spark, sf_dir)
    ln = F.col("l_linenumber")
    t = (F.when(ln == 1, F.lit("")).when(ln == 2, F.lit(" - ")).when(ln == 3, F.lit(" nan ")).when(ln == 4, F.lit("None"))
          .otherwise(F.concat(F.lit(" "), F.col("partName"), F.lit(" "))))
    n = (F.when(ln == 1, F.lit("1e3")).when(ln == 2, F.lit("n/a"))
          .when(ln == 3, F.concat(F.lit("$"), F.col("l_orderkey").cast("string"), F.lit(","),
                                  F.lpad(F.col("size").cast("string"), 3, "0"), F.lit(".5")))
          .otherwise(F.col("price").cast("string")))
    return l.select(*KEYS, null_tokens(t).alias("token_clean"), to_numeric(n).alias("numeric_clean"))


@query("str_02_token_normalise", lines_with() + """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  trim(regexp_replace(regexp_replace(upper(partName || ' & ' || brand || '!!' || partType), '[^A-Z0-9& ]+', ' ', 'g'), '\\s+', ' ', 'g')) AS token
FROM lines""")
def str_02(spark, sf_dir):
    l = lines(spark, sf_dir)
    return l.select(*KEYS, norm_token(F.concat("partName", F.lit(" & "), "brand", F.lit("!!"), "partType")).alias("token"))


@query("str_05_category_mapping", lines_with() + f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {_MAP} AS propertyType,
  CASE WHEN partType IN ('ECONOMY', 'SMALL') THEN 'Budget' WHEN partType IN ('PROMO') THEN 'Deal' ELSE partType END AS typeGroup
FROM lines""")
def str_05(spark, sf_dir):
    l = lines(spark, sf_dir)
    l = category_mapping(l, "propertyType", CLEAN_CFG["category_mappings"]["propertyType"])
    l = l.withColumn("typeGroup", F.col("partType"))
    l = category_mapping(l, "typeGroup", {"source": "typeGroup", "mode": "exact", "preserve_unmatched": True,
                                          "rules": {"Budget": ["economy", "small"], "Deal": ["promo"]}})
    return l.select(*KEYS, "propertyType", "typeGroup")


@query("str_06_rare_category_bucketing", lines_with() + """
, b AS (SELECT *, brand || '/' || CAST(size AS VARCHAR) AS bs FROM lines),
c AS (SELECT bs, count(*) AS n FROM b GROUP BY bs)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN n >= 50 THEN b.bs ELSE 'Other' END AS brandSize
FROM b JOIN c ON b.bs = c.bs""")
def str_06(spark, sf_dir):
    l = lines(spark, sf_dir).withColumn("brandSize", F.concat("brand", F.lit("/"), F.col("size").cast("string")))
    return bucket_rare(l, "brandSize", 50).select(*KEYS, "brandSize")


@query("nul_01_02_impute", lines_with() + f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  {R('coalesce(discount, (SELECT median(discount) FROM lines))', 6)} AS discount,
  {R('coalesce(tax, (SELECT median(tax) FROM lines))', 6)} AS tax, price,
  coalesce(CASE WHEN size > 40 THEN partType END, 'Unknown') AS bigType
FROM lines""")
def nul_01_02(spark, sf_dir):
    l = lines(spark, sf_dir).select(*KEYS, "discount", "tax", "price",
                                    F.when(F.col("size") > 40, F.col("partType")).alias("bigType"))
    l = impute_unknown(impute_median(l, exclude=["price"] + KEYS), ["bigType"])
    return l.select(*KEYS, rnd("discount", 6).alias("discount"), rnd("tax", 6).alias("tax"), "price", "bigType")
