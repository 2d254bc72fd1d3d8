"""Logical views that give the driver's TPC-H-style tables the roles of a sales panel.

Each view exists twice: as a DataFrame plan (what the library runs) and as DuckDB SQL
(used only by the oracle check). Both must produce identical rows.

sales: orders x customer x nation x region, one row per order
  row_id=o_orderkey, saleDate=o_orderdate, salePrice=o_totalprice, suburb=n_name,
  region=r_name, propertyType=c_mktsegment, street=o_orderpriority, saleType=o_orderstatus,
  landSizeM2=c_acctbal when positive (data-driven NULLs), yearBuilt, streetAddress.
lines: lineitem x part, one row per line item (sizes, nullable numerics, categories).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.functions.dates import year_month
from panelforge.sources.files import read_table


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority", "o_orderstatus")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
          .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    seg = F.col("c_mktsegment")
    addr = (F.when(k % 4 == 0, F.concat((ck % 200 + 1).cast("string"), F.lit(" "), seg, F.lit(" ROAD")))
             .when(k % 4 == 1, F.concat(F.lit("UNIT "), (k % 30 + 1).cast("string"), F.lit("/"),
                                        (ck % 90 + 1).cast("string"), F.lit(" "), seg, F.lit(" STREET")))
             .when(k % 4 == 2, F.concat((k % 12 + 1).cast("string"), F.lit("/"), (ck % 50 + 2).cast("string"),
                                        F.lit("-"), (ck % 50 + 6).cast("string"), F.lit(" "), F.lower(seg),
                                        F.lit(" avenue")))
             .otherwise(F.concat(F.lit("G0"), (k % 9 + 1).cast("string"), F.lit("/"), (ck % 70 + 1).cast("string"),
                                 F.lit(" "), seg, F.lit(" PARADE, "), F.col("n_name"))))
    return j.select(
        k.alias("row_id"),
        ck.alias("custkey"),
        F.col("o_orderdate").alias("saleDate"),
        year_month("o_orderdate").alias("saleYearMonth"),
        F.col("o_totalprice").alias("salePrice"),
        F.col("n_name").alias("suburb"),
        F.col("r_name").alias("region"),
        seg.alias("propertyType"),
        F.col("o_orderpriority").alias("street"),
        F.col("o_orderstatus").alias("saleType"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("landSizeM2"),
        (F.lit(1950) + ck % 50).cast("int").alias("yearBuilt"),
        addr.alias("streetAddress"),
    )


SALES_SQL = """sales AS (
  SELECT o_orderkey AS row_id, o_custkey AS custkey, o_orderdate AS saleDate,
         CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS saleYearMonth,
         o_totalprice AS salePrice, n_name AS suburb, r_name AS region, c_mktsegment AS propertyType,
         o_orderpriority AS street, o_orderstatus AS saleType,
         CASE WHEN c_acctbal > 0 THEN c_acctbal END AS landSizeM2,
         CAST(1950 + o_custkey % 50 AS INTEGER) AS yearBuilt,
         CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_custkey % 200 + 1 AS VARCHAR) || ' ' || c_mktsegment || ' ROAD'
              WHEN o_orderkey % 4 = 1 THEN 'UNIT ' || CAST(o_orderkey % 30 + 1 AS VARCHAR) || '/' ||
                   CAST(o_custkey % 90 + 1 AS VARCHAR) || ' ' || c_mktsegment || ' STREET'
              WHEN o_orderkey % 4 = 2 THEN CAST(o_orderkey % 12 + 1 AS VARCHAR) || '/' ||
                   CAST(o_custkey % 50 + 2 AS VARCHAR) || '-' || CAST(o_custkey % 50 + 6 AS VARCHAR) || ' ' ||
                   lower(c_mktsegment) || ' avenue'
              ELSE 'G0' || CAST(o_orderkey % 9 + 1 AS VARCHAR) || '/' || CAST(o_custkey % 70 + 1 AS VARCHAR) ||
                   ' ' || c_mktsegment || ' PARADE, ' || n_name END AS streetAddress
  FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey)"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_shipdate")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size",
                                                 "p_retailprice")
    j = li.join(p, li.l_partkey == p.p_partkey)
    return j.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("landSizeM2"),
        F.col("l_linenumber").cast("double").alias("bed"),
        (F.col("p_size") % 5).cast("double").alias("bath"),
        (F.col("l_linenumber") % 4).cast("double").alias("car"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("discount"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("tax"),
        F.col("p_retailprice").alias("retailPrice"),
        F.col("p_size").alias("size"),
        F.col("p_type").alias("partType"),
        F.col("p_brand").alias("brand"),
        F.col("p_name").alias("partName"),
        F.col("l_returnflag").alias("flag"),
        year_month("l_shipdate").alias("shipYearMonth"),
        F.year("l_shipdate").cast("int").alias("shipYear"),
    )


LINES_SQL = """lines AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice AS price,
         l_quantity AS landSizeM2, CAST(l_linenumber AS DOUBLE) AS bed, CAST(p_size % 5 AS DOUBLE) AS bath,
         CAST(l_linenumber % 4 AS DOUBLE) AS car, nullif(l_discount, 0.0) AS discount,
         nullif(l_tax, 0.0) AS tax, p_retailprice AS retailPrice, p_size AS size, p_type AS partType,
         p_brand AS brand, p_name AS partName, l_returnflag AS flag,
         CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS shipYearMonth,
         CAST(year(l_shipdate) AS INTEGER) AS shipYear
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def with_sql(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
