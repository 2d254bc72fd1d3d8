"""Registered queries: macro tables and landed series files (MAC-01..05, JON-03/04, SRC-05/06)."""
from __future__ import annotations

import zlib

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelforge.functions.nulls import rnd
from panelforge.operators import macro as M
from panelforge.operators.joins import join_on_year
from panelforge.plans.registry import query
from panelforge.plans.sqlkit import R, sales_with
from panelforge.plans.views import sales
from panelforge.session import scratch_path
from panelforge.sources.files import read_table
from panelforge.sources.series import cash_rule, cpi_rule, read_series, rejected_rows, write_series_file, write_series_records


def index_series(spark, sf_dir):
    """Monthly 'index' series derived from line items: mean extended price / 100 per ship month."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.groupBy(F.date_trunc("month", "l_shipdate").alias("date")).agg((F.avg("l_extendedprice") / 100).alias("v"))


def rate_series(spark, sf_dir):
    """Daily 'rate' series (fraction): mean non-zero discount per ship day."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_shipdate").alias("date")).agg(F.avg(F.nullif("l_discount", F.lit(0.0))).alias("v"))


def close_series(spark, sf_dir):
    """Daily 'close' series: total extended price per ship day / 10,000."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_shipdate").alias("date")).agg((F.sum("l_extendedprice") / 10000).alias("v"))


IDX_SQL = "idx AS (SELECT date_trunc('month', l_shipdate) AS date, avg(l_extendedprice) / 100 AS v FROM lineitem GROUP BY 1)"
RATE_SQL = "rate AS (SELECT l_shipdate AS date, avg(nullif(l_discount, 0.0)) AS v FROM lineitem GROUP BY 1)"
CLOSE_SQL = "cls AS (SELECT l_shipdate AS date, sum(l_extendedprice) / 10000 AS v FROM lineitem GROUP BY 1)"

CPI_AVG_SQL = f"""cpi_avg AS (SELECT year, cpi_index_avg, cpi_index_avg / nullif(lag(cpi_index_avg) OVER (ORDER BY year), 0) - 1 AS cpi_yoy_avg
  FROM (SELECT CAST(year(date) AS INTEGER) AS year, avg(v) AS cpi_index_avg FROM idx WHERE year(date) >= 1995 GROUP BY 1))"""
CPI_DEC_SQL = f"""cpi_dec AS (SELECT year, cpi_index_dec, cpi_index_dec / nullif(lag(cpi_index_dec) OVER (ORDER BY year), 0) - 1 AS cpi_yoy_dec
  FROM (SELECT CAST(year(date) AS INTEGER) AS year, arg_max(v, date) AS cpi_index_dec FROM idx WHERE year(date) >= 1995 GROUP BY 1))"""
CASH_SQL = f"""cash AS (SELECT year, cash_rate_avg, cash_rate_eoy,
    cash_rate_avg - lag(cash_rate_avg) OVER (ORDER BY year) AS cash_rate_change_avg,
    cash_rate_eoy - lag(cash_rate_eoy) OVER (ORDER BY year) AS cash_rate_change_eoy
  FROM (SELECT CAST(year(date) AS INTEGER) AS year, avg(v * 100) AS cash_rate_avg, arg_max(v * 100, date) AS cash_rate_eoy
        FROM rate WHERE year(date) >= 1996 AND v IS NOT NULL GROUP BY 1))"""
ASX_SQL = f"""asx0 AS (SELECT CAST(year(date) AS INTEGER) AS year, arg_max(v, date) AS asx200_close FROM cls WHERE v IS NOT NULL GROUP BY 1),
asx1 AS (SELECT CAST(y.year AS INTEGER) AS year, asx0.asx200_close FROM (SELECT unnest(range((SELECT min(year) FROM asx0), (SELECT max(year) FROM asx0) + 1)) AS year) y
         LEFT JOIN asx0 USING (year) WHERE y.year >= 1997),
asx AS (SELECT year, asx200_close, ff / nullif(lag(ff) OVER (ORDER BY year), 0) - 1 AS asx200_yoy
        FROM (SELECT *, last_value(asx200_close IGNORE NULLS) OVER (ORDER BY year ROWS UNBOUNDED PRECEDING) AS ff FROM asx1))"""


def _cpi_avg(spark, sf_dir):
    return M.index_annual_avg(index_series(spark, sf_dir), "v", start_year=1995)


def _cpi_dec(spark, sf_dir):
    return M.index_annual_last(index_series(spark, sf_dir), "v", start_year=1995)


def _cash(spark, sf_dir):
    r = rate_series(spark, sf_dir).where(F.col("v").isNotNull()).withColumn("v", F.col("v") * 100)
    return M.rate_annual(r, "v", start_year=1996)


def _asx(spark, sf_dir):
    return M.close_year_end(close_series(spark, sf_dir), "v", start_year=1997)


def _r(df, scale=6, keep=("year",)):
    return df.select(*[F.col(c) if c in keep else rnd(c, scale).alias(c) for c in df.columns])


@query("mac_01_05_index_annual_average", f"WITH {IDX_SQL}, {CPI_AVG_SQL} SELECT year, {R('cpi_index_avg', 6)} AS cpi_index_avg, {R('cpi_yoy_avg', 6)} AS cpi_yoy_avg FROM cpi_avg")
def mac_01(spark, sf_dir):
    return _r(_cpi_avg(spark, sf_dir))


@query("mac_02_index_last_of_year", f"WITH {IDX_SQL}, {CPI_DEC_SQL} SELECT year, {R('cpi_index_dec', 6)} AS cpi_index_dec, {R('cpi_yoy_dec', 6)} AS cpi_yoy_dec FROM cpi_dec")
def mac_02(spark, sf_dir):
    return _r(_cpi_dec(spark, sf_dir))


@query("mac_03_rate_annual_and_changes", f"WITH {RATE_SQL}, {CASH_SQL} SELECT year, " +
       ", ".join(f"{R(c, 6)} AS {c}" for c in ("cash_rate_avg", "cash_rate_eoy", "cash_rate_change_avg", "cash_rate_change_eoy")) +
       " FROM cash")
def mac_03(spark, sf_dir):
    return _r(_cash(spark, sf_dir))


@query("mac_04_year_end_close", f"WITH {CLOSE_SQL}, {ASX_SQL} SELECT year, {R('asx200_close', 6)} AS asx200_close, {R('asx200_yoy', 6)} AS asx200_yoy FROM asx")
def mac_04(spark, sf_dir):
    return _r(_asx(spark, sf_dir))


MACRO_SQL = f"""{IDX_SQL}, {RATE_SQL}, {CLOSE_SQL}, {CPI_AVG_SQL}, {CPI_DEC_SQL}, {CASH_SQL}, {ASX_SQL},
macro AS (SELECT * FROM asx FULL OUTER JOIN cpi_dec USING (year) FULL OUTER JOIN cpi_avg USING (year)
          FULL OUTER JOIN cash USING (year))"""
MACRO_COLS = ["asx200_close", "asx200_yoy", "cpi_index_dec", "cpi_yoy_dec", "cpi_index_avg", "cpi_yoy_avg",
              "cash_rate_avg", "cash_rate_eoy", "cash_rate_change_avg", "cash_rate_change_eoy"]


def macro_table(spark, sf_dir):
    return M.macro_annual([_asx(spark, sf_dir), _cpi_dec(spark, sf_dir), _cpi_avg(spark, sf_dir), _cash(spark, sf_dir)])


@query("jon_04_macro_full_outer_chain", f"WITH {MACRO_SQL} SELECT year, " +
       ", ".join(f"{R(c, 6)} AS {c}" for c in MACRO_COLS) + " FROM macro")
def jon_04(spark, sf_dir):
    return _r(macro_table(spark, sf_dir))


@query("jon_03_join_macro_on_sale_year", sales_with(MACRO_SQL) + f"""
SELECT row_id, {R('cpi_index_avg', 6)} AS cpi_index_avg, {R('cash_rate_eoy', 6)} AS cash_rate_eoy, {R('asx200_yoy', 6)} AS asx200_yoy
FROM sales LEFT JOIN macro ON CAST(year(saleDate) AS INTEGER) = macro.year""")
def jon_03(spark, sf_dir):
    s = sales(spark, sf_dir).withColumn("saleYear", F.year("saleDate").cast("int"))
    j = join_on_year(s, macro_table(spark, sf_dir), "saleYear", "year")
    return j.select("row_id", *[rnd(c, 6).alias(c) for c in ("cpi_index_avg", "cash_rate_eoy", "asx200_yoy")])


def _landed(spark, sf_dir, name):
    return scratch_path(spark, f"landed/{name}_{zlib.crc32(sf_dir.encode()):08x}")


CPI_HEADER = [["Title", "Year-ended inflation", "Consumer price index"],
              ["Description", "Year-ended inflation; per cent", "All groups CPI; index numbers; weighted average of eight capital cities"],
              ["Frequency", "Monthly", "Monthly"], ["Type", "Original", "Original"], ["Units", "Per cent", "Index"]]
CASH_HEADER = [["Title", "Cash Rate Target; monthly average", "Cash Rate Target"],
               ["Description", "Cash Rate Target", "Cash Rate Target"],
               ["Frequency", "Monthly", "Daily"], ["Type", "Original", "Original"], ["Units", "Original", "Original"]]


@query("src_05_landed_index_table", f"WITH {IDX_SQL} SELECT strftime(date, '%Y-%m-%d') AS date, {R('v', 6)} AS cpi_index FROM idx")
def src_05(spark, sf_dir):
    s = index_series(spark, sf_dir)
    path = write_series_file(s.select("date", (F.col("v") / 10).alias("yoy"), "v"), _landed(spark, sf_dir, "cpi"),
                             CPI_HEADER)
    out = read_series(spark, path, cpi_rule, "cpi_index")
    return out.select(F.date_format("date", "yyyy-MM-dd").alias("date"), rnd("cpi_index", 6).alias("cpi_index"))


#: Cells with commas, quotes, a line break and letters outside ASCII.
QUOTED_HEADER = [["Title", "CPI; \u201call groups\u201d, change", 'All groups CPI, "index"\nnot adjusted \u2013 caf\u00e9'],
                 ["Description", "Change, year on year", "All groups CPI, Index numbers, Weighted average of eight capital cities"],
                 ["Frequency", "Quarterly", "Quarterly"], ["Type", "Original", "Original"], ["Units", "Per cent, %", "Index, 2011-12=100"]]


def _quoted(spark, sf_dir):
    """The index in thousands with separators, every tenth value broken and every fifteenth date."""
    s = index_series(spark, sf_dir).withColumn("k", F.dayofyear("date"))
    value = (F.when(F.col("k") % 10 == 0, "n/a, revised").when(F.col("k") % 10 == 1, F.lit(None)).otherwise(F.format_number(F.col("v") * 1000, 3)))
    date = F.when(F.col("k") % 15 == 7, F.concat(F.lit("week of "), F.date_format("date", "yyyy-MM-dd"))).otherwise(F.date_format("date", "dd-MMM-yyyy"))
    out = s.select(date.alias("d"), F.lit("1,5 \u20ac").alias("change"), value.alias("v"))
    return write_series_records(out, _landed(spark, sf_dir, "quoted"), QUOTED_HEADER)


_QUOTED_SQL = IDX_SQL + """,
k AS (SELECT *, dayofyear(date) AS k FROM idx), bad AS (SELECT *, CASE WHEN k % 15 = 7 THEN 'unparsable date' WHEN k % 10 = 1 THEN 'missing value'
  WHEN k % 10 = 0 THEN 'unparsable value' END AS reason FROM k)"""


@query("src_05_quoted_landed_table", f"WITH {_QUOTED_SQL} SELECT strftime(date, '%Y-%m-%d') AS date, {R('round(v * 1000, 3)', 2)} AS cpi_index FROM bad WHERE reason IS NULL")
def src_05_quoted(spark, sf_dir):
    out = read_series(spark, _quoted(spark, sf_dir), cpi_rule, "cpi_index", encoding="utf-8")
    return out.select(F.date_format("date", "yyyy-MM-dd").alias("date"), rnd("cpi_index", 2).alias("cpi_index"))


@query("src_05_rejected_rows", f"WITH {_QUOTED_SQL} SELECT reason, count(*) AS n FROM bad WHERE reason IS NOT NULL GROUP BY 1")
def src_05_rejected(spark, sf_dir):
    return rejected_rows(spark, _quoted(spark, sf_dir), cpi_rule, encoding="utf-8").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("src_06_landed_rate_table_daily_preferred", f"WITH {RATE_SQL} SELECT strftime(date, '%Y-%m-%d') AS date, {R('v * 100', 6)} AS cash_rate FROM rate WHERE v IS NOT NULL")
def src_06(spark, sf_dir):
    s = rate_series(spark, sf_dir)
    monthly = F.avg("v").over(Window.partitionBy(F.date_trunc("month", "date")))
    path = write_series_file(s.select("date", monthly.alias("m"), "v"), _landed(spark, sf_dir, "cash"), CASH_HEADER)
    out = read_series(spark, path, cash_rule, "cash_rate", percent_guard=True)
    return out.select(F.date_format("date", "yyyy-MM-dd").alias("date"), rnd("cash_rate", 6).alias("cash_rate"))
