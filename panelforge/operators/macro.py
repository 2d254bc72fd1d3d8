"""Yearly macro tables from periodic series (MAC-01..05) and their joins (JON-03/04).

Series are (date, value) DataFrames. Annualising is a ``groupBy(year)``; year-over-year terms
use ``lag`` over the yearly table (tens of rows per series, ordered by year).
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.nulls import safe_div
from panelforge.operators.joins import full_outer_chain


def _yearly(series: DataFrame, start_year: int | None) -> DataFrame:
    s = series.withColumn("year", F.year("date").cast("int"))
    if start_year is not None:                       # MAC-05: cut before annualising
        s = s.where(F.col("year") >= int(start_year))
    return s


def _pct_change(c: str) -> F.Column:
    w = Window.orderBy("year")
    return safe_div(F.col(c), F.lag(c, 1).over(w)) - 1


def index_annual_avg(series: DataFrame, value: str, start_year: int | None = None,
                     prefix: str = "cpi") -> DataFrame:
    """MAC-01: calendar-year average of an index and its year-on-year change."""
    y = _yearly(series, start_year).groupBy("year").agg(F.avg(value).alias(f"{prefix}_index_avg"))
    return y.withColumn(f"{prefix}_yoy_avg", _pct_change(f"{prefix}_index_avg"))


def index_annual_last(series: DataFrame, value: str, start_year: int | None = None,
                      prefix: str = "cpi", suffix: str = "dec") -> DataFrame:
    """MAC-02: last observation of each year and its year-on-year change."""
    y = _yearly(series, start_year).groupBy("year").agg(F.max_by(value, "date").alias(f"{prefix}_index_{suffix}"))
    return y.withColumn(f"{prefix}_yoy_{suffix}", _pct_change(f"{prefix}_index_{suffix}"))


def rate_annual(series: DataFrame, value: str, start_year: int | None = None, prefix: str = "cash_rate") -> DataFrame:
    """MAC-03: yearly average, end-of-year value and their first differences (points)."""
    y = _yearly(series, start_year).groupBy("year").agg(F.avg(value).alias(f"{prefix}_avg"),
                                                        F.max_by(value, "date").alias(f"{prefix}_eoy"))
    w = Window.orderBy("year")
    return y.withColumns({f"{prefix}_change_avg": F.col(f"{prefix}_avg") - F.lag(f"{prefix}_avg").over(w),
                          f"{prefix}_change_eoy": F.col(f"{prefix}_eoy") - F.lag(f"{prefix}_eoy").over(w)})


def close_year_end(series: DataFrame, value: str, start_year: int | None = None, prefix: str = "asx200") -> DataFrame:
    """MAC-04: year-end close from a daily close series, from ``start_year``, with yoy change.

    Years without rows between the first and the last year appear with NULL close (a calendar
    year-end resample), generated from the year bounds.
    """
    s = series.where(F.col(value).isNotNull()).withColumn("year", F.year("date").cast("int"))
    y = s.groupBy("year").agg(F.max_by(value, "date").alias(f"{prefix}_close"))
    lo, hi = y.select(F.min("year")).scalar(), y.select(F.max("year")).scalar()
    years = y.limit(1).select(F.explode(F.sequence(lo, hi)).alias("year"))
    full = years.join(y, "year", "left")
    if start_year is not None:
        full = full.where(F.col("year") >= int(start_year))
    # pct_change pads NULLs forward before dividing
    w = Window.orderBy("year")
    ff = F.last(f"{prefix}_close", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    full = full.withColumn("__ff", ff)
    return full.withColumn(f"{prefix}_yoy", safe_div("__ff", F.lag("__ff").over(w)) - 1).drop("__ff")


def macro_annual(tables: Sequence[DataFrame]) -> DataFrame:
    """JON-04: chained full outer joins of the yearly tables on year, sorted by year."""
    return full_outer_chain(list(tables), "year")
