"""SRC-05/06: landed indicator tables with five metadata rows (title, description, frequency,
type, units) above the data rows; column 0 holds the date, the others are series.

A file is read as CSV records, not lines: cells may be quoted and hold commas, quotes and line breaks, in
any encoding. The first five records become per-column metadata, a rule picks the series column, and the data
records become dates and numbers; records that don't are kept with the reason in a table of their own.
"""
from __future__ import annotations

import csv
import io
from dataclasses import dataclass, field
from typing import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelforge.functions.dates import parse_date

META_ROWS = ("title", "desc", "freq", "type", "units")
#: How the statistics offices encode their files.
ENCODING = "windows-1252"


def csv_records(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """``pos, cells`` of the records of landed CSV files, empty ones left out; files follow each other by name.

    Spark's own reader knows a few encodings only, so a file's bytes are decoded and split in the task that reads them:
    landed files hold one indicator table each, as long as the calendar.
    """
    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                records = [r for r in csv.reader(io.StringIO(content.decode(encoding), newline="")) if any(r)]
                yield pd.DataFrame({"path": name, "n": range(len(records)), "cells": records})

    rows = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
    rows = rows.mapInPandas(split, "path string, n long, cells array<string>")
    return rows.select((F.dense_rank().over(Window.orderBy("path")) * F.lit(1 << 32) + F.col("n")).alias("pos"), "cells")


def read_series_records(spark: SparkSession, path: str, encoding: str = ENCODING) -> tuple[list[dict], DataFrame]:
    """Return (column metadata list, data records DataFrame with ``cells`` and ``pos``)."""
    rows = csv_records(spark, path, encoding)
    head = [r["cells"] for r in rows.orderBy("pos").limit(len(META_ROWS)).collect()]   # five records
    if len(head) < len(META_ROWS):
        raise RuntimeError(f"{path} has fewer than {len(META_ROWS)} header rows")
    meta = []
    for col in range(1, max(map(len, head))):
        m = {k: (cells[col] if col < len(cells) else "").strip() for k, cells in zip(META_ROWS, head)}
        if any(m.values()):
            meta.append(m | {"index": col})
    last = rows.orderBy("pos").limit(len(META_ROWS)).agg(F.max("pos")).scalar()
    return meta, rows.where(F.col("pos") > last)


@dataclass(frozen=True)
class SeriesPattern:
    """Phrases that a series' metadata hold (any case), by field; ``without`` names ones they must not hold."""

    holds: Mapping[str, Sequence[str]]
    without: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def fits(self, meta: Mapping) -> bool:
        def found(field_name: str, phrase: str) -> bool:
            return any(phrase in meta[f].lower() for f in field_name.split("/"))

        return (all(found(f, p) for f, ps in self.holds.items() for p in ps)
                and not any(found(f, p) for f, ps in self.without.items() for p in ps))


# The phrases of each indicator's series, best pattern first ("a/b": in either field).
CPI_SERIES = (SeriesPattern({"desc": ("all groups cpi", "index", "weighted average of eight capital cities")}),
              SeriesPattern({"desc": ("index",)}, without={"units": ("%",)}))
CASH_SERIES = (SeriesPattern({"title/desc": ("cash rate", "target"), "freq": ("daily",)}),
               SeriesPattern({"title/desc": ("cash rate", "target"), "freq": ("monthly",)}),
               SeriesPattern({"title/desc": ("cash rate", "target")}))


def best_series(meta: list[dict], patterns: Sequence[SeriesPattern], what: str) -> int:
    """SRC-06: column of the first series that fits the best pattern any series fits."""
    ranked = [(rank, m["index"]) for rank, p in enumerate(patterns) for m in meta if p.fits(m)]
    if not ranked:
        raise RuntimeError(f"no {what} column")
    return min(ranked)[1]


def cpi_rule(meta: list[dict]) -> int:
    """Column of the all-groups CPI index, else of the first index that is not in percent."""
    return best_series(meta, CPI_SERIES, "CPI index")


def cash_rule(meta: list[dict]) -> int:
    """Column of the cash rate target, daily before monthly before other frequencies."""
    return best_series(meta, CASH_SERIES, "cash rate target")


def series_rows(spark: SparkSession, path: str, rule: Callable[[list[dict]], int], value_name: str,
                encoding: str = ENCODING, day_first: bool = False) -> DataFrame:
    """(pos, date, value, date_text, value_text, reason) of every data record; ``reason`` is NULL for a good one.

    Numbers may have thousands separators.
    """
    meta, data = read_series_records(spark, path, encoding)
    col = rule(meta)
    cell = lambda i: F.nullif(F.trim(F.try_element_at("cells", F.lit(i + 1))), F.lit(""))
    out = data.select("pos", cell(0).alias("date_text"), cell(col).alias("value_text"))
    number = F.regexp_replace("value_text", r"(?<=\d),(?=\d{3}(\D|$))", "")
    out = out.withColumns({"date": parse_date("date_text", day_first=day_first), value_name: number.try_cast("double")})
    reason = (F.when(F.col("date_text").isNull(), "missing date").when(F.col("date").isNull(), "unparsable date")
              .when(F.col("value_text").isNull(), "missing value").when(F.col(value_name).isNull(), "unparsable value"))
    return out.select("pos", "date", value_name, "date_text", "value_text", reason.alias("reason"))


def rejected_rows(spark: SparkSession, path: str, rule: Callable[[list[dict]], int], encoding: str = ENCODING,
                  day_first: bool = False) -> DataFrame:
    """SRC-05 audit: the records :func:`read_series` leaves out, as texts with the reason."""
    rows = series_rows(spark, path, rule, "value", encoding, day_first).where(F.col("reason").isNotNull())
    return rows.select("pos", "date_text", "value_text", "reason")


def read_series(spark: SparkSession, path: str, rule: Callable[[list[dict]], int], value_name: str,
                percent_guard: bool = False, encoding: str = ENCODING, day_first: bool = False) -> DataFrame:
    """(date, value) for the chosen column: records without a date or number dropped, sorted by date.

    With ``percent_guard`` a series whose median is below 0.2 is a fraction and becomes percent.
    """
    rows = series_rows(spark, path, rule, value_name, encoding, day_first)
    out = rows.where(F.col("reason").isNull()).select("date", value_name)
    if percent_guard:   # one file's series: its length is that of the calendar
        med = out.select(F.percentile(value_name, 0.5)).scalar()
        out = out.withColumn(value_name, F.when(med < 0.2, F.col(value_name) * 100.0).otherwise(F.col(value_name)))
    return out.orderBy("date")


def write_series_file(df: DataFrame, path: str, header_rows: list[list[str]]) -> str:
    """Land a (date, v1, v2, ...) table as one CSV text file with metadata rows first."""
    spark = df.sparkSession
    meta = spark.createDataFrame([(i, ",".join(r)) for i, r in enumerate(header_rows)], "k int, value string")
    cols = df.columns
    body = df.select(F.lit(len(header_rows)).alias("k"), F.concat_ws(",", F.date_format(cols[0], "yyyy-MM-dd"),
                                                                      *[F.coalesce(F.col(c).cast("string"), F.lit(""))
                                                                        for c in cols[1:]])
                     .alias("value"), F.col(cols[0]).alias("d"))
    out = meta.withColumn("d", F.lit(None).cast("timestamp")).unionByName(body)
    # one output file; the series is calendar-bounded (days x series), not data-bounded
    out.repartition(1).sortWithinPartitions("k", "d").select("value").write.mode("overwrite").text(path)
    return path


def write_series_records(df: DataFrame, path: str, header_rows: Sequence[Sequence[str]]) -> str:
    """Land a table of texts, its first column the date, as one CSV file (UTF-8) with metadata records first; cells are
    quoted where they need it."""
    cols = df.columns
    meta = df.sparkSession.createDataFrame([(i, *r) for i, r in enumerate(header_rows)],
                                           "k int, " + ", ".join(f"`{c}` string" for c in cols))
    body = df.select(F.lit(len(header_rows)).alias("k"), *[F.col(c).cast("string").alias(c) for c in cols])
    out = meta.unionByName(body).repartition(1).sortWithinPartitions("k", cols[0]).select(*cols)   # calendar-bounded
    out.write.mode("overwrite").option("escape", '"').option("emptyValue", "").csv(path)
    return path
