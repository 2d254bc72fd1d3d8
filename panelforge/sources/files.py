"""File sources and sinks: Parquet/CSV by extension, CSV directory union, audit and list sinks."""
from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table: ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_parquet_or_csv(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """SRC-02: read by extension; CSV columns stay strings (coerce explicitly later)."""
    p = path.rstrip("/")
    if p.endswith(".parquet") or p.endswith(".pq"):
        return spark.read.parquet(path)
    if p.endswith(".csv"):
        return spark.read.option("header", header).option("inferSchema", False).csv(path)
    raise ValueError(f"unsupported file type: {path}")


def save_parquet_or_csv(df: DataFrame, path: str, mode: str = "overwrite",
                        partition_by: Sequence[str] | None = None) -> str:
    """SRC-03: write by extension (a directory of part files, as Spark writes)."""
    p = path.rstrip("/")
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if p.endswith(".csv"):
        w.option("header", True).csv(path)
    elif p.endswith(".parquet") or p.endswith(".pq"):
        w.parquet(path)
    else:
        raise ValueError(f"unsupported file type: {path}")
    return path


def read_csv_union(spark: SparkSession, paths: Sequence[str], encoding: str = "utf-8",
                   source_col: str = "sourceFile") -> DataFrame:
    """SRC-01: stack CSV files by column name (missing -> NULL), keep the source file name.

    Files are grouped by header so that each group is one scan; groups are unioned by name.
    ``paths`` may be files or glob patterns; no match raises.
    """
    files = []
    for p in paths:   # patterns are expanded first: the files behind one may have different headers
        files += [r["path"] for r in spark.read.format("binaryFile").load(p).select("path").collect()] if any(
            c in p for c in "*?[{") else [p]
    files = sorted(set(files))
    if not files:
        raise FileNotFoundError("no CSV files matched")
    reader = (spark.read.option("header", True).option("inferSchema", False)
              .option("encoding", encoding).option("mode", "PERMISSIVE"))
    # the first record of every file, read in one job: files that share it are one scan
    first = (spark.read.text(files, wholetext=False).select(F.col("_metadata.file_path").alias("f"), "value",
                                                            F.monotonically_increasing_id().alias("pos"))
             if encoding.lower().replace("-", "") == "utf8" else
             spark.read.option("encoding", encoding).csv(files, schema="value string", sep="\u0001", quote="").select(
                 F.col("_metadata.file_path").alias("f"), "value", F.monotonically_increasing_id().alias("pos")))
    heads = first.groupBy("f").agg(F.min_by("value", "pos").alias("head")).collect()   # one row a file
    groups: dict[str, list[str]] = {}
    for r in sorted(heads, key=lambda r: r["f"]):
        groups.setdefault(r["head"], []).append(r["f"])
    frames = [reader.csv(fs).withColumn(source_col, F.col("_metadata.file_name"))
              for _, fs in sorted(groups.items())]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def filter_with_reason(df: DataFrame, keep, reason: str, reason_col: str = "_drop_reason"):
    """FLT-01 / SRC-07: split into (kept, dropped-with-reason); NULL predicate counts as drop."""
    k = F.coalesce(keep, F.lit(False))
    return df.filter(k), df.filter(~k).withColumn(reason_col, F.lit(reason))


def write_lines(df: DataFrame, column: str, path: str) -> str:
    """SRC-08: one value per line (e.g. the selected feature list)."""
    df.select(F.col(column).cast("string")).coalesce(1).write.mode("overwrite").text(path)
    return path


class Registry:
    """SRC-04: dataset registry resolving frames, aliases, '{alias}' references and paths."""

    def __init__(self, spark: SparkSession, datasets: Mapping[str, object] | None = None):
        self.spark = spark
        self.datasets = dict(datasets or {})

    def resolve(self, key) -> DataFrame:
        if isinstance(key, DataFrame):
            return key
        k = str(key)
        if k.startswith("{") and k.endswith("}"):
            k = k[1:-1]
        if k in self.datasets:
            v = self.datasets[k]
            return v if isinstance(v, DataFrame) else self.resolve(v)
        if "/" not in k and "." not in k:
            try:
                if self.spark.catalog.tableExists(k):
                    return self.spark.table(k)
            except Exception:  # not a valid table identifier: treat as a path
                pass
        return load_parquet_or_csv(self.spark, k)
