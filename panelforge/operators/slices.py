"""Range slices: a written table whose rows are dealt to tasks by (keys, order), and what follows from it.

``sliced`` range-partitions a table by its keys and an order within them, notes the partition of each row and
writes it once, so that every later step sees the same slices. A key of any size is spread over as many slices
as its rows need; within a key, slices follow each other in the order. Ranks, positions and neighbouring rows
then need only a count per (key, slice), summed over the slices before, and work inside one slice.
"""
from __future__ import annotations

import uuid
from functools import reduce
from operator import and_
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.session import scratch_path

SLICE = "__slice"


def written(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` written once as Parquet to the shared checkpoint folder and read back; cuts the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join where NULL keys match; the keys are ``left``'s."""
    names = {k: f"__r{i}_{k}" for i, k in enumerate(keys)}
    other = right.withColumnsRenamed(names)
    if not names:
        return left.join(other, how=how)
    return left.join(other, reduce(and_, (left[k].eqNullSafe(other[names[k]]) for k in keys)), how).drop(*names.values())


def sliced(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str = "sliced") -> DataFrame:
    """``df`` plus its slice number, range-partitioned by keys and order and written once."""
    cols = [*(F.col(k).asc_nulls_last() for k in keys), *(F.col(o) if isinstance(o, str) else o for o in order)]
    return written(df.repartitionByRange(*cols).withColumn(SLICE, F.spark_partition_id()), name)


def slice_counts(table: DataFrame, keys: Sequence[str], weight: Column | str = None) -> DataFrame:
    """``keys, __slice, __rows, __before, __total``: rows (or summed weight) of a key in a slice, in its earlier
    slices and altogether. At most one row per key and slice."""
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = table.groupBy(*keys, SLICE).agg(size.cast("bigint").alias("__rows"))
    key = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    earlier = key.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumns({"__before": F.coalesce(F.sum("__rows").over(earlier), F.lit(0)),
                               "__total": F.sum("__rows").over(key)})


def with_positions(df: DataFrame, keys: Sequence[str], order: Sequence[Column], output: str) -> DataFrame:
    """0-based position of every row within its key by ``order`` (which should be unique within the key)."""
    table = sliced(df, keys, order, "positions")
    inside = Window.partitionBy(*keys, SLICE).orderBy(*order)
    offsets = slice_counts(table, keys).select(*keys, SLICE, "__before")
    numbered = table.withColumn(output, F.row_number().over(inside) - 1)
    return (null_safe_join(numbered, offsets, [*keys, SLICE])
            .withColumn(output, (F.col(output) + F.col("__before")).cast("bigint")).drop("__before", SLICE))
