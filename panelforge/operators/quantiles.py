"""Exact quantiles of columns and groups, inside Spark and in one way for every size.

1. values are counted per (group, value) with map-side combine, so ties collapse into counts;
2. the counts are range-sliced by (group, value): a group of any size spreads over many tasks;
3. the counts of each (group, slice), summed over the slices before, tell which slice holds a wanted rank;
4. only those slices are read again: running counts inside the slice give the value at the rank.

One row per group and quantile comes out; nothing is gathered, estimated or retried.

Interpolation: h = p * (n - 1); value = s[floor(h)] + (h - floor(h)) * (s[ceil(h)] - s[floor(h)]).
"""
from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.operators.slices import SLICE, null_safe_join, slice_counts, sliced


def value_counts(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``keys, __c, __v, __n``: how often each non-NULL value of column number ``__c`` occurs in a group."""
    named = [F.col(c).cast("double").alias(f"__v{i}") for i, c in enumerate(columns)]
    if len(columns) == 1:
        long = df.select(*keys, F.lit(0).alias("__c"), named[0].alias("__v"))
    else:   # a row per value without an array per row
        long = df.select(*keys, *named).unpivot(list(keys), [f"__v{i}" for i in range(len(columns))], "__c", "__v")
        long = long.withColumn("__c", F.substring("__c", 4, 10).cast("int"))
    return long.where(F.col("__v").isNotNull()).groupBy(*keys, "__c", "__v").agg(F.count(F.lit(1)).alias("__n"))


def ranked_values(df: DataFrame, keys: Sequence[str], wanted: Sequence[tuple[str, float]], lower: bool = False) -> DataFrame:
    """``keys, __w, __q``: per group the exact quantile ``wanted[__w]`` = (column, probability).

    Groups without a value of the column have no row for it. NULL keys form a group. With ``lower`` the value at
    floor(h) is taken instead of interpolating, always one of the column's own.
    """
    keys = list(keys)
    columns = list(dict.fromkeys(c for c, _ in wanted))
    part = [*keys, "__c"]
    table = sliced(value_counts(df, keys, columns), part, ["__v"], "quantiles")
    places = slice_counts(table, part, "__n")
    # the wanted quantiles of a row's column, then the one or two ranks of each that lie in its slice
    listed = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(columns.index(c)).alias("c"), F.lit(float(p)).alias("p"))
                       for w, (c, p) in enumerate(wanted)])
    asked = places.withColumn("__l", F.explode(F.filter(listed, lambda a: a["c"] == F.col("__c"))))
    h = F.col("__l.p") * (F.col("__total") - 1)
    ends = [F.struct(F.lit(False).alias("hi"), F.floor(h).alias("k")),
            F.struct(F.lit(True).alias("hi"), (F.floor(h) if lower else F.ceil(h)).alias("k"))]
    asked = asked.select(*part, SLICE, "__rows", "__before", F.col("__l.w").alias("w"), (h - F.floor(h)).alias("f"), F.explode(F.array(*ends)).alias("e"))
    rank = F.col("e.k") - F.col("__before")
    asked = asked.where((rank >= 0) & (rank < F.col("__rows"))).select(*part, SLICE, "w", F.col("e.hi").alias("hi"), rank.alias("r"), "f")
    inside = Window.partitionBy(*part, SLICE).orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    held = null_safe_join(table, asked.select(*part, SLICE).distinct(), [*part, SLICE], "left_semi").withColumn("__upto", F.sum("__n").over(inside))
    # a join whose condition keeps the value at each rank: no list is walked row by row
    hits = (null_safe_join(held, asked, [*part, SLICE]).where((F.col("r") < F.col("__upto")) & (F.col("r") >= F.col("__upto") - F.col("__n")))
            .select(*keys, "__v", "w", "hi", "f"))
    ends = hits.groupBy(*keys, F.col("w").alias("__w")).agg(
        F.max(F.when(~F.col("hi"), F.col("__v"))).alias("__lo"), F.max(F.when(F.col("hi"), F.col("__v"))).alias("__hi"),
        F.max("f").alias("__f"))
    step = F.when((F.col("__f") == 0) | F.lit(lower), F.lit(0.0)).otherwise(F.col("__f") * (F.col("__hi") - F.col("__lo")))
    return ends.select(*keys, "__w", (F.col("__lo") + step).alias("__q"))


def grouped_quantiles(df: DataFrame, keys: Sequence[str], outputs: Mapping[str, tuple[str, float]]) -> DataFrame:
    """One row per group that has a value: an exact interpolated quantile per output name -> (column, probability)."""
    names = list(outputs)
    long = ranked_values(df, keys, [outputs[n] for n in names])
    return long.groupBy(*keys).agg(*[F.max(F.when(F.col("__w") == i, F.col("__q"))).alias(n) for i, n in enumerate(names)])


def group_quantiles(df: DataFrame, keys: Sequence[str], column: str, probs: Sequence[float],
                    names: Sequence[str] | None = None) -> DataFrame:
    """Exact interpolated quantiles of one column per group: (keys..., q0, q1, ... or ``names``)."""
    names = list(names or [f"q{i}" for i in range(len(probs))])
    return grouped_quantiles(df, keys, {n: (column, p) for n, p in zip(names, probs)})


def quantiles_of(df: DataFrame, spec: Mapping[str, Sequence[float]]) -> dict[str, list[float | None]]:
    """Exact interpolated quantiles of whole columns, {column: [q(p) for p in probs]}; one row each comes to the driver."""
    wanted = [(c, p) for c, probs in spec.items() for p in probs]
    found = {r["__w"]: r["__q"] for r in ranked_values(df, [], wanted).collect()} if wanted else {}
    values = iter(range(len(wanted)))
    return {c: [found.get(next(values)) for _ in probs] for c, probs in spec.items()}


def cut_points(df: DataFrame, columns: Sequence[str], bins: int) -> dict[str, list[float]]:
    """The ``bins`` - 1 values at equal steps of rank in each column that has a value, from one sliced table."""
    wanted = [(c, i / bins) for c in columns for i in range(1, bins)]
    found = {r["__w"]: r["__q"] for r in ranked_values(df, [], wanted, lower=True).collect()} if wanted else {}
    return {c: [found[k] for k in range(j * (bins - 1), (j + 1) * (bins - 1))]
            for j, c in enumerate(columns) if j * (bins - 1) in found}


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float]) -> list[float | None]:
    return quantiles_of(df, {column: list(probs)})[column]


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    return {c: v[0] for c, v in quantiles_of(df, {c: [0.5] for c in columns}).items()}
