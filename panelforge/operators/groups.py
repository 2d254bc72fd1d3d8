"""Group transforms (AGG-01..08) and aggregate-and-join-back (JON-05).

A group value is computed once per group with a partial/final ``groupBy`` (map-side combine,
so a hot key is pre-aggregated on every executor) and joined back null-safely. This avoids
``Window.partitionBy(keys)``, which would send a whole hot group to a single task.
The join side is the per-group table; AQE turns it into a broadcast when it is small at
run time, otherwise it is a shuffled equi-join whose skewed partitions AQE splits.
"""
from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.nulls import col_

AGG_NAMES = ("mean", "median", "sum", "min", "max", "std", "count", "nunique")


def agg_expr(name: str, target) -> Column:
    """Aggregate by the reference's names (pandas semantics: NULLs skipped; all-NULL sum = 0)."""
    x = col_(target)
    n = name.lower()
    if n == "mean":
        return F.avg(x)
    if n == "median":
        return F.percentile(x, 0.5)
    if n == "sum":
        return F.coalesce(F.sum(x), F.lit(0))
    if n == "min":
        return F.min(x)
    if n == "max":
        return F.max(x)
    if n == "std":
        return F.stddev_samp(x)
    if n == "count":
        return F.count(x)
    if n == "nunique":
        return F.count_distinct(x)
    raise ValueError(f"unsupported aggregate {name!r}")


def _as_list(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def join_back(df: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left-join a per-key table back onto rows with NULL == NULL key matching."""
    keys = list(keys)
    ren = {k: f"__k{i}" for i, k in enumerate(keys)}
    t = table.withColumnsRenamed(ren)
    cond = None
    for k in keys:
        c = df[k].eqNullSafe(t[ren[k]])
        cond = c if cond is None else cond & c
    return df.join(t, cond, "left").drop(*ren.values())


def grouped(df: DataFrame, keys: Sequence[str], specs: Sequence[tuple[str, str, str]],
            extra: Sequence[Column] = ()) -> DataFrame:
    """One row per group with aggregates given as (name, column, alias), plus extra Columns.

    Medians are exact but never gathered per group (``quantiles``): all of them come from one sliced table.
    """
    from panelforge.operators.quantiles import grouped_quantiles
    from panelforge.operators.slices import null_safe_join
    keys = list(keys)
    plain = [F.count(F.lit(1)).alias("__rows")] + [agg_expr(a, c).alias(o) for a, c, o in specs
                                                    if a.lower() != "median"] + list(extra)
    out = df.groupBy(*keys).agg(*plain)
    medians = {o: (c, 0.5) for a, c, o in specs if a.lower() == "median"}
    if medians:
        out = null_safe_join(out, grouped_quantiles(df, keys, medians), keys, "left")
    return out.drop("__rows")


def group_stats(df: DataFrame, keys, target: str, outputs: Mapping[str, str],
                min_count: int | None = None) -> DataFrame:
    """One row per group (NULL keys form their own group) with the requested aggregates."""
    keys = _as_list(keys)
    specs = [(a, target, o) for a, o in outputs.items()]
    extra = [F.count(target).alias("__n")] if min_count is not None else []
    out = grouped(df, keys, specs, extra)
    if min_count is not None:
        out = out.withColumns({o: F.when(F.col("__n") >= int(min_count), F.col(o)) for o in outputs.values()})
        out = out.drop("__n")
    return out


def group_transform(df: DataFrame, keys, target: str, outputs: Mapping[str, str],
                    min_count: int | None = None, source: DataFrame | None = None) -> DataFrame:
    """AGG-01: group value on every row, one output column per aggregate.

    ``source`` (same rows, at least keys + target) lets the statistics come from a narrow,
    earlier plan instead of ``df``, so a chain of steps references its growing plan once.
    """
    if target not in df.columns or any(k not in df.columns for k in _as_list(keys)):
        return df
    src = source if source is not None else df
    return join_back(df, group_stats(src, keys, target, outputs, min_count), _as_list(keys))


def aggregate_join_back(df: DataFrame, keys, target: str, aggregate: str, output: str) -> DataFrame:
    """JON-05: aggregate and left-join back; skipped when the output already exists."""
    if output in df.columns:
        return df
    return group_transform(df, keys, target, {aggregate: output})
