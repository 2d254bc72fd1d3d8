"""Order statistics and totals of calendar-month frames, without copying a row per frame.

A frame of group g at month t holds the rows of g with month in [t - past, t + future]. Rows are first counted per
(group, month, value) and the counts range-sliced by (group, value): a slice holds a value range of a group, with
all its months. Then

1. rows per (group, slice, month), summed over each frame's months and over the slices before, tell which slice
   holds a wanted rank of a frame and its rank there;
2. inside a slice the rows of one month form a run sorted by value. The value at a rank is found by halving the
   slice's value range: at each step the ranks of the middle value in the runs of the frame's months are added up.

The work of 2 grows with the number of frames, the months of a frame and the logarithm of the slice, not with rows
times months.
"""
from __future__ import annotations

from typing import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.operators.slices import SLICE, sliced, written

#: Ranks around the middle of a frame of n values, and after one of them is taken out.
FRAME_RANKS = {"f_sa": lambda n: F.floor((n - 2) / 2), "f_sa1": lambda n: F.floor((n - 2) / 2) + 1,
               "f_sb": lambda n: F.floor((n - 1) / 2), "f_sb1": lambda n: F.floor((n - 1) / 2) + 1,
               "f_sm": lambda n: F.floor(n / 2)}
#: Ranks of the two smallest and the two largest values.
_ENDS = {"f_lo0": lambda n: F.lit(0) * n, "f_lo1": lambda n: F.lit(0) * n + 1, "f_hi0": lambda n: n - 1, "f_hi1": lambda n: n - 2}


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    before = np.cumsum(count) - count
    return np.arange(int(count.sum())) - np.repeat(before - first, count)


def values_at_ranks(group: np.ndarray, month: np.ndarray, value: np.ndarray, count: np.ndarray, of: np.ndarray,
                    low: np.ndarray, high: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each request the value at 0-based ``rank`` among the rows of group ``of`` with month in [low, high].

    Rows stand for ``count`` equal values each; groups are numbered from 0. The rank must exist.
    """
    n = len(group)
    by_value = np.lexsort((value, group))
    group, month, value, count = group[by_value], month[by_value], value[by_value], count[by_value]
    # runs: the rows of one group and month, by value; a row is known by its place in the order by value
    by_run = np.lexsort((np.arange(n), month, group))
    g, m = group[by_run], month[by_run]
    new = np.ones(n, bool)
    new[1:] = (g[1:] != g[:-1]) | (m[1:] != m[:-1])
    run_start = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    key = run * n + by_run                        # rising: runs in order, places inside a run
    upto = np.concatenate([[0], np.cumsum(count[by_run])])
    # the runs of each request: those of its group between its months
    first_month = int(min(month.min(), low.min()))
    width = int(max(month.max(), high.max())) - first_month + 2
    run_key = g[run_start] * width + (m[run_start] - first_month)
    first = np.searchsorted(run_key, of * width + (low - first_month))
    runs = np.searchsorted(run_key, of * width + (high - first_month), side="right") - first
    request, which = np.repeat(np.arange(len(of)), runs), _spread(first, runs)
    ahead = upto[run_start[which]]
    # halve the group's places until one is left: the first with more than ``rank`` values up to it
    below = np.searchsorted(group, of) - 1
    upper = np.searchsorted(group, of, side="right") - 1
    while (upper - below > 1).any():
        middle = (below + upper) >> 1
        reached = upto[np.searchsorted(key, which * n + middle[request], side="right")] - ahead
        enough = np.bincount(request, reached, len(of)) > rank
        upper, below = np.where(enough, middle, upper), np.where(enough, below, middle)
    return value[upper]


def _select(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    """The requests of one slice: ``__g, __t, __w`` with the value found."""
    names = pd.Index(rows["__g"].unique())
    values = values_at_ranks(names.get_indexer(rows["__g"]), rows["__t"].to_numpy(np.int64), rows["__x"].to_numpy(float),
                             rows["__n"].to_numpy(np.int64), names.get_indexer(asked["__of"]),
                             asked["__from"].to_numpy(np.int64), asked["__to"].to_numpy(np.int64), asked["__r"].to_numpy(np.int64)
                             ) if len(asked) else np.zeros(0)
    return pd.DataFrame({"__g": asked["__of"], "__t": asked["__at"], "__w": asked["__w"], "__q": values})


def group_text(keys: list[str]) -> Column:
    """One text per combination of key values, NULLs included: each value with its length before it."""
    texts = [F.col(k).cast("string") for k in keys]
    return F.concat(F.lit(""), *[F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in texts])


def _ranked(table: DataFrame, frames: DataFrame, past: int, future: int, ranks: Mapping) -> DataFrame:
    """``__g, __t`` and a value per rank name of every frame (``frames``: ``__g, __t``)."""
    held = table.where(F.col("__x").isNotNull())
    cells = held.groupBy("__g", SLICE, "__t").agg(F.sum("__n").alias("__m"))
    slices = cells.select("__g", SLICE).distinct()
    # every frame of a group in every slice of it, with the rows of the frame's months there
    grid = frames.join(slices, "__g").join(cells, ["__g", SLICE, "__t"], "left")
    months = Window.partitionBy("__g", SLICE).orderBy("__t").rangeBetween(-past, future)
    grid = grid.withColumn("__m", F.coalesce(F.sum("__m").over(months), F.lit(0)))
    frame = Window.partitionBy("__g", "__t")
    grid = grid.withColumns({"__all": F.sum("__m").over(frame),
                             "__before": F.coalesce(F.sum("__m").over(
                                 frame.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    asked = F.array(*[F.struct(F.lit(i).alias("w"), r(F.col("__all")).cast("bigint").alias("r")) for i, r in enumerate(ranks.values())])
    here = F.filter(asked, lambda a: (a["r"] >= 0) & (a["r"] < F.col("__all")) & (a["r"] >= F.col("__before"))
                    & (a["r"] < F.col("__before") + F.col("__m")))
    requests = (grid.select("__g", SLICE, "__t", "__before", F.explode(here).alias("__a"))
                .select(F.col("__g").alias("__of"), F.col(SLICE).alias("__in"), F.col("__t").alias("__at"), F.col("__a.w").alias("__w"), (F.col("__a.r") - F.col("__before")).alias("__r"),
                        (F.col("__t") - past).alias("__from"), (F.col("__t") + future).alias("__to")))
    found = (held.select(*[F.col(c).alias(c) for c in ("__g", SLICE, "__t", "__x", "__n")]).groupBy(SLICE).cogroup(requests.groupBy("__in"))
             .applyInPandas(_select, "__g string, __t bigint, __w int, __q double"))
    return found.groupBy("__g", "__t").agg(*[F.max(F.when(F.col("__w") == i, F.col("__q"))).alias(n) for i, n in enumerate(ranks)])


def frame_statistics(rows: DataFrame, keys: list[str], past: int, future: int, ranks: Mapping, extremes: bool,
                     squares: bool) -> DataFrame:
    """One row per (keys, ``__t``) of ``rows`` (``keys, __t, __x``): rows, values, sum, ends and ranks of the frame.

    ``f_lo`` / ``f_hi``: the smallest / largest values, two of each with ``extremes``; ``f_q, f_d, f_0`` (with
    ``squares``): sums of squared and plain deviations from the group's mean ``f_0``. Written once: the rows are
    read here a single time, and the caller joins a small table.
    """
    counted = (rows.where(F.col("__t").isNotNull()).groupBy(*keys, "__t", "__x").agg(F.count(F.lit(1)).alias("__n"))
               .withColumn("__g", group_text(keys)))
    table = sliced(counted, ["__g"], [F.col("__x").asc_nulls_first(), "__t"], "frames")
    n = F.when(F.col("__x").isNotNull(), F.col("__n")).otherwise(0)
    exprs = [F.sum("__n").alias("c_rows"), F.sum(n).alias("c_n"), F.sum(F.col("__x") * F.col("__n")).alias("c_s"),
             F.min("__x").alias("c_min"), F.max("__x").alias("c_max")]
    cells = table.groupBy(*keys, "__g", "__t").agg(*exprs)
    group = Window.partitionBy("__g")
    if squares:
        mean = cells.groupBy("__g").agg(F.try_divide(F.sum("c_s"), F.sum("c_n")).alias("c_0"))
        off = F.col("__x") - F.col("c_0")
        moments = table.join(mean, "__g").groupBy("__g", "__t").agg(
            F.sum(off * F.col("__n")).alias("c_d"), F.sum(off * off * F.col("__n")).alias("c_q"), F.max("c_0").alias("c_0"))
        cells = cells.join(moments, ["__g", "__t"])
    months = group.orderBy("__t").rangeBetween(-past, future)
    frame = {"f_rows": F.sum("c_rows").over(months), "f_n": F.sum("c_n").over(months), "f_s": F.sum("c_s").over(months),
             "f_lo": F.array(F.min("c_min").over(months)), "f_hi": F.array(F.max("c_max").over(months))}
    if squares:
        frame |= {"f_q": F.sum("c_q").over(months), "f_d": F.sum("c_d").over(months), "f_0": F.max("c_0").over(months)}
    ranks = dict(ranks) | (_ENDS if extremes else {})
    totals = cells.select(*keys, "__g", "__t", *[e.alias(name) for name, e in frame.items()])
    out = totals.join(_ranked(table, cells.select("__g", "__t"), past, future, ranks), ["__g", "__t"], "left")
    if extremes:
        out = out.withColumns({"f_lo": F.array("f_lo0", "f_lo1"), "f_hi": F.array("f_hi0", "f_hi1")}).drop(*_ENDS)
    missing = [k for k in FRAME_RANKS if k not in ranks]
    out = out.withColumns({k: F.lit(None).cast("double") for k in missing}) if missing else out
    return written(out.withColumn("f_med", (F.col("f_sb") + F.col("f_sm")) / 2).drop("__g"), "frame-table")
