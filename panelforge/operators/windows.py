"""Calendar-month range windows (WIN-01..05) and row-count rolling windows (WIN-06).

Time-range aggregates run in three steps so that no group is ever held by one task:

1. rows -> (keys, month) cells with a partial/final ``groupBy`` (map-side combine);
2. a RANGE window over the small cell table merges cells into frame totals;
3. the frame table is joined back to the rows on (keys, month), NULL-safe.

Leave-current-row-out results (``include_current=False``, which removes only the current
row, not its month) follow from the frame totals by algebra (count, sum, sum of squares),
from the two smallest / largest values per frame (min, max), and from the order statistics
around the middle of the frame (median; see ``frames``).
"""
from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.dates import month_ordinal
from panelforge.operators.frames import FRAME_RANKS, frame_statistics
from panelforge.operators.groups import join_back
from panelforge.operators.slices import SLICE, null_safe_join, slice_counts, sliced

TIME_AGGS = ("mean", "median", "sum", "min", "max", "std", "count")
ROLL_AGGS = ("mean", "median", "sum", "min", "max", "std", "count", "nunique")


def _keys(k) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def _el(arr: Column, idx0: Column) -> Column:
    """0-based array element, NULL when out of range."""
    return F.when(idx0 >= 0, F.try_element_at(arr, (idx0 + 1).cast("int")))


def time_range_aggregate(df: DataFrame, keys, time_col: str, target: str, outputs: Mapping[str, str],
                         past: int = 0, future: int = 0, include_current: bool = False,
                         time_is_ordinal: bool = False, min_count: int | None = None,
                         source: DataFrame | None = None) -> DataFrame:
    """WIN-01..05: per row, aggregate the group's rows with month in [t - past, t + future].

    ``time_col`` holds YYYYMM integers (or month ordinals when ``time_is_ordinal``).
    A row with NULL time gets NULL. An empty frame gives NULL (count too); a frame whose
    target values are all NULL gives count 0 and sum 0.
    """
    keys = _keys(keys)
    past, future = max(0, int(past)), max(0, int(future))
    aggs = {a.lower(): o for a, o in outputs.items()}
    bad = set(aggs) - set(TIME_AGGS)
    if bad:
        raise ValueError(f"unsupported time aggregate(s): {sorted(bad)}")
    x = F.col(target).cast("double")
    t = F.col(time_col).cast("bigint") if time_is_ordinal else month_ordinal(time_col)
    need_sq = "std" in aggs
    need_lo = "min" in aggs
    need_hi = "max" in aggs
    need_med = "median" in aggs

    rows = df.withColumn("__t", t).withColumn("__x", x)
    # statistics come from ``source`` (same rows, fewer columns, earlier plan) when given
    srows = (source.select(*keys, time_col, target) if source is not None else df).select(
        *keys, t.alias("__t"), x.alias("__x"))
    if need_med:
        wanted = {n: r for n, r in FRAME_RANKS.items() if not include_current or n in ("f_sb", "f_sm")}
        ft = frame_statistics(srows, keys, past, future, wanted, extremes=not include_current and (need_lo or need_hi),
                              squares=need_sq)
        return _finish_time_range(rows, ft, keys, aggs, include_current, min_count)
    cell_exprs = [F.count(F.lit(1)).alias("c_rows"), F.count("__x").alias("c_n"),
                  F.sum("__x").alias("c_s")]
    if need_sq:
        cell_exprs.append(F.var_pop("__x").alias("c_v"))
    if need_lo or need_hi:
        cell_exprs += [F.min("__x").alias("c_min"), F.max("__x").alias("c_max")]
    cells = srows.where(F.col("__t").isNotNull()).groupBy(*keys, "__t").agg(*cell_exprs)
    if (need_lo or need_hi) and not include_current:
        # two smallest / largest values per cell (a multiset): min and max, how often they occur,
        # and the next value, from one more aggregate over the rows joined to their cell extremes
        ext = join_back(srows.where(F.col("__t").isNotNull()), cells.select(*keys, "__t", "c_min", "c_max"),
                        keys + ["__t"])
        second = ext.groupBy(*keys, "__t").agg(
            F.count(F.when(F.col("__x") == F.col("c_min"), 1)).alias("c_min_n"),
            F.min(F.when(F.col("__x") > F.col("c_min"), F.col("__x"))).alias("c_min2"),
            F.count(F.when(F.col("__x") == F.col("c_max"), 1)).alias("c_max_n"),
            F.max(F.when(F.col("__x") < F.col("c_max"), F.col("__x"))).alias("c_max2"))
        cells = join_back(cells, second, keys + ["__t"])
        cells = cells.withColumns({
            "c_lo": F.array_compact(F.array("c_min", F.when(F.col("c_min_n") >= 2, F.col("c_min")).otherwise(F.col("c_min2")))),
            "c_hi": F.array_compact(F.array("c_max", F.when(F.col("c_max_n") >= 2, F.col("c_max")).otherwise(F.col("c_max2"))))})

    if need_sq:
        # squares are summed around the group's mean, so large values with a small spread keep it
        group = Window.partitionBy(*keys)
        cells = cells.withColumn("c_0", F.when(F.sum("c_n").over(group) > 0, F.sum("c_s").over(group) / F.sum("c_n").over(group)))
        off = F.when(F.col("c_n") > 0, F.col("c_s") / F.col("c_n") - F.col("c_0"))
        cells = cells.withColumns({"c_d": F.col("c_n") * off, "c_q": F.col("c_n") * (F.col("c_v") + off * off)})
    w = Window.partitionBy(*keys).orderBy("__t").rangeBetween(-past, future)
    frame = {"f_rows": F.sum("c_rows").over(w), "f_n": F.sum("c_n").over(w),
             "f_s": F.sum("c_s").over(w)}
    if need_sq:
        frame["f_q"], frame["f_d"], frame["f_0"] = F.sum("c_q").over(w), F.sum("c_d").over(w), F.max("c_0").over(w)
    if need_lo or need_hi:
        if include_current:
            frame["f_lo"] = F.array(F.min("c_min").over(w))
            frame["f_hi"] = F.array(F.max("c_max").over(w))
        else:   # at most 2 values per cell and (past + future + 1) cells per frame
            frame["f_lo"] = F.slice(F.sort_array(F.flatten(F.collect_list("c_lo").over(w))), 1, 2)
            frame["f_hi"] = F.slice(F.sort_array(F.flatten(F.collect_list("c_hi").over(w)), asc=False), 1, 2)
    ft = cells.select(*keys, "__t", *[e.alias(n) for n, e in frame.items()])
    return _finish_time_range(rows, ft, keys, aggs, include_current, min_count)


def _finish_time_range(rows: DataFrame, ft: DataFrame, keys: list[str], aggs: Mapping[str, str], include_current: bool,
                       min_count: int | None) -> DataFrame:
    """Join the frame table back to the rows and read each row's results from it."""
    need_sq = "std" in aggs
    joined = join_back(rows.withColumnRenamed("__t", "__tt"),
                       ft.withColumnRenamed("__t", "__tt"), keys + ["__tt"])
    xv = F.col("__x")
    has_x = xv.isNotNull()
    if include_current:
        n_rows, n_c, s_c = F.col("f_rows"), F.col("f_n"), F.col("f_s")
        q_c, d_c = (F.col("f_q"), F.col("f_d")) if need_sq else (None, None)
    else:
        n_rows = F.col("f_rows") - 1
        n_c = F.col("f_n") - F.when(has_x, 1).otherwise(0)
        s_c = F.col("f_s") - F.coalesce(xv, F.lit(0.0))
        own = F.coalesce(xv - F.col("f_0"), F.lit(0.0)) if need_sq else None
        q_c, d_c = (F.col("f_q") - own * own, F.col("f_d") - own) if need_sq else (None, None)
    s_c = F.coalesce(s_c, F.lit(0.0))
    res: dict[str, Column] = {}
    for agg, out in aggs.items():
        if agg == "mean":
            v = F.when(n_c > 0, s_c / n_c)
        elif agg == "sum":
            v = s_c
        elif agg == "count":
            v = n_c
        elif agg == "std":
            var = (q_c - d_c * d_c / n_c) / (n_c - 1)
            v = F.when(n_c > 1, F.sqrt(F.greatest(var, F.lit(0.0))))
        elif agg in ("min", "max"):
            arr = F.col("f_lo" if agg == "min" else "f_hi")
            if include_current:
                v = _el(arr, F.lit(0))
            else:
                v = F.when(has_x & (xv == _el(arr, F.lit(0))), _el(arr, F.lit(1))).otherwise(_el(arr, F.lit(0)))
        else:  # median
            if include_current:
                v = F.col("f_med")
            else:
                m = F.col("f_n") - 1          # frame size after removing x (x not NULL)
                def new_at(r):
                    # rank r of the frame with one occurrence of x removed
                    lo = F.when(r == F.floor((F.col("f_n") - 2) / 2), F.col("f_sa")).otherwise(F.col("f_sb"))
                    hi = F.when(r == F.floor((F.col("f_n") - 2) / 2), F.col("f_sa1")).otherwise(F.col("f_sb1"))
                    return F.when(lo < xv, lo).otherwise(hi)
                loo = (new_at(F.floor((m - 1) / 2)) + new_at(F.floor(m / 2))) / 2
                v = F.when(~has_x, F.col("f_med")).when(m > 0, loo)
        if min_count is not None and agg != "count":
            v = F.when(n_c >= int(min_count), v)
        res[out] = F.when(n_rows > 0, v)
    drop = [c for c in joined.columns if c.startswith("f_")] + ["__x", "__tt"]
    return joined.withColumns(res).drop(*drop)


def _rolling_columns(spec, target: str, outputs: Mapping[str, str], min_periods: int) -> dict:
    x = F.col(target).cast("double")
    n = F.count(x).over(spec)
    res = {}
    for agg, out in outputs.items():
        a = agg.lower()
        if a == "mean":
            v = F.avg(x).over(spec)
        elif a == "median":
            v = F.percentile(x, 0.5).over(spec)          # frame holds at most `window` rows
        elif a == "sum":
            v = F.coalesce(F.sum(x).over(spec), F.lit(0.0))
        elif a == "min":
            v = F.min(x).over(spec)
        elif a == "max":
            v = F.max(x).over(spec)
        elif a == "std":
            v = F.stddev_samp(x).over(spec)
        elif a == "count":
            v = n.cast("double")
        elif a == "nunique":
            v = F.size(F.collect_set(x).over(spec)).cast("double")
        else:
            raise ValueError(f"unsupported rolling aggregate {agg!r}")
        res[out] = F.when(n >= int(min_periods), v)
    return res


def rolling(df: DataFrame, keys, sort_by: str, target: str, window: int, outputs: Mapping[str, str],
            min_periods: int = 1, center: bool = False, tie_breaker: str | Sequence[str] | None = "row_id") -> DataFrame:
    """WIN-06: last ``window`` rows by ``sort_by`` of any type (NULLs last, ties by ``tie_breaker``).

    A result needs at least ``min_periods`` non-NULL values in the frame.

    Rows are range-sliced by (keys, order), so a hot group spreads over many tasks whatever its sort key. Each
    slice is windowed by itself, with the rows of neighbouring slices that its frames reach as a halo: at most
    ``window`` rows of the slices before (centred: and after), found from the slices' row counts. The results are
    those of one window per group.
    """
    keys = _keys(keys)
    w = int(window)
    lo, hi = (-(w // 2), (w - 1) // 2) if center else (-(w - 1), 0)
    ties = [c for c in _keys(tie_breaker)] if tie_breaker else []
    names = [sort_by, *ties]
    order = [F.col(c).asc_nulls_last() for c in names]
    table = sliced(df, keys, order, "rolling")
    narrow = table.select(*dict.fromkeys([*keys, sort_by, target, *ties, SLICE]))
    parts = [table.withColumn("__halo", F.lit(False))]
    for reach, back in ((-lo, True), (hi, False)):
        if reach > 0:
            parts.append(_halo(narrow, keys, names, reach, back).withColumn("__halo", F.lit(True)))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p, allowMissingColumns=True)
    spec = Window.partitionBy(*keys, SLICE).orderBy(*order).rowsBetween(lo, hi)
    out = every.withColumns(_rolling_columns(spec, target, outputs, min_periods)).where(~F.col("__halo"))
    return out.drop(SLICE, "__halo")


def _halo(table: DataFrame, keys: list[str], order: list[str], reach: int, back: bool) -> DataFrame:
    """Rows that frames of other slices reach, one copy per slice that does: ``back`` takes the last ``reach``
    rows of a slice to later slices, otherwise the first ones to earlier slices."""
    counts = slice_counts(table, keys).withColumn("__end", F.col("__before") + F.col("__rows"))
    key = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    counts = counts.withColumn("__k", F.row_number().over(key.orderBy(SLICE)))
    # pairs of slices of a key with fewer than ``reach`` rows between them; only the few small ones have far partners
    ahead = counts.select(*keys, F.explode(F.sequence(F.col("__k") + 1, F.col("__k") + reach)).alias("__k"),
                          F.col(SLICE).alias("__left"), F.col("__end").alias("__left_end"))
    pairs = (null_safe_join(counts, ahead, [*keys, "__k"])
             .withColumn("__gap", F.col("__before") - F.col("__left_end")).where(F.col("__gap") < reach))
    source, to = ("__left", SLICE) if back else (SLICE, "__left")
    pairs = pairs.select(*keys, F.col(source).alias("__from"), F.col(to).alias("__to"), "__gap")
    near = [F.col(c).desc_nulls_first() if back else F.col(c).asc_nulls_last() for c in order]
    edge = table.withColumn("__r", F.row_number().over(Window.partitionBy(*keys, SLICE).orderBy(*near)))
    edge = edge.where(F.col("__r") <= reach).withColumnRenamed(SLICE, "__from")
    halo = null_safe_join(edge, pairs, [*keys, "__from"]).where(F.col("__r") + F.col("__gap") <= reach)
    return halo.withColumn(SLICE, F.col("__to")).drop("__from", "__to", "__gap", "__r")
