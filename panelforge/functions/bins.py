"""Binning (BIN-*): fixed edges with labels, mapping bins, age bands, equal-width bins."""
from __future__ import annotations

import math
from typing import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.nulls import col_
from panelforge.functions.strings import map_values


def _fmt_edge(x: float, precision: int = 3) -> str:
    """Interval edge text as the reference prints it (3 significant decimals, float repr)."""
    if not math.isfinite(x) or x == 0:
        return repr(float(x))
    frac, whole = math.modf(x)
    digits = (-int(math.floor(math.log10(abs(frac)))) - 1 + precision) if whole == 0 else precision
    return repr(float(np.around(x, digits)))


def _interval_labels(edges: Sequence[float], right: bool, include_lowest: bool) -> list[str]:
    shown = [float(e) for e in edges]
    if right and include_lowest and math.isfinite(shown[0]):
        shown[0] = shown[0] - 10 ** -3
    out = []
    for a, b in zip(shown[:-1], shown[1:]):
        la, lb = _fmt_edge(a), _fmt_edge(b)
        out.append(f"({la}, {lb}]" if right else f"[{la}, {lb})")
    return out


def fixed_bins(c, edges: Sequence[float], labels: Sequence[str] | None = None, right: bool = True,
               include_lowest: bool = True, fill_value: str | None = "Unknown",
               extend_lower: bool = True, extend_upper: bool = True) -> Column:
    """BIN-01 / BIN-03: edges (sorted, optionally extended to +-inf) -> label; outside/NULL -> fill.

    Label count different from the interval count gives interval text such as '(2.0, 4.0]'.
    """
    e = sorted(float(x) for x in edges)
    if extend_lower:
        e = [-math.inf] + e
    if extend_upper:
        e = e + [math.inf]
    n = len(e) - 1
    labs = list(labels) if labels is not None and len(labels) == n else _interval_labels(e, right, include_lowest)
    x = col_(c).cast("double")
    out = F.lit(None).cast("string")
    for i in reversed(range(n)):
        lo, hi = e[i], e[i + 1]
        if right:
            lower_ok = (x > lo) if not (i == 0 and include_lowest) else (x >= lo)
            upper_ok = x <= hi
        else:
            lower_ok = x >= lo
            upper_ok = x < hi
        conds = []
        if math.isfinite(lo):
            conds.append(lower_ok)
        if math.isfinite(hi):
            conds.append(upper_ok)
        cond = x.isNotNull()
        for cc in conds:
            cond = cond & cc
        out = F.when(cond, F.lit(labs[i])).otherwise(out)
    return F.coalesce(out, F.lit(fill_value)) if fill_value is not None else out


def mapping_bins(c, mapping: Mapping, default: str = "Unknown") -> Column:
    """BIN-02: dictionary bins with a default."""
    return map_values(c, mapping, default)


def age_bands(c, bands: Sequence[float] = (5, 20), labels: Sequence[str] | None = None) -> Column:
    """BIN-04: (-inf, b0], (b0, b1], (b1, inf) with default labels '0–b0', 'b0+1–b1', 'b1+1+'."""
    b = list(bands)
    if labels is None:
        labels = [f"0–{b[0]}", f"{b[0] + 1}–{b[1]}", f"{b[1] + 1}+"]
    return fixed_bins(c, b, labels, right=True, include_lowest=True, fill_value=None)


def equal_width_bin(df: DataFrame, c: str, bins: int = 20, output: str = "bin") -> DataFrame:
    """BIN-06: equal-width bin index in [0, bins) from the column's global min/max.

    The bounds are scalar subqueries (one tiny aggregate each, no join); the lowest value
    falls in bin 0, other values in the right-closed bin that contains them.
    """
    lo = df.select(F.min(F.col(c).cast("double"))).scalar()
    hi = df.select(F.max(F.col(c).cast("double"))).scalar()
    x = F.col(c).cast("double")
    width = (hi - lo) / F.lit(float(bins))
    idx = F.when(x.isNotNull(), F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.greatest(F.ceil((x - lo) / width) - 1, F.lit(0)), F.lit(bins - 1))))
    return df.withColumn(output, idx.cast("int"))
