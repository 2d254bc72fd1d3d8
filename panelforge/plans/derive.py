"""Declarative derive specifications -> one lazy plan.

A spec is an ordered list of steps (plain dicts, as in a YAML file). Each step maps to one
DataFrame -> DataFrame function; the fold builds a single Catalyst plan and nothing runs until
the caller writes the result. Window steps with the same (group, time) spec are merged into one
operator call so that Spark computes their frame totals in one window node.
"""
from __future__ import annotations

from typing import Any, Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions import arith, bins, dates, expressions, strings
from panelforge.operators import cleaning, groups, joins, panel, windows
from panelforge.plans import blocks
from panelforge.sources.files import Registry


def expr_columns(df: DataFrame, exprs: Mapping[str, str]) -> DataFrame:
    """EXP-01..08: output columns from expression texts over the columns of ``df`` (see ``functions.expressions``)."""
    return df.withColumns({out: expressions.expression(df, text) for out, text in exprs.items()})


def _several(df: DataFrame, outputs: Sequence[str], text: str | Sequence[str]) -> DataFrame:
    """One column per output, from a tuple expression or from one text each."""
    found = (expressions.expression_columns(df, text) if isinstance(text, str)
             else [expressions.expression(df, t) for t in text or ()])
    if len(found) != len(outputs):
        raise expressions.ExpressionError(f"expected {len(outputs)} values, not {len(found)}, in expression {text!r}")
    return df.withColumns(dict(zip(outputs, found)))


def _simple(df: DataFrame, step: Mapping[str, Any], ctx: Registry) -> DataFrame:
    m = str(step.get("method", "")).lower()
    cfg = step.get("config") or {}
    src, out = step.get("source"), step.get("output")
    if m == "expr":
        e = cfg.get("expr") or step.get("expr")
        return _several(df, out, e) if isinstance(out, (list, tuple)) else expr_columns(df, {out: e})
    if src is not None and src not in df.columns and m not in ("distance_to_cbd",):
        return df
    if m == "map_values":
        return df.withColumn(out or src, strings.map_values(src, cfg.get("mapping") or step.get("mapping") or {},
                                                            cfg.get("default", step.get("default"))))
    if m == "extract_street":
        return df.withColumn(out or "street", strings.extract_street(src, cfg.get("unknown_value", "Unknown")))
    if m == "to_month_index":
        return panel.month_index(df, src, out or "month_id", int(cfg.get("offset", 0)))
    if m == "cyclical_encode":
        prefix = out if isinstance(out, str) else cfg.get("out_prefix", src)
        c = dates.cyclical(src, int(cfg.get("period", 12)))
        names = list(out) if isinstance(out, (list, tuple)) else [f"{prefix}_sin", f"{prefix}_cos"]
        return df.withColumns({names[0]: c["sin"], names[1]: c["cos"]})
    if m == "property_age":
        return df.withColumn(out or "propertyAge", dates.age_at(cfg.get("sale_year_col", "saleYear"), src,
                                                                 cfg.get("min_age"), cfg.get("max_age")))
    if m == "date_parts":
        src = src or "saleDate"
        if not step.get("skip_all_null_check") and df.where(F.col(src).isNotNull()).limit(1).count() == 0:
            return df                                              # all NULL: skipped, as specified
        p = dates.date_parts(src)
        return df.withColumns({cfg.get("year_output", "saleYear"): p["year"],
                               cfg.get("month_output", "saleMonth"): p["month"],
                               cfg.get("year_month_output", "saleYearMonth"): p["year_month"]})
    if m == "distance_to_cbd":
        lat, lon = cfg.get("latitude_col", "latitude"), cfg.get("longitude_col", "longitude")
        if lat not in df.columns or lon not in df.columns:
            return df
        return df.withColumn(out or "distance_to_cbd", arith.haversine_km(lat, lon))
    raise ValueError(f"unsupported simple method {m!r}")


def _aggregate(df, step, ctx, source=None):
    cfg = step.get("config") or {}
    return groups.group_transform(df, step.get("group_by"), step["target"], step["outputs"], cfg.get("min_count"),
                                  source=source)


def _time_aggregate(df, step, ctx, source=None):
    w = step.get("window") or {}
    if step.get("time_col") not in df.columns or step.get("target") not in df.columns:
        return df
    return windows.time_range_aggregate(df, step["group_by"], step["time_col"], step["target"], step["outputs"],
                                        w.get("past", 0), w.get("future", 0), w.get("include_current", False),
                                        time_is_ordinal=bool(step.get("time_is_ordinal", False)),
                                        min_count=(step.get("config") or {}).get("min_count"), source=source)


def _rolling(df, step, ctx, source=None):
    cfg = step.get("config") or {}
    return windows.rolling(df, step["group_by"], step["sort_by"], step["target"], int(step["window"]),
                           step["outputs"], int(cfg.get("min_periods", 1)), bool(cfg.get("center", False)),
                           step.get("tie_breaker", "row_id"))


def _bin(df, step, ctx):
    cfg = step.get("config") or {}
    if step["source"] not in df.columns:
        return df
    if step.get("method", "fixed") == "mapping":
        return df.withColumn(step["output"], bins.mapping_bins(step["source"], cfg.get("mapping") or {},
                                                               cfg.get("default", "Unknown")))
    return df.withColumn(step["output"], bins.fixed_bins(
        step["source"], cfg.get("edges") or cfg.get("bins"), cfg.get("labels"), bool(cfg.get("right", True)),
        bool(cfg.get("include_lowest", True)), cfg.get("fill_value", "Unknown"),
        bool(cfg.get("extend_lower", True)), bool(cfg.get("extend_upper", True))))


def _join(df, step, ctx):
    right = ctx.resolve(step["right"])
    return joins.join_step(df, right, step["on"], step.get("how", "left"), step.get("select"),
                           tuple(step.get("suffixes", ("", "_right"))), step.get("validate"),
                           step.get("on_missing", "warn"))


def _blocks(df, step, ctx):
    """A spec of named blocks as one step (see ``plans.blocks``)."""
    return blocks.run_blocks(df, step["blocks"], ctx.datasets)


STEPS: dict[str, Callable[[DataFrame, Mapping[str, Any], Registry], DataFrame]] = {
    "simple": _simple, "aggregate": _aggregate, "time_aggregate": _time_aggregate,
    "rolling": _rolling, "bin": _bin, "join": _join, "blocks": _blocks,
}


def _merge_time_steps(steps: Sequence[Mapping[str, Any]]) -> list[Mapping[str, Any]]:
    """Adjacent time_aggregate steps with the same group/time/target/window become one call."""
    out: list[dict] = []
    for s in steps:
        if (s.get("type") == "time_aggregate" and out and out[-1].get("type") == "time_aggregate"
                and all(out[-1].get(k) == s.get(k) for k in ("group_by", "time_col", "target", "window"))
                and out[-1].get("enabled", True) and s.get("enabled", True)):
            merged = dict(out[-1])
            merged["outputs"] = {**out[-1]["outputs"], **s["outputs"]}
            out[-1] = merged
        else:
            out.append(dict(s))
    return out


def _outputs(df: DataFrame) -> dict[str, str]:
    """Column name -> attribute of the analysed plan; a step that rewrites a column gives it a new one."""
    out = df._jdf.queryExecution().analyzed().output()
    return {out.apply(i).name(): out.apply(i).exprId().toString() for i in range(out.size())}


def run_derive(df: DataFrame, steps: Sequence[Mapping[str, Any]], datasets: Mapping[str, Any] | None = None,
               default_fill=None, materialize: bool = False) -> DataFrame:
    """Apply an ordered step list (one lazy plan); optional global default fill at the end (NUL-03).

    ``materialize`` writes the input once (reliable checkpoint in the shared folder) so the
    statistics of every grouped/window step read it instead of re-running an expensive upstream.
    """
    if materialize:
        from panelforge.session import cut_lineage
        df = cut_lineage(df)
    ctx = Registry(df.sparkSession, datasets)
    # Statistics of grouped/window steps are computed from the input plan (``base``) whenever the
    # columns they need are still untouched and no step has changed the rows, so each step joins
    # its results onto the growing plan once instead of re-running that plan for its statistics.
    base, dirty, rows_same = df, set(), True
    for step in _merge_time_steps(steps):
        if not step.get("enabled", True):
            continue
        kind = step.get("type")
        if kind not in STEPS:
            raise ValueError(f"unknown step type {kind!r}")
        before = _outputs(df)
        if kind in ("aggregate", "time_aggregate", "rolling"):
            g = step.get("group_by")
            tie = step.get("tie_breaker", "row_id") if kind == "rolling" else None
            need = ([g] if isinstance(g, str) else list(g or [])) + [step.get("target")] + \
                ([step["time_col"]] if kind == "time_aggregate" else []) + \
                ([step["sort_by"]] + ([tie] if isinstance(tie, str) else list(tie or [])) if kind == "rolling" else [])
            clean = rows_same and all(c in base.columns and c not in dirty for c in need)
            df = STEPS[kind](df, step, ctx, source=base.select(*dict.fromkeys(need)) if clean else None)
        else:
            df = STEPS[kind](df, step, ctx)
        if kind == "blocks":
            rows_same = False                      # a block may have dropped rows
        if kind == "join" and (step.get("how", "left") != "left"
                               or step.get("validate") not in ("many_to_one", "m:1", "one_to_one", "1:1")):
            rows_same = False                      # the join may have changed the row set
        dirty |= {c for c, attribute in _outputs(df).items() if before.get(c) != attribute}
    if default_fill is not None:
        df = cleaning.default_fill(df, default_fill)
    return df
