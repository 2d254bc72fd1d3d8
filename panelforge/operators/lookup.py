"""As-of feature lookup, batch scoring preparation, prediction post-processing, promotion.

JON-07 is an as-of join done the Spark way: the feature store is first reduced to one row per
(lookup key, month) (the last row of that month), then requests and store rows are unioned,
partitioned by the lookup key, ordered by month, and ``last(ignorenulls)`` carries the latest
store row at or before each request month. No request is paired with every store row.
"""
from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.bins import fixed_bins
from panelforge.functions.dates import age_at, split_year_month
from panelforge.functions.strings import canon_type
from panelforge.operators.slices import null_safe_join

# Two-sided normal quantiles used for prediction intervals.
Z_BY_LEVEL = {0.80: 1.2816, 0.90: 1.6449, 0.95: 1.96, 0.98: 2.3263, 0.99: 2.58}


def reindex(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """PRJ-07: exactly these columns in this order; missing ones become typed NULLs."""
    return df.select(*[(F.col(c).cast(t) if c in df.columns else F.lit(None).cast(t)).alias(c)
                       for c, t in columns.items()])


def rename_aliases(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """PRJ-08: rename input aliases to canonical names (only those present, target absent)."""
    ren = {a: c for a, c in aliases.items() if a in df.columns and c not in df.columns}
    return df.withColumnsRenamed(ren) if ren else df


def _asof(wanted: DataFrame, table: DataFrame, keys: Sequence[str], month_col: str) -> DataFrame:
    """``keys, __m, __ref``: for each wanted (keys, ``__m``) the table's latest ``__p`` at or before that month, else its
    latest of all; NULL where the table has no such key.

    The month-ordered window runs over distinct wanted pairs and the table's per-month rows only (both bounded by
    keys x months), so many requests for one hot key never share a window task.
    """
    kind = table.schema["__p"].dataType
    union = wanted.select(*keys, "__m", F.lit(None).cast(kind).alias("__p"), F.lit(1).alias("__is_req")).unionByName(
        table.select(*keys, F.col(month_col).alias("__m"), "__p", F.lit(0).alias("__is_req")))
    upto = Window.partitionBy(*keys).orderBy("__m", "__is_req").rowsBetween(Window.unboundedPreceding, 0)
    prior = union.withColumn("__prior", F.last("__p", ignorenulls=True).over(upto)).where(F.col("__is_req") == 1)
    latest = table.groupBy(*keys).agg(F.max_by("__p", F.col(month_col)).alias("__latest"))
    return null_safe_join(prior, latest, keys, "left").select(*keys, "__m", F.coalesce("__prior", "__latest").alias("__ref"))


def asof_reference(requests: DataFrame, store: DataFrame, columns: Sequence[str], request_id: str = "request_id",
                   suburb_col: str = "suburb", month_col: str = "saleYearMonth",
                   filters: Sequence[str] = (), order_col: str = "row_id") -> DataFrame:
    """JON-07: per request the representative store row: same suburb (case-insensitive) and,
    when any store row matches them, the request's filter values; exact month, else the latest
    earlier month, else the latest month; the last row within that month. A NULL request value
    skips its filter.

    Returns (request_id, <columns...>) from the chosen store row, one row per request row.

    The store is reduced once, to its last row per suburb, all filters and month. The choices of filters that
    occur among the requests (and the empty one, to fall back on) are then built from that table alone.
    """
    bits = {f: 1 << i for i, f in enumerate(filters)}
    chosen = sum((F.when(F.col(f).isNotNull(), b).otherwise(0) for f, b in bits.items()), F.lit(0))
    req = requests.select(F.col(request_id).alias("__rid"), F.upper(F.trim(F.col(suburb_col))).alias("__su"), *filters,
                          F.col(month_col).alias("__m"), chosen.alias("__use"))
    payload = F.struct(F.col(order_col).alias("__o"), F.struct(*[F.col(c) for c in columns]).alias("__p"))
    full = (store.groupBy(F.upper(F.col(suburb_col).cast("string")).alias("__su"), *filters, F.col(month_col))
            .agg(F.max_by(payload, F.col(order_col)).alias("__x")))
    used = {0} | ({r[0] for r in req.select("__use").distinct().collect()} if filters else set())   # at most 2^filters
    keys = ["__su", "__use", *filters]
    under = full.withColumn("__use", F.explode(F.array(*[F.lit(u) for u in sorted(used)])))
    under = under.withColumns({f: F.when(F.col("__use").bitwiseAND(F.lit(b)) > 0, F.col(f)) for f, b in bits.items()})
    table = (under.groupBy(*keys, month_col).agg(F.max_by("__x", F.col("__x.__o")).alias("__x"))
             .select(*keys, month_col, F.col("__x.__p").alias("__p")))
    none = req.withColumns({"__use": F.lit(0)} | {f: F.lit(None).cast(req.schema[f].dataType) for f in filters})
    wanted = req.select(*keys, "__m").unionByName(none.select(*keys, "__m")).distinct()
    found = _asof(wanted, table, keys, month_col)
    out = null_safe_join(req, found, [*keys, "__m"], "left")
    if filters:
        # the filtered candidates count only when some store row matches all filters of the request
        base = found.where(F.col("__use") == 0).select("__su", "__m", F.col("__ref").alias("__base"))
        out = null_safe_join(out, base, ["__su", "__m"], "left").withColumn("__ref", F.coalesce("__ref", "__base"))
    return out.select(F.col("__rid").alias(request_id), *[F.col(f"__ref.{c}").alias(c) for c in columns])


def hydrate(requests: DataFrame, reference: DataFrame, columns: Sequence[str], request_id: str = "request_id") -> DataFrame:
    """JON-08: fill only NULL request cells from the reference row."""
    ref = reference.select(request_id, *[F.col(c).alias(f"__ref_{c}") for c in columns])
    j = requests.join(ref, request_id, "left")
    fills = {c: (F.coalesce(F.col(c), F.col(f"__ref_{c}")) if c in requests.columns else F.col(f"__ref_{c}"))
             for c in columns}
    return j.withColumns(fills).drop(*[f"__ref_{c}" for c in columns])


def metadata_impute(df: DataFrame, numeric: Mapping[str, float], categorical: Mapping[str, str]) -> DataFrame:
    """NUL-04: row-wise fill of NULLs from the stored impute table (one pass, no column-level rule)."""
    fills = {c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in numeric.items() if c in df.columns}
    fills.update({c: F.coalesce(F.col(c), F.lit(v)) for c, v in categorical.items() if c in df.columns})
    return df.withColumns(fills) if fills else df


def prepare_requests(requests: DataFrame, store: DataFrame, metadata: Mapping, aliases: Mapping[str, str] | None = None,
                     reference_columns: Sequence[str] = (), filters: Sequence[str] = ()) -> DataFrame:
    """PRE-01: model rows from minimal descriptors: aliases, month split, age, canonical type,
    bands and buckets, as-of hydration, metadata imputation, model column order."""
    df = rename_aliases(requests, aliases or {})
    sp = split_year_month("saleYearMonth")
    df = df.withColumns({"saleYear": sp["year"], "saleMonth": sp["month"]})
    if "yearBuilt" in df.columns:
        df = df.withColumn("propertyAge", age_at("saleYear", "yearBuilt", min_age=0))
    if "propertyType" in df.columns:
        df = df.withColumn("propertyType", F.coalesce(canon_type("propertyType"), F.col("propertyType")))
    for name, spec in (metadata.get("bands") or {}).items():
        if spec["source"] in df.columns:
            df = df.withColumn(name, fixed_bins(spec["source"], spec["edges"], spec.get("labels"),
                                                fill_value=spec.get("fill_value")))
    if reference_columns:
        ref = asof_reference(df, store, reference_columns, filters=filters)
        df = hydrate(df, ref, reference_columns)
    imp = metadata.get("impute") or {}
    df = metadata_impute(df, imp.get("numeric", {}), imp.get("categorical", {}))
    order = list(metadata.get("columns") or [])
    return df.select("request_id", *[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in order]) if order else df


def delta_to_price(raw: Column, bases: Sequence[Column], is_delta: bool) -> Column:
    """PRE-03: for *_delta targets, first non-NULL base x (1 + raw); no base -> raw."""
    if not is_delta:
        return raw
    base = F.coalesce(*bases) if bases else F.lit(None)
    return F.when(base.isNotNull(), base * (1 + raw)).otherwise(raw)


def z_value(level: float) -> float:
    return Z_BY_LEVEL.get(round(float(level), 2), 2.58)


def with_interval(df: DataFrame, pred: str, rmse: Column, level: float = 0.95, base: Column | None = None) -> DataFrame:
    """PRE-04: prediction +- z * rmse (scaled by the base price for delta targets)."""
    half = F.lit(z_value(level)) * rmse
    if base is not None:
        half = half * base
    return df.withColumns({"lower": F.col(pred) - half, "upper": F.col(pred) + half})


# --- PRO-01 / PRO-02 model promotion --------------------------------------------------------------
def best_per_window(report: DataFrame, score_col: str = "val_r2") -> DataFrame:
    """PRO-02: best entry per forecast window (key = window, else target, else name); the
    first row wins ties (input order = ``ord``)."""
    key = F.coalesce(F.col("forecast_window"), F.col("target"), F.col("name"))
    w = Window.partitionBy(key).orderBy(F.desc_nulls_last(score_col), F.col("ord"))
    return report.where(F.col(score_col).isNotNull() & ~F.isnan(score_col)).withColumn(
        "__rk", F.row_number().over(w)).where(F.col("__rk") == 1).drop("__rk")


def select_targets(report: DataFrame, mode: str = "all", names: Sequence[str] = (),
                   score_col: str = "val_r2") -> DataFrame:
    """PRO-01: all / named / best overall / latest entry per target."""
    if mode == "named":
        return report.where(F.col("target").isin(list(names)) | F.col("name").isin(list(names)))
    if mode == "best":
        return report.orderBy(F.desc_nulls_last(score_col), "ord").limit(1)
    if mode == "latest":
        w = Window.partitionBy("target").orderBy(F.desc("timestamp"), F.desc("ord"))
        return report.withColumn("__rk", F.row_number().over(w)).where(F.col("__rk") == 1).drop("__rk")
    return report


def strength_labels(scores: DataFrame, score_col: str = "best_score") -> DataFrame:
    """PRE-05: p25/p75 of the selected scores -> strong / medium / light."""
    q = scores.select(F.percentile(F.col(score_col), F.array(F.lit(0.25), F.lit(0.75)))).scalar()
    s = F.col(score_col)
    return scores.withColumn("strength", F.when(s >= q[1], "strong").when(s >= q[0], "medium").otherwise("light"))
