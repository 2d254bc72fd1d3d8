"""Reporting queries behind the dashboards: filters, profiles, growth, shares, top-k, samples.

Only the query logic lives here (the UI is not rebuilt). Every operator is a grouped
aggregate or a window over an already-aggregated table.
"""
from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.bins import equal_width_bin
from panelforge.functions.nulls import safe_div
from panelforge.functions.strings import title_case

# Dashboard driver themes by feature name, and the fallback theme.
FEATURE_THEMES = {
    "bed": "Bedrooms",
    "bath": "Bathrooms",
    "car": "Car Spaces",
    "landSizeM2": "Land Size",
    "floorSizeM2": "Floor Size",
    "propertyType": "Property Type",
    "propertyAge": "Age / Vintage",
    "propertyAgeBand": "Age / Vintage",
    "street": "Street Effect",
    "suburb_price_median_current": "Market Context",
    "suburb_price_median_3m": "Market Context",
    "suburb_price_median_6m": "Market Context",
    "suburb_price_median_12m": "Market Context",
    "suburb_txn_count_3m": "Liquidity",
    "suburb_txn_count_6m": "Liquidity",
    "suburb_txn_count_12m": "Liquidity",
    "suburb_delta_3m": "Momentum",
    "suburb_delta_12m": "Momentum",
    "rel_price_vs_suburb_median": "Relative Pricing",
}
DEFAULT_THEME = "Other / Engineered"
# Display labels of the melted price metrics.
METRIC_LABELS = {"salePrice_mean": "Average Sale Price", "salePrice_median": "Median Sale Price"}


# --- filters (FLT-06..10) -----------------------------------------------------------------------
def factor_filter(df: DataFrame, num: str, den: str, output: str, min_value: float = 0.01) -> DataFrame:
    """FLT-06: output = num/den; keep finite values > min_value."""
    out = df.withColumn(output, safe_div(num, den))
    return out.where(F.col(output).isNotNull() & (F.col(output) > float(min_value)))


def _year_range(df: DataFrame, year_col: str | None, year_range, date_col: str | None) -> DataFrame:
    if not year_range:
        return df
    if date_col:   # the same range on the raw date: a predicate Parquet can push down
        lo = F.lit(f"{int(year_range[0]):04d}-01-01").cast("timestamp_ntz")
        hi = F.lit(f"{int(year_range[1]) + 1:04d}-01-01").cast("timestamp_ntz")
        return df.where((F.col(date_col) >= lo) & (F.col(date_col) < hi))
    if year_col:
        return df.where(F.col(year_col).between(year_range[0], year_range[1]))
    return df


def equality_filters(df: DataFrame, equals: Mapping[str, str], year_col: str | None = None,
                     year_range: tuple[int, int] | None = None, wildcard: str = "All",
                     date_col: str | None = None) -> DataFrame:
    """FLT-07: column == value unless value is the wildcard; inclusive year range (on the year
    column, or as a pushed-down range on ``date_col``)."""
    for c, v in equals.items():
        if v != wildcard:
            df = df.where(F.col(c) == F.lit(v))
    return _year_range(df, year_col, year_range, date_col)


def membership_filters(df: DataFrame, members: Mapping[str, Sequence], year_col: str | None = None,
                       year_range: tuple[int, int] | None = None, date_col: str | None = None) -> DataFrame:
    """FLT-08: column in list (an empty list keeps all); inclusive year range."""
    for c, vals in members.items():
        if vals:
            df = df.where(F.col(c).isin(list(vals)))
    return _year_range(df, year_col, year_range, date_col)


def drop_unknown(df: DataFrame, column: str, unknown: str = "Unknown") -> DataFrame:
    """FLT-10: drop rows whose value is the unknown marker."""
    return df.where(~F.col(column).eqNullSafe(F.lit(unknown)))


def clean_distinct(df: DataFrame, column: str, no_digits: bool = False, title: bool = True) -> DataFrame:
    """STR-14: trimmed, non-empty, not 'unknown' (any case), optionally digit-free, title-cased
    distinct values, sorted."""
    v = F.trim(F.col(column).cast("string"))
    out = df.select(v.alias(column)).where((F.col(column) != "") & (F.lower(F.col(column)) != "unknown"))
    if no_digits:
        out = out.where(~F.col(column).rlike(r"\d"))
    if title:
        out = out.select(title_case(column).alias(column))
    return out.distinct().orderBy(column)


# --- BIN-06 ----------------------------------------------------------------------------------------
def binned_means(df: DataFrame, feature: str, target: str, by: Column, bins: int = 20) -> DataFrame:
    """BIN-06: equal-width bins of a driver (<= 20) and mean target per bin and year."""
    b = equal_width_bin(df.where(F.col(feature).isNotNull()), feature, bins, "bin")
    return b.groupBy("bin", by).agg(F.avg(target).alias("mean_price"), F.count(F.lit(1)).alias("n"))


# --- profiles (AGG-17/18/26/27, AGG-23) ------------------------------------------------------------
def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """AGG-17: count, mean, std, min, quartiles (interpolated), max per column, one pass."""
    from panelforge.operators.quantiles import quantiles_of
    qs = quantiles_of(df, {c: [0.25, 0.5, 0.75] for c in columns})
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.array(*[F.lit(v).cast("double") for v in qs[c]]).alias(f"q{i}"),
                 F.max(x).alias(f"hi{i}")]
    row = df.agg(*aggs)
    stack = ", ".join(f"'{c}', n{i}, m{i}, s{i}, lo{i}, q{i}[0], q{i}[1], q{i}[2], hi{i}" for i, c in enumerate(columns))
    return row.selectExpr(f"stack({len(columns)}, {stack}) AS (column, count, mean, std, min, p25, p50, p75, max)")


def value_counts(df: DataFrame, columns: Sequence[str], ordered: bool = True) -> DataFrame:
    """AGG-18: (column, value, count) for string columns, counts descending."""
    long = df.select(*[F.col(c).cast("string") for c in columns]).unpivot([], list(columns), "column", "value")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy("column", F.desc("count"), "value") if ordered else counts


def most_frequent_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) with the most frequent non-NULL value of each column that has one (ties -> smallest).

    Values are counted with map-side combine and the best picked by a partial aggregate: no task holds them all.
    """
    counts = value_counts(df, columns, ordered=False).where(F.col("value").isNotNull())
    return counts.groupBy("column").agg(F.min_by("value", F.struct(-F.col("count"), F.col("value"))).alias("value"))


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """AGG-26: the most frequent value (ties -> smallest)."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
    return counts.agg(F.min_by(F.col(column), F.struct(-F.col("__n"), F.col(column))).alias(f"{column}_mode"))


def bounds(df: DataFrame, column: str) -> DataFrame:
    """AGG-27: min and max of a column."""
    return df.agg(F.min(column).alias(f"{column}_min"), F.max(column).alias(f"{column}_max"))


def latest_month(df: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """AGG-23: latest YYYYMM over the candidate columns that exist."""
    cols = [F.max(F.col(c).try_cast("int")) for c in candidates if c in df.columns]
    return df.agg(F.greatest(*cols).alias("latest_year_month") if len(cols) > 1 else cols[0].alias("latest_year_month"))


# --- growth and shares (AGG-19/20/21/22, WIN-13/14) ------------------------------------------------
def type_period_stats(df: DataFrame, type_col: str, period_col: str, price_col: str) -> DataFrame:
    """AGG-19: median, transaction count and std per type x period."""
    from panelforge.operators.groups import grouped
    return grouped(df, [type_col, period_col], [("median", price_col, "median_price"), ("std", price_col, "volatility")],
                   [F.count(F.lit(1)).alias("txn_count")])


def yoy_growth(stats: DataFrame, type_col: str, period_col: str, lag: int = 12) -> DataFrame:
    """WIN-13: growth against the median 12 observed periods earlier (per type)."""
    w = Window.partitionBy(type_col).orderBy(period_col)
    ago = F.lag("median_price", lag).over(w)
    return stats.withColumn("median_price_12m_ago", ago).withColumn(
        "yoy_growth", safe_div(F.col("median_price") - F.col("median_price_12m_ago"), "median_price_12m_ago"))


def yoy_summary(growth: DataFrame, type_col: str, period_col: str) -> DataFrame:
    """AGG-20: latest growth and price, summed counts over rows with growth, sorted by growth."""
    g = growth.where(F.col("yoy_growth").isNotNull())
    return (g.groupBy(type_col).agg(F.max_by("yoy_growth", period_col).alias("latest_growth"),
                                    F.max_by("median_price", period_col).alias("latest_price"),
                                    F.sum("txn_count").alias("txn_last12m"))
             .orderBy(F.desc("latest_growth")))


def volume_share(df: DataFrame, group_col: str, type_col: str) -> DataFrame:
    """WIN-14: transaction count per group x type and its share of the group total."""
    d = df.groupBy(group_col, type_col).agg(F.count(F.lit(1)).alias("txn_count"))
    return d.withColumn("volume_share", F.col("txn_count") / F.sum("txn_count").over(Window.partitionBy(group_col)))


def quarterly_stats(df: DataFrame, quarter_col: str, price_col: str) -> DataFrame:
    """AGG-21: mean and median per quarter."""
    from panelforge.operators.groups import grouped
    return grouped(df, [quarter_col], [("mean", price_col, "salePrice_mean"), ("median", price_col, "salePrice_median")])


def melt(df: DataFrame, id_vars: Sequence[str], value_vars: Sequence[str], var_name: str = "variable",
         value_name: str = "value", labels: Mapping[str, str] | None = None) -> DataFrame:
    """SET-05: wide -> long, with an optional label map on the variable names."""
    out = df.unpivot(list(id_vars), list(value_vars), var_name, value_name)
    if labels:
        m = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k), F.lit(v))])
        out = out.withColumn(var_name, F.coalesce(F.try_element_at(m, F.col(var_name)), F.col(var_name)))
    return out


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """TOP-*: first k rows by an explicit total order (ties broken by the caller's keys)."""
    return df.orderBy(*order).limit(k)


def seeded_sample(df: DataFrame, n: int, seed: int, key: str = "row_id") -> DataFrame:
    """SMP-01: deterministic sample of n rows: smallest hash(key, seed) (a top-k, not a scan-all sort)."""
    return df.withColumn("__h", F.xxhash64(F.col(key), F.lit(seed))).orderBy("__h", key).limit(n).drop("__h")


def theme_scores(scores: DataFrame, themes: Mapping[str, str] = FEATURE_THEMES, default: str = DEFAULT_THEME,
                 exclude: Sequence[str] = ()) -> DataFrame:
    """STR-17: driver theme per feature (default theme), excluded features removed, by score."""
    m = F.create_map(*[x for k, v in themes.items() for x in (F.lit(k), F.lit(v))])
    out = scores.withColumn("driver_theme", F.coalesce(F.try_element_at(m, F.col("feature")), F.lit(default)))
    if exclude:
        out = out.where(~F.col("feature").isin(list(exclude)))
    return out


def top_drivers(scores: DataFrame, top_n: int = 10, theme: str | None = None) -> DataFrame:
    """TOP-04: top-N drivers by best score, optional theme filter."""
    s = scores if not theme else scores.where(F.col("driver_theme") == theme)
    return s.orderBy(F.desc("best_score"), "feature").limit(top_n)


def ordered_positions(df: DataFrame, keys: Sequence[str], order: Sequence[Column], output: str = "pos") -> DataFrame:
    """SRT-01: 1-based row position within each group in a multi-key order, whatever the keys' types.

    Rows are range-sliced by (group, order) and numbered inside their slice; counts of the slices before are added.
    """
    from panelforge.operators.slices import with_positions
    return with_positions(df, list(keys), order, output).withColumn(output, F.col(output) + 1)
