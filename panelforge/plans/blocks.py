"""UDF-3 / UDF-4: derive specs written as named blocks.

A spec maps block names to settings. Every kind of block is registered with the columns it reads and writes, and
blocks run when what they read is there: a block comes after all blocks that write one of its inputs, otherwise in
the order of the spec; the yearly table and the buckets come last. A block called otherwise is taken by its ``fn``, or
as a group aggregate when it has ``group_by``, ``target``, ``aggregate`` and ``output``. Blocks that are disabled,
unknown or lack an input column are left out with a warning.
"""
from __future__ import annotations

import warnings
from dataclasses import dataclass
from typing import Any, Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions import bins, dates, strings
from panelforge.operators import groups, insights, joins, panel
from panelforge.operators.ratios import price_per_area, ratio_feature
from panelforge.sources.files import Registry

Spec = Mapping[str, Any]


@dataclass(frozen=True)
class Block:
    """What a kind of block does to a table, and which columns it reads and writes under a spec."""

    run: Callable[[DataFrame, Spec, Registry], DataFrame]
    reads: Callable[[Spec], Sequence[str]]
    writes: Callable[[Spec], Sequence[str]]


_RATIO_OPTIONS = ("clip_min", "clip_max", "numerator_offset", "denominator_offset", "denominator_min", "drop_na")


def _options(spec: Spec, names: Sequence[str]) -> dict[str, Any]:
    return {k: spec[k] for k in names if spec.get(k) is not None}


def _street(df: DataFrame, spec: Spec, _: Registry) -> DataFrame:
    unknown = (spec.get("config") or {}).get("unknown_value", "Unknown")
    out = df.withColumn(spec["output"], strings.extract_street(spec["source"], unknown))
    return out.where(F.col(spec["output"]) != unknown) if spec.get("drop_unknown") else out


def _group_aggregate(df: DataFrame, spec: Spec, _: Registry) -> DataFrame:
    return groups.aggregate_join_back(df, spec["group_by"], spec["target"], spec["aggregate"], spec["output"])


def _prefix(df: DataFrame, spec: Spec, _: Registry) -> DataFrame:
    if spec["output"] in df.columns:
        return df
    return df.withColumn(spec["output"], strings.prefix(spec["source"], int(spec["length"])))


def _price_factor(df: DataFrame, spec: Spec, _: Registry) -> DataFrame:
    return insights.factor_filter(df, spec["numerator"], spec["denominator"], spec["output"], float(spec.get("min_value", 0.01)))


def _category(df: DataFrame, spec: Spec, _: Registry) -> DataFrame:
    return df.withColumn(spec.get("output", "propertyCategory"), strings.property_category(
        spec.get("property_type_col", "propertyType"), spec.get("land_use_col", "landUse"), spec.get("unknown_value", "Other")))


def _cyclical(df: DataFrame, spec: Spec, _: Registry) -> DataFrame:
    sin, cos = _cyclical_names(spec)
    parts = dates.cyclical(spec.get("month_col", "saleMonth"), int(spec.get("period", 12)))
    return df.withColumns({sin: parts["sin"], cos: parts["cos"]})


def _cyclical_names(spec: Spec) -> list[str]:
    name = spec.get("out_prefix", spec.get("month_col", "saleMonth"))
    return [f"{name}_sin", f"{name}_cos"]


def _age(df: DataFrame, spec: Spec, _: Registry) -> DataFrame:
    return df.withColumn(spec.get("output", "propertyAge"), dates.age_at(
        spec.get("sale_year_col", "saleYear"), spec.get("year_built_col", "yearBuilt"), spec.get("min_age"), spec.get("max_age")))


def _ratio(df: DataFrame, spec: Spec, _: Registry) -> DataFrame:
    return ratio_feature(df, spec["numerator"], spec["denominator"], spec["output"], **_options(spec, _RATIO_OPTIONS))


def _per_area(df: DataFrame, spec: Spec, _: Registry) -> DataFrame:
    return price_per_area(df, spec["area_col"], spec["output"], spec.get("price_col", "salePrice"), **_options(spec, _RATIO_OPTIONS))


def _month_index(df: DataFrame, spec: Spec, _: Registry) -> DataFrame:
    return panel.month_index(df, spec.get("month_col", "saleYearMonth"), spec.get("output", "month_id"), int(spec.get("offset", 0)))


def _rollups(df: DataFrame, spec: Spec, _: Registry) -> DataFrame:
    return panel.suburb_rollups(df, **_options(spec, ("suburb_col", "month_col", "price_col", "windows", "prefix", "type_col",
                                                      "type_map", "type_default", "type_tags")))


def _rollup_names(spec: Spec) -> list[str]:
    prefix, windows = spec.get("prefix", "suburb"), spec.get("windows", (3, 6, 12))
    return ([f"{prefix}_price_median_current", f"{prefix}_delta_3m", f"{prefix}_delta_12m"]
            + [f"{prefix}_{kind}_{w}m" for w in windows for kind in ("price_median", "txn_count", "volatility")])


def _relative(df: DataFrame, spec: Spec, _: Registry) -> DataFrame:
    options = _options(spec, ("price_col", "suburb_col", "month_col", "suburb_median_col", "region_col", "street_col", "min_samples"))
    return panel.relative_pricing(df, prefix=spec.get("output_prefix", "rel"), **options)


def _relative_names(spec: Spec) -> list[str]:
    prefix = spec.get("output_prefix", "rel")
    return [f"{prefix}_price_vs_suburb_median", f"{prefix}_price_vs_region_median", f"{prefix}_street_effect"]


def _age_bands(df: DataFrame, spec: Spec, _: Registry) -> DataFrame:
    return df.withColumn(spec.get("output", "propertyAgeBand"), bins.age_bands(
        spec.get("age_col", "propertyAge"), spec.get("bands", (5, 20)), spec.get("labels")))


def _date_parts(df: DataFrame, spec: Spec, _: Registry) -> DataFrame:
    source = F.col("saleDate")
    if isinstance(df.schema["saleDate"].dataType, T.StringType):
        source = dates.parse_date("saleDate")
    parts = dates.date_parts(source)
    return df.withColumns({"saleYear": parts["year"], "saleMonth": parts["month"], "saleYearMonth": parts["year_month"]})


def _yearly(df: DataFrame, spec: Spec, data: Registry) -> DataFrame:
    table = data.resolve(spec.get("path") or spec["macro_path"])
    return joins.join_on_year(df, table, spec.get("sale_year_col", "saleYear"))


def _buckets(df: DataFrame, spec: Spec, _: Registry) -> DataFrame:
    found = {}
    for name, own in spec.items():
        if not isinstance(own, Mapping) or not own.get("enabled", True) or own.get("source") not in df.columns:
            continue
        output, fill = own.get("output", f"{name}_bucket"), own.get("fill_value", "Unknown")
        if own.get("mapping"):
            found[output] = bins.mapping_bins(F.col(own["source"]).cast("string"), own["mapping"], own.get("default", fill))
        elif own.get("bins"):
            found[output] = bins.fixed_bins(own["source"], own["bins"], own.get("labels"), bool(own.get("right", True)),
                                            bool(own.get("include_lowest", True)), fill, bool(own.get("extend_lower", True)),
                                            bool(own.get("extend_upper", True)))
    return df.withColumns(found) if found else df


_SALES = lambda spec: [spec.get("suburb_col", "suburb"), spec.get("month_col", "saleYearMonth"), spec.get("price_col", "salePrice")]
_OUTPUT = lambda spec: [spec["output"]]

GROUP_AGGREGATE = Block(_group_aggregate, lambda s: [*s["group_by"], s["target"]], _OUTPUT)
BLOCKS: dict[str, Block] = {
    "street": Block(_street, lambda s: [s["source"]], _OUTPUT),
    "postcode_prefix": Block(_prefix, lambda s: [s["source"]], _OUTPUT),
    "price_factor": Block(_price_factor, lambda s: [s["numerator"], s["denominator"]], _OUTPUT),
    "property_category": Block(_category, lambda s: [s.get("property_type_col", "propertyType"), s.get("land_use_col", "landUse")],
                               lambda s: [s.get("output", "propertyCategory")]),
    "month_cyclical": Block(_cyclical, lambda s: [s.get("month_col", "saleMonth")], _cyclical_names),
    "property_age": Block(_age, lambda s: [s.get("sale_year_col", "saleYear"), s.get("year_built_col", "yearBuilt")],
                          lambda s: [s.get("output", "propertyAge")]),
    "ratio": Block(_ratio, lambda s: [s["numerator"], s["denominator"]], _OUTPUT),
    "price_per_area": Block(_per_area, lambda s: [s.get("price_col", "salePrice"), s["area_col"]], _OUTPUT),
    "month_index": Block(_month_index, lambda s: [s.get("month_col", "saleYearMonth")], lambda s: [s.get("output", "month_id")]),
    "suburb_time_aggregates": Block(_rollups, _SALES, _rollup_names),
    "relative_pricing": Block(_relative, lambda s: [*_SALES(s), s.get("suburb_median_col", "suburb_price_median_current")], _relative_names),
    "age_bands": Block(_age_bands, lambda s: [s.get("age_col", "propertyAge")], lambda s: [s.get("output", "propertyAgeBand")]),
    "date_parts": Block(_date_parts, lambda s: ["saleDate"], lambda s: ["saleYear", "saleMonth", "saleYearMonth"]),
}
#: Names that ``fn`` may take.
FUNCTIONS: dict[str, Block] = {"ratio": BLOCKS["ratio"], "price_per_area": BLOCKS["price_per_area"]}
#: Blocks that come last, in this order.
LAST: dict[str, Block] = {
    "macro_join": Block(_yearly, lambda s: [s.get("sale_year_col", "saleYear")], lambda s: []),
    "buckets": Block(_buckets, lambda s: [], lambda s: [b.get("output", f"{n}_bucket") for n, b in s.items() if isinstance(b, Mapping)]),
}
#: Parts of a spec that describe the segment table instead of a block.
SEGMENT_PARTS = ("grouping", "aggregations", "future_targets")


def _block_of(name: str, spec: Spec) -> Block | None:
    if name in BLOCKS and name == "street":
        return BLOCKS[name]
    if all(k in spec for k in ("group_by", "target", "aggregate", "output")):
        return GROUP_AGGREGATE
    return BLOCKS.get(name) or FUNCTIONS.get(str(spec.get("fn") or "").strip())


def ordered_blocks(config: Mapping[str, Spec]) -> list[tuple[str, Block, Spec]]:
    """The enabled blocks of a spec in running order; a circle of inputs and outputs raises."""
    found = []
    for name, spec in config.items():
        if name in SEGMENT_PARTS or name in LAST or not isinstance(spec, Mapping) or not spec.get("enabled", True):
            continue
        block = _block_of(name, spec)
        if block is None:
            warnings.warn(f"block {name!r} is left out: unknown name or fn {spec.get('fn')!r}", stacklevel=3)
            continue
        try:
            found.append((name, block, spec, set(block.reads(spec)), set(block.writes(spec))))
        except KeyError as missing:
            warnings.warn(f"block {name!r} is left out: setting {missing} is missing", stacklevel=3)
    out, waiting = [], found
    while waiting:
        # a block may also rewrite one of its own inputs; it waits for the others that write them
        ready = next((b for b in waiting if not any(b[3] & o[4] for o in waiting if o is not b)), None)
        if ready is None:
            raise ValueError(f"blocks need each other's outputs: {[b[0] for b in waiting]}")
        out.append(ready[:3])
        waiting = [b for b in waiting if b is not ready]
    return out + [(n, b, config[n]) for n, b in LAST.items() if config.get(n) and config[n].get("enabled", True)]


def run_blocks(df: DataFrame, config: Mapping[str, Spec], datasets: Mapping[str, Any] | None = None) -> DataFrame:
    """Apply a spec of named blocks; date parts come first where ``saleDate`` exists."""
    data = Registry(df.sparkSession, datasets)
    if "saleDate" in df.columns and "date_parts" not in config:
        config = {"date_parts": {}, **config}
    for name, block, spec in ordered_blocks(config):
        missing = [c for c in block.reads(spec) if c not in df.columns]
        if missing:
            warnings.warn(f"block {name!r} is left out: no column(s) {missing}", stacklevel=2)
            continue
        df = block.run(df, spec, data)
    return df


def segment_table(df: DataFrame, config: Mapping[str, Any], row_id: str = "row_id") -> DataFrame | None:
    """The segment table that ``grouping``, ``aggregations`` and ``future_targets`` describe; None without grouping."""
    grouping = config.get("grouping") or {}
    if not grouping or not grouping.get("enabled", True):
        return None
    values = config.get("aggregations") or {}
    metrics = values.get("metrics", []) if values.get("enabled", True) else []
    return panel.build_segments(df, grouping.get("keys", []), grouping.get("month_col", "saleYearMonth"), metrics,
                                values.get("carry"), int(grouping.get("min_rows", 0)), int(grouping.get("min_months", 0)),
                                config.get("future_targets") or [], row_id)
