"""Specs of named blocks: order by inputs, fn names, warnings, segments."""
import datetime

import pytest

from panelforge.plans import blocks


def test_blocks_run_when_their_inputs_are_there():
    spec = {"relative_pricing": {}, "age_bands": {}, "r": {"fn": "ratio", "numerator": "vsMean", "denominator": "propertyAge", "output": "q"},
            "suburb_time_aggregates": {}, "property_age": {}, "g": {"group_by": ["suburb"], "target": "salePrice", "aggregate": "mean", "output": "vsMean"},
            "date_parts": {}, "buckets": {"b": {"source": "q", "bins": [1]}}, "macro_join": {"path": "p"}, "off": {"enabled": False}}
    names = [n for n, _, _ in blocks.ordered_blocks(spec)]
    assert names[-2:] == ["macro_join", "buckets"] and "off" not in names
    for first, then in (("date_parts", "property_age"), ("property_age", "age_bands"), ("property_age", "r"), ("g", "r"),
                        ("date_parts", "suburb_time_aggregates"), ("suburb_time_aggregates", "relative_pricing")):
        assert names.index(first) < names.index(then)


def test_circles_raise_and_unknown_blocks_warn():
    circle = {"a": {"fn": "ratio", "numerator": "y", "denominator": "x", "output": "z"},
              "b": {"fn": "ratio", "numerator": "z", "denominator": "x", "output": "y"}}
    with pytest.raises(ValueError, match="need each other"):
        blocks.ordered_blocks(circle)
    with pytest.warns(UserWarning, match="unknown name"):
        assert blocks.ordered_blocks({"x": {"fn": "nothing"}}) == []
    with pytest.warns(UserWarning, match="setting 'output'"):
        assert blocks.ordered_blocks({"ratio": {"numerator": "a", "denominator": "b"}}) == []


def test_ratio_street_and_missing_columns(spark):
    rows = [(1, datetime.date(2023, 1, 5), "1/2 Oak Road", 100.0, 4.0, 2000), (2, datetime.date(2023, 2, 5), None, 50.0, 0.0, 1990),
            (3, None, "9 Elm Street", 10.0, 5.0, None)]
    df = spark.createDataFrame(rows, "row_id long, saleDate date, address string, salePrice double, area double, yearBuilt int")
    spec = {"r": {"fn": "ratio", "numerator": "salePrice", "denominator": "area", "output": "r", "drop_na": True},
            "street": {"source": "address", "output": "street", "drop_unknown": True}, "property_age": {},
            "price_per_area": {"area_col": "area", "output": "ppa", "clip_max": 20},
            "postcode_prefix": {"source": "postcode", "output": "pp", "length": 2}}
    with pytest.warns(UserWarning, match="postcode_prefix.*no column"):
        out = blocks.run_blocks(df, spec)
    assert [tuple(r) for r in out.select("row_id", "r", "street", "propertyAge", "ppa", "saleYearMonth").orderBy("row_id").collect()] == [
        (1, 25.0, "Oak Road", 23.0, None, 202301), (3, 2.0, "Elm Street", None, 2.0, None)]


def test_segments_of_a_spec(spark):
    rows = [(i, 202301 + i, "A", 100.0 + 2 * i, 101.0 + 2 * i) for i in range(4)]
    df = spark.createDataFrame(rows, "row_id long, saleYearMonth int, suburb string, current_price_median double, salePrice double")
    config = {"grouping": {"keys": ["suburb"]},
              "aggregations": {"metrics": [{"name": "current_price_median", "source": "current_price_median", "agg": "mean"}]},
              "future_targets": [{"name": "price_future_1m", "source": "salePrice", "agg": "mean", "horizon": 1, "window": 1, "min_periods": 1,
                                  "base_column": "current_price_median", "derived": [{"type": "delta"}, {"type": "diff"}],
                                  "smooth": {"window": 2, "min_periods": 1, "derived": [{"type": "delta"}]}}]}
    seg = blocks.segment_table(df, config).orderBy("saleYearMonth").collect()
    assert [r["price_future_1m"] for r in seg] == [103.0, 105.0, 107.0, None]
    assert [r["price_future_1m_diff"] for r in seg] == [3.0, 3.0, 3.0, None]
    assert {"price_future_1m_delta", "price_future_1m_smooth", "price_future_1m_smooth_delta"} <= set(seg[0].asDict())
    assert blocks.segment_table(df, {"grouping": {"enabled": False, "keys": ["suburb"]}}) is None
