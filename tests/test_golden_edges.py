"""Golden cases for rewritten columns, large values, NULL filters, whole-number medians and mixed headers."""
import datetime

import pytest
from pyspark.sql import functions as F

from panelforge.functions.dates import parse_date
from panelforge.operators.cleaning import impute_median
from panelforge.operators.lookup import asof_reference
from panelforge.operators.windows import time_range_aggregate
from panelforge.plans.derive import run_derive
from panelforge.sources.files import read_csv_union


def test_rewritten_column_feeds_later_statistics(spark):
    day = datetime.datetime
    df = spark.createDataFrame([(day(2020, 1, 5), 199912, 100.0), (day(2020, 2, 5), 199912, 200.0)],
                               "saleDate timestamp, saleYearMonth int, price double")
    out = run_derive(df, [{"type": "simple", "method": "date_parts", "source": "saleDate"},
                          {"type": "aggregate", "group_by": ["saleYearMonth"], "target": "price", "outputs": {"mean": "m"}}])
    assert sorted((r.saleYearMonth, r.m) for r in out.collect()) == [(202001, 100.0), (202002, 200.0)]


@pytest.mark.parametrize("current,expected", [(True, [1.29099] * 4), (False, [1.0, 1.0, 1.52753, 1.52753])])
def test_std_of_large_values(spark, current, expected):
    df = spark.createDataFrame([("a", 202001, 1e9 + k) for k in range(4)], "g string, m int, x double")
    out = time_range_aggregate(df, ["g"], "m", "x", {"std": "s"}, 3, 0, current).collect()
    assert sorted(r.s for r in out) == pytest.approx(expected, abs=1e-4)


def test_asof_skips_null_filter(spark):
    store = spark.createDataFrame([("A", 202001, "x", "u", 10.0, 1), ("A", 202001, "y", "u", 20.0, 2)],
                                  "suburb string, saleYearMonth int, street string, kind string, v double, row_id long")
    req = spark.createDataFrame([(1, "a", 202002, "x", None), (2, "a", 202002, None, None), (3, "a", 202002, "z", "u")],
                                "request_id int, suburb string, saleYearMonth int, street string, kind string")
    out = {r.request_id: r.v for r in asof_reference(req, store, ["v"], filters=["street", "kind"]).collect()}
    assert out == {1: 10.0, 2: 20.0, 3: 20.0}


def test_whole_number_median_keeps_its_half(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "x int")
    assert sorted(r.x for r in impute_median(df).collect()) == [1.0, 2.0, 2.5, 3.0, 4.0]


def test_csv_pattern_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x,z\n3,4,5\n")
    out = read_csv_union(spark, [f"{tmp_path}/*.csv"]).select("x", "y", "z").collect()
    assert sorted(map(tuple, out)) == [("1", "2", None), ("4", "3", "5")]


def test_more_date_formats(spark):
    df = spark.createDataFrame([("2021-01-04T10:00:00",), ("04-Jan-2021",), ("4 January 2021",), ("Jan 4, 2021",), ("no",)], "s string")
    out = [r.d for r in df.select(F.to_date(parse_date("s")).alias("d")).collect()]
    assert out == [datetime.date(2021, 1, 4)] * 4 + [None]
