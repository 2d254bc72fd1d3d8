"""Golden single-operator cases (inline frames, exact expected values)."""
import math

from pyspark.sql import functions as F

from panelforge.functions.bins import fixed_bins
from panelforge.functions.strings import extract_street
from panelforge.operators.groups import group_transform
from panelforge.operators.joins import join_step
from panelforge.operators.windows import rolling, time_range_aggregate


def _col(df, c, order="row_id"):
    return [r[c] for r in df.orderBy(order).collect()]


F2_ROWS = [(0, "A", 202301, 500), (1, "A", 202302, 550), (2, "A", 202303, 530),
           (3, "B", 202301, 400), (4, "B", 202303, 420)]
F2_SCHEMA = "row_id long, suburb string, saleYearMonth int, price int"


def test_group_transform_mean(spark):
    df = spark.createDataFrame([(0, "A", 500), (1, "A", 550), (2, "B", 400), (3, "B", 420), (4, "B", 380)],
                               "row_id long, suburb string, price int")
    out = group_transform(df, "suburb", "price", {"mean": "suburb_price_mean"})
    assert out.count() == 5
    assert _col(out, "suburb_price_mean") == [525.0, 525.0, 400.0, 400.0, 400.0]


def test_time_aggregate_include_current(spark):
    df = spark.createDataFrame(F2_ROWS, F2_SCHEMA)
    out = time_range_aggregate(df, "suburb", "saleYearMonth", "price", {"mean": "m"}, past=1, future=0,
                               include_current=True)
    assert _col(out, "m") == [500.0, 525.0, 540.0, 400.0, 420.0]


def test_time_aggregate_exclude_current(spark):
    df = spark.createDataFrame(F2_ROWS, F2_SCHEMA)
    out = time_range_aggregate(df, "suburb", "saleYearMonth", "price", {"mean": "m", "count": "n"},
                               past=1, future=0, include_current=False)
    assert _col(out, "m") == [None, 500.0, 550.0, None, None]
    assert _col(out, "n") == [None, 1, 1, None, None]


def test_rolling_mean(spark):
    df = spark.createDataFrame(F2_ROWS, F2_SCHEMA)
    out = rolling(df, "suburb", "saleYearMonth", "price", 2, {"mean": "r"}, min_periods=1)
    assert _col(out, "r") == [500.0, 525.0, 540.0, 400.0, 410.0]


def test_fixed_bins(spark):
    df = spark.createDataFrame([(0, 150.0), (1, 350.0), (2, 1200.0), (3, None)], "row_id long, landSize double")
    out = df.withColumn("b", fixed_bins("landSize", [200, 800], ["small", "medium", "large"]))
    assert _col(out, "b") == ["small", "medium", "large", "Unknown"]
    out2 = df.withColumn("b", fixed_bins("landSize", [200, 800], ["x"]))
    assert _col(out2, "b") == ["(-inf, 200.0]", "(200.0, 800.0]", "(800.0, inf]", "Unknown"]


def test_expression(spark):
    df = spark.createDataFrame([(0, 2, 1), (1, 3, 2), (2, 4, 3)], "row_id long, bed int, bath int")
    assert _col(df.withColumn("t", F.expr("bed + bath")), "t") == [3, 5, 7]


def test_left_join_keeps_rows(spark):
    left = spark.createDataFrame([(0, "A", 500), (1, "A", 550), (2, "B", 400), (3, "B", 420)],
                                 "row_id long, suburb string, price int")
    right = spark.createDataFrame([("A", 80000), ("B", 75000)], "suburb string, median_income int")
    out = join_step(left, right, on="suburb", how="left")
    assert _col(out, "median_income") == [80000, 80000, 75000, 75000]


def test_null_keys_match(spark):
    left = spark.createDataFrame([(0, None), (1, "A")], "row_id long, k string")
    right = spark.createDataFrame([(None, 1), ("A", 2)], "k string, v int")
    out = join_step(left, right, on="k", how="left")
    assert _col(out, "v") == [1, 2]


def test_street_extraction(spark):
    cases = [("112 BRUNSWICK ROAD", "Brunswick Road"), ("10/6-10 Creek Road", "Creek Road"),
             ("105/435-439 Whitehorse Road", "Whitehorse Road"), ("G01/569 Whitehorse Road", "Whitehorse Road"),
             ("UNIT 4/14-16 Mcghee Avenue", "Mcghee Avenue"), (None, "Unknown"),
             ("3 o'brien st-john 2nd", "O'Brien St-John 2Nd")]
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(cases)], "row_id long, a string")
    assert _col(df.withColumn("s", extract_street("a")), "s") == [e for _, e in cases]


def test_expr_then_aggregate(spark):
    df = spark.createDataFrame([(0, 100000, 200, "Richmond"), (1, 120000, 250, "Richmond"), (2, 130000, 300, "Carlton")],
                               "row_id long, salePrice int, landSizeM2 int, suburb string")
    df = df.withColumn("ppsqm", F.expr("try_divide(salePrice, nullif(landSizeM2, 0))"))
    out = group_transform(df, "suburb", "ppsqm", {"mean": "m"})
    assert math.isclose(_col(out, "m")[0], 490.0)


def test_leave_one_out_min_max_with_ties_and_nulls(spark):
    rows = [(0, "A", 202301, 5.0), (1, "A", 202301, 5.0), (2, "A", 202301, 9.0), (3, "A", 202302, None),
            (4, "B", 202301, 7.0), (5, "B", 202302, 3.0)]
    df = spark.createDataFrame(rows, F2_SCHEMA.replace("price int", "price double"))
    out = time_range_aggregate(df, "suburb", "saleYearMonth", "price", {"min": "mn", "max": "mx"},
                               past=1, future=0, include_current=False)
    assert _col(out, "mn") == [5.0, 5.0, 5.0, 5.0, None, 7.0]
    assert _col(out, "mx") == [9.0, 9.0, 5.0, 9.0, None, 7.0]
