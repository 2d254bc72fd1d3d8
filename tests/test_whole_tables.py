"""Join, set and as-of queries that read whole tables: every segment, group, region and store row counts."""
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from panelforge.plans.views import sales

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


def test_union_and_missing_months_read_every_segment_and_group(spark):
    s = sales(spark, SF)
    union = E.queries()["set_01_union_by_name_all_segments"](spark, SF)
    assert union.count() == s.count() and union.select("part").distinct().count() == 5
    missing = E.queries()["set_03_jon_10_expected_minus_seen_months_all_groups"](spark, SF)
    keys = ["suburb", "propertyType", "street"]
    o = F.year("saleDate") * 12 + F.month("saleDate")
    want = s.groupBy(*keys).agg((F.max(o) - F.min(o) + 1 - F.count_distinct(o)).alias("n")).where("n > 0")
    got = missing.groupBy(*keys).agg(F.count("*").alias("n"))
    assert got.count() > 1 and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_asof_store_holds_every_street_and_join_every_region(spark):
    s = sales(spark, SF)
    ref = E.queries()["jon_07_asof_reference_lookup_all_sales"](spark, SF)
    assert ref.count() == s.count()   # each sale finds at least itself
    hydrated = E.queries()["jon_08_hydrate_null_cells_all_sales"](spark, SF)
    assert hydrated.where("yearBuilt is null").count() == 0
    joined = E.queries()["jon_01_02_outer_join_suffixes_validation_all_rows"](spark, SF)
    row = joined.agg(F.sum("n"), F.count("region_name")).first()
    assert tuple(row) == (s.count(), 5)


def test_elimination_takes_all_rows(spark, monkeypatch):
    from panelforge.plans import q_select
    seen = {}

    def capture(df, *args, **kwargs):
        seen.update(kwargs["elimination"], rows=df.count())
        raise InterruptedError

    monkeypatch.setattr(q_select.S, "select_features", capture)
    with pytest.raises(InterruptedError):
        E.queries()["fse_01_08_smp_01_selection_with_elimination"](spark, SF)
    assert not seen.get("sample_rows") and seen["rows"] == q_select.lines(spark, SF).count()


def test_asof_lattice_keeps_repeated_requests_and_null_filters(spark):
    from panelforge.operators.lookup import asof_reference
    store = spark.createDataFrame([(1, "A", "x", "p", 202001, 1.0), (2, "a", "x", "q", 202003, 2.0), (3, "A", "y", None, 202002, 3.0),
                                   (4, "B", "x", "p", 202001, 4.0), (5, "A", "x", "p", 202001, 5.0)],
                                  "row_id int, suburb string, kind string, street string, saleYearMonth int, v double")
    req = spark.createDataFrame([(1, " a ", "x", "p", 202002), (1, " a ", "x", "p", 202002), (2, "A", "x", None, 202002), (3, "A", None, None, 202002),
                                 (4, "A", "z", "p", 201901), (5, "C", "x", "p", 202002), (6, "A", None, "q", 201901), (7, "A", "y", None, 202001)],
                                "request_id int, suburb string, kind string, street string, saleYearMonth int")
    got = asof_reference(req, store, ["v"], filters=["kind", "street"])
    assert sorted(((r["request_id"], r["v"]) for r in got.collect()), key=str) == [
        (1, 5.0), (1, 5.0), (2, 5.0), (3, 3.0), (4, 2.0), (5, None), (6, 2.0), (7, 3.0)]
    assert sorted(r["v"] for r in asof_reference(req.where("request_id in (1, 4)"), store, ["v"]).collect()) == [2.0, 3.0, 3.0]


def test_failing_cardinality_raises(spark):
    from panelforge.operators.joins import join_step
    one = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, x string")
    many = spark.createDataFrame([(1, 1.0), (1, 2.0), (None, 3.0)], "k int, y double")
    assert join_step(one, many, "k", validate="one_to_many").count() == 4
    for left, right, rule, side in ((one, many, "one_to_one", "right"), (many, one, "one_to_one", "left"), (one, many, "many_to_one", "right"),
                                    (many, one, "one_to_many", "left")):
        with pytest.raises(ValueError, match=f"{rule}.*{side} keys are not unique"):
            join_step(left, right, "k", validate=rule)
    twice = spark.createDataFrame([(None, 1.0), (None, 2.0)], "k int, y double")
    with pytest.raises(ValueError, match="right keys"):      # NULL is a key like any other
        join_step(one, twice, "k", validate="one_to_one")


def test_modes_by_counts(spark):
    from panelforge.operators.insights import most_frequent, most_frequent_values
    from panelforge.operators.modelling import impute_table
    df = spark.createDataFrame([("b", None, 1.0), ("a", None, None), ("b", None, 4.0), ("a", None, 2.0), (None, None, None)], "x string, y string, n double")
    assert most_frequent(df, "x").first()[0] == "a" and most_frequent(df, "y").first()[0] is None
    assert [tuple(r) for r in most_frequent_values(df, ["x", "y"]).collect()] == [("x", "a")]
    assert sorted(map(tuple, impute_table(df, ["n"], ["x", "y"]).collect())) == [
        ("n", "numeric", "2.0"), ("x", "categorical", "a"), ("y", "categorical", "Unknown")]


def test_rounding_is_half_up_at_the_half(spark):
    from panelforge.functions.nulls import rnd
    df = spark.createDataFrame([(1.23449,), (1.2345,), (1.2344999999999999,), (-1.2346,), (2.0,)], "x double")
    assert [r[0] for r in df.select(rnd("x", 3)).collect()] == [1.234, 1.235, 1.235, -1.235, 2.0]
