"""Every registered query with an oracle must match DuckDB on the sf0.001 tables."""
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"

import __spark_entry__ as E  # noqa: E402

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    from oracle_check import duck as make
    return make(SF)


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    from oracle_check import compare
    r = compare(spark, duck, name, E.queries()[name], E.oracle_sql()[name], SF)
    assert r["ok"], r
    assert "type_mismatch" not in r, r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns == ["suburb", "price_band", "n", "mean_normalized_price"]
