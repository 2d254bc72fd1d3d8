"""Order statistics, windows and positions over many range slices, against the oracle and brute force."""
import os
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"
NAMES = ["win_03_loo_median_min_max", "win_04_range_include_current", "win_05_empty_and_null_frames",
         "agg_01_08_group_transform_all_functions", "agg_11_group_month_table", "win_06_rolling_rows",
         "win_06_rolling_centered", "srt_01_multi_key_sort_rank"]


@pytest.fixture
def many_slices(spark):
    """Small tables stay cut into 16 slices instead of being put together into one."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", NAMES)
def test_many_slices_match_oracle(spark, many_slices, name):
    import __spark_entry__ as E
    from oracle_check import compare, duck
    r = compare(spark, duck(SF), name, E.queries()[name], E.oracle_sql()[name], SF)
    assert r["ok"], r


def test_group_quantiles_of_a_hot_group(spark, many_slices):
    from panelforge.operators import quantiles as Q
    rng = np.random.default_rng(5)
    rows = [("a" if i % 30 else None, float(v)) for i, v in enumerate(rng.normal(50, 10, 3000).round(1))]
    rows += [("b", 7.0)] * 500 + [("c", None), ("d", 1.0), ("d", 2.0)]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {r["k"]: (r["q0"], r["q1"], r["q2"]) for r in Q.group_quantiles(df, ["k"], "x", [0.1, 0.5, 1.0]).collect()}
    assert set(got) == {"a", "b", "d", None}          # a group without a value has no row
    for key in got:
        want = np.quantile([v for k, v in rows if k == key], [0.1, 0.5, 1.0])
        assert np.allclose(got[key], want, rtol=0, atol=1e-9)
    both = Q.quantiles_of(df.withColumn("y", -F.col("x")), {"x": [0.25, 0.5], "y": [0.75]})
    values = [v for _, v in rows if v is not None]
    assert np.allclose(both["x"] + both["y"], [*np.quantile(values, [0.25, 0.5]), -np.quantile(values, 0.25)], atol=1e-9)


def test_values_at_ranks_equal_sorting():
    from panelforge.operators.frames import values_at_ranks
    rng = np.random.default_rng(3)
    group, month = rng.integers(0, 6, 800), rng.integers(-5, 30, 800)
    value, count = rng.integers(0, 40, 800).astype(float), rng.integers(1, 4, 800)
    asked = []
    for _ in range(400):
        g, lo = rng.integers(0, 6), rng.integers(-7, 28)
        hi = lo + rng.integers(0, 13)
        held = np.sort(np.repeat(value, np.where((group == g) & (month >= lo) & (month <= hi), count, 0)))
        if len(held):
            k = rng.integers(0, len(held))
            asked.append((g, lo, hi, k, held[k]))
    g, lo, hi, k, want = (np.array(c) for c in zip(*asked))
    assert (values_at_ranks(group, month, value, count, g, lo, hi, k) == want).all()


def test_rolling_on_an_integer_key_of_one_hot_group(spark, many_slices):
    from panelforge.operators.windows import rolling
    rng = random.Random(1)
    rows = [("hot" if i % 9 else rng.choice(["a", "b", None]), rng.choice([None, rng.randrange(300)]), i,
             rng.choice([None, float(rng.randrange(50))])) for i in range(1500)]
    df = spark.createDataFrame(rows, "k string, s int, row_id int, x double")
    for window, center in ((50, False), (7, True)):
        got = {r["row_id"]: (r["m"], r["n"]) for r in rolling(df, "k", "s", "x", window, {"sum": "m", "count": "n"}, center=center).collect()}
        assert len(got) == 1500
        for key in ("hot", "a", "b", None):
            own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is None, r[1] or 0, r[2]))
            for i, r in enumerate(own):
                lo, hi = (i - window // 2, i + (window - 1) // 2) if center else (i - window + 1, i)
                xs = [q[3] for q in own[max(lo, 0):hi + 1] if q[3] is not None]
                assert got[r[2]] == ((sum(xs), len(xs)) if xs else (None, None))


def test_halo_rows_stay_few(spark, many_slices):
    from panelforge.operators import slices, windows
    df = spark.range(4000).select(F.lit("hot").alias("k"), F.col("id").alias("s"), F.col("id").cast("double").alias("x"))
    table = slices.sliced(df, ["k"], ["s"])
    assert table.select(slices.SLICE).distinct().count() > 8
    assert windows._halo(table, ["k"], ["s"], 49, True).count() <= 49 * 16   # of 4,000 rows


def test_positions_without_keys(spark, many_slices):
    from panelforge.operators.slices import with_positions
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), (F.col("id") % 2 == 0).alias("flag"))
    got = with_positions(df, [], [F.col("v").desc()], "pos").collect()
    assert sorted(r["pos"] for r in got) == list(range(1000)) and all(r["pos"] == 999 - r["v"] for r in got)
