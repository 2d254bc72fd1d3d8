"""Stateless derive steps applied to a file stream with foreachBatch."""
import os
import tempfile

import pytest

from panelforge.streaming.derive_stream import derive_stream, stateless_steps

SF = "/root/testdata/sf0.001"


def test_derive_stream_matches_batch(spark):
    from pyspark.sql import functions as F
    from panelforge.plans.derive import run_derive
    steps = [{"type": "simple", "method": "date_parts", "source": "o_orderdate"},
             {"type": "bin", "source": "o_totalprice", "output": "band",
              "config": {"edges": [100000, 300000], "labels": ["low", "mid", "high"]}},
             {"type": "aggregate", "group_by": ["o_custkey"], "target": "o_totalprice", "outputs": {"mean": "m"}}]
    assert [s["type"] for s in stateless_steps(steps)] == ["simple", "bin"]
    src = spark.read.parquet(f"{SF}/orders.parquet")
    out = tempfile.mkdtemp(prefix="pf-stream-out-")
    ck = tempfile.mkdtemp(prefix="pf-stream-ck-")
    stream = spark.readStream.schema(src.schema).option("pathGlobFilter", "orders.parquet").parquet(SF)
    with pytest.raises(ValueError, match="aggregate"):
        derive_stream(stream, steps, os.path.join(out, "t"), ck)
    q = derive_stream(stream, stateless_steps(steps), os.path.join(out, "t"), ck)
    q.awaitTermination(120)
    got = spark.read.parquet(os.path.join(out, "t"))
    want = run_derive(src, stateless_steps(steps))
    cols = ["o_orderkey", "saleYearMonth", "band"]
    assert got.count() == src.count()
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0
