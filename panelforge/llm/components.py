"""Connected components of a link table, and splitting of large groups into block pairs."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from panelforge.llm.common import drop_scratch, scratch_table


def split_into_block_pairs(rows: DataFrame, keys: list[str], size: str, row_id: str, block: int) -> DataFrame:
    """Rows with ``bi, bj, side`` such that any two rows of a group meet in exactly one (bi, bj).

    A group of ``size`` rows becomes ceil(size / block) blocks by id hash; a row goes to the pairs of its
    own block with every block (a small group stays one pair). ``side`` is 0 in block bi and 1 in bj; in
    a pair of a block with itself all rows have side 0.
    """
    blocks = F.ceil(F.col(size) / F.lit(block)).cast("int")
    out = rows.withColumn("_nb", blocks).withColumn("_b", F.pmod(F.xxhash64(row_id, *keys), F.col("_nb")).cast("int"))
    out = out.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)))
    return (out.withColumn("bi", F.least("_b", "_j")).withColumn("bj", F.greatest("_b", "_j"))
            .withColumn("side", (F.col("_b") > F.col("_j")).cast("int")).drop("_nb", "_b", "_j"))


def _oriented(a: Column | str, b: Column | str) -> list[Column]:
    return [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component`` of every id in ``links``: the smallest id reachable.

    Alternating large-star and small-star steps: each makes neighbours point to the smallest one seen,
    in a number of rounds that grows with the logarithm of the longest path. Each round is written to the
    shared folder; only a count and a checksum come to the driver. Links to itself or with nulls are ignored.
    """
    edges = (links.select(*_oriented(a, b)).filter("u is not null and v is not null and u > v").distinct())
    edges, state = _round(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (both.filter("v > u").join(least, "u").unionByName(edges.join(least, "u").select("u", "v", "m").filter("v > m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.filter("u > m").select("u", F.col("m").alias("v")))
                 .filter("u > v").distinct())
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(smallest, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(smallest.select("u", F.col("m").alias("v"))).distinct())
        before, (edges, after) = edges, _round(small)
        drop_scratch(before)
        if after == state:
            break
        state = after
    return (edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()))


def _round(edges: DataFrame) -> tuple[DataFrame, tuple]:
    seen = Observation()
    checked = edges.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
                            F.min("u").alias("lo"), F.max("u").alias("hi"))
    table = scratch_table(checked, "links")
    got = seen.get
    return table, (got["n"], got["x"], got["lo"], got["hi"])
