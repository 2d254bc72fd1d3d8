"""Near-duplicate vectors: binary codes of random rotations with stored correction factors.

A unit vector o is rotated at random; the signs of its coordinates are its code, and f = <code/sqrt(D), o> its
correction factor. <code/sqrt(D), q> / f is an unbiased estimate of <o, q>, whose error is below
``CONFIDENCE`` * sqrt((1 - f^2) / f^2 / (D - 1)) except with negligible probability; a pair is recomputed
exactly unless even the upper end of that interval is below the threshold.

Candidate pairs come from bands of code bits: vectors of one label meet where they agree in all bits of a band.
The number of bits follows the largest label's size, so that unrelated vectors rarely meet at any size, and
the number of bands follows from the recall asked for at the threshold itself.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from panelforge.llm.common import scratch_table
from panelforge.llm.components import components, split_into_block_pairs
from panelforge.llm.topk import whole_vector

THRESHOLD = 0.93
RECALL = 0.99
CONFIDENCE = 5.0
MIN_CODE = 128
BLOCK = 1024
SEED = 20240229


@lru_cache(maxsize=16)
def rotation(dim: int, bits: int, seed: int = SEED) -> np.ndarray:
    """``dim`` x ``bits`` matrix: as many random rotations of a space of ``dim`` dimensions as needed."""
    rng = np.random.default_rng([seed, dim])
    made = []
    while sum(m.shape[1] for m in made) < bits:
        q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
        made.append(q * np.sign(np.diag(r)))
    return np.hstack(made)[:, :bits]


def band_plan(largest: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bits per band, bands): a pair at the threshold shares a band with probability ``recall``."""
    bits = min(30, max(6, math.ceil(math.log2(max(largest, 2))) + 4))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - agree))


def _units(raw: list, dim: int) -> np.ndarray:
    v = np.array(raw, np.float64).reshape(len(raw), dim)
    v = v / np.abs(v).max(axis=1, keepdims=True)   # no overflow in the squares
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _bands(bits: int, bands: int):
    """Band numbers of unit vectors, as one binary of int32 per vector."""
    @pandas_udf("binary")
    def keys(vectors: pd.Series) -> pd.Series:
        out = np.empty(len(vectors), object)
        dims = vectors.map(len).to_numpy()
        for dim in np.unique(dims):
            own = np.flatnonzero(dims == dim)
            signs = _units([vectors.iloc[i] for i in own], dim) @ rotation(int(dim), bits * bands) > 0
            numbers = signs.reshape(len(own), bands, bits) @ (1 << np.arange(bits, dtype=np.int64))
            for i, row in zip(own, numbers.astype(np.int32)):
                out[i] = row.tobytes()
        return pd.Series(out)
    return keys


def _explode(bands: int):
    @pandas_udf("array<int>")
    def numbers(packed: pd.Series) -> pd.Series:
        return pd.Series([np.frombuffer(b, np.int32) for b in packed], dtype=object)
    return numbers


def link_group(ids: np.ndarray, side: np.ndarray, unit: np.ndarray, keys: np.ndarray, band: int, same: bool,
               threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links per row and smallest linked id per row's local component, for one block pair of a bucket.

    Counts a pair only in the first band that it shares.
    """
    n, dim = unit.shape
    code_dim = max(MIN_CODE, dim)
    turned = unit @ rotation(code_dim, code_dim, SEED + 1)[:dim]     # zero-padded to the code's dimension
    code = np.where(turned >= 0, 1.0, -1.0).astype(np.float32)
    factor = np.abs(turned).sum(axis=1) / math.sqrt(code_dim)
    spread = CONFIDENCE * np.sqrt(np.maximum(1 - factor ** 2, 0) / factor ** 2 / (code_dim - 1))
    estimate = (code @ turned.astype(np.float32).T) / math.sqrt(code_dim) / factor[:, None]
    maybe = estimate + spread[:, None] >= threshold - 1e-4
    maybe &= np.triu(np.ones((n, n), bool), 1) if same else (side[:, None] == 0) & (side[None, :] == 1)
    i, j = np.nonzero(maybe)
    linked = np.zeros((n, n), bool)
    for a in range(0, len(i), 100_000):
        x, y = i[a:a + 100_000], j[a:a + 100_000]
        real = np.einsum("ij,ij->i", unit[x], unit[y]) >= threshold
        real &= ids[x] != ids[y]
        x, y = x[real], y[real]
        if band and len(x):
            new = ~(keys[x, :band] == keys[y, :band]).any(axis=1)
            x, y = x[new], y[new]
        linked[x, y] = linked[y, x] = True
    root = ids.copy()
    if linked.any():
        touched = np.flatnonzero(linked.any(axis=1))
        sub, lab = linked[np.ix_(touched, touched)], ids[touched]
        while True:
            new = np.minimum(lab, np.where(sub, lab[None, :], np.iinfo(np.int64).max).min(axis=1))
            if (new == lab).all():
                break
            lab = new
        root[touched] = lab
    return linked.sum(axis=1), root


def _verify(threshold: float):
    """mapInPandas function over rows sorted by (bucket, bi, bj): links of every block pair."""
    def groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry = None
        for batch in batches:
            if carry is not None:
                batch = pd.concat([carry, batch], ignore_index=True)
            key = batch[["bucket", "bi", "bj"]].to_numpy()
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            last = int(cuts[-1]) if len(cuts) else 0
            for a, b in zip([0, *cuts[:-1]], cuts):
                yield batch.iloc[a:b]
            carry = batch.iloc[last:]
        if carry is not None and len(carry):
            yield carry

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, links, roots = [], [], []
        for g in groups(batches):
            if len(g) < 2:
                continue
            own = g["vec_id"].to_numpy()
            vectors = np.stack([np.frombuffer(b, np.float64) for b in g["unit"]])
            keys = np.stack([np.frombuffer(b, np.int32) for b in g["keys"]])
            count, root = link_group(own, g["side"].to_numpy(), vectors, keys, int(g["band"].iloc[0]),
                                     bool(g["bi"].iloc[0] == g["bj"].iloc[0]), threshold)
            hit = count > 0
            ids.append(own[hit])
            links.append(count[hit])
            roots.append(root[hit])
            if len(ids) >= 2000:
                yield _frame(ids, links, roots)
                ids, links, roots = [], [], []
        yield _frame(ids, links, roots)

    def _frame(ids, links, roots) -> pd.DataFrame:
        empty = [np.zeros(0, np.int64)]
        return pd.DataFrame({"vec_id": np.concatenate(ids or empty), "links": np.concatenate(links or empty),
                             "root": np.concatenate(roots or empty)})
    return verify


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK,
                 id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row per vec_id.

    Only vectors of one label and one dimension are compared. Null labels or ids, null or zero vectors and
    vectors with null or non-finite components link with nothing. An id that occurs more than once counts as
    one vector, with its smallest label and vector. An empty table gives an empty result.
    """
    base = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                           F.col(vector_col).alias("v"))
            .groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("s")).select("vec_id", "s.label", "s.v"))
    length = F.aggregate(F.coalesce("v", F.array().cast("array<float>")), F.lit(0.0),
                         lambda t, x: t + F.abs(x.cast("double")))
    base = scratch_table(base, "vectors")
    good = base.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & whole_vector(F.col("v"))
                       & (F.coalesce(length, F.lit(0.0)) > 0))
    largest = good.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, bands = band_plan(largest, threshold, recall)

    @pandas_udf("binary")
    def unit(vs: pd.Series) -> pd.Series:
        return pd.Series([_units([v], len(v)).tobytes() for v in vs], dtype=object)

    coded = scratch_table(good.select("vec_id", F.xxhash64("label", F.size("v")).alias("grp"),
                                      _bands(bits, bands)("v").alias("keys"), unit("v").alias("unit")), "codes")
    keys = (coded.select("vec_id", "grp", F.posexplode(_explode(bands)("keys")).alias("band", "number"))
            .select("vec_id", "band", F.xxhash64("grp", "band", "number").alias("bucket")))
    sizes = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    meeting = keys.join(sizes, "bucket").join(coded.select("vec_id", "keys", "unit"), "vec_id")
    pairs = split_into_block_pairs(meeting, ["bucket"], "size", "vec_id", block)
    dealt = (pairs.select("bucket", "bi", "bj", "side", "band", "vec_id", "keys", "unit")
             .repartition("bucket", "bi", "bj").sortWithinPartitions("bucket", "bi", "bj", "vec_id"))
    found = scratch_table(dealt.mapInPandas(_verify(threshold), "vec_id long, links long, root long"), "vector-links")
    counted = found.groupBy("vec_id").agg(F.sum("links").alias("n_links")).withColumnRenamed("vec_id", "l_id")
    member = components(found, "vec_id", "root")
    return (base.join(counted, F.col("vec_id") == F.col("l_id"), "left")
            .join(member, F.col("vec_id") == F.col("id"), "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
