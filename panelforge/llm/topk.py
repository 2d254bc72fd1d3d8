"""Exact top-k search by inner product with a pivot table.

Every vector keeps its distances to many pivots. For a query q, a candidate x and a pivot p the triangle
inequality gives |d(q,p) - d(x,p)| <= d(q,x), hence <q,x> <= (|q|^2 + |x|^2 - max_p(...)^2) / 2. In each block of
candidates a query evaluates those of the highest bounds first, and of the others those whose bound reaches its
k-th score so far. Both tables are packed in blocks and written once; tasks read the blocks they pair, so no copy of
a block is shuffled, gathered or broadcast. The best k of all blocks are ranked at the end.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from panelforge.llm.common import LARGE_ROWS, scratch_table

PIVOTS = 32
QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 4096
#: Queries whose bounds are held at once, and candidates that set a query's first k-th score.
STRIP, FIRST = 16, 64
_PACKED = "block int, n int, dim int, ids binary, vectors binary, distances binary"


def whole_vector(vector: Column) -> Column:
    """Not null, and all components present and finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine, F.lit(False))


def scaled(vector: Column, scale: int = 256) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def _pack(pivots: dict[int, np.ndarray], size: int, label: bool):
    """mapInPandas function: vectors of a partition -> packed blocks of one dimension each.

    A vec_id that occurs more than once counts with its smallest vector.
    """
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[int, dict[int, np.ndarray]] = {}
        block = -1
        for batch in batches:
            for i, b, v in zip(batch["vec_id"], batch["block"], batch["v"]):
                block = int(b)
                own = waiting.setdefault((block, len(v)), {})
                if i not in own or v.tolist() < own[i].tolist():
                    own[i] = v
        for (block, dim), own in sorted(waiting.items()):
            ids = np.array(sorted(own), np.int64)
            table = np.stack([own[i] for i in ids.tolist()]).astype(np.int64)
            for a in range(0, len(ids), size):
                yield _packed(block, dim, ids[a:a + size], table[a:a + size], pivots.get(dim))
    return pack


def _packed(block: int, dim: int, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray | None) -> pd.DataFrame:
    v = vectors.astype(np.float64)
    if pivots is None or not len(pivots):
        distances = np.zeros((len(ids), 0))
    else:
        distances = np.stack([np.sqrt(((v - p) ** 2).sum(axis=1)) for p in pivots.astype(np.float64)], axis=1)
    return pd.DataFrame([(block, len(ids), dim, ids.tobytes(), vectors.tobytes(), distances.tobytes())],
                        columns=["block", "n", "dim", "ids", "vectors", "distances"])


def _unpacked(row, prefix: str):
    n, dim = getattr(row, prefix + "n"), row.dim
    return (np.frombuffer(getattr(row, prefix + "ids"), np.int64),
            np.frombuffer(getattr(row, prefix + "vectors"), np.int64).reshape(n, dim),
            np.frombuffer(getattr(row, prefix + "distances"), np.float64).reshape(n, -1))


def search_block(q_ids, q, q_dist, x_ids, x, x_dist, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vec_id, score) of each query's best k in one block of candidates, exactly.

    Candidates have ascending ids. Ties go to the smaller id.
    """
    limit = max(int(np.abs(q).max(initial=0)), 1) * max(int(np.abs(x).max(initial=0)), 1) * max(q.shape[1], 1)
    kind = np.float64 if limit < 1 << 52 else object   # products stay exact integers either way
    qf, xf = q.astype(kind), x.astype(kind)
    q_norm, x_norm = (q.astype(float) ** 2).sum(1), (x.astype(float) ** 2).sum(1)
    slack = (0.5 + 1e-9) * x_norm + 0.5       # rounding of the distances
    x_by_pivot = np.ascontiguousarray(x_dist.T)
    low, gap = np.empty((2, min(STRIP, len(q)), len(x)))
    first_n = max(FIRST, k)
    out = []
    for a in range(0, len(q), STRIP):
        strip = slice(a, a + STRIP)
        n = len(q[strip])
        low, gap = low[:n], gap[:n]
        low[:] = 0
        for p, to_pivot in enumerate(x_by_pivot):
            np.subtract(q_dist[strip, p][:, None], to_pivot, out=gap)
            np.maximum(low, np.abs(gap, out=gap), out=low)
        bound = np.square(low, out=gap)
        bound *= -0.5
        bound += slack
        bound += (0.5 + 1e-9) * q_norm[strip][:, None]
        own = np.searchsorted(x_ids, q_ids[strip])
        here = np.flatnonzero(own < len(x_ids))
        here = here[x_ids[own[here]] == q_ids[strip][here]]
        bound[here, own[here]] = -np.inf
        bar = np.full((n, 1), -np.inf, kind)     # no k-th score so far
        if len(x) > first_n:
            first = np.argpartition(bound, len(x) - first_n, axis=1)[:, len(x) - first_n:]
            score = (xf[first] @ qf[strip][:, :, None])[:, :, 0]
            score[np.take_along_axis(bound, first, 1) == -np.inf] = -np.inf
            bar = np.sort(score, axis=1)[:, first_n - k:first_n - k + 1]
        left = (bound >= bar) & (bound > -np.inf)
        if np.count_nonzero(left) * 16 > left.size:
            score = qf[strip] @ xf.T
            r, c = np.nonzero(left & (score >= bar))
            score = score[r, c]
        else:
            r, c = np.nonzero(left)
            score = (qf[strip][r] * xf[c]).sum(axis=1)
        order = np.lexsort((c, -score, r))
        r, c, score = r[order], c[order], score[order]
        best = np.arange(len(r)) - np.searchsorted(r, r) < k
        out.append((q_ids[strip][r[best]], x_ids[c[best]], score[best].astype(np.int64)))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256, pivots: int = PIVOTS,
          id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best candidates of every query.

    Queries are the rows whose id is divisible by ``every``; candidates all rows but the query's own id.
    Vectors that are null or hold null or non-finite components take no part, nor do null ids; vectors
    meet only those of their own dimension; an id that occurs more than once counts once, with its
    smallest vector. Scores are 64-bit integers. An empty table gives an empty result.
    """
    rows = (vectors.filter(F.col(id_col).isNotNull() & whole_vector(F.col(vector_col)))
            .select(F.col(id_col).cast("long").alias("vec_id"), scaled(F.col(vector_col), scale).alias("v")))
    count = rows.count()
    # pivots: the vectors with the smallest id hashes (a number fixed beforehand)
    chosen: dict[int, list] = {}
    for r in (rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).collect()):
        chosen.setdefault(len(r["v"]), []).append(r["v"])
    table = {dim: np.array(v, np.int64) for dim, v in chosen.items()}

    def packed(df: DataFrame, blocks: int, size: int) -> DataFrame:
        blocks = max(1, blocks)
        placed = df.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
        return placed.repartition(min(blocks, 4096), "block").mapInPandas(_pack(table, size, False), _PACKED)

    x = scratch_table(packed(rows, -(-count // CANDIDATE_BLOCK), CANDIDATE_BLOCK), "top-k-candidates", LARGE_ROWS)
    q = scratch_table(packed(rows.filter(F.col("vec_id") % every == 0), -(-count // (every * QUERY_BLOCK)), QUERY_BLOCK),
                      "top-k-queries", LARGE_ROWS)
    q = q.withColumnsRenamed({c: "q_" + c for c in ("block", "n", "ids", "vectors", "distances")})
    # pairs of partitions are read where they are needed: a block's copies would be too many for a shuffle or broadcast
    met = x.hint("shuffle_replicate_nl").join(q, "dim")

    def evaluate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                qi, vi, s = search_block(*_unpacked(row, "q_"), *_unpacked(row, ""), k)
                yield pd.DataFrame({"query_id": qi, "vec_id": vi, "score": s})

    found = met.mapInPandas(evaluate, "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
