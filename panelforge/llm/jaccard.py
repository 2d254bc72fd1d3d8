"""Shingle Jaccard join with count-vector R-trees.

A document's set is its distinct word shingles as 64-bit hashes. Its count vector says how many of them fall
into each of G hash groups; the overlap of two sets is at most the sum of the smaller counts of each group, and
for two boxes of points at most the same sum over the boxes' largest counts, which prunes whole branches.

Such points alone can't be dealt out to many machines (unrelated documents of one length lie close together in
all coordinates), so each R-tree holds the documents of one bucket: those that share a shingle among the
first of their sets in one order for all. With J >= t, two sets share one among the first |x| - ceil(2t/(1+t) |x|) + 1
of the smaller and the first |y| - ceil(t |y|) + 1 of the larger set, so buckets lose no pair. The order puts frequent
shingles last: one pass counts all shingles in a table of fixed size, and those in a slot well above the mean come
later the fuller it is; equal ones go by hash.

Steps: (1) sets, equal sets collapsed; (2) buckets; (3) documents that share many buckets with their bucket's
first document are compared with it exactly and merged; (4) in the buckets that still hold several components, the
R-tree join gives each document's closest partner by the bound, verified exactly and merged; both steps settle
groups of near copies with few pairs each; (5) the same join gives all remaining pairs between components,
verified exactly, so no link is lost; (6) components.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from panelforge.llm.common import drop_scratch, free_name, scratch_table, ship_code
from panelforge.llm.components import components, split_into_block_pairs

WORDS = 5
THRESHOLD = (75, 100)   # linked when 100 * intersection >= 75 * union
#: A key this frequent among so many keys of a task is hot: its rows spread over so many salts.
HOT_AT_ONCE, KEYS_AT_ONCE, SALTS = 64, 1_000_000, 256
BLOCK = 2048
LEAF, FANOUT = 64, 8
#: Bits of the map of ids that ``sets_of`` reads texts for: its size is fixed, misses are impossible.
MAP_BITS = 24
MEMO_LIMIT = 100_000
#: Slots of the table of shingle counts, and rows it is sent in.
SLOT_BITS, SLOT_PARTS = 18, 16
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                     0x85EBCA77C2B2AE63], np.uint64)


class WordHash(dict):
    """Memo of word (bytes) -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_WORD_HASH = WordHash()


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_hashes(text: str | None, k: int = WORDS) -> np.ndarray:
    """Hashes of the word k-shingles as they come: A-Z lower-cased, words split at ASCII white space.

    Fewer than k words make one shingle of them all; no words, none.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_WORD_HASH.__getitem__, words), np.uint64, n)
    take = min(k, n)
    total = np.full(n - take + 1, np.uint64(take))
    for j in range(take):
        total += _mix(h[j:n - take + 1 + j] + np.uint64(j)) * _FACTORS[j % len(_FACTORS)]
    return _mix(total)


def shingle_set(text: str | None, k: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word k-shingles."""
    return np.unique(shingle_hashes(text, k))


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def slot_levels(texts: DataFrame) -> np.ndarray:
    """Per slot how far its shingle count lies above the mean, in half octaves (0: not above).

    Counts of all texts are added up in each task, then in groups of tasks; the driver gets the sums alone.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            found = [_slot(shingle_hashes(t)) for t in batch.column(0).to_pylist()]
            total += np.bincount(np.concatenate(found), minlength=len(total)) if found else 0
        task = TaskContext.get().partitionId()
        parts = total.reshape(SLOT_PARTS, -1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SLOT_PARTS, dtype=np.int32)), pa.array(np.full(SLOT_PARTS, task, np.int32)),
                                          pa.array([p.tobytes() for p in parts], pa.binary())], names=["part", "task", "counts"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, np.int64) for c in group["counts"])
        return pd.DataFrame({"part": group["part"].iloc[:1], "task": 0, "counts": [total.tobytes()]})

    kind = "part int, task int, counts binary"
    rows = texts.select("text")
    width = max(1, math.isqrt(rows.rdd.getNumPartitions()))
    sums = rows.mapInArrow(count, kind).groupBy("part", (F.col("task") % width).alias("g")).applyInPandas(add, kind)
    found = {r["part"]: r["counts"] for r in sums.groupBy("part").applyInPandas(add, kind).collect()}
    if not found:
        return np.zeros(1 << SLOT_BITS, np.uint8)
    counts = np.concatenate([np.frombuffer(found[p], np.int64) for p in range(SLOT_PARTS)])
    return np.floor(2 * np.log2(np.maximum(counts / max(counts.mean(), 1e-9), 1))).astype(np.uint8)


def in_order(hashes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """A sorted set in the order of all sets: by the level of its slot, then by hash."""
    level = levels[_slot(hashes)]
    late = level > 0
    if not late.any():
        return hashes
    return np.concatenate([hashes[~late], hashes[late][np.argsort(level[late], kind="stable")]])


def group_counts(hashes: np.ndarray) -> bytes:
    """Packed count vector over the next power of two of groups at or above the set's size, 16 at least.

    Two bits a group hold counts up to 3; what is above that in all groups together is a number at the end.
    """
    groups = max(16, 1 << max(len(hashes) - 1, 0).bit_length())
    counts = np.bincount((hashes >> np.uint64(20)).astype(np.int64) & (groups - 1), minlength=groups)
    low = np.minimum(counts, 3).astype(np.uint8).reshape(-1, 4)
    packed = low[:, 0] | low[:, 1] << 2 | low[:, 2] << 4 | low[:, 3] << 6
    return packed.tobytes() + int((counts - np.minimum(counts, 3)).sum()).to_bytes(4, "little")


def unpack_counts(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(counts up to 3, excess) of vectors over equally many groups, one per row."""
    raw = np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1)
    low = ((raw[:, :-4, None] >> np.array([0, 2, 4, 6], np.uint8)) & 3).reshape(len(packed), -1)
    return low, raw[:, -4:].copy().view("<u4")[:, 0].astype(np.int64)


def fold(counts: np.ndarray, groups: int) -> np.ndarray:
    """Count vectors (rows) over fewer groups: group g takes g, g + groups, g + 2 groups, ..."""
    return counts.reshape(len(counts), -1, groups).sum(axis=1, dtype=np.uint8) if counts.shape[1] > groups else counts


def overlap_bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum over groups of the smaller count, for all rows of a against all rows of b.

    min(x, y) is the number of t with x >= t and y >= t, hence a sum of 0/1 matrix products.
    """
    out = np.zeros((len(a), len(b)), np.float32)
    for t in range(1, int(min(a.max(initial=0), b.max(initial=0))) + 1):
        out += (a >= t).astype(np.float32) @ (b >= t).astype(np.float32).T
    return out.astype(np.int64)


def prefixes(n: int, num: int = THRESHOLD[0], den: int = THRESHOLD[1]) -> tuple[int, int]:
    """How many first hashes a set of n needs as the smaller and as the larger one of a pair."""
    both = -(-2 * num * n // (num + den))
    return n - both + 1, n - (-(-num * n // den)) + 1


def least_overlap(x, y, num: int = THRESHOLD[0], den: int = THRESHOLD[1]):
    """Smallest intersection at which sets of sizes x and y link."""
    return -(-num * (x + y) // (num + den))


_SETS = "doc_id long, n long, sig binary, keys array<long>, counts binary"


def _sets(levels):
    """mapInArrow function: documents -> their sets; ``levels`` is the broadcast of :func:`slot_levels`."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sig, keys, counts = [], [], [], []
            for t in batch.column(1).to_pylist():
                s = shingle_set(t)
                n.append(len(s))
                sig.append(xxhash.xxh128_digest(s.tobytes()) if len(s) else None)
                keys.append(in_order(s, levels.value)[:prefixes(len(s))[1]].view(np.int64) if len(s) else [])
                counts.append(group_counts(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(sig, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(counts, pa.binary())],
                names=["doc_id", "n", "sig", "keys", "counts"])
    return sets


_KEYS = "key long, rep long, size long, salt int"


def _bucket_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, document) rows. A key frequent among a task's next million keys is hot there: its rows are
    salted over many partitions, and one row of it without a document goes unsalted as a sign."""
    waiting, total = [], 0
    for batch in batches:
        waiting.append(batch)
        total += len(batch.column(2).flatten())
        if total >= KEYS_AT_ONCE:
            yield _salted(pa.Table.from_batches(waiting).combine_chunks())
            waiting, total = [], 0
    if waiting:
        yield _salted(pa.Table.from_batches(waiting).combine_chunks())


def _salted(table: pa.Table) -> pa.RecordBatch:
    docs, sizes, lists = (c.combine_chunks() for c in table.columns[:3])
    lengths = np.asarray(pc.list_value_length(lists)).astype(np.int64)
    key = pc.list_flatten(lists).to_numpy(zero_copy_only=False)
    rep, n = np.repeat(docs.to_numpy(), lengths), np.repeat(sizes.to_numpy(), lengths)
    start = np.repeat(np.cumsum(lengths) - lengths, lengths)
    small = np.array([prefixes(x)[0] for x in sizes.to_pylist()], np.int64)
    first = np.arange(len(key)) - start < np.repeat(small, lengths)
    size = n * 2 + first     # the last bit: also among the first as the smaller set
    values, where, count = np.unique(key, return_inverse=True, return_counts=True)
    hot = (count >= HOT_AT_ONCE)[where]
    signs = values[count >= HOT_AT_ONCE]
    none = np.zeros(len(signs), np.int64)
    salt = np.where(hot, 1 + (_mix(rep.astype(np.uint64)) % np.uint64(SALTS)).astype(np.int32), 0)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([key, signs])),
         pa.array(np.concatenate([rep, none]), mask=np.concatenate([np.zeros(len(key), bool), none == 0])),
         pa.array(np.concatenate([size, none])), pa.array(np.concatenate([salt, none]).astype(np.int32))],
        names=["key", "rep", "size", "salt"])


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (salted or not, key), the salted ones and those whose key occurs more than once
    (a sign counts); signs go."""
    carry = None
    for batch in batches:
        part = [batch.column(0).to_numpy(), batch.column(1).fill_null(0).to_numpy(), batch.column(2).to_numpy(),
                batch.column(1).is_null().to_numpy(zero_copy_only=False), batch.column(3).to_numpy() > 0]
        if carry is not None:
            part = [np.concatenate([a, b]) for a, b in zip(carry, part)]
        if not len(part[0]):
            continue
        key = part[0]
        same = key[1:] == key[:-1]
        shared = np.concatenate([[False], same]) | np.concatenate([same, [False]]) | part[4]
        keep = shared & ~part[3]
        # the last row waits for its successor; if it has been passed on already, it waits as a sign
        carry = [c[-1:].copy() for c in part]
        carry[3] |= shared[-1:]
        carry[4][:] = False
        yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in part[:3]], names=["key", "rep", "size"])


def _compatible(nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
    return (THRESHOLD[0] * np.maximum(nx, ny) <= THRESHOLD[1] * np.minimum(nx, ny))


def _first_of_smaller(nx, ny, fx, fy):
    """Whether a bucket's key is among the first of the smaller set (of both sets of equal size)."""
    return np.where(nx < ny, fx, np.where(nx > ny, fy, fx & fy)).astype(bool)


class RTree:
    """Static tree over count vectors: rows sorted by set size, packed into leaves and inner boxes.

    A box keeps the least and largest set size, the largest count of every group and the largest excess.
    """

    def __init__(self, sizes: np.ndarray, counts: np.ndarray, excess: np.ndarray):
        self.order = np.argsort(sizes, kind="stable")
        self.sizes, self.counts, self.excess = sizes[self.order], counts[self.order], excess[self.order]
        starts = np.arange(0, len(sizes), LEAF)
        ends = np.minimum(starts + LEAF, len(sizes))
        # from leaves up: (first row or child, end, least size, largest size, largest counts, largest excess)
        self.levels = [(starts, ends, self.sizes[starts], self.sizes[ends - 1],
                        np.maximum.reduceat(self.counts, starts, axis=0), np.maximum.reduceat(self.excess, starts))]
        while len(starts) > 1:
            _, _, low, high, top, over = self.levels[-1]
            starts = np.arange(0, len(low), FANOUT)
            ends = np.minimum(starts + FANOUT, len(low))
            self.levels.append((starts, ends, low[starts], high[ends - 1], np.maximum.reduceat(top, starts, axis=0),
                                np.maximum.reduceat(over, starts)))


def tree_join(a: RTree, b: RTree, same: bool, folded: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Leaf pairs that the bounds leave, as (rows, rows, closeness): rows are numbers into the vectors the
    trees were built from; closeness is the overlap bound over both sizes, -1 for a pair that can't link.

    With ``same`` both trees are one, and every pair comes once. Counts above 3 are known by their sum only:
    they add at most the smaller of both sums, or after folding (``folded``) both.
    """
    def above(x, y):
        return x + y if folded else np.minimum(x, y)

    todo = [(len(a.levels) - 1, 0, len(b.levels) - 1, 0)]
    while todo:
        la, i, lb, j = todo.pop()
        (sa, ea, lowa, higha, topa, overa), (sb, eb, lowb, highb, topb, overb) = a.levels[la], b.levels[lb]
        # sizes: the smallest set of one box against the best partner the other box can offer
        if THRESHOLD[0] * lowb[j] > THRESHOLD[1] * higha[i] or THRESHOLD[0] * lowa[i] > THRESHOLD[1] * highb[j]:
            continue
        best = int(np.minimum(topa[i], topb[j]).sum(dtype=np.int64)) + int(above(overa[i], overb[j]))
        if best < least_overlap(int(lowa[i]), int(lowb[j])):
            continue
        if la and (la >= lb or not lb):
            todo += [(la - 1, k, lb, j) for k in range(sa[i], ea[i])]
        elif lb:
            todo += [(la, i, lb - 1, k) for k in range(sb[j], eb[j])]
        elif not same or i <= j:
            x, y = slice(sa[i], ea[i]), slice(sb[j], eb[j])
            bound = overlap_bound(a.counts[x], b.counts[y]) + above(a.excess[x][:, None], b.excess[y][None, :])
            nx, ny = a.sizes[x][:, None], b.sizes[y][None, :]
            good = (bound >= least_overlap(nx, ny)) & _compatible(nx, ny)
            if same and i == j:
                good &= np.triu(np.ones(good.shape, bool), 1)
            if good.any():
                yield a.order[x], b.order[y], np.where(good, bound / (nx + ny), -1.0)


def bucket_pairs(rep: np.ndarray, size: np.ndarray, counts: list[bytes], comp: np.ndarray, side: np.ndarray,
                 same: bool, best_only: bool = False) -> tuple[np.ndarray, np.ndarray, bool]:
    """Pairs of a block pair of one bucket that the bound leaves and that lie in different components, and
    whether there are more of them than are returned.

    ``best_only``: of each document only the pair with the closest bound.
    """
    met_pairs = 0
    n, first = size >> 1, (size & 1).astype(bool)
    left, right = [], []
    closest, partner = np.full(len(rep), -1.0), np.zeros(len(rep), np.int64)
    # sets of very unequal size can't link: only vectors of neighbouring lengths meet, folded to the shorter
    widths = np.array([(len(c) - 4) * 4 for c in counts])
    unpacked = {int(w): (own := np.flatnonzero(widths == w), *unpack_counts([counts[i] for i in own]))
                for w in np.unique(widths)}

    def tree(w: int, groups: int, keep: int | None) -> tuple[np.ndarray, RTree] | None:
        own, low, excess = unpacked[w]
        if keep is not None:
            chosen = side[own] == keep
            own, low, excess = own[chosen], low[chosen], excess[chosen]
        return (own, RTree(n[own], fold(low, groups), excess)) if len(own) else None

    for w in unpacked:
        for v in (w, 2 * w) if same else (w // 2, w, 2 * w):
            if v not in unpacked:
                continue
            one, groups = same and v == w, min(v, w)
            mine = tree(w, groups, None if same else 0)
            theirs = mine if one else tree(v, groups, None if same else 1)
            if mine is None or theirs is None:
                continue
            here, other = mine[0], theirs[0]
            met = tree_join(mine[1], theirs[1], one, v != w)
            for p, q, ratio in met:
                x, y = here[p], other[q]
                nx, ny, fx, fy = n[x][:, None], n[y][None, :], first[x][:, None], first[y][None, :]
                # the shared hash must be among the first of the smaller set
                fits = (comp[x][:, None] != comp[y][None, :]) & _first_of_smaller(nx, ny, fx, fy)
                ratio = np.where(fits, ratio, -1.0)
                if best_only:
                    met_pairs += int((ratio >= 0).sum())
                    for rows, others, table in ((x, y, ratio), (y, x, ratio.T)):
                        k = table.argmax(axis=1)
                        top = table[np.arange(len(rows)), k]
                        better = top > closest[rows]
                        closest[rows[better]], partner[rows[better]] = top[better], others[k[better]]
                else:
                    i, j = np.nonzero(ratio >= 0)
                    left.append(rep[x[i]])
                    right.append(rep[y[j]])
    if best_only:
        found = np.flatnonzero(closest >= 0)
        a, b = rep[found], rep[partner[found]]
        returned = len(set(zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist())))
        return a, b, met_pairs > returned
    none = [np.zeros(0, np.int64)]
    return np.concatenate(left or none), np.concatenate(right or none), False


def _closest_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    return _tree_pairs(batches, True)


def _all_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    return _tree_pairs(batches, False)


def _tree_pairs(batches: Iterator[pd.DataFrame], best_only: bool) -> Iterator[pd.DataFrame]:
    """mapInPandas functions over rows sorted by (key, bi, bj): pairs ``a, b``, and keys (``more``) of
    buckets that hold more pairs than were returned."""
    carry, left, right, more = None, [], [], []

    def flush() -> pd.DataFrame:
        a = np.concatenate(left) if left else np.zeros(0, np.int64)
        b = np.concatenate(right) if right else np.zeros(0, np.int64)
        met = pd.DataFrame({"a": np.maximum(a, b), "b": np.minimum(a, b)}, dtype="Int64").drop_duplicates()
        met["more"] = pd.array([pd.NA] * len(met), "Int64")
        keys = pd.DataFrame({"more": more}, dtype="Int64").reindex(columns=["a", "b", "more"]).astype("Int64")
        for kept in (left, right, more):
            kept.clear()
        return pd.concat([met, keys], ignore_index=True)

    def work(rows: pd.DataFrame, cuts: np.ndarray) -> None:
        """All complete groups of a frame; ``cuts`` are their starts and the end of the last."""
        key, rep, size, comp, side = (rows[c].to_numpy() for c in ("key", "rep", "size", "comp", "side"))
        counts, same = rows["counts"].to_numpy(), (rows["bi"] == rows["bj"]).to_numpy()
        starts, ends = cuts[:-1], cuts[1:]
        if not len(starts):
            return
        stop = int(cuts[-1])
        n = size >> 1
        # nothing to find where all rows are of one component or no two sizes go together
        open_ = np.minimum.reduceat(comp[:stop], starts) < np.maximum.reduceat(comp[:stop], starts)
        two = ends - starts == 2
        x = starts[two]
        open_[two] &= _compatible(n[x], n[x + 1]) & _first_of_smaller(n[x], n[x + 1], size[x] & 1, size[x + 1] & 1)
        # two documents whose vectors are equally wide need no tree: all such buckets are bounded together
        widths = np.fromiter(map(len, counts[:stop]), np.int64, stop)
        alike = open_.copy()
        alike[two] &= widths[x] == widths[x + 1]
        alike &= two
        open_ &= ~alike
        x = starts[alike]
        for w in np.unique(widths[x]):
            own = x[widths[x] == w]
            step = max(1, 20_000_000 // int(w * 4))
            for k in range(0, len(own), step):
                i = own[k:k + step]
                (la, ea), (lb, eb) = unpack_counts(counts[i].tolist()), unpack_counts(counts[i + 1].tolist())
                bound = np.minimum(la, lb).sum(axis=1, dtype=np.int64) + np.minimum(ea, eb)
                i = i[bound >= least_overlap(n[i], n[i + 1])]
                if len(i):
                    left.append(rep[i])
                    right.append(rep[i + 1])
        for x, y in zip(starts[open_].tolist(), ends[open_].tolist()):
            a, b, rest = bucket_pairs(rep[x:y], size[x:y], counts[x:y], comp[x:y], side[x:y], bool(same[x]), best_only)
            if rest:
                more.append(int(key[x]))
            if len(a):
                left.append(a)
                right.append(b)

    for batch in batches:
        if carry is not None:
            batch = pd.concat([carry, batch], ignore_index=True)
        key = batch[["key", "bi", "bj"]].to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1])
        work(batch, cuts)
        carry = batch.iloc[int(cuts[-1]):]
        if sum(map(len, left)) + len(more) > 500_000:
            yield flush()
    if carry is not None and len(carry):
        work(carry.reset_index(drop=True), np.array([0, len(carry)]))
    yield flush()


def _map_words(ids: DataFrame, col: str) -> DataFrame:
    """Map of 2^MAP_BITS bits with the hashes of ``ids`` set, as at most 2^(MAP_BITS-6) words ``w, m``."""
    bit = F.pmod(F.xxhash64(col), F.lit(1 << MAP_BITS))
    return (ids.select(F.shiftright(bit, 6).alias("w"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64({col}), {1 << MAP_BITS}) & 63 as int))")
                       .alias("m")).groupBy("w").agg(F.bit_or("m").alias("m")))


def _id_map(ids: DataFrame, col: str) -> np.ndarray:
    """The words of :func:`_map_words` in the driver."""
    words = _map_words(ids, col).toPandas()
    out = np.zeros(1 << (MAP_BITS - 6), np.int64)
    out[words["w"].to_numpy(np.int64)] = words["m"].to_numpy(np.int64)
    return out


def sets_of(texts: DataFrame, ids: DataFrame, col: str) -> DataFrame:
    """``id, hashes`` (binary) for the documents in ``ids``; others may come too, to be joined away.

    Texts are hashed again instead of kept: a broadcast bit map of fixed size tells which may be needed.
    """
    shared = texts.sparkSession.sparkContext.broadcast(_id_map(ids, col))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, made = [], []
            bit = batch.column(2).to_numpy()
            wanted = (shared.value[bit >> 6] >> (bit & 63)) & 1
            for k in np.flatnonzero(wanted).tolist():
                s = shingle_set(batch.column(1)[k].as_py())
                if len(s):
                    keep.append(k)
                    made.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), pa.array(made, pa.binary())],
                                             names=["id", "hashes"])

    marked = texts.select(F.col("doc_id").alias("id"), "text", F.pmod(F.xxhash64("doc_id"), F.lit(1 << MAP_BITS)).alias("bit"))
    return marked.mapInArrow(compute, "id long, hashes binary")


def _exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs that link, from rows sorted by pair with one set each; two rows make a pair complete."""
    last, first_set, sets = None, [], []
    out: list[tuple[int, int]] = []
    for batch in batches:
        for a, b, i, h in zip(batch["a"].tolist(), batch["b"].tolist(), batch["id"].tolist(), batch["hashes"]):
            if (a, b) != last:
                last, first_set, sets = (a, b), [], []
            (first_set if i == a else sets).append(h)
            if not sets or not first_set or out and out[-1] == last:
                continue
            # a doc id on several rows brings several sets: any of them may link
            if any(_linked(x, h) for x in first_set) if i == b else any(_linked(h, y) for y in sets):
                out.append(last)
        yield pd.DataFrame(out[:-1] if out else [], columns=["a", "b"], dtype="int64")
        out = out[-1:]
    yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _linked(x: bytes, y: bytes) -> bool:
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    both = int((y[at] == x).sum())
    return THRESHOLD[1] * both >= THRESHOLD[0] * (len(x) + len(y) - both)


def verified(pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """The pairs ``a, b`` whose sets link, by exact intersection; written to the shared folder."""
    pairs = scratch_table(pairs, name + "-candidates")
    ends = (pairs.select("a", "b", F.col("a").alias("id"))
            .unionByName(pairs.select("a", "b", F.col("b").alias("id"))))
    sets = sets_of(texts, ends.select("id").distinct(), "id")
    met = ends.join(sets, "id").repartition("a", "b").sortWithinPartitions("a", "b", "id")
    links = scratch_table(met.select("a", "b", "id", "hashes").mapInPandas(_exact, "a long, b long"), name)
    drop_scratch(pairs)
    return links


def _tree_round(buckets: DataFrame, named: DataFrame, links: DataFrame, pairs, texts: DataFrame,
                name: str) -> tuple[DataFrame, DataFrame]:
    """Verified links from the R-trees of those buckets that hold several components under ``links``, and
    the keys of the buckets that hold more pairs than ``pairs`` returned."""
    merged = components(links).withColumnsRenamed({"id": "rep", "component": "comp"})
    placed = scratch_table(buckets.join(merged, "rep", "left").withColumn("comp", F.coalesce("comp", "rep")), name + "-placed")
    # two documents that no size or prefix lets link need no vectors: "lo_size" and "hi_size" are theirs
    low, high = F.shiftright("lo_size", 1), F.shiftright("hi_size", 1)
    smaller_first = F.col("lo_size").bitwiseAND(F.lit(1)) == 1   # of equal sizes, both are
    can_link = ((F.col("m") > 2) | (low * THRESHOLD[1] >= high * THRESHOLD[0]) & smaller_first)
    mixed = (placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("m"),
                                       F.min("size").alias("lo_size"), F.max("size").alias("hi_size"),
                                       F.sum(F.xxhash64("rep", "size").cast("decimal(38,0)")).alias("members"))
             .filter("lo < hi").filter(can_link)
             # of buckets with the same members one is enough
             .groupBy("m", "members").agg(F.min("key").alias("key")).select("key", "m"))
    ready = (placed.join(mixed, "key")
             .join(named.select(F.col("doc_id").alias("rep"), "counts", F.col("n").alias("rn")), "rep")
             .filter("rn = shiftright(size, 1)"))
    dealt = (split_into_block_pairs(ready, ["key"], "m", "rep", BLOCK)
             .select("key", "bi", "bj", "side", "rep", "size", "comp", "counts")
             .repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj"))
    met = scratch_table(dealt.mapInPandas(pairs, "a long, b long, more long"), name + "-met")
    drop_scratch(placed)
    more = scratch_table(met.filter("more is not null").select(F.col("more").alias("key")).distinct(), name + "-more")
    links = verified(met.filter("a is not null").select("a", "b").distinct(), texts, name)
    drop_scratch(met)
    return links, more


def alone_and_repeated(named: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``named`` whose ``sig`` no other row has, and those that may have equals.

    A broadcast bit map of fixed size marks the signatures that occur more than once: no equals are parted, few rows
    without any come along, and nothing but the signatures is shuffled.
    """
    again = named.groupBy("sig").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    bit = f"pmod(xxhash64(sig), {1 << MAP_BITS})"
    words = scratch_table(_map_words(again, "sig"), "repeated")   # at most 2^(MAP_BITS-6) rows, hence the broadcast
    marked = (named.withColumn("w", F.expr(f"shiftright({bit}, 6)")).join(F.broadcast(words), "w", "left")
              .withColumn("again", F.expr(f"coalesce(shiftright(m, cast({bit} & 63 as int)) & 1, 0) = 1")).drop("w", "m"))
    return marked.filter("not again").drop("again"), marked.filter("again").drop("again")


def one_per_set(named: DataFrame) -> DataFrame:
    """``rep, n, keys`` per distinct set, ``rep`` its smallest id. Only sets that may have equals move with their keys."""
    alone, repeated = alone_and_repeated(named)
    merged = repeated.groupBy("sig", "n").agg(F.min("doc_id").alias("rep"), F.first("keys").alias("keys"))
    return alone.select(F.col("doc_id").alias("rep"), "n", "keys").unionByName(merged.select("rep", "n", "keys"))


def near_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs``.

    Null, empty and blank texts have no shingles and link with nothing (component: the own id). Rows with a
    null id link with nothing and have a null component. Rows that repeat an id are one node, linked
    by any of its texts. Ties need no rule: components do not depend on the order of rows. Other columns
    are not read. An empty table gives an empty result.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ship_code(docs.sparkSession)
    levels = docs.sparkSession.sparkContext.broadcast(slot_levels(texts))   # one byte a slot
    sets = scratch_table(texts.mapInArrow(_sets(levels), _SETS), "sets")
    named = sets.filter("sig is not null and doc_id is not null")
    buckets = scratch_table(
        one_per_set(named).mapInArrow(_bucket_rows, _KEYS).repartition("key", "salt")
        .sortWithinPartitions(F.col("salt") > 0, "key").mapInArrow(_shared_keys, "key long, rep long, size long"), "buckets")
    # the keys have done their work; sizes, signatures and count vectors stay
    whole, sets = sets, scratch_table(sets.drop("keys"), "set-sizes")
    drop_scratch(whole)
    named = sets.filter("sig is not null and doc_id is not null")

    # near copies share many buckets with the first document of their size in each of them
    step = F.floor(F.log(F.shiftright("size", 1).cast("double")) / math.log(THRESHOLD[1] / THRESHOLD[0])).cast("int")
    stepped = buckets.withColumn("step", step)
    heads = stepped.groupBy("key", "step").agg(F.min("rep").alias("b"), F.count(F.lit(1)).alias("m")).filter("m > 1")
    near = (stepped.join(heads, ["key", "step"]).filter("rep > b")
            .groupBy(F.col("rep").alias("a"), "b").agg(F.count(F.lit(1)).alias("c"), F.max(F.shiftright("size", 1)).alias("n"))
            .filter("c * 10 >= n").select("a", "b"))
    first = verified(near, texts, "first-links")
    # what is left: buckets with several components, joined by their R-trees
    closest, unfinished = _tree_round(buckets, named, first, _closest_pairs, texts, "closest-links")
    linked = first.unionByName(closest)
    # a bucket of which every pair that the bound leaves has been verified holds nothing new
    second, rest = _tree_round(buckets.join(unfinished, "key", "left_semi"), named, linked, _all_pairs, texts, "second-links")
    drop_scratch(buckets, unfinished, rest)

    smallest = named.groupBy("sig").agg(F.min("doc_id").alias("rep"))
    same_set = named.select("doc_id", "sig").join(smallest, "sig").filter("doc_id > rep").select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    all_links = same_set.unionByName(linked).unionByName(second)
    member = components(all_links).withColumnsRenamed({"id": "c_id", "component": "c"})
    return (sets.select("doc_id", F.col("n").alias("n_shingles"))
            .join(member, F.col("doc_id") == F.col("c_id"), "left")
            .select("doc_id", "n_shingles", F.coalesce("c", "doc_id").alias("component_id")))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group, columns unchanged.

    Rows with a null id stay. Of rows that repeat an id, all stay or none.
    """
    gone = free_name(docs, "gone")
    kept = (near_documents(docs, id_col, text_col).filter("doc_id is not null and doc_id <> component_id")
            .select(F.col("doc_id").alias(gone)).distinct())
    return docs.join(kept, F.col(id_col) == F.col(gone), "left_anti")
