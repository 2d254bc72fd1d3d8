"""Removal of repeated word sequences by recompression.

Rounds of recompression rewrite every text: a run of one symbol becomes one symbol, then each left symbol
followed by a right symbol becomes one (left or right is a bit of the symbol's name). A new name is a hash of the
round and the names it joins, so all tasks name equal runs and pairs alike and equal substrings get equal symbols
in their interior. Which words decide a symbol (its own and those the rounds looked at beside it) is kept as its
span; a window of words that holds the span holds the symbol, wherever the window stands.

Of the highest-level symbols that a window holds, the one with the smallest name is the window's anchor, named by
its span's words; equal windows have equal anchors at the same place in them. A Spark round counts the anchors'
names. Only windows on anchors shared by two places can repeat (about one anchor a dozen words is shuffled, not
every word). They are verified in blocks, the neighbouring windows of one anchor: a block whose whole content is
found twice settles all its windows; of the others, one block of each content is split into single windows.

Hashes only propose anchors; what counts as equal has two independent 64-bit hashes of its words (anchor and block
or window), and texts are told apart by 96 bits.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from panelforge.llm.common import drop_scratch, scratch_table, ship_code

WINDOW, ROUNDS = 35, 4
#: Bytes of text whose arrays are worked on at once (longer texts alone), rows of an output batch.
SLICE_BYTES, OUT_ROWS = 300_000, 50_000
#: A key with more than 1 / HOT_SHARE of the rows (hence fewer than HOT_SHARE keys) is joined in SALTS parts.
HOT_SHARE, SALTS = 1000, 64

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BLACK = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


class RangeHash:
    """64-bit hashes of ranges of a sequence, equal for equal content wherever the range lies."""

    def __init__(self, seed: int):
        random = np.random.default_rng(seed)
        self.letter = random.integers(0, 1 << 64, 256, dtype=np.uint64)
        self.base = int(random.integers(0, 1 << 62)) * 8 + 5
        self.power = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) <= n:
            for name, factor in (("power", self.base), ("inverse", pow(self.base, -1, 1 << 64))):
                steps = np.full(2 * n, factor % (1 << 64), np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def sums(self, values: np.ndarray) -> np.ndarray:
        self._grow(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.power[:len(values)], out=out[1:])
        return out

    def ranges(self, sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((sums[stop] - sums[start]) * self.inverse[start] + (stop - start).astype(np.uint64) * _ODD)


_BYTES, _WORDS = (RangeHash(11), RangeHash(12)), (RangeHash(13), RangeHash(14))


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of texts ``data[offsets[i]:offsets[i + 1]]``, and each text's first word."""
    black = _BLACK[data]
    begins, stops = black.copy(), black.copy()
    begins[1:] &= ~black[:-1]
    stops[:-1] &= ~black[1:]
    full = offsets[1:] > offsets[:-1]
    first, last = offsets[:-1][full], offsets[1:][full] - 1
    begins[first], stops[last] = black[first], black[last]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(stops) + 1, np.searchsorted(start, offsets)


def word_names(data: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int) -> np.ndarray:
    own = _BYTES[lane]
    return own.ranges(own.sums(own.letter[data]), start, end)


def recompressed(names: np.ndarray, bounds: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols after ``rounds`` rounds: names and spans [low, high) of words that decide them.

    A span that would need the words beyond a text's end reaches one word past it, so no window holds it.
    """
    size = np.diff(bounds)
    text = np.repeat(np.arange(len(size)), size)
    low, high = np.arange(len(names)), np.arange(len(names)) + 1
    before, beyond = bounds[:-1] - 1, bounds[1:] + 1
    for r in range(rounds):
        if not len(names):
            break
        # runs: decided by the symbols on both sides too
        new = np.ones(len(names), bool)
        new[1:] = (names[1:] != names[:-1]) | (text[1:] != text[:-1])
        i = np.flatnonzero(new)
        j = np.append(i[1:], len(names)) - 1
        length = (j - i + 1).astype(np.uint64)
        kept, where = names[i], text[i]
        names = np.where(length > 1, mixed(kept + length * _ODD + np.uint64(r + 1)), kept)
        apart = np.ones(len(i) + 1, bool)
        apart[1:-1] = where[1:] != where[:-1]
        low = np.where(apart[:-1], before[where], low[np.maximum(i - 1, 0)])
        high = np.where(apart[1:], beyond[where], high[np.minimum(j + 1, len(text) - 1)])
        text = where
        # pairs of a left and a right symbol; a symbol that stays single is decided by the one it might have joined
        right = (mixed(names + np.full(1, 2 * r + 1, np.uint64) * _M2) >> np.uint64(20) & np.uint64(1)).astype(bool)
        joins = np.zeros(len(names), bool)
        joins[:-1] = ~right[:-1] & right[1:] & ~apart[1:-1]
        second = np.zeros(len(names), bool)
        second[1:] = joins[:-1]
        after = np.minimum(np.arange(1, len(names) + 1), len(names) - 1)
        low_here, high_here = low, high
        low = low.copy()
        low[1:] = np.where(right[1:], np.where(apart[1:-1], before[text[1:]], low_here[:-1]), low_here[1:])
        if right[0]:
            low[0] = before[text[0]]
        high = np.where(right, high_here, np.where(apart[1:], beyond[text], high_here[after]))
        names = np.where(joins, mixed(names * _ODD + mixed(names[after] + np.uint64(r + 1))), names)
        keep = ~second
        names, text, low, high = names[keep], text[keep], low[keep], high[keep]
    return names, low, high


def anchored_windows(names: np.ndarray, bounds: np.ndarray, window: int = WINDOW,
                     rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts of all windows, and [start, stop) of each one's anchor: a symbol's span, or the window itself
    where it holds no symbol. Symbol names order the anchors; of equal ones the first counts."""
    n = len(names)
    inside = np.ones(n, bool)
    for stop in bounds[1:].tolist():
        inside[max(stop - window + 1, 0):stop] = False
    # the loop marks the last words of each text; those of a short text's predecessor are out anyway
    at = np.flatnonzero(inside & (np.arange(n) + window <= n))
    symbol, low, high = recompressed(names, bounds, rounds)
    if not len(at) or not len(symbol):
        return at, at, at + window
    first = np.searchsorted(low, at)
    last = np.searchsorted(high, at + window, side="right")     # symbols first .. last - 1 lie in the window
    index = np.uint64((1 << 32) - 1)
    order = (mixed(symbol) & ~index) | np.arange(len(symbol), dtype=np.uint64)
    held = last - first
    low_of, high_of = at.copy(), at + window
    table, step = order, 1
    todo = np.flatnonzero(held > 0)
    while len(todo):
        now = todo[held[todo] < 2 * step]
        if len(now):
            best = np.minimum(table[first[now]], table[last[now] - step]) & index
            low_of[now], high_of[now] = low[best], high[best]
            todo = todo[held[todo] >= 2 * step]
        if len(todo):
            table = np.minimum(table[:-step], table[step:])
            step *= 2
    return at, low_of, high_of


def _slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most SLICE_BYTES together, or one text."""
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SLICE_BYTES, side="right")) - 1)
        yield lo, hi
        lo = hi


def _texts(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _anchor_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """k1, k2, text -> k1, k2, name, times (1, or 2 for more): the anchors of each text."""
    for batch in batches:
        data, offsets = _texts(batch.column("text"))
        keys = [batch.column(c).to_numpy() for c in ("k1", "k2")]
        for lo, hi in _slices(offsets):
            own = data[offsets[lo]:offsets[hi]]
            start, end, bounds = words_of(own, offsets[lo:hi + 1] - offsets[lo])
            if len(start) < WINDOW:
                continue
            names = word_names(own, start, end, 0)
            _, a, b = anchored_windows(names, bounds)
            if not len(a):
                continue
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            a, b = a[new], b[new]
            text = np.searchsorted(bounds, a, side="right") - 1
            name = _WORDS[0].ranges(_WORDS[0].sums(names), a, b)
            order = np.lexsort((a, name, text))
            text, name, a = text[order], name[order], a[order]
            other = np.ones(len(name), bool)
            other[1:] = (name[1:] != name[:-1]) | (text[1:] != text[:-1])
            # an anchor can come back after a smaller one's windows: only other places count as a second time
            moved = np.zeros(len(name), bool)
            moved[1:] = ~other[1:] & (a[1:] != a[:-1])
            at = np.flatnonzero(other)
            twice = np.logical_or.reduceat(moved, at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[0][lo + text[at]]), pa.array(keys[1][lo + text[at]]), pa.array(_signed(name[at])),
                 pa.array((1 + twice).astype(np.int8))], ["k1", "k2", "name", "times"])


def _kept_digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without a shared anchor are done: all their words stay. The others keep text and names."""
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary()).to_pylist()
        held = batch.column("names").is_valid().to_pylist()
        words = [t.split() for t in texts]
        digests = [None if h else _kept_digest(w) for h, w in zip(held, words)]
        open_ = pa.array([not h for h in held])
        text = batch.column("text")
        yield pa.RecordBatch.from_arrays(
            [batch.column("k1"), batch.column("k2"), batch.column("copies"),
             pa.array([len(w) for w in words], pa.int64()), pa.array(digests, pa.string()),
             pc.if_else(open_, pa.scalar(None, text.type), text).cast(pa.string()), batch.column("names")],
            ["k1", "k2", "copies", "n_words", "digest", "text", "names"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with shared anchors -> their blocks: name, key, place, size and the windows' hashes."""
    for batch in batches:
        data, offsets = _texts(batch.column("text"))
        keys = [batch.column(c).to_numpy() for c in ("k1", "k2")]
        names_of = batch.column("names")
        for lo, hi in _slices(offsets):
            own = data[offsets[lo]:offsets[hi]]
            start, end, bounds = words_of(own, offsets[lo:hi + 1] - offsets[lo])
            first = word_names(own, start, end, 0)
            at, a, b = anchored_windows(first, bounds)
            if not len(at):
                continue
            name = _signed(_WORDS[0].ranges(_WORDS[0].sums(first), a, b))
            text = np.searchsorted(bounds, at, side="right") - 1
            # a shared name is shared for every text that has it, so the slice's names together will do
            ok = np.isin(name, names_of.slice(lo, hi - lo).flatten().to_numpy())
            at, a, b, name, text = at[ok], a[ok], b[ok], name[ok], text[ok]
            if not len(at):
                continue
            new = np.ones(len(at), bool)
            new[1:] = (at[1:] != at[:-1] + 1) | (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (text[1:] != text[:-1])
            i = np.flatnonzero(new)
            size = np.diff(np.append(i, len(at)))
            sums = _WORDS[1].sums(word_names(own, start, end, 1))
            whole = _WORDS[1].ranges(sums, at[i], at[i] + size - 1 + WINDOW)
            # the anchor's place in the block belongs to its content: equal windows have it at one place
            whole = _signed(mixed(whole + (a[i] - at[i]).astype(np.uint64) * _M2))
            single = _signed(_WORDS[1].ranges(sums, at, at + WINDOW)).tobytes()
            stops = np.cumsum(size)
            hashes = pa.Array.from_buffers(pa.large_binary(), len(i), [
                None, pa.py_buffer(np.append(0, stops * 8).astype(np.int64).tobytes()), pa.py_buffer(single)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[0][lo + text[i]]), pa.array(keys[1][lo + text[i]]), pa.array(name[i]), pa.array(whole),
                 pa.array((at[i] - bounds[text[i]]).astype(np.int32)), pa.array(size.astype(np.int32)), hashes],
                ["k1", "k2", "name", "block", "start", "size", "windows"])


def _single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """name, block, times, windows -> a row per window: name, block, times, at, hash."""
    for batch in batches:
        size = np.array([len(w) // 8 for w in batch.column("windows").to_pylist()], np.int64)
        hashes = np.frombuffer(b"".join(batch.column("windows").to_pylist()), np.int64)
        before = np.cumsum(size) - size
        columns = [np.repeat(batch.column(c).to_numpy(), size) for c in ("name", "block", "times")]
        columns += [(np.arange(len(hashes)) - np.repeat(before, size)).astype(np.int32), hashes]
        for lo in range(0, len(hashes), OUT_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(c[lo:lo + OUT_ROWS]) for c in columns],
                                             ["name", "block", "times", "at", "hash"])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open texts with their marks -> words removed and digest of the words kept."""
    for batch in batches:
        rows = {c: batch.column(c).to_pylist() for c in ("copies", "n_words", "digest", "marks")}
        texts = batch.column("text").cast(pa.large_binary()).to_pylist()
        removed, digests = [], []
        for copies, n, digest, marks, text in zip(rows["copies"], rows["n_words"], rows["digest"], rows["marks"], texts):
            gone = np.zeros(n + 1, np.int64)
            if copies > 1 and n >= WINDOW:
                gone[0] = 1
            for mark in marks or ():
                if mark["ats"] is None:
                    gone[mark["start"]] += 1
                    gone[mark["start"] + mark["size"] - 1 + WINDOW] -= 1
                else:
                    at = np.unique(mark["ats"]) + mark["start"]
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + WINDOW, -1)
            gone = np.cumsum(gone[:-1]) > 0 if n else np.zeros(0, bool)
            removed.append(int(gone.sum()))
            if removed[-1] == n:
                digest = _kept_digest([])
            elif digest is None:
                digest = _kept_digest(list(compress(text.split(), (~gone).tolist())))
            digests.append(digest)
        yield pa.RecordBatch.from_arrays(
            [batch.column("k1"), batch.column("k2"), batch.column("copies"), batch.column("n_words"),
             pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
            ["k1", "k2", "copies", "n_words", "n_removed", "kept_sha256"])


def join_hot(left: DataFrame, right: DataFrame, keys: list[str], rows: str, total: int, spread: Column) -> DataFrame:
    """Inner join on ``keys`` where ``right`` has one row a key and tells its number of ``rows`` in ``left``.

    The rows of a key with more than 1 / HOT_SHARE of the ``total`` are dealt to SALTS parts by ``spread``. There are
    fewer than HOT_SHARE such keys, which bounds what is broadcast.
    """
    hot = (right.filter(F.col(rows) > F.lit(max(total // HOT_SHARE, SALTS))).select(*keys, F.lit(True).alias("is_hot")))
    salt = F.when(F.col("is_hot"), F.pmod(spread, F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    dealt = left.join(F.broadcast(hot), keys, "left").withColumn("salt", salt).drop("is_hot")
    parts = F.when(F.col(rows) > F.lit(max(total // HOT_SHARE, SALTS)),
                   F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(right.withColumn("salt", F.explode(parts)).drop(rows), [*keys, "salt"]).drop("salt")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` per row of ``docs``.

    A word is removed if a window of 35 words that covers it starts anywhere else too, in the same text or another
    (another row with the same text included). ``kept_sha256`` digests the kept words joined by one space.

    Null and empty texts have no words; null ids and repeated rows are rows like any other; other columns are not
    read; an empty table gives an empty result. Texts are worked on whole: a very long one alone, in memory that
    grows with it.
    """
    spark = docs.sparkSession
    ship_code(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("k1"), F.hash(text).alias("k2"))
    keys = ["k1", "k2"]

    # round 1: which anchors are in two places
    anchors = scratch_table(base.select(*keys, "text").mapInArrow(_anchor_names, "k1 long, k2 int, name long, times byte"), "anchors")
    counted = (anchors.groupBy("name").agg(F.min("k1").alias("lo"), F.max("k1").alias("hi"), F.max("times").alias("times"),
                                           F.count(F.lit(1)).alias("rows"))
               .filter("lo != hi or times > 1").select("name", "rows"))
    counted = scratch_table(counted, "shared-anchors")
    total = anchors.count()
    shared = join_hot(anchors.select(*keys, "name"), counted, ["name"], "rows", total, F.col("k1"))
    names = scratch_table(shared.groupBy(*keys).agg(F.collect_set("name").alias("names")), "text-anchors")
    drop_scratch(anchors, counted)

    # each text once; those without a shared anchor are done
    texts = base.groupBy(*keys).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    texts = scratch_table(texts.join(names, keys, "left").mapInArrow(
        _settle, "k1 long, k2 int, copies long, n_words long, digest string, text string, names array<long>"), "texts")
    drop_scratch(names)

    # round 2: blocks, and the windows of those found once
    blocks = scratch_table(texts.filter("names is not null").select(*keys, "text", "names").mapInArrow(
        _blocks, "k1 long, k2 int, name long, block long, start int, size int, windows binary"), "blocks")
    place = ["name", "block"]
    contents = scratch_table(blocks.groupBy(*place).agg(F.count(F.lit(1)).alias("times"), F.first("windows").alias("windows")),
                             "contents")
    schema = "name long, block long, times long, at int, hash long"
    singles = contents.mapInArrow(_single_windows, schema)
    repeated = (singles.groupBy("name", "hash").agg(F.sum("times").alias("times"), F.count(F.lit(1)).alias("rows"))
                .filter("times > 1").select("name", "hash", "rows"))
    repeated = scratch_table(repeated, "repeated")
    once = contents.filter("times = 1").mapInArrow(_single_windows, schema).drop("times")
    found = join_hot(once, repeated, ["name", "hash"], "rows", contents.count(), F.col("block"))
    marks = (found.groupBy(*place).agg(F.collect_set("at").alias("ats")).withColumn("rows", F.lit(1).cast("long"))
             .unionByName(contents.filter("times > 1").select(*place, F.lit(None).cast("array<int>").alias("ats"),
                                                              F.col("times").alias("rows"))))
    marks = scratch_table(marks, "marks")
    marked = join_hot(blocks.drop("windows"), marks, place, "rows", blocks.count(), F.col("k1"))
    marked = marked.groupBy(*keys).agg(F.collect_list(F.struct("start", "size", "ats")).alias("marks"))
    result = texts.drop("names").join(marked, keys, "left").mapInArrow(
        _finish, "k1 long, k2 int, copies long, n_words long, n_removed long, kept_sha256 string")
    result = scratch_table(result, "kept")
    drop_scratch(texts, blocks, contents, repeated, marks)
    rows = result.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    return (join_hot(base.drop("text"), result, keys, "copies", rows, F.xxhash64("doc_id"))
            .select("doc_id", "n_words", "n_removed", "kept_sha256"))
