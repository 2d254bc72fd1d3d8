"""Alignment of two tokenizers' tokens by the byte offsets where both end a token.

Each text becomes two rising lists of byte ends. The shorter list drives a galloping (exponential, then
binary) search into the longer one, all its ends at once in numpy. Ends found in both lists cut the tokens
into groups; the difference between the ranks of neighbouring ends is the range of tokens that one token
overlaps, hence its links.

Both tokenizers start a new token at a single space or line end between two plain characters, so a text is
cut there into chunks whose tokens don't depend on their neighbours (a text without such places is one
chunk). A worker aligns each different chunk once and adds the results up.

Corpus-wide link counts: documents are packed in blocks of bounded size that keep, per document, how often it
holds each chunk, and the block's own table of id pairs. Only (block, pair, documents) rows are shuffled and
counted; each block gets back the counts of its pairs and finishes its documents.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from panelforge.llm.common import LARGE_ROWS, scratch_table, ship_code

#: Chunk occurrences of a block of documents (a document is never split), and bytes of the worker's memo.
BLOCK_CHUNKS, MEMO_BYTES = 1_000_000, 160_000_000
_PLAIN = r"[^\s\x00-\x20\x7f-\xa0]"
_CUT = re.compile(f"(?<={_PLAIN})(?=[ \n]{_PLAIN})")
_ODD = re.compile(r"[ \n](?:[ \n]|\Z)|[\x00-\x09\x0b-\x1f\x7f-\xa0]|[^\S \n]")
SPACE = "▁"
_PACKED = ("block long, doc_id array<long>, totals binary, digests array<string>, ptr binary, chunk binary, times binary, "
           "pair_ptr binary, pair binary, codes binary, holders binary")
_OUT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
        "groups_sha256 string")


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 stands for itself, the rest from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def gallop(wanted: np.ndarray, start: np.ndarray, stop: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each wanted value the first index in [start, stop) with ``ends[index] >= wanted``.

    Steps double until one passes the value, then the last step is halved; ``ends[stop - 1] >= wanted`` holds.
    """
    low = start - 1                      # ends[low] < wanted (or before the list)
    step = np.ones(len(wanted), np.int64)
    open_ = np.arange(len(wanted))
    while len(open_):
        at = np.minimum(low[open_] + step[open_], stop[open_] - 1)
        short = ends[at] < wanted[open_]
        open_, at = open_[short], at[short]
        low[open_] = at
        step[open_] *= 2
    high = np.minimum(low + step, stop - 1)   # ends[high] >= wanted
    open_ = np.flatnonzero(high - low > 1)
    while len(open_):
        mid = (low[open_] + high[open_]) >> 1
        short = ends[mid] < wanted[open_]
        low[open_[short]] = mid[short]
        high[open_[~short]] = mid[~short]
        open_ = open_[high[open_] - low[open_] > 1]
    return high


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The ranges first[i] .. first[i] + count[i] - 1, one after the other."""
    before = np.cumsum(count) - count
    return np.arange(int(count.sum())) - np.repeat(before - first, count)


def overlaps(s: np.ndarray, n: np.ndarray, l: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, ...]:
    """Links and common ends of pairs of end lists: ``n[i]`` values of ``s`` against ``m[i]`` of ``l``.

    Each pair's lists start and end at the same offset, the first one is not the longer one. Returns the
    links as indices into ``s`` and ``l``, and for each token of either whether its end closes a group.
    """
    l_stop = np.cumsum(m)
    found = gallop(s, np.repeat(l_stop - m, n), np.repeat(l_stop, n), l)
    same = l[found] == s
    first = np.empty(len(s), np.int64)
    first[1:] = found[:-1] + same[:-1]         # the first token that ends after this one starts
    first[np.cumsum(n) - n] = l_stop - m
    count = found - first + 1
    closes = np.zeros(len(l), bool)
    closes[found[same]] = True
    return np.repeat(np.arange(len(s)), count), _spread(first, count), same, closes


class _Growing:
    """A one-dimensional array that doubles its room."""

    def __init__(self, kind: type):
        self.room, self.n = np.empty(1 << 12, kind), 0

    def extend(self, values: np.ndarray) -> None:
        while self.n + len(values) > len(self.room):
            self.room = np.concatenate([self.room, np.empty_like(self.room)])
        self.room[self.n:self.n + len(values)] = values
        self.n += len(values)

    @property
    def values(self) -> np.ndarray:
        return self.room[:self.n]


class Aligner(dict):
    """Memo chunk -> number; per number the chunk's tokens, groups, links, group text and pair codes.

    A chunk is written without the single space before it; one that starts otherwise keeps its white space.
    ``a_json`` is a byte-level vocabulary file for ``tokenizers``, ``b_model`` a SentencePiece model, both as
    the files' content.
    """

    def __init__(self, a_json: str, b_model: bytes):
        super().__init__()
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        byte = byte_alphabet()
        self.a_bytes = {i: bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode()
                        for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search(f"\n|[^{SPACE}]{SPACE}|{SPACE}\n", p) for p in pieces):
            raise ValueError("pieces that cross a space or a line end are not supported")
        self.b_bytes = dict(enumerate(bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                                      for i, p in enumerate(pieces)))
        self.a_size, self.b_size = (np.array([len(t.get(i, b"")) for i in range(max(t) + 1)], np.int64)
                                    for t in (self.a_bytes, self.b_bytes))
        self.a_marks = [f"{i}{end}" for i in range(len(self.a_size)) for end in ",|"]
        self.b_marks = [f"{i}{end}" for i in range(len(self.b_size)) for end in ",;"]
        self.lead = self.b.piece_to_id(SPACE)
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.held = 0
        self.waiting: list[str] = []                           # numbered, not aligned yet
        self.totals = [_Growing(np.int32) for _ in range(4)]   # n_a, n_b, n_groups, n_links
        self.changed = _Growing(np.bool_)                      # a tokenizer's bytes are not the chunk's
        self.groups: list[str] = []
        self.pairs = _Growing(np.int64)                        # codes a << 32 | b of the links, repeats included

    def __missing__(self, chunk: str) -> int:
        number = self[chunk] = len(self)
        self.waiting.append(chunk)
        return number

    def _b_ids(self, chunks: list[str]) -> list[list[int]]:
        """The second tokenizer's ids; it puts a space before a chunk that starts with a line end, which goes."""
        ids = self.b.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
        return [i if c[0] == " " else i[1:] if i[:1] == [self.lead] else [] for c, i in zip(chunks, ids)]

    def learn(self) -> None:
        """Align the chunks that wait, in the order of their numbers."""
        keys, self.waiting = self.waiting, []
        if not keys:
            return
        chunks = [k if k[0] in " \n" else " " + k for k in keys]
        a_ids = [e.ids for e in self.a.encode_batch(chunks, add_special_tokens=False)]
        b_ids = self._b_ids(chunks)
        changed = np.zeros(len(chunks), bool)
        n, m = (np.fromiter(map(len, ids), np.int64, len(chunks)) for ids in (a_ids, b_ids))
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64, int(k.sum())) for ids, k in ((a_ids, n), (b_ids, m)))
        raw = [c.encode("utf-8", "surrogatepass") for c in chunks]
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])   # offsets in all chunks joined
        ends = np.cumsum([len(r) for r in raw])
        if not (min(n.min(), m.min()) and np.array_equal(a_end[np.cumsum(n) - 1], ends)
                and np.array_equal(b_end[np.cumsum(m) - 1], ends)
                and b"".join(map(self.a_bytes.__getitem__, a.tolist())) == b"".join(raw)
                == b"".join(map(self.b_bytes.__getitem__, b.tolist()))):
            changed = np.array([not (b"".join(map(self.a_bytes.__getitem__, x)) == r
                                     == b"".join(map(self.b_bytes.__getitem__, y)))
                                for x, y, r in zip(a_ids, b_ids, raw)])
            a, b = a[~np.repeat(changed, n)], b[~np.repeat(changed, m)]
            n[changed] = m[changed] = 0
            a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        a_start, b_start = np.cumsum(n) - n, np.cumsum(m) - m
        a_closes, b_closes = np.zeros(len(a), bool), np.zeros(len(b), bool)
        links = np.zeros(len(chunks), np.int64)
        codes, owners = [a[:0]], [a[:0]]
        for a_drives in (True, False):
            part = np.flatnonzero(((n <= m) == a_drives) & ~changed)
            if not len(part):
                continue
            x, y = _spread(a_start[part], n[part]), _spread(b_start[part], m[part])
            if a_drives:
                i, j, i_closes, j_closes = overlaps(a_end[x], n[part], b_end[y], m[part])
            else:
                j, i, j_closes, i_closes = overlaps(b_end[y], m[part], a_end[x], n[part])
            a_closes[x], b_closes[y] = i_closes, j_closes
            owner = np.repeat(part, n[part])[i]
            links += np.bincount(owner, minlength=len(chunks))
            codes.append(a[x[i]] << 32 | b[y[j]])
            owners.append(owner)
        code, owner = np.concatenate(codes), np.concatenate(owners)
        groups = self._group_texts(a, b, a_closes, b_closes, n, m)
        running = np.concatenate([[0], np.cumsum(a_closes)])
        for kept, values in zip([*self.totals, self.changed],
                                (n, m, running[a_start + n] - running[a_start], links, changed)):
            kept.extend(values)
        self.pairs.extend(code[np.argsort(owner, kind="stable")])
        self.groups += groups
        self.held += 230 * len(chunks) + 2 * sum(map(len, keys)) + sum(map(len, groups)) + 8 * len(code)

    def _group_texts(self, a, b, a_closes, b_closes, n, m) -> list[str]:
        """Per chunk ``a1,a2|b1;a3|b2,b3``: the decimal ids of each group, first tokenizer | second."""
        # a token's place: behind the other tokenizer's tokens of earlier groups (and of its own group, for the second)
        a_group, b_group = np.cumsum(a_closes) - a_closes, np.cumsum(b_closes) - b_closes
        a_per, b_per = np.bincount(a_group), np.bincount(b_group)
        a_at = np.arange(len(a)) + (np.cumsum(b_per) - b_per)[a_group]
        b_at = np.arange(len(b)) + np.cumsum(a_per)[b_group]
        mark = np.empty(len(a) + len(b), np.int64)
        mark[a_at] = 2 * a + a_closes
        mark[b_at] = 2 * b + b_closes + len(self.a_marks)
        every = list(map((self.a_marks + self.b_marks).__getitem__, mark.tolist()))
        stops = np.cumsum(n + m).tolist()
        return ["".join(every[lo:hi])[:-1] for lo, hi in zip([0, *stops], stops)]

    def numbers(self, texts: list[str | None]) -> list[np.ndarray]:
        """The chunk numbers of each text; none for a text without tokens."""
        out = [np.array(list(map(self.__getitem__, chunks_of(t))), np.int64) for t in texts]
        self.learn()
        changed = self.changed.values
        return [x[:0] if changed[x].any() else x for x in out]


def chunks_of(text: str | None) -> list[str]:
    """A text's chunks, as the memo writes them."""
    if not text:
        return []
    if text[0] not in " \n" and not _ODD.search(text):
        return text.replace("\n", " \n").split(" ")
    return [c[1:] if c[0] == " " and c[1:2].strip("\x00\n ") and not _ODD.match(c[1]) else c for c in _CUT.split(" " + text)]


_ALIGNERS: dict[str, Aligner] = {}


def _aligner(key: str, files) -> Aligner:
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(*files.value)
    return _ALIGNERS[key]


class _Block:
    """Documents gathered until their chunks reach the limit, then packed as one row."""

    def __init__(self):
        self.ids: list[int | None] = []
        self.numbers: list[np.ndarray] = []
        self.digests: list[str] = []
        self.size = 0

    def add(self, doc_id: int | None, numbers: np.ndarray, aligner: Aligner) -> None:
        self.ids.append(doc_id)
        self.numbers.append(numbers)
        text = ";".join(map(aligner.groups.__getitem__, numbers.tolist()))
        self.digests.append(hashlib.sha256(text.encode()).hexdigest() if text else "")
        self.size += len(numbers) + 1

    def packed(self, block: int, aligner: Aligner) -> pd.DataFrame:
        n = len(self.ids)
        flat = np.concatenate(self.numbers)
        doc = np.repeat(np.arange(n), [len(x) for x in self.numbers])
        known = len(aligner.groups)
        held = np.flatnonzero(np.bincount(flat, minlength=known))
        local = np.zeros(known, np.int64)
        local[held] = np.arange(len(held))
        totals = np.stack([np.bincount(doc, t.values[flat], n) for t in aligner.totals], axis=1).astype(np.int64)
        # how often a document holds a chunk, chunks numbered inside the block
        entry, times = np.unique(doc * max(len(held), 1) + local[flat], return_counts=True)
        d, c = np.divmod(entry, max(len(held), 1))
        ptr = np.searchsorted(d, np.arange(n + 1))
        # the chunks' links as indices into the block's own table of pairs
        link_count = aligner.totals[3].values.astype(np.int64)
        link_start = np.cumsum(link_count) - link_count
        pair_count = link_count[held]
        pair_ptr = np.concatenate([[0], np.cumsum(pair_count)])
        codes, pair = np.unique(aligner.pairs.values[_spread(link_start[held], pair_count)], return_inverse=True)
        holders = np.zeros(len(codes), np.int64)
        for lo in range(0, n, 256):           # documents that hold each pair, some documents at a time
            span = slice(ptr[lo], ptr[min(lo + 256, n)])
            size = pair_count[c[span]]
            own = np.repeat(d[span], size) * len(codes) + pair[_spread(pair_ptr[:-1][c[span]], size)]
            holders += np.bincount(np.unique(own) % max(len(codes), 1), minlength=len(codes))
        return pd.DataFrame({
            "block": [block], "doc_id": [self.ids], "totals": [totals.tobytes()], "digests": [self.digests],
            "ptr": [ptr.astype(np.int64).tobytes()], "chunk": [c.astype(np.int32).tobytes()],
            "times": [times.astype(np.int32).tobytes()], "pair_ptr": [pair_ptr.astype(np.int64).tobytes()],
            "pair": [pair.astype(np.int32).tobytes()], "codes": [codes.tobytes()], "holders": [holders.tobytes()]})


def _finish(block: pd.Series, counts: pd.DataFrame) -> pd.DataFrame:
    """A block's documents, given ``code, count, best`` of its pairs."""
    read = lambda name, kind=np.int64: np.frombuffer(block[name], kind)
    codes, pair, pair_ptr = read("codes"), read("pair", np.int32), read("pair_ptr")
    order = np.argsort(counts["code"].to_numpy())
    if len(order) != len(codes) or (counts["code"].to_numpy()[order] != codes).any():
        raise ValueError("a block's pairs and their counts differ")
    n = len(block["doc_id"])
    ptr, chunk, times = read("ptr"), read("chunk", np.int32), read("times", np.int32)
    sums = {}
    for name in ("best", "count"):
        value = counts[name].to_numpy()[order].astype(np.int64)
        running = np.concatenate([[0], np.cumsum(value[pair])])
        per_chunk = running[pair_ptr[1:]] - running[pair_ptr[:-1]]
        ahead = np.concatenate([[0], np.cumsum(per_chunk[chunk] * times)])
        sums[name] = ahead[ptr[1:]] - ahead[ptr[:-1]]
    totals = read("totals").reshape(n, 4)
    return pd.DataFrame({"doc_id": pd.array([None if i is None or i != i else int(i) for i in block["doc_id"]], "Int64"),
                         "n_a": totals[:, 0], "n_b": totals[:, 1], "n_groups": totals[:, 2], "n_links": totals[:, 3],
                         "n_best": sums["best"], "count_sum": sums["count"], "groups_sha256": list(block["digests"])})


def aligned_blocks(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Documents packed in blocks, each with its chunks, its table of id pairs and their documents.

    Both files are read on the driver and broadcast; their size is that of the vocabularies.
    """
    spark = docs.sparkSession
    ship_code(spark)
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        files = spark.sparkContext.broadcast((a.read(), b.read()))
    key = f"{a_path}\n{b_path}"

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner, block = _aligner(key, files), _Block()
        made = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = [None if pd.isna(i) else int(i) for i in batch["i"]]
            texts = batch["t"].tolist()
            for lo in range(0, len(texts), 64):
                for i, numbers in zip(ids[lo:lo + 64], aligner.numbers(texts[lo:lo + 64])):
                    block.add(i, numbers, aligner)
                if block.size >= BLOCK_CHUNKS or aligner.held > MEMO_BYTES:
                    yield block.packed(made, aligner)
                    made, block = made + 1, _Block()
                    if aligner.held > MEMO_BYTES:
                        aligner.forget()
        if block.ids:
            yield block.packed(made, aligner)

    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    return rows.mapInPandas(pack, _PACKED)


def link_counts(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``block, code`` rows, and ``code, count, best`` of every id pair: documents that hold the pair linked,
    and 1 where no other pair of the same first id has more."""
    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for b, codes, holders in zip(batch["block"], batch["codes"], batch["holders"]):
                code = np.frombuffer(codes, np.int64)
                yield pd.DataFrame({"block": np.full(len(code), b), "code": code, "docs": np.frombuffer(holders, np.int64)})

    rows = blocks.select("block", "codes", "holders").mapInPandas(pairs, "block long, code long, docs long")
    counts = rows.groupBy("code").agg(F.sum("docs").alias("count"))
    # one row per first id: at most the vocabulary's size
    most = counts.groupBy(F.shiftright("code", 32).alias("a")).agg(F.max("count").alias("most"))
    counts = (counts.withColumn("a", F.shiftright("code", 32)).join(most, "a")
              .select("code", "count", (F.col("count") == F.col("most")).cast("int").alias("best")))
    return rows.select("block", "code"), counts


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` per row of ``docs``.

    ``a_path``: byte-level vocabulary file, applied to a space and the text; ``b_path``: SentencePiece model that
    adds that space itself. Links are all pairs of token occurrences whose byte ranges overlap. A pair's count is
    the number of documents (rows) that hold it; ``count_sum`` adds the counts of the document's links and
    ``n_best`` counts those no other link of the same first id exceeds, ties included.

    Null or empty texts, and texts whose bytes either tokenizer changes, have zeros and an empty digest and
    count nowhere. Null ids and repeated rows are rows like any other; other columns are not read; an empty table
    gives an empty result. A very long text is aligned whole, in memory that grows with that text alone.
    """
    blocks = scratch_table(aligned_blocks(docs, a_path, b_path, id_col, text_col), "alignment", LARGE_ROWS)
    held, counts = link_counts(blocks)
    answers = held.join(counts, "code").select("block", "code", "count", "best")

    def finish(block: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        return _finish(block.iloc[0], counts)

    kept = blocks.drop("holders")
    return kept.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(finish, _OUT)
