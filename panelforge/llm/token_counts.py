"""Token counts by heap-and-linked-list byte-pair merging, without emitting identifiers.

The count of a text is its initial symbols minus the merges made. Merging repeatedly pops the adjacent
pair with the lowest rank (ties: leftmost) from a heap; symbols form a linked list over the characters.
"""
from __future__ import annotations

import re
from heapq import heapify, heappop, heappush
from operator import add

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

SPACE = "▁"  # the piece files' mark for a space
#: Segment counts remembered in each of the two generations of a Python worker's memo.
MEMO_LIMIT = 200_000
_SEGMENTS = re.compile(r" *[^ \n]+| +|\n")
_UNEVEN = re.compile(r"  |\n | \n|^ | \Z")


def load_ranks(path: str) -> dict[str, int]:
    """Merge ranks (0 = first) of the normal pieces of a SentencePiece BPE model file."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [(-model.get_score(i), i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    order = {score: rank for rank, score in enumerate(sorted({s for s, _ in pieces}))}
    ranks = {model.id_to_piece(i): order[score] for score, i in pieces}
    if any("\n" in p or re.search(f"[^{SPACE}]{SPACE}", p) for p in ranks):
        raise ValueError("pieces that cross a space or a line end are not supported")
    return ranks


class PairMerger(dict):
    """Memo of word -> token count, the space before the word included; merged when it is missing.

    A word at the start of a line is looked up with the line end instead of a space before it.

    The memo has two generations of at most ``MEMO_LIMIT`` segments, so it is bounded and yet keeps
    the segments that come again and again.
    """

    def __init__(self, ranks: dict[str, int]):
        super().__init__()
        self.ranks = ranks
        self.symbols = frozenset(p for p in ranks if len(p) == 1)
        self.older: dict[str, int] = {}

    def __missing__(self, segment: str) -> int:
        n = self.older.get(segment)
        if n is None:
            n = self.merge(segment if segment[:1] == "\n" else SPACE + segment)
        if len(self) >= MEMO_LIMIT:
            self.older = dict(self)
            self.clear()
        self[segment] = n
        return n

    def merge(self, s: str) -> int:
        """Initial symbols minus merges; a character without a piece stands as its UTF-8 bytes."""
        rank, n = self.ranks.get, len(s)
        tokens, extra = n, {}
        if not self.symbols.issuperset(s):
            extra = {i: len(c.encode("utf-8", "surrogatepass")) - 1 for i, c in enumerate(s) if c not in self.symbols}
            tokens += sum(extra.values())
        # a heap entry packs (rank, where the left symbol starts, where the right symbol ends)
        bits = 21 if n < 1 << 21 else 40
        low = (1 << bits) - 1
        heap = [(r << bits | i) << bits | i + 2 for i, pair in enumerate(map(add, s, s[1:]))
                if (r := rank(pair)) is not None]
        if not heap:
            return tokens
        heapify(heap)
        end = list(range(1, n + 1))   # end[i]: where the symbol that starts at i ends; 0 once merged away
        before = list(range(-1, n))   # before[i]: start of the symbol left of the one that starts at i
        while heap:
            entry = heappop(heap)
            stop, left = entry & low, entry >> bits & low
            mid = end[left]
            if not mid or mid >= n or end[mid] != stop:
                continue  # one of the two symbols has changed since
            tokens -= 1
            if extra:
                tokens -= (extra.pop(left, 0) if mid == left + 1 else 0)
                tokens -= (extra.pop(mid, 0) if stop == mid + 1 else 0)
            end[left], end[mid] = stop, 0
            before[stop] = left
            if stop < n:
                after = end[stop]
                if (r := rank(s[left:after])) is not None:
                    heappush(heap, (r << bits | left) << bits | after)
            if left:
                prior = before[left]
                if (r := rank(s[prior:stop])) is not None:
                    heappush(heap, (r << bits | prior) << bits | stop)
        return tokens

    def count(self, text: str | None) -> int:
        """Tokens of a whole text; a leading space is assumed, as the piece files do."""
        if not text:
            return 0
        text = text.replace(SPACE, " ")
        if not _UNEVEN.search(text):
            return sum(map(self.__getitem__, text.replace("\n", " \n").split(" ")))
        return sum(map(self._segment, _SEGMENTS.findall(" " + text)))

    def _segment(self, segment: str) -> int:
        """One segment of a text with runs of spaces or spaces at line ends."""
        word = segment.lstrip(" ")
        spaces = len(segment) - len(word)
        if not spaces:
            return 1 if word == "\n" else self["\n" + word] - 1
        return self[word] if word and spaces == 1 else self.merge(SPACE * spaces + word)


_MERGERS: dict[str, PairMerger] = {}


def _merger(key: str, ranks: dict[str, int]) -> PairMerger:
    """The worker's merger: its memo lives across batches and tasks of a reused worker."""
    if key not in _MERGERS:
        _MERGERS[key] = PairMerger(ranks)
    return _MERGERS[key]


def token_count(text: Column, spark, model_path: str) -> Column:
    """Column of token counts under the model at ``model_path`` (read on the driver only).

    The ranks are broadcast: their size is that of the vocabulary, whatever the data.
    """
    shared = spark.sparkContext.broadcast(load_ranks(model_path))

    @pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        merger = _merger(model_path, shared.value)
        return pd.Series([merger.count(t) for t in texts], dtype="int64")

    return count(text)


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row of ``docs``.

    A null or empty text has 0 bytes and 0 tokens; null ids, repeated rows and other columns are left
    as they are (one output row per input row); an empty table gives an empty result. Very long texts
    are counted whole: merging never crosses a space or line end, so its memory is that of one segment.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"),
                        token_count(text, docs.sparkSession, model_path).alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
