"""SentencePiece encoding and decoding by batched numpy Viterbi.

The words of a batch are grouped by length; all words of one length advance together, one end position at a
time. Substrings are rolling 64-bit hashes looked up in the sorted hashes of the pieces, and the best last
piece per position is a vectorised maximum that leaves a backpointer.

The piece file at hand holds merge ranks in the place of log-probabilities, so the score of a piece is taken
from Zipf's law for its rank, -log(rank + 2). The segmentation is the one of highest total score; it is not
the merge order's (``token_counts`` counts that one).
"""
from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

SPACE = "▁"
MEMO_LIMIT = 60_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_TOP = np.uint64(44)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_SEGMENTS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
UNKNOWN_PENALTY = 10.0


def load_pieces(path: str) -> dict:
    """Pieces of a SentencePiece model as plain data: normal pieces with ids and scores, byte ids."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    normal, byte_ids = [], [-1] * 256
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:-1], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            normal.append((piece, i, -model.get_score(i)))
    rank = {s: r for r, s in enumerate(sorted({s for _, _, s in normal}))}
    return {"pieces": [p for p, _, _ in normal], "ids": [i for _, i, _ in normal],
            "scores": [-float(np.log(rank[s] + 2)) for _, _, s in normal], "bytes": byte_ids,
            "all": [model.id_to_piece(i) for i in range(model.get_piece_size())]}


def _prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """Rolling hash of every prefix: column k is the hash of the first k characters."""
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * _MIX
    mixed ^= mixed >> np.uint64(29)
    for k in range(codes.shape[1]):
        out[:, k + 1] = out[:, k] * _BASE + mixed[:, k]
    return out


def _codes(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), length)


class Viterbi:
    """Best segmentations of segments under a piece table (``load_pieces``)."""

    def __init__(self, table: dict):
        self.pieces = table["pieces"]
        self.ids = np.array(table["ids"], np.int64)
        scores = np.array(table["scores"])
        self.bytes = table["bytes"]
        self.longest = max(map(len, self.pieces), default=1)
        #: an unknown character costs more than any piece
        self.unknown = float(scores.min(initial=0.0)) - UNKNOWN_PENALTY
        self.power = np.ones(self.longest + 1, np.uint64)
        for k in range(self.longest):
            self.power[k + 1:k + 2] = self.power[k:k + 1] * _BASE
        self.codes = np.zeros((len(self.pieces) + 1, self.longest), np.uint32)   # right-aligned characters
        for k, p in enumerate(self.pieces):
            self.codes[k, self.longest - len(p):] = _codes([p], len(p))[0]
        self.score_of = {p: (float(s), int(i)) for p, s, i in zip(self.pieces, scores, self.ids)}
        self.present = np.zeros(1 << 20, bool)   # leading bits of all piece hashes
        self.by_length = {}   # piece length -> (sorted hashes, their scores, their piece numbers)
        for n in sorted({len(p) for p in self.pieces}):
            own = [k for k, p in enumerate(self.pieces) if len(p) == n]
            h = _prefix_hashes(_codes([self.pieces[k] for k in own], n))[:, n]
            order = np.argsort(h)
            self.present[(h >> _TOP).astype(np.int64)] = True
            if len(np.unique(h)) != len(h):
                raise ValueError("piece hashes collide")
            self.by_length[n] = (h[order], scores[own][order], np.array(own)[order])
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def solve(self, words: list[str], length: int) -> list[bytes]:
        """Ids (int32 bytes) of equally long words. Equal scores: the shorter last piece wins."""
        codes = _codes(words, length)
        prefix = _prefix_hashes(codes)
        best = np.full((length + 1, len(words)), -np.inf)
        best[0] = 0.0
        back = np.zeros((length + 1, len(words)), np.int32)    # length of the best last piece
        piece = np.full((length + 1, len(words)), -1, np.int32)
        for end in range(1, length + 1):
            top, size, number = best[end - 1] + self.unknown, back[end], piece[end]
            size[:] = 1
            for n, (keys, scores, numbers) in self.by_length.items():
                if n > end:
                    break
                h = prefix[:, end] - prefix[:, end - n] * self.power[n]
                hit = np.flatnonzero(self.present[(h >> _TOP).astype(np.int64)])   # most substrings are no piece
                at = np.searchsorted(keys, h[hit])
                at[at == len(keys)] = 0
                real = keys[at] == h[hit]
                hit, at = hit[real], at[real]
                total = best[end - n, hit] + scores[at]
                better = total > top[hit]
                hit, at = hit[better], at[better]
                top[hit], size[hit], number[hit] = total[better], n, numbers[at]
            best[end] = top
        # walk the backpointers of all words at once, checking every chosen piece character by character
        ids = np.zeros((len(words), length), np.int32)
        first = np.full(len(words), length)
        end = np.full(len(words), length)
        alone = np.zeros(len(words), bool)    # words with byte pieces, or with a wrong hash match
        padded = np.zeros((len(words), self.longest + length), np.uint32)
        padded[:, self.longest:] = codes
        column = np.arange(self.longest)
        live = np.arange(len(words))
        while len(live):
            e = end[live]
            n, k = back[e, live], piece[e, live]
            same = (padded[live[:, None], e[:, None] + column] == self.codes[k]) | (column < (self.longest - n)[:, None])
            alone[live] |= (k < 0) | ~same.all(axis=1)
            first[live] -= 1
            ids[live, first[live]] = self.ids[np.maximum(k, 0)]
            end[live] -= n
            live = live[end[live] > 0]
        return [self.solve_alone(w) if one else row[f:].tobytes()
                for w, one, row, f in zip(words, alone.tolist(), ids, first.tolist())]

    def solve_alone(self, word: str) -> bytes:
        """The same for one word by plain dynamic programming; unknown characters become byte pieces."""
        best: list[tuple[float, int, list[int]]] = [(0.0, 0, [])]
        for end in range(1, len(word) + 1):
            raw = [self.bytes[b] for b in word[end - 1].encode("utf-8", "surrogatepass")]
            found = (best[end - 1][0] + self.unknown, end - 1, raw)
            for n in range(1, min(self.longest, end) + 1):
                hit = self.score_of.get(word[end - n:end])
                if hit and best[end - n][0] + hit[0] > found[0]:
                    found = (best[end - n][0] + hit[0], end - n, [hit[1]])
            best.append(found)
        parts, end = [], len(word)
        while end:
            parts.append(best[end][2])
            end = best[end][1]
        return np.array([i for part in reversed(parts) for i in part], np.int32).tobytes()

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Piece ids (int32) of each text; segments new to the memo are solved together, by length."""
        split = [_SEGMENTS.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        memo, missing = self.memo, {}
        for segment in set().union(*split):
            if segment not in memo:
                ids = self.older.get(segment)
                if ids is None:
                    missing.setdefault(len(segment), []).append(segment)
                else:
                    memo[segment] = ids
        for length, words in missing.items():
            step = max(1, 500_000 // (length + self.longest))   # bounds the matrices
            for a in range(0, len(words), step):
                memo.update(zip(words[a:a + step], self.solve(words[a:a + step], length)))
        out = [np.frombuffer(b"".join(map(memo.__getitem__, segments)), np.int32) for segments in split]
        if len(memo) > MEMO_LIMIT:
            self.older, self.memo = memo, {}
        return out


class Codec:
    """A worker's encoder and decoder of one piece table."""

    def __init__(self, table: dict):
        self.viterbi = Viterbi(table)
        byte_of = {i: bytes([b]) for b, i in enumerate(table["bytes"]) if i >= 0}
        self.raw = [byte_of.get(i, p.encode("utf-8")) for i, p in enumerate(table["all"])]

    def decode(self, ids: list[int]) -> str:
        """Bytes joined, space marks to spaces, the assumed first space removed."""
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "surrogatepass").replace(SPACE, " ")
        return text[1:] if text[:1] == " " else text


_CODECS: dict[str, Codec] = {}


def _codec(key: str, table: dict) -> Codec:
    if key not in _CODECS:
        _CODECS[key] = Codec(table)
    return _CODECS[key]


def encode_documents(docs: DataFrame, model_path: str, text_col: str = "text", out_col: str = "pieces") -> DataFrame:
    """``docs`` with an ``array<int>`` column of piece ids.

    A null or empty text has no pieces; all other columns and rows stay (an ``out_col`` already there is
    replaced). The piece table is read on the driver and broadcast: its size is the vocabulary's. Texts
    are encoded whole; space marks in a text count as spaces, as the format has it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_pieces(model_path))

    @pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        return pd.Series(_codec(model_path, shared.value).viterbi.encode(texts.tolist()), dtype=object)

    return docs.withColumn(out_col, encode(F.coalesce(F.col(text_col), F.lit(""))))


def decode_documents(encoded: DataFrame, model_path: str, ids_col: str = "pieces", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its piece ids; null ids give an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(load_pieces(model_path))

    @pandas_udf("string")
    def text_of(ids: pd.Series) -> pd.Series:
        codec = _codec(model_path, shared.value)
        return pd.Series(["" if i is None else codec.decode(i.tolist()) for i in ids], dtype=object)

    return encoded.withColumn(out_col, text_of(ids_col))


def encoded_digest(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_pieces, ids_sha256, round_trip`` per row: encoded, decoded again and compared.

    ``ids_sha256`` is the hash of the ids as little-endian 32-bit integers. ``round_trip`` compares the decoded text with
    the text (null: empty) after space marks in it became spaces. Encoding and decoding share one pass
    over the text, so the ids never leave the worker.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_pieces(model_path))

    @pandas_udf("n_pieces long, ids_sha256 string, round_trip boolean")
    def digest(texts: pd.Series) -> pd.DataFrame:
        codec = _codec(model_path, shared.value)
        rows = []
        texts = texts.tolist()
        for a in range(0, len(texts), 200):
            for t, ids in zip(texts[a:a + 200], codec.viterbi.encode(texts[a:a + 200])):
                rows.append((len(ids), hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest(),
                             codec.decode(ids.tolist()) == t.replace(SPACE, " ")))
        return pd.DataFrame(rows, columns=["n_pieces", "ids_sha256", "round_trip"])

    out = docs.select(F.col(id_col).alias("doc_id"), digest(F.coalesce(F.col(text_col), F.lit(""))).alias("d"))
    return out.select("doc_id", "d.n_pieces", "d.ids_sha256", "d.round_trip")
