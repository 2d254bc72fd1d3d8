"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a text become integer bins; trees grow on gradient histograms per bin. The fitted trees are
flattened into arrays and a batch of rows walks all trees at once with numpy gathers.
"""
from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from panelforge.llm.common import in_fold, labelled_sample

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
#: Labelled rows per class that the trees are fitted on (smallest id hashes).
MAX_ROWS_PER_CLASS = 8000

# Frequent function words (English, French, German, Spanish).
STOP_WORDS = frozenset("""the of and to in a is that for it was on with as be by this are at or an from
de la le les et des du en un une que est pour dans qui sur pas au par avec
der die und den das von zu mit sich ist auf für im dem nicht ein eine als
el los del se y las por una con no al lo su""".split())
FEATURES = ("words", "word_length", "word_length_sd", "distinct", "top_word", "repeats", "symbol_words", "upper",
            "digits", "punctuation", "lines", "line_words", "repeated_lines", "sentence_ends", "stop_words",
            "compression", "bars", "longest_word", "letters", "closing")
_SYMBOL = re.compile(r"[#$%&*@^~=<>{}\\|]")
_SYMBOL_WORD = re.compile(r"[^\s#$%&*@^~=<>{}\\|]*[#$%&*@^~=<>{}\\|]\S*")
_DIGITS = re.compile(r"[0-9]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_PUNCT = re.compile(r"[.,;:!?'\"()\-]")
_END = re.compile(r"[.!?](?=\s|\Z)")


def statistics(text: str | None) -> list[float]:
    """The statistics named in ``FEATURES``; all but a few are shares, so length alone decides little."""
    text = text or ""
    words = text.lower().split()
    n, chars = len(words), len(text)
    if not n:
        return [0.0] * len(FEATURES)
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=n)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    symbols = len(_SYMBOL_WORD.findall(text)) if _SYMBOL.search(text) else 0
    raw = text.encode("utf-8", "surrogatepass")
    return [
        math.log1p(n), float(lengths.mean()), float(lengths.std()), len(counts) / n, max(counts.values()) / n,
        sum(map(str.__eq__, words, words[1:])) / n, symbols / n, len(_UPPER.findall(text)) / n,
        len(_DIGITS.findall(text)) / n, len(_PUNCT.findall(text)) / n, math.log1p(len(lines)),
        n / max(len(lines), 1), 1.0 - len(set(lines)) / max(len(lines), 1), len(_END.findall(text)) / n,
        sum(counts[w] for w in STOP_WORDS if w in counts) / n, len(zlib.compress(raw, 1)) / len(raw),
        text.count("|") / n, float(lengths.max()), float(lengths.sum()) / chars, float(text.rstrip()[-1:] in ".!?"),
    ]


def _bin(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
              ridge: float = 1.0, min_rows: int = 10) -> dict:
    """Boosted trees for the logistic loss, as flat arrays (see ``predict``).

    Every tree is a complete binary tree of ``depth`` levels stored level by level: node k has the
    children 2k+1 and 2k+2; a node that can't be split sends all rows to the left (threshold infinity).
    """
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = _bin(x, edges)
    flat = binned + np.arange(width) * bins
    inner = 2 ** depth - 1
    feature, threshold = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    value = np.zeros((trees, inner + 1))
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    bias = math.log(share / (1 - share))
    margin = np.full(n, bias)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2 ** level - 1, 2 ** level
            cell = ((node - first)[:, None] * (width * bins) + flat).ravel()
            shape = (count, width, bins)
            sums = [np.bincount(cell, np.repeat(v, width), count * width * bins).reshape(shape).cumsum(2)
                    for v in (g, h, np.ones(n))]
            (gl, hl, nl), (ga, ha, na) = sums, [s[:, :, -1:] for s in sums]
            gain = gl ** 2 / (hl + ridge) + (ga - gl) ** 2 / (ha - hl + ridge) - ga ** 2 / (ha + ridge)
            gain[(nl < min_rows) | (na - nl < min_rows)] = -np.inf
            for k in range(count):
                j, b = divmod(int(gain[k].argmax()), bins)
                if gain[k, j, b] > 1e-6 and b < len(edges[j]):
                    feature[t, first + k], threshold[t, first + k] = j, edges[j][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        leaf = node - inner
        value[t] = -rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge)
        margin += value[t][leaf]
    return {"bias": bias, "depth": depth, "feature": feature, "threshold": threshold, "value": value}


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    """Scores of rows: all rows walk all trees together, one gather per level."""
    feature, threshold, value = model["feature"], model["threshold"], model["value"]
    if not len(x):
        return np.zeros(0)
    tree = np.arange(len(feature))[None, :]
    row = np.arange(len(x))[:, None]
    node = np.zeros((len(x), len(feature)), np.int64)
    for _ in range(model["depth"]):
        node = 2 * node + 1 + (x[row, feature[tree, node]] > threshold[tree, node])
    margin = model["bias"] + value[tree, node - feature.shape[1]].sum(axis=1)
    return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def fit_quality(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_ROWS_PER_CLASS,
                id_col: str = "doc_id", text_col: str = "text", **options) -> dict:
    """Trees from labelled, not held-out rows: at most ``max_per_class`` short statistics rows a class
    come to the driver. Without rows of both classes the model is a constant."""
    @pandas_udf("array<double>")
    def measure(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts])

    sample = labelled_sample(docs, labels, "quality", FOLDS, HELD_OUT, max_per_class, id_col, text_col)
    rows = sample.select("y", measure("text").alias("x")).collect()
    rows.sort(key=lambda r: (r["y"], r["x"]))   # the same model whatever order the rows come in
    x = np.array([r["x"] for r in rows], dtype=float).reshape(-1, len(FEATURES))
    y = np.array([r["y"] for r in rows], dtype=float)
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 0.5) / (len(y) + 1.0)
        return {"bias": math.log(share / (1 - share)), "depth": 0, "feature": np.zeros((1, 0), np.int64),
                "threshold": np.zeros((1, 0)), "value": np.zeros((1, 1))}
    return fit_trees(x, y, **options)


def score_quality(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``.

    Null and empty texts have all statistics 0 and are scored like any other row. Null ids are not held
    out. One row per input row; an empty table gives an empty result; only the text is an input.
    """
    @pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(predict(model, np.array([statistics(t) for t in texts]).reshape(-1, len(FEATURES))))

    return (docs.select(F.col(id_col).alias("doc_id"), in_fold(F.col(id_col), FOLDS, HELD_OUT).alias("held_out"),
                        score(F.col(text_col)).alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))
