"""Toxicity: a learned lexicon trie met by Levenshtein automata, with scores of the words around a hit.

* Lexicon: words, and word beginnings with several endings, that mark the toxic class among labelled
  texts (binomial tail, corrected for the number of candidates).
* Matching: the trie and the Levenshtein automata of all its entries are followed together, as one
  deterministic automaton whose states (trie node, edits so far) are built when first reached. Long entries
  match with one edit, very long ones with two; word beginnings match exactly, the learned words that begin with
  them also with edits.
* Context: a hit inside quotation marks, or shortly after a word of mention, counts as quotation; other
  hits, their density and direct address count as abuse. A logistic model over these sums gives the score.
"""
from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from panelforge.llm.common import free_name, in_fold, labelled_sample, scratch_table, ship_code

#: Labelled rows per class that the lexicon and the weights are learned from (smallest id hashes).
MAX_ROWS_PER_CLASS = 6000
#: Entries of the lexicon at most (the most frequent of the significant ones).
MAX_TERMS = 4000
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
ONE_EDIT_FROM, TWO_EDITS_FROM = 5, 9
STEM_LENGTHS = (4, 5, 6)
WINDOW = 8
MEMO_LIMIT = 60_000
#: States the lazily built automaton holds before it starts anew.
STATE_LIMIT = 30_000

# Common English insults that the lexicon starts from (dropped where clean labels use them more).
SEEDS = tuple("""idiot idiots moron morons stupid imbecile cretin dimwit dumb fool loser losers pathetic worthless scum scumbag
trash garbage filth filthy vermin disgusting clown jerk bastard asshole bitch retard freak degenerate parasite""".split())
SEED_WEIGHT = 3.0
# Words that announce a mention or quotation of another word.
MENTION = frozenset("""say says said saying word words term terms called call calls quote quoted quotes wrote write
mot mots dit disait appelle wort wörter sagt sagte genannt palabra palabras dijo dice llamado""".split())
# Words of direct address.
ADDRESS = frozenset("you your youre u yourself du dich dir dein ihr euch tu te toi vous votre usted eres tú ti".split())
_WORD = re.compile(r"[^\W_]+")
_QUOTE = re.compile("[\"“”„«»]")


class TermAutomaton:
    """Deterministic automaton of trie x Levenshtein automata, built lazily.

    A state is a set of (trie node, edits); ``accept`` holds each state's best entry as (entry, edits).
    """

    def __init__(self, words: list[str], stems: list[str]):
        self.child: list[dict[str, int]] = [{}]
        self.word: list[int] = [-1]
        self.stem: list[int] = [-1]
        self.room = [0]   # most edits allowed to any word at or below a node
        self.size = len(words) + len(stems)
        self.n_words = len(words)
        for k, w in enumerate(words):
            self._insert(w, k, (len(w) >= ONE_EDIT_FROM) + (len(w) >= TWO_EDITS_FROM), self.word)
        for k, w in enumerate(stems):
            self._insert(w, len(words) + k, 0, self.stem)
        self.allowed = [(len(w) >= ONE_EDIT_FROM) + (len(w) >= TWO_EDITS_FROM) for w in words]
        self._restart()

    def _restart(self) -> None:
        """No states but the start: they are built again as words need them."""
        self.ids: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.accept: list[tuple[int, int] | None] = []
        self.start = self._state({(0, 0)})

    def _insert(self, text: str, entry: int, edits: int, mark: list[int]) -> None:
        node = 0
        self.room[0] = max(self.room[0], edits)
        for c in text:
            nxt = self.child[node].get(c)
            if nxt is None:
                nxt = self.child[node][c] = len(self.child)
                self.child.append({})
                self.word.append(-1)
                self.stem.append(-1)
                self.room.append(0)
            node = nxt
            self.room[node] = max(self.room[node], edits)
        if mark[node] < 0:
            mark[node] = entry

    def _state(self, items: set[tuple[int, int]]) -> int:
        """Id of the closure of ``items`` under skipping entry letters; -1 if nothing is left."""
        best: dict[int, int] = {}
        todo = list(items)
        while todo:
            node, e = todo.pop()
            if best.get(node, 99) <= e:
                continue
            best[node] = e
            if node >= 0 and e < self.room[node]:
                todo += [(n, e + 1) for n in self.child[node].values() if self.room[n] > e]
        if not best:
            return -1
        key = frozenset(best.items())
        found = self.ids.get(key)
        if found is None:
            found = self.ids[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
            hits = [(e, self.word[n]) for n, e in key if n >= 0 and self.word[n] >= 0 and e <= self.allowed[self.word[n]]]
            hits += [(0, -n - 1) for n, e in key if n < 0]   # a stem that has been passed
            # fewest edits first; a beginning before a word that it covers
            self.accept.append(min(hits, key=lambda h: (h[0], h[1] < self.n_words, h[1]))[::-1] if hits else None)
        return found

    def _step(self, state: int, c: str) -> int:
        items = set()
        for node, e in self.sets[state]:
            if node < 0:
                items.add((node, 0))
                continue
            nxt = self.child[node].get(c)
            if nxt is not None:
                items.add((nxt, e))
                if e == 0 and self.stem[nxt] >= 0:
                    items.add((-self.stem[nxt] - 1, 0))
            if e < self.room[node]:
                items.add((node, e + 1))                                               # a letter too many
                items.update((n, e + 1) for n in self.child[node].values() if self.room[n] > e)  # another letter
        out = self.moves[state][c] = self._state({(n, e) for n, e in items if n < 0 or e <= max(self.room[n], 0)})
        return out

    def match(self, word: str) -> tuple[int, int] | None:
        """Best entry for a word as (entry, edits), or None."""
        if len(self.sets) > STATE_LIMIT:
            self._restart()
        state, moves = self.start, self.moves
        for c in word:
            nxt = moves[state].get(c)
            state = self._step(state, c) if nxt is None else nxt
            if state < 0:
                return None
        return self.accept[state]


FEATURES = ("exact", "edited", "quoted", "densest", "rate", "addressed")
#: Bias and weights that few labels are shrunk to: hits count for abuse, quoted ones for nothing.
PRIOR_BIAS, PRIOR = -3.5, (1.6, 0.6, 0.0, 0.8, 0.4, 0.4)


class Scorer:
    """Features and score of a text under a fitted model (a plain dict)."""

    def __init__(self, model: dict):
        words, stems = model["words"], model["stems"]
        self.automaton = TermAutomaton([w for w, _ in words], [s for s, _ in stems])
        self.weight = [v for _, v in words] + [v for _, v in stems]
        self.harmless = frozenset(model.get("harmless", ()))
        self.bias, self.coef = model.get("bias", 0.0), np.array(model.get("coef", [0.0] * len(FEATURES)))
        self.memo: dict[str, tuple[int, int] | None] = {}

    def hit(self, word: str) -> tuple[int, int] | None:
        try:
            return self.memo[word]
        except KeyError:
            found = self.automaton.match(word)
            if found is not None and found[1] and word in self.harmless:
                found = None
            if len(self.memo) >= MEMO_LIMIT:
                self.memo.clear()
            self.memo[word] = found
            return found

    def hits(self, words: list[str]) -> list[tuple[int, tuple[int, int]]]:
        hit = self.hit
        seen = {w: h for w in set(words) if (h := hit(w)) is not None}
        return [(i, seen[w]) for i, w in enumerate(words) if w in seen] if seen else []

    def features(self, text: str) -> list[float]:
        low = text.lower()
        words = _WORD.findall(low)
        hits = self.hits(words)
        if not hits:
            return [0.0] * len(FEATURES)
        quoted = self._quoted(low, words, hits)
        exact = edited = mention = addressed = 0.0
        direct = []
        for (i, (entry, edits)), q in zip(hits, quoted):
            w = self.weight[entry]
            if q:
                mention += w
                continue
            direct.append((i, w * 0.5 ** edits))
            if edits:
                edited += w
            else:
                exact += w
            if not ADDRESS.isdisjoint(words[max(0, i - WINDOW):i + WINDOW + 1]):
                addressed += w
        densest = total = 0.0
        a = 0
        for i, w in direct:   # heaviest stretch of 4 windows
            total += w
            while direct[a][0] <= i - 4 * WINDOW:
                total -= direct[a][1]
                a += 1
            densest = max(densest, total)
        rate = 100.0 * len(direct) / (len(words) + 20)
        return [math.log1p(exact), math.log1p(edited), math.log1p(mention), math.log1p(densest), math.log1p(rate),
                math.log1p(addressed)]

    def _quoted(self, low: str, words: list[str], hits: list) -> list[bool]:
        """Per hit: inside quotation marks of its line, or up to 3 words after a word of mention."""
        out = [not MENTION.isdisjoint(words[max(0, i - 3):i]) for i, _ in hits]
        if _QUOTE.search(low):
            starts = [m.start() for m in _WORD.finditer(low)]
            for k, (i, _) in enumerate(hits):
                at = starts[i]
                line = low[low.rfind("\n", 0, at) + 1:at]
                out[k] = out[k] or len(_QUOTE.findall(line)) % 2 == 1 and bool(
                    _QUOTE.search(low, at, low.find("\n", at) if "\n" in low[at:] else len(low)))
        return out

    def score(self, text: str | None) -> float:
        z = self.bias + float(np.dot(self.coef, self.features(text or "")))
        return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, z))))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 50) -> tuple[float, np.ndarray]:
    """Logistic regression by Newton steps, shrunk to the prior weights."""
    a = np.hstack([np.ones((len(x), 1)), x])
    prior = np.array([PRIOR_BIAS, *PRIOR])
    w = prior.copy()
    penalty = np.diag([ridge] * a.shape[1])
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + penalty @ (w - prior)
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty + 1e-9 * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), w[1:]


def _significant(stats: list, positives: int, negatives: int, candidates: int) -> list[tuple[str, float, int]]:
    """(term, log-odds weight, positive texts) of terms whose share of toxic texts can't be chance."""
    base = (positives + 1) / (positives + negatives + 2)
    limit = math.log(max(candidates, 1)) + math.log(2)   # fewer than one false entry expected
    out = []
    for term, p, n in stats:
        share = p / (p + n)
        if share < 0.5 or share <= base:
            continue
        gain = p * math.log(share / base) + (n * math.log((1 - share) / (1 - base)) if n else 0.0)
        if gain > limit:
            out.append((term, math.log((p + 0.5) / (positives + 1)) - math.log((n + 0.5) / (negatives + 1)), p))
    return sorted(out, key=lambda t: (-t[2], t[0]))


def _beginnings(words: str, length: int):
    """The first ``length`` letters of longer words, marked by a star."""
    # one parameter a function: Spark passes the position as a second one
    return F.transform(F.filter(words, lambda w: F.length(w) > length),
                       lambda w: F.concat(F.substring(w, 1, length), F.lit("*")))


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_ROWS_PER_CLASS,
                 id_col: str = "doc_id", text_col: str = "text") -> dict:
    """Model dict from labelled, not held-out rows (at most ``max_per_class`` a class).

    Without labelled rows of both classes the lexicon is the seeds and the weights are the prior's.
    """
    ship_code(docs.sparkSession)
    sample = scratch_table(labelled_sample(docs, labels, "toxic", FOLDS, HELD_OUT, max_per_class, id_col, text_col),
                           "toxicity-sample")
    counts = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    positives, negatives = counts.get(1, 0), counts.get(0, 0)
    words = F.filter(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))),
                     lambda w: F.length(w).between(3, 30))
    stems = F.flatten(F.array(*[_beginnings("words", n) for n in STEM_LENGTHS]))
    # copies of one text count once: equal smallest hash of two following words, per class
    following = F.zip_with("words", F.slice("words", F.lit(2), F.greatest(F.size("words"), F.lit(1))),
                           lambda a, b: F.xxhash64(a, b))
    single = (sample.withColumn("words", words).withColumn("sig", F.array_min(following))
              .dropDuplicates(["y", "sig"]))
    terms = single.select("y", F.explode(F.array_distinct(F.concat("words", stems))).alias("term"))
    counted = terms.groupBy("term").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n"))
    stats = counted.filter("p >= 3")
    candidates = stats.count()
    rows = [tuple(r) for r in stats.filter("p > n").orderBy(F.desc("p"), "term").limit(10 * MAX_TERMS).collect()]
    found = _significant(rows, positives, negatives, candidates)
    stems_found = [(t[:-1], w) for t, w, _ in found if t.endswith("*")]
    kept_stems: list[tuple[str, float]] = []
    spread = defaultdict(int)   # significant words per beginning: a stem needs several endings
    for t, _, _ in found:
        if not t.endswith("*"):
            for n in STEM_LENGTHS:
                spread[t[:n]] += len(t) > n
    for s, w in sorted(stems_found, key=lambda x: (len(x[0]), x[0])):
        if spread[s] != 1 and not any(s.startswith(k) for k, _ in kept_stems):
            kept_stems.append((s, w))
    heads = tuple(s for s, _ in kept_stems)
    whole = [(t, w) for t, w, _ in found if not t.endswith("*")]
    covered = [(t, w) for t, w in whole if t.startswith(heads or ("\0",))]   # match exactly by a beginning, else with edits
    model = {"words": [x for x in whole if not x[0].startswith(heads or ("\0",))][:MAX_TERMS] + covered,
             "stems": kept_stems[:MAX_TERMS], "rows": (positives, negatives)}
    learned = {t for t, _ in model["words"]}
    known = {r["term"]: (r["p"], r["n"]) for r in counted.filter(F.col("term").isin(*SEEDS)).collect()}
    for seed in SEEDS:
        p, n = known.get(seed, (0, 0))
        if seed not in learned and p >= n:
            model["words"].append((seed, SEED_WEIGHT))
    if not positives or not negatives:
        return model | {"bias": PRIOR_BIAS, "coef": list(PRIOR)}
    # edited forms that clean texts use are words of their own
    clean_words = terms.filter("term not like '%*'").groupBy("term").agg(
        F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n")).filter("n > 0 and n * 20 > p")

    @pandas_udf("boolean")
    def edited(words: pd.Series) -> pd.Series:
        s = Scorer(model)
        return pd.Series([bool((h := s.hit(w)) and h[1]) for w in words], dtype=bool)

    model["harmless"] = [r["term"] for r in clean_words.filter(edited("term")).select("term").collect()]

    @pandas_udf("array<double>")
    def featurise(texts: pd.Series) -> pd.Series:
        s = Scorer(model)
        return pd.Series([s.features(t) for t in texts])

    fitted = sample.select("y", featurise("text").alias("x")).collect()   # at most 2 * max_per_class short rows
    x = np.array([r["x"] for r in fitted]).reshape(-1, len(FEATURES))
    y = np.array([r["y"] for r in fitted], dtype=float)
    bias, coef = fit_logistic(x, y)
    return model | {"bias": bias, "coef": coef.tolist()}


def toxicity_score(text, model: dict):
    """Score column (0 to 1) of whole texts; null counts as empty."""
    @pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        s = _scorer(model)
        return pd.Series([s.score(t) for t in texts], dtype="float64")
    return score(text)


_SCORERS: dict[str, Scorer] = {}


def _scorer(model: dict) -> Scorer:
    """The worker's scorer of a model; its automaton and memo live across batches and tasks."""
    key = repr((model["bias"], model["coef"], len(model["words"]), len(model["stems"]), model["words"][:3]))
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(model)
    return _SCORERS[key]


def score_toxicity(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``.

    Null and empty texts get the score of a text without hits. Null ids are not held out. One row per
    input row; an empty table gives an empty result; only the text is an input of the score.
    """
    ship_code(docs.sparkSession)
    return (docs.select(F.col(id_col).alias("doc_id"), in_fold(F.col(id_col), FOLDS, HELD_OUT).alias("held_out"),
                        toxicity_score(F.col(text_col), model).alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def drop_toxic(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below the threshold, columns unchanged."""
    ship_code(docs.sparkSession)
    toxic = free_name(docs, "toxic")
    return (docs.withColumn(toxic, toxicity_score(F.col(text_col), model))
            .filter(F.col(toxic) < THRESHOLD).drop(toxic))
