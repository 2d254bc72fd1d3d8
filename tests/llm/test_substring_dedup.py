"""Repeated word windows against a dictionary of all windows."""
import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from panelforge.llm import substring_dedup as dedup

DOCS = "doc_id long, text string, k1 string, name string, copies int, digest string"


def reference(rows):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    seen = Counter(tuple(w[k:k + 35]) for _, w in words for k in range(len(w) - 34))
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - 34):
            if seen[tuple(w[k:k + 35])] > 1:
                gone.update(range(k, k + 35))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def removed(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", "y", 1, "z") for i, t in rows], DOCS).repartition(4)
    return sorted(map(tuple, dedup.remove_repeats(docs).collect()), key=str)


def passages(seed, vocabulary, texts, gap=" "):
    """Texts made of fresh words, copied passages of about the window's length, runs and periods."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(vocabulary)]
    shared = [rng.choices(words, k=rng.choice([30, 34, 35, 36, 40, 55, 90, 200])) for _ in range(8)]
    rows = []
    for i in range(texts):
        out = []
        for _ in range(rng.randint(0, 6)):
            kind = rng.random()
            if kind < 0.4:
                out += rng.choices(words, k=rng.randint(1, 60))
            elif kind < 0.7:
                p = rng.choice(shared)
                cut = rng.randint(0, max(0, len(p) - 34))
                out += p[cut:cut + rng.choice([34, 35, 36, 60])]
            elif kind < 0.8:
                out += [rng.choice(words)] * rng.choice([2, 20, 33, 36, 80])
            elif kind < 0.9:
                out += rng.choices(words, k=rng.choice([2, 3, 5])) * rng.choice([4, 9, 20])
            elif rows:
                out += (rows[rng.randrange(len(rows))][1] or "").split()
        rows.append((i, gap.join(out)))
    return rows


@pytest.mark.parametrize("seed,vocabulary,texts", [(1, 3000, 60), (2, 4, 60), (3, 200, 150)])
def test_removed_words_equal_brute_force(spark, seed, vocabulary, texts):
    rows = passages(seed, vocabulary, texts)
    assert removed(spark, rows) == reference(rows)


def test_odd_texts(spark):
    long = " ".join(f"x{k % 977}y{k % 13}" for k in range(20_000))
    base = passages(7, 500, 30, "  \n\t")
    wide = " ".join(["ünïcode word", "日本語", " x", "é", "a\x1cb"] * 9)
    rows = base + [(100, None), (101, ""), (102, " \n "), (None, base[4][1]), (4, base[4][1]), (4, base[4][1]),
                   (103, long), (104, wide), (105, "lead " + wide.replace(" ", "\x0b")), (106, " ".join(["same"] * 34)),
                   (107, " ".join(["same"] * 35)), (108, "one"), (109, " ".join(["same"] * 34) + " other")]
    assert removed(spark, rows) == reference(rows)
    assert removed(spark, []) == []


def test_hot_groups_are_dealt_out_without_loss(spark, monkeypatch):
    monkeypatch.setattr(dedup, "HOT_SHARE", 4)
    monkeypatch.setattr(dedup, "SALTS", 3)
    rng = random.Random(9)
    passage = [f"p{k}" for k in range(38)]
    rows = [(i, " ".join([f"a{i}"] * (i % 3) + passage + [f"b{i}c{k}" for k in range(i % 40)])) for i in range(90)]
    rows += [(1000 + i, " ".join(f"q{k}" for k in range(70))) for i in range(60)]
    rng.shuffle(rows)
    assert removed(spark, rows) == reference(rows)


def test_equal_windows_have_equal_anchors():
    """Wherever a window stands, its anchor is at the same place in it, and most have a symbol for one."""
    rng = np.random.default_rng(4)
    window = rng.integers(0, 1 << 64, 35, dtype=np.uint64)
    places = set()
    for k in range(50):
        left, right = (rng.choice(window, rng.integers(0, 50)) for _ in range(2))
        names = np.concatenate([left, window, right])
        at, low, high = dedup.anchored_windows(names, np.array([0, len(names)]))
        row = np.flatnonzero(at == len(left))[0]
        places.add((low[row] - len(left), high[row] - len(left)))
    assert len(places) == 1 and all(0 <= a < b <= 35 for a, b in places)
    names = rng.integers(0, 1 << 64, 20_000, dtype=np.uint64)
    at, low, high = dedup.anchored_windows(names, np.array([0, 7000, 7010, 20_000]))
    assert ((low >= at) & (high <= at + 35)).all() and (high - low < 35).mean() > 0.95
    assert len(set(low.tolist())) < len(at) / 6   # neighbouring windows share anchors


def test_range_hashes_and_words():
    own = dedup.RangeHash(1)
    values = np.tile(np.random.default_rng(0).integers(0, 1 << 64, 50, dtype=np.uint64), 3)
    sums = own.sums(values)
    a = own.ranges(sums, np.arange(0, 60), np.arange(0, 60) + 20)
    assert (a[:50] == own.ranges(sums, np.arange(50, 100), np.arange(50, 100) + 20)).all() and len(set(a.tolist())) == 50
    texts = [b"a bb", b"", b" c\n", b"d", b"\te f "]
    offsets = np.cumsum([0] + [len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    start, end, bounds = dedup.words_of(data, offsets)
    assert [data[s:e].tobytes() for s, e in zip(start, end)] == [w for t in texts for w in t.split()]
    assert np.diff(bounds).tolist() == [len(t.split()) for t in texts]
