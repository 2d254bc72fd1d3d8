"""Operators over whole tables: vectors, joins, mixing, components, pipeline; against brute force."""
import random

import numpy as np
import pytest

from panelforge.llm import components as comp
from panelforge.llm import embedding_dedup, jaccard, mixing, topk

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, rep long"
VECTORS = "vec_id long, embedding array<float>, label int, score long, v string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t) if t else None, 7, 7) for i, t, s in rows], DOCS)


def union_find(ids, links):
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_components_of_paths_and_stars(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(60)] + [(200, i) for i in range(201, 300)] + [
        (rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(60)] + [(7, 7)]
    got = {r.id: r.component for r in comp.components(spark.createDataFrame(links, "a long, b long")).collect()}
    ids = {i for l in links for i in l}
    assert got == {i: c for i, c in union_find(ids, links).items() if i in got} and len(got) >= len(ids) - 1
    assert comp.components(spark.createDataFrame([], "a long, b long")).count() == 0


def sets_of(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def jaccard_reference(rows):
    sets = [(i, sets_of(t)) for i, t, _ in rows if i is not None]
    links = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k]
             if x and y and 100 * len(x & y) >= 75 * len(x | y)]
    return union_find({i for i, _ in sets}, links)


def near_copy_rows():
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    passage = rng.choices(words, k=60)
    rows, i = [], 0
    for _ in range(12):
        base = rng.choices(words, k=rng.choice([4, 7, 30, 120, 400]))
        for _ in range(rng.randint(1, 14)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            if rng.random() < 0.3:
                copy += passage
            rows.append((i, " ".join(copy), "s"))
            i += 1
    rows += [(i + 1, rows[0][1], "s"), (i + 2, rows[0][1].upper(), "s"), (i + 3, None, "s"), (i + 4, " \n", "s"), (i + 5, "", "s"),
             (i + 6, "one", "s"), (i + 7, "ONE", "s"), (None, rows[0][1], "s"), (2, rows[2][1], "s")]
    return rows


def test_jaccard_join_equals_brute_force(spark):
    rows = near_copy_rows()
    out = jaccard.near_documents(docs_of(spark, rows)).collect()
    expected = jaccard_reference(rows)
    assert len(out) == len(rows)
    for r in out:
        assert r.component_id == expected.get(r.doc_id)
    sizes = {(i, len(sets_of(t))) for i, t, _ in rows}
    assert {(r.doc_id, r.n_shingles) for r in out} == sizes
    kept = jaccard.one_per_group(docs_of(spark, rows))
    assert {r.doc_id for r in kept.collect()} == {None} | {i for i, c in expected.items() if i == c}
    assert kept.columns == docs_of(spark, []).columns
    assert jaccard.near_documents(docs_of(spark, [])).count() == 0


def test_jaccard_join_with_small_blocks_and_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    rows = near_copy_rows()[:80]
    out = {r.doc_id: r.component_id for r in jaccard.near_documents(docs_of(spark, rows)).collect()}
    assert out == jaccard_reference(rows)


def test_only_sets_that_repeat_move_with_their_keys(spark):
    rows = [(i, bytes([i % 90]), 3, [i % 90, 5]) for i in range(100)] + [(100, bytes([99]), 4, [1])]
    named = spark.createDataFrame(rows, "doc_id long, sig binary, n long, keys array<long>")
    alone, repeated = jaccard.alone_and_repeated(named)
    assert {r.doc_id for r in alone.collect()} == {*range(10, 90), 100}
    assert {r.doc_id for r in repeated.collect()} == {*range(10), *range(90, 100)}
    moved = [line for line in alone._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert not moved
    found = {(r.rep, r.n, tuple(r.keys)) for r in jaccard.one_per_set(named).collect()}
    assert found == {(i, 3, (i, 5)) for i in range(90)} | {(100, 4, (1,))}


def test_overlap_bound_never_too_low():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(1, 300))
        pool = rng.integers(0, 2 ** 63, n * 2).astype(np.uint64)
        x, y = np.unique(rng.choice(pool, n)), np.unique(rng.choice(pool, max(1, n - int(rng.integers(0, 9)))))
        (a, ea), (b, eb) = jaccard.unpack_counts([jaccard.group_counts(x)]), jaccard.unpack_counts([jaccard.group_counts(y)])
        g = min(a.shape[1], b.shape[1])
        over = min(ea[0], eb[0]) if a.shape == b.shape else ea[0] + eb[0]
        bound = jaccard.overlap_bound(jaccard.fold(a, g), jaccard.fold(b, g))[0, 0] + over
        assert bound >= len(np.intersect1d(x, y))
        small, large = jaccard.prefixes(len(x)), jaccard.prefixes(len(y))
        if 100 * len(np.intersect1d(x, y)) >= 75 * len(np.union1d(x, y)):
            p, q = (small[0], large[1]) if len(x) <= len(y) else (small[1], large[0])
            assert len(np.intersect1d(x[:p], y[:q]))


def vector_rows(rng, n=240, dim=16):
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            v = np.array(rows[int(rng.integers(len(rows)))][1]) + rng.normal(0, rng.choice([0.02, 0.06, 0.1]), dim)
        else:
            v = rng.standard_normal(dim)
        rows.append((i, v.astype(np.float32).tolist(), int(rng.integers(2))))
    return rows


BAD_VECTORS = [(1000, None, 0), (1001, [0.0] * 16, 0), (1002, [float("nan")] * 16, 0), (1003, [None] * 16, 0),
               (1004, [float("inf")] * 16, 1), (1005, [1.0] * 16, None), (1006, [1.0] * 3, 0), (1007, [2.0] * 3, 0), (1008, [], 0)]


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, l, 3, "x") for i, v, l in rows], VECTORS)


def test_embedding_links_equal_brute_force(spark):
    rows = vector_rows(np.random.default_rng(8))
    unit = {i: np.array(v, float) / np.linalg.norm(np.array(v, float)) for i, v, _ in rows}
    links = [(a, b) for a, _, x in rows for b, _, y in rows if a < b and x == y and unit[a] @ unit[b] >= 0.93]
    count = {i: sum(i in l for l in links) for i in unit}
    roots = union_find(set(unit), links)
    df = vectors_of(spark, rows + rows[:3] + BAD_VECTORS + [(None, [1.0] * 16, 0)])
    for block in (1024, 4):
        out = {r.vec_id: r for r in embedding_dedup.near_vectors(df, block=block, recall=0.99999).collect()}
        assert len(out) == len(rows) + len(BAD_VECTORS) + 1
        for i in unit:
            assert (out[i].n_links, out[i].component_id, out[i].kept) == (count[i], roots[i], roots[i] == i)
    assert (out[1006].n_links, out[1007].component_id) == (1, 1006)
    assert all(out[i].n_links == 0 and out[i].kept for i in (1000, 1001, 1002, 1003, 1004, 1005, 1008))
    assert embedding_dedup.near_vectors(vectors_of(spark, [])).count() == 0


def test_rotation_estimate_is_unbiased():
    rng = np.random.default_rng(2)
    o, q = rng.standard_normal((2, 64))
    o, q = o / np.linalg.norm(o), (0.8 * o / np.linalg.norm(o) + 0.2 * q)
    q /= np.linalg.norm(q)
    got = []
    for seed in range(400):
        r = embedding_dedup.rotation(64, 64, seed)
        code, turned = np.sign(o @ r) / 8, q @ r
        got.append(code @ turned / (code @ (o @ r)))
    assert abs(np.mean(got) - o @ q) < 0.01


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = [(i, v, l) for i, v, l in vector_rows(rng, 180)]
    rows += [(300 + i, rows[5][1], 0) for i in range(8)]     # ties
    good = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for i, v, _ in rows]
    expected = []
    for q, x in good:
        if q % 50 == 0:
            best = sorted(((-int(x @ y), i) for i, y in good if i != q))[:5]
            expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    bad = [r for r in BAD_VECTORS if r[0] in (1000, 1002, 1003, 1004)]
    out = topk.top_k(vectors_of(spark, rows + rows[:4] + bad), pivots=8).collect()
    assert sorted(map(tuple, out)) == sorted(expected)
    few = topk.top_k(vectors_of(spark, rows[:3])).collect()
    assert [r["rank"] for r in sorted(few)] == [1, 2]
    assert topk.top_k(vectors_of(spark, [])).count() == 0


def test_top_k_block_pairs_are_neither_broadcast_nor_shuffled(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 64)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    rows = vector_rows(np.random.default_rng(4), 700)
    good = np.array([np.floor(256 * np.array(v, np.float32).astype(float)) for _, v, _ in rows]).astype(int)
    found = topk.top_k(vectors_of(spark, rows))
    out = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in found.collect()}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Broadcast" not in plan and "MergeJoin" not in plan and "Generate" not in plan
    ids = [i for i, _, _ in rows]
    for q in range(len(ids)):
        if ids[q] % 50 == 0:
            best = sorted((-int(good[q] @ good[x]), ids[x]) for x in range(len(ids)) if x != q)[:5]
            assert [out[ids[q], k + 1] for k in range(5)] == [(i, -s) for s, i in best]


@pytest.mark.parametrize("size", [200, 1 << 29, 1 << 40])
@pytest.mark.parametrize("spread", [1, 1000])
def test_search_block_is_exact_for_small_and_large_integers(size, spread):
    rng = np.random.default_rng(size % 97)
    centers = rng.integers(-size, size, (4, 8))
    x = centers[rng.integers(0, 4, 900)] + rng.integers(-size // spread, size // spread + 1, (900, 8))
    x[100:140] = x[7]                                       # ties
    ids, at = np.arange(0, 9000, 10), np.arange(0, 900, 9)
    far = lambda v: np.sqrt(((v[:, None] - centers[None]).astype(float) ** 2).sum(2))
    if size > 1 << 30:                                      # scores that fit 64 bits, products beyond 52
        x[:, 2:] = 0
        x[:, :2] >>= 10
    i, v, s = topk.search_block(ids[at], x[at], far(x[at]), ids, x, far(x), 5)
    assert len(i) == 5 * len(at)
    for n, a in enumerate(at):
        best = sorted((-sum(int(b) * int(c) for b, c in zip(x[a], x[o])), int(ids[o])) for o in range(900) if o != a)[:5]
        assert list(zip((-s[5 * n:5 * n + 5]).tolist(), v[5 * n:5 * n + 5].tolist())) == best


def test_mix_reaches_targets_and_handles_edges(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(400)]
    rows += [(3, rows[3][1], rows[3][2]), (None, "x y z", "a"), (900, None, "empty"), (901, "", "empty")]
    docs = docs_of(spark, rows)
    out = mixing.mix_sources(docs).collect()
    assert len(out) == len(rows)
    total = sum(r["size"] for r in out)
    by = {}
    for r in out:
        assert 0 <= r.taken <= 2 * r["size"]
        by.setdefault(r.source, []).append(r)
    for source, own in by.items():
        assert {r.source_size for r in own} == {sum(r["size"] for r in own)}
        assert sum(r.taken for r in own) == int(own[0].target + 0.5) and own[0].target <= 2 * own[0].source_size
    assert abs(sum(own[0].target for own in by.values()) - 1.5 * total) < 1e-6
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix_sources(docs).collect()))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = {}
    for r in mixed.collect():
        words[r.source] = words.get(r.source, 0) + len(r.text.split())
    for s, own in by.items():
        repeats = 1 if s != rows[3][2] else None     # the repeated row is taken with its twin
        if repeats:
            assert words.get(s, 0) == sum(r.taken for r in own)
    assert mixing.mix_sources(docs_of(spark, [])).count() == 0


def test_bucket_says_whether_pairs_are_left():
    import numpy as np

    def met(sets):
        sizes = np.array([len(s) * 2 + 1 for s in sets])
        ids = np.arange(len(sets))
        counts = [jaccard.group_counts(s) for s in sets]
        return jaccard.bucket_pairs(ids, sizes, counts, ids, np.zeros(len(sets), int), True, True)

    hashes = np.sort(np.random.default_rng(1).integers(0, 2 ** 63, 400, dtype=np.int64).astype(np.uint64))
    a, b, more = met([hashes[:100], hashes[1:101], hashes[200:300]])
    assert {tuple(sorted(p)) for p in zip(a.tolist(), b.tolist())} == {(0, 1)} and not more
    a, b, more = met([hashes[k:k + 100] for k in (0, 1, 2, 3)])   # six pairs, fewer are some document's closest
    assert more and len(set(map(frozenset, zip(a.tolist(), b.tolist())))) < 6


def test_repeated_rows_take_the_words_of_the_budget(spark):
    rows = [(7, "one two three four", "a")] * 6 + [(8, " ".join(["w"] * 30), "b"), (9, " ".join(["v"] * 11), "b")]
    plan = mixing.mix_sources(docs_of(spark, rows)).collect()
    mixed = mixing.mixed_documents(docs_of(spark, rows)).collect()
    for source in "ab":
        assert sum(len(r["text"].split()) for r in mixed if r["source"] == source) == sum(r["taken"] for r in plan if r["source"] == source)


def test_sets_of_every_order_share_a_key(spark):
    """Frequent shingles come last, the order is one for all, and no link is lost by it."""
    rng = np.random.default_rng(8)
    rows = near_copy_rows()
    levels = jaccard.slot_levels(docs_of(spark, rows).select("text"))
    hashes = [jaccard.shingle_set(t) for _, t, _ in rows if t and t.split()]
    everything = np.concatenate([jaccard.shingle_hashes(t) for _, t, _ in rows if t])
    counts = np.bincount(jaccard._slot(everything), minlength=1 << jaccard.SLOT_BITS)
    assert (np.diff(levels[np.argsort(counts)].astype(int)) >= 0).all() and levels.max() > 0
    for order in (levels, rng.integers(0, 9, len(levels)).astype(np.uint8)):
        keys = [jaccard.in_order(h, order) for h in hashes]
        for i, x in enumerate(hashes):
            assert (np.sort(keys[i]) == x).all()
            for j in range(i):
                y = hashes[j]
                both = len(np.intersect1d(x, y))
                if 100 * both >= 75 * (len(x) + len(y) - both):
                    small, large = sorted((i, j), key=lambda k: len(hashes[k]))
                    first = keys[small][:jaccard.prefixes(len(hashes[small]))[0]]
                    assert len(np.intersect1d(first, keys[large][:jaccard.prefixes(len(hashes[large]))[1]]))
