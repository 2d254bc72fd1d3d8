"""Cross-tokenizer alignment against whole-text tokenization and all-pairs overlap tests."""
import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from panelforge.llm import common, token_alignment as align

P = pytest.importorskip("public_tokenizers")
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
DOCS = "doc_id long, text string, n_a string, block string, code long"


def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(P.path(A_FILE))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=P.path(B_FILE))


def whole_text(a, b, text):
    """(a ids, b ids, group text, links) of one text, by testing every pair of byte ranges."""
    none = ([], [], "", [])
    if not text:
        return none
    letter = align.byte_alphabet()
    x = a.encode(" " + text, add_special_tokens=False)
    y = b.encode(text)
    x_bytes = [bytes(letter[c] for c in t) for t in x.tokens]
    y_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
               for i in y]
    if not b"".join(x_bytes) == b"".join(y_bytes) == (" " + text).encode():
        return none
    x_end, y_end = ([sum(map(len, t[:k + 1])) for k in range(len(t))] for t in (x_bytes, y_bytes))
    links = [(i, j) for k, i in enumerate(x.ids) for m, j in enumerate(y)
             if x_end[k] - len(x_bytes[k]) < y_end[m] and y_end[m] - len(y_bytes[m]) < x_end[k]]
    groups, at = [], 0
    for end in sorted(set(x_end) & set(y_end)):
        groups.append(",".join(str(i) for i, e in zip(x.ids, x_end) if at < e <= end) + "|"
                      + ",".join(str(i) for i, e in zip(y, y_end) if at < e <= end))
        at = end
    return x.ids, y, ";".join(groups), links


def reference(rows):
    a, b = libraries()
    found = [whole_text(a, b, t) for _, t in rows]
    held = Counter(p for *_, links in found for p in set(links))
    most = {}
    for (i, _), n in held.items():
        most[i] = max(most.get(i, 0), n)
    return sorted(((d, len(x), len(y), g.count("|"), len(links), sum(held[p] == most[p[0]] for p in links),
                    sum(held[p] for p in links), hashlib.sha256(g.encode()).hexdigest() if g else "")
                   for (d, _), (x, y, g, links) in zip(rows, found)), key=str)


def aligned(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], DOCS).repartition(3)
    return sorted(map(tuple, align.align_tokenizers(docs, P.path(A_FILE), P.path(B_FILE)).collect()), key=str)


def odd_texts(n, seed):
    rng = random.Random(seed)
    letters = "ab  \n\tçé日本𝒳<s>/0x A.eth​\x00'sß 　\x1c|<|endoftext|> "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(n)]
    return texts + ["<|endoftext|> a </s>", "it's  we'll  x ", "a▁b c", " lead", "\n", "\nx", " \nx y", "tail ", "naïve Straße 1234 "]


def test_rows_equal_brute_force(spark):
    rows = [(k, t) for k, t in enumerate(odd_texts(250, 4))]
    rows += [(1000, None), (1001, ""), (None, "no id here"), (3, rows[3][1]), (3, rows[3][1]),
             (1002, "plain words of a longer text, again and again. " * 12), (1003, "x" * 3000), (1004, "éa" * 400)]
    assert aligned(spark, rows) == reference(rows)


def test_blocks_of_few_documents_and_a_full_memo_change_nothing(spark, monkeypatch):
    rows = [(k, " ".join(random.Random(k % 7).choices(["the", "Tokens", "overlap,", "über", "naïveté"], k=30)) + f" {k}") for k in range(60)]
    aligner = align.Aligner(open(P.path(A_FILE), encoding="utf-8").read(), open(P.path(B_FILE), "rb").read())
    blocks = []
    for lo in range(0, 60, 20):
        block = align._Block()
        for (i, _), numbers in zip(rows[lo:lo + 20], aligner.numbers([t for _, t in rows[lo:lo + 20]])):
            block.add(i, numbers, aligner)
        blocks.append(block.packed(lo, aligner))
        aligner.forget()
    import pandas as pd
    packed = spark.createDataFrame(pd.concat(blocks), align._PACKED)
    held, counts = align.link_counts(packed)
    one = counts.toPandas()
    assert held.count() == sum(len(np.frombuffer(c, np.int64)) for f in blocks for c in f["codes"])
    got = []
    for f in blocks:
        own = one[one["code"].isin(np.frombuffer(f["codes"][0], np.int64))]
        got += [tuple(r) for r in align._finish(f.iloc[0], own).itertuples(index=False)]
    assert sorted(got, key=str) == reference(rows) == aligned(spark, rows)


def test_blocks_are_written_in_small_row_groups(spark, monkeypatch):
    import os

    import pandas as pd
    import pyarrow.parquet as pq
    made = []
    monkeypatch.setattr(align, "scratch_table", lambda *a: (made.append((a, scratch_table(*a))), made[-1][1])[1])
    scratch_table = common.scratch_table
    assert len(aligned(spark, [(1, "some words"), (2, "more words")])) == 2
    (_, name, options), _ = made[0]
    # rows as large as those of full blocks: a writer that looks at its size only after a hundred rows holds them all
    large = spark.range(0, 24, 1, 1).mapInPandas(
        lambda batches: (pd.DataFrame({"id": [i], "chunk": [os.urandom(5 << 20)]}) for b in batches for i in b["id"]), "id long, chunk binary")
    files = scratch_table(large, name, options).inputFiles()
    groups = pq.ParquetFile(files[0].removeprefix("file://")).metadata
    assert groups.num_row_groups > 2 and max(groups.row_group(i).num_rows for i in range(groups.num_row_groups)) <= 10


def test_gallop_equals_searchsorted():
    rng = np.random.default_rng(1)
    long = np.unique(rng.integers(0, 10_000, 900))
    wanted = rng.integers(0, long[-1] + 1, 5000)
    start, stop = np.zeros(5000, np.int64), np.full(5000, len(long))
    assert (align.gallop(wanted, start, stop, long) == np.searchsorted(long, wanted)).all()


def test_empty_table(spark):
    assert aligned(spark, []) == []
