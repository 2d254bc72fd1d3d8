"""Per-text operators: token counts, PII, pieces, quality, toxicity, HTML; edge cases and exact references."""
import random
import re

import numpy as np
import pytest

from panelforge.llm import html_text, pii, quality, sentencepieces, token_counts, toxicity

P = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, hits string, n long"


def model_path():
    return P.path("piece_bpe_32k.model")


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None, "x", 1) for i, t in rows], DOCS)


EDGE = [(1, None), (2, ""), (3, "   \n "), (4, "plain words here."), (4, "plain words here."), (None, "no id"),
        (5, "long " * 40_000)]


def fuzz(n, seed=3, alphabet="ab  \n\tçé▁日本𝒳<s>/0x A.eth​\x00"):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def test_token_counts_equal_the_library():
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=model_path())
    merger = token_counts.PairMerger(token_counts.load_ranks(model_path()))
    texts = fuzz(1500) + ["A sentence, with words and numbers 1234.", "x" * 5000, " lead", "trail ", "a\n\nb \n c", "<s> </s>"]
    assert [merger.count(t) for t in texts] == [len(sp.encode(t)) for t in texts]


def test_token_count_edges(spark):
    out = token_counts.count_tokens(docs_of(spark, EDGE), model_path(), limit=100).collect()
    assert len(out) == len(EDGE)
    by = {r.doc_id: r for r in out}
    assert (by[1].n_bytes, by[1].n_tokens, by[1].over_limit) == (0, 0, False) == tuple(by[2][1:])
    assert by[5].over_limit and by[None].n_tokens > 0
    assert token_counts.count_tokens(docs_of(spark, []), model_path()).count() == 0


def reference_spans(text):
    out = []
    for k, p in enumerate((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                           r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = (k == 0 or k == 1 and max(map(int, m[0].split("."))) <= 255
                  or k == 2 and 16 <= len(digits) <= 19
                  and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0
                  or k == 3 and 8 <= len(digits) <= 15)
            if ok:
                out.append((k, m.start(), m.end()))
    return sorted(out)


def test_base_spans_equal_plain_patterns():
    rng = random.Random(5)
    bits = ["a.b@c.d", "@", "1.2.3.4", "300.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (988) 555-2485", "+12",
            " ", "x", "7", ".", "-", "é", "\n", "0041", "a@b", "+", "1.2.3.4.5"]
    for _ in range(2000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
        base, every = pii.spans(text)
        assert base == reference_spans(text)
        assert set(base) <= set(every)


@pytest.mark.parametrize("text,kind,found", [
    ("mail john.smith [at] example [dot] com now", "email", "john.smith [at] example [dot] com"),
    ("john dot smith at example dot co dot uk ok", "email", "john dot smith at example dot co dot uk"),
    ("write joe＠site․org", "email", "joe＠site․org"),
    ("to mаria@mail.com", "email", "mаria@mail.com"),
    ("call plus one five five five, one two three four five six", "phone",
     "plus one five five five, one two three four five six"),
    ("four one one one 1111 1111 one one one one", "card", "four one one one 1111 1111 one one one one"),
    ("at one nine two dot one six eight dot zero dot one", "ip", "one nine two dot one six eight dot zero dot one"),
])
def test_disguised_data_maps_back_to_source(text, kind, found):
    _, every = pii.spans(text)
    assert (kind, found) in [(pii.KINDS[k], text[a:b]) for k, a, b in every]


@pytest.mark.parametrize("text,kind,found", [
    ("to 192 dot 168 dot 0 dot 1 now", "ip", "192 dot 168 dot 0 dot 1"),
    ("to 192[.]168[dot]0 (punto) 1 now", "ip", "192[.]168[dot]0 (punto) 1"),
    ("a uno punto dos punto tres punto cuatro!", "ip", "uno punto dos punto tres punto cuatro"),
    ("an eins Punkt 2 Punkt drei Punkt 4", "ip", "eins Punkt 2 Punkt drei Punkt 4"),
    ("call +1 four 1 five 5 five 0 one 2 three 4", "phone", "+1 four 1 five 5 five 0 one 2 three 4"),
    ("pay 4111 one 111 1111 one 111 today", "card", "4111 one 111 1111 one 111"),
    ("to \u017fix dot 1 dot 2 dot three", "ip", "\u017fix dot 1 dot 2 dot three"),
])
def test_runs_that_mix_numerals_words_and_dots(text, kind, found):
    _, every = pii.spans(text)
    assert every == [(pii.KINDS.index(kind), text.index(found), text.index(found) + len(found))]


@pytest.mark.parametrize("text,found", [("host 10.0.0.1, one of two", "10.0.0.1"), ("10.0.0.1 two times", "10.0.0.1"),
                                        ("+1 415 555 0123, one of us", "+1 415 555 0123")])
def test_words_after_a_plain_find_do_not_extend_it(text, found):
    base, every = pii.spans(text)
    assert base == every and [text[a:b] for _, a, b in every] == [found]


@pytest.mark.parametrize("text", ["look at example.com today", "one two three go", "at the end dot", "12 at 5 dot 3", ""])
def test_clean_texts_stay_clean(text):
    assert pii.spans(text) == ([], [])


def test_pii_edges_and_masking(spark):
    docs = docs_of(spark, EDGE + [(9, "a@b.com or bob [at] x [dot] org")])
    out = {r.doc_id: r for r in pii.find_pii(docs).collect()}
    assert out[1].spans == "" and out[1].base_sha256 == out[2].base_sha256 and out[9].n_email == 2
    masked = pii.mask_pii(docs)
    assert masked.columns == docs.columns and masked.count() == len(EDGE) + 1
    row = {r.doc_id: r for r in masked.collect()}
    assert row[9].text == "<EMAIL> or <EMAIL>" and row[9].n_chars == 18 and row[1].text is None
    assert pii.find_pii(docs_of(spark, [])).count() == 0


def test_pieces_round_trip_and_brute_force():
    codec = sentencepieces.Codec(sentencepieces.load_pieces(model_path()))
    texts = fuzz(800) + ["", "words and words", "long" * 2000]
    for t, ids in zip(texts, codec.viterbi.encode(texts)):
        assert codec.decode(ids.tolist()) == t.replace("▁", " ")
    for w in {w for t in texts for w in t.split()} | {"▁the", "▁information"}:
        assert codec.viterbi.solve([w], len(w))[0] == codec.viterbi.solve_alone(w)


def test_piece_edges(spark):
    docs = docs_of(spark, EDGE)
    rows = sentencepieces.encoded_digest(docs, model_path()).collect()
    assert len(rows) == len(EDGE) and all(r.round_trip for r in rows)
    both = sentencepieces.decode_documents(sentencepieces.encode_documents(docs, model_path()), model_path())
    assert all((r.text or "") == r.decoded for r in both.collect())
    assert sentencepieces.encoded_digest(docs_of(spark, []), model_path()).count() == 0


def labels_of(spark, rows, label):
    return spark.createDataFrame(rows, f"doc_id long, {label} int")


def test_quality_learns_and_handles_edges(spark):
    rng = random.Random(1)
    words = "the of and river house walks slowly under bright morning light while people talk".split()
    good = [(i, " ".join(rng.choices(words, k=60)).capitalize() + ".") for i in range(120)]
    bad = [(i, " ".join(rng.choices(words, k=4) * 15).upper() + " ### $$$") for i in range(120, 240)]
    docs, labels = docs_of(spark, good + bad + [(900, None), (901, "")]), labels_of(
        spark, [(i, int(i < 120)) for i in range(240)], "quality")
    model = quality.fit_quality(docs, labels, trees=20)
    out = {r.doc_id: r for r in quality.score_quality(docs, model).collect()}
    held = [r for r in out.values() if r.held_out and r.doc_id < 240]
    assert held and sum((r.predicted == 1) == (r.doc_id < 120) for r in held) >= 0.95 * len(held)
    assert out[900].score == out[901].score and 0 <= out[900].score <= 1
    again = quality.fit_quality(docs, labels, trees=20)
    assert np.array_equal(model["value"], again["value"])
    none = quality.fit_quality(docs, labels_of(spark, [], "quality"))
    assert {r.score for r in quality.score_quality(docs, none).collect()} == {0.5}
    assert quality.score_quality(docs_of(spark, []), model).count() == 0


def test_flat_trees_equal_plain_traversal():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((300, 5))
    y = (x[:, 0] + x[:, 1] ** 2 > 0.5).astype(float)
    model = quality.fit_trees(x, y, trees=15, depth=3)
    plain = []
    for row in x:
        z = model["bias"]
        for t in range(15):
            k = 0
            for _ in range(3):
                k = 2 * k + 1 + (row[model["feature"][t, k]] > model["threshold"][t, k])
            z += model["value"][t, k - 7]
        plain.append(1 / (1 + np.exp(-z)))
    assert np.allclose(quality.predict(model, x), plain)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_equals_edit_distance():
    words = ["idiot", "worthless", "scum", "loser", "losers", "disgusting"]
    automaton = toxicity.TermAutomaton(words, ["lowei"])
    rng = random.Random(2)
    for _ in range(4000):
        w = list(rng.choice(words))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(w) + 1)
            w[k:k + rng.randint(0, 1)] = rng.choice(["", "x", "s", "o"])
        w = "".join(w)
        best = min(((edits(w, t), i) for i, t in enumerate(words) if edits(w, t) <= automaton.allowed[i]), default=None)
        got = automaton.match(w)
        assert (got is None) == (best is None), w
        if best:
            assert got[1] == best[0], w
    assert automaton.match("loweischaft") == (6, 0) and automaton.match("lowe") is None


def test_toxicity_learns_quotes_and_edges(spark):
    rng = random.Random(4)
    plain = "river house walks slowly under bright morning light while people talk about bread".split()
    rows, labels = [], []
    for i in range(300):
        words = rng.choices(plain, k=40)
        if i % 3 == 0:
            for _ in range(3):
                words.insert(rng.randrange(40), rng.choice(["zgrumpel", "vrakkolo"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0)))
    docs = docs_of(spark, rows + [(900, None), (901, "")])
    model = toxicity.fit_toxicity(docs, labels_of(spark, labels, "toxic"))
    assert {w for w, _ in model["words"]} | {s for s, _ in model["stems"]}
    out = {r.doc_id: r for r in toxicity.score_toxicity(docs, model).collect()}
    assert all((out[i].predicted == 1) == (i % 3 == 0) for i in range(300) if out[i].held_out)
    assert out[900].score == out[901].score < 0.7
    scorer = toxicity.Scorer(model)
    abuse = scorer.score("you zgrumpel you vrakkolo")
    assert abuse > scorer.score('he said the words "zgrumpel" and the word "vrakkolo" again') and abuse > 0.7
    assert scorer.features("zgrumpal zgrumpal")[1] > 0 or model["stems"]
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == 202
    assert toxicity.score_toxicity(docs_of(spark, []), model).count() == 0
    none = toxicity.fit_toxicity(docs, labels_of(spark, [], "toxic"))
    assert len({r.score for r in toxicity.score_toxicity(docs, none).collect()}) == 1
    seeded = toxicity.Scorer(none)
    assert seeded.score("you worthless idiot, what a moron") > 0.7 > seeded.score("a quiet walk") == seeded.score(None)


def test_misspelled_inflected_terms_are_hit(spark):
    rng = random.Random(6)
    plain = "river house walks slowly under bright morning light while people talk about bread".split()
    forms = ["vrakkolo", "vrakkola", "vrakkolen"]
    rows, labels = [], []
    for i in range(300):
        words = rng.choices(plain, k=40)
        if i % 3 == 0:
            for _ in range(3):
                words.insert(rng.randrange(40), rng.choice(forms))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0)))
    model = toxicity.fit_toxicity(docs_of(spark, rows), labels_of(spark, labels, "toxic"))
    assert [s for s, _ in model["stems"]] == ["vrak"] and set(forms) <= {w for w, _ in model["words"]}
    scorer = toxicity.Scorer(model)
    assert scorer.hit("vrakkolo") == (len(model["words"]), 0) == scorer.hit("vrakkolissimo")
    for term in ("vrzkkolo", "vakkola", "vrrakkolen"):   # misspelled inside the beginning
        assert scorer.hit(term)[1] == 1
    assert scorer.features("vrzkkolo vakkola")[1] > 0
    assert scorer.score("you vrzkkolo and you vakkola") > scorer.score("you walk and you talk")


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><div id="cookie-notice">We use cookies here.</div>
<header><a href=/>Home</a><h2>Site</h2></header><nav><ul><li><a href=x>One</a></ul></nav>
<div class="content"><h1>My  title</h1><p>First para &amp; more text here that is long enough to count as a paragraph.
<p>Short &#233;nd.</p><div class="ad">Buy now, buy now!</div><p>Second para with <a href=x>link</a> text.</p></div>
<aside><p>Some related text that goes on and on for a while, truly, it is rather long.</p></aside>
<section class="comments"><div class="comment"><p>I think this article is great, thanks for posting it here.</p></div></section>
<form><label>Email</label></form><footer>&copy; 2020 Site.</footer><script>var t="</p><p>Not text.";</script>"""


def test_html_main_text(spark):
    expected = ("My title\n\nFirst para & more text here that is long enough to count as a paragraph.\n\nShort énd.\n\n"
                "Second para with link text.")
    assert html_text.main_text(PAGE) == expected
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, "x"), (None, "u", "", "x"), (3, "u", "<p", "x"),
                                   (4, "u", "<article><p>" + "Word. " * 50_000, "x"), (4, "u", "a < b <b>c", "x")],
                                  "page_id long, url string, html string, text string")
    out = html_text.extract_main_text(pages).collect()
    assert len(out) == 6 and [r.n_chars for r in out if r.page_id == 1] == [len(expected)]
    assert [r.text for r in out if r.page_id in (2, None)] == ["", ""]
    assert max(r.n_chars for r in out) == 50_000 * 6 - 1


def test_min_cut_is_minimal():
    rng = random.Random(7)
    for _ in range(200):
        n = rng.randint(1, 8)
        z = [rng.uniform(-4, 4) for _ in range(n)]
        edges = [(i, j, rng.uniform(0, 2)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5]

        def cost(keep):
            return (sum(max(v, 0) for v, k in zip(z, keep) if not k) + sum(max(-v, 0) for v, k in zip(z, keep) if k)
                    + sum(w for i, j, w in edges if keep[i] != keep[j]))
        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert cost(html_text.min_cut(z, edges)) == pytest.approx(best, abs=0.02)
