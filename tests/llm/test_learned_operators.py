"""Operators that learn or sample: gradients, round trips, held-out accuracy, awkward rows."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabfit.llm import html_extract, pii, sampling, toxicity


# --- toxicity -------------------------------------------------------------------

@pytest.fixture(scope="module")
def toxic_rows():
    r = np.random.default_rng(1)
    clean = [f"wor{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}" for i in range(100)]
    bad = ["idiot", "moron", "scumbag"]
    rows = []
    for i in range(600):
        w = [clean[k] for k in r.integers(0, 100, int(r.integers(5, 400)))]
        y = int(r.random() < 0.3)
        for k in r.choice(len(w), min(len(w), 3), replace=False) if y else ():
            w[int(k)] = bad[int(r.integers(3))]
        rows.append((i, " ".join(w), y))
    return rows


@pytest.fixture(scope="module")
def toxic_model(toxic_rows):
    part = toxic_rows[:400]
    return toxicity.train([t for _, t, _ in part], np.array([y for *_, y in part]), np.ones(400), least_steps=150)


def test_toxicity_on_held_out_texts_and_misspellings(toxic_rows, toxic_model):
    z = toxic_model.logits([t for _, t, _ in toxic_rows[400:]], {})
    y = np.array([y for *_, y in toxic_rows[400:]])
    assert ((z > 0) == y).mean() > 0.95
    score = toxic_model.word_scores(["idiott", "iidiot", "worak"])
    assert min(score[:2]) > score[2] + 1


def test_toxicity_awkward_rows(spark, toxic_model):
    df = spark.createDataFrame([(1, None, "c"), (2, "", "c"), (2, "", "c"), (None, "!!! ###", None), (3, "x" * 200_000, "c"),
                                (4, "idiot " * 50_000, "c")], "doc_id long, text string, score string")
    got = toxicity.score(df, toxic_model).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if not r["text"]}) == 1
    assert toxicity.score(df.where("false"), toxic_model).count() == 0


def test_toxicity_labels_come_from_the_training_part_only(spark, toxic_rows):
    docs = spark.createDataFrame([(i, t) for i, t, _ in toxic_rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in toxic_rows] + [(0, 0, 0), (None, 1, 0), (1, None, 0)],
                                   "doc_id long, toxic int, quality int")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(docs, labels, per_class=40), toxicity.fit(docs, flipped, per_class=40)
    assert a.bias == b.bias and (a.weight == b.weight).all()
    none = toxicity.fit(docs, labels.where("false"))
    assert none.bias == 0.0 and not none.weight.any()


# --- personal data ----------------------------------------------------------------

CASES = [
    ("", []),
    ("mail a.b+c@x-y.example.com, or @no or a@b", [("email", 5, 26)]),
    ("a@b.c@d.e", [("email", 0, 5)]),
    ("ip 1.2.3.4.5 and 256.1.1.1 and 010.0.0.1", [("ip", 3, 10), ("ip", 31, 40)]),
    ("card 4111 1111-1111 1111 x 4111111111111112", [("card", 5, 24)]),
    ("call +1 (555) 010-9999. +12 or +1-2", [("phone", 5, 22)]),
    ("é😀 +44 20 7946 0958", [("phone", 3, 19)]),
]


def _base_by_pattern(text):
    """The patterns as they are written down, by the regular expression engine."""
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[ -]", "", m[0])
        if 14 <= len(d) <= 19 and pii.luhn(d):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@pytest.mark.parametrize("text,spans", CASES)
def test_base_spans(text, spans):
    assert pii.base_spans(text) == spans == _base_by_pattern(text)


def test_base_spans_equal_the_patterns_on_random_texts():
    r = np.random.default_rng(5)
    for alphabet in ("01.@a-+ ", "0123456789 -.+()", "a@.-b_%1"):
        for _ in range(400):
            t = "".join(alphabet[int(i)] for i in r.integers(0, len(alphabet), int(r.integers(0, 60))))
            assert pii.base_spans(t) == _base_by_pattern(t), t
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_base_spans_are_linear_in_long_runs():
    for t in ("1" * 200_000, "a" * 200_000, "a.b" * 60_000 + "@", "+1" * 60_000, "1.1." * 40_000, "@a" * 60_000):
        pii.base_spans(t)


def test_crf_gradients_match_differences():
    m = pii.Tagger(seed=1)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    codes = np.array([[65, 64, 66, 49], [32, 50, 51, 64]])
    tags = np.array([[1, 2, 0, 3], [0, 7, 8, 0]])

    def loss():
        em = m.emissions(codes).astype(np.float64)
        tr, total = m.p["trans"], 0.0
        for b in range(2):
            a = em[0, b]
            gold = em[0, b, tags[b, 0]]
            for t in range(1, 4):
                a = np.log(np.exp(a[:, None] + tr).sum(0)) + em[t, b]
                gold += tr[tags[b, t - 1], tags[b, t]] + em[t, b, tags[b, t]]
            total += np.log(np.exp(a).sum()) - gold
        return total / 2
    g = m.gradients(codes, tags)
    for k, at in (("trans", (1, 2)), ("out", (3, 1)), ("wf", (2, 5)), ("wb", (14, 30)), ("emb", (64, 3)), ("cf", (7,))):
        old = m.p[k][at]
        m.p[k][at] = old + 1e-3
        up = loss()
        m.p[k][at] = old - 1e-3
        down = loss()
        m.p[k][at] = old
        assert abs((up - down) / 2e-3 - g[k][at]) < 2e-3, k


@pytest.fixture(scope="module")
def tagger():
    text = " ".join(f"word{'abcdefghij'[i % 10]}" for i in range(300))
    codes, tags = pii.training_windows([text] * 5, limit=900)
    return pii.Tagger().fit(codes, tags, epochs=14)


def test_model_reads_spans_that_patterns_miss(tagger):
    r = np.random.default_rng(9)
    hit = n = false = 0
    for _ in range(120):
        s, kind = pii._variant(r, ["alice", "bob"])
        text = f"some words here {s} and more words there"
        got = pii.model_spans([text], tagger)[0]
        if kind:
            n += 1
            hit += any(k == kind and text[a:b] == s for k, a, b in got)
        else:
            false += bool(got)
    assert hit / n > 0.5 and false <= 6


def test_decoding_does_not_depend_on_windows(tagger):
    span = "+1 (743) 555-3824"
    found = set()
    for shift in range(0, 150, 7):
        text = "x " * shift + span + " y" * 100
        got = [(k, a - 2 * shift, b - 2 * shift) for k, a, b in pii.model_spans([text], tagger)[0]]
        found.update(got)
        assert len(got) <= 1
    assert found <= {("phone", 0, len(span))}


def test_pii_awkward_rows(spark, tagger):
    text = "write to a.b@c.de now, ip 1.2.3.4"
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, text, 5), (3, text, 5), (None, "no data", 5), (4, "7" * 100_000, 5)],
                               "doc_id long, text string, spans int")
    rows = pii.find_pii(df, tagger).collect()
    assert len(rows) == 6
    by = {r["doc_id"]: r for r in rows}
    assert by[3]["n_email"] == 1 and by[3]["n_ip"] == 1 and by[3]["spans"].startswith("email:9:17")
    assert by[1]["base_sha256"] == by[2]["base_sha256"] and by[1]["spans"] == ""
    clean = {r["doc_id"]: r["text"] for r in pii.redact(df, tagger).collect()}
    assert clean[1] is None and clean[2] == "" and clean[None] == "no data"
    assert clean[3] == "write to [EMAIL] now, ip [IP]"
    assert pii.find_pii(df.where("false"), tagger).count() == 0


def test_stretches_hold_the_best_sequence(tagger):
    """The tags of stretches are those of the whole text, also with models that join spans and at text edges."""
    r = np.random.default_rng(21)

    def whole(model, em):
        tr = (model.p["trans"] + pii._ILLEGAL).astype(np.float64)
        best, back = em[0] + pii._ILLEGAL[0], []
        for e in list(em[1:]) + [np.r_[0.0, np.full(pii.TAGS - 1, -1e6)]]:
            v = best[:, None] + tr
            back.append(v.argmax(0))
            best = v.max(0) + e
        tag, out = 0, []
        for b in reversed(back):
            tag = b[tag]
            out.append(tag)
        return out[::-1]

    def score(model, em, tags):
        tr = (model.p["trans"] + pii._ILLEGAL).astype(np.float64)
        return (em[np.arange(len(em)), tags].sum(dtype=np.float64) + pii._ILLEGAL[0][tags[0]]
                + sum(tr[a, b] for a, b in zip(tags, [*tags[1:], 0])))

    spans = adjacent = 0
    for trial in range(60):
        m = pii.Tagger()
        m.p = dict(tagger.p)
        if trial % 2:
            m.p["trans"] = r.normal(size=(pii.TAGS, pii.TAGS)).astype(np.float32) * 2
        seqs = [r.normal(size=(int(n), pii.TAGS)).astype(np.float32) * 3 for n in r.integers(0, 60, 5)]
        for e in seqs:
            e[:, 0] += 5
        for e, (tags, _) in zip(seqs, m.decode(seqs)):
            if len(e):
                assert score(m, e, tags) >= score(m, e, whole(m, e.astype(np.float64))) - 1e-3
                spans += int((tags % 2).sum())
                adjacent += int(((tags[1:] % 2 == 1) & (tags[:-1] > 0)).sum())
    assert spans > 50 and adjacent > 5


def test_most_of_a_text_needs_no_decoding(tagger):
    """Characters over which no span can win are not decoded, all others are."""
    m = pii.Tagger()
    m.p = dict(tagger.p, bias=tagger.p["bias"] + np.eye(pii.TAGS, dtype=np.float32)[0] * 4)
    text = "plain words and more of them " * 60
    em = pii._emissions([text + "call (743) 555-3824 " + text], m)
    parts = m._open_parts(em[0], np.array([len(em[0])]))
    assert sum(hi - lo for lo, hi, _ in parts) < len(em[0]) / 4
    assert all(any(lo <= at < hi for lo, hi, _ in parts) for at in np.flatnonzero(m.decode(em)[0][0]))


def test_fast_network_equals_the_one_of_training(tagger):
    codes = np.random.default_rng(5).integers(0, pii.CHARS, (pii.BLAS_ROWS + 9, 50))
    np.testing.assert_allclose(tagger.emissions(codes), tagger.emissions(codes, {}), atol=2e-4)


def test_sample_is_that_of_all_texts(spark, tagger, monkeypatch):
    """The training texts are the first by their hash, whatever share of the texts was looked at."""
    monkeypatch.setattr(pii, "SAMPLE_TEXTS", 3)
    seen = []
    monkeypatch.setattr(pii, "training_windows", lambda texts: seen.append(texts) or (np.zeros((1, 8), int), np.zeros((1, 8), int)))
    df = spark.createDataFrame([(i, f"no {i}" if i % 20 == 0 else "none") for i in range(400)], "doc_id long, text string")
    first = [r["text"] for r in df.where("doc_id % 20 = 0").orderBy(F.xxhash64(F.col("doc_id").cast("string"))).limit(3).collect()]
    for rows in (df, df.limit(25)):
        pii.fit(rows)
    assert sorted(seen[0]) == sorted(first) and len(seen[1]) <= 3
    pii.fit(df.where("text = 'none'"))
    assert seen[2] == []


def test_every_character_is_read(spark, tagger):
    """The network gets every character of every text, also where no trigger is near."""
    read = []

    class Reading(pii.Tagger):
        def emissions(self, codes, keep=None):
            read.append(codes)
            return super().emissions(codes, keep)

    seen = Reading()
    seen.p = tagger.p
    text = "plain words only " * 40
    pii.model_spans([text, "", "short"], seen)
    assert sum(c.size for c in read) >= len(text) + 5
    # an address in words without any trigger reaches the model through find_pii and redact as well
    masked = "call john or mail john at site.com " + "and more words " * 30
    df = spark.createDataFrame([(1, masked), (2, None)], "doc_id long, text string")
    want = pii.model_spans([masked], tagger)[0]
    rows = {r["doc_id"]: r for r in pii.find_pii(df, tagger).collect()}
    assert rows[1]["spans"] == pii.joined(want) and rows[2]["spans"] == ""
    assert [(r["doc_id"], r["text"] is None) for r in pii.redact(df, tagger).orderBy("doc_id").collect()] == [(1, False), (2, True)]


def test_masking_a_batch_takes_room_for_its_texts_only(spark, tagger):
    """Not for as many texts as long as the longest: a batch of 3,000 rows with one text of 100,000 characters."""
    import tracemalloc

    import pandas as pd
    parts = pd.Series(["a b"] * 3000, index=range(5, 3005))
    parts[5], parts[6], parts[7] = "word " * 20_000, None, ""
    seen = []

    def clean(texts):
        seen.extend(texts)
        return [t.upper() for t in texts]

    tracemalloc.start()
    out = pii._replaced(parts, clean)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 20e6  # a list put into the Series took 1,200 MB
    assert out[5] == "WORD " * 20_000 and out[6] is None and out[7] == "" and set(out[8:]) == {"A B"}
    assert len(seen) == 2999 and list(out.index) == list(parts.index)
    none = pii._replaced(pd.Series([None, None], dtype=object), clean)
    assert none.tolist() == [None, None] and pii._replaced(pd.Series([], dtype=object), clean).tolist() == []
    df = spark.createDataFrame([(i, None if i == 1 else "mail bob@site.com") for i in range(600)], "doc_id long, text string")
    rows = {r["doc_id"]: r["text"] for r in pii.redact(df.coalesce(1), tagger).collect()}
    assert rows.pop(1) is None and set(rows.values()) == {"mail [EMAIL]"}


def test_trimmed_spans_hold_what_their_kind_needs():
    def cut(text, kind):
        lo, hi = pii._trimmed(text, kind, 0, len(text))
        return text[lo:hi]
    assert cut("x x +1 (743) 555-3824 y", "phone") == "+1 (743) 555-3824"
    assert cut("call seven three one now", "phone") == "seven three one"
    assert cut("some words only", "card") == "" and cut("at at at at", "email") == ""
    assert cut("john at site dot com", "email") == "john at site dot com" and cut("a.7 @ b.com", "email") == "a.7 @ b.com"


def test_windows_and_batches_do_not_change_tags(tagger):
    r = np.random.default_rng(5)
    texts = ["word " * int(r.integers(1, 300)) + pii._variant(r, ["alice", "bob"])[0] + " more" * int(r.integers(200)) for _ in range(12)]
    alone = [pii.model_spans([t], tagger)[0] for t in texts]
    assert pii.model_spans(texts, tagger) == alone


# --- sampled segmentations ----------------------------------------------------------

@pytest.fixture(scope="module")
def sampler():
    return sampling.Sampler(sampling.Pieces(sampling.model_path()))


TEXTS = ["", "hello  world", " lead and trail ", "a\nb\n\nc", "▁ is kept", "日本語 😀 \t x", "q" * 5000, "ab " * 3000,
         "x" * 41, "\x00\x1f\x85　"]


def test_decoding_is_lossless(sampler):
    got = sampler.sample(TEXTS, np.arange(len(TEXTS), dtype=np.uint64))
    assert [sampler.pieces.decode(g.tolist()) if len(g) else "" for g in got] == TEXTS
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=sampling.model_path())
    assert sp.decode(got[1].tolist()) == "hello  world"


def test_samples_do_not_depend_on_what_is_remembered(sampler):
    keys = np.arange(len(TEXTS), dtype=np.uint64) * np.uint64(12345)
    together = sampler.sample(TEXTS, keys)
    for i in (1, 4, 7):
        alone = sampling.Sampler(sampler.pieces).sample([TEXTS[i]], keys[i:i + 1])[0]
        assert alone.tolist() == together[i].tolist()


def test_long_and_short_units_are_filtered_alike(sampler):
    one, two = sampling.Sampler(sampler.pieces), sampling.Sampler(sampler.pieces)
    units = [" hello", " the", "日本", " z\tq"]
    one._learn_many(units)
    for u in units:
        two._learn_long(u)
    assert one.edges == two.edges
    assert one.piece[:one.edges][one.piece[:one.edges] < sampler.pieces.size].tolist() == \
        two.piece[:two.edges][two.piece[:two.edges] < sampler.pieces.size].tolist()
    assert np.allclose(one.cum[:one.edges], two.cum[:two.edges], atol=1e-6)


def test_segmentations_follow_their_weights(sampler):
    ids = sampler.pieces.ids

    def ways(u):
        if not u:
            yield (), 1.0
        for i in range(1, len(u) + 1):
            if u[:i] in ids:
                for rest, w in ways(u[i:]):
                    yield (ids[u[:i]][0], *rest), w * ids[u[:i]][1]
    want = dict(ways(" then"))
    total, n = sum(want.values()), 20_000
    got = Counter(tuple(x.tolist()) for x in sampler.sample(["then"] * n, np.arange(n, dtype=np.uint64) * np.uint64(982451653)))
    assert set(got) <= set(want)
    for k, w in want.items():
        p = w / total
        assert abs(got[k] / n - p) < 5 * np.sqrt(p * (1 - p) / n) + 1e-3


def test_encode_awkward_rows(spark):
    df = spark.createDataFrame([(1, "same text here", 0), (1, "same text here", 0), (None, "same text here", 0), (2, None, 0), (3, "", 0)],
                               "doc_id long, text string, piece_ids int")
    rows = sampling.decode(sampling.encode(df)).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in rows) and len(rows) == 5
    twice = [r["piece_ids"] for r in rows if r["doc_id"] == 1]
    assert twice[0] == twice[1]
    assert sampling.encode(df.where("false")).count() == 0


# --- web pages --------------------------------------------------------------------

def test_blocks_of_messy_pages():
    page = ("<html><head><title>t</title><style>p{x:'</p>'}</style></head><body><!-- <p>no</p> --><nav><a href='/a>b'>menu</a></nav>"
            "<p>one &amp; <b>two</b>three<br>four<p>five &lt;b&gt; &#233;\n six<script>if (a<b) {'</p>'}</script>"
            "<ul><li>x<li>y</ul>a < b tail")
    got = [b.text for b in html_extract.blocks(page)]
    assert got == ["menu", "one & twothree", "four", "five <b> é six", "x", "y", "a < b tail"]
    assert html_extract.blocks("") == [] and html_extract.blocks("<p></p> <br>") == []
    assert [b.text for b in html_extract.blocks("plain")] == ["plain"]
    assert len(html_extract.blocks("<div>" * 3000 + "x" + "</p>" * 3000 + "<p>" * 3000)) == 1


def test_labeller_gradients_match_differences():
    m = html_extract.Labeller(seed=1)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    paths, words = html_extract._Buckets(html_extract.PATH_BUCKETS), html_extract._Buckets(html_extract.WORD_BUCKETS)
    pages = [m.encode(html_extract.blocks(p), paths, words) for p in ("<p>a b<p>c", "<nav>x</nav><p>a<p>d e f")]
    ys = [np.array([1.0, 0.0]), np.array([0.0, 1.0, 1.0])]

    def loss():
        s = m.scores(pages)
        return -sum((y * np.log(p) + (1 - y) * np.log(1 - p)).sum() for p, y in zip(s, ys)) / 2
    g = m._gradients(pages, ys)
    for k, at in (("out", (3, 0)), ("wf", (5, 7)), ("wb", (75, 20)), ("cb", (33,)), ("path", (paths["p"], 4)), ("word", (words["a"], 2))):
        old = m.p[k][at]
        m.p[k][at] = old + 1e-3
        up = loss()
        m.p[k][at] = old - 1e-3
        down = loss()
        m.p[k][at] = old
        assert abs((up - down) / 2e-3 - g[k][at]) < 2e-3, k


def test_every_word_of_a_block_is_read(monkeypatch):
    m = html_extract.Labeller(seed=1)
    paths, words = html_extract._Buckets(html_extract.PATH_BUCKETS), html_extract._Buckets(html_extract.WORD_BUCKETS)
    said = [f"w{i % 700}" for i in range(3000)] + ["last"] * 5
    page = html_extract.blocks("<p>" + " ".join(said) + "<p>b c b")
    x, _ = m._inputs([m.encode(page, paths, words)], 2)
    at = slice(html_extract.PATH_DIM, html_extract.PATH_DIM + html_extract.WORD_DIM)
    for t, want in enumerate((said, ["b", "c", "b"])):
        np.testing.assert_allclose(x[t, 0, at], np.mean([m.p["word"][words[w]] for w in want], axis=0), atol=1e-5)
    monkeypatch.setattr(html_extract, "IDS_AT_ONCE", 1)
    np.testing.assert_allclose(m._inputs([m.encode(page, paths, words)], 2)[0], x, atol=1e-6)


def test_open_tags_are_seen_at_any_depth():
    deep = "<div>" * 40
    outer, after = html_extract.blocks(f"<nav class=menu>{deep}x{'</div>' * 40}</nav>y")
    assert {"nav", ".menu", "div"} == set(outer.path) and outer.deep == 42 and after.path == ()
    # an end tag far down, an implied end under many inline tags, a link around deep text
    assert html_extract.blocks("<footer>" + "<span>" * 100 + "x</footer>y")[1].path == ()
    assert set(html_extract.blocks("<p class=ad>" + "<b>" * 20 + "x<p>y")[1].path) == {"p"}
    link = html_extract.blocks("<a href='/'>" + "<i>" * 9 + "text</a> after")[0]
    assert (link.text, link.linked) == ("text after", 4)


@pytest.fixture(scope="module")
def labeller():
    return html_extract.train(["<p>" + " ".join(f"tok{i}" for i in range(200)) + "</p>"])


def test_labeller_on_unseen_layouts(spark, labeller):
    main = "".join(f"<p>sentence {i} of the story with several more words in it.</p>" for i in range(5))
    page = ("<body><header class='site-header'><p>My Site</p></header><nav><ul><li><a href='/'>Home</a></ul></nav>"
            "<div class='cookie-banner'><p>We use cookies</p></div><article><h1>Head &amp; line</h1>" + main + "</article>"
            "<aside class='sidebar'><h3>Related</h3><p>other story</p></aside><section id='comments'><div class='comment'>nice one</div>"
            "</section><form><label>Search</label></form><footer>&copy; site</footer></body>")
    df = spark.createDataFrame([(1, "u", page, 9), (2, "u", None, 9), (3, "u", "", 9), (3, "u", "", 9), (None, None, "<nav>x</nav>", 9)],
                               "page_id long, url string, html string, text int")
    rows = html_extract.extract(df, labeller).collect()
    got = {r["page_id"]: r["text"] for r in rows}
    assert len(rows) == 5 and got[2] == got[3] == ""
    want = "Head & line " + " ".join(f"sentence {i} of the story with several more words in it." for i in range(5))
    assert got[1] == want
    assert html_extract.extract(df.where("false"), labeller).count() == 0
