"""The registered queries on a small folder of tables with awkward rows: the columns that their
contracts fix equal a brute-force version; row counts hold; empty tables give empty results."""

import hashlib
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tabfit.llm import html_extract, packing, pii, queries, sampling, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, spans int"
PROSE = [" ".join(f"{w}{i * k % 13}" for k, w in enumerate(("the", "river", "runs", "past", "old", "mills", "and", "wide") * 9)) for i in range(40)]
TEXTS = [None, "", " \t\n", "one", "two words", *PROSE, PROSE[0], "mail a.b@mail.example.org or +49 30 1234 5678, 10.0.0.1 and 999.1.1.1",
         "card 4111 1111 1111 1111 and 4111 1111 1111 1112", "same line\nsame line\n#|| $$ same line", "é ü ñ ▁ ß 日本 " * 30,
         "You stupid idiot, " * 10, "x y z " * 100, "🙂 emoji 🙂", "long " * 30_000, "a b c d"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    rows = [(i * 3 - 6, t, "en", "ab"[i % 2], None if t is None else len(t), "f", 1) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, DOCS).repartition(4).write.parquet(f"{d}/documents.parquet")
    labels = [(r[0], 1, int("idiot" in (r[1] or ""))) for r in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    pages = [(1, "u", "<html><body><nav><a href='x'>Home</a></nav><article><p>" + PROSE[0] + "</p><p>" + PROSE[1]
              + " &amp; &lt;more&gt;</p></article><footer>Imprint</footer></body></html>", "t"),
             (2, "v", None, "t"), (3, "w", "", None), (4, None, "no tags at all", "t"), (5, "x", '<p class="x>' + PROSE[2] + "</p><p>y", "t")]
    spark.createDataFrame(pages, "page_id long, url string, html string, text string").write.parquet(f"{d}/pages.parquet")
    spark.createDataFrame([(1, PROSE[3]), (2, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, {r[0]: r[1] for r in rows}


def _run(spark, folder, name):
    got = queries.QUERIES[name](spark, folder[0]).collect()
    rows = {r["doc_id"]: r.asDict() for r in got}
    assert len(got) == len(rows) == len(folder[1]) and set(rows) == set(folder[1])
    return rows


def test_op1(spark, folder):
    rows = _run(spark, folder, "op1_jump_sharding")
    for i, t in folder[1].items():
        b = (t or "").encode()
        r = rows[i]
        assert (r["size"], r["text_crc32"], r["law"]) == (len(b) + 1, zlib.crc32(b), "key")
        eight, nine = (int(sharding.jump_hash(np.array([i]), n)[0]) for n in (8, 9))
        assert (r["shard"], r["grown_shard"]) == (eight, nine) and nine in (eight, 8)
    for s in range(8):
        slots = sorted(r["slot"] for r in rows.values() if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_op2(spark, folder):
    rows = _run(spark, folder, "op2_toxicity")
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0.0 <= r["score"] <= 1.0 and r["predicted"] == int(r["score"] >= 0.3)


def test_op3(spark, folder):
    rows = _run(spark, folder, "op3_pii")
    for i, t in folder[1].items():
        base = pii.base_spans(t or "")
        r = rows[i]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert r["base_sha256"] == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r["spans"].split(",") if s)]
        assert set(base) <= set(spans) and spans == sorted(spans, key=lambda s: (s[1], pii.KINDS.index(s[0])))
    found = rows[next(i for i, t in folder[1].items() if t and t.startswith("mail"))]
    assert (found["n_email"], found["n_ip"], found["n_card"], found["n_phone"]) == (1, 1, 0, 1)


def test_trigger_is_the_same_in_both_languages(spark):
    texts = ["nothing here", "a 1", "x@y", "jane dot doe at mail dot com", "jane (at) mail", "one two three four", "one two", "٣ arabic",
             "４１ wide", "look at one dot of paint", "[ dot ]", "noon at the river", "SEVEN-seven-SEVEN", "", "a＠b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["h"] for r in df.select("t", F.col("t").rlike(pii._TRIGGER_SQL).alias("h")).collect()}
    assert got == {t: bool(pii._TRIGGER.search(t)) for t in texts}
    assert got["jane dot doe at mail dot com"] and got["one two three four"] and got["４１ wide"] and not got["noon at the river"]


def test_op5(spark, folder):
    rows = _run(spark, folder, "op5_sentencepiece")
    pieces = sampling._sampler(sampling.model_path(), sampling.ALPHA).pieces
    for i, t in folder[1].items():
        r = rows[i]
        assert r["lossless"] and r["n_pieces"] == len(r["piece_ids"])
        assert (pieces.decode(r["piece_ids"]) if r["piece_ids"] else "") == (t or "")
        assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(r['piece_ids'])}I", *r["piece_ids"]))
    again = sampling.encode(spark.read.parquet(f"{folder[0]}/documents.parquet").repartition(1)).collect()
    assert {r["doc_id"]: r["piece_ids"] for r in again} == {i: r["piece_ids"] for i, r in rows.items()}


def test_op6(spark, folder):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.vocabulary_path())
    ids = {i: tok.encode(t or "", add_special_tokens=False).ids + [1] for i, t in folder[1].items()}
    got = [r.asDict() for r in queries.QUERIES["op6_packing"](spark, folder[0]).collect()]
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(ids)
    for i, parts in by_doc.items():
        at = 0
        for r in sorted(parts, key=lambda r: r["start"]):
            piece = ids[i][at:at + r["length"]]
            assert (r["start"], r["doc_tokens"]) == (at, len(ids[i])) and len(piece) == r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(piece)}I", *piece))
            at += r["length"]
        assert at == len(ids[i])
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048


def test_op7(spark, folder):
    rows = {r["page_id"]: r.asDict() for r in queries.QUERIES["op7_html"](spark, folder[0]).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5] and all(r["n_chars"] == len(r["text"]) for r in rows.values())
    assert rows[2]["text"] == rows[3]["text"] == "" and rows[1]["url"] == "u"
    assert PROSE[0] in rows[1]["text"] and "& <more>" in rows[1]["text"] and "Imprint" not in rows[1]["text"]
    assert "<" not in rows[5]["text"] and "class" not in rows[5]["text"]


def _simhash(t):
    w = WORD.findall(t)
    pairs = list(zip(w, w[1:])) if len(w) > 1 else [(x, "") for x in w]
    votes = np.zeros(64, dtype=np.int64)
    for a, b in pairs:
        h = xxhash.xxh64_intdigest(b.encode(), xxhash.xxh64_intdigest(a.encode(), 42))
        weight = 1 + len(a) + len(b)
        votes += np.array([weight if h >> k & 1 else -weight for k in range(64)])
    return sum(1 << k for k in range(64) if votes[k] > 0)


def test_op9(spark, folder):
    rows = _run(spark, folder, "op9_simhash")
    order = sorted(folder[1])
    prints = {i: _simhash(folder[1][i] or "") for i in order}
    for k, i in enumerate(order):
        t, nxt = folder[1][i] or "", folder[1][order[(k + 1) % len(order)]] or ""
        cut = len(t) // 4
        edited = t[:len(t) - cut] + nxt[:cut]
        e, r = _simhash(edited), rows[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (r["fingerprint"], r["edited_fingerprint"]) == (f"{prints[i]:016x}", f"{e:016x}")
        assert r["near_edited"] == 1 - (prints[i] ^ e).bit_count() / 64
        assert r["near_next"] == 1 - (prints[i] ^ prints[order[(k + 1) % len(order)]]).bit_count() / 64


def test_op10(spark, folder):
    rows = _run(spark, folder, "op10_weak_quality")
    for i, t in folder[1].items():
        w = WORD.findall(t or "")
        g = [tuple(w[a:a + 3]) for a in range(len(w) - 2)]
        c, cover = Counter(g), set()
        for a, x in enumerate(g):
            if c[x] > 1:
                cover.update((a, a + 1, a + 2))
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        r = rows[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(cover))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(cover) > 50 * len(w))
        assert r["kept"] == (not r["base_failed"] and r["quality"] >= 0.5) and 0.0 <= r["quality"] <= 1.0


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"pipeline", "op7_html"}))
def test_empty_tables(spark, folder, tmp_path, name):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder[0]}/{t}.parquet").where("false").write.parquet(f"{tmp_path}/{t}.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("page", ["<a ", '<a b="x>" ', '<p class="x>Hello</p>', "<select>x", "<!x ", "<", "<!-- ", '<a x="', "<a x=" + " " * 50])
def test_pages_are_read_in_linear_time(page):
    import time

    def seconds(n):
        best = float("inf")
        for _ in range(3):
            t = time.process_time()
            html_extract.blocks(page * n)
            best = min(best, time.process_time() - t)
        return best
    assert seconds(64_000) < 64 * max(seconds(4_000), 0.003)


def test_markup_never_stays():
    def text(page):
        return [b.text for b in html_extract.blocks(page)]
    assert text('<p class="x>Hello</p><p>next</p>') == ["Hello", "next"]
    assert text("<a href='x>y' title=\"q'\">link</a> t <p title=it's>it's</p>") == ["link t", "it's"]
    assert text("a <!-- b > c --> d <!-- e > f") == ["a d"] and text("1 < 2 <b>x</b> & y <3") == ["1 < 2 x & y <3"]
