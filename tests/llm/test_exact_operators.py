"""Operators with exact results, against brute force, with awkward rows: nulls, empty
and blank texts, repeated rows, ties, empty tables and clashing extra columns."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabfit.llm import fingerprint, line_dedup, near_dedup, packing, quality, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, shard string, __words string, n_words int"

A = " ".join(f"alpha{i}" for i in range(60))
B = " ".join(f"beta{i}" for i in range(30))
C = " ".join(f"gamma{i}" for i in range(30))
LONG = " ".join(f"w{i % 977} x{i}" for i in range(30_000))
TEXTS = [
    None, "", " \t\n", "one", "one", "two words", A, A, f"{A} tail", f"intro here\n{A}\nmiddle", f"other\n{B}\n{C}\nend",
    f"{B}\n{C}", f"{B}\n\n{C}\nmore", f"{A}\n{A}", "x y z x y z x y z", "é ü ñ ▁ ß 日本", "A B c D " * 20, LONG,
    LONG + " changed", "#$% ||| <> && **\n#\n#\n#", "same line\nsame line\n\nother",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", "w", 7) for i, t in enumerate(TEXTS)]
    rows += [(6, A, "en", "s", "w", 7), (None, "null key text", None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# --- sharding ---------------------------------------------------------------

def _jump(key: int, n: int) -> int:
    b, j, key = -1, 0, key % (1 << 64)
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash_equals_scalar_form_and_moves_only_into_new_shards():
    keys = np.concatenate([np.arange(-500, 3000), np.array([2 ** 63 - 1, -2 ** 63])])
    for n in (1, 2, 8, 9, 1000):
        assert sharding.jump_hash(keys, n).tolist() == [_jump(int(k), n) for k in keys]
    eight, nine = sharding.jump_hash(keys, 8), sharding.jump_hash(keys, 9)
    moved = eight != nine
    assert set(nine[moved]) == {8}
    assert 0.05 < moved.mean() < 0.18


def test_slots_are_gapless_and_rows_stay_whole(docs, nothing):
    placed = sharding.assign_shards(docs.select("doc_id", "text", "shard"), "doc_id", 3)
    assert dict(placed.dtypes)["shard"] == "int"  # the clashing column is replaced
    slots = sharding.number_slots(placed.select("doc_id", "shard"), ["doc_id"]).collect()
    assert len(slots) == docs.count()
    by = {}
    for r in slots:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    empty = sharding.assign_shards(nothing, "doc_id", 3).select("doc_id", "shard")
    assert sharding.number_slots(empty, ["doc_id"]).count() == 0


def test_one_row_repeated_many_times_gets_all_slots(spark):
    rows = spark.range(1000).select(F.lit(5).cast("long").alias("doc_id"))
    slots = sharding.number_slots(sharding.assign_shards(rows, "doc_id", 4), ["doc_id"])
    assert sorted(r["slot"] for r in slots.collect()) == list(range(1000))


def test_other_key_types(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert {r["shard"] for r in sharding.assign_shards(df, "k", 1).collect()} == {0}


# --- quality ----------------------------------------------------------------

def _stats(t):
    t = t or ""
    w = WORD.findall(t)
    g = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    c, cover = Counter(g), set()
    for i, x in enumerate(g):
        if c[x] > 1:
            cover.update((i, i + 1, i + 2))
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover))


def test_text_statistics_equal_brute_force(docs, nothing):
    got = quality.weak_quality(docs).collect()
    assert len(got) == docs.count()
    texts = dict(enumerate(TEXTS)) | {None: "null key text"}
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == _stats(
            texts[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])
        assert 0.0 < r["quality"] < 1.0
    assert quality.weak_quality(nothing).count() == 0


def test_votes_find_the_bad_texts(spark):
    r = np.random.default_rng(1)
    words = [f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(100)]

    def prose():
        return " ".join(words[i] for i in r.integers(0, 100, 120))
    rows = [(i, prose(), 1) for i in range(300)]
    rows += [(1000 + i, prose().upper(), 0) for i in range(20)]
    rows += [(2000 + i, " ".join(w + "###" for w in prose().split()), 0) for i in range(20)]
    rows += [(3000 + i, " ".join([prose()[:200]] * 4) + " " + prose(), 0) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, good int")
    got = quality.weak_quality(df).collect()
    assert all(x["kept"] == bool(x["good"]) for x in got)


# --- line dedup ---------------------------------------------------------------

def _line_brute(docs, min_words):
    """Deleted line places by comparing all runs as tuples."""
    first_text, seqs = {}, {}
    for i, t in docs:
        t = t or ""
        lines = t.split("\n")
        nb = [k for k, x in enumerate(lines) if WORD.search(x)]
        seqs[i] = (t, [lines[k] for k in nb], [len(WORD.findall(lines[k])) for k in nb])
        if t not in first_text or i < first_text[t]:
            first_text[t] = i
    first = {}
    for i, (t, s, w) in seqs.items():
        if first_text[t] == i:
            for p in range(len(s)):
                for q in range(p, len(s)):
                    if sum(w[p:q + 1]) >= min_words:
                        k = tuple(s[p:q + 1])
                        first[k] = min(first.get(k, (i, p)), (i, p))
    out = {}
    for i, (t, s, w) in seqs.items():
        gone = set()
        if first_text[t] != i:
            gone = set(range(len(s))) if sum(w) >= min_words else set()
        else:
            for p in range(len(s)):
                for q in range(p, len(s)):
                    if sum(w[p:q + 1]) >= min_words and first[tuple(s[p:q + 1])] < (i, p):
                        gone.update(range(p, q + 1))
        out[i] = [x for k, x in enumerate(s) if k not in gone], len(gone)
    return out


@pytest.mark.parametrize("min_words", [1, 7, 50])
def test_line_dedup_equals_all_runs(spark, min_words):
    r = np.random.default_rng(min_words)
    pool = [" ".join(f"l{i}w{j}" for j in range(int(r.integers(1, 9)))) for i in range(12)] + ["", " "]
    texts = ["\n".join(pool[k] for k in r.integers(0, len(pool), int(r.integers(0, 25)))) for _ in range(60)]
    texts += texts[:5] + [A, A, f"{A}\n{A}"]
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    expected = _line_brute(docs, min_words)
    got = {x["doc_id"]: x for x in line_dedup.dedup_lines(df, min_words=min_words).collect()}
    assert len(got) == len(docs)
    for i, (left, n) in expected.items():
        assert [x for x in got[i]["text"].split("\n") if WORD.search(x)] == left
        assert got[i]["n_removed_lines"] == n


def test_line_dedup_awkward_rows(docs, nothing):
    wide = docs.withColumn("n_removed_lines", F.lit("clash")).withColumn("id", F.lit(1)).withColumn("c", F.lit(2))
    got = line_dedup.dedup_lines(wide)
    assert got.count() == docs.count()
    rows = {(r["doc_id"], r["text"]): r for r in got.collect()}
    assert (0, None) in rows and (1, "") in rows and (None, "null key text") in rows
    kept = [r for r in rows.values() if r["doc_id"] == 6]
    assert [r["text"] for r in kept] == [A] and kept[0]["n_removed_lines"] == 0  # both copies of the row, once here
    assert [r["text"] for r in rows.values() if r["doc_id"] == 7] == [""]
    assert [r["text"] for r in rows.values() if r["doc_id"] == 9] == ["intro here\nmiddle"]
    assert [r["text"] for r in rows.values() if r["doc_id"] == 13] == [""]
    assert line_dedup.dedup_lines(nothing).count() == 0


# --- fingerprints ---------------------------------------------------------------

def test_simhash_votes(spark, docs, nothing):
    f = fingerprint.simhash(docs.where("doc_id is not null").dropDuplicates(["doc_id"]), ["doc_id"], "text")
    got = {r["doc_id"]: r["fingerprint"] for r in f.collect()}
    assert len(got) == len(TEXTS)
    assert got[0] == got[1] == got[2] == 0
    assert got[6] == got[7] and got[3] == got[4]
    far = bin((got[17] ^ got[18]) & (2 ** 64 - 1)).count("1")
    assert far <= 3 < bin((got[6] ^ got[11]) & (2 ** 64 - 1)).count("1")
    # votes by hand for one text
    pairs = spark.createDataFrame([("two", "words")], "a string, b string").select(F.xxhash64("a", "b")).first()[0]
    assert got[5] == pairs  # a single term decides every bit
    assert fingerprint.simhash(nothing, ["doc_id"], "text").count() == 0


def test_block_tables_find_all_within_radius(spark):
    r = np.random.default_rng(2)
    base = [int(x) for x in r.integers(-2 ** 63, 2 ** 63 - 1, 40)]
    values = list(base)
    for b in base[:25]:
        for n in range(1, 6):
            m = 0
            for k in r.choice(64, n, replace=False):
                m |= 1 << int(k)
            x = (b ^ m) & (2 ** 64 - 1)
            values.append(x - 2 ** 64 if x >= 2 ** 63 else x)
    df = spark.createDataFrame([(v,) for v in values + values[:10]] + [(None,)], "fingerprint long")
    got = {(x["a"], x["b"]) for x in fingerprint.near_fingerprints(df, radius=3, blocks=6).collect()}
    vs = sorted(set(values))
    want = {(a, b) for i, a in enumerate(vs) for b in vs[i + 1:] if bin((a ^ b) & (2 ** 64 - 1)).count("1") <= 3}
    assert got == want and want


def test_next_document_across_ranges(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(fingerprint, "ROWS_PER_RANGE", 7)
    r = np.random.default_rng(3)
    texts = {i * 3: "".join(chr(int(c)) for c in r.integers(97, 110, int(r.integers(0, 40)))) + " é" * (i % 3) for i in range(60)}
    spark.createDataFrame([(i, t if i % 9 else None) for i, t in texts.items()], "doc_id long, text string").repartition(5).write.parquet(
        f"{tmp_path}/documents.parquet")
    texts = {i: t if i % 9 else "" for i, t in texts.items()}
    got = {x["doc_id"]: x for x in fingerprint.op9_simhash(spark, str(tmp_path)).collect()}
    ids = sorted(texts)
    assert sorted(got) == ids
    for k, i in enumerate(ids):
        t, nxt = texts[i], texts[ids[(k + 1) % len(ids)]]
        q = len(t) // 4
        assert got[i]["edited_sha256"] == hashlib.sha256((t[:len(t) - q] + nxt[:q]).encode()).hexdigest()
        x = int(got[i]["fingerprint"], 16) ^ int(got[ids[(k + 1) % len(ids)]]["fingerprint"], 16)
        assert got[i]["near_next"] == 1 - bin(x).count("1") / 64


# --- near duplicates ----------------------------------------------------------------

def _set(t, k):
    w = [x.lower() for x in (t or "").encode().split()]
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def _groups(docs, k, percent=80):
    s = {i: _set(t, k) for i, t in docs}
    up = {i: i for i, _ in docs}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    ids = sorted(up)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(s[a] & s[b])
            if both and 100 * both >= percent * len(s[a] | s[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(s[i]), root(i)) for i in ids}


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates_equal_brute_force(spark, words, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    r = np.random.default_rng(words)
    base = [[f"v{int(x)}" for x in r.integers(0, 500, 120)] for _ in range(8)]
    texts = [None, "", "one", "One", "one two", "ONE two", "One\ttwo ", "a b a b a b", "b a b a b a"]
    for b in base:
        for n in range(12):  # up to and beyond the threshold
            c = list(b)
            for k in r.choice(len(c), n // 2, replace=False):
                c[int(k)] = f"new{int(r.integers(10 ** 6))}"
            texts.append(" ".join(c))
    for n in range(30):  # a chain: neighbours alike, ends not
        texts.append(" ".join(f"c{i}" for i in range(4 * n, 4 * n + 200)))
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in near_dedup.near_duplicates(df, words=words).collect()}
    assert got == _groups(docs, words)


def test_near_duplicates_awkward_rows(docs, nothing):
    got = near_dedup.near_duplicates(docs, words=5).collect()
    assert len(got) == docs.count()
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["component_id"] == i and by[i]["kept"] for i in (0, 1, 2))
    assert by[4]["component_id"] == 3 and not by[4]["kept"]
    assert by[18]["component_id"] == 17
    assert by[None]["kept"] and by[None]["component_id"] is None
    assert near_dedup.near_duplicates(nothing).count() == 0


def test_components_of_long_chains_and_stars(spark):
    e = [(i, i + 1) for i in range(0, 200)] + [(1000, x) for x in range(1001, 1100)] + [(5000, 4000), (5000, 4999)]
    got = {r["id"]: r["component"] for r in near_dedup.components(spark.createDataFrame(e, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(201)) and got[1050] == 1000
    assert got[5000] == got[4999] == 4000 and len(got) == 201 + 100 + 3
    assert near_dedup.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pruning_keeps_what_could_reach_the_threshold():
    least = near_dedup.least_matches(0.8, 1e-6, 160)
    assert sorted(least) == [32, 64, 96, 128, 160]
    assert all(least[n] < 0.8 * n for n in least) and least[160] > 70


# --- packing ----------------------------------------------------------------------

def test_differencing_partitions_every_piece():
    r = np.random.default_rng(4)
    for n, m in ((1, 1), (5, 8), (40, 7), (200, 50), (0, 3)):
        sizes = [int(x) for x in r.integers(1, 500, n)]
        w = packing.differencing(sizes, m)
        assert len(w) == m and sorted(i for x in w for i in x) == list(range(n))
    sizes = [int(x) for x in r.integers(1, 500, 300)]
    sums = [sum(sizes[i] for i in x) for x in packing.differencing(sizes, 30)]
    assert max(sums) - min(sums) < 60
    # the textbook case: differencing {8,7,6,5,4} two ways leaves a difference of two
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in x) for x in packing.differencing([8, 7, 6, 5, 4], 2)) == [14, 16]


def test_windows_rise_until_they_fit():
    sizes = [6, 6, 6]
    w = packing.balance(sizes, 10)
    assert len(w) == 3 and all(sum(sizes[i] for i in x) <= 10 for x in w)


def test_pieces_and_windows_hold_every_token(spark, docs, nothing):
    from tokenizers import Tokenizer
    path = packing.vocabulary_path()
    special = spark.createDataFrame([(100, "it's <|endoftext|> I'LL 12ab\x1cx　y Ünï 'S\x85ÀÉß½²µª\xa0it’s don't İI ÿ\xad×÷ e\u0301", "", "", "", 0)], SCHEMA)
    df = docs.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(special)
    pieces = packing.materialise(packing.token_pieces(df, with_ids=True), "test-pieces")
    rows = packing.pack(pieces).collect()
    t = Tokenizer.from_file(path)
    texts = {r["doc_id"]: r["text"] or "" for r in df.collect()}
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert set(by) == set(texts)
    for i, rs in by.items():
        ids = t.encode(texts[i], add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(rs, key=lambda r: r["start"]):
            part = np.array(ids[at:at + r["length"]], dtype="<u4").tobytes()
            assert r["start"] == at and r["ids"] == part and r["ids_crc32"] == zlib.crc32(part)
            assert r["doc_tokens"] == len(ids)
            at += r["length"]
        assert at == len(ids)
    seq = {}
    for r in rows:
        seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(seq) == list(range(len(seq)))
    for parts in seq.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= packing.CAPACITY
    none = packing.materialise(packing.token_pieces(nothing), "test-none")
    assert packing.pack(none).count() == 0
