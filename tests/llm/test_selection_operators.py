"""Importance resampling, the Merkle manifest and substring dedup, against brute force, with
awkward rows: nulls, empty and blank texts, repeated rows and keys, ties, long words
and texts, empty tables and extra columns with clashing names."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabfit.llm import merkle, near_dedup, queries, resampling, substring_dedup
from tabfit.llm.common import copies, join_spread, materialise, places

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, weight string, id string, hash int, kept string"
PASSAGE = " ".join(f"p{i}" for i in range(45))
BODY = " ".join(f"Body{i}, é{i % 7}" for i in range(60))
TEXTS = [None, "", " \t\n", "one", PASSAGE, f"intro {PASSAGE} outro", PASSAGE, BODY, BODY.upper(), "A b-C ünï 日本 x9",
         "z" * 200 + " y " + "w" * 64 + " " + "v" * 63, ("same " * 80).strip(), f"{PASSAGE}\n{PASSAGE}",
         " ".join(f"q{i % 5}" for i in range(300)), "alpha " * 19 + "beta", PASSAGE[:-3] + " changed " + PASSAGE]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ("a", "b", None)[i % 3], "en", None if t is None else len(t), "x", "y", 1, "k") for i, t in enumerate(TEXTS)]
    rows += [rows[5], rows[5], rows[7], (4, "other text " + PASSAGE, "a", None, 3, None, None, None, None),
             (None, "null key " + BODY, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# --- helpers ------------------------------------------------------------------

def test_places_and_copies(spark):
    rows = spark.createDataFrame([(g, k, n) for g in ("a", None, "b") for k, n in ((3, 2), (1, 1), (2, 5))],
                                 "g string, k int, __n long")
    got = places(rows, "g", [F.col("k")], "test-places", rows_per_range=2).collect()
    assert {(r["g"], r["k"]): (r["__place"], r["__size"]) for r in got} == {
        (g, k): (p, 8) for g in ("a", None, "b") for k, p in ((1, 0), (2, 1), (3, 6))}
    assert sorted((r["k"], r["__i"]) for r in copies(rows.where("g = 'a'")).collect()) == [
        (k, i) for k, n in ((1, 1), (2, 5), (3, 2)) for i in range(n)]


def test_hot_keys_join_where_they_lie(spark):
    left = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50).alias("k"), "id")
    right = materialise(left.groupBy("k").agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("lo")), "test-right")
    right = right.where("k <> 7")
    for how in ("inner", "left"):
        got = join_spread(left, right, "k", "c", how)
        want = left.join(right, "k", how)
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


# --- resampling -----------------------------------------------------------------

def _features(t):
    w = re.findall(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").encode().lower())
    return len(w), [b" ".join(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def _resampled(rows, target, percent, min_words, buckets=10_000):
    S, T = Counter(), Counter()
    bucket = [(n, [zlib.crc32(x) % buckets for x in f]) for n, f in (_features(t) for _, t in rows)]
    for _, f in bucket:
        S.update(f)
    for t in target:
        T.update(zlib.crc32(x) % buckets for x in _features(t)[1])
    s, t = sum(S.values()), sum(T.values())
    gain = [math.floor(1000 * math.log((T[b] + 1) * (s + buckets) / ((S[b] + 1) * (t + buckets)))) for b in range(buckets)]
    out = []
    for (i, _), (n, f) in zip(rows, bucket):
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        out.append([i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), None, n >= min_words])
    able = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = k + 1
    return Counter(tuple(r[:5]) for r in out)


@pytest.mark.parametrize("percent,min_words", [(5, 20), (50, 3), (100, 0), (0, 0), (30, 0)])
def test_resampling_equals_brute_force(spark, docs, percent, min_words):
    target = spark.createDataFrame([(PASSAGE,), (None,), ("A b",)], "text string")
    got = resampling.resample(docs, target, percent=percent, min_words=min_words)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert Counter(tuple(r) for r in got.collect()) == _resampled(rows, [PASSAGE, None, "A b"], percent, min_words)


def test_resampling_in_small_pieces(spark, monkeypatch, docs):
    monkeypatch.setattr(resampling, "WORDS_AT_ONCE", 7)
    monkeypatch.setattr(resampling, "TEXT_SLICE", 11)
    texts = [(t or "").encode() for t in TEXTS]
    owner, found, words = (np.concatenate(x) for x in zip(*resampling.run_buckets(iter(texts), resampling._Crcs(), 997)))
    for i, t in enumerate(TEXTS):
        n, f = _features(t)
        assert Counter(found[owner == i].tolist()) == Counter(zlib.crc32(x) % 997 for x in f)
        assert (words == i).sum() == n


def test_cutoff_among_many_equal_scores(spark):
    """One row repeated over and over, equal scores of several keys, and keys at both ends."""
    rows = spark.createDataFrame([(k, 7, n) for k, n in ((5, 3), (-9, 2), (2 ** 62, 4), (-2 ** 63, 1))] + [(1, 9, 2)],
                                 "k long, score long, __n long")
    for wanted in range(1, 13):
        cut, above = resampling._at_least(rows, "score", wanted, 7, 9)
        assert (cut, above) == ((9, 0) if wanted <= 2 else (7, 2))
    same = spark.range(3000).select(F.lit(8).cast("long").alias("doc_id"), F.lit("w " * 30).alias("text"))
    got = resampling.resample(same, same.limit(1), percent=10).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 301)) and len(got) == 3000


def test_resampling_of_empty_tables(spark, docs, nothing):
    assert resampling.resample(nothing, docs).count() == 0
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = resampling.resample(docs, nothing)
    assert Counter(tuple(r) for r in got.collect()) == _resampled(rows, [], 5, 20)
    with pytest.raises(ValueError):
        resampling.resample(docs, docs, key="text")


# --- merkle -----------------------------------------------------------------------

def _h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def _tree(nodes, fanout):
    paths, pos, cur = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(cur) > 1:
        for j in range(len(nodes)):
            a = pos[j] // fanout * fanout
            paths[j].append(("".join(cur[a:pos[j]]), "".join(cur[pos[j] + 1:a + fanout])))
            pos[j] //= fanout
        cur = [_h("".join(cur[a:a + fanout])) for a in range(0, len(cur), fanout)]
    return cur[0], paths


def _manifest(rows, fanout):
    """rows: (key, group, leaf); (key, group, leaf, subroot, root, path) of each."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    found, subroots = [], []
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        root, paths = _tree([r[2] for r in groups[g]], fanout)
        subroots.append(root)
        found.append(paths)
    root, tops = _tree(subroots, fanout)
    return [(*r, s, root, tuple(p + top)) for g, s, top, paths in zip(order, subroots, tops, found)
            for r, p in zip(groups[g], paths)]


@pytest.mark.parametrize("sizes,fanout", [((1,), 16), ((40, 3, 1, 17), 16), ((300, 16, 257), 16), ((9, 2, 1, 1, 1, 8), 2)])
def test_manifest_equals_brute_force(spark, sizes, fanout):
    rows = [(k * 7 % n if n > 1 else 5, None if g == 1 else f"é{g}", _h(f"{g}:{k}")) for g, n in enumerate(sizes) for k in range(n)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "k long, s string, leaf string, idx string, left int").repartition(3)
    got = merkle.manifest(df, "k", "s", ["idx"], fanout).collect()
    assert sorted((str(r["k"]), str(r["s"]), r["leaf"], r["subroot"], r["root"],
                   tuple((p["left"], p["right"]) for p in r["path"])) for r in got) == sorted(
        (str(k), str(s), *rest) for k, s, *rest in _manifest(rows, fanout))
    assert all(r["idx"] == "x" for r in got)


def test_proofs_lead_to_the_root_and_show_changes(spark, docs, nothing):
    cols = [F.col(c) for c in merkle.LEAF_COLUMNS]
    rows = docs.select("doc_id", "source", merkle.leaf_hash(cols).alias("leaf"), merkle.leaf_hash(cols[:-1]).alias("other"))
    m = merkle.manifest(rows, "doc_id", "source", ["other"])
    got = m.withColumn("ok", merkle.fold(F.col("path"), F.col("leaf")) == F.col("root")).withColumn(
        "bad", merkle.fold(F.col("path"), F.col("other")) == F.col("root")).collect()
    assert len(got) == docs.count() and all(r["ok"] and not r["bad"] for r in got)

    def leaf(r):
        return _h("".join("-" if r[c] is None else f"{len(str(r[c]).encode())}:{r[c]}" for c in merkle.LEAF_COLUMNS))
    assert sorted(r["leaf"] for r in got) == sorted(leaf(r) for r in docs.collect())
    assert merkle.manifest(nothing.withColumn("leaf", F.lit("x")), "doc_id", "source", []).count() == 0


# --- substring dedup -----------------------------------------------------------------

def _dedup(rows, words, folds=None):
    """rows: (key, text), distinct; {(key, text): (n_words, n_removed, kept)}."""
    folds = folds or defaultdict(int)
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, folds[r[1] or ""])):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        gone = set()
        for a in range(len(w) - words + 1):
            k = tuple(w[a:a + words])
            if k in seen:
                gone.update(range(a, a + words))
            seen.add(k)
        out[i, t or ""] = len(w), len(gone), " ".join(x for a, x in enumerate(w) if a not in gone)
    return out


def test_difference_cover():
    for i in range(substring_dedup.PERIOD):
        for j in range(substring_dedup.PERIOD):
            assert any((i + d) % 13 in substring_dedup.COVER and (j + d) % 13 in substring_dedup.COVER for d in range(13))
    for n in (0, 1, 12, 13, 40):
        assert substring_dedup.cover_positions(n).tolist() == [p for p in range(n) if p % 13 in (0, 1, 3, 9)]


@pytest.mark.parametrize("words", [20, 14])
def test_substring_dedup_equals_brute_force(docs, nothing, words):
    got = substring_dedup.dedup_substrings(docs, words=words).collect()
    assert len(got) == docs.count()
    folds = {r["t"]: r["f"] for r in docs.select(F.coalesce("text", F.lit("")).alias("t"), substring_dedup._fold(
        F.coalesce("text", F.lit("")).cast("binary")).alias("f")).collect()}
    expected = _dedup({(r["doc_id"], r["text"]) for r in docs.collect()}, words, folds)
    by_key = defaultdict(Counter)
    for r in docs.collect():
        by_key[r["doc_id"]][expected[r["doc_id"], r["text"] or ""]] += 1
    found = defaultdict(Counter)
    for r in got:
        found[r["doc_id"]][r["n_words"], r["n_removed"], bytes(r["kept"]).decode()] += 1
    assert found == by_key
    assert substring_dedup.dedup_substrings(nothing).count() == 0
    with pytest.raises(ValueError):
        substring_dedup.dedup_substrings(docs, words=13)


def test_random_overlaps(spark, monkeypatch):
    """Runs of a small vocabulary cut at all offsets, in batches of several sizes."""
    r = np.random.default_rng(3)
    base = [f"w{k}" for k in r.integers(0, 40, 400)]
    rows = []
    for i in range(80):
        a, n = int(r.integers(0, 370)), int(r.integers(1, 90))
        rows.append((i, " ".join([f"u{i}_{k}" for k in range(int(r.integers(0, 9)))] + base[a:a + n] + [f"v{i}"])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    expected = _dedup(set(rows), 20)
    for rows_at_once, size in ((2000, 1 << 25), (3, 2000)):
        monkeypatch.setattr(substring_dedup, "ROWS_AT_ONCE", rows_at_once)
        monkeypatch.setattr(substring_dedup, "BYTES_PER_PARTITION", size)
        got = substring_dedup.dedup_substrings(df).collect()
        assert {(x["doc_id"], x["n_words"], x["n_removed"], bytes(x["kept"]).decode()) for x in got} == {
            (i, *v) for (i, _), v in expected.items()}


def test_texts_in_slices(monkeypatch):
    text = ("äb  c\td\n" * 50 + "long" * 30).encode()
    whole = substring_dedup.word_hashes(text, substring_dedup._Hashes())
    monkeypatch.setattr(substring_dedup, "TEXT_SLICE", 7)
    assert (substring_dedup.word_hashes(text, substring_dedup._Hashes()) == whole).all()
    assert [w for part in substring_dedup.word_slices(text) for w in part] == text.split()


# --- near duplicates: rows that share a key ----------------------------------------------

def test_near_duplicates_with_shared_keys_do_not_depend_on_partitioning(spark):
    a = " ".join(f"a{i}" for i in range(40))
    rows = [(1, a), (1, "quite another text here"), (2, a + " tail"), (3, "quite another text here"), (3, "quite another text here")]
    seen = set()
    for n in (1, 2, 5):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(n)
        got = near_dedup.near_duplicates(df, words=2)
        seen.add(tuple(sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got.collect())))
    assert len(seen) == 1
    with pytest.raises(ValueError):
        near_dedup.near_duplicates(df, percent=50)


# --- the registered queries ------------------------------------------------------------

@pytest.mark.parametrize("name", ["op11_resampling", "op12_merkle", "op13_substring_dedup"])
def test_queries_read_whole_tables(spark, name):
    got = queries.QUERIES[name](spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    if name == "op12_merkle":
        altered = got.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
        assert altered.where("verified").count() < altered.count() and got.select("root").distinct().count() == 1
