"""Operator 4: near-duplicate documents by MinHash and sequential Bayesian verification.

A document is the set of its distinct word shingles.  Documents with equal sets
form a class, and only the class's least id goes on.  Its MinHash signature is
cut into bands; equal bands name candidates.  Candidates are compared signature
batch by signature batch: after ``n`` values with ``m`` agreeing, the posterior
of the similarity under a flat prior is Beta(m + 1, n - m + 1), and a pair is
dropped as soon as the probability of reaching the threshold falls below
``miss``.  Survivors are decided on their full sets.

No bucket emits all its pairs.  First each member of a bucket is compared with
the bucket's least and greatest id; the links found join most members of a group
into components.  Then only members of *different* components that still share a
bucket are compared, in blocks of rows inside the tasks: by signatures first, then,
for the members left with a partner, on their full sets.  A task returns no more
links than join the components it has seen, so what leaves it grows with the rows,
not with their pairs; pairs within a component cannot change the result.  Two
documents end in one component exactly if links connect them, as with all
candidate pairs.

A pair at the threshold shares none of the bands with probability
``(1 - threshold ** rows) ** bands`` (3e-6 for the defaults at 0.8).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfit.llm.common import join_spread, materialise, ship, table, text_or_empty

BANDS, ROWS = 32, 5
BATCH = 32
MISS = 1e-6
#: Members of a bucket compared as one block, and words remembered by a task.
BLOCK = 64
#: Blocks of a bucket for each row and column of its grid of block pairs.
GRID = 128
WORDS_KEPT = 400_000
_SLICE = 4096
#: Shingles laid out at once when the sets of two blocks are intersected.
_COLUMNS = 32_768


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingle_set(text: bytes, words: int, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``words``-word shingles of UTF-8
    ``text`` after lower-casing A-Z; one for a shorter text, none without words."""
    seq = text.lower().split()  # of bytes: both are ASCII only
    if not seq:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(hashes.__getitem__, seq), dtype=np.uint64, count=len(seq))
    k = min(words, len(h))
    s = np.full(len(h) - k + 1, np.uint64(k), dtype=np.uint64)
    for i in range(k):
        s = (s ^ h[i:len(h) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        s ^= s >> np.uint64(29)
    return np.unique(s)


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20)
    return (r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            r.integers(0, 1 << 63, n, dtype=np.uint64))


def signature(shingles: np.ndarray, mult: np.ndarray, add: np.ndarray) -> np.ndarray:
    """MinHash values: 16 bits of the least 64-bit value of each function, below its leading
    zeros.  Different values agree in them once in 65,536 times, which can only let a
    pair through to the next check."""
    out = np.full(len(mult), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), _SLICE):
        part = shingles[at:at + _SLICE]
        for k in range(0, len(mult), 16):
            v = part[None, :] * mult[k:k + 16, None]
            v += add[k:k + 16, None]
            out[k:k + 16] = np.minimum(out[k:k + 16], v.min(axis=1))
    return (out >> np.uint64(24) & np.uint64(0xFFFF)).astype("<u2")


def least_matches(threshold: float, miss: float, total: int, batch: int = BATCH) -> dict[int, int]:
    """For each number ``n`` of compared values, the fewest matches ``m`` with
    P(similarity >= threshold | m of n) >= miss.  With integer parameters the
    Beta tail is P(Binomial(n + 1, threshold) <= m)."""
    least = {}
    for n in range(batch, total + 1, batch):
        tail, m = 0.0, 0
        while m <= n:
            tail += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if tail >= miss:
                break
            m += 1
        least[n] = m
    return least


def survivors(a: np.ndarray, b: np.ndarray, least: dict[int, int]) -> np.ndarray:
    """Rows of the signature matrices ``a``, ``b`` not pruned in any batch."""
    live, matches, before = np.arange(len(a)), np.zeros(len(a), dtype=np.int32), 0
    for n, m in least.items():
        matches[live] += (a[live, before:n] == b[live, before:n]).sum(axis=1, dtype=np.int32)
        live, before = live[matches[live] >= m], n
    return live


def _as_matrix(blobs, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), dtype="<u2").reshape(-1, width)


def sketches(docs: DataFrame, key: str, text: str, words: int, bands: int, rows: int) -> DataFrame:
    """``id``, ``n`` (set size), ``cls`` (128-bit digest of the set, null if it is
    empty) and ``sig``."""
    ship(docs.sparkSession)
    mult, add = _multipliers(bands * rows)
    key_type = docs.select(F.col(key).alias("id")).schema["id"].dataType

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            n, cls, sig = [], [], []
            for t in batch.column(1):
                s = shingle_set(t.as_py(), words, hashes)
                n.append(len(s))
                cls.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sig.append(signature(s, mult, add).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.binary()), pa.array(sig, pa.binary())],
                ["id", "n", "cls", "sig"])

    src = docs.select(F.col(key).alias("id"), text_or_empty(text).cast("binary").alias("t"))
    return src.mapInArrow(sketch, f"id {key_type.simpleString()}, n long, cls binary, sig binary")


def components(links: DataFrame) -> DataFrame:
    """``id, component`` (least reachable id) of the ids in ``links (a, b)``.

    Alternating large-star and small-star rounds (Kiveris et al., 2014) until
    every id hangs on the least one it can reach; every round is a join and
    map-side combined aggregations, written to the shared folder.  A round that
    is not the last replaces links by links to lesser ids, so the loop ends."""
    e = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    e = materialise(e, "links")
    while True:
        # large star: the greater neighbours of a node move to its least neighbour
        both = e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
                 .where("a < b").distinct())
        # small star: the lesser neighbours of a node, and itself, to the least of them
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (large.join(low, "b").select(F.col("m").alias("x"), F.col("a").alias("y"))
                 .unionAll(low.select(F.col("m").alias("x"), F.col("b").alias("y")))
                 .where("x < y").distinct().select(F.col("x").alias("a"), F.col("y").alias("b")))
        nxt = materialise(small, "links")
        # done when every node hangs on one centre that hangs on nothing
        open_ends = nxt.select("a").distinct().join(nxt.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
        several = nxt.groupBy("b").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        e = nxt
        if open_ends.isEmpty() and several.isEmpty():
            break
    return (e.select(F.col("b").alias("id"), F.col("a").alias("component"))
            .unionAll(e.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()))


def _marks(ids: DataFrame) -> tuple[np.ndarray, int]:
    """A bitmap with a bit for the hash of every id of a written table, as bytes, and its
    number of bits: 16 per id, at most 2 ** 27 (16 MB).  With more ids it only lets more
    through."""
    size = 1 << min(27, max(20, (16 * ids.count()).bit_length()))
    at = F.pmod(F.xxhash64("id"), F.lit(size)) + 1  # bitmaps count from 1
    parts = ids.groupBy(F.bitmap_bucket_number(at).alias("n")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("b"))
    bits = np.zeros(size // 8, dtype=np.uint8)
    for r in parts.toLocalIterator():
        part = np.frombuffer(r["b"], dtype=np.uint8)
        bits[(r["n"] - 1) * len(part):r["n"] * len(part)] = part
    return bits, size


def _sets(docs: DataFrame, ids: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """``id, s``: the full shingle sets of the documents in ``ids (id, cls)`` (and of a few
    others).  Texts are not shuffled: the readers keep those marked in a bitmap.  Of
    rows that share a key the set of the class in ``ids`` is kept, once."""
    ids = materialise(ids, "ids")
    bits, size = _marks(ids)
    marked = docs.sparkSession.sparkContext.broadcast(bits)  # bounded: 16 MB
    src = docs.select(F.col(key).alias("id"), text_or_empty(text).cast("binary").alias("t"))
    src = src.select("id", "t", F.pmod(F.xxhash64("id"), F.lit(size)).alias("at"))
    id_type = src.schema["id"].dataType.simpleString()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bit = _WordHashes(), marked.value
        for batch in batches:
            at = batch.column(2).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array((bit[at >> 3] >> (at & 7) & 1).astype(bool)))
            s = [shingle_set(t.as_py(), words, hashes).tobytes() for t in batch.column(1)]
            cls = [hashlib.blake2b(x, digest_size=16).digest() for x in s]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cls, pa.binary()), pa.array(s, pa.binary())],
                                             ["id", "c", "s"])

    full = src.mapInArrow(sets, f"id {id_type}, c binary, s binary")
    # shuffled once, by id: the joins on id that follow read the same exchange
    full = full.repartition("id").join(ids, "id").where("c = cls").select("id", "s")
    return full.dropDuplicates(["id"])


def _marked(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose id is in ``ids`` (and a few others), found by a bitmap."""
    bits, size = _marks(materialise(ids, "ids"))
    marked = rows.sparkSession.sparkContext.broadcast(bits)  # bounded: 16 MB
    at = rows.withColumn("__at", F.pmod(F.xxhash64("id"), F.lit(size)))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a = batch.column(batch.num_columns - 1).to_numpy()
            batch = batch.filter(pa.array((marked.value[a >> 3] >> (a & 7) & 1).astype(bool)))
            yield batch.select(batch.schema.names[:-1])

    return at.mapInArrow(keep, rows.schema)


def _verify(docs: DataFrame, pairs: DataFrame, chosen: DataFrame, key: str, text: str, words: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach ``percent``.  A set crosses the network once for
    its id, and once more for every pair in which it has the greater id."""
    ids = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct()
    full = _sets(docs, ids.join(chosen, "id"), key, text, words)
    id_type = full.schema["id"].dataType.simpleString()

    def enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = len(np.intersect1d(p, q, assume_unique=True))
                ok.append(100 * both >= percent * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok))

    joined = (pairs.join(full.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
              .join(full.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
              .select("a", "b", "sa", "sb"))
    return joined.mapInArrow(enough, f"a {id_type}, b {id_type}")


def _mixed(member: DataFrame) -> DataFrame:
    """The rows ``bucket, band, id, comp`` of buckets with several components.  In a bucket of
    three members or fewer, the least and the greatest have met all others already."""
    several = member.groupBy("bucket").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("c")).where("lo < hi and c > 3")
    return join_spread(member, several.select("bucket", "c"), "bucket", "c").drop("c")


def _block_pairs(member: DataFrame) -> DataFrame:
    """``bucket, band, r1, r2``: pairs of blocks (arrays of ``id, comp, data``) that hold
    all pairs of a bucket's rows of different components.  Rows of a component with
    many members have blocks of their own, which are not paired with each other."""
    per_comp = member.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("m"))
    big = per_comp.where(F.col("m") >= BLOCK)
    small = per_comp.where(F.col("m") < BLOCK).groupBy("bucket").agg(F.sum("m").alias("rest"))
    m = member.join(small, "bucket", "left").join(big, ["bucket", "comp"], "left")
    parts = F.ceil(F.coalesce("m", "rest") / BLOCK)
    m = m.select("bucket", "band", "id", "comp", "data", F.when(F.col("m").isNotNull(), F.col("comp")).alias("owner"),
                 F.pmod(F.xxhash64("id"), parts).alias("part"))
    blocks = m.groupBy("bucket", "band", "owner", "part").agg(F.collect_list(F.struct("id", "comp", "data")).alias("rows"))
    blocks = materialise(blocks, "blocks")
    # the pairs of a bucket's blocks are dealt to the cells of a grid, a task's worth each
    grid = blocks.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / GRID).alias("g")).where("g > 1")
    blocks = blocks.join(grid, "bucket", "left").withColumn("g", F.coalesce("g", F.lit(1)))
    blocks = blocks.withColumn("cell", F.pmod(F.xxhash64("owner", "part"), F.col("g")))
    every = F.sequence(F.lit(0).cast("long"), F.col("g") - 1)
    x = blocks.select("bucket", "band", F.col("owner").alias("o1"), F.col("part").alias("p1"), F.col("rows").alias("r1"),
                      F.col("cell").alias("c1"), F.explode(every).alias("c2"))
    y = blocks.select("bucket", F.col("owner").alias("o2"), F.col("part").alias("p2"), F.col("rows").alias("r2"),
                      F.explode(every).alias("c1"), F.col("cell").alias("c2"))
    order1 = F.struct(F.col("o1").alias("o"), F.col("p1").alias("p"))
    order2 = F.struct(F.col("o2").alias("o"), F.col("p2").alias("p"))
    return x.join(y, ["bucket", "c1", "c2"]).where((order1 <= order2) & (
        F.col("o1").isNull() | F.col("o2").isNull() | (F.col("o1") != F.col("o2")))).select("bucket", "band", "r1", "r2")


def _columns(rows) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    return np.array([r["id"] for r in rows]), np.array([r["comp"] for r in rows]), [r["data"] for r in rows]


def _shared(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of ``x`` with all of ``y``."""
    common = np.intersect1d(np.concatenate(x), np.concatenate(y))
    out = np.zeros((len(x), len(y)), dtype=np.int64)
    for lo in range(0, len(common), _COLUMNS):
        part = common[lo:lo + _COLUMNS]

        def rows(sets: list[np.ndarray]) -> np.ndarray:
            m = np.zeros((len(sets), len(part)), dtype=np.float32)
            for i, s in enumerate(sets):
                at = np.searchsorted(part, s)
                at[at == len(part)] = 0
                m[i, at[part[at] == s]] = 1.0
            return m
        out += (rows(x) @ rows(y).T).astype(np.int64)
    return out


def _forest(links: list[tuple]) -> list[tuple]:
    """Of links (component, component, id, id), the ids of those that join something."""
    up: dict = {}

    def root(v):
        while up.setdefault(v, v) != v:
            up[v] = up[up[v]]
            v = up[v]
        return v
    out = []
    for c, d, a, b in links:
        c, d = root(c), root(d)
        if c != d:
            up[max(c, d)] = min(c, d)
            out.append((min(a, b), max(a, b)))
    return out


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5,
                    percent: int = 80, bands: int = BANDS, rows: int = ROWS, miss: float = MISS) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``n_shingles``, ``component_id`` (the
    least key reachable over links, itself included) and ``kept`` (it is that key).

    Two documents are linked if ``100 * intersection >= percent * union`` of their
    shingle sets.  Texts without words (or null) link with nothing.  ``key`` must
    name rows; rows repeated with one key get one answer each, from the least
    class among them, and rows with a null key are their own component."""
    width = bands * rows
    if (1 - (percent / 100) ** rows) ** bands > 1e-5:
        raise ValueError(f"{bands} bands of {rows} values miss too many pairs at {percent} %: choose more bands or fewer rows")
    sk = materialise(sketches(docs, key, text, words, bands, rows), "sketches")
    named = sk.where("id is not null and cls is not null")
    classes = named.groupBy("cls").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("m"))
    classes = materialise(classes, "classes")
    # an id that leads several classes (rows that share a key) stands for the least of them
    chosen = materialise(classes.groupBy(F.col("rep").alias("id")).agg(F.min("cls").alias("cls")), "leaders")
    # one shuffle of the signatures; a leader's repeated rows differ in nothing
    reps = named.select("id", "cls", "n", "sig").join(chosen, ["id", "cls"], "left_semi").dropDuplicates(["id", "cls"])
    reps = materialise(reps.select("id", "n", "sig"), "representatives")
    id_type = reps.schema["id"].dataType.simpleString()
    least = least_matches(percent / 100, miss, width)

    keyed = reps.select("id", F.inline(F.array(*[F.struct(F.lit(i).alias("band"), F.xxhash64(
        F.lit(i), F.substring("sig", 2 * rows * i + 1, 2 * rows)).alias("bucket")) for i in range(bands)])))
    shared = keyed.groupBy("bucket").agg(
        F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("c")).where("lo < hi")
    shared = materialise(shared, "shared-buckets")
    buckets = materialise(join_spread(keyed, shared, "bucket", "c").drop("c"), "buckets")

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, q = (batch.column(i).to_numpy() for i in (4, 5))
            # sets of too different a size cannot reach the threshold
            batch = batch.filter(pa.array(100 * np.minimum(p, q) >= percent * np.maximum(p, q)))
            a, b = (_as_matrix([v.as_py() for v in batch.column(i)], width) for i in (2, 3))
            live = survivors(a, b, least)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).take(pa.array(live))

    # members against the least and the greatest of their bucket
    spokes = buckets.select(F.inline(F.array(
        F.struct(F.col("lo").alias("a"), F.col("id").alias("b")),
        F.struct(F.col("id").alias("a"), F.col("hi").alias("b"))))).where("a < b").distinct()
    spokes = materialise(spokes, "spokes")
    # signatures of the ids in spokes only, shuffled once: both joins read the same exchange
    sig = _marked(reps, spokes.select(F.col("a").alias("id")).unionAll(spokes.select(F.col("b").alias("id"))).distinct())
    sig = sig.repartition("id")
    met = (spokes.join(sig.select(F.col("id").alias("b"), F.col("sig").alias("y"), F.col("n").alias("nb")), "b")
           .join(sig.select(F.col("id").alias("a"), F.col("sig").alias("x"), F.col("n").alias("na")), "a")
           .select("a", "b", "x", "y", "na", "nb"))
    near = materialise(met.mapInArrow(prune, f"a {id_type}, b {id_type}"), "near")
    links = materialise(_verify(docs, near, chosen, key, text, words, percent), "first-links")

    # what different components of one bucket still have to be compared
    comp = materialise(components(links), "first-components")
    member = buckets.select("bucket", "band", "id").join(comp, "id", "left").select(
        "bucket", "band", "id", F.coalesce("component", "id").alias("comp"))
    member = materialise(_mixed(materialise(member, "members")), "mixed")
    if not member.isEmpty():
        def open_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in batches:
                for bucket, band, r1, r2 in zip(frame.bucket, frame.band, frame.r1, frame.r2):
                    i1, c1, s1 = _columns(r1)
                    i2, c2, s2 = _columns(r2)
                    m1, m2 = _as_matrix(s1, width), _as_matrix(s2, width)
                    left, right = np.nonzero(c1[:, None] != c2[None, :])
                    live = survivors(m1[left], m2[right], least)
                    left, right = left[live], right[live]
                    # a pair is taken up in the first band that it shares
                    same = (m1[left] == m2[right]).reshape(len(left), bands, rows).all(axis=2)
                    here = same.argmax(axis=1) == band
                    ids = np.unique(np.concatenate((i1[left[here]], i2[right[here]])))
                    yield pd.DataFrame({"bucket": np.full(len(ids), bucket, dtype=np.int64), "id": ids})

        todo = _block_pairs(member.join(reps.select("id", F.col("sig").alias("data")), "id"))
        open_rows = todo.mapInPandas(open_pairs, f"bucket long, id {id_type}").distinct()
        left_over = materialise(member.join(open_rows, ["bucket", "id"], "left_semi"), "open")

        def join_exactly(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in batches:
                for r1, r2 in zip(frame.r1, frame.r2):
                    i1, c1, s1 = _columns(r1)
                    i2, c2, s2 = _columns(r2)
                    x, y = ([np.frombuffer(v, dtype=np.uint64) for v in s] for s in (s1, s2))
                    both = _shared(x, y)
                    size = np.array([len(v) for v in x])[:, None] + np.array([len(v) for v in y])[None, :]
                    hit = (100 * both >= percent * (size - both)) & (c1[:, None] != c2[None, :])
                    keep = _forest([(c1[i], c2[j], i1[i], i2[j]) for i, j in zip(*np.nonzero(hit))])
                    yield pd.DataFrame(keep, columns=["a", "b"], dtype=object if not keep else None)

        full = _sets(docs, left_over.select("id").distinct().join(chosen, "id"), key, text, words)
        todo = _block_pairs(left_over.join(full.select("id", F.col("s").alias("data")), "id"))
        more = todo.mapInPandas(join_exactly, f"a {id_type}, b {id_type}")
        comp = components(links.unionByName(more))
    # classes of one row that are linked with nothing need no answer from here; the rows of a
    # class ask for it by its digest, a very common one everywhere at once
    found = (classes.join(comp.withColumnRenamed("id", "rep"), "rep", "left").where("m > 1 or component < rep")
             .select("cls", F.coalesce("component", "rep").alias("__component"), "m"))
    found = materialise(found, "answers")
    out = join_spread(sk.select("id", "n", "cls"), found, "cls", "m", "left")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"),
                      F.coalesce("__component", "id").alias("component_id"),
                      F.coalesce(F.coalesce("__component", "id") == F.col("id"), F.lit(True)).alias("kept"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the least doc_id of their group, linked by two-word shingles at 0.8."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, words=2, percent=80)
