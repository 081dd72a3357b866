"""Operator 13: duplicated passages, found from anchors at difference-cover positions.

A window is ``words`` consecutive words of a document; a word is removed if a window
over it has the same words as one that starts earlier (smaller key, or the same
document further front).

*Anchors.*  Positions are taken modulo ``PERIOD`` = 13.  The residues ``COVER`` =
{0, 1, 3, 9} form a difference cover: every difference modulo 13 is one of two of them.
So for any two places i, j there is an offset below 13 at which both i + offset and
j + offset have residues of the cover: two equal windows of 20 words share an aligned
anchor, the 8 words from there.  Only 4 of 13 positions are hashed and shuffled.

*Extension.*  An anchor that occurs twice is extended to the windows that hold it, at
most 13, and these are compared by 128-bit hashes of all their words; the earliest
occurrence of each is its origin, all others are removed.  Anchors only choose what
is compared, so their 64-bit hashes cannot cause a removal.

No pair is ever formed, and no passage, however common, is gathered in a task: before
hashes are shuffled, a batch of documents keeps one occurrence of each (the earliest,
for windows); of the others it is certain already that they are repeated (later).  So a
hash crosses the network once a batch at most.  Hashes travel as arrays, cut into
slices of the hash space, whose number follows from the size of the texts.  Texts are
shuffled only of documents with repeated anchors and, at the end, with removed words:
a bitmap of their keys, of bounded size, lets the readers pass the others by.  Of
documents with equal texts only the first is compared; the others lose all words if
they have a window at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfit.llm.common import materialise, ship, table, text_or_empty

WINDOW = 20
#: A perfect difference set and its modulus.
PERIOD, COVER = 13, (0, 1, 3, 9)
WORDS_KEPT = 100_000
TEXT_SLICE = 1 << 20
#: Bytes of text for each partition of shuffled hashes, and slices of hashes in one.
BYTES_PER_PARTITION = 32 << 20
SLICES = 8
#: Documents whose words are laid out together.
ROWS_AT_ONCE = 2_000
#: Bits of the bitmap of keys, at most (16 MB).
MARK_BITS = 1 << 27
_SPACES = b" \t\n\x0b\x0c\r"


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


class _Digests(dict):
    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= WORDS_KEPT:
            self.clear()
        h = self[word] = xxhash.xxh3_128_digest(word)
        return h


def word_slices(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, slice by slice; no word is cut."""
    at = 0
    while at < len(text):
        end = min(len(text), at + TEXT_SLICE)
        while end < len(text) and text[end] not in _SPACES:
            end += 1
        yield text[at:end].split()
        at = end


def word_hashes(text: bytes, hashes: dict) -> np.ndarray:
    """64-bit hashes of the words of a text."""
    parts = [np.fromiter(map(hashes.__getitem__, w), dtype=np.uint64, count=len(w)) for w in word_slices(text)]
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)


def word_digests(text: bytes, digests: dict) -> np.ndarray:
    """128-bit hashes of the words of a text, as two columns."""
    parts = [np.frombuffer(b"".join(map(digests.__getitem__, w)), dtype="<u8").reshape(-1, 2) for w in word_slices(text)]
    return np.concatenate(parts) if parts else np.empty((0, 2), dtype=np.uint64)


def window_hash(h: np.ndarray, starts: np.ndarray, words: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the ``words`` word hashes from each of ``starts``."""
    s = np.full(len(starts), np.uint64(words + (seed << 32)), dtype=np.uint64)
    for k in range(words):
        s = (s ^ h[starts + k]) * np.uint64(0x9E3779B97F4A7C15)
        s ^= s >> np.uint64(29)
    return s


def cover_positions(n: int) -> np.ndarray:
    """The positions below ``n`` whose residue is in the cover, ascending."""
    at = np.arange(0, n, PERIOD)[:, None] + np.array(COVER)
    at = at.reshape(-1)
    return at[at < n]


def _anchor_length(words: int) -> int:
    if words <= PERIOD:
        raise ValueError(f"a window needs more than {PERIOD} words")
    return words - PERIOD + 1


def _source(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("id"), text_or_empty(text).cast("binary").alias("t"))


def _partitions(src: DataFrame) -> int:
    size = src.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    return max(1, -(-size // BYTES_PER_PARTITION))


def _cut(columns: list[pa.Array], p: np.ndarray, kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    """One row for each value of ``p``: it, and the columns' values there as lists."""
    order = np.argsort(p, kind="stable")
    slices, first = np.unique(p[order], return_index=True)
    offsets = pa.array(np.append(first, len(p)).astype(np.int32))
    take = pa.array(order)
    lists = [pa.ListArray.from_arrays(offsets, c.take(take)).cast(pa.list_(k)) for c, k in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays([pa.array(slices.astype(np.int32))] + lists, ["p"] + names)


def _by_document(ids: pa.Array, extra: list[np.ndarray], value: np.ndarray, names: list[str], kinds) -> pa.RecordBatch:
    """Rows ``id, extra..., values`` from entries that belong to documents."""
    code = _rank(ids)
    order = np.lexsort((value, *extra[::-1], code))
    keys = [code[order]] + [e[order] for e in extra]
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(new)
    offsets = pa.array(np.append(first, len(order)).astype(np.int32))
    lists = pa.ListArray.from_arrays(offsets, pa.array(value[order].astype(np.int32)))
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(order[first]))] + [pa.array(e[order][first], k) for e, k in zip(extra, kinds)] + [lists], names)


def _rank(ids: pa.Array) -> np.ndarray:
    """Dense ranks in Spark's order; a null comes first."""
    return pc.rank(ids, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(lo, ROWS_AT_ONCE)


def repeated_anchors(src: DataFrame, words: int) -> DataFrame:
    """``id, ats``: the places of the anchors that occur more than once, in parts."""
    length = _anchor_length(words)
    n = _partitions(src)
    spark_id = src.schema["id"].dataType.simpleString()

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            which, at, key = [], [], []
            for i, t in enumerate(batch.column(1)):
                h = word_hashes(t.as_py(), hashes)
                pos = cover_positions(len(h) - length + 1)
                if len(pos):
                    which.append(np.full(len(pos), i, dtype=np.int32))
                    at.append(pos.astype(np.int32))
                    key.append(window_hash(h, pos, length))
            if not key:
                continue
            which, at, key = np.concatenate(which), np.concatenate(at), np.concatenate(key)
            order = np.argsort(key, kind="stable")
            k = key[order]
            new = np.concatenate(([True], k[1:] != k[:-1]))
            again = ~new
            first_of_many = new & np.append(again[1:], False)
            # one of each hash is shuffled by it; places that are certain go by any key
            certain = np.zeros(len(key), dtype=bool)
            certain[order[again | first_of_many]] = True
            sent = order[new]
            slice_of = (key % np.uint64(n * SLICES)).astype(np.int64)
            ids = batch.column(0)
            yield _cut([pa.array(key[sent].view(np.int64)), ids.take(pa.array(which[sent])),
                        # a hash that is certain to be repeated is sent without a place
                        pa.array(np.where(certain[sent], -1, at[sent]).astype(np.int32))],
                       slice_of[sent], [pa.int64(), ids.type, pa.int32()], ["ks", "ids", "ats"])
            sure = np.flatnonzero(certain)
            if len(sure):
                c = _cut([ids.take(pa.array(which[sure])), pa.array(at[sure])], slice_of[sure], [ids.type, pa.int32()],
                         ["ids", "ats"])
                none = pa.array([[]] * c.num_rows, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([c.column(0), none, c.column(1), c.column(2)], ["p", "ks", "ids", "ats"])

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ks, at, ids = [], [], []
        for batch in batches:
            sizes = np.diff(batch.column(1).offsets.to_numpy())
            for i in range(batch.num_rows):
                d, a = batch.column(2)[i].values, batch.column(3)[i].values.to_numpy()
                if sizes[i] == 0:
                    yield _by_document(d, [], a, ["id", "ats"], [])
                else:
                    ks.append(batch.column(1)[i].values.to_numpy())
                    ids.append(d)
                    at.append(a)
        if not ks:
            return
        k, at, ids = np.concatenate(ks), np.concatenate(at), pa.concat_arrays(ids)
        order = np.argsort(k, kind="stable")
        same = k[order][1:] == k[order][:-1]
        twice = np.concatenate((same, [False])) | np.concatenate(([False], same))
        hit = order[twice]
        hit = hit[at[hit] >= 0]
        if len(hit):
            yield _by_document(ids.take(pa.array(hit)), [], at[hit], ["id", "ats"], [])

    sent = src.mapInArrow(lambda b: anchors(_pieces(b)), f"p int, ks array<bigint>, ids array<{spark_id}>, ats array<int>")
    return sent.repartition(n, "p").mapInArrow(repeated, f"id {spark_id}, ats array<int>")


def marks(ids: DataFrame) -> tuple[np.ndarray, int]:
    """A bitmap, as bytes, with a bit for the hash of every ``id`` of a written table, and
    its number of bits: 16 per id, ``MARK_BITS`` at most.  Beyond that it lets more through."""
    size = 1 << min(MARK_BITS.bit_length() - 1, max(20, (16 * ids.count()).bit_length()))
    at = F.pmod(F.xxhash64("id"), F.lit(size)) + 1  # bitmaps count from 1
    parts = ids.groupBy(F.bitmap_bucket_number(at).alias("n")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("b"))
    bits = np.zeros(size // 8, dtype=np.uint8)
    for r in parts.toLocalIterator():
        part = np.frombuffer(r["b"], dtype=np.uint8)
        bits[(r["n"] - 1) * len(part):r["n"] * len(part)] = part
    return bits, size


def marked(src: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``src (id, t)`` in two: the rows whose ``id`` may be in the written table ``ids``, and others."""
    bits, size = marks(ids)
    shared = src.sparkSession.sparkContext.broadcast(bits)  # bounded: 16 MB

    id_type = src.schema["id"].dataType.simpleString()
    at = src.select("id", "t", F.pmod(F.xxhash64("id"), F.lit(size)).alias("at"))

    def part(wanted: int):
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                a = batch.column(2).to_numpy()
                yield batch.filter(pa.array((shared.value[a >> 3] >> (a & 7) & 1) == wanted)).select(["id", "t"])
        return at.mapInArrow(keep, f"id {id_type}, t binary")

    return part(1), part(0)


def _equal_texts(src: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The first document of every text (``id``), and the others (``id, th``)."""
    every = src.select("id", F.md5("t").alias("digest"), _fold("t").alias("th"))
    firsts = materialise(every.groupBy("digest").agg(F.min(F.struct("id")).alias("o")).select("o.id", "digest"), "first-texts")
    # by their own key, so that no text, however common, is one key
    own = firsts.select(F.col("id").alias("i2"), F.col("digest").alias("d2"))
    others = every.join(own, F.col("id").eqNullSafe(F.col("i2")) & (F.col("digest") == F.col("d2")), "left_anti")
    return firsts, others.select("id", "th").distinct()


def _fold(text: str) -> Column:
    """A number below 2 ** 31 that tells texts of one key apart."""
    return F.pmod(F.xxhash64(text), F.lit(1 << 31)).cast("int")


def later_places(src: DataFrame, places: DataFrame, words: int) -> DataFrame:
    """``id, th, later``, in parts: of the windows over ``places (id, ats)`` the starts of those
    that occur earlier, in the document with this key and fold of its text."""
    near, _ = marked(src, places.select("id"))
    length, n = _anchor_length(words), _partitions(src)
    spark_id = src.schema["id"].dataType.simpleString()
    pl = places.select(F.col("id").alias("__id"), "ats")
    joined = near.join(pl, F.col("id").eqNullSafe(F.col("__id"))).select("id", "t", "ats", _fold("t").alias("th"))

    def earliest(h1, h2, ids, th, start):
        """Order by hash, then place; and where each hash's first row is in it."""
        order = np.lexsort((start, th, _rank(ids), h2, h1))
        a, b = h1[order], h2[order]
        return order, np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = _Digests()
        for batch in batches:
            which, start, h1, h2 = [], [], [], []
            for i, (t, ats) in enumerate(zip(batch.column(1), batch.column(2))):
                h = word_digests(t.as_py(), digests)
                at = ats.values.to_numpy(zero_copy_only=False).astype(np.int64)
                # rows that share a key have each other's anchors: places beyond the text go
                s = (at[:, None] - np.arange(words - length + 1)).reshape(-1)
                s = np.unique(s[(s >= 0) & (s <= len(h) - words)])
                if len(s):
                    which.append(np.full(len(s), i, dtype=np.int32))
                    start.append(s.astype(np.int32))
                    h1.append(window_hash(np.ascontiguousarray(h[:, 0]), s, words, 1))
                    h2.append(window_hash(np.ascontiguousarray(h[:, 1]), s, words, 2))
            if not which:
                continue
            which, start, h1, h2 = (np.concatenate(v) for v in (which, start, h1, h2))
            ids = batch.column(0).take(pa.array(which))
            th = batch.column(3).to_numpy()[which]
            order, new = earliest(h1, h2, ids, th, start)
            slice_of = (h1 % np.uint64(n * SLICES)).astype(np.int64)
            sent, late = order[new], order[~new]
            names, kinds = ["h1s", "h2s", "ids", "ths", "starts"], [pa.int64(), pa.int64(), ids.type, pa.int32(), pa.int32()]
            # the earliest of the batch is shuffled; the others are later for certain,
            # but for repeated rows of one document
            yield _cut([pa.array(h1[sent].view(np.int64)), pa.array(h2[sent].view(np.int64)), ids.take(pa.array(sent)),
                        pa.array(th[sent]), pa.array(start[sent])], slice_of[sent], kinds, names)
            late = late[~_same_place(ids, th, start, order, new)[~new]]
            if len(late):
                c = _cut([ids.take(pa.array(late)), pa.array(th[late]), pa.array(start[late])], slice_of[late], kinds[2:], names[2:])
                none = pa.array([[]] * c.num_rows, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([c.column(0), none, none, *c.columns[1:]], ["p"] + names)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], [], []]
        for batch in batches:
            sizes = np.diff(batch.column(1).offsets.to_numpy())
            for i in range(batch.num_rows):
                v = [batch.column(k)[i].values for k in range(1, 6)]
                if sizes[i] == 0:
                    yield _by_document(v[2], [v[3].to_numpy()], v[4].to_numpy(), ["id", "th", "later"], [pa.int32()])
                else:
                    for h, x in zip(held, v):
                        h.append(x)
        if not held[0]:
            return
        h1, h2, ids, th, start = (pa.concat_arrays(h) for h in held)
        h1, h2, th, start = (x.to_numpy() for x in (h1, h2, th, start))
        order, new = earliest(h1, h2, ids, th, start)
        late = order[~new & ~_same_place(ids, th, start, order, new)]
        if len(late):
            yield _by_document(ids.take(pa.array(late)), [th[late]], start[late], ["id", "th", "later"], [pa.int32()])

    sent = joined.mapInArrow(lambda b: extend(_pieces(b)), f"p int, h1s array<bigint>, h2s array<bigint>, ids array<{spark_id}>, "
                                                           "ths array<int>, starts array<int>")
    return sent.repartition(n, "p").mapInArrow(judge, f"id {spark_id}, th int, later array<int>")


def _same_place(ids: pa.Array, th: np.ndarray, start: np.ndarray, order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """For the rows in ``order``: is it the same place as the first of its hash (a repeated row)?"""
    first = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    code = _rank(ids)
    return (code[order] == code[first]) & (th[order] == th[first]) & (start[order] == start[first])


def later_windows(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WINDOW) -> DataFrame:
    """``id, th, later, copy``: the starts, in the document with this key and fold of its text, of
    windows that occur earlier; or that its whole text is that of an earlier document."""
    ship(docs.sparkSession)
    src = _source(docs, key, text)
    firsts, copies = _equal_texts(src)
    places = repeated_anchors(src, words).groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("ats"))).alias("ats"))
    # of equal texts only the first is compared
    own = firsts.select(F.col("id").alias("i2")).distinct()
    places = materialise(places.join(own, F.col("id").eqNullSafe(F.col("i2")), "left_semi"), "anchors")
    later = later_places(src, places, words).groupBy("id", "th").agg(F.flatten(F.collect_list("later")).alias("later"))
    whole = copies.select("id", "th", F.lit(None).cast("array<int>").alias("later"))
    both = later.unionByName(whole).groupBy("id", "th").agg(
        F.max("later").alias("later"), F.max(F.col("later").isNull()).alias("copy"))
    return materialise(both, "later-windows")


def _cleaned(words: int):
    """Reads ``id, t, later, copy`` and gives ``id, n_words, n_removed, kept``."""
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, kept = [], [], []
            for t, later, copy in zip(batch.column(1), batch.column(2), batch.column(3)):
                ws = [w for part in word_slices(t.as_py()) for w in part]
                cut = np.zeros(len(ws) + 1, dtype=np.int64)
                if copy.as_py() and len(ws) >= words:
                    cut[0] = 1
                elif later.is_valid:
                    at = np.asarray(later.values, dtype=np.int64)
                    np.add.at(cut, at, 1)
                    np.add.at(cut, at + words, -1)
                stay = np.cumsum(cut[:-1]) == 0
                n.append(len(ws))
                gone.append(int(len(ws) - stay.sum()))
                kept.append(b" ".join(ws if not gone[-1] else [w for w, k in zip(ws, stay) if k]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())],
                ["id", "n_words", "n_removed", "kept"])
    return clean


def dedup_substrings(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``n_words``, ``n_removed`` and ``kept`` (the words
    left, joined by one space, as UTF-8 bytes).

    ``key`` must name documents; rows with one key but different texts are documents of
    their own, ordered by their text's hash, and rows equal in key and text are one
    document with one answer for each.  A null key comes first.  Null, empty and blank
    texts have no words; other columns are not read; an empty table gives none."""
    src = _source(docs, key, text)
    later = later_windows(docs, key, text, words)
    id_type = src.schema["id"].dataType.simpleString()
    some, others = marked(src, later.select("id"))
    cuts = later.select(F.col("id").alias("i2"), F.col("th").alias("t2"), "later", "copy")
    joined = some.withColumn("th", _fold("t")).join(
        cuts, F.col("id").eqNullSafe(F.col("i2")) & (F.col("th") == F.col("t2")), "left")
    joined = joined.select("id", "t", "later", F.coalesce("copy", F.lit(False)).alias("copy"))
    rest = others.select("id", "t", F.lit(None).cast("array<int>").alias("later"), F.lit(False).alias("copy"))
    out = f"id {id_type}, n_words long, n_removed long, kept binary"
    clean = _cleaned(words)
    done = joined.mapInArrow(lambda b: clean(_pieces(b)), out).unionByName(rest.mapInArrow(lambda b: clean(_pieces(b)), out))
    return done.withColumnRenamed("id", key)


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their words, how many of them repeat a passage of 20 words that
    starts earlier, and the hash of the others."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    clean = dedup_substrings(docs)
    return clean.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
