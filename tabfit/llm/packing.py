"""Operator 6: packing of token pieces by Karmarkar-Karp multiway differencing.

A document's tokens are cut into pieces: full windows of ``capacity`` tokens, and
a rest in pieces of at most ``max_piece``.  Full windows are sequences by
themselves.  The others are dealt by a hash into groups of a bounded number of
tokens, and each group is partitioned into ``m`` windows: every piece starts as a
partial partition of its own, and the two partial partitions with the greatest
imbalance are merged, the fullest windows of one with the emptiest of the other,
until one partition is left.  ``m`` starts at the least count that could hold the
group and rises until no window exceeds the capacity.

Only lengths are shuffled, never tokens.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabfit.llm.common import materialise, ship, table, text_or_empty

CAPACITY, MAX_PIECE = 2048, 512
#: Windows that one group fills, about: bounds the work and memory of a task's step.
GROUP_WINDOWS = 128
VOCABULARY = "word_bpe_49k.json"
END_ID = 1
PARTS_KEPT = 600_000

# the tokenizer's own split, for words of code points up to U+00FF in lower case
_LETTERS, _NUMBERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\s{_LETTERS}{_NUMBERS}]+")
# not white space to the tokenizer, though str.split() would split there
_ODD = re.compile("[\x1c-\x1f]")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class WordIds:
    """Token ids of texts, as bytes of unsigned 32-bit integers.

    The tokenizer lower-cases, splits a text into parts by a fixed pattern, drops
    white space, and encodes each part alone: a text's ids are its parts' ids in
    turn, and parts repeat.  Texts of code points up to U+00FF are split here by
    the same pattern.  Other words (and special tokens' strings) go through the
    whole tokenizer, as white space always ends a part."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.parts: dict[str, bytes] = {}
        # byte-level pieces: printable bytes stand for themselves, the others for
        # the code points from 256 on
        same = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        other = iter(range(256, 512))
        self.letter = [chr(b) if b in same else chr(next(other)) for b in range(256)]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _encode(self, part: str) -> bytes:
        """Ids of one unit of ``_split``: a part goes to the model as it is."""
        if part[0] == " ":
            return self._whole(part)
        if not (part.isascii() and part.isprintable()):
            part = "".join([self.letter[b] for b in part.encode()])
        return np.array([t.id for t in self.model.tokenize(part)], dtype="<u4").tobytes()

    @staticmethod
    def _plain(text: str) -> bool:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return "<|" not in text

    def _split(self, text: str) -> list[str]:
        """Units that are encoded alone, in order; those that this class has not
        split further are marked by a leading space, which the tokenizer drops."""
        if self._plain(text):
            return _PARTS.findall(text.lower())
        out: list[str] = []
        for w in text.split():
            if self._plain(w):
                out += _PARTS.findall(w.lower())
            else:
                out.append(" " + w)
        return out

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        for t in texts:
            if _ODD.search(t):
                yield self._whole(t)
                continue
            parts = self._split(t)
            new = set(parts).difference(self.parts)
            if len(self.parts) + len(new) > PARTS_KEPT:
                self.parts.clear()
                new = set(parts)
            for p in new:
                self.parts[p] = self._encode(p)
            yield b"".join(map(self.parts.__getitem__, parts))


_WORDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One per worker process and vocabulary."""
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path]


def cuts(n: int, capacity: int, max_piece: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens."""
    full = n // capacity * capacity
    out = [(s, capacity) for s in range(0, full, capacity)]
    rest = n - full
    k = -(-rest // max_piece)
    edges = [full + rest * i // k for i in range(k + 1)] if k else []
    return out + [(a, b - a) for a, b in zip(edges, edges[1:])]


def token_pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                 max_piece: int = MAX_PIECE, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """``key, start, length, ids_crc32, doc_tokens`` (and ``ids``) of every piece.

    A document's tokens are the ids of its whole text and ``END_ID``, so a null or
    empty text is one piece of one token.  Row-local: no shuffle."""
    ship(docs.sparkSession)
    path = path or vocabulary_path()
    src = docs.select(F.col(key).alias("id"), text_or_empty(text).alias("t"))
    id_type = src.schema["id"].dataType.simpleString()
    end = np.array([END_ID], dtype="<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                chunk = batch.slice(lo, 512)
                row, start, length, crc, total, ids = [], [], [], [], [], []
                for i, b in enumerate(words.ids(chunk.column(1).to_pylist())):
                    b += end
                    n = len(b) // 4
                    for s, k in cuts(n, capacity, max_piece):
                        part = b[4 * s:4 * (s + k)]
                        row.append(i)
                        start.append(s)
                        length.append(k)
                        crc.append(zlib.crc32(part))
                        total.append(n)
                        ids.append(part if with_ids else None)
                yield pa.RecordBatch.from_arrays(
                    [chunk.column(0).take(pa.array(row, pa.int64())), *[pa.array(x, pa.int64()) for x in (start, length, crc, total)],
                     pa.array(ids, pa.binary())], ["id", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    out = src.mapInArrow(pieces, f"id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, ids binary")
    out = out.withColumnRenamed("id", key)
    return out if with_ids else out.drop("ids")


def differencing(sizes: list[int], m: int) -> list[list[int]]:
    """Karmarkar-Karp: ``m`` lists of indices into ``sizes`` with near-equal sums.

    A partial partition is the sums of its windows, fullest first, without the
    empty ones.  Merging puts the fullest windows of one on the emptiest of the
    other; while both fit side by side none meet, as empty windows come first."""
    n = len(sizes)
    if m <= 1 or not n:
        return [list(range(n)), *[[] for _ in range(m - 1)]]
    heap = [(-s, i, np.array([s]), np.array([i])) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    # joined windows: id, and the two it was made of, merge by merge
    made: list[tuple[int, np.ndarray, np.ndarray]] = []
    top, tick = n, n
    while len(heap) > 1:
        _, _, a, ai = heapq.heappop(heap)
        _, _, b, bi = heapq.heappop(heap)
        meet = len(a) + len(b) - m
        if meet <= 0:
            s, ids = np.concatenate((a, b)), np.concatenate((ai, bi))
        else:
            i, j = len(a) - meet, len(b) - meet
            left, right = ai[i:][::-1], bi[j:]
            made.append((top, left, right))
            s = np.concatenate((a[:i], b[:j], a[i:][::-1] + b[j:]))
            ids = np.concatenate((ai[:i], bi[:j], np.arange(top, top + meet)))
            top += meet
        order = np.argsort(-s, kind="stable")
        s, ids = s[order], ids[order]
        low = int(s[-1]) if len(s) == m else 0
        heapq.heappush(heap, (low - int(s[0]), tick, s, ids))
        tick += 1
    window = np.empty(top, dtype=np.int64)
    window[heap[0][3]] = np.arange(len(heap[0][3]))
    for first, left, right in reversed(made):
        own = window[first:first + len(left)]
        window[left], window[right] = own, own
    out: list[list[int]] = [[] for _ in range(m)]
    for i, w in enumerate(window[:n].tolist()):
        out[w].append(i)
    return out


def balance(sizes: list[int], capacity: int) -> list[list[int]]:
    """Differencing into the fewest windows (by that method) within the capacity."""
    m = max(1, -(-sum(sizes) // capacity))
    while True:
        windows = differencing(sizes, m)
        if all(sum(sizes[i] for i in w) <= capacity for w in windows):
            return [w for w in windows if w]
        m += 1


def pack(pieces: DataFrame, length: str = "length", salt: tuple[str, ...] = ("doc_id", "start"),
         capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` (0 up, gapless) and ``offset`` of each piece.

    ``pieces`` should be a written table: it is read more than once.  Lengths must
    be 1 to ``capacity``.  ``salt`` deals the pieces out; rows that agree in it may
    share a group, whose size is bounded all the same.  Empty in, empty out."""
    ship(pieces.sparkSession)
    cols = pieces.columns
    stats = pieces.where(F.col(length) < capacity).agg(
        F.sum(length).alias("t"), F.max(length).alias("l")).first()
    groups = max(1, -(-(stats["t"] or 0) // (capacity * GROUP_WINDOWS)))
    group = F.when(F.col(length) >= capacity, F.lit(-1).cast("long")).otherwise(
        F.pmod(F.xxhash64(*salt), F.lit(groups)))
    dealt = pieces.withColumn("__g", group).withColumn("__k", F.monotonically_increasing_id())
    dealt = materialise(dealt, "dealt")
    # equal salts (repeated rows) could fill one group: such a group is split further
    full = dealt.where("__g = -1").select("*", F.col("__k").alias("__w"), F.lit(0).cast("long").alias("offset"))
    crowd = dealt.where("__g >= 0").groupBy("__g").agg(F.sum(length).alias("__t"))
    parts = F.ceil(F.col("__t") / (2 * capacity * GROUP_WINDOWS))
    rest = dealt.where("__g >= 0").join(crowd, "__g").withColumn("__p", F.pmod(F.xxhash64("__k"), parts))
    slim = rest.select("__g", "__p", "__k", F.col(length).cast("long").alias("__len"))

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["__len", "__k"], ascending=[False, True])
        sizes = [int(x) for x in frame["__len"]]
        window, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        for w, members in enumerate(balance(sizes, capacity)):
            at = 0
            for i in members:
                window[i], offset[i] = w, at
                at += sizes[i]
        return pd.DataFrame({"__k": frame["__k"], "__g": frame["__g"], "__p": frame["__p"],
                             "__w": window, "offset": offset})

    placed = slim.groupBy("__g", "__p").applyInPandas(fill, "__k long, __g long, __p long, __w long, offset long")
    placed = materialise(placed, "placed")
    # windows before each group; full windows are numbered after them, file by file
    per_group = placed.groupBy("__g", "__p").agg((F.max("__w") + 1).alias("__n"))
    block = F.floor(F.col("__g") / 1000)
    per_group = per_group.withColumn("__b", block)
    blocks = per_group.groupBy("__b").agg(F.sum("__n").alias("__bn"))
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("__b", F.coalesce(F.sum("__bn").over(before), F.lit(0)).alias("__b0"))
    inside = Window.partitionBy("__b").orderBy("__g", "__p").rowsBetween(Window.unboundedPreceding, -1)
    base = per_group.select("__b", "__g", "__p", F.coalesce(F.sum("__n").over(inside), F.lit(0)).alias("__i0"))
    base = base.join(blocks, "__b").select("__g", "__p", (F.col("__b0") + F.col("__i0")).alias("__base"))
    mixed = placed.join(base, ["__g", "__p"]).select("__k", (F.col("__base") + F.col("__w")).alias("sequence_id"), "offset")
    mixed = dealt.where("__g >= 0").join(mixed, "__k")
    used = per_group.agg(F.sum("__n").alias("n")).first()["n"] or 0
    # monotonically increasing ids are a partition number (upper bits) and a row number
    part = F.shiftright("__k", 33)
    sizes = full.groupBy(part.alias("__f")).agg(F.count(F.lit(1)).alias("__n"))
    order = Window.orderBy("__f").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("__f", F.coalesce(F.sum("__n").over(order), F.lit(0)).alias("__f0"))
    rows = Window.partitionBy("__f").orderBy("__k")
    alone = full.withColumn("__f", part).withColumn("__r", F.row_number().over(rows) - 1).join(sizes, "__f")
    alone = alone.withColumn("sequence_id", F.lit(used) + F.col("__f0") + F.col("__r"))
    out = [*[c for c in cols if c not in ("sequence_id", "offset")], "sequence_id", "offset"]
    return mixed.select(*out).unionByName(alone.select(*out))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token pieces of all documents (a null text: only the closing id) and their places
    in sequences of 2048 tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = materialise(token_pieces(docs), "pieces")
    return pack(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
