"""Operator 11: importance resampling towards a target distribution.

Documents are drawn so that their word runs look like those of a target set.  A
document's features are all runs of 1 to 3 consecutive words; a feature counts
in the bucket of its CRC-32.  The counts of the corpus and of the target give each
bucket a gain in thousandths of a nat, and a document weighs the sum of its
features' gains.  Gumbel noise from a hash of the key turns "the greatest scores"
into a draw without replacement, in proportion to the weights.

* Counting and scoring read every text once each.  Inside a task the words of many
  texts lie in arrays: the CRC-32 of a run follows from those of its words, so no
  run is ever built as a string.
* The cutoff is found by bisection, without a sort: exact count jobs over the
  written scores narrow the score, then the key among the rows with that score.
* Only the rows drawn are ranked: they are range-partitioned by score and key, and a
  range's ranks follow the rows of the ranges before it.

Rows equal in all result columns are kept as one row with a count until the end, so
one row repeated many times is never gathered in a task.  Defined results: a null
text has no features, a null key hashes as the empty key and comes after all others
in a tie; rows of equal score and key are ordered by weight, then number of features;
an empty table gives an empty result, an empty target leaves the gains to the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabfit.llm.common import copies, materialise, places, ship, table, text_or_empty

BUCKETS = 10_000
PERCENT = 5
MIN_WORDS = 20
SEED = 42
#: Words laid out in arrays at once, and distinct words remembered by a task.
WORDS_AT_ONCE = 200_000
WORDS_KEPT = 400_000
#: Bytes of one text split into words at once.
TEXT_SLICE = 1 << 20
#: Bisection steps answered by one count job (2 ** steps - 1 counts).
STEPS_PER_JOB = 4

#: Words are runs of a-z, 0-9 and characters beyond ASCII; A-Z is lowered.
_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
                  for c in range(256))
#: Words longer than this are hashed directly.
_SHORT = 63
_MASK = np.uint64(0xFFFFFFFF)


def _zero_tables() -> np.ndarray:
    """For each length n up to ``_SHORT`` + 1, four tables of 256 values: their xor over
    the bytes of a CRC state is the state after n zero bytes (CRC-32 is linear)."""
    step = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], dtype=np.uint32)
    out = np.zeros((_SHORT + 2, 4, 256), dtype=np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(1, _SHORT + 2):
        out[n] = (out[n - 1] >> np.uint32(8)) ^ step[out[n - 1] & np.uint32(255)]
    return out


_ZEROS = _zero_tables().reshape(-1)


def _after(state: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC of ``x`` + zeros, without the part of the zeros alone, for CRCs ``state``
    of ``x`` and numbers of zeros ``length`` (at most ``_SHORT`` + 1)."""
    at = length.astype(np.int64) * 1024
    out = _ZEROS[at + (state & np.uint32(255))]
    for k in (1, 2, 3):
        out = out ^ _ZEROS[at + 256 * k + ((state >> np.uint32(8 * k)) & np.uint32(255))]
    return out


#: CRC of a space followed by n zeros without the part of the zeros alone.
_SPACE = _after(np.full(_SHORT + 1, zlib.crc32(b" "), dtype=np.uint32), np.arange(_SHORT + 1))


class _Crcs(dict):
    """CRC-32 of a word, and its length (at most ``_SHORT`` + 1) above it."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        v = self[word] = zlib.crc32(word) | min(len(word), _SHORT + 1) << 32
        return v


def _slices(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, slice by slice; no word is cut."""
    at = 0
    while at < len(text):
        end = min(len(text), at + TEXT_SLICE)
        part = text[at:end].translate(_TO_WORDS)
        while end < len(text) and not part.endswith(b" "):
            more = text[end:end + 4096].translate(_TO_WORDS)
            cut = more.find(b" ")
            more = more if cut < 0 else more[:cut + 1]
            part, end = part + more, end + len(more)
        yield part.split()
        at = end


def run_buckets(texts: Iterator[bytes], crcs: dict, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For the texts in order, in pieces of bounded size: ``doc`` (number of the text)
    and ``bucket`` of every feature, and ``word_doc`` (number of the text of every word)."""
    words: list[bytes] = []
    docs: list[int] = []   # the texts of the pieces in ``words``, with their sizes
    sizes: list[int] = []
    carried = 0            # words at the front that were counted before

    def flush():
        nonlocal words, docs, sizes, carried
        w, d = words, np.repeat(np.array(docs, dtype=np.int64), sizes)
        packed = np.fromiter(map(crcs.__getitem__, w), dtype=np.uint64, count=len(w))
        one, size = (packed & _MASK).astype(np.uint32), (packed >> np.uint64(32)).astype(np.int64)
        long = size > _SHORT
        spaced = _SPACE[np.minimum(size, _SHORT)] ^ one       # CRC of " " + word
        pair = np.zeros(len(w), dtype=np.uint32)
        triple = np.zeros(len(w), dtype=np.uint32)
        step = np.where(long, 0, size) + 1
        pair[1:] = _after(one[:-1], step[1:]) ^ spaced[1:]
        for i in np.flatnonzero(long):
            if i > 0:
                pair[i] = zlib.crc32(b" " + w[i], int(one[i - 1]))
        triple[2:] = _after(pair[1:-1], step[2:]) ^ spaced[2:]
        for i in np.flatnonzero(long):
            if i > 1:
                triple[i] = zlib.crc32(b" " + w[i], int(pair[i - 1]))
        new = np.arange(len(w)) >= carried
        second, third = new.copy(), new.copy()
        second[:1], third[:2] = False, False
        second[1:] &= d[1:] == d[:-1]
        third[2:] &= d[2:] == d[:-2]
        found = np.concatenate((one[new], pair[second], triple[third])) % np.uint32(buckets)
        owner = np.concatenate((d[new], d[second], d[third]))
        result = owner, found.astype(np.int64), d[new]
        words, carried = w[-2:], min(2, len(w))
        docs, sizes = d[-2:].tolist(), [1] * carried
        return result

    for i, t in enumerate(texts):
        for part in _slices(t):
            for lo in range(0, len(part), WORDS_AT_ONCE):
                some = part[lo:lo + WORDS_AT_ONCE]
                words += some
                docs.append(i)
                sizes.append(len(some))
                if len(words) - carried >= WORDS_AT_ONCE:
                    yield flush()
    if len(words) > carried:
        yield flush()


def _bytes(column: pa.Array) -> Iterator[bytes]:
    for t in column:
        yield t.as_py()


def bucket_counts(df: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: features of all texts of ``df`` by bucket; a task returns at most
    ``buckets`` rows."""
    ship(df.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crcs, total = _Crcs(), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, found, _ in run_buckets(_bytes(batch.column(0)), crcs, buckets):
                total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    src = df.select(text_or_empty(text).cast("binary").alias("t"))
    parts = src.mapInArrow(count, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket: floor(1000 ln of the ratio of its smoothed shares in
    target and corpus).  ``buckets`` numbers reach the driver."""
    both = (bucket_counts(docs, text, buckets).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
            .unionByName(bucket_counts(target, text, buckets).select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t"))))
    s, t = np.zeros(buckets), np.zeros(buckets)
    for r in both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect():
        s[r["bucket"]], t[r["bucket"]] = r["s"], r["t"]
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_words, n_features, weight`` for every row of ``docs``."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(gains)  # one number a bucket
    src = docs.select(F.col(key), text_or_empty(text).cast("binary").alias("__t"))
    kind = src.schema[key].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crcs, gain = _Crcs(), shared.value
        for batch in batches:
            n = batch.num_rows
            words, features, weight = (np.zeros(n, dtype=np.int64) for _ in range(3))
            for owner, found, word_doc in run_buckets(_bytes(batch.column(1)), crcs, len(gain)):
                words += np.bincount(word_doc, minlength=n)
                features += np.bincount(owner, minlength=n)
                # sums of integers, exact in doubles
                weight += np.bincount(owner, weights=gain[found], minlength=n).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words), pa.array(features), pa.array(weight)],
                ["k", "n_words", "n_features", "weight"])

    return (src.mapInArrow(score, f"k {kind}, n_words long, n_features long, weight long")
            .withColumnRenamed("k", key))


def gumbel(key: str, seed: int) -> Column:
    """floor(-1000 ln(-ln u)) of the uniform number u that key and seed hash to."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    u = (h + 0.5) / 4294967296.0
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("long")


def _at_least(rows: DataFrame, value: str, wanted: int, lo: int, hi: int) -> tuple[int, int]:
    """The greatest ``v`` in [lo, hi] for which the rows with ``value >= v`` hold ``wanted``
    copies, and the copies above it.  ``lo`` must qualify.  Exact counts over all rows,
    several steps of the bisection a job."""
    above = 0
    while lo < hi:
        cuts: set[int] = set()
        spans = [(lo, hi)]
        for _ in range(STEPS_PER_JOB):
            nxt = []
            for a, b in spans:
                if a < b:
                    m = a + (b - a + 1) // 2
                    cuts.add(m)
                    nxt += [(a, m - 1), (m, b)]
            spans = nxt
        found = rows.agg(*[F.coalesce(F.sum(F.when(F.col(value) >= F.lit(c), F.col("__n"))), F.lit(0)).alias(f"c{i}")
                           for i, c in enumerate(sorted(cuts))]).first()
        for c, n in zip(sorted(cuts), found):
            if n >= wanted:
                lo = max(lo, c)
            elif c <= hi:
                hi, above = c - 1, n
    return lo, above


def _ranked(drawn: DataFrame, key: str, wanted: int) -> DataFrame:
    """The drawn rows, each copy with its rank; copies beyond ``wanted`` have none."""
    order = [F.col("score").desc(), F.col(key).asc_nulls_last(), F.col("weight"), F.col("n_features")]
    each = copies(places(drawn.withColumn("__all", F.lit(0)), "__all", order, "drawn"))
    rank = F.col("__place") + F.col("__i") + 1
    return each.select(key, "n_features", "weight", "score", F.when(rank <= wanted, rank).cast("long").alias("rank"))


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT,
             min_words: int = MIN_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """Every row of ``docs`` as ``key, n_features, weight, score, rank``; ``rank`` numbers
    the floor(``percent`` * N / 100) greatest scores of the N rows with ``min_words`` words
    (ties to the smaller key) from 1, and is null for the others.  ``key`` must be an
    integer column."""
    if not isinstance(docs.schema[key].dataType, T.IntegralType):
        raise ValueError(f"{key} must be an integer column: the cutoff is found by bisection over it")
    if not 0 <= percent <= 100:
        raise ValueError("percent must be from 0 to 100")
    weighed = weigh(docs, bucket_gains(docs, target, text, buckets), key, text)
    scored = weighed.select(key, "n_features", "weight", (F.col("weight") + gumbel(key, seed)).alias("score"),
                            (F.col("n_words") >= min_words).alias("__open"))
    rows = materialise(scored.groupBy(*scored.columns).agg(F.count(F.lit(1)).alias("__n")), "scores")
    columns = [key, "n_features", "weight", "score"]
    able = rows.where("__open")
    total, lo, hi = able.agg(F.sum("__n"), F.min("score"), F.max("score")).first()
    wanted = (total or 0) * percent // 100
    if wanted == 0:
        return copies(rows).select(*columns, F.lit(None).cast("long").alias("rank"))
    cut, above = _at_least(able, "score", wanted, lo, hi)
    # among the rows with that score the least keys are drawn; null keys last
    ties = able.where(F.col("score") == cut).select((-F.col(key).cast("decimal(20,0)")).alias("__back"), "__n")
    named, least, most = ties.agg(F.coalesce(F.sum(F.when(F.col("__back").isNotNull(), F.col("__n"))), F.lit(0)),
                                  F.min("__back"), F.max("__back")).first()
    top = F.col("score") > cut
    if named >= wanted - above:
        back, _ = _at_least(ties, "__back", wanted - above, int(least), int(most))
        drawn = F.col("__open") & (top | ((F.col("score") == cut) & (F.col(key) <= -back)))
    else:
        drawn = F.col("__open") & (F.col("score") >= cut)
    chosen = F.coalesce(drawn, F.lit(False))
    rest = copies(rows.where(~chosen)).select(*columns, F.lit(None).cast("long").alias("rank"))
    return rest.unionByName(_ranked(rows.where(chosen), key, wanted))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their features, weight, score and rank in the draw of 5 % of
    those with 20 words, towards the texts of ``benchmark``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample(docs, table(spark, sf_dir, "benchmark"))
