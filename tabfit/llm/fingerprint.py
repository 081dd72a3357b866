"""Operator 9: SimHash document fingerprints (built-in functions only).

The terms of a text are its word pairs (its only word, if it has one); a term
weighs one plus its letters, so long, rarer words count for more.  Every term
hash votes on 64 signed bits with that weight; a bit of the fingerprint is set
where the weight for it exceeds the weight against it.  The votes are sums, so
they are combined inside the tasks before anything is shuffled.

``near_fingerprints`` finds all fingerprints within a Hamming radius by
permuted block tables.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabfit.llm.common import table, text_or_empty, words_of
from tabfit.operators.ranking import _range_bucket

BITS = 64
#: One mask picks bit i and bit i + 32 of a hash: both counts share one sum.
PAIR_MASK = (1 << 32) | 1
ROWS_PER_RANGE = 4_000


def _votes(h: Column, weight: Column) -> list[Column]:
    lanes = [F.sum(F.shiftrightunsigned(h, i).bitwiseAND(F.lit(PAIR_MASK)) * weight).alias(f"__v{i}")
             for i in range(BITS // 2)]
    return [*lanes, F.sum(weight).alias("__w")]


def _from_votes() -> Column:
    """The 64-bit fingerprint of the summed votes (0 where there are no terms)."""
    bits = F.lit(0).cast("long")
    for i in range(BITS // 2):
        v = F.col(f"__v{i}")
        for at, count in ((i, v.bitwiseAND(F.lit((1 << 32) - 1))), (i + 32, F.shiftrightunsigned(v, 32))):
            bit = F.shiftleft(F.lit(1).cast("long"), at)
            bits = bits.bitwiseOR(F.when(2 * count > F.col("__w"), bit).otherwise(F.lit(0).cast("long")))
    return bits


def as_hex(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), BITS // 4, "0"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits of two 64-bit fingerprints, 0 to 1."""
    return 1.0 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def simhash(df: DataFrame, keys: list[str], text: str, out: str = "fingerprint") -> DataFrame:
    """``keys`` and the fingerprint of ``text``, one row per distinct ``keys``
    (they must name a row).  Null, empty and blank texts have fingerprint 0; an
    empty table gives an empty result."""
    t = df.select(*keys, words_of(text_or_empty(text)).alias("__words"))
    n = F.size("__words")
    second = F.when(n > 1, F.slice("__words", F.lit(2), n)).otherwise(F.array(F.lit("")))
    t = t.select(*keys, "__words", second.alias("__next"))
    # the last word has no partner and is dropped, unless it is the only one
    pairs = t.select(*keys, F.inline_outer(F.arrays_zip("__words", "__next")))
    live = F.col("__words").isNotNull() & F.col("__next").isNotNull()
    weight = F.when(live, 1 + F.char_length("__words") + F.char_length("__next")).otherwise(F.lit(0))
    terms = pairs.select(*keys, F.xxhash64("__words", "__next").alias("__h"), weight.cast("long").alias("__wt"))
    votes = terms.groupBy(*keys).agg(*_votes(F.col("__h"), F.col("__wt")))
    return votes.select(*keys, _from_votes().alias(out))


def near_fingerprints(prints: DataFrame, fingerprint: str = "fingerprint", radius: int = 3,
                      blocks: int = 6) -> DataFrame:
    """All pairs ``(a, b, distance)``, a < b, of different 64-bit fingerprints of
    ``prints`` that differ in at most ``radius`` bits.

    The bits fall into ``blocks`` blocks; within the radius at least ``blocks -
    radius`` of them agree.  For each choice of that many blocks one table is
    keyed by their bits (permuted to the front), so a pair meets in some table.
    Documents with equal fingerprints are one row here: join back on the
    fingerprint for membership.  Nulls are left out; an empty table gives none."""
    if not 0 <= radius < blocks <= BITS:
        raise ValueError("radius must be below the number of blocks")
    f = prints.select(F.col(fingerprint).alias("f")).where("f is not null").distinct()
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - radius):
        m = 0
        for b in chosen:
            m |= ((1 << edges[b + 1]) - 1) & ~((1 << edges[b]) - 1)
        masks.append(m - (1 << BITS) if m >= 1 << (BITS - 1) else m)
    keyed = f.select("f", F.posexplode(F.array(*[
        F.col("f").bitwiseAND(F.lit(m).cast("long")) for m in masks])).alias("table", "key"))
    a, b = keyed.alias("a"), keyed.alias("b")
    pairs = a.join(b, (F.col("a.table") == F.col("b.table")) & (F.col("a.key") == F.col("b.key"))
                   & (F.col("a.f") < F.col("b.f")))
    distance = F.bit_count(F.col("a.f").bitwiseXOR(F.col("b.f")))
    return (pairs.where(distance <= radius)
            .select(F.col("a.f").alias("a"), F.col("b.f").alias("b"), distance.alias("distance"))
            .distinct())


def with_next(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Each row with the row after it in ascending order of ``key`` (ties by the
    text's hash; after the last row comes the first): ``key``, ``text``,
    ``__next`` (the other's text), ``__range``, ``__at`` (place in the range)
    and ``__halo``.

    Rows are dealt once, by ranges of the key; the first row of each range goes
    to the range before as well (``__halo``, to be dropped by the caller), so no
    text is shuffled twice and no order is made in one task.  A null key comes
    first; an empty table gives an empty result."""
    narrow = docs.select(key)
    n = narrow.count()
    bucket = _range_bucket(docs, F.col(key), n, ROWS_PER_RANGE, seed=9)
    firsts = (narrow.select(key, F.coalesce(bucket, F.lit(0)).alias("__range")).groupBy("__range")
              .agg(F.min(F.struct(key)).alias("__first")))
    # bounded: one row per range, at most ranking.MAX_BUCKETS
    order = Window.orderBy("__range")
    ends = firsts.select("__range", F.col(f"__first.{key}").alias("__first"),
                         F.lag("__range").over(order).alias("__before"),
                         F.max("__range").over(Window.partitionBy()).alias("__last"))
    t = docs.select(F.col(key), F.col(text)).withColumn("__range", F.coalesce(bucket, F.lit(0)))
    t = t.withColumn("__hash", F.xxhash64(text))
    t = t.join(F.broadcast(ends), "__range")
    is_first = F.col(key).eqNullSafe(F.col("__first"))
    here = F.struct(F.col("__range").alias("r"), F.lit(False).alias("h"))
    halo = F.struct(F.coalesce("__before", "__last").alias("r"), F.lit(True).alias("h"))
    t = t.select(key, text, "__hash", F.inline(
        F.when(is_first, F.array(here, halo)).otherwise(F.array(here))).alias("__range", "__halo"))
    by = Window.partitionBy("__range").orderBy("__halo", key, "__hash")
    return t.select(key, text, "__range", "__halo", F.row_number().over(by).alias("__at"),
                    F.lead(text).over(by).alias("__next"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprints of all documents and of their edited texts, and how alike they and the
    next document's are.  Null texts are empty; a lone document is its own next one."""
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", text_or_empty("text").alias("text"))
    t = with_next(docs, "doc_id", "text")
    t = t.withColumn("n_chars", F.char_length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut),
                      F.substring(F.coalesce("__next", F.lit("")), F.lit(1), cut))
    t = t.select("__range", "__at", "__halo", "doc_id", "n_chars", "text", edited.alias("edited"))
    both = t.select(
        "__range", "__at", "__halo", "doc_id", "n_chars", F.sha2("edited", 256).alias("sha"),
        F.posexplode(F.array("text", "edited")).alias("__which", "__text"))
    keys = ["__range", "__at", "__halo", "doc_id", "n_chars", "sha", "__which"]
    prints = simhash(both, keys, "__text", "f")
    per_doc = prints.groupBy("__range", "__at", "__halo", "doc_id", "n_chars", "sha").agg(
        F.max(F.when(F.col("__which") == 0, F.col("f"))).alias("f"),
        F.max(F.when(F.col("__which") == 1, F.col("f"))).alias("e"))
    by = Window.partitionBy("__range").orderBy("__at")
    nxt = per_doc.withColumn("x", F.lead("f").over(by)).where(~F.col("__halo"))
    return nxt.select("doc_id", "n_chars", F.col("sha").alias("edited_sha256"),
                      as_hex(F.col("f")).alias("fingerprint"),
                      as_hex(F.col("e")).alias("edited_fingerprint"),
                      likeness(F.col("f"), F.col("e")).alias("near_edited"),
                      likeness(F.col("f"), F.col("x")).alias("near_next"))
