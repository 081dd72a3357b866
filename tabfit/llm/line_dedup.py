"""Operator 8: repeated runs of lines by a suffix array (built-in functions only).

The lines with a word of all documents form sequences of line IDs (64-bit line
hashes).  Prefix doubling sorts their suffixes into classes: the class of a
suffix at depth ``2 * d`` is the pair of the classes, at depth ``d``, of itself
and of the suffix ``d`` lines on; classes with one member leave at once, as
nothing repeated can start there.  Two suffixes share a longest common prefix of
at least ``d`` lines exactly if they are in one class at depth ``d``, so the
classes are the intervals of the longest-common-prefix array.

A run of lines counts as repeated if it has ``min_words`` words at least.  Every
maximal repeated run is the union of the shortest such runs that start or that
end at one of its lines, and those are no longer than ``min_words`` lines.  So
doubling stops at that depth, whatever the corpus, with the same result as the
full suffix array.  The class of a run of any length ``n`` is the pair of the
classes, at the greatest depth ``d <= n``, of its first and last ``d`` lines.

The first copy of a run (least id, then least place) stays; the lines of later
copies are deleted, also inside one document.  Documents with equal texts are
compared as one: all but the first of them are one repeated run from first to
last line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabfit.llm.common import join_spread, materialise, table, text_or_empty, words_of

MIN_WORDS = 50
_LINE = r"[^ \t\x0B\f\r]"


def _documents(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per (key, text hash): the lines with a word as ``h`` (hash), ``w``
    (words) and ``no`` (place among all lines)."""
    body = text_or_empty(text)
    t = docs.select(F.col(key).alias("id"), F.xxhash64(body).alias("th"),
                    F.octet_length(body).alias("len"),
                    F.transform(F.split(body, "\n"), lambda s, i: F.struct(
                        s.alias("s"), i.alias("no"))).alias("all"))
    lines = F.transform(F.filter("all", lambda x: x["s"].rlike(_LINE)), lambda x: F.struct(
        F.xxhash64(x["s"]).alias("h"), F.size(words_of(x["s"])).alias("w"), x["no"].alias("no")))
    return t.select("id", "th", "len", lines.alias("lines"))


def _covered_runs(active: DataFrame, min_words: int) -> DataFrame:
    """The shortest runs of ``min_words`` words that start or end at a line and
    have only repeated lines: ``id, th, start, n``."""
    doc = Window.partitionBy("id", "th").orderBy("idx")
    t = active.withColumn("ce", F.sum("w").over(doc.rowsBetween(Window.unboundedPreceding, 0)))
    t = t.withColumn("cs", F.col("ce") - F.col("w"))
    ahead = Window.partitionBy("id", "th").orderBy("cs").rangeBetween(0, min_words - 1)
    back = Window.partitionBy("id", "th").orderBy("ce").rangeBetween(-(min_words - 1), 0)
    t = t.select("id", "th", "idx",
                 F.count("w").over(ahead).alias("n1"), F.sum("w").over(ahead).alias("w1"),
                 F.max("idx").over(ahead).alias("end1"),
                 F.count("w").over(back).alias("n2"), F.sum("w").over(back).alias("w2"),
                 F.min("idx").over(back).alias("start2"))
    starts = F.when((F.col("w1") >= min_words) & (F.col("end1") - F.col("idx") + 1 == F.col("n1")),
                    F.struct(F.col("idx").alias("start"), F.col("n1").alias("n")))
    ends = F.when((F.col("w2") >= min_words) & (F.col("idx") - F.col("start2") + 1 == F.col("n2")),
                  F.struct(F.col("start2").alias("start"), F.col("n2").alias("n")))
    return (t.select("id", "th", F.explode(F.array_compact(F.array_distinct(F.array(starts, ends)))).alias("r"))
            .select("id", "th", F.col("r.start").alias("start"), F.col("r.n").cast("int").alias("n"))
            .distinct())


def _repeated(rows: DataFrame) -> DataFrame:
    """The classes ``c`` with more than one row, and how many they have (``n``)."""
    return materialise(rows.groupBy("c").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated")


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """The lines to delete, as ranges: ``id, th`` (the document: its key and the
    64-bit hash of its text), ``n_removed``, ``cuts`` (array of ``lo, hi``, places
    among all lines of the text) and ``whole`` (all lines with a word go).

    Rows with equal key and equal text count as one document.  Null and empty
    texts have no lines; a null key sorts first; an empty table gives none."""
    if min_words < 1:
        raise ValueError("min_words must be at least 1")
    d = materialise(_documents(docs, key, text).where(F.size("lines") > 0), "lines")
    # the first document of every text, found by its own key: no text, however common, is one key
    texts = d.groupBy("th", "len").agg(F.min(F.struct("id")).alias("first"))
    texts = materialise(texts.select(F.col("first.id").alias("fid"), F.col("th").alias("fth"), F.col("len").alias("flen")), "texts")
    is_first = F.col("id").eqNullSafe(F.col("fid")) & (F.col("th") == F.col("fth")) & (F.col("len") == F.col("flen"))
    words = F.aggregate("lines", F.lit(0).cast("long"), lambda a, x: a + x["w"])
    copies = (d.select("id", "th", "len", words.alias("words"), F.size("lines").alias("n"))
              .where(F.col("words") >= min_words).join(texts, is_first, "left_anti")
              .select("id", "th", F.col("n").cast("long").alias("n_removed")).distinct())

    firsts = d.join(texts, is_first, "left_semi").dropDuplicates(["id", "th"])
    every = firsts.select("id", "th", F.posexplode("lines").alias("idx", "l")).select(
        "id", "th", "idx", F.col("l.h").alias("c"), F.col("l.w").alias("w"), F.col("l.no").alias("no"))
    every = materialise(every, "every-line")
    active = materialise(join_spread(every, _repeated(every), "c", "n").drop("n"), "active-lines")

    runs = materialise(_covered_runs(active, min_words), "runs")
    longest = runs.agg(F.max("n")).first()[0] or 0
    # prefix doubling, on the lines that repeat
    depth, level = active.select("id", "th", "idx", "c"), 0
    levels = [depth.withColumn("k", F.lit(0))]
    while 2 << level <= longest:
        step = 1 << level
        there = Window.partitionBy("id", "th").orderBy("idx").rangeBetween(step, step)
        pairs = depth.withColumn("c2", F.max("c").over(there)).where("c2 is not null")
        pairs = pairs.select("id", "th", "idx", F.xxhash64("c", "c2").alias("c"))
        pairs = materialise(pairs, "suffix-pairs")
        depth = join_spread(pairs, _repeated(pairs), "c", "n").select("id", "th", "idx", "c")
        depth = materialise(depth, "suffix-classes")
        level += 1
        levels.append(depth.withColumn("k", F.lit(level)))
    classes = levels[0]
    for x in levels[1:]:
        classes = classes.unionByName(x)

    top = F.floor(F.log2("n")).cast("int")
    r = runs.withColumn("k", top).withColumn("tail", F.col("start") + F.col("n") - F.pow(F.lit(2.0), top).cast("int"))

    def at(place: str, out: str) -> DataFrame:
        return classes.select(F.col("id").alias("i2"), F.col("th").alias("t2"), F.col("idx").alias(place),
                              "k", F.col("c").alias(out))

    def look(left: DataFrame, place: str, out: str) -> DataFrame:
        right = at("p2", out).withColumnRenamed("k", "k2")
        return left.join(right, F.col("id").eqNullSafe(F.col("i2")) & (F.col("th") == F.col("t2"))
                         & (F.col(place) == F.col("p2")) & (F.col("k") == F.col("k2"))).drop("i2", "t2", "p2", "k2")

    r = look(look(r, "start", "ca"), "tail", "cb")
    r = r.select("id", "th", "start", "n", F.xxhash64("n", "ca", "cb").alias("run"))
    r = materialise(r, "run-classes")
    # the first place of every run; all other places, found by their own key, are later ones
    origin = r.groupBy("run").agg(F.min(F.struct("id", "th", "start", "n")).alias("o")).select(
        F.col("o.id").alias("i2"), F.col("o.th").alias("t2"), F.col("o.start").alias("s2"), F.col("o.n").alias("n2"))
    later = r.join(origin, F.col("id").eqNullSafe(F.col("i2")) & (F.col("th") == F.col("t2"))
                   & (F.col("start") == F.col("s2")) & (F.col("n") == F.col("n2")), "left_anti")
    gone = later.select("id", "th", F.explode(F.sequence(
        F.col("start"), F.col("start") + F.col("n") - 1)).alias("idx")).distinct()
    own = active.select(F.col("id").alias("i2"), F.col("th").alias("t2"), F.col("idx").alias("x2"), "no")
    gone = gone.join(own, F.col("id").eqNullSafe(F.col("i2")) & (F.col("th") == F.col("t2"))
                     & (F.col("idx") == F.col("x2"))).select("id", "th", "idx", "no")
    islands = gone.withColumn("g", F.col("idx") - F.row_number().over(
        Window.partitionBy("id", "th").orderBy("idx")))
    cuts = islands.groupBy("id", "th", "g").agg(
        F.min("no").alias("lo"), F.max("no").alias("hi"), F.count(F.lit(1)).alias("m"))
    cuts = cuts.groupBy("id", "th").agg(F.sum("m").alias("n_removed"),
                                        F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("cuts"))
    none = F.array().cast("array<struct<lo:int,hi:int>>")
    return (cuts.select("id", "th", "n_removed", "cuts", F.lit(False).alias("whole"))
            .unionByName(copies.select("id", "th", "n_removed", none.alias("cuts"), F.lit(True).alias("whole"))))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text",
                min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the later copies of repeated runs cut from ``text`` and
    ``n_removed_lines`` added.  A text that loses all its lines becomes empty; a
    null text stays null; lines without a word inside a cut go with it."""
    found = repeated_lines(docs, key, text, min_words).select(
        F.col("id").alias("__id"), F.col("th").alias("__th"), F.col("n_removed").alias("__n"),
        F.col("cuts").alias("__cuts"), F.col("whole").alias("__whole"))
    keep = [c for c in docs.columns if c != "n_removed_lines"]
    joined = docs.select(*keep).join(
        found, F.col(key).eqNullSafe(F.col("__id"))
        & (F.xxhash64(text_or_empty(text)) == F.col("__th")), "left")
    left = F.filter(F.split(text_or_empty(text), "\n"), lambda s, i: ~F.exists(
        "__cuts", lambda c: (i >= c["lo"]) & (i <= c["hi"])))
    clean = (F.when(F.col("__n").isNull(), F.col(text)).when(F.col("__whole"), F.lit(""))
             .otherwise(F.array_join(left, "\n")))
    return joined.select(*[clean.alias(c) if c == text else c for c in keep],
                         F.coalesce("__n", F.lit(0)).cast("long").alias("n_removed_lines"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the later copies of repeated runs of lines; a null text stays null."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs)
