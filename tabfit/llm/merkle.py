"""Operator 12: a Merkle manifest of a dataset, with a membership proof per row.

Every row is a leaf: the SHA-256 of its columns, each written with its length.  The
leaves of a group (a source), in key order, form a tree of runs of ``FANOUT``
consecutive nodes; its root is the group's subroot, and the subroots form the tree of
the whole dataset in the same way.  A change in any row changes the root, and the
siblings on a row's way up prove that the row belongs to the root.

Each level is one window over its nodes in order.  Columns at the fixed offsets
-15..-1 and 1..15 (lag and lead), masked by the node's slot in its run and by the
run's length, are its left and right siblings; the first child of each run hashes its
own digest and the ones led in to the parent.  Windows are cut at whole runs, so a
group of any size spreads over tasks.  Places in a group are found range by range.  On
the way down a node hands its siblings to its children, so a row joins one table a
sixteenth of its own, and all digests of its proof arrive in one array.

Defined results: null columns are written ``-``; a null group is a group of its own,
first in order; rows with one key are ordered by their leaf, so repeated rows are
leaves of their own; a lone leaf is its group's subroot, a lone subroot the root; the
proof of a lone row of a lone group is the hash of nothing; an empty table has none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabfit.llm.common import copies, materialise, places, table

FANOUT = 16
#: Runs whose nodes share one window group.
RUNS_PER_WINDOW = 64
#: Columns of a document's leaf, in this order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_hash(columns: list[Column]) -> Column:
    """The leaf of a row: ``-`` for a null column, else UTF-8 byte count, ``:``, value."""
    return digest(*[F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")),
                               F.lit("-")) for c in columns])


def with_siblings(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``nodes (g, idx, n, hash, ...)`` with ``left`` and ``right``: the digests of the run's
    nodes before and after each one, concatenated."""
    slot = F.col("idx") % fanout
    run = F.least(F.lit(fanout).cast("long"), F.col("n") - (F.col("idx") - slot))
    w = Window.partitionBy("g", F.floor(F.col("idx") / (fanout * RUNS_PER_WINDOW))).orderBy("idx")
    # a masked offset never reaches beyond the run
    before = [F.when(slot >= k, F.lag("hash", k).over(w)).otherwise("") for k in range(fanout - 1, 0, -1)]
    after = [F.when(slot + k < run, F.lead("hash", k).over(w)).otherwise("") for k in range(1, fanout)]
    return nodes.select("*", F.concat(*before).alias("left"), F.concat(*after).alias("right"))


def _parents(nodes: DataFrame, fanout: int) -> DataFrame:
    first = with_siblings(nodes.where("n > 1"), fanout).where(F.col("idx") % fanout == 0)
    return first.select("g", F.floor(F.col("idx") / fanout).alias("idx"),
                        F.ceil(F.col("n") / fanout).alias("n"), digest(F.col("hash"), F.col("right")).alias("hash"))


def levels(leaves: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """The levels of the trees of all groups, from ``leaves (g, idx, n, hash)`` up.  A
    group's last node, its root, is the one with ``n = 1``."""
    out = [leaves]
    size = leaves.agg(F.max("n")).first()[0] or 0
    while size > 1:
        out.append(materialise(_parents(out[-1], fanout), "merkle-level"))
        size = -(-size // fanout)
    return out


def _down(level: DataFrame, above: DataFrame | None, roots: DataFrame, fanout: int, extra: list[str]) -> DataFrame:
    """``g, idx, path, tip`` (and ``extra``) of the nodes of a level: their own siblings, then
    those of the level above, then ``roots`` (``g, path``: what follows a group's root); and
    the digest of that root."""
    step = F.array(F.struct("left", "right"))
    end = roots.select(F.col("g").alias("__g"), "path")
    lone = level.where("n = 1").join(end, F.col("g").eqNullSafe(F.col("__g"))).select(
        "g", "idx", "path", F.col("hash").alias("tip"), *extra)
    if above is None:
        return lone
    up = above.select(F.col("g").alias("__g"), F.col("idx").alias("__up"), F.col("path").alias("__path"), "tip")
    own = with_siblings(level.where("n > 1"), fanout)
    rest = own.join(up, F.col("g").eqNullSafe(F.col("__g")) & (F.floor(F.col("idx") / fanout) == F.col("__up")))
    return rest.select("g", "idx", F.concat(step, "__path").alias("path"), "tip", *extra).unionByName(lone)


def paths(all_levels: list[DataFrame], roots: DataFrame, extra: list[str], fanout: int = FANOUT) -> DataFrame:
    """The path of every leaf: an array of ``left, right`` from its run to the root."""
    below = None
    for i in range(len(all_levels) - 1, -1, -1):
        below = _down(all_levels[i], below, roots, fanout, extra if i == 0 else [])
        if i:
            below = materialise(below, "merkle-paths")
    return below


def fold(path: Column, leaf: Column) -> Column:
    """The root that a leaf and the siblings of its path lead to."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["left"], node, s["right"]))


def proof(path: Column) -> Column:
    """The hash of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def _in_order(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``g`` (the group), ``idx`` (place in it) and ``n`` (its size)."""
    counted = materialise(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("__n")), name)
    placed = copies(places(counted, group, [F.col(c) for c in order], name))
    kept = [c for c in rows.columns if c != group]
    return materialise(placed.select(F.col(group).alias("g"), (F.col("__place") + F.col("__i")).alias("idx"),
                                     F.col("__size").alias("n"), *kept), name)


def manifest(rows: DataFrame, key: str, group: str, others: list[str], fanout: int = FANOUT) -> DataFrame:
    """Of rows with ``key``, ``group``, ``leaf`` and the columns ``others``: ``key, group,
    leaf, others, subroot, root, path`` (the siblings from leaf to root)."""
    if fanout < 2:
        raise ValueError("fanout must be at least 2")
    base = rows.select(F.col(group).cast("string").alias("__group"), F.col(key).alias("__key"),
                       F.col("leaf").alias("hash"), *[F.col(c).alias(f"__o_{c}") for c in others])
    extra = [c for c in base.columns if c not in ("__group", "hash")]
    leaves = _in_order(base, "__group", ["__key", "hash", *extra[1:]], "merkle-leaves")
    trees = levels(leaves, fanout)
    subroots = trees[0].where("n = 1").select("g", "hash")
    for level in trees[1:]:
        subroots = subroots.unionByName(level.where("n = 1").select("g", "hash"))
    subroots = materialise(subroots, "merkle-subroots")
    one = subroots.select(F.lit(0).alias("__all"), F.col("g").alias("__source"), "hash")
    top = levels(_in_order(one, "__all", ["__source"], "merkle-top"), fanout)
    root = top[-1].where("n = 1").first()  # one row, or none for an empty table
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    end = top[-1].where("n = 1").select("g", nothing.alias("path"))
    upper = paths(top, end, ["__source"], fanout)
    upper = materialise(upper.select(F.col("__source").alias("g"), "path"), "merkle-paths")
    found = paths(trees, upper, ["hash", *extra], fanout)
    return found.select(F.col("__key").alias(key), F.col("g").alias(group), F.col("hash").alias("leaf"),
                        *[F.col(f"__o_{c}").alias(c) for c in others], F.col("tip").alias("subroot"),
                        F.lit(root["hash"] if root else None).cast("string").alias("root"), "path")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents by source; for every fifth key or so (by its CRC-32)
    the root is recomputed from a text in lower case, which must not lead to it."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    cols = [F.col(c) for c in LEAF_COLUMNS]
    low = [F.translate("text", _UPPER, _LOWER) if c == "text" else F.col(c) for c in LEAF_COLUMNS]
    rows = docs.select("doc_id", "source", leaf_hash(cols).alias("leaf"),
                       F.when(tampered, leaf_hash(low)).alias("altered"))
    m = manifest(rows, "doc_id", "source", ["altered"])
    folded = fold(F.col("path"), F.coalesce("altered", "leaf"))
    out = m.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"),
                   folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
