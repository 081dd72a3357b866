"""Operator 1: sharding by jump consistent hashing.

A stable key goes to one of ``n`` shards by the jump recurrence (Lamping and
Veach, 2014): the key seeds a linear congruential sequence whose steps name the
shard counts at which the key would move.  No ring table exists, and going from
``n`` to ``n + 1`` shards moves about ``1/(n + 1)`` of the keys, all of them
into the new shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabfit.llm.common import materialise, ship, table, text_or_empty
from tabfit.operators.ranking import running_totals

#: Fixed value: multiplier of the 64-bit generator in the published recurrence.
JUMP_MULTIPLIER = 2862933555777941757
#: Rows ranked together in one task when slots are numbered.
ROWS_PER_RANGE = 20_000
#: Repeated rows (same key, same content) that one task writes out together.
COPIES_PER_CHUNK = 65_536

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def jump_hash(keys: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard of each 64-bit key, vectorised over the keys."""
    state = keys.astype(np.int64).view(np.uint64).copy()
    shard = np.zeros(len(state), dtype=np.int64)
    nxt = np.zeros(len(state), dtype=np.int64)
    live = np.arange(len(state))
    while len(live):
        shard[live] = nxt[live]
        s = state[live] * np.uint64(JUMP_MULTIPLIER) + np.uint64(1)
        state[live] = s
        ratio = float(1 << 31) / ((s >> np.uint64(33)).astype(np.float64) + 1.0)
        nxt[live] = ((shard[live] + 1) * ratio).astype(np.int64)
        live = live[nxt[live] < n_shards]
    return shard


def shard_of(df: DataFrame, key: str, n_shards: int) -> Column:
    """Column: the shard of ``key``.  Integer keys are used as they are, other
    types by their 64-bit hash; a null key counts as key 0."""
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    ship(df.sparkSession)
    typed = isinstance(df.schema[key].dataType, _INTEGRAL)
    k = F.col(key).cast("long") if typed else F.when(F.col(key).isNotNull(), F.xxhash64(key))

    @F.pandas_udf("int")
    def jump(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(np.int64), n_shards).astype(np.int32))

    return jump(F.coalesce(k, F.lit(0).cast("long")))


def assign_shards(df: DataFrame, key: str, n_shards: int, shard_col: str = "shard") -> DataFrame:
    """``df`` with ``shard_col`` (replaced if present); row-local, no shuffle."""
    return df.withColumn(shard_col, shard_of(df, key, n_shards))


def number_slots(df: DataFrame, order_cols: list[str], shard_col: str = "shard",
                 slot_col: str = "slot") -> DataFrame:
    """Gapless numbers from 0 inside each shard, in the order of ``order_cols``.

    ``df`` must hold only ``shard_col`` and ``order_cols``: equal rows are
    collapsed to a count before anything is ranked and written out again
    chunk by chunk, so neither a large shard nor a row repeated many times is
    gathered in one task.  Ranks are found range by range.  An empty table
    gives an empty result.
    """
    cols = [shard_col, *order_cols]
    rows = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    rows = materialise(rows, "slots")
    ranked = running_totals(rows, cols, ["__n"], rows_per_bucket=ROWS_PER_RANGE)
    # one row per shard
    sizes = rows.groupBy(F.col(shard_col).alias("__s")).agg(F.sum("__n").alias("__size"))
    starts = sizes.select("__s", F.coalesce(
        F.sum("__size").over(Window.orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("__start"))
    ranked = ranked.join(F.broadcast(starts), F.col(shard_col).eqNullSafe(F.col("__s")))
    last = F.col("__n") - 1
    chunked = ranked.withColumn("__chunk", F.explode(
        F.sequence(F.lit(0).cast("long"), F.floor(last / COPIES_PER_CHUNK))))
    low = F.col("__chunk") * COPIES_PER_CHUNK
    each = chunked.withColumn("__i", F.explode(
        F.sequence(low, F.least(last, low + (COPIES_PER_CHUNK - 1)))))
    return each.select(*cols, (F.col("before___n") - F.col("__start") + F.col("__i"))
                       .cast("long").alias(slot_col))


def op1_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 by ``doc_id`` (law ``key``), and where each
    would be with a ninth shard."""
    docs = table(spark, sf_dir, "documents")
    text = text_or_empty("text")
    # a null text counts no bytes
    narrow = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                         F.crc32(text.cast("binary")).cast("long").alias("text_crc32"))
    placed = assign_shards(narrow, "doc_id", 8)
    slots = number_slots(placed, ["doc_id", "text_crc32", "size"])
    return (assign_shards(slots, "doc_id", 9, "grown_shard")
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    "slot", "grown_shard"))
