"""Global ordering without a single-task window.

``Window.orderBy(...)`` with no partition moves every row into one task.  The
operators here cut the total order into contiguous key ranges (boundaries taken
from a small seeded sample, so the bucket of a row is a deterministic
expression), rank inside each range with a partitioned window, and add the
exclusive prefix of the per-range totals.  The per-range table has one row per
range, so it is bounded by ``max_buckets`` and safe to broadcast.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 2_000_000
MAX_BUCKETS = 4096
SAMPLE_PER_BUCKET = 64


def _range_bucket(df: DataFrame, key: Column, n_rows: int, rows_per_bucket: int,
                  seed: int) -> Column:
    """Deterministic bucket expression: number of sampled boundaries below ``key``."""
    n_buckets = min(MAX_BUCKETS, max(1, math.ceil(n_rows / rows_per_bucket)))
    if n_buckets == 1:
        return F.lit(0)
    frac = min(1.0, SAMPLE_PER_BUCKET * n_buckets / max(n_rows, 1))
    # bounded: about SAMPLE_PER_BUCKET * n_buckets keys reach the driver
    sample = [r[0] for r in df.select(key.alias("_k")).sample(False, frac, seed)
              .orderBy("_k").collect()]
    if not sample:
        return F.lit(0)
    step = len(sample) / n_buckets
    bounds = []
    for i in range(1, n_buckets):
        b = sample[min(len(sample) - 1, int(i * step))]
        if not bounds or b != bounds[-1]:
            bounds.append(b)
    key_type = df.select(key.alias("_k")).schema["_k"].dataType
    lits = [F.lit(b).cast(key_type) if not hasattr(b, "asDict")
            else F.struct(*[F.lit(v).cast(f.dataType).alias(f.name)
                            for v, f in zip(b, key_type.fields)])
            for b in bounds]
    # number of boundaries below the key, by a balanced comparison tree:
    # log2(#ranges) comparisons per row instead of one per boundary
    def below(lo: int, hi: int) -> Column:
        # the answer lies in [lo, hi]
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2
        return F.when(key > lits[mid - 1], below(mid, hi)).otherwise(below(lo, mid - 1))
    return below(0, len(lits))


def running_totals(df: DataFrame, order_cols: list[str], value_cols: list[str],
                   prefix: str = "before_", rows_per_bucket: int = ROWS_PER_BUCKET,
                   seed: int = 7, n_rows: int | None = None) -> DataFrame:
    """Add ``before_<v>``: the sum of ``v`` over all rows strictly earlier in the
    ascending order of ``order_cols`` (ties broken by the full key, so keys
    should be unique; pre-aggregate first).

    ``order_cols`` are ascending; negate numeric columns for descending order.
    """
    if n_rows is None:
        n_rows = df.count()
    key = F.struct(*[F.col(c) for c in order_cols])
    bucket = _range_bucket(df, key, n_rows, rows_per_bucket, seed)
    t = df.withColumn("_bucket", bucket)
    w = (Window.partitionBy("_bucket").orderBy(*order_cols)
         .rowsBetween(Window.unboundedPreceding, -1))
    inner = t.select("*", *[F.coalesce(F.sum(v).over(w), F.lit(0)).alias(f"_in_{v}")
                            for v in value_cols])
    # one row per bucket: bounded by MAX_BUCKETS
    per_bucket = t.groupBy("_bucket").agg(*[F.sum(v).alias(f"_tot_{v}") for v in value_cols])
    wb = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        "_bucket", *[F.coalesce(F.sum(f"_tot_{v}").over(wb), F.lit(0)).alias(f"_off_{v}")
                     for v in value_cols])
    out = inner.join(F.broadcast(offsets), "_bucket")
    return out.select(*df.columns, *[(F.col(f"_off_{v}") + F.col(f"_in_{v}")).alias(prefix + v)
                                     for v in value_cols])


def global_index(df: DataFrame, order_cols: list[str], index_col: str = "index",
                 rows_per_bucket: int = ROWS_PER_BUCKET, seed: int = 7,
                 n_rows: int | None = None) -> DataFrame:
    """0-based position of each row in the ascending order of ``order_cols``
    (like ``row_number() over (order by ...) - 1``), computed range by range."""
    t = df.withColumn("_one", F.lit(1).cast("long"))
    r = running_totals(t, order_cols, ["_one"], prefix="_idx", rows_per_bucket=rows_per_bucket,
                       seed=seed, n_rows=n_rows)
    return r.withColumnRenamed("_idx_one", index_col).drop("_one")
