"""Joins against a side whose size is checked before it is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DatetimeType, NumericType, StringType

# Broadcast a side only if it has at most this many rows and about this many
# bytes; beyond either the join shuffles both sides (sort-merge, with AQE
# splitting skewed keys).
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 64 << 20


def maybe_broadcast(side: DataFrame, n_rows: int | None = None,
                    max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(side)`` when its rows and bytes are within bounds, else ``side``.

    Both are summed inside the tasks (one row per task is shuffled).  Text and binary
    values count their bytes, fixed-width ones and the elements of arrays of them
    16 each; only other nested values are written out to be measured."""
    fixed = (NumericType, BooleanType, DatetimeType)
    size, flat = F.lit(0).cast("long"), 0
    for f in side.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, fixed):
            flat += 16
        elif isinstance(f.dataType, (StringType, BinaryType)):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, fixed):
            size = size + F.greatest(F.size(c), F.lit(0)) * 16
        else:
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    got = side.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size + flat), F.lit(0)).alias("b")).first()
    fits = max(got["n"], n_rows or 0) <= max_rows and got["b"] <= MAX_BROADCAST_BYTES
    return F.broadcast(side) if fits else side


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "inner",
                   max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Equi-join a fact table with a dimension table (``USING`` semantics when
    ``on`` is a column name or list of names: the key appears once)."""
    return fact.join(maybe_broadcast(dim, max_rows=max_rows), on, how)
