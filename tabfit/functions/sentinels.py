"""Sentinel handling: the data model uses sentinels (-1, '') instead of NULLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fill_sentinels(df: DataFrame, fills: dict[str, object]) -> DataFrame:
    """Replace NULL in each named column by its sentinel, keeping column order."""
    return df.select(*[
        F.coalesce(F.col(c), F.lit(fills[c]).cast(df.schema[c].dataType)).alias(c)
        if c in fills else F.col(c)
        for c in df.columns
    ])


def mask_sentinel(c, sentinel=-1) -> Column:
    """The value, or NULL where it equals the sentinel (aggregates skip NULL)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col != F.lit(sentinel), col)


def optional_label(c, has_label: bool = True, default: float = -1.0) -> Column:
    """Label column as double; the default where absent or when the file has no label."""
    if not has_label or c is None:
        return F.lit(default).cast("double")
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.cast("double"), F.lit(default).cast("double"))
