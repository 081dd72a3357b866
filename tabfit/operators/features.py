"""Feature derivations: filters, imputation, label rules, assembly."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabfit.operators.stats import mean_of


def keep_positive(df: DataFrame, *cols: str) -> DataFrame:
    """Rows where every named column is > 0 (pushed into the scan by Catalyst)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & (F.col(c) > 0)
    return df.where(cond)


def impute_non_positive(df: DataFrame, col: str, out: str, mean: Column | None = None) -> DataFrame:
    """``out`` = col where col > 0, else the mean of col over ``df`` (or the
    given scalar ``mean``).

    The mean is taken over all rows of ``df``, sentinels included, exactly as
    a plain average of the column would be.
    """
    m = mean if mean is not None else mean_of(df, col)
    return df.withColumn(out, F.when(F.col(col) > 0, F.col(col).cast("double")).otherwise(m))


def label_above_mean(df: DataFrame, col: str, out: str = "label",
                     above: int = 0, otherwise: int = 1,
                     over: DataFrame | None = None, mean: Column | None = None) -> DataFrame:
    """Binary label around the global mean of ``col`` (taken over ``over``,
    default ``df``, or the given scalar ``mean``); by default a value above
    the mean is labelled 0 and the rest 1."""
    m = mean if mean is not None else mean_of(over if over is not None else df, col)
    return df.withColumn(out, F.when(F.col(col) > m, F.lit(above)).otherwise(F.lit(otherwise)))


def strip_metadata(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop ML attribute metadata (e.g. nominal index columns) so trees treat
    the values as ordered numbers."""
    return df.withColumns({c: F.col(c).alias(c, metadata={}) for c in cols})


def assemble(df: DataFrame, cols: list[str], out: str = "features",
             label_col: str | None = None, allow_label: bool = False,
             handle_invalid: str = "error") -> DataFrame:
    """Assemble numeric / vector columns into one ML vector column.

    Refuses to put the label into the features unless ``allow_label``.
    Array columns are converted to vectors first.
    """
    if label_col and label_col in cols and not allow_label:
        raise ValueError(f"label column {label_col!r} listed among the features")
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql.types import ArrayType
    prepared = df
    for c in cols:
        if isinstance(df.schema[c].dataType, ArrayType):
            prepared = prepared.withColumn(c, array_to_vector(F.col(c)))
    prepared = strip_metadata(prepared, cols)
    return VectorAssembler(inputCols=cols, outputCol=out,
                           handleInvalid=handle_invalid).transform(prepared)
