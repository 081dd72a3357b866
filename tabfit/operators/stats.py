"""Global statistics: masked moments, scalar means, standardisation.

All moments of all columns come from a single ``agg`` (one pass, partial
aggregation map-side).  Scalars that feed a later expression are attached as
scalar subqueries (``DataFrame.scalar()``), so no cross join and no Python
round trip is needed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabfit.functions.sentinels import mask_sentinel


def masked_moments(df: DataFrame, cols: list[str], sentinel=-1.0) -> DataFrame:
    """One row: ``<c>_mean``, ``<c>_std`` (population) and ``<c>_n`` over the
    values of each column that are not the sentinel."""
    aggs = []
    for c in cols:
        m = mask_sentinel(F.col(c).cast("double"), float(sentinel))
        aggs += [F.avg(m).alias(f"{c}_mean"), F.stddev_pop(m).alias(f"{c}_std"),
                 F.count(m).alias(f"{c}_n")]
    return df.agg(*aggs)


def means_of(df: DataFrame, cols: list) -> dict[str, Column]:
    """Global means of several columns from ONE scalar subquery (one pass);
    returns {name: Column}."""
    names = [c if isinstance(c, str) else f"_m{i}" for i, c in enumerate(cols)]
    exprs = [F.avg((F.col(c) if isinstance(c, str) else c).cast("double")).alias(n)
             for c, n in zip(cols, names)]
    sub = df.select(F.struct(*exprs).alias("s")).scalar()
    return {n: sub.getField(n) for n in names}


def mean_of(df: DataFrame, col) -> Column:
    """The global mean of ``col`` over ``df`` as a scalar-subquery Column."""
    c = F.col(col) if isinstance(col, str) else col
    return df.select(F.avg(c.cast("double"))).scalar()


def _scale(x: Column, mean: Column, std: Column) -> Column:
    # float semantics of the reference: a zero stdev gives NaN (0/0) or +-Infinity
    d = x.cast("double") - mean
    return F.when(std == 0, F.when(d == 0, F.lit(float("nan")))
                  .otherwise(F.signum(d) * F.lit(float("inf")))).otherwise(d / std)


@dataclass
class StandardizerModel:
    cols: list[str]
    means: dict[str, float]
    stds: dict[str, float]

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        """(x - mean) / stdev for every row, sentinel rows included."""
        return df.withColumns({
            c + suffix: _scale(F.col(c), F.lit(self.means[c]), F.lit(self.stds[c]))
            for c in self.cols})


class Standardizer:
    """Masked population moments fitted once; applied to any frame."""

    def __init__(self, cols: list[str], sentinel=-1.0):
        self.cols = list(cols)
        self.sentinel = sentinel

    def fit(self, df: DataFrame) -> StandardizerModel:
        row = masked_moments(df, self.cols, self.sentinel).first()  # one row, bounded
        return StandardizerModel(self.cols,
                                 {c: row[f"{c}_mean"] for c in self.cols},
                                 {c: row[f"{c}_std"] for c in self.cols})


def standardize_inline(df: DataFrame, cols: list[str], sentinel=-1.0, suffix: str = "") -> DataFrame:
    """Standardise with moments attached as scalar subqueries (no driver trip)."""
    mom = masked_moments(df, cols, sentinel)
    return df.withColumns({
        c + suffix: _scale(F.col(c), mom.select(f"{c}_mean").scalar(), mom.select(f"{c}_std").scalar())
        for c in cols})
