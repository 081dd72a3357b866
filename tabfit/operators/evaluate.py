"""Evaluation as DataFrame jobs.

* ``auc`` - exact area under the ROC curve, ties counted half (the
  Mann-Whitney form).  Rows are first collapsed to one row per distinct score
  (partial aggregation, so a score shared by a third of the rows is one row),
  then the negatives ranked below each score come from ``running_totals``,
  which never moves the whole table into one task.
* ``evaluate`` - any ``Metric`` per named set as (set, metric, value) rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from tabfit.functions.metrics import METRICS, Metric, StateMetric
from tabfit.operators.ranking import running_totals
from tabfit.session import shared_dir


def score_column(df: DataFrame, col: str) -> Column:
    """A double score from a double, an array or an ML vector column (element 1)."""
    dt = df.schema[col].dataType
    if isinstance(dt, ArrayType):
        return F.col(col)[1].cast("double")
    if dt.typeName() in ("double", "float", "integer", "long", "decimal", "short"):
        return F.col(col).cast("double")
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col(col))[1]


def auc(df: DataFrame, score_col: str = "probability", label_col: str = "label",
        group_cols: list[str] | None = None) -> DataFrame:
    """Exact ROC AUC (ties half) per group, as rows (group..., auc, positives, negatives)."""
    groups = list(group_cols or [])
    s = df.select(*groups, score_column(df, score_col).alias("_s"),
                  F.col(label_col).cast("double").alias("_y"))
    per_score = (s.groupBy(*groups, "_s")
                 .agg(F.sum(F.when(F.col("_y") > 0.5, 1).otherwise(0)).cast("long").alias("pos"),
                      F.sum(F.when(F.col("_y") > 0.5, 0).otherwise(1)).cast("long").alias("neg")))
    # written: the ranking reads it more than once, the source is read once.  The files
    # go with the frame (spark.cleaner.referenceTracking.cleanCheckpoints)
    shared_dir(df.sparkSession)
    per_score = per_score.checkpoint(eager=True)
    ranked = running_totals(per_score, [*groups, "_s"], ["neg"])
    if groups:
        # running totals run over the whole (group, score) order: make them per group
        first = ranked.groupBy(*[F.col(g).alias(f"_k_{g}") for g in groups]).agg(
            F.min("before_neg").alias("_g0"))
        same = F.lit(True)
        for g in groups:  # a NULL group is a group
            same = same & F.col(g).eqNullSafe(F.col(f"_k_{g}"))
        ranked = ranked.join(first, same)  # AQE broadcasts it when the group count is small
        ranked = ranked.withColumn("before_neg", F.col("before_neg") - F.col("_g0"))
    P, N = F.sum("pos"), F.sum("neg")
    return ranked.groupBy(*groups).agg(
        (F.sum(F.col("pos") * (F.col("before_neg") + 0.5 * F.col("neg"))) / (P.cast("double") * N)).alias("auc"),
        P.alias("positives"), N.alias("negatives"))


def auc_value(df: DataFrame, score_col: str = "probability", label_col: str = "label") -> float:
    return auc(df, score_col, label_col).first()["auc"]


def evaluate(df: DataFrame, metric: Metric | StateMetric | str, prediction_col: str = "prediction",
             label_col: str = "label", set_col: str | None = None,
             set_name: str = "test") -> DataFrame:
    """Rows (set, metric, value) for one metric over one or more named sets; one
    named set without rows has the value NaN."""
    m = METRICS[metric] if isinstance(metric, str) else metric
    if isinstance(m, StateMetric):
        rows = df if set_col else df.withColumn("__set", F.lit(set_name))
        got = m.by_set(rows, F.col(prediction_col), F.col(label_col), set_col or "__set")
        return got.select("set", F.lit(m.name).alias("metric"), "value")
    if set_col is None:
        value = F.coalesce(m(F.col(prediction_col), F.col(label_col)).cast("double"), F.lit(float("nan")))
        return df.agg(value.alias("value")).select(F.lit(set_name).alias("set"),
                                                   F.lit(m.name).alias("metric"), "value")
    key = F.col(set_col)
    return (df.groupBy(key.alias("set"))
            .agg(F.lit(m.name).alias("metric"), m(F.col(prediction_col), F.col(label_col)).alias("value")))
