"""Evaluation metrics as aggregate Columns.

A ``Metric`` is a name plus a function ``(prediction, label) -> aggregate
Column``; it can be used in ``df.agg(...)``, in ``groupBy().agg(...)`` for
per-set metrics, and by the boosting trainer for per-round watch metrics.
All of them are ordinary partial aggregates, so they run map-side first and
move a handful of bytes per partition.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any, Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Probability clipping used by log-loss style metrics.
EPS = 1e-15


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


@dataclass(frozen=True)
class Metric:
    name: str
    fn: Callable[[Column, Column], Column]
    higher_is_better: bool = False
    # which scored column the metric reads: "prediction" (value or class),
    # "probability" (binary positive-class probability) or "probabilities"
    # (array of class probabilities)
    reads: str = "prediction"
    # the same for arrays, if the metric is (a function of) a mean over rows: the term of each
    # row, and the value from their sum and number
    terms: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None
    finish: Callable[[float, float], float] = lambda total, n: float(total / n) if n else float("nan")

    def __call__(self, prediction, label) -> Column:
        return self.fn(_c(prediction), _c(label))


def _rmsle(p: Column, y: Column) -> Column:
    # Prediction clamped at 0, then sqrt(mean((ln(p+1) - ln(y+1))^2)).
    # Spark's log1p(-1) is NULL, where the JVM math gives -Infinity; and an
    # empty input must give NaN (0/0).  Spell both out.
    sq = F.pow(F.log1p(F.greatest(p.cast("double"), F.lit(0.0))) - F.log1p(y.cast("double")), 2)
    n = F.count(F.lit(1))
    below = F.sum(F.when(y < -1, 1).otherwise(0))
    at_minus_one = F.sum(F.when(y == -1, 1).otherwise(0))
    return (F.when(n == 0, F.lit(float("nan")))
            .when(below > 0, F.lit(float("nan")))
            .when(at_minus_one > 0, F.lit(float("inf")))
            .otherwise(F.sqrt(F.sum(sq) / n)))


def _logloss(p: Column, y: Column) -> Column:
    pc = F.least(F.greatest(p.cast("double"), F.lit(EPS)), F.lit(1 - EPS))
    yd = y.cast("double")
    return F.avg(-(yd * F.log(pc) + (1 - yd) * F.log(1 - pc)))


def _error(p: Column, y: Column) -> Column:
    # binary error rate with the 0.5 threshold on a probability
    return F.avg(F.when((p > 0.5) != (y.cast("double") > 0.5), 1.0).otherwise(0.0))


def _merror(p: Column, y: Column) -> Column:
    # p is the predicted class
    return F.avg(F.when(p.cast("double") != y.cast("double"), 1.0).otherwise(0.0))


def _mlogloss(p: Column, y: Column) -> Column:
    # p is an array of class probabilities, y the 0-based class
    py = F.element_at(p, y.cast("int") + 1)
    return F.avg(-F.log(F.least(F.greatest(py.cast("double"), F.lit(EPS)), F.lit(1 - EPS))))


def _rmse(p: Column, y: Column) -> Column:
    return F.sqrt(F.avg(F.pow(p.cast("double") - y.cast("double"), 2)))


# The terms follow the SQL also at its edges: a NaN is greater than any number.
def _rmsle_terms(p: np.ndarray, y: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return (np.log1p(np.maximum(p, 0.0)) - np.log1p(y)) ** 2


def _logloss_terms(p: np.ndarray, y: np.ndarray) -> np.ndarray:
    pc = np.fmin(np.maximum(p, EPS), 1 - EPS)
    return -(y * np.log(pc) + (1 - y) * np.log(1 - pc))


def _error_terms(p: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (~(p <= 0.5) != ~(y <= 0.5)).astype(float)


def _root(total: float, n: float) -> float:
    return float(np.sqrt(total / n)) if n else float("nan")


rmsle = Metric("rmsle", _rmsle, terms=_rmsle_terms, finish=_root)
logloss = Metric("logloss", _logloss, reads="probability", terms=_logloss_terms)
error_rate = Metric("error", _error, reads="probability", terms=_error_terms)
merror = Metric("merror", _merror)
mlogloss = Metric("mlogloss", _mlogloss, reads="probabilities")
rmse = Metric("rmse", _rmse, terms=lambda p, y: (p - y) ** 2, finish=_root)

@dataclass(frozen=True)
class StateMetric:
    """A metric that no aggregate Column can express: a state with

    * ``init() -> state``
    * ``update(state, predictions, labels) -> state``, on arrays of a batch of rows
    * ``merge(state, state) -> state``, in any order
    * ``finish(state) -> float``

    States are folded inside the tasks, then merged in two steps, so neither rows nor
    the states of all tasks meet in one place.  A state must be of bounded size."""
    name: str
    init: Callable[[], Any]
    update: Callable[[Any, np.ndarray, np.ndarray], Any]
    merge: Callable[[Any, Any], Any]
    finish: Callable[[Any], float]
    higher_is_better: bool = False
    reads: str = "prediction"

    def by_set(self, rows: DataFrame, prediction: Column, label: Column, set_col: str = "set") -> DataFrame:
        """``set, value``: the metric of each set."""
        t = rows.select(F.col(set_col).cast("string").alias("set"), prediction.cast("double").alias("p"),
                        label.cast("double").alias("y"), F.pmod(F.spark_partition_id(), F.lit(MERGED_AT_ONCE)).alias("part"))

        def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            states: dict = {}
            part = 0
            for b in batches:
                part = int(b["part"].iloc[0]) if len(b) else part
                for name, g in b.groupby("set", dropna=False):
                    name = None if pd.isna(name) else name
                    states[name] = self.update(states.get(name, self.init()), g["p"].to_numpy(), g["y"].to_numpy())
            yield pd.DataFrame({"set": list(states), "part": part, "state": [pickle.dumps(v) for v in states.values()]})

        def together(g: pd.DataFrame) -> Any:
            state = self.init()
            for s in g["state"]:
                state = self.merge(state, pickle.loads(s))
            return state

        def some(g: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"set": g["set"].iloc[:1], "state": [pickle.dumps(together(g))]})

        def last(g: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"set": g["set"].iloc[:1], "value": [float(self.finish(together(g)))]})

        parts = t.mapInPandas(fold, "set string, part int, state binary")
        parts = parts.groupBy("set", "part").applyInPandas(some, "set string, state binary")
        return parts.groupBy("set").applyInPandas(last, "set string, value double")


#: Partitions whose states are merged by one task of the first step: all that are equal modulo this.
MERGED_AT_ONCE = 64

METRICS: dict[str, Metric] = {m.name: m for m in (rmsle, logloss, error_rate, merror, mlogloss, rmse)}
