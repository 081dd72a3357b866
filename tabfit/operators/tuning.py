"""Parameter grids, a repeatable hash split, and train-validation selection.

The split is a pure function of a key column: ``md5(key)`` prefix below a
threshold, so it does not depend on
partitioning or on task retries, and DuckDB computes the same split.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfit.operators.boosting import (BoostModel, BoostParams, BoostTrainer, grid_growths, page_frame,
                                       scored_columns, state_rows)
from tabfit.operators.evaluate import auc


def param_grid(**axes) -> list[dict]:
    """Cross product of the given axes, in the order the axes are given."""
    names = list(axes)
    return [dict(zip(names, combo)) for combo in itertools.product(*[axes[n] for n in names])]


def hash_threshold(ratio: float) -> str:
    """Eight hex digits t such that md5 prefixes below t cover ``ratio`` of the keys
    (to within 2 ** -32).  A ratio of 1 gives "g", which every prefix is below."""
    if not 0 <= ratio <= 1:
        raise ValueError("ratio must be between 0 and 1")
    n = round(ratio * (1 << 32))
    return "g" if n >= 1 << 32 else f"{n:08x}"


def in_train(key, ratio: float) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.substring(F.md5(k.cast("string")), 1, 8) < F.lit(hash_threshold(ratio))


def hash_split(df: DataFrame, key: str, ratio: float = 0.8) -> tuple[DataFrame, DataFrame]:
    cond = in_train(key, ratio)
    return df.where(cond), df.where(~cond)


@dataclass
class TuningResult:
    best_model: BoostModel
    best_index: int
    grid: list[dict]
    metrics: list[float]
    base: BoostParams | None = None

    def transform(self, df: DataFrame) -> DataFrame:
        return self.best_model.transform(df)

    def results(self, spark: SparkSession) -> DataFrame:
        rows = []
        base = self.base or BoostParams()
        for i, (g, m) in enumerate(zip(self.grid, self.metrics)):
            e = base.replace(**g)  # the parameters the grid point actually used
            rows.append((i, float(e.eta), int(e.num_round), int(e.max_depth), float(e.reg_lambda),
                         float(m), i == self.best_index))
        return spark.createDataFrame(
            rows, "combo int, eta double, num_round int, max_depth int, reg_lambda double, "
                  "validation_auc double, is_best boolean")


class TrainValidationSplit:
    """Fit every grid point on the train part, score the validation part,
    keep the best, refit it on all rows.

    The rows are quantised once, with bin edges of the train part, and all grid points
    grow on that shared copy in the same jobs: the point is a key of the level
    histogram, beside class and node, so a level of the whole grid is one job
    and a page holds a margin per point, not a copy of the rows.  Points that differ
    in their number of rounds only are one model, read after several rounds.
    Validation rows ride along in the same pages, so their margins come for free.
    The refit on all rows has bin edges of all rows.  ``evaluator`` is "auc" (higher is
    better) or a metric name from ``functions.metrics`` (lower is better).
    """

    def __init__(self, base: BoostParams, grid: list[dict], key_col: str,
                 train_ratio: float = 0.8, features_col: str = "features",
                 label_col: str = "label", refit: bool = True, evaluator: str = "auc"):
        self.base, self.grid, self.key_col = base, grid, key_col
        self.train_ratio, self.features_col, self.label_col = train_ratio, features_col, label_col
        self.refit, self.evaluator = refit, evaluator
        if not grid:
            raise ValueError("an empty grid has no best point")
        for name in ("max_bins", "missing"):
            if any(name in g for g in grid):
                raise ValueError(f"{name} cannot vary inside one grid: the rows are binned once")
        objectives = {base.objective, *(g["objective"] for g in grid if "objective" in g)}
        if evaluator == "auc" and any(o.startswith("multi:") for o in objectives):
            raise ValueError("auc needs one score per row: choose another evaluator for multi-class")

    def _trainer(self, params: BoostParams) -> BoostTrainer:
        return BoostTrainer(params, features_col=self.features_col, label_col=self.label_col,
                            id_col=self.key_col)

    def _score(self, params: BoostParams, rows: DataFrame) -> float:
        valid = rows.where(F.col("set") == "valid")
        if self.evaluator == "auc":
            # AUC only depends on the order of the scores: the margin will do
            return auc(valid.select(F.col("m")[0].alias("s"), "y"), "s", "y").first()["auc"]
        from tabfit.functions.metrics import METRICS
        m = METRICS[self.evaluator]
        cols = scored_columns(params.objective, F.col("m"), params.classes())
        return valid.agg(m(cols.get(m.reads, cols["prediction"]), F.col("y"))).first()[0]

    def fit(self, df: DataFrame) -> TuningResult:
        split = F.when(in_train(self.key_col, self.train_ratio), "train").otherwise("valid")
        chosen = [self.base.replace(**g) for g in self.grid]
        points, at = grid_growths(chosen)
        due: dict[int, list[tuple[int, int]]] = {}  # what to score after a round
        for i, p in enumerate(chosen):
            due.setdefault(p.num_round - 1, []).append((i, at[i]))
        metrics = [0.0] * len(chosen)
        prep = self._trainer(self.base).prepare(df, set_col=split, edge_sets=("train",))
        try:
            def after(r: int, state: RDD, models: list[BoostModel]) -> None:
                frame = page_frame(df.sparkSession, state)
                for i, point in due[r]:
                    metrics[i] = self._score(chosen[i], state_rows(frame, prep.n_feat, point, chosen[i].classes()))

            models = self._trainer(self.base).fit_points(prep, points, ("train",), after, set(due))
        finally:
            prep.release()
        sign = 1 if self.evaluator == "auc" else -1
        best = max(range(len(metrics)), key=lambda i: (sign * metrics[i], -i))
        if self.refit:
            model = self._trainer(chosen[best]).fit(df)
        else:
            model = models[at[best]].first_rounds(chosen[best])
        return TuningResult(model, best, self.grid, metrics, self.base)
