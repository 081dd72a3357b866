"""The trainer as a ``pyspark.ml`` estimator, for pipelines and Spark's own tuning.

    Pipeline(stages=[StringIndexer(...), VectorAssembler(...), Booster(objective="binary:logistic")])
    TrainValidationSplit(estimator=Booster(...), estimatorParamMaps=grid, evaluator=...)

``Booster.fitMultiple``, which Spark's tuning calls with the whole grid, grows all points in
the same jobs.  Estimator, model and pipelines of them can be saved and loaded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import fields

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasSeed
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame

from tabfit.operators.boosting import BoostModel, BoostParams, BoostTrainer

#: ``pyspark.ml`` name -> (name in ``BoostParams``, converter, what it is)
_PARAMS = {
    "objective": ("objective", TypeConverters.toString, "loss: reg:squarederror, binary:logistic, binary:logitraw, multi:softprob"),
    "numRound": ("num_round", TypeConverters.toInt, "boosting rounds"),
    "eta": ("eta", TypeConverters.toFloat, "shrinkage of the leaf values"),
    "maxDepth": ("max_depth", TypeConverters.toInt, "depth of a tree"),
    "regLambda": ("reg_lambda", TypeConverters.toFloat, "L2 penalty on leaf values"),
    "gamma": ("gamma", TypeConverters.toFloat, "least gain of a split"),
    "minChildWeight": ("min_child_weight", TypeConverters.toFloat, "least sum of hessians of a child"),
    "subsample": ("subsample", TypeConverters.toFloat, "share of the rows that a round sees"),
    "numClass": ("num_class", TypeConverters.toInt, "classes of multi: objectives"),
    "maxBins": ("max_bins", TypeConverters.toInt, "bins of a feature"),
    "baseScore": ("base_score", TypeConverters.toFloat, "prediction before the first round"),
    "missing": ("missing", TypeConverters.toFloat, "a value that counts as missing, beside NaN"),
    "treeLimit": (None, TypeConverters.toInt, "rounds used when scoring (default: all)"),
    "idCol": (None, TypeConverters.toString, "row key, needed by subsample"),
}


class _BoosterParams(HasFeaturesCol, HasLabelCol, HasSeed):
    """Parameters of estimator and model."""

    def __init__(self) -> None:
        super().__init__()
        defaults = {f.name: f.default for f in fields(BoostParams)}
        for name, (own, _, _) in _PARAMS.items():
            if own and defaults[own] is not None:
                self._setDefault(**{name: defaults[own]})
        self._setDefault(seed=defaults["seed"])

    def boost_params(self, extra: dict | None = None) -> BoostParams:
        """The trainer's parameters, with those of a parameter map on top."""
        given = {p.name: v for p, v in self.extractParamMap(extra or {}).items()}
        own = {o: given[n] for n, (o, _, _) in _PARAMS.items() if o and n in given}
        return BoostParams(**own, seed=given["seed"]).validate()

    def _maybe(self, name: str):
        p = getattr(self, name)
        return self.getOrDefault(p) if self.isDefined(p) else None


for _name, (_, _converter, _doc) in _PARAMS.items():
    setattr(_BoosterParams, _name, Param(Params._dummy(), _name, _doc, typeConverter=_converter))


class Booster(_BoosterParams, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Gradient-boosted trees (``operators/boosting.py``) as an estimator."""

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", labelCol: str = "label", objective: str = "binary:logistic",
                 numRound: int = 10, eta: float = 0.3, maxDepth: int = 6, regLambda: float = 1.0, gamma: float = 0.0,
                 minChildWeight: float = 1.0, subsample: float = 1.0, numClass: int = 1, maxBins: int = 64,
                 baseScore: float = 0.5, missing: float | None = None, seed: int = 0, idCol: str | None = None,
                 treeLimit: int | None = None):
        super().__init__()
        self.setParams(**self._input_kwargs)

    def setParams(self, **given) -> "Booster":
        return self._set(**{k: v for k, v in given.items() if v is not None})

    def _trainer(self, params: BoostParams) -> BoostTrainer:
        return BoostTrainer(params, features_col=self.getFeaturesCol(), label_col=self.getLabelCol(), id_col=self._maybe("idCol"))

    def _wrap(self, model: BoostModel, extra: dict | None = None) -> "BoosterModel":
        out = BoosterModel(model)
        return self._copyValues(out, extra or {})

    def _fit(self, dataset: DataFrame) -> "BoosterModel":
        return self._wrap(self._trainer(self.boost_params()).fit(dataset))

    def fitMultiple(self, dataset: DataFrame, paramMaps) -> Iterator[tuple[int, "BoosterModel"]]:
        """Models of all parameter maps, grown in the same jobs where they share columns and bins."""
        shared = {"featuresCol", "labelCol", "idCol", "maxBins", "missing"}
        points = [self.boost_params(m) for m in paramMaps]
        if any(p.name in shared for m in paramMaps for p in m) or len({p.classes() for p in points}) > 1:
            return iter([(i, self.fit(dataset, m)) for i, m in enumerate(paramMaps)])
        # the trainer that quantises needs the row key if any point samples
        base = min(points, key=lambda p: p.subsample)
        models = self._trainer(base).fit_grid(dataset, points)
        return iter([(i, self._wrap(m, dict(paramMaps[i]))) for i, m in enumerate(models)])


class BoosterModel(_BoosterParams, Model, MLReadable, MLWritable):
    """A fitted ``Booster``: adds margin, prediction and, by objective, probability and
    ``probabilities`` columns."""

    def __init__(self, model: BoostModel | None = None):
        super().__init__()
        self.model = model

    def _transform(self, dataset: DataFrame) -> DataFrame:
        self.model.features_col = self.getFeaturesCol()
        return self.model.transform(dataset, tree_limit=self._maybe("treeLimit"))

    def write(self) -> "_ModelWriter":
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> "_ModelReader":
        return _ModelReader(cls)


class _ModelWriter(MLWriter):
    def __init__(self, instance: BoosterModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.model.save(self.sparkSession, f"{path}/trees")


class _ModelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> BoosterModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        out = self.cls(BoostModel.load(self.sparkSession, f"{path}/trees"))
        out._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(out, meta)
        return out
