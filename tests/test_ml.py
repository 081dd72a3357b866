"""The estimator in pipelines and under Spark's own tuning."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import functions as F

from tabfit.ml import Booster, BoosterModel
from tabfit.operators.boosting import BoostParams, BoostTrainer
from tabfit.plans import standins as S
from tabfit.plans.frames import sales_features

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sales(spark):
    return sales_features(S.sales(spark, SF), S.stores(spark, SF)).persist()


def _margins(df):
    return [r["margin"] for r in df.orderBy("rowId").select("margin").collect()]


def test_estimator_equals_the_trainer(spark, sales, tmp_path):
    est = Booster(objective="binary:logistic", numRound=3, eta=0.4, maxDepth=3, subsample=0.8, idCol="rowId", seed=5)
    model = est.fit(sales)
    p = BoostParams(objective="binary:logistic", num_round=3, eta=0.4, max_depth=3, subsample=0.8, seed=5)
    assert _margins(model.transform(sales)) == _margins(BoostTrainer(p, id_col="rowId").fit(sales).transform(sales))
    path = str(tmp_path / "m")
    model.write().overwrite().save(path)
    again = BoosterModel.load(path)
    assert again.uid == model.uid and again.getOrDefault(again.numRound) == 3
    assert _margins(again.transform(sales)) == _margins(model.transform(sales))
    est.save(str(tmp_path / "e"))
    assert Booster.load(str(tmp_path / "e")).boost_params() == est.boost_params()
    assert _margins(model.copy({model.treeLimit: 1}).transform(sales)) != _margins(model.transform(sales))


def test_pipeline_is_saved_and_loaded(spark, tmp_path):
    raw = S.passengers(spark, SF).withColumn("label", F.col("survived").cast("double"))
    cats = ["sex", "embarked"]
    stages = [StringIndexer(inputCols=cats, outputCols=[c + "I" for c in cats]),
              VectorAssembler(inputCols=[c + "I" for c in cats] + ["age", "fare"], outputCol="features"),
              Booster(objective="binary:logitraw", numRound=2, maxDepth=3)]
    fitted = Pipeline(stages=stages).fit(raw)
    path = str(tmp_path / "p")
    fitted.save(path)
    a = fitted.transform(raw).orderBy("passengerId").select("margin").collect()
    assert a == PipelineModel.load(path).transform(raw).orderBy("passengerId").select("margin").collect()


def test_sparks_tuning_grows_the_grid_together(spark, sales, monkeypatch):
    est = Booster(objective="binary:logistic", maxDepth=3, subsample=0.8, idCol="rowId")
    grid = ParamGridBuilder().addGrid(est.numRound, [1, 3]).addGrid(est.eta, [0.1, 0.5]).build()
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="probabilities", labelCol="label")
    calls = []
    own = BoostTrainer.fit_grid
    monkeypatch.setattr(BoostTrainer, "fit_grid", lambda self, df, points: calls.append(len(points)) or own(self, df, points))
    tuned = TrainValidationSplit(estimator=est, estimatorParamMaps=grid, evaluator=evaluator, trainRatio=0.8, seed=3).fit(sales)
    assert calls == [4] and len(tuned.validationMetrics) == 4
    best = grid[max(range(4), key=lambda i: tuned.validationMetrics[i])]
    single = est.copy(best).fit(sales)
    assert _margins(tuned.transform(sales)) == _margins(single.transform(sales))
    models = dict(est.fitMultiple(sales, grid))
    for i, m in enumerate(grid):
        assert _margins(models[i].transform(sales)) == _margins(est.copy(m).fit(sales).transform(sales))
