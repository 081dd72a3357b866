"""The catalogue's models are trained with the reference applications' settings."""

import pytest

import __spark_entry__ as E
from tabfit.operators.boosting import BoostTrainer
from tabfit.operators.tuning import TrainValidationSplit

SF = "/root/testdata/sf0.001"

#: query -> rounds, depth, subsample (a list of rounds: the grid that is searched)
SETTINGS = {
    "train_binary": (20, 6, 0.8),
    "score_preview": (20, 6, 0.8),
    "score_saved_model": (20, 6, 0.8),
    "score_tree_limit": (20, 6, 0.8),
    "model_dump": (20, 6, 0.8),
    "score_stream": (20, 6, 0.8),
    "train_regression": (100, 6, 0.8),
    "train_watch_rmsle": (100, 6, 0.8),
    "metric_rmsle_model": (100, 6, 0.8),
    "train_margin": (20, 6, 1.0),
    "train_watch": (100, 6, 1.0),
    "tune_tvs": ([20, 50], 6, 0.8),
    "tune_sales_scored": ([20, 50], 6, 0.8),
    "tune_passenger_margin": ([20, 50], 6, 1.0),
    "tune_census_lambda": (100, 6, 1.0),
}


class _Seen(Exception):
    pass


@pytest.mark.parametrize("name", sorted(SETTINGS))
def test_registered_settings(spark, monkeypatch, name):
    def train(self, *args, **kwargs):
        raise _Seen([self.params])

    def tune(self, *args, **kwargs):
        raise _Seen([self.base.replace(**point) for point in self.grid])

    monkeypatch.setattr(BoostTrainer, "fit", train)
    monkeypatch.setattr(TrainValidationSplit, "fit", tune)
    with pytest.raises(_Seen) as seen:
        E.queries()[name](spark, SF)
    rounds, depth, subsample = SETTINGS[name]
    points = seen.value.args[0]
    assert sorted({p.num_round for p in points}) == (rounds if isinstance(rounds, list) else [rounds])
    assert {(p.max_depth, p.subsample) for p in points} == {(depth, subsample)}
