"""Skewed keys and size bounds: results stay exact, plans switch strategy."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from tabfit.operators.encode import FrequencyIndexer
from tabfit.operators.evaluate import auc_value
from tabfit.operators.joins import join_dimension


def _plan(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_auc_with_a_hot_score(spark):
    """A third of the rows share one score; the exact AUC still equals MLlib's."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0.5)).otherwise((F.col("id") * 7919 % 1000) / 1000.0).alias("s"),
        F.when((F.col("id") * 31 % 7) < 3, 1.0).otherwise(0.0).alias("y"))
    ml = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0).evaluate(df)
    assert auc_value(df, "s", "y") == pytest.approx(ml, abs=1e-12)


def test_indexer_with_a_hot_value(spark):
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
            F.concat(F.lit("v"), (F.col("id") % 997).cast("string"))).alias("c"))
    m = FrequencyIndexer(["c"], ["i"]).fit(df)
    assert m.sizes["c"] == 998
    top = m.labels("c").first()
    assert (top["value"], top["index"]) == ("hot", 0)
    assert m.transform(df).where(F.col("i") == 0).count() == n // 3


def test_dimension_join_respects_the_broadcast_bound(spark):
    fact = spark.range(1000).select((F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    dim = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    small = join_dimension(fact, dim, "k", max_rows=100)
    assert "BroadcastHashJoin" in _plan(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = join_dimension(fact, dim, "k", max_rows=10)
        assert "BroadcastHashJoin" not in _plan(big)
        assert big.count() == small.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_label_is_kept_out_of_features(spark):
    from tabfit.plans import standins as S
    from tabfit.plans.frames import census_features
    c = S.census(spark, "/root/testdata/sf0.001")
    assert len(census_features(c).first()["features"]) == 14
    assert len(census_features(c, include_label_in_features=True).first()["features"]) == 15
    from tabfit.operators.features import assemble
    with pytest.raises(ValueError):
        assemble(c, ["age", "label"], label_col="label")


def test_bad_row_reasons(spark, write_text):
    from tabfit.sources.csv import read_csv
    from tabfit.sources.schemas import ORDERS_TEXT
    path = write_text("o.csv", "1, 2, O, 3.5, 1-URGENT\nx, 2, O, 3.5, 1-URGENT\n1, 2, O\n")
    res = read_csv(spark, path, ORDERS_TEXT, on_bad="quarantine")
    reasons = sorted(r["reason"] for r in res.bad.collect())
    assert reasons == ["expected 5 fields, found 3", "unparsable value"]
    assert res.good.count() == 1


def test_training_state_is_spread_over_cores(spark):
    """A large input arriving as one partition is spread before boosting;
    a small one stays in a single task."""
    from tabfit.operators.boosting import BoostParams, BoostTrainer
    big = spark.range(1_200_000).coalesce(1).select(
        F.array((F.col("id") % 97).cast("double"), (F.col("id") % 13).cast("double")).alias("x"),
        (F.col("id") % 2).cast("double").alias("label"))
    tr = BoostTrainer(BoostParams(num_round=1, max_depth=2), features_col="x")
    prep = tr.prepare(big)
    assert prep.state.rdd.getNumPartitions() == min(spark.sparkContext.defaultParallelism, 12)
    prep.release()
    small = tr.prepare(big.limit(1000))
    assert small.state.rdd.getNumPartitions() == 1
    small.release()
