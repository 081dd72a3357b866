import math

import pytest
from pyspark.sql import functions as F

from tabfit.functions.dates import date_parts, split_date_parts
from tabfit.functions.metrics import logloss, rmsle
from tabfit.functions.sentinels import fill_sentinels, optional_label


def test_date_parts_g1(spark):
    df = spark.createDataFrame([("2011-01-01 05:00:00",), ("2011-07-04 17:00:00",)], "date string")
    rows = df.select(*[c.alias(k) for k, c in date_parts("date", "yyyy-MM-dd HH:mm:ss").items()]).collect()
    assert [tuple(r) for r in rows] == [(2011, 1, 1, 5, 7), (2011, 7, 4, 17, 2)]


def test_split_date_parts(spark):
    df = spark.createDataFrame([("2015-07-31",), ("bad",)], "d string")
    rows = df.select(*[c.alias(k) for k, c in split_date_parts("d").items()]).collect()
    assert tuple(rows[0]) == (2015, 7, 31)
    assert tuple(rows[1]) == (None, None, None)


def _metric(spark, metric, rows, schema="p double, y double"):
    df = spark.createDataFrame(rows, schema)
    return df.agg(metric(F.col("p"), F.col("y")).alias("v")).first()["v"]


def test_rmsle_g8(spark):
    assert _metric(spark, rmsle, [(-3.0, 0.0), (1.0, 3.0), (7.0, 7.0)]) == pytest.approx(0.40018871128431455)
    assert _metric(spark, rmsle, [(1.0, -1.0), (1.0, 3.0)]) == math.inf
    assert math.isnan(_metric(spark, rmsle, [(1.0, -2.0)]))
    assert math.isnan(_metric(spark, rmsle, [], "p double, y double"))


def test_logloss_g8(spark):
    assert _metric(spark, logloss, [(0.9, 1.0), (0.2, 0.0), (0.6, 1.0)]) == pytest.approx(0.2797765635793423)


def test_sentinels(spark):
    df = spark.createDataFrame([(None, None), (3, "x")], "a int, s string")
    out = fill_sentinels(df, {"a": -1, "s": ""}).collect()
    assert [tuple(r) for r in out] == [(-1, ""), (3, "x")]
    lab = df.select(optional_label("a", True).alias("l1"), optional_label("a", False).alias("l2")).collect()
    assert [tuple(r) for r in lab] == [(-1.0, -1.0), (3.0, -1.0)]
