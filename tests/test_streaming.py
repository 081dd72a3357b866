"""Streaming scorer: a restarted query with the same checkpoint scores only
files that arrived since, so every row is scored exactly once."""

from pyspark.sql import functions as F

from tabfit.operators.boosting import BoostParams, BoostTrainer
from tabfit.plans import standins as S
from tabfit.plans.frames import sales_features
from tabfit.streaming.scoring import score_files

SF = "/root/testdata/sf0.001"


def test_restart_scores_new_files_once(spark, tmp_path):
    fr = sales_features(S.sales(spark, SF), S.stores(spark, SF)).select("rowId", "features", "label")
    model = BoostTrainer(BoostParams(num_round=2, max_depth=3)).fit(fr)
    src, sink, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    first = fr.where(F.col("rowId") % 2 == 0).select("rowId", "features")
    second = fr.where(F.col("rowId") % 2 == 1).select("rowId", "features")
    first.write.parquet(f"{src}/batch=1")
    schema = spark.read.parquet(f"{src}/batch=1").schema
    q = score_files(spark, model, f"{src}/*", schema, sink, ckpt, keep_cols=["rowId"])
    q.awaitTermination()
    n1 = spark.read.parquet(sink).count()
    assert n1 == first.count()
    second.write.parquet(f"{src}/batch=2")
    q = score_files(spark, model, f"{src}/*", schema, sink, ckpt, keep_cols=["rowId"])
    q.awaitTermination()
    out = spark.read.parquet(sink)
    assert out.count() == fr.count()
    assert out.select("rowId").distinct().count() == fr.count()
    expected = model.transform(fr).select("rowId", F.col("probability").alias("p"))
    diff = out.join(expected, "rowId").where(F.abs(F.col("probability") - F.col("p")) > 1e-12)
    assert diff.count() == 0
