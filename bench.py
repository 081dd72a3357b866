"""Benchmark the headline queries; prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_RUNS (timed runs per query after one warm-up, default 3).

Each query is executed to completion with a ``noop`` write (no collect), so
the time covers the whole plan.  The reported value per query is the median
of the timed runs; ``value`` is their sum.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from tabfit.session import build_session, shared_dir
    spark = build_session(master=f"local[{cpus}]", app="tabfit-bench", shuffle_partitions=cpus)
    shared_dir(spark)
    from pyspark.sql import functions as F
    from tabfit.operators.boosting import BoostModel, BoostParams, BoostTrainer
    from tabfit.operators.tuning import TrainValidationSplit, hash_split, param_grid
    from tabfit.plans import catalog as C
    from tabfit.plans import standins as S
    from tabfit.plans.frames import sales_features

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    state: dict = {}

    def fit_rounds():
        fr = sales_features(S.sales(spark, sf_dir), S.stores(spark, sf_dir)).select(
            "rowId", "features", "label").persist()
        fr.count()
        p = BoostParams(objective="binary:logistic", num_round=20, eta=0.3, max_depth=6,
                        subsample=0.8, seed=7)
        t = time.time()
        model = BoostTrainer(p, id_col="rowId").fit(fr)
        elapsed = time.time() - t
        state["model"], state["frame"] = model, fr
        return elapsed / p.num_round  # seconds per boosting round

    def mllib_round():
        # reference point: Spark's built-in GBT on the same frame and depth
        from pyspark.ml.classification import GBTClassifier
        fr = state["frame"]
        t = time.time()
        GBTClassifier(maxIter=5, maxDepth=6, stepSize=0.3, subsamplingRate=0.8, maxBins=64,
                      seed=7).fit(fr)
        return (time.time() - t) / 5

    def fit_softprob():
        # 10 classes, depth 3, eta 0.3 (the multi-class configuration), 64 features
        v = S.vectors(spark, sf_dir).persist()
        v.count()
        p = BoostParams(objective="multi:softprob", num_class=10, num_round=10, eta=0.3, max_depth=3)
        t = time.time()
        BoostTrainer(p, features_col="x").fit(v)
        elapsed = time.time() - t
        v.unpersist()
        return elapsed / p.num_round

    def score():
        model, fr = state["model"], state["frame"]
        t = time.time()
        run(model.transform(fr).select("rowId", "probability", "prediction"))
        return time.time() - t

    def tune():
        fr = state["frame"]
        grid = param_grid(num_round=[20, 50], eta=[0.1, 0.4])
        t = time.time()
        TrainValidationSplit(BoostParams(objective="binary:logistic", max_depth=6, subsample=0.8),
                             grid, key_col="rowId").fit(fr)
        return time.time() - t

    def q(name):
        def f():
            t = time.time()
            run(C.QUERIES[name](spark, sf_dir))
            return time.time() - t
        return f

    # rounds, depths and grids are the catalogue's; the longest items run once
    plan = [
        ("feat_sales", q("feat_sales"), runs),
        ("feat_census", q("feat_census"), runs),
        ("feat_passenger", q("feat_passenger"), runs),
        ("feat_hourly_vector", q("feat_hourly_vector"), runs),
        ("enc_string_index_multi", q("enc_string_index_multi"), runs),
        ("metric_auc", q("metric_auc"), runs),
        ("metric_multiclass", q("metric_multiclass"), runs),
        ("src_bad_rows", q("src_bad_rows"), runs),
        ("fit_round_binary", fit_rounds, 1),
        ("score_model", score, runs),
        ("mllib_gbt_round_binary", mllib_round, runs),
        ("fit_round_softprob_10class", fit_softprob, 1),
        ("tune_tvs_2x2", tune, 0),
    ]
    out = {}
    for name, fn, n in plan:
        first = fn()  # warm-up; the only run of an item with n = 0
        times = [fn() for _ in range(n)] or [first]
        out[name] = round(statistics.median(times), 3)
    rows = state["frame"].count()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "sf": sf, "cpus": cpus, "runs": runs,
                      "train_rows": rows}))
    spark.stop()


if __name__ == "__main__":
    main()
