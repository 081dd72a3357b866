import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabfit.operators.boosting import (BoostModel, BoostParams, BoostTrainer, grad_hess, leaf_weights,
                                       state_rows)
from tabfit.operators.evaluate import auc, auc_value
from tabfit.operators.tuning import TrainValidationSplit, hash_split, hash_threshold, param_grid
from tabfit.plans import standins as S
from tabfit.plans.frames import sales_features

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sales(spark):
    return sales_features(S.sales(spark, SF), S.stores(spark, SF)).persist()


def _loss(hist, set_name="train"):
    return [v for (_, s, _, v) in hist if s == set_name]


def test_binary_invariants(spark, sales):
    train, test = hash_split(sales, "rowId", 0.8)
    p = BoostParams(objective="binary:logistic", num_round=4, eta=0.5, max_depth=3)
    m = BoostTrainer(p).fit(train, watches={"test": test})
    losses = _loss(m.history)
    assert len(losses) == 4 and all(b < a for a, b in zip(losses, losses[1:]))
    assert losses[0] < math.log(2)  # better than the constant 0.5 model
    sc = m.transform(test)
    assert sc.count() == test.count()
    assert sc.where((F.col("probability") < 0) | (F.col("probability") > 1)).count() == 0
    # same data and seed -> the same model
    m2 = BoostTrainer(p).fit(train)
    assert [t.splits for t in m.trees] == [t.splits for t in m2.trees]


def test_binned_training_margin_equals_raw_scoring(spark, sales):
    p = BoostParams(objective="binary:logistic", num_round=3, eta=0.3, max_depth=4)
    m = BoostTrainer(p).fit(sales, watches={"again": sales})
    # history of the training rows (binned margins) equals the metric of raw scoring
    from tabfit.functions.metrics import logloss
    raw = m.transform(sales).agg(logloss(F.col("probability"), F.col("label"))).first()[0]
    assert _loss(m.history)[-1] == pytest.approx(raw, rel=1e-9)
    assert _loss(m.history, "again")[-1] == pytest.approx(raw, rel=1e-9)


def test_regression_and_subsample(spark):
    from tabfit.plans.frames import hourly_features
    fr = hourly_features(S.hourly(spark, SF))
    p = BoostParams(objective="reg:squarederror", num_round=4, eta=0.3, max_depth=4, subsample=0.8)
    with pytest.raises(ValueError):
        BoostTrainer(p).fit(fr)  # sampling needs a row id
    m = BoostTrainer(p, id_col="rowId").fit(fr, watches={"all": fr})
    rm = _loss(m.history)
    assert all(b < a for a, b in zip(rm, rm[1:]))


def test_softprob(spark):
    v = S.vectors(spark, SF)
    p = BoostParams(objective="multi:softprob", num_class=10, num_round=2, eta=0.3, max_depth=2)
    m = BoostTrainer(p, features_col="x").fit(v, watches={"all": v})
    ml = _loss(m.history)
    assert ml[1] < ml[0] < math.log(10) + 1e-9
    s = m.transform(v).select(F.aggregate("probabilities", F.lit(0.0), lambda a, x: a + x).alias("t"))
    assert all(r["t"] == pytest.approx(1.0) for r in s.collect())


def test_logitraw_margin_and_tree_limit(spark, sales):
    p = BoostParams(objective="binary:logitraw", num_round=3, eta=0.3, max_depth=3)
    m = BoostTrainer(p).fit(sales)
    full = m.transform(sales).select("rowId", "margin").collect()
    lim = m.transform(sales, tree_limit=1000).select("rowId", "margin").collect()
    assert full == lim
    one = m.transform(sales, tree_limit=1).select("margin").collect()
    assert one != [r[1:] for r in full]


def test_save_load_same_scores(spark, sales, tmp_path):
    p = BoostParams(objective="binary:logistic", num_round=2, eta=0.3, max_depth=3)
    m = BoostTrainer(p).fit(sales)
    path = str(tmp_path / "model")
    m.save(spark, path)
    m2 = BoostModel.load(spark, path)
    a = m.transform(sales).select("rowId", "probability").orderBy("rowId").collect()
    b = m2.transform(sales).select("rowId", "probability").orderBy("rowId").collect()
    assert a == b
    assert m.nodes(spark).count() == m2.nodes(spark).count()


def test_leaf_weights_g8(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 1.0), (0, 0.0)], "leaf int, y double")
    g, h = grad_hess("binary:logistic", F.array(F.lit(0.0)), F.col("y"))
    t = df.select("leaf", g[0].alias("g"), h[0].alias("h"))
    assert leaf_weights(t, "leaf", "g", "h", 1.0).first()["weight"] == pytest.approx(0.2857142857142857)
    assert leaf_weights(t, "leaf", "g", "h", 0.5).first()["weight"] == pytest.approx(0.4)


def test_auc_g8_and_mllib(spark):
    df = spark.createDataFrame([(.9, 1), (.6, 1), (.6, 0), (.3, 0), (.3, 1)], "s double, y int")
    assert auc_value(df, "s", "y") == pytest.approx(0.6666666666666666)
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    o = spark.read.parquet(f"{SF}/orders.parquet").select(
        F.col("o_totalprice").alias("s"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1.0).otherwise(0.0).alias("y"))
    ml = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0).evaluate(o)
    assert auc_value(o, "s", "y") == pytest.approx(ml, abs=1e-12)


def test_grid_and_split():
    assert param_grid(num_round=[20, 50], eta=[0.1, 0.4]) == [
        {"num_round": 20, "eta": 0.1}, {"num_round": 20, "eta": 0.4},
        {"num_round": 50, "eta": 0.1}, {"num_round": 50, "eta": 0.4}]
    assert len(param_grid(eta=[0.1, 0.6], reg_lambda=[0.5, 1])) == 4
    assert hash_threshold(0.8) == "cccccccd" and hash_threshold(0.0) == "00000000"


def test_train_validation_split(spark, sales):
    base = BoostParams(objective="binary:logistic", max_depth=2)
    res = TrainValidationSplit(base, param_grid(num_round=[1, 2], eta=[0.1, 0.4]), "rowId").fit(sales)
    r = res.results(spark).collect()
    assert len(r) == 4 and sum(x["is_best"] for x in r) == 1
    best = max(r, key=lambda x: x["validation_auc"])
    assert best["is_best"]
    assert res.transform(sales).count() == sales.count()


def test_prepared_state_matches_scoring(spark, sales):
    """Validation AUC read off the shared quantised state equals the AUC of
    scoring the validation rows with the fitted model."""
    from tabfit.operators.tuning import in_train
    tr = BoostTrainer(BoostParams(objective="binary:logistic", num_round=2, eta=0.3, max_depth=3))
    prep = tr.prepare(sales, set_col=F.when(in_train("rowId", 0.8), "train").otherwise("valid"))
    model, state = tr.fit_prepared(prep, ("train",), keep_state=True)
    rows = state_rows(state, prep.n_feat)
    a = auc(rows.where(F.col("set") == "valid").select(F.col("m")[0].alias("s"), "y"), "s", "y").first()["auc"]
    _, valid = hash_split(sales, "rowId", 0.8)
    b = auc_value(model.transform(valid), "probability", "label")
    state.unpersist()
    prep.release()
    assert a == pytest.approx(b, abs=1e-12)


def test_routed_scoring_equals_case_expression(spark, sales):
    """Scoring by node tables equals the exported nested-CASE SQL of the model."""
    p = BoostParams(objective="binary:logistic", num_round=3, eta=0.3, max_depth=4)
    m = BoostTrainer(p).fit(sales)
    from pyspark.ml.functions import vector_to_array
    a = m.transform(sales).select("rowId", "margin").orderBy("rowId").collect()
    via_sql = (sales.withColumn("_x", vector_to_array("features"))
               .select("rowId", F.expr(m.margin_sql("_x"))[0].alias("margin")).orderBy("rowId").collect())
    assert [r["margin"] for r in a] == pytest.approx([r["margin"] for r in via_sql], abs=1e-12)


def _shape(model):
    return [({n: (sp[:2], sp[5]) for n, sp in t.splits.items()}, sorted(t.leaves)) for t in model.trees]


def _leaves(model):
    return [v for t in model.trees for _, (v, _) in sorted(t.leaves.items())]


def test_shuffled_histograms_give_the_same_trees(spark, sales):
    """Pages in one task, and in several with a shuffle by node."""
    from dataclasses import replace
    v = S.vectors(spark, SF)
    cases = [(sales, "features", BoostParams(objective="binary:logistic", num_round=2, eta=0.3, max_depth=5)),
             (sales, "features", BoostParams(objective="reg:squarederror", num_round=2, max_depth=5, subsample=0.8)),
             (v, "x", BoostParams(objective="multi:softprob", num_class=10, num_round=1, eta=0.3, max_depth=3))]
    for df, col, p in cases:
        tr = BoostTrainer(p, features_col=col, id_col="rowId")
        prep = tr.prepare(df.repartition(3))
        assert prep.parts == 1
        a = tr.fit_prepared(prep)
        # the same edges, pages of the two halves
        halves = [_requantised(tr, df.where(f"rowId % 2 = {i}"), prep.edges) for i in (0, 1)]
        both = replace(prep, state=halves[0].unionByName(halves[1]).repartition(2), parts=2)
        b = tr.fit_prepared(both)
        assert _shape(a) == _shape(b)
        assert _leaves(a) == pytest.approx(_leaves(b), rel=1e-9, abs=1e-12)
        prep.release()


def _requantised(tr, df, edges):
    """Pages of ``df`` with given edges."""
    own = tr._edges
    tr._edges = lambda values, n: edges
    try:
        return tr.prepare(df).state
    finally:
        tr._edges = own


def _brute_best(x, y_g, y_h, lam, mcw):
    """Best split of one node over all cuts of raw bins, missing (None) on either side."""
    best = None
    n_feat = len(x[0])
    for f in range(n_feat):
        vals = sorted({r[f] for r in x if r[f] is not None})
        miss = [i for i, r in enumerate(x) if r[f] is None]
        for cut in vals[1:] + ([math.inf] if miss else []):
            for left in (False, True):
                if left and not miss:
                    continue
                L = [i for i, r in enumerate(x) if (r[f] is not None and r[f] < cut) or (r[f] is None and left)]
                R = [i for i in range(len(x)) if i not in set(L)]
                if not L or not R:
                    continue
                s = [sum(v[i] for i in side) for side in (L, R) for v in (y_g, y_h)]
                if s[1] < mcw or s[3] < mcw:
                    continue
                G, H = s[0] + s[2], s[1] + s[3]
                gain = s[0] ** 2 / (s[1] + lam) + s[2] ** 2 / (s[3] + lam) - G ** 2 / (H + lam)
                key = (-float(f"{gain:.10e}"), f, cut, left)
                if best is None or key < best[0]:
                    best = key, gain, sorted(L)
    return best


def test_first_split_equals_brute_force_with_missing_values(spark):
    import random
    rnd = random.Random(5)
    for trial in range(4):
        x = [[None if rnd.random() < 0.3 else float(rnd.randint(0, 4)) for _ in range(3)] for _ in range(60)]
        y = [float((r[0] or 0) > 2) + (2.0 if r[1] is None else 0.0) + rnd.random() for r in x]
        df = spark.createDataFrame([(i, r, v) for i, (r, v) in enumerate(zip(x, y))], "id int, x array<double>, label double")
        p = BoostParams(objective="reg:squarederror", num_round=1, max_depth=1, reg_lambda=0.5 + trial)
        m = BoostTrainer(p, features_col="x").fit(df)
        best = _brute_best(x, [0.5 - v for v in y], [1.0] * len(y), p.reg_lambda, 1.0)
        f, _, thr, gain, _, left = m.trees[0].splits[0]
        assert (f, thr, left) == best[0][1:] and gain == pytest.approx(best[1])
        # scoring sends the rows where training did
        got = {r["id"]: r["prediction"] for r in m.transform(df).collect()}
        low = {got[i] for i in best[2]}
        assert len(low) == 1 and low.isdisjoint({got[i] for i in range(60) if i not in set(best[2])})


def test_sparse_and_dense_input_give_the_same_trees(spark):
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.linalg import Vectors
    import random
    rnd = random.Random(9)
    rows = []
    for i in range(400):
        v = [rnd.choice([0.0, 0.0, 0.0, 1.0, 2.5, -1.0]) for _ in range(12)]
        rows.append((i, Vectors.sparse(12, [(k, a) for k, a in enumerate(v) if a]), v,
                     float(v[3] > 0) if rnd.random() < 0.9 else float(v[5] == 0)))
    df = spark.createDataFrame(rows, ["id", "sv", "x", "label"]).withColumn("dv", array_to_vector("x"))
    p = BoostParams(objective="binary:logistic", num_round=3, eta=0.5, max_depth=4, missing=0.0)
    models = {c: BoostTrainer(p, features_col=c).fit(df) for c in ("sv", "dv", "x")}
    nan = df.withColumn("n", F.transform("x", lambda v: F.when(v != 0, v).otherwise(float("nan"))))
    models["n"] = BoostTrainer(p.replace(missing=None), features_col="n").fit(nan)
    first = _shape(models["sv"])
    assert any(sp[1] for t, _ in first for sp in t.values())  # some default goes left
    scores = []
    for c, m in models.items():
        assert _shape(m) == first
        scores.append([r["margin"] for r in m.transform(nan).orderBy("id").collect()])
    assert all(s == pytest.approx(scores[0], abs=1e-12) for s in scores)
    # training margins equal scoring
    tr = BoostTrainer(p, features_col="sv", id_col="id")
    prep = tr.prepare(df)
    model, state = tr.fit_prepared(prep, keep_state=True)
    got = sorted(r["m"][0] for r in state_rows(state, prep.n_feat).collect())
    assert got == pytest.approx(sorted(scores[0]), abs=1e-12)
    prep.release()


def test_two_hundred_thousand_sparse_features(spark):
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql.types import DoubleType, StructField, StructType
    n = 200_000
    rows = [(Vectors.sparse(n, [(i * 97 % n, 1.0), (7 if i % 3 else 8, 1.0)] if i * 97 % n > 8 else [(9, 1.0)]),
             float(i % 3 == 0)) for i in range(1, 600)]
    df = spark.createDataFrame(rows, StructType([StructField("features", VectorUDT()), StructField("label", DoubleType())]))
    p = BoostParams(objective="binary:logistic", num_round=2, eta=1.0, max_depth=2, missing=0.0)
    m = BoostTrainer(p).fit(df)
    assert m.num_features == n and m.trees[0].splits[0][0] in (7, 8)
    right = m.transform(df).where((F.col("prediction") == F.col("label"))).count()
    assert right >= 590


def test_grid_points_equal_single_fits(spark, sales):
    """All points of a grid grow in the same jobs; each equals its own fit."""
    from tabfit.operators.tuning import in_train
    base = BoostParams(objective="binary:logistic", subsample=0.8)
    grid = param_grid(num_round=[2, 4], eta=[0.1, 0.4], max_depth=[2, 4], reg_lambda=[0.5, 2.0])
    tuned = TrainValidationSplit(base, grid, "rowId", refit=False).fit(sales)
    train, valid = hash_split(sales, "rowId", 0.8)
    for i in (0, 5, 10, 15):
        p = base.replace(**grid[i])
        tr = BoostTrainer(p, id_col="rowId")
        prep = tr.prepare(sales, set_col=F.when(in_train("rowId", 0.8), "train").otherwise("valid"), edge_sets=("train",))
        single = tr.fit_prepared(prep, ("train",))
        prep.release()
        assert tuned.metrics[i] == pytest.approx(auc_value(single.transform(valid), "probability", "label"), abs=1e-12)
        if i == tuned.best_index:
            assert _shape(single) == _shape(tuned.best_model)
    assert tuned.best_index == max(range(len(grid)), key=lambda i: (tuned.metrics[i], -i))
    assert len({t.round for t in tuned.best_model.trees}) == grid[tuned.best_index]["num_round"]


def test_auc_as_watch_metric(spark, sales):
    train, test = hash_split(sales, "rowId", 0.8)
    p = BoostParams(objective="binary:logistic", num_round=2, eta=0.5, max_depth=3, eval_metric="auc")
    m = BoostTrainer(p).fit(train, watches={"test": test})
    assert [(r, s, n) for r, s, n, _ in m.history] == [(r, s, "auc") for r in (0, 1) for s in ("test", "train")]
    for r, name, _, v in m.history:
        rows = train if name == "train" else test
        assert v == pytest.approx(auc_value(m.transform(rows, tree_limit=r + 1), "probability", "label"), abs=1e-12)


def test_split_ratio_is_exact_at_the_ends(spark):
    df = spark.range(20_000)
    for ratio in (0.0, 1.0):
        train, test = hash_split(df, "id", ratio)
        assert (train.count(), test.count()) == (round(20_000 * ratio), round(20_000 * (1 - ratio)))
    share = hash_split(df, "id", 0.9)[0].count() / 20_000
    assert abs(share - 0.9) < 0.01


def test_rare_and_sparse_features_get_bins(spark):
    """One-hot on 1 % of the rows, 95 % missing, and a skewed feature with rare values."""
    n = 10_000
    x = F.array(F.when(F.col("id") % 100 == 7, 1.0).otherwise(0.0),
                F.when(F.col("id") % 20 == 0, (F.col("id") % 999).cast("double")),
                F.when(F.col("id") % 500 == 3, 1000.0 + F.col("id")).otherwise((F.col("id") % 3).cast("double")),
                F.lit(float("nan")))
    df = spark.range(n).select("id", x.alias("x"), F.when(F.col("id") % 100 == 7, 1.0).otherwise(0.0).alias("label"))
    tr = BoostTrainer(BoostParams(objective="binary:logistic", num_round=1, max_depth=2), features_col="x")
    prep = tr.prepare(df)
    assert prep.edges[0] == [1.0]
    assert len(prep.edges[1]) > 40 and all(v == v for e in prep.edges for v in e)
    assert prep.edges[2][:3] == [1.0, 2.0, 1003.0] and prep.edges[3] == []
    prep.release()
    assert tr.fit(df).trees[0].splits[0][0] == 0


def test_copies_of_a_row_are_sampled_one_by_one(spark):
    from tabfit.operators.boosting import BoostParams as P
    df = spark.range(4000).select("id", F.array(F.lit(1.0)).alias("x"), (F.col("id") % 2).cast("double").alias("label"))
    prep = BoostTrainer(P(subsample=0.5), features_col="x", id_col="id").prepare(df)
    state = prep.state
    from tabfit.operators import pages
    rids = [i for b in state.toArrow().to_batches() for page in pages.read_pages(b, 1) for i in page.rid.tolist()]
    assert len(set(rids)) == len(rids) == 4000
    import numpy as np
    share = pages.sampled(np.array(rids), 0, 0, 0.5).mean()
    assert abs(share - 0.5) < 0.03
    prep.release()


def test_tuning_bins_come_from_the_train_part(spark):
    from tabfit.operators.tuning import in_train
    df = spark.range(400).select(F.col("id"), F.when(in_train("id", 0.5), F.col("id") % 5).otherwise(99)
                                 .cast("double").alias("v"))
    df = df.select("id", F.array("v").alias("x"), (F.col("id") % 2).cast("double").alias("label"))
    tr = BoostTrainer(BoostParams(), features_col="x", id_col="id")
    split = F.when(in_train("id", 0.5), "train").otherwise("valid")
    prep = tr.prepare(df, set_col=split, edge_sets=("train",))
    assert prep.edges == [[1.0, 2.0, 3.0, 4.0]]
    prep.release()
    with pytest.raises(ValueError):
        TrainValidationSplit(BoostParams(objective="multi:softprob", num_class=3), [{}], "id")


def test_equal_gains_take_the_least_feature():
    import numpy as np
    from tabfit.operators.pages import best_of_node
    f, b = np.repeat(np.arange(3), 2), np.tile(np.arange(2), 3)
    G = np.array([-1.0, 1.0] * 3) + np.repeat([0.0, 1e-14, -1e-14], 2)
    best = best_of_node(f, b, G, np.ones(6), np.ones(6, dtype=int), (0.0, 2.0, 2), 1.0, 0.5)
    assert best[:3] == (0, 0, False)


def test_auc_keeps_the_null_group_and_large_counts(spark):
    from tabfit.operators.evaluate import evaluate
    df = spark.createDataFrame([(None, 0.9, 1.0), (None, 0.1, 0.0), ("a", 0.2, 1.0), ("a", 0.8, 0.0)],
                               "g string, s double, y double")
    got = {r["g"]: r["auc"] for r in auc(df, "s", "y", ["g"]).collect()}
    assert got == {None: 1.0, "a": 0.0}
    empty = evaluate(df.where("false"), "rmse", "s", "y").collect()
    assert len(empty) == 1 and math.isnan(empty[0]["value"])


def test_leaf_masks_equal_case_expressions_to_the_bit(spark, sales):
    """Shallow and deep trees (several words of leaves), classes, missing values, one leaf only."""
    v = S.vectors(spark, SF)
    gaps = v.withColumn("x", F.transform("x", lambda e, i: F.when((e * 1000).cast("int") % 5 == i % 5, float("nan")).otherwise(e)))
    hard = v.withColumn("label", F.col("label") % 2)
    cases = [(sales, "features", BoostParams(objective="binary:logistic", num_round=4, max_depth=4)),
             (hard, "x", BoostParams(objective="reg:squarederror", num_round=2, max_depth=9, min_child_weight=0.0, reg_lambda=0.0)),
             (gaps, "x", BoostParams(objective="multi:softprob", num_class=10, num_round=2, max_depth=3)),
             (sales, "features", BoostParams(objective="binary:logistic", num_round=2, gamma=1e12))]
    for df, col, p in cases:
        m = BoostTrainer(p, features_col=col).fit(df)
        for limit in (None, 1):
            a, b = ([r["_margin"] for r in m.transform(df, limit, keep_margin_array=True, engine=e).orderBy("rowId").collect()]
                    for e in ("sql", "masks"))
            assert a == b
    assert max(len(t.leaves) for t in BoostTrainer(cases[1][2], features_col="x").fit(hard).trees) > 64


def _ks():
    """Greatest distance between the score distributions of the two classes, on 1,000 bins."""
    import numpy as np
    from tabfit.functions.metrics import StateMetric

    def update(s, p, y):
        at = np.clip((p * 1000).astype(int), 0, 999)
        return s + np.stack([np.bincount(at[y == k], minlength=1000) for k in (0, 1)])

    def finish(s):
        c = np.cumsum(s, axis=1) / np.maximum(s.sum(axis=1, keepdims=True), 1)
        return float(np.abs(c[0] - c[1]).max())
    return StateMetric("ks", lambda: np.zeros((2, 1000), dtype=int), update, lambda a, b: a + b, finish, True, "probability")


def test_state_metric_each_round(spark, sales):
    import numpy as np
    from tabfit.operators.evaluate import evaluate
    ks = _ks()
    train, test = hash_split(sales, "rowId", 0.8)
    p = BoostParams(objective="binary:logistic", num_round=2, eta=0.5, max_depth=3)
    m = BoostTrainer(p, metric=ks).fit(train, watches={"test": test})
    assert [(r, s, n) for r, s, n, _ in m.history] == [(r, s, "ks") for r in (0, 1) for s in ("test", "train")]
    scored = m.transform(test)
    rows = scored.select("probability", "label").toPandas()
    state = ks.update(ks.init(), rows["probability"].to_numpy(), rows["label"].to_numpy())
    assert m.history[2][3] == pytest.approx(ks.finish(state))
    got = evaluate(scored.repartition(7), ks, "probability", "label", set_name="held out").collect()
    assert [tuple(r) for r in got] == [("held out", "ks", pytest.approx(ks.finish(state)))]
    assert np.isfinite(got[0]["value"])


def test_a_level_is_one_short_job(spark, sales, monkeypatch):
    """Pages in several tasks: a level of a bounded histogram, and the metric of a round, are
    one job each; a larger histogram is shuffled and gives the same trees."""
    from dataclasses import replace
    from tabfit.operators import boosting
    p = BoostParams(objective="binary:logistic", num_round=3, max_depth=4, reg_lambda=0.5)
    tr = BoostTrainer(p, id_col="rowId")
    prep = tr.prepare(sales)
    halves = [_requantised(tr, sales.where(f"rowId % 2 = {i}"), prep.edges) for i in (0, 1)]
    both = replace(prep, state=halves[0].unionByName(halves[1]).repartition(2), parts=2)
    sc = spark.sparkContext
    fits, stages = [], []
    for limit in (boosting.COLLECTED_SLOTS, 0):
        monkeypatch.setattr(boosting, "COLLECTED_SLOTS", limit)
        sc.setJobGroup(f"levels-{limit}", "")
        fits.append(tr.fit_prepared(both, track=True))
        sc.setLocalProperty("spark.jobGroup.id", None)
        tracker = sc.statusTracker()
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(f"levels-{limit}")]
        stages.append((len(jobs), max(len(j.stageIds) for j in jobs)))
    # four levels of three rounds, three metrics, and one job that reads the pages
    assert stages[0][0] <= 16 and stages[0][1] <= 2
    assert _shape(fits[0]) == _shape(fits[1])
    assert _leaves(fits[0]) == pytest.approx(_leaves(fits[1]), rel=1e-9, abs=1e-12)
    assert [h[3] for h in fits[0].history] == pytest.approx([h[3] for h in fits[1].history], rel=1e-9)
    prep.release()


@pytest.mark.parametrize("name", ["rmsle", "logloss", "error", "rmse"])
def test_array_terms_of_a_metric_equal_its_column(spark, name):
    import math
    from tabfit.functions.metrics import METRICS
    m, nan = METRICS[name], float("nan")
    cases = [[(0.2, 0.0), (0.7, 1.0), (1.0, 0.0)], [(0.0, 1.0), (-3.0, 0.5)], [(nan, 1.0), (0.3, 0.0)], [(0.3, nan)],
             [(0.5, -1.0), (0.4, 0.0)], [(0.5, -2.0)]]
    for i, rows in enumerate(cases):
        want = spark.createDataFrame(rows, "p double, y double").agg(m("p", "y").cast("double").alias("v")).first()["v"]
        pred, y = (np.array(c) for c in zip(*rows))
        terms = m.terms(pred, y)
        got = m.finish(terms.sum(), len(terms))
        assert got == pytest.approx(want, rel=1e-12) or math.isnan(got) and math.isnan(want), (name, i, got, want)


def test_bins_of_a_byte_and_of_two(spark):
    from tabfit.operators.pages import Bins
    assert Bins([[1.0] * 254]).kind == "<u1" and Bins([[1.0] * 255]).kind == "<u2"
    df = spark.range(3000).select("id", F.array((F.col("id") % 700).cast("double"), (F.col("id") % 7).cast("double")).alias("x"),
                                  (F.col("id") % 700 > 300).cast("double").alias("label"))
    for bins, kind in ((64, "<u1"), (1024, "<u2")):
        tr = BoostTrainer(BoostParams(num_round=2, max_depth=3, max_bins=bins), features_col="x")
        prep = tr.prepare(df)
        assert prep.bins().kind == kind
        model, state = tr.fit_prepared(prep, keep_state=True)
        got = sorted(r["m"][0] for r in state_rows(state, prep.n_feat).collect())
        assert got == pytest.approx(sorted(r["margin"] for r in model.transform(df).collect()), abs=1e-12)
        state.unpersist()
        prep.release()


def _random_page(r, count, n, kind="u1", missing=0.1):
    code = np.stack([np.where(r.random(n) < missing, c + 1, r.integers(0, c + 1, n)) for c in count]).astype(kind)
    return ("train", n, r.integers(-9, 9, n).astype("<i8").tobytes(), (r.random(n) < 0.4).astype("<f8").tobytes(),
            r.normal(size=n).astype("<f8").tobytes(), code.tobytes(), None, None)


@pytest.mark.parametrize("objective,share", [("binary:logistic", 1.0), ("binary:logistic", 0.5), ("reg:squarederror", 1.0)])
def test_features_counted_together_give_the_sums_of_each(objective, share, monkeypatch):
    """The histogram of every node, feature and bin equals a count row by row; a level of 14 features
    needs a count over the rows for some groups of them, not three for each feature."""
    from tabfit.operators import pages
    r = np.random.default_rng(3)
    count = [49, 2, 64, 4, 6, 2, 6, 0, 8, 1, 10, 8, 11, 300 if share < 1 else 6]
    bins = pages.Bins([[float(i) for i in range(c)] for c in count])
    records = [_random_page(r, count, n, "u1" if bins.kind == "<u1" else "u2") for n in (900, 1, 700)]
    splits = {0: (0, 20, 0.0, 0.0, 0.0, False), 1: (2, 30, 0.0, 0.0, 0.0, True), 2: (10, 4, 0.0, 0.0, 0.0, False)}
    passes = []
    real = np.bincount
    monkeypatch.setattr(np, "bincount", lambda *a, **k: (passes.append(1), real(*a, **k))[1])
    for known, opened in (({}, [0]), ({0: splits[0]}, [1, 2]), (splits, [3, 4, 6]), (splits, [5])):
        level = pages.Level(15, 2, 1, [np.zeros(1)], [objective], [7], [share], [pages.Growing(0, known, np.array(opened))])
        del passes[:]
        got = {t: v for t, v in pages.histograms(records, level, bins)}
        assert len(passes) <= 3 * 10  # three pages; before: 3 * 14 and 3 a page
        want = {}
        for record in records:
            page = pages.page_of(record, len(count))
            g, h = pages.gradients(objective, page.m, page.y)
            node, ok = pages.route(page, known, bins, {}), pages.sampled(page.rid, 2, 7, share)
            for i in range(page.n):
                if int(node[i]) not in opened or ok is not None and not ok[i]:
                    continue
                sums, slots = want.setdefault(int(node[i]), (np.zeros(3), {}))
                v = np.array([g[0][i], h[0][i], 1.0])
                sums += v
                for f, c in enumerate(count):
                    if page.bins[f][i] <= c:
                        slots[int(bins.slot[f]) + int(page.bins[f][i])] = slots.get(int(bins.slot[f]) + int(page.bins[f][i]), 0.0) + v
        assert set(got) == set(want)
        for t, (G, H, n, slot, g, h, rows) in got.items():
            sums, slots = want[t]
            assert (G, H, n) == pytest.approx(tuple(sums), rel=1e-12)
            assert slot.tolist() == sorted(slots)
            assert np.array([g, h, rows]).T == pytest.approx(np.array([slots[s] for s in slot.tolist()]), rel=1e-9, abs=1e-12)


def test_masks_and_tables_lead_to_the_same_node():
    from tabfit.operators import pages
    r = np.random.default_rng(8)
    count = [5, 12, 3]
    bins = pages.Bins([[float(i) for i in range(c)] for c in count])
    page = pages.page_of(_random_page(r, count, 500), 3)
    for _ in range(20):
        splits, level = {}, [0]
        while level:
            k = level.pop()
            if k < 31 and r.random() < 0.8:
                f = int(r.integers(3))
                splits[k] = (f, int(r.integers(count[f] + 1)), 0.0, 0.0, 0.0, bool(r.integers(2)))
                level += [2 * k + 1, 2 * k + 2]
        number = r.integers(0, 200, 70)
        assert (pages.numbered(page, splits, bins, {}, number) == number[pages.route(page, splits, bins, {})]).all()


def test_pages_are_joined_while_trees_grow(monkeypatch):
    from tabfit.operators import pages
    r = np.random.default_rng(9)
    monkeypatch.setattr(pages, "GROWING_ROWS", 100)
    small = [("ab"[i % 2], *_random_page(r, [4, 7], 30)[1:4], None, *_random_page(r, [4, 7], 30)[5:]) for i in range(11)]
    for with_id in (True, False):
        out = list(pages.merged(iter(small), 2, with_id))
        assert [x[:2] for x in out] == [("a", 120), ("b", 120), ("a", 60), ("b", 30)]
        for name in "ab":
            old = [pages.page_of(x, 2) for x in small if x[0] == name]
            new = [pages.page_of(x, 2) for x in out if x[0] == name]
            assert (np.concatenate([p.bins for p in old], axis=1) == np.concatenate([p.bins for p in new], axis=1)).all()
            assert (np.concatenate([p.y for p in old]) == np.concatenate([p.y for p in new])).all()
            ids = np.concatenate([p.rid for p in new])
            assert (ids == (np.concatenate([p.rid for p in old]) if with_id else 0)).all()
    monkeypatch.setattr(pages, "CHUNK", 2 * 50)  # pages of many features stay small
    assert [x[1] for x in pages.merged(iter(small), 2, True) if x[0] == "a"] == [60, 60, 60]
    wide = pages.Joint(pages.Bins([[1.0] * 60] * 3000), 4, 1)
    assert sorted(f for features, *_ in wide.groups for f in features) == list(range(3000))


def test_dense_rows_are_paged_without_a_column_of_nulls(sales, monkeypatch):
    seen = []

    def asked(self, f, schema, *a, **k):
        seen.append(self.columns)
        return mapped(self, f, schema, *a, **k)

    kind = type(sales)
    mapped = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", asked)
    tr = BoostTrainer(BoostParams(num_round=1), id_col="rowId")
    prep = tr.prepare(sales)
    assert seen == [["set", "rid", "y", "val"]]
    prep.release()
