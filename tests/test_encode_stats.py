import pytest
from pyspark.sql import functions as F

from tabfit.operators.encode import FirstSeenVocab, FrequencyIndexer, OneHot
from tabfit.operators.ranking import global_index, running_totals
from tabfit.operators.stats import Standardizer, masked_moments, standardize_inline

SF = "/root/testdata/sf0.001"


def test_first_seen_onehot_g6(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x"), (4, "")], "k int, c string")
    m = OneHot(["c"], "k", empty_values={"c": ""}).fit(df)
    assert m.width("c") == 3
    rows = m.transform(df).orderBy("k").select("cVec").collect()
    assert [r[0] for r in rows] == [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [1.0, 0.0, 0.0], [0.0, 0.0, 0.0]]
    unseen = spark.createDataFrame([(9, "z")], "k int, c string")
    assert m.transform(unseen).first()["cVec"] == [0.0, 0.0, 0.0]
    vocab = {r["value"]: r["index"] for r in m.vocab_model.vocab.collect()}
    assert vocab == {"x": 0, "y": 1, "": 2}


@pytest.mark.parametrize("local_rank_max", [4096, 0])
def test_frequency_indexer_matches_mllib(spark, local_rank_max):
    """Both ranking paths (on the driver for bounded statistics, distributed
    range buckets otherwise) equal MLlib's StringIndexer."""
    import tabfit.operators.encode as E
    from pyspark.ml.feature import StringIndexer
    part = spark.read.parquet(f"{SF}/part.parquet").select("p_partkey", "p_brand", "p_type")
    old = E.LOCAL_RANK_MAX
    E.LOCAL_RANK_MAX = local_rank_max
    try:
        ours = FrequencyIndexer(["p_brand", "p_type"], ["b", "t"]).fit(part).transform(part)
        a = sorted(tuple(r) for r in ours.select("p_partkey", "b", "t").collect())
    finally:
        E.LOCAL_RANK_MAX = old
    ml = StringIndexer(inputCols=["p_brand", "p_type"], outputCols=["b", "t"],
                       stringOrderType="frequencyDesc").fit(part).transform(part)
    b = sorted(tuple(r) for r in ml.select("p_partkey", "b", "t").collect())
    assert a == b


def test_indexer_handle_invalid(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "c string")
    m = FrequencyIndexer(["c"], ["i"], handle_invalid="keep").fit(df)
    other = spark.createDataFrame([("a",), ("zz",)], "c string")
    assert [r[0] for r in m.transform(other).orderBy("c").select("i").collect()] == [0.0, 2.0]
    m.handle_invalid = "skip"
    assert m.transform(other).count() == 1
    m.handle_invalid = "error"
    with pytest.raises(Exception):
        m.transform(other).collect()


def test_global_index_multi_bucket(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5003).alias("k"))
    got = global_index(df, ["k"], rows_per_bucket=300)  # forces ~17 key ranges
    rows = got.orderBy("k").collect()
    assert [r["index"] for r in rows] == list(range(5000))


def test_running_totals(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(100)], "k int, v int")
    got = {r["k"]: r["before_v"] for r in running_totals(df, ["k"], ["v"], rows_per_bucket=7).collect()}
    expect, acc = {}, 0
    for i in range(100):
        expect[i] = acc
        acc += i % 3
    assert got == expect


def test_masked_moments_and_standardize_g5(spark):
    df = spark.createDataFrame([(22.0,), (-1.0,), (38.0,), (30.0,)], "age double")
    row = masked_moments(df, ["age"]).first()
    assert row["age_mean"] == pytest.approx(30.0)
    assert row["age_std"] == pytest.approx(6.531972647421808)
    expect = [-1.224744871391589, -4.7458863766424075, 1.224744871391589, 0.0]
    fitted = Standardizer(["age"]).fit(df).transform(df, suffix="S").select("ageS").collect()
    inline = standardize_inline(df, ["age"], suffix="S").select("ageS").collect()
    assert [r[0] for r in fitted] == pytest.approx(expect)
    assert [r[0] for r in inline] == pytest.approx(expect)


def test_sparse_onehot_equals_the_dense_one(spark):
    from pyspark.ml.functions import vector_to_array
    rows = [(i, v, w, float(i)) for i, (v, w) in enumerate([("b", "x"), ("", "y"), ("a", None), ("b", "x"), ("c", "z")])]
    df = spark.createDataFrame(rows, "k int, c string, d string, n double")
    m = OneHot(["c", "d"], "k", empty_values={"c": "", "d": ""}).fit(df.where("k < 4"))
    dense = m.transform(df).select("k", F.concat("cVec", "dVec", F.array("n")).alias("x"))
    sparse = m.transform_sparse(df, "f", ["n"])
    assert sparse.columns == [*df.columns, "f"]
    assert sorted(sparse.select("k", vector_to_array("f").alias("x")).collect()) == sorted(dense.collect())


def test_onehot_of_two_hundred_thousand_values(spark):
    """No bound on the width: the frame is fitted on and scored as it is."""
    from tabfit.operators.boosting import BoostParams, BoostTrainer
    n = 200_000
    df = spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("c"),
                               (F.col("id") % 5).cast("string").alias("d"))
    m = OneHot(["c", "d"], "k").fit(df)
    assert m.width("c") == n
    few = m.transform_sparse(df.where("k % 400 = 7 or k < 500"), "features").withColumn(
        "label", F.when(F.col("d") == "3", 1.0).otherwise(0.0))
    assert few.first()["features"].size == n + 5
    model = BoostTrainer(BoostParams(objective="binary:logistic", num_round=1, max_depth=1, missing=0.0)).fit(few)
    assert model.trees[0].splits[0][0] == n + 3
    assert model.transform(few).where("prediction = label").count() == few.count()


def test_inline_and_joined_lookups_agree(spark):
    """Small vocabularies use a literal map, large ones a join: same indexes,
    also for values with quotes, backslashes and commas."""
    import tabfit.operators.encode as E
    vals = ["a", "it's", "back\\\\slash", "x,y", "", "b"]
    df = spark.createDataFrame([(v,) for v in vals for _ in range(vals.index(v) + 1)], "c string")
    small = FrequencyIndexer(["c"], ["i"]).fit(df)
    assert "c" in small.inline
    old = E.INLINE_VOCAB_MAX, E.LOCAL_RANK_MAX
    E.INLINE_VOCAB_MAX, E.LOCAL_RANK_MAX = 0, 0   # join lookup + distributed ranking
    try:
        big = FrequencyIndexer(["c"], ["i"]).fit(df)
    finally:
        E.INLINE_VOCAB_MAX, E.LOCAL_RANK_MAX = old
    assert "c" not in big.inline
    a = sorted(tuple(r) for r in small.transform(df).collect())
    b = sorted(tuple(r) for r in big.transform(df).collect())
    assert a == b and len({r[1] for r in a}) == len(vals)


def test_first_seen_paths_agree(spark):
    import tabfit.operators.encode as E
    p = spark.read.parquet(f"{SF}/customer.parquet").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("n"), "c_mktsegment")
    a = sorted(tuple(r) for r in FirstSeenVocab(["n", "c_mktsegment"], "c_custkey").fit(p)
               .vocab.select("column", "value", "index").collect())
    old = E.LOCAL_RANK_MAX
    E.LOCAL_RANK_MAX = 0
    try:
        b = sorted(tuple(r) for r in FirstSeenVocab(["n", "c_mktsegment"], "c_custkey").fit(p)
                   .vocab.select("column", "value", "index").collect())
    finally:
        E.LOCAL_RANK_MAX = old
    assert a == b


def test_global_index_composite_string_keys(spark):
    """Many key ranges over (string, long) keys: struct boundaries, NULL-free."""
    rows = [(f"col{i % 7}", -(i * 37 % 101), f"v{i:05d}") for i in range(3000)]
    df = spark.createDataFrame(rows, "column string, neg long, value string")
    got = global_index(df, ["column", "neg", "value"], rows_per_bucket=150)
    out = sorted((r["index"], r["column"], r["neg"], r["value"]) for r in got.collect())
    expect = sorted(rows)
    assert [(c, n, v) for _, c, n, v in out] == expect
    assert [i for i, *_ in out] == list(range(3000))
