"""Every catalogue query runs; those with an oracle match DuckDB (sf0.001)."""

import hashlib
import math
import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
#: query -> what its rows must satisfy (a list of dicts)
BY_ROUND = {"train_watch": 100, "train_watch_rmsle": 100, "train_watch_multiclass": 10}
#: share of right predictions on the rows that the model was trained on
ON_TRAINING_ROWS = {"tune_sales_scored": 0.6, "tune_sales_pipeline": 0.6, "train_softprob": 0.5}
GRIDS = {"tune_tvs": 4, "tune_census_lambda": 4, "tune_passenger_margin": 4, "tune_libsvm_depth": 4}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return repr(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows))
                        .encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


# the corpus queries without SQL have tests of their own
OWN_TESTS = {n for n in E.queries() if re.match(r"op\d+_|pipeline$", n)}


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql()) - OWN_TESTS))
def test_model_queries(spark, name):
    """Rows are collected whole: losses fall, probabilities are probabilities, scores
    are finite and separate the labels, a grid has one best point."""
    rows = [r.asDict() for r in E.queries()[name](spark, SF).collect()]
    assert rows
    for c in ("probability", "validation_auc"):
        assert all(0.0 <= r[c] <= 1.0 for r in rows if c in r)
    for c in ("margin", "prediction", "value", "margin1", "marginAll"):
        assert all(math.isfinite(r[c]) for r in rows if c in r)
    if name in BY_ROUND:
        train = [r["value"] for r in sorted(rows, key=lambda r: r["round"]) if r["set"] == "train"]
        assert len(train) == BY_ROUND[name] and train[-1] < train[0]
    if name in GRIDS:
        best = [r for r in rows if r["is_best"]]
        assert len(rows) == GRIDS[name] and len(best) == 1
        assert best[0]["validation_auc"] == max(r["validation_auc"] for r in rows)
    if name in ON_TRAINING_ROWS:
        right = sum(float(r["label"]) == r["prediction"] for r in rows) / len(rows)
        assert right > ON_TRAINING_ROWS[name]
    if name == "model_dump":
        leaves = [r for r in rows if r["is_leaf"]]
        assert len({r["tree"] for r in rows}) == 20 and len(leaves) == len(rows) - len(leaves) + 20


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["rowId", "storeId", "label", "margin", "probability", "prediction"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_no_python_in_plans(spark, name):
    import io
    from contextlib import redirect_stdout
    buf = io.StringIO()
    with redirect_stdout(buf):
        E.queries()[name](spark, SF).explain()
    plan = buf.getvalue()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
