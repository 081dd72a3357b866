"""The corpus pipeline on a small made-up corpus with planted cases."""

import numpy as np
import pytest

import corpus_pipeline
from tabfit.llm import packing, queries


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    r = np.random.default_rng(8)
    words = [f"wor{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i % 6]}" for i in range(300)]

    def prose(n):
        return " ".join(words[k] for k in r.integers(0, 300, n))
    rows, labels = [], []
    for i in range(400):
        t = prose(int(r.integers(40, 200))).split()
        y = int(i % 5 == 0)
        for k in r.choice(len(t), 4, replace=False) if y else ():
            t[int(k)] = ("idiot", "moron")[int(r.integers(2))]
        rows.append([i, " ".join(t), "en", "s", 0])
        labels.append((i, 1, y))
    passage = prose(60)
    rows[101][1] = "first\n" + passage + "\nlast"
    rows[202][1] = "other start\n" + passage + "\nother end " + prose(30)
    rows[103][1] = rows[102][1]
    near = rows[104][1].split()
    near[-1] = "changed"
    rows[106][1] = " ".join(near)
    rows[107][1] += " mail some.one@mail.example.com now"
    rows[108][1], rows[109][1] = None, ""
    d = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([tuple(x) for x in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(
        3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d, {x[0]: x[1] for x in rows}


def test_stages_take_effect(spark, corpus):
    d, texts = corpus
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, d), f"test-{name}")
        seen[name] = docs
        if name != "packing":
            assert docs.columns == columns
    kept = {n: {r["doc_id"]: r for r in seen[n].collect()} for n in ("toxicity", "line_dedup", "near_dedup", "pii")}
    toxic = {i for i in range(400) if i % 5 == 0}
    assert len(toxic - set(kept["toxicity"])) >= 0.95 * len(toxic)
    assert len(set(range(400)) - toxic - set(kept["toxicity"])) <= 4
    lines = kept["line_dedup"]
    assert lines[202]["text"].startswith("other start\nother end") and "first" in lines[101]["text"]
    assert 102 in lines and 103 not in lines and 108 in lines and 109 in lines
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in lines.values())
    near = kept["near_dedup"]
    assert 104 in near and 106 not in near and set(lines) - set(near) <= {106}
    clean = kept["pii"]
    assert "[EMAIL]" in clean[107]["text"] and "@" not in clean[107]["text"]
    assert set(clean) == set(near) and clean[108]["text"] is None
    packed = seen["packing"].collect()
    assert {r["doc_id"] for r in packed} == set(clean)
    assert sum(r["length"] for r in packed if r["start"] == 0 and r["doc_id"] == 108) == 1
    used = {}
    for r in packed:
        used[r["sequence_id"]] = used.get(r["sequence_id"], 0) + r["length"]
    assert max(used.values()) <= packing.CAPACITY


def test_stage_names_and_registration():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "pii", "packing"]
    assert queries.QUERIES["pipeline"] is corpus_pipeline.run and corpus_pipeline.ORACLE_SQL is None
    assert [q for q in queries.QUERIES if q.startswith("op")] == sorted(
        (q for q in queries.QUERIES if q.startswith("op")), key=lambda q: int(q[2:].split("_")[0]))
