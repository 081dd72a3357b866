import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabfit.functions.sentinels import fill_sentinels
from tabfit.sources.csv import read_csv
from tabfit.sources.libsvm import read_libsvm
from tabfit.sources.schemas import CENSUS, STORE, STORE_SENTINELS

# Header and rows as in the public files.
G2 = '''"Store","StoreType","Assortment","CompetitionDistance","CompetitionOpenSinceMonth","CompetitionOpenSinceYear","Promo2","Promo2SinceWeek","Promo2SinceYear","PromoInterval"
1,"c","a",1270,9,2008,0,,,""
2,"a","a",570,11,2007,1,13,2010,"Jan,Apr,Jul,Oct"
291,"d","a",,,,0,,,""
'''

G4 = """39, State-gov, 77516, Bachelors, 13, Never-married, Adm-clerical, Not-in-family, White, Male, 2174, 0, 40, United-States, <=50K
bad row
50, Self-emp-not-inc, 83311, Bachelors, 13, Married-civ-spouse, Exec-managerial, Husband, White, Male, 0, 0, 13, United-States, >50K

x, Private, 1, a, 1, b, c, d, e, f, 0, 0, 1, g, <=50K
"""


def test_store_file_g2(spark, write_text):
    path = write_text("store.csv", G2)
    df = fill_sentinels(read_csv(spark, path, STORE, header=True), STORE_SENTINELS)
    rows = [tuple(r) for r in df.orderBy("storeId").collect()]
    assert rows == [(1, "c", "a", 1270, 9, 2008, 0, -1, -1, ""),
                    (2, "a", "a", 570, 11, 2007, 1, 13, 2010, "Jan,Apr,Jul,Oct"),
                    (291, "d", "a", -1, -1, -1, 0, -1, -1, "")]


def test_census_quarantine_g4(spark, write_text):
    path = write_text("census.csv", G4)
    res = read_csv(spark, path, CENSUS, on_bad="quarantine")
    assert sorted(r["age"] for r in res.good.collect()) == [39, 50]
    # the count must not depend on which columns a query reads
    assert res.good.count() == 2
    assert res.good.select("label").count() == 2
    bad = sorted(r["raw"] for r in res.bad.collect())
    assert bad == ["bad row", "x, Private, 1, a, 1, b, c, d, e, f, 0, 0, 1, g, <=50K"]
    assert res.bad.count() == 2
    assert res.good.where(F.col("workClass") == "State-gov").count() == 1  # trimmed


def test_census_failfast(spark, write_text):
    path = write_text("census_ff.csv", G4)
    with pytest.raises(Exception):
        read_csv(spark, path, CENSUS, on_bad="fail").collect()
    assert read_csv(spark, path, CENSUS, on_bad="drop").count() == 2


def test_libsvm_g7(spark, write_text):
    path = write_text("a.libsvm", "1 3:1 10:1 126:1\n0 3:1 3:5\n")
    raw = read_libsvm(spark, path, 129, index_base=0).select("label", vector_to_array("features").alias("a"))
    rows = raw.orderBy(F.desc("label")).collect()
    ones = [i for i, v in enumerate(rows[0]["a"]) if v != 0]
    assert ones == [3, 10, 126]
    assert rows[1]["a"][3] == 5.0
    path1 = write_text("b.libsvm", "1 3:1 10:1 126:1\n")  # Spark's reader wants increasing indices
    std = read_libsvm(spark, path1, 129, index_base=1).select("label", vector_to_array("features").alias("a"))
    ones = [i for i, v in enumerate(std.orderBy(F.desc("label")).first()["a"]) if v != 0]
    assert ones == [2, 9, 125]


def test_bad_row_line_numbers_g4(spark, write_text):
    """Line numbers count every line of the file (blank ones too), like the
    reference's counter: the bad rows of G4 are lines 2 and 5."""
    path = write_text("census_ln.csv", G4)
    res = read_csv(spark, path, CENSUS, on_bad="quarantine", line_numbers=True)
    assert sorted(r["line"] for r in res.bad.collect()) == [2, 5]
    assert sorted(r["age"] for r in res.good.collect()) == [39, 50]


def test_line_numbers_across_splits(spark, tmp_path):
    """A file read in several splits still gets consecutive numbers."""
    from tabfit.sources.text import numbered_lines
    p = tmp_path / "big.txt"
    p.write_text("".join(f"row {i}\n" for i in range(1, 20001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = numbered_lines(spark, str(p))
        rows = df.select("line", "value").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 20000
    assert all(r["value"] == f"row {r['line']}" for r in rows)


def test_libsvm_index_outside_the_vector_fails(spark, write_text):
    from tabfit.sources.libsvm import read_libsvm
    ok = read_libsvm(spark, write_text("a.txt", "1 3:2 0:1 3:4\n0\n"), 5, index_base=0).collect()
    assert [list(r["features"].toArray()) for r in ok] == [[1, 0, 0, 4, 0], [0, 0, 0, 0, 0]]
    with pytest.raises(Exception, match="libsvm index outside"):
        read_libsvm(spark, write_text("b.txt", "1 3:2 200:5\n"), 129, index_base=0).collect()


def test_label_is_the_last_field_of_any_width(spark, write_text):
    from tabfit.plans.extractors import HourlyExtractor
    line = "2011-01-01 00:00:00,1,0,0,1,9.84,14.395,81,0.0"
    path = write_text("h.csv", f"{line},3,13,16\n{line},8,32,40\n")
    ex = HourlyExtractor(spark)
    assert [r["label"] for r in ex.labeled_points(path).collect()] == [16.0, 40.0]
    assert [r["label"] for r in ex.labeled_points(path, has_label=False).collect()] == [-1.0, -1.0]
    plain = write_text("p.csv", line + "\n")
    assert ex.labeled_points(plain, has_label=False).count() == 1


def test_passenger_file_with_quoted_names(spark, write_text):
    from tabfit.sources.csv import read_csv
    from tabfit.sources.schemas import PASSENGER_FILE
    path = write_text("q.csv", 'id,s,c,n,x,a,b,p,t,f,cb,e\n1,0,3,"Last, Mr. First ""Nick""",male,22,1,0,A/5 21171,7.25,,S\n'
                               'x,0,3,"Last, Mr. Other",male,22,1,0,A/5,7.25,,S\n')
    got = read_csv(spark, path, PASSENGER_FILE, header=True, on_bad="quarantine")
    row = got.good.collect()
    assert len(row) == 1 and row[0]["name"] == 'Last, Mr. First "Nick"' and row[0]["ticket"] == "A/5 21171"
    assert [r["reason"] for r in got.bad.collect()] == ["unparsable value"]


def test_store_rules(spark, write_text):
    from tabfit.sources.csv import read_stores
    path = write_text("s.csv", G2 + '4,"a","b",5,,,0,13,2010,"Jan,Apr,Jul,Oct"\n')
    rows = {r["storeId"]: tuple(r)[6:] for r in read_stores(spark, path).collect()}
    assert rows == {1: (0, -1, -1, ""), 2: (1, 13, 2010, "Jan,Apr,Jul,Oct"), 291: (0, -1, -1, ""),
                    4: (0, -1, -1, "Jan,Apr,Jul,Oct")}


def test_sparse_libsvm_equals_the_dense_one(spark, write_text):
    path = write_text("a.libsvm", "1 3:1 10:1 126:1\n0 3:1 3:5\n1\n0 128:0.5 0:2\n")
    dense = read_libsvm(spark, path, 129, index_base=0).select("label", vector_to_array("features").alias("a"))
    sparse = read_libsvm(spark, path, 129, index_base=0, sparse=True)
    assert {type(r["features"]).__name__ for r in sparse.collect()} == {"SparseVector"}
    assert sorted(sparse.select("label", vector_to_array("features").alias("a")).collect()) == sorted(dense.collect())
    with pytest.raises(Exception, match="libsvm index outside"):
        read_libsvm(spark, write_text("b.txt", "1 3:2 200:5\n"), 129, index_base=0, sparse=True).collect()


def test_one_pass_report(spark, write_text, tmp_path):
    from tabfit.sources.csv import stage_csv
    path = write_text("census_once.csv", G4)
    got = stage_csv(spark, path, CENSUS, line_numbers=True)
    assert got.counts == {"good": 2, "bad": 2}
    two = read_csv(spark, path, CENSUS, on_bad="quarantine", line_numbers=True)
    assert sorted(got.good.collect()) == sorted(two.good.collect())
    assert sorted(map(str, got.bad.collect())) == sorted(map(str, two.bad.collect()))
    # what is read now is the written table, not the text
    assert all("census_once" not in f and f.endswith(".parquet") for f in got.good.inputFiles() + got.bad.inputFiles())
    none = stage_csv(spark, write_text("none.csv", "\n"), CENSUS)
    assert none.counts == {"good": 0, "bad": 0} and none.good.count() == none.bad.count() == 0
