import pytest
from pyspark.sql import functions as F

from tabfit.functions.sentinels import fill_sentinels
from tabfit.plans.frames import SALES_FEATURES, hourly_features, passenger_features, sales_features
from tabfit.sources.csv import read_csv
from tabfit.sources.schemas import HOURLY, HOURLY_NO_LABEL, SALES, STORE, STORE_SENTINELS

from tests.test_sources import G2

G3 = '''"Store","DayOfWeek","Date","Sales","Customers","Open","Promo","StateHoliday","SchoolHoliday"
1,5,2015-07-31,5263,555,1,1,"0","1"
1,4,2015-07-30,5020,546,1,1,"0","1"
2,5,2015-07-31,6064,625,1,1,"0","1"
291,5,2015-07-31,9000,700,1,0,"a","0"
2,7,2015-07-26,0,0,0,0,"0","0"
'''

G1 = """2011-01-01 05:00:00,1,0,0,2,9.84,12.88,75,6.0032,1
2011-07-04 17:00:00,3,1,0,1,33.62,37.88,46,0,301
"""


def _sales_store(spark, write_text):
    sales = read_csv(spark, write_text("sales.csv", G3), SALES, header=True)
    stores = fill_sentinels(read_csv(spark, write_text("store.csv", G2), STORE, header=True),
                            STORE_SENTINELS)
    return sales, stores


def test_sales_frame_g3(spark, write_text):
    sales, stores = _sales_store(spark, write_text)
    fr = sales_features(sales, stores)
    rows = fr.orderBy("storeId", "day").collect()
    assert len(rows) == 4
    got = [(r["storeId"], r["day"], round(r["logSales"], 6), r["transformedCompetitionDistance"], r["label"])
           for r in rows]
    assert got == [(1, 30, 8.521185, 1270.0, 1), (1, 31, 8.568456, 1270.0, 1),
                   (2, 31, 8.710125, 570.0, 1), (291, 31, 9.10498, 777.25, 0)]
    # index order: most frequent first, ties by value
    idx = {r["storeId"]: (r["stateHolidayIndex"], r["schoolHolidayIndex"], r["storeTypeIndex"],
                          r["promoIntervalIndex"]) for r in rows}
    assert idx[1] == (0.0, 0.0, 0.0, 0.0)
    assert idx[2] == (0.0, 0.0, 1.0, 1.0)
    assert idx[291] == (1.0, 1.0, 2.0, 0.0)
    assert len(rows[0]["features"]) == len(SALES_FEATURES)
    dropped = {"sales", "customers", "date", "competitionDistance", "promoInterval"}
    assert not dropped & set(fr.columns)


def test_hourly_frame_g1(spark, write_text):
    path = write_text("hourly.csv", G1)
    fr = hourly_features(read_csv(spark, path, HOURLY))
    rows = fr.orderBy("date").collect()
    assert list(rows[0]["features"]) == pytest.approx(
        [2011, 1, 1, 5, 7, 1, 0, 0, 2, 9.84, 12.88, 75, 6.0032])
    assert [r["label"] for r in rows] == [1.0, 301.0]
    nolab = hourly_features(read_csv(spark, write_text("h2.csv", G1.replace(",1\n", "\n").replace(",301\n", "\n")),
                                     HOURLY_NO_LABEL), has_label=False)
    assert [r["label"] for r in nolab.collect()] == [-1.0, -1.0]


def test_passenger_frame(spark):
    p = spark.createDataFrame(
        [(1, 0, 3.0, "male", 22.0, 1.0, 0.0, 7.25, "", "S"),
         (2, 1, 1.0, "female", 38.0, 1.0, 0.0, 71.28, "C85", "C"),
         (3, 1, 3.0, "female", -1.0, 0.0, 0.0, 7.92, "", "S"),
         (4, 1, -1.0, "", 30.0, 1.0, 0.0, 53.1, "C123", "")],
        "passengerId long, survived int, pClass double, sex string, age double, sibsp double, "
        "parch double, fare double, cabin string, embarked string")
    fr = passenger_features(p).orderBy("passengerId").collect()
    # pClass slots {3,1,-1}, sex {male,female,''}, cabin {'',C85,C123}, embarked {S,C,''} + 4 scaled
    assert len(fr[0]["features"]) == 3 + 3 + 3 + 3 + 4
    assert list(fr[0]["features"])[:12] == [1, 0, 0, 1, 0, 0, 0, 0, 0, 1, 0, 0]
    assert list(fr[3]["features"])[:12] == [0, 0, 0, 0, 0, 0, 0, 0, 1, 0, 0, 0]
    assert fr[2]["ageStd"] == pytest.approx(-4.7458863766424075)


def test_feature_plans_stay_in_jvm(spark):
    import io
    from contextlib import redirect_stdout
    from tabfit.plans import standins as S
    fr = sales_features(S.sales(spark, "/root/testdata/sf0.001"), S.stores(spark, "/root/testdata/sf0.001"))
    buf = io.StringIO()
    with redirect_stdout(buf):
        fr.explain("formatted")
    plan = buf.getvalue()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # the positive-sales filter reaches the orders scan
    assert "PushedFilters" in plan and "GreaterThan(o_totalprice,0.0)" in plan
