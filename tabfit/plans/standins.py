"""Reference-shaped entity frames derived from the driver's tables.

The reference reads five kinds of files (hourly rentals, store sales and store
attributes, passengers, census rows, libsvm vectors).  The catalogue derives
each from the given Parquet tables, in Spark for ``queries()`` and in DuckDB
SQL for ``oracle_sql()``, so both sides start from identical rows:

* sales   <- orders      (storeId = o_custkey, sales = o_totalprice, ...)
* stores  <- customer    (storeId = c_custkey, competitionDistance from c_acctbal, ...)
* census  <- lineitem joined with orders
* passengers <- customer (row order = c_custkey)
* hourly  <- events      (label = the ``k`` value of props)
* vectors <- embeddings  (label 0-9, 64 slots)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The four promotion month lists of the store data.
PROMO_INTERVALS = ["Jan,Apr,Jul,Oct", "Feb,May,Aug,Nov", "Mar,Jun,Sept,Dec"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --------------------------------------------------------------------- sales
def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("rowId"),
        F.col("o_custkey").alias("storeId"),
        F.dayofweek("o_orderdate").alias("daysOfWeek"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.col("o_totalprice").alias("sales"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("customers"),
        F.when(F.col("o_orderstatus") == "P", 0).otherwise(1).alias("open"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1).otherwise(0).alias("promo"),
        F.substring("o_orderpriority", 1, 1).alias("stateHoliday"),
        F.col("o_orderstatus").alias("schoolHoliday"),
    )


SALES_SQL = """
SELECT o_orderkey AS rowId, o_custkey AS storeId,
       CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS daysOfWeek,
       strftime(o_orderdate, '%Y-%m-%d') AS date,
       o_totalprice AS sales,
       CAST(floor(o_totalprice / 1000) AS INTEGER) AS customers,
       CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS open,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS promo,
       substr(o_orderpriority, 1, 1) AS stateHoliday,
       o_orderstatus AS schoolHoliday
FROM orders"""


# -------------------------------------------------------------------- stores
def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    promo2 = (F.col("c_nationkey") % 2).cast("int")
    k3 = F.col("c_nationkey") % 3
    return c.select(
        F.col("c_custkey").alias("storeId"),
        F.col("c_mktsegment").alias("storeType"),
        F.when(k3 == 0, "a").when(k3 == 1, "b").otherwise("c").alias("assortment"),
        F.when(F.col("c_acctbal") < 0, -1).otherwise(F.floor("c_acctbal").cast("int"))
        .alias("competitionDistance"),
        ((F.col("c_nationkey") % 12) + 1).cast("int").alias("competitionOpenSinceMonth"),
        (F.col("c_nationkey") + 2000).cast("int").alias("competitionOpenSinceYear"),
        promo2.alias("promo2"),
        F.when(promo2 == 0, -1).otherwise(F.col("c_nationkey") + 1).cast("int").alias("promo2SinceWeek"),
        F.when(promo2 == 0, -1).otherwise(F.col("c_nationkey") % 5 + 2010).cast("int")
        .alias("promo2SinceYear"),
        F.when(promo2 == 0, "").when(k3 == 0, PROMO_INTERVALS[0]).when(k3 == 1, PROMO_INTERVALS[1])
        .otherwise(PROMO_INTERVALS[2]).alias("promoInterval"),
    )


STORES_SQL = f"""
SELECT c_custkey AS storeId, c_mktsegment AS storeType,
       CASE WHEN c_nationkey % 3 = 0 THEN 'a' WHEN c_nationkey % 3 = 1 THEN 'b' ELSE 'c' END AS assortment,
       CASE WHEN c_acctbal < 0 THEN -1 ELSE CAST(floor(c_acctbal) AS INTEGER) END AS competitionDistance,
       CAST(c_nationkey % 12 + 1 AS INTEGER) AS competitionOpenSinceMonth,
       CAST(c_nationkey + 2000 AS INTEGER) AS competitionOpenSinceYear,
       CAST(c_nationkey % 2 AS INTEGER) AS promo2,
       CAST(CASE WHEN c_nationkey % 2 = 0 THEN -1 ELSE c_nationkey + 1 END AS INTEGER) AS promo2SinceWeek,
       CAST(CASE WHEN c_nationkey % 2 = 0 THEN -1 ELSE c_nationkey % 5 + 2010 END AS INTEGER) AS promo2SinceYear,
       CASE WHEN c_nationkey % 2 = 0 THEN ''
            WHEN c_nationkey % 3 = 0 THEN '{PROMO_INTERVALS[0]}'
            WHEN c_nationkey % 3 = 1 THEN '{PROMO_INTERVALS[1]}'
            ELSE '{PROMO_INTERVALS[2]}' END AS promoInterval
FROM customer"""


# -------------------------------------------------------------------- census
def census(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority",
                                              "o_totalprice")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        F.col("l_orderkey").alias("orderKey"),
        F.col("l_linenumber").alias("lineNumber"),
        F.col("l_quantity").cast("int").alias("age"),
        F.col("l_returnflag").alias("workClass"),
        F.floor("l_extendedprice").cast("int").alias("fnlwgt"),
        F.col("o_orderpriority").alias("education"),
        F.col("l_linenumber").alias("educationNum"),
        F.col("o_orderstatus").alias("maritalStatus"),
        F.year("l_shipdate").cast("string").alias("occupation"),
        F.col("l_linestatus").alias("relationship"),
        F.round(F.col("l_tax") * 100).cast("int").cast("string").alias("race"),
        F.when(F.col("l_partkey") % 2 == 0, "Male").otherwise("Female").alias("sex"),
        F.round(F.col("l_discount") * 100).cast("int").alias("capitalGain"),
        F.round(F.col("l_tax") * 100).cast("int").alias("capitalLoss"),
        F.month("l_shipdate").alias("hoursPerWeek"),
        (F.col("l_suppkey") % 7).cast("string").alias("nativeCountry"),
        F.when(F.col("o_totalprice") > 300000, ">50K").otherwise("<=50K").alias("label"),
    )


CENSUS_SQL = """
SELECT l_orderkey AS orderKey, l_linenumber AS lineNumber,
       CAST(l_quantity AS INTEGER) AS age, l_returnflag AS workClass,
       CAST(floor(l_extendedprice) AS INTEGER) AS fnlwgt, o_orderpriority AS education,
       l_linenumber AS educationNum, o_orderstatus AS maritalStatus,
       CAST(year(l_shipdate) AS VARCHAR) AS occupation, l_linestatus AS relationship,
       CAST(CAST(round(l_tax * 100) AS INTEGER) AS VARCHAR) AS race,
       CASE WHEN l_partkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS sex,
       CAST(round(l_discount * 100) AS INTEGER) AS capitalGain,
       CAST(round(l_tax * 100) AS INTEGER) AS capitalLoss,
       CAST(month(l_shipdate) AS INTEGER) AS hoursPerWeek,
       CAST(l_suppkey % 7 AS VARCHAR) AS nativeCountry,
       CASE WHEN o_totalprice > 300000 THEN '>50K' ELSE '<=50K' END AS label
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


# ---------------------------------------------------------------- passengers
def passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    nk = F.col("c_nationkey")
    seg1 = F.substring("c_mktsegment", 1, 1)
    return c.select(
        F.col("c_custkey").alias("passengerId"),
        F.when(F.col("c_acctbal") > 4500, 1).otherwise(0).alias("survived"),
        F.when(nk == 24, -1.0).otherwise((nk % 3 + 1).cast("double")).alias("pClass"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE"), "male")
        .when(nk == 23, "").otherwise("female").alias("sex"),
        F.when(F.col("c_acctbal") < 0, -1.0).otherwise(F.col("c_acctbal") / 100).alias("age"),
        (nk % 4).cast("double").alias("sibsp"),
        F.when(nk == 22, -1.0).otherwise((nk % 3).cast("double")).alias("parch"),
        F.when(F.col("c_acctbal") < 0, -1.0).otherwise(F.col("c_acctbal") / 10).alias("fare"),
        F.when(nk == 0, "").otherwise(F.concat(seg1, nk.cast("string"))).alias("cabin"),
        F.when(nk == 1, "").otherwise(seg1).alias("embarked"),
    )


PASSENGERS_SQL = """
SELECT c_custkey AS passengerId,
       CASE WHEN c_acctbal > 4500 THEN 1 ELSE 0 END AS survived,
       CASE WHEN c_nationkey = 24 THEN -1.0 ELSE CAST(c_nationkey % 3 + 1 AS DOUBLE) END AS pClass,
       CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 'male'
            WHEN c_nationkey = 23 THEN '' ELSE 'female' END AS sex,
       CASE WHEN c_acctbal < 0 THEN -1.0 ELSE c_acctbal / 100 END AS age,
       CAST(c_nationkey % 4 AS DOUBLE) AS sibsp,
       CASE WHEN c_nationkey = 22 THEN -1.0 ELSE CAST(c_nationkey % 3 AS DOUBLE) END AS parch,
       CASE WHEN c_acctbal < 0 THEN -1.0 ELSE c_acctbal / 10 END AS fare,
       CASE WHEN c_nationkey = 0 THEN '' ELSE substr(c_mktsegment, 1, 1) || CAST(c_nationkey AS VARCHAR) END AS cabin,
       CASE WHEN c_nationkey = 1 THEN '' ELSE substr(c_mktsegment, 1, 1) END AS embarked
FROM customer"""


# -------------------------------------------------------------------- hourly
def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    d = F.dayofmonth("ts")
    dow = F.dayofweek("ts")
    return e.select(
        F.col("event_id").alias("rowId"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date"),
        F.when(d <= 7, 1).when(d <= 14, 2).when(d <= 21, 3).otherwise(4).alias("season"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("holiday"),
        F.when(dow.isin(1, 7), 0).otherwise(1).alias("workingDay"),
        (F.col("user_id") % 4 + 1).cast("int").alias("weather"),
        F.col("value").alias("temp"),
        (F.col("value") * 1.1).alias("atemp"),
        (F.col("user_id") % 100).cast("int").alias("humidity"),
        (F.col("value") / 3).alias("windspeed"),
        F.get_json_object("props", "$.k").cast("int").alias("count"),
    )


HOURLY_SQL = """
SELECT event_id AS rowId, strftime(ts, '%Y-%m-%d %H:%M:%S') AS date,
       CASE WHEN day(ts) <= 7 THEN 1 WHEN day(ts) <= 14 THEN 2 WHEN day(ts) <= 21 THEN 3 ELSE 4 END AS season,
       CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS holiday,
       CASE WHEN dayofweek(ts) IN (0, 6) THEN 0 ELSE 1 END AS workingDay,
       CAST(user_id % 4 + 1 AS INTEGER) AS weather,
       value AS temp, value * 1.1 AS atemp,
       CAST(user_id % 100 AS INTEGER) AS humidity,
       value / 3 AS windspeed,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS count
FROM events"""


# ------------------------------------------------------------------- vectors
def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rowId, label double, x array<double>) from the embeddings table."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("rowId"), F.col("label").cast("double").alias("label"),
                    F.col("embedding").cast("array<double>").alias("x"))
