"""Query catalogue: one Spark plan per operator, with its DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLES[name] -> SQL``.
Outputs are scalar columns with matching aliases on both sides; doubles are
rounded to 4 places and integers cast to bigint so hashes compare.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfit.plans import standins as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def r4(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 4)


def big(c):
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


# shared SQL building blocks
JOINED_SQL = f"""
sales AS ({S.SALES_SQL}),
stores AS ({S.STORES_SQL}),
j AS (SELECT * FROM sales JOIN stores USING (storeId) WHERE sales > 0 AND open > 0)"""


# ===================================================================== filters
@register("filter_positive", f"""
SELECT rowId, storeId, round(sales, 4) AS sales
FROM ({S.SALES_SQL}) s WHERE sales > 0 AND open > 0""")
def q_filter_positive(spark, sf):
    from tabfit.operators.features import keep_positive
    return (keep_positive(S.sales(spark, sf), "sales", "open")
            .select("rowId", "storeId", r4("sales").alias("sales")))


# ======================================================================= joins
@register("join_using", f"""
WITH sales AS ({S.SALES_SQL}), stores AS ({S.STORES_SQL})
SELECT rowId, storeId, round(sales, 4) AS sales, storeType, assortment,
       CAST(competitionDistance AS BIGINT) AS competitionDistance, promoInterval
FROM sales JOIN stores USING (storeId)""")
def q_join_using(spark, sf):
    from tabfit.operators.joins import join_dimension
    j = join_dimension(S.sales(spark, sf), S.stores(spark, sf), "storeId")
    return j.select("rowId", "storeId", r4("sales").alias("sales"), "storeType", "assortment",
                    big("competitionDistance").alias("competitionDistance"), "promoInterval")


# ================================================================ aggregations
@register("agg_mean", f"""
WITH {JOINED_SQL}
SELECT round(avg(competitionDistance), 4) AS meanCompetitionDistance, count(*) AS n FROM j""")
def q_agg_mean(spark, sf):
    from tabfit.plans.frames import sales_joined
    j = sales_joined(S.sales(spark, sf), S.stores(spark, sf))
    return j.agg(r4(F.avg("competitionDistance")).alias("meanCompetitionDistance"),
                 F.count(F.lit(1)).alias("n"))


def _masked_sql(cols, src):
    parts = []
    for c in cols:
        m = f"CASE WHEN {c} <> -1 THEN {c} END"
        parts += [f"round(avg({m}), 3) AS {c}_mean", f"round(stddev_pop({m}), 3) AS {c}_std",
                  f"count({m}) AS {c}_n"]
    return f"SELECT {', '.join(parts)} FROM ({src}) t"


@register("agg_moments_masked", _masked_sql(["age", "sibsp", "parch", "fare"], S.PASSENGERS_SQL))
def q_agg_moments_masked(spark, sf):
    from tabfit.operators.stats import masked_moments
    cols = ["age", "sibsp", "parch", "fare"]
    m = masked_moments(S.passengers(spark, sf), cols, -1.0)
    # 3 places: the fare mean sits on a 4th-place rounding tie at sf0.01
    return m.select(*[F.round(c, 3).alias(c) if not c.endswith("_n") else big(c).alias(c)
                      for c in m.columns])


@register("label_above_mean", f"""
WITH {JOINED_SQL}
SELECT rowId, storeId, round(ln(sales), 4) AS logSales,
       CAST(CASE WHEN ln(sales) > (SELECT avg(ln(sales)) FROM j) THEN 0 ELSE 1 END AS BIGINT) AS label
FROM j""")
def q_label_above_mean(spark, sf):
    from tabfit.operators.features import label_above_mean
    from tabfit.plans.frames import sales_joined
    j = sales_joined(S.sales(spark, sf), S.stores(spark, sf))
    j = j.withColumn("logSales", F.log(F.col("sales")))
    r = label_above_mean(j, "logSales", "label")
    return r.select("rowId", "storeId", r4("logSales").alias("logSales"), big("label").alias("label"))


@register("impute_mean", f"""
WITH {JOINED_SQL}
SELECT rowId, storeId, CAST(competitionDistance AS BIGINT) AS competitionDistance,
       round(CASE WHEN competitionDistance > 0 THEN competitionDistance
                  ELSE (SELECT avg(competitionDistance) FROM j) END, 4) AS transformedCompetitionDistance
FROM j""")
def q_impute_mean(spark, sf):
    from tabfit.operators.features import impute_non_positive
    from tabfit.plans.frames import sales_joined
    j = sales_joined(S.sales(spark, sf), S.stores(spark, sf))
    r = impute_non_positive(j, "competitionDistance", "transformedCompetitionDistance")
    return r.select("rowId", "storeId", big("competitionDistance").alias("competitionDistance"),
                    r4("transformedCompetitionDistance").alias("transformedCompetitionDistance"))


# ============================================================ scalar functions
@register("feat_date_parts", """
SELECT event_id AS rowId, CAST(year(ts) AS BIGINT) AS year, CAST(month(ts) AS BIGINT) AS month,
       CAST(day(ts) AS BIGINT) AS day, CAST(hour(ts) AS BIGINT) AS hour,
       CAST(dayofweek(ts) + 1 AS BIGINT) AS dayOfWeek
FROM events""")
def q_feat_date_parts(spark, sf):
    from tabfit.functions.dates import date_parts
    h = S.hourly(spark, sf)
    p = date_parts("date", "yyyy-MM-dd HH:mm:ss")
    return h.select("rowId", *[big(v).alias(k) for k, v in p.items()])


@register("feat_date_split", """
SELECT o_orderkey AS rowId, CAST(year(o_orderdate) AS BIGINT) AS year,
       CAST(month(o_orderdate) AS BIGINT) AS month, CAST(day(o_orderdate) AS BIGINT) AS day
FROM orders""")
def q_feat_date_split(spark, sf):
    from tabfit.functions.dates import split_date_parts
    s = S.sales(spark, sf)
    return s.select("rowId", *[big(v).alias(k) for k, v in split_date_parts("date").items()])


# ==================================================================== encoders
def _freq_vocab_sql(col: str, src: str) -> str:
    return (f"SELECT {col} AS value, row_number() OVER (ORDER BY count(*) DESC, {col}) - 1 AS idx "
            f"FROM {src} GROUP BY {col}")


@register("enc_string_index", f"""
WITH v AS ({_freq_vocab_sql('p_brand', 'part')})
SELECT p_partkey, p_brand, CAST(idx AS BIGINT) AS brandIndex FROM part JOIN v ON p_brand = v.value""")
def q_enc_string_index(spark, sf):
    from tabfit.operators.encode import FrequencyIndexer
    part = S.table(spark, sf, "part").select("p_partkey", "p_brand")
    m = FrequencyIndexer(["p_brand"], ["brandIndex"]).fit(part)
    return m.transform(part).select("p_partkey", "p_brand", big("brandIndex").alias("brandIndex"))


def _census_index_sql() -> str:
    from tabfit.plans.frames import CENSUS_CATEGORICAL
    ctes = [f"c AS ({S.CENSUS_SQL})"]
    joins, outs = [], []
    for i, col in enumerate(CENSUS_CATEGORICAL):
        ctes.append(f"v{i} AS ({_freq_vocab_sql(col, 'c')})")
        joins.append(f"JOIN v{i} ON c.{col} = v{i}.value")
        outs.append(f"CAST(v{i}.idx AS BIGINT) AS {col}Idx")
    return (f"WITH {', '.join(ctes)}\nSELECT orderKey, lineNumber, {', '.join(outs)}\n"
            f"FROM c {' '.join(joins)}")


@register("enc_string_index_multi", _census_index_sql())
def q_enc_string_index_multi(spark, sf):
    from tabfit.operators.encode import FrequencyIndexer
    from tabfit.plans.frames import CENSUS_CATEGORICAL
    c = S.census(spark, sf)
    outs = [x + "Idx" for x in CENSUS_CATEGORICAL]
    m = FrequencyIndexer(CENSUS_CATEGORICAL, outs).fit(c)
    return m.transform(c).select("orderKey", "lineNumber", *[big(o).alias(o) for o in outs])


def _first_seen_sql(col: str, src: str, order: str = "passengerId") -> str:
    return (f"SELECT CAST({col} AS VARCHAR) AS value, "
            f"row_number() OVER (ORDER BY min({order})) - 1 AS idx FROM {src} GROUP BY {col}")


@register("enc_vocab_first_seen", "WITH p AS (" + S.PASSENGERS_SQL + ")\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, value, CAST(idx AS BIGINT) AS index FROM ({_first_seen_sql(c, 'p')})"
    for c in ["pClass", "sex", "cabin", "embarked"]))
def q_enc_vocab_first_seen(spark, sf):
    from tabfit.operators.encode import FirstSeenVocab
    p = S.passengers(spark, sf)
    m = FirstSeenVocab(["pClass", "sex", "cabin", "embarked"], "passengerId").fit(p)
    return m.vocab.select(F.col("column").alias("feature"), "value", big("index").alias("index"))


_EMPTY_SQL = {"pClass": "pClass = -1", "sex": "sex = ''", "cabin": "cabin = ''",
              "embarked": "embarked = ''"}


def _onehot_sql(extra_select: str = "") -> str:
    cols = ["pClass", "sex", "cabin", "embarked"]
    ctes = ["p AS (" + S.PASSENGERS_SQL + ")"]
    ctes += [f"v_{c} AS ({_first_seen_sql(c, 'p')})" for c in cols]
    hot = [f"CAST(CASE WHEN {_EMPTY_SQL[c]} THEN -1 ELSE v_{c}.idx END AS BIGINT) AS {c}Hot"
           for c in cols]
    width = " + ".join(f"(SELECT count(*) FROM v_{c})" for c in cols)
    joins = " ".join(f"JOIN v_{c} ON CAST(p.{c} AS VARCHAR) = v_{c}.value" for c in cols)
    return (f"WITH {', '.join(ctes)}\nSELECT passengerId, {', '.join(hot)}, "
            f"CAST({width} AS BIGINT) AS width{extra_select}\nFROM p {joins}")


def _hot_position(c):
    # 0-based slot holding the 1, or -1 for an all-zero (empty) encoding
    return (F.array_position(F.col(c), 1.0) - 1).cast("bigint")


@register("enc_onehot", _onehot_sql())
def q_enc_onehot(spark, sf):
    from tabfit.operators.encode import OneHot
    cols = ["pClass", "sex", "cabin", "embarked"]
    p = S.passengers(spark, sf)
    m = OneHot(cols, "passengerId",
               empty_values={"pClass": -1.0, "sex": "", "cabin": "", "embarked": ""}).fit(p)
    r = m.transform(p)
    width = sum(m.width(c) for c in cols)
    return r.select("passengerId", *[_hot_position(c + "Vec").alias(c + "Hot") for c in cols],
                    F.lit(width).cast("bigint").alias("width"))


def _std_sql_exprs(cols):
    out = []
    for c in cols:
        m = f"CASE WHEN {c} <> -1 THEN {c} END"
        out.append(f"round(({c} - (SELECT avg({m}) FROM p)) / (SELECT stddev_pop({m}) FROM p), 4) AS {c}Std")
    return out


@register("feat_standardize", "WITH p AS (" + S.PASSENGERS_SQL + ")\nSELECT passengerId, "
          + ", ".join(_std_sql_exprs(["age", "sibsp", "parch", "fare"])) + " FROM p")
def q_feat_standardize(spark, sf):
    from tabfit.operators.stats import Standardizer
    cols = ["age", "sibsp", "parch", "fare"]
    p = S.passengers(spark, sf)
    r = Standardizer(cols, -1.0).fit(p).transform(p, suffix="Std")
    return r.select("passengerId", *[r4(c + "Std").alias(c + "Std") for c in cols])


@register("feat_standardize_inline", "WITH p AS (" + S.PASSENGERS_SQL + ")\nSELECT passengerId, "
          + ", ".join(_std_sql_exprs(["age", "sibsp", "parch", "fare"])) + " FROM p")
def q_feat_standardize_inline(spark, sf):
    from tabfit.operators.stats import standardize_inline
    cols = ["age", "sibsp", "parch", "fare"]
    r = standardize_inline(S.passengers(spark, sf), cols, -1.0, suffix="Std")
    return r.select("passengerId", *[r4(c + "Std").alias(c + "Std") for c in cols])


# ============================================================== feature frames
@register("feat_drop", f"""
WITH {JOINED_SQL}
SELECT rowId, storeId, CAST(daysOfWeek AS BIGINT) AS daysOfWeek, CAST(open AS BIGINT) AS open,
       CAST(promo AS BIGINT) AS promo, CAST(promo2 AS BIGINT) AS promo2
FROM j""")
def q_feat_drop(spark, sf):
    from tabfit.plans.frames import SALES_DROP, sales_joined
    j = sales_joined(S.sales(spark, sf), S.stores(spark, sf)).drop(*SALES_DROP)
    return j.select(*[big(c).alias(c) for c in j.columns])


def _sales_features_sql() -> str:
    from tabfit.plans.frames import SALES_CATEGORICAL
    ctes = [JOINED_SQL.strip()]
    ctes.append("""f AS (SELECT *, CAST(split_part(date, '-', 1) AS INTEGER) AS year,
        CAST(split_part(date, '-', 2) AS INTEGER) AS month, CAST(split_part(date, '-', 3) AS INTEGER) AS day,
        ln(sales) AS logSales,
        CASE WHEN competitionDistance > 0 THEN competitionDistance
             ELSE (SELECT avg(competitionDistance) FROM j) END AS tcd FROM j)""")
    joins, outs = [], []
    for i, col in enumerate(SALES_CATEGORICAL):
        ctes.append(f"v{i} AS ({_freq_vocab_sql(col, 'f')})")
        joins.append(f"JOIN v{i} ON f.{col} = v{i}.value")
        outs.append(f"CAST(v{i}.idx AS BIGINT) AS {col}Index")
    return (f"WITH {', '.join(ctes)}\nSELECT rowId, storeId, CAST(daysOfWeek AS BIGINT) AS daysOfWeek, "
            "CAST(open AS BIGINT) AS open, CAST(promo AS BIGINT) AS promo, CAST(promo2 AS BIGINT) AS promo2, "
            "CAST(day AS BIGINT) AS day, CAST(month AS BIGINT) AS month, CAST(year AS BIGINT) AS year, "
            "round(logSales, 4) AS logSales, round(tcd, 4) AS transformedCompetitionDistance, "
            f"{', '.join(outs)}, "
            "CAST(CASE WHEN logSales > (SELECT avg(logSales) FROM f) THEN 0 ELSE 1 END AS BIGINT) AS label, "
            "CAST(14 AS BIGINT) AS nFeatures, "
            "round(storeId + daysOfWeek + promo + competitionDistance + promo2 + day + month + year + tcd"
            f" + {' + '.join(f'v{i}.idx' for i in range(len(SALES_CATEGORICAL)))}, 2) AS featureSum\n"
            f"FROM f {' '.join(joins)}")


def _vec_summary(col="features"):
    from pyspark.ml.functions import vector_to_array
    a = vector_to_array(F.col(col))
    return a


@register("feat_sales", _sales_features_sql())
def q_feat_sales(spark, sf):
    from tabfit.plans.frames import SALES_CATEGORICAL, sales_features
    r = sales_features(S.sales(spark, sf), S.stores(spark, sf))
    a = _vec_summary()
    return r.select(
        "rowId", "storeId", *[big(c).alias(c) for c in
                              ["daysOfWeek", "open", "promo", "promo2", "day", "month", "year"]],
        r4("logSales").alias("logSales"),
        r4("transformedCompetitionDistance").alias("transformedCompetitionDistance"),
        *[big(c + "Index").alias(c + "Index") for c in SALES_CATEGORICAL],
        big("label").alias("label"), F.size(a).cast("bigint").alias("nFeatures"),
        F.round(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x), 2).alias("featureSum"))


def _census_features_sql() -> str:
    from tabfit.plans.frames import CENSUS_CATEGORICAL
    base = _census_index_sql()
    head, sel = base.rsplit("\nSELECT ", 1)
    cols, frm = sel.split("\nFROM ", 1)
    feat = ("c.age + v0.idx + c.fnlwgt + v1.idx + c.educationNum + v2.idx + v3.idx + v4.idx + v5.idx"
            " + v6.idx + c.capitalGain + c.capitalLoss + c.hoursPerWeek + v7.idx")
    return (f"{head}\nSELECT {cols}, CAST(c.age AS BIGINT) AS age, CAST(c.fnlwgt AS BIGINT) AS fnlwgt, "
            "CAST(c.educationNum AS BIGINT) AS educationNum, CAST(c.capitalGain AS BIGINT) AS capitalGain, "
            "CAST(c.capitalLoss AS BIGINT) AS capitalLoss, CAST(c.hoursPerWeek AS BIGINT) AS hoursPerWeek, "
            f"CAST(14 AS BIGINT) AS nFeatures, round(CAST({feat} AS DOUBLE), 2) AS featureSum\nFROM {frm}")


@register("feat_census", _census_features_sql())
def q_feat_census(spark, sf):
    from tabfit.plans.frames import CENSUS_CATEGORICAL, census_features
    r = census_features(S.census(spark, sf))
    a = _vec_summary()
    ints = ["age", "fnlwgt", "educationNum", "capitalGain", "capitalLoss", "hoursPerWeek"]
    return r.select("orderKey", "lineNumber", *[big(c + "Idx").alias(c + "Idx") for c in CENSUS_CATEGORICAL],
                    *[big(c).alias(c) for c in ints], F.size(a).cast("bigint").alias("nFeatures"),
                    F.round(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x), 2).alias("featureSum"))


@register("feat_passenger", _onehot_sql(
    ", CAST(survived AS BIGINT) AS label, "
    + ", ".join(_std_sql_exprs(["age", "sibsp", "parch", "fare"]))))
def q_feat_passenger(spark, sf):
    from pyspark.ml.functions import vector_to_array
    from tabfit.plans.frames import PASSENGER_ONEHOT, PASSENGER_SCALED, passenger_features
    r = passenger_features(S.passengers(spark, sf))
    a = vector_to_array(F.col("features"))
    # read the hot slots and the scaled values back out of the assembled vector
    offsets, out, start = {}, [], 0
    widths = {c: F.size(F.col(c + "Vec")) for c in PASSENGER_ONEHOT}
    pos = F.lit(0)
    for c in PASSENGER_ONEHOT:
        seg = F.slice(a, pos + 1, widths[c])
        out.append((F.array_position(seg, 1.0) - 1).cast("bigint").alias(c + "Hot"))
        pos = pos + widths[c]
    width = pos
    for i, c in enumerate(PASSENGER_SCALED):
        out.append(F.round(F.element_at(a, width + 1 + i), 4).alias(c + "Std"))
    return r.select("passengerId", *out, width.cast("bigint").alias("width"),
                    big("label").alias("label"))


_HOURLY_SLOTS_SQL = ["year(ts)", "month(ts)", "day(ts)", "hour(ts)", "dayofweek(ts) + 1", "season",
                     "holiday", "workingDay", "weather", "temp", "atemp", "humidity", "windspeed"]


@register("feat_hourly_vector", f"""
WITH h AS (SELECT *, strptime(date, '%Y-%m-%d %H:%M:%S') AS ts FROM ({S.HOURLY_SQL}))
SELECT rowId, {', '.join(f'round(CAST({e} AS DOUBLE), 4) AS s{i}' for i, e in enumerate(_HOURLY_SLOTS_SQL))},
       CAST(count AS DOUBLE) AS label
FROM h""")
def q_feat_hourly_vector(spark, sf):
    from pyspark.ml.functions import vector_to_array
    from tabfit.plans.frames import hourly_features
    r = hourly_features(S.hourly(spark, sf))
    a = vector_to_array(F.col("features"))
    return r.select("rowId", *[F.round(a[i], 4).alias(f"s{i}") for i in range(13)],
                    F.col("label").cast("double").alias("label"))


# ===================================================================== sources
def _stage(spark, name):
    from tabfit.session import staging_path
    return staging_path(spark, name)


@register("src_csv_roundtrip", f"""
SELECT storeId, CAST(daysOfWeek AS BIGINT) AS daysOfWeek, date, round(sales, 4) AS sales,
       CAST(customers AS BIGINT) AS customers, CAST(open AS BIGINT) AS open,
       CAST(promo AS BIGINT) AS promo, stateHoliday, schoolHoliday
FROM ({S.SALES_SQL}) s""")
def q_src_csv_roundtrip(spark, sf):
    from tabfit.sources.csv import read_csv, write_csv
    from tabfit.sources.schemas import SALES
    path = _stage(spark, "sales-csv")
    write_csv(S.sales(spark, sf).drop("rowId"), path, header=True)
    r = read_csv(spark, path, SALES, header=True, on_bad="fail")
    return r.select("storeId", big("daysOfWeek").alias("daysOfWeek"), "date", r4("sales").alias("sales"),
                    *[big(c).alias(c) for c in ["customers", "open", "promo"]],
                    "stateHoliday", "schoolHoliday")


@register("src_csv_quoted_list", f"""
SELECT storeId, storeType, assortment, CAST(competitionDistance AS BIGINT) AS competitionDistance,
       CAST(competitionOpenSinceMonth AS BIGINT) AS competitionOpenSinceMonth,
       CAST(competitionOpenSinceYear AS BIGINT) AS competitionOpenSinceYear,
       CAST(promo2 AS BIGINT) AS promo2, CAST(promo2SinceWeek AS BIGINT) AS promo2SinceWeek,
       CAST(promo2SinceYear AS BIGINT) AS promo2SinceYear, promoInterval
FROM ({S.STORES_SQL}) s""")
def q_src_csv_quoted_list(spark, sf):
    from tabfit.functions.sentinels import fill_sentinels
    from tabfit.sources.csv import read_csv, write_csv
    from tabfit.sources.schemas import STORE, STORE_SENTINELS
    st = S.stores(spark, sf)
    # sentinels are written as empty fields, as in the store file
    st = st.select(*[F.when(F.col(c) != F.lit(STORE_SENTINELS[c]), F.col(c)).alias(c)
                     if c in STORE_SENTINELS else F.col(c) for c in st.columns])
    path = _stage(spark, "stores-csv")
    write_csv(st, path, header=True)
    r = fill_sentinels(read_csv(spark, path, STORE, header=True), STORE_SENTINELS)
    ints = ["competitionDistance", "competitionOpenSinceMonth", "competitionOpenSinceYear",
            "promo2", "promo2SinceWeek", "promo2SinceYear"]
    return r.select("storeId", "storeType", "assortment", *[big(c).alias(c) for c in ints],
                    "promoInterval")


@register("src_sentinel_fill", f"""
SELECT passengerId, CAST(survived AS BIGINT) AS survived, round(pClass, 4) AS pClass, sex,
       round(age, 4) AS age, round(sibsp, 4) AS sibsp, round(parch, 4) AS parch,
       round(fare, 4) AS fare, cabin, embarked
FROM ({S.PASSENGERS_SQL}) p""")
def q_src_sentinel_fill(spark, sf):
    from tabfit.functions.sentinels import fill_sentinels
    from tabfit.sources.csv import read_csv, write_csv
    from tabfit.sources.schemas import PASSENGER, PASSENGER_SENTINELS
    p = S.passengers(spark, sf)
    p = p.select(*[F.when(F.col(c) != F.lit(PASSENGER_SENTINELS[c]), F.col(c)).alias(c)
                   if c in PASSENGER_SENTINELS else F.col(c) for c in p.columns])
    path = _stage(spark, "passengers-csv")
    write_csv(p, path, header=False)
    r = fill_sentinels(read_csv(spark, path, PASSENGER, header=False), PASSENGER_SENTINELS)
    return r.select("passengerId", big("survived").alias("survived"),
                    *[r4(c).alias(c) if c not in ("sex", "cabin", "embarked") else F.col(c)
                      for c in ["pClass", "sex", "age", "sibsp", "parch", "fare", "cabin", "embarked"]])


@register("src_store_rules", f"""
SELECT storeId, storeType, CAST(promo2 AS BIGINT) AS promo2, CAST(promo2SinceWeek AS BIGINT) AS promo2SinceWeek,
       CAST(promo2SinceYear AS BIGINT) AS promo2SinceYear, promoInterval
FROM ({S.STORES_SQL}) s""")
def q_src_store_rules(spark, sf):
    """A store file that names a start of the second promotion for every store: the reader
    takes it only where promo2 is not 0."""
    from tabfit.sources.csv import read_stores, write_csv
    nation = S.table(spark, sf, "customer").select(F.col("c_custkey").alias("storeId"), "c_nationkey")
    st = S.stores(spark, sf)
    planted = st.join(nation, "storeId").select(*[
        (F.col("c_nationkey") + 1).cast("int").alias(c) if c == "promo2SinceWeek"
        else (F.col("c_nationkey") % 5 + 2010).cast("int").alias(c) if c == "promo2SinceYear"
        else F.col(c) for c in st.columns])
    path = _stage(spark, "stores-planted")
    write_csv(planted, path, header=True)
    r = read_stores(spark, path)
    return r.select("storeId", "storeType", *[big(c).alias(c) for c in ("promo2", "promo2SinceWeek", "promo2SinceYear")],
                    "promoInterval")


_FILE_SENTINELS_SQL = ", ".join(f"round({c}, 4) AS {c}" for c in ("pClass", "age", "sibsp", "parch", "fare"))


@register("src_passenger_file", f"""
SELECT passengerId, CAST(survived AS BIGINT) AS survived, {_FILE_SENTINELS_SQL}, sex, cabin, embarked,
       'Last' || passengerId || ', Mr. First "Nick"' AS name, 'A/5 ' || passengerId * 7 AS ticket
FROM ({S.PASSENGERS_SQL}) p""")
def q_src_passenger_file(spark, sf):
    """The passenger file as handed out: 12 fields, among them a quoted name with a comma
    and quotes, and the ticket; empty fields become sentinels."""
    from tabfit.functions.sentinels import fill_sentinels
    from tabfit.sources.csv import read_csv, write_csv
    from tabfit.sources.schemas import PASSENGER_FILE, PASSENGER_SENTINELS
    p = S.passengers(spark, sf)
    blank = {c: F.when(F.col(c) != F.lit(v), F.col(c)) for c, v in PASSENGER_SENTINELS.items()}
    extra = {"name": F.concat(F.lit("Last"), F.col("passengerId").cast("string"), F.lit(', Mr. First "Nick"')),
             "ticket": F.concat(F.lit("A/5 "), (F.col("passengerId") * 7).cast("string"))}
    cols = {**blank, **extra}
    path = _stage(spark, "passenger-file")
    write_csv(p.select(*[cols.get(f.name, F.col(f.name)).alias(f.name) for f in PASSENGER_FILE.fields]), path, header=True)
    r = fill_sentinels(read_csv(spark, path, PASSENGER_FILE, header=True), PASSENGER_SENTINELS)
    return r.select("passengerId", big("survived").alias("survived"),
                    *[r4(c).alias(c) for c in ("pClass", "age", "sibsp", "parch", "fare")],
                    "sex", "cabin", "embarked", "name", "ticket")


_BAD_KEY_SQL = "substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 1) = '0'"


@register("src_bad_rows", f"""
SELECT CASE WHEN {_BAD_KEY_SQL} THEN 'bad' ELSE 'good' END AS kind, o_orderstatus AS status,
       count(*) AS n
FROM orders GROUP BY 1, 2""")
def q_src_bad_rows(spark, sf):
    from tabfit.sources.csv import read_csv
    from tabfit.sources.schemas import ORDERS_TEXT
    o = S.table(spark, sf, "orders")
    corrupt = F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 1) == "0"
    key = F.when(corrupt, F.concat(F.lit("x"), F.col("o_orderkey").cast("string"))) \
        .otherwise(F.col("o_orderkey").cast("string"))
    # census-style text: a blank after every comma
    line = F.concat_ws(", ", key, F.col("o_custkey").cast("string"), "o_orderstatus",
                       F.col("o_totalprice").cast("string"), "o_orderpriority")
    path = _stage(spark, "orders-text")
    o.select(line.alias("value")).write.text(path)
    res = read_csv(spark, path, ORDERS_TEXT, on_bad="quarantine")
    good = res.good.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("good"))
    bad = res.bad.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("bad"))
    return good.unionByName(bad).select("kind", "status", big("n").alias("n"))


@register("src_bad_row_report", f"""
WITH t AS (SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS month, o_orderkey, o_custkey,
        o_orderstatus, CAST(floor(o_totalprice) AS BIGINT) AS price, o_orderpriority,
        substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 1) AS k FROM orders),
l AS (SELECT month, k, CASE k WHEN '0' THEN 'x' || o_orderkey || ', ' || o_custkey || ', ' || o_orderstatus || ', ' || price
            || ', ' || o_orderpriority
        WHEN '1' THEN o_orderkey || ', ' || o_custkey || ', ' || o_orderstatus END AS raw,
        row_number() OVER (PARTITION BY month ORDER BY o_orderkey) AS line FROM t)
SELECT month, line, raw, CASE k WHEN '0' THEN 'unparsable value' ELSE 'expected 5 fields, found 3' END AS reason
FROM l WHERE k IN ('0', '1')""")
def q_src_bad_row_report(spark, sf):
    """Every bad row of a set of files with its line number, raw text and cause."""
    from tabfit.sources.csv import read_csv
    from tabfit.sources.schemas import ORDERS_TEXT
    o = S.table(spark, sf, "orders")
    k = F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 1)
    key = F.when(k == "0", F.concat(F.lit("x"), F.col("o_orderkey").cast("string"))).otherwise(F.col("o_orderkey").cast("string"))
    head = [key, F.col("o_custkey").cast("string"), F.col("o_orderstatus")]
    tail = [F.floor("o_totalprice").cast("bigint").cast("string"), F.col("o_orderpriority")]
    line = F.when(k == "1", F.concat_ws(", ", *head)).otherwise(F.concat_ws(", ", *head, *tail))
    path = _stage(spark, "orders-months")
    month = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("month")
    # one file a month, in key order
    (o.select(month, "o_orderkey", line.alias("value")).repartition("month").sortWithinPartitions("month", "o_orderkey")
     .select("month", "value").write.partitionBy("month").text(path))
    bad = read_csv(spark, path, ORDERS_TEXT, on_bad="quarantine", line_numbers=True).bad
    return bad.select(F.regexp_extract("file", r"month=(\d+)", 1).cast("bigint").alias("month"),
                      big("line").alias("line"), "raw", "reason")


@register("src_bad_rows_one_pass", """
WITH t AS (SELECT o_orderstatus AS status, substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 1) AS k, o_totalprice AS p FROM orders)
SELECT 'good' AS kind, status, count(*) AS n, CAST(sum(floor(p)) AS BIGINT) AS total FROM t WHERE k NOT IN ('0', '1') GROUP BY status
UNION ALL SELECT 'unparsable value', status, count(*), NULL FROM t WHERE k = '0' GROUP BY status
UNION ALL SELECT 'expected 5 fields, found 3', status, count(*), NULL FROM t WHERE k = '1' GROUP BY status
UNION ALL SELECT 'observed good', NULL, count(*), NULL FROM t WHERE k NOT IN ('0', '1')
UNION ALL SELECT 'observed bad', NULL, count(*), NULL FROM t WHERE k IN ('0', '1')""")
def q_src_bad_rows_one_pass(spark, sf):
    """Good rows, bad rows and both counts from one scan of the text."""
    from tabfit.sources.csv import stage_csv
    from tabfit.sources.schemas import ORDERS_TEXT
    o = S.table(spark, sf, "orders")
    k = F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 1)
    key = F.when(k == "0", F.concat(F.lit("x"), F.col("o_orderkey").cast("string"))).otherwise(F.col("o_orderkey").cast("string"))
    head = [key, F.col("o_custkey").cast("string"), F.col("o_orderstatus")]
    tail = [F.floor("o_totalprice").cast("bigint").cast("string"), F.col("o_orderpriority")]
    path = _stage(spark, "orders-once")
    o.select(F.when(k == "1", F.concat_ws(", ", *head)).otherwise(F.concat_ws(", ", *head, *tail)).alias("value")).write.text(path)
    got = stage_csv(spark, path, ORDERS_TEXT)
    none = F.lit(None).cast("bigint")
    good = got.good.groupBy(F.lit("good").alias("kind"), F.col("o_orderstatus").alias("status")).agg(
        big(F.count(F.lit(1))).alias("n"), big(F.sum("o_totalprice")).alias("total"))
    status = F.trim(F.get(F.split("raw", ","), F.lit(2)))
    bad = got.bad.groupBy(F.col("reason").alias("kind"), status.alias("status")).agg(big(F.count(F.lit(1))).alias("n"), none.alias("total"))
    seen = spark.createDataFrame([(f"observed {k}", None, n, None) for k, n in got.counts.items()],
                                 "kind string, status string, n long, total long")
    return good.unionByName(bad).unionByName(seen)


@register("src_libsvm_roundtrip", """
SELECT 'one' AS reader, CAST(label AS DOUBLE) AS label,
       round(list_sum(CAST(embedding AS DOUBLE[])), 4) AS total,
       round(CAST(embedding[1] AS DOUBLE), 4) AS first, round(CAST(embedding[1] AS DOUBLE), 4) AS lead
FROM embeddings
UNION ALL
SELECT 'raw' AS reader, CAST(label AS DOUBLE) AS label,
       round(list_sum(CAST(embedding AS DOUBLE[])), 4) AS total,
       round(CAST(embedding[1] AS DOUBLE), 4) AS first, 0.0 AS lead
FROM embeddings""")
def q_src_libsvm_roundtrip(spark, sf):
    """Both readers over one libsvm file: 1-based (Spark's reader) and raw
    indices (slot 0 stays empty, values sit one slot later)."""
    from pyspark.ml.functions import vector_to_array
    from tabfit.sources.libsvm import read_libsvm, write_libsvm
    v = S.vectors(spark, sf)
    path = _stage(spark, "vectors-libsvm")
    write_libsvm(v, path, "label", "x", index_base=1)
    a = vector_to_array(F.col("features"))
    total = F.round(F.aggregate(a, F.lit(0.0), lambda s, x: s + x), 4).alias("total")
    one = read_libsvm(spark, path, 64, index_base=1).select(
        F.lit("one").alias("reader"), "label", total, F.round(a[0], 4).alias("first"),
        F.round(a[0], 4).alias("lead"))
    raw = read_libsvm(spark, path, 65, index_base=0).select(
        F.lit("raw").alias("reader"), "label", total, F.round(a[1], 4).alias("first"),
        F.round(a[0], 4).alias("lead"))
    return one.unionByName(raw)


@register("label_optional", f"""
SELECT date, CAST(-1.0 AS DOUBLE) AS label, CAST(count AS DOUBLE) AS labelPresent
FROM ({S.HOURLY_SQL}) h""")
def q_label_optional(spark, sf):
    from tabfit.functions.sentinels import optional_label
    from tabfit.sources.csv import read_csv, write_csv
    from tabfit.sources.schemas import HOURLY
    h = S.hourly(spark, sf).drop("rowId")
    path = _stage(spark, "hourly-csv")
    write_csv(h, path)
    with_label = read_csv(spark, path, HOURLY)
    # the same file read without ground truth: every label is the default
    return with_label.select("date", optional_label("count", has_label=False).alias("label"),
                             optional_label("count", has_label=True).alias("labelPresent"))


@register("labeled_point", f"""
WITH h AS (SELECT *, strptime(date, '%Y-%m-%d %H:%M:%S') AS ts FROM ({S.HOURLY_SQL}))
SELECT CAST(count AS DOUBLE) AS label,
       {', '.join(f'round(CAST({e} AS DOUBLE), 4) AS s{i}' for i, e in enumerate(_HOURLY_SLOTS_SQL))}
FROM h""")
def q_labeled_point(spark, sf):
    from pyspark.ml.functions import vector_to_array
    from tabfit.plans.extractors import HourlyExtractor
    from tabfit.sources.csv import write_csv
    path = _stage(spark, "hourly-lp")
    write_csv(S.hourly(spark, sf).drop("rowId"), path)
    lp = HourlyExtractor(spark).labeled_points(path, has_label=True)
    a = vector_to_array(F.col("features"))
    return lp.select("label", *[F.round(a[i], 4).alias(f"s{i}") for i in range(13)])


# ===================================================================== metrics
@register("metric_rmsle", """
SELECT l_returnflag AS set, 'rmsle' AS metric,
       round(sqrt(avg(pow(ln(1 + greatest(l_extendedprice / 2000 - 5, 0)) - ln(1 + l_quantity), 2))), 4)
         AS value
FROM lineitem GROUP BY l_returnflag""")
def q_metric_rmsle(spark, sf):
    from tabfit.functions.metrics import rmsle
    from tabfit.operators.evaluate import evaluate
    li = S.table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("set"), (F.col("l_extendedprice") / 2000 - 5).alias("prediction"),
        F.col("l_quantity").alias("label"))
    return evaluate(li, rmsle, set_col="set").withColumn("value", r4("value"))


_AUC_SRC = """SELECT o_orderstatus AS status, o_totalprice AS score,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS label FROM orders"""


def _auc_sql(group: bool) -> str:
    g = "status, " if group else ""
    part = "PARTITION BY status " if group else ""
    return f"""
WITH s AS ({_AUC_SRC}),
g AS (SELECT {g}score, sum(label) AS pos, sum(1 - label) AS neg FROM s GROUP BY {g}score),
c AS (SELECT *, coalesce(sum(neg) OVER ({part}ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING
                                        AND 1 PRECEDING), 0) AS nb FROM g)
SELECT {g}round(sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg)), 4) AS auc,
       CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives
FROM c {'GROUP BY status' if group else ''}"""


def _auc_input(spark, sf):
    o = S.table(spark, sf, "orders")
    return o.select(F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("score"),
                    F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1).otherwise(0)
                    .alias("label"))


@register("metric_auc", _auc_sql(False))
def q_metric_auc(spark, sf):
    from tabfit.operators.evaluate import auc
    r = auc(_auc_input(spark, sf), "score", "label")
    return r.select(r4("auc").alias("auc"), big("positives").alias("positives"),
                    big("negatives").alias("negatives"))


@register("metric_auc_grouped", _auc_sql(True))
def q_metric_auc_grouped(spark, sf):
    from tabfit.operators.evaluate import auc
    r = auc(_auc_input(spark, sf), "score", "label", group_cols=["status"])
    return r.select("status", r4("auc").alias("auc"), big("positives").alias("positives"),
                    big("negatives").alias("negatives"))


@register("metric_logloss", """
WITH t AS (SELECT d.lang AS lang, l.quality AS y,
                  1 / (1 + exp(-(ln(d.n_chars) - 7))) AS p
           FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
c AS (SELECT lang, y, greatest(least(p, 1 - 1e-15), 1e-15) AS p FROM t)
SELECT lang AS set, 'logloss' AS metric, round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 4) AS value
FROM c GROUP BY lang""")
def q_metric_logloss(spark, sf):
    from tabfit.functions.metrics import logloss
    from tabfit.operators.evaluate import evaluate
    lab = S.table(spark, sf, "labels")
    doc = S.table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    t = lab.join(doc, "doc_id").select(
        F.col("lang").alias("set"), F.col("quality").alias("label"),
        (F.lit(1.0) / (1 + F.exp(-(F.log(F.col("n_chars").cast("double")) - 7)))).alias("probability"))
    return evaluate(t, logloss, "probability", "label", set_col="set").withColumn("value", r4("value"))


def _mc_sql() -> str:
    # a class's score: the sum of the slots whose number ends in its digit
    es = [" + ".join(f"CAST(embedding[{i + 1}] AS DOUBLE)" for i in range(64) if i % 10 == k) for k in range(10)]
    names = [f"e{i}" for i in range(10)]
    total = " + ".join(f"exp(10 * ({n} - mx))" for n in names)
    return f"""
WITH t0 AS (SELECT label, {', '.join(f'{e} AS e{i}' for i, e in enumerate(es))} FROM embeddings),
t AS (SELECT *, greatest({', '.join(names)}) AS mx, [{', '.join(names)}][label + 1] AS ey FROM t0),
u AS (SELECT label, exp(10 * (ey - mx)) / ({total}) AS py,
             list_position([{', '.join(names)}], mx) - 1 AS pred FROM t)
SELECT 'all' AS set, 'merror' AS metric,
       round(avg(CASE WHEN pred <> label THEN 1.0 ELSE 0.0 END), 4) AS value FROM u
UNION ALL
SELECT 'all' AS set, 'mlogloss' AS metric,
       round(avg(-ln(greatest(least(py, 1 - 1e-15), 1e-15))), 4) AS value FROM u"""


@register("metric_multiclass", _mc_sql())
def q_metric_multiclass(spark, sf):
    """Multi-class error and log loss of class scores that read all 64 slots."""
    from functools import reduce
    from tabfit.functions.metrics import merror, mlogloss
    from tabfit.operators.evaluate import evaluate
    v = S.vectors(spark, sf)
    e = F.array(*[reduce(lambda a, b: a + b, [F.col("x")[i] for i in range(64) if i % 10 == k]) for k in range(10)])
    v = v.select("label", e.alias("e"))
    mx = F.array_max("e")
    ex = F.transform("e", lambda z: F.exp(10 * (z - mx)))
    total = F.aggregate(ex, F.lit(0.0), lambda a, z: a + z)
    scored = v.select("label", F.transform(ex, lambda z: z / total).alias("probabilities"),
                      (F.array_position("e", mx) - 1).cast("double").alias("prediction"))
    a = evaluate(scored, merror, "prediction", "label", set_name="all")
    b = evaluate(scored, mlogloss, "probabilities", "label", set_name="all")
    return a.unionByName(b).withColumn("value", r4("value"))


@register("leaf_weights", """
WITH t AS (SELECT CAST(floor(o_totalprice / 100000) AS INTEGER) AS leaf,
                  CAST(0.5 AS DOUBLE) - CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END
                    AS g,
                  CAST(0.25 AS DOUBLE) AS h FROM orders),
s AS (SELECT leaf, sum(g) AS G, sum(h) AS H FROM t GROUP BY leaf)
SELECT CAST(leaf AS BIGINT) AS leaf, CAST(0.5 AS DOUBLE) AS lambda, round(G, 4) AS G,
       round(H, 4) AS H, round(-G / (H + 0.5), 4) AS weight FROM s
UNION ALL
SELECT CAST(leaf AS BIGINT) AS leaf, CAST(1.0 AS DOUBLE) AS lambda, round(G, 4) AS G,
       round(H, 4) AS H, round(-G / (H + 1.0), 4) AS weight FROM s""")
def q_leaf_weights(spark, sf):
    from tabfit.operators.boosting import grad_hess, leaf_weights
    o = S.table(spark, sf, "orders")
    y = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1).otherwise(0)
    g, h = grad_hess("binary:logistic", F.array(F.lit(0.0)), y)
    t = o.select(F.floor(F.col("o_totalprice") / 100000).cast("int").alias("leaf"),
                 g[0].alias("g"), h[0].alias("h"))
    out = None
    for lam in (0.5, 1.0):
        w = leaf_weights(t, "leaf", "g", "h", lam).select(
            big("leaf").alias("leaf"), F.lit(lam).alias("lambda"), r4("G").alias("G"),
            r4("H").alias("H"), r4("weight").alias("weight"))
        out = w if out is None else out.unionByName(w)
    return out


# ================================================= training, tuning, scoring
def _sales_frame(spark, sf):
    from tabfit.plans.frames import sales_features
    return sales_features(S.sales(spark, sf), S.stores(spark, sf))


_BINNED = ["season", "holiday", "workingDay", "weather", "rareDay", "mostlyMissing"]
_BINNED_SQL = f"""h AS (SELECT CAST(season AS DOUBLE) AS season, CAST(holiday AS DOUBLE) AS holiday,
    CAST(workingDay AS DOUBLE) AS workingDay, CAST(weather AS DOUBLE) AS weather,
    CASE WHEN rowId % 100 = 7 THEN 1.0 ELSE 0.0 END AS rareDay,
    CASE WHEN rowId % 20 = 0 THEN CAST(humidity % 10 AS DOUBLE) END AS mostlyMissing FROM ({S.HOURLY_SQL}))"""


@register("bin_edges", "WITH " + _BINNED_SQL + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, {c} AS edge FROM h WHERE {c} > (SELECT min({c}) FROM h) GROUP BY {c}"
    for c in _BINNED))
def q_bin_edges(spark, sf):
    """Edges of features with few values: every value but the least, also one on
    1 % of the rows, and whatever share is missing."""
    from tabfit.operators.boosting import BoostParams, BoostTrainer
    h = S.hourly(spark, sf).select(
        *[F.col(c).cast("double").alias(c) for c in _BINNED[:4]],
        F.when(F.col("rowId") % 100 == 7, 1.0).otherwise(0.0).alias("rareDay"),
        F.when(F.col("rowId") % 20 == 0, (F.col("humidity") % 10).cast("double")).alias("mostlyMissing"))
    edges = BoostTrainer(BoostParams(), feature_cols=_BINNED).bin_edges(h)
    return spark.createDataFrame([(c, v) for c, e in zip(_BINNED, edges) for v in e],
                                 "feature string, edge double")


_TREE_DEPTH, _TREE_ETA, _TREE_LAMBDA, _TREE_BASE = 3, 0.3, 1.0, 50.0


def _tree_sql() -> str:
    """One regression tree in SQL, level by level: histogram, gain of every cut with the
    missing values on either side, best split, routing; then the nodes ``nodes`` and
    the leaf of every row (``rows``)."""
    n = len(_BINNED)
    parts = [_BINNED_SQL.replace("SELECT CAST(season", f"SELECT rowId, {_TREE_BASE} - CAST(count AS DOUBLE) AS g, CAST(season", 1),
             "u AS (" + " UNION ALL ".join(f"SELECT rowId, {i} AS f, {c} AS v FROM h" for i, c in enumerate(_BINNED)) + ")",
             "edges AS (SELECT DISTINCT f, v AS cut FROM u WHERE v > (SELECT min(v) FROM u AS l WHERE l.f = u.f) "
             f"UNION ALL SELECT f, CAST('Infinity' AS DOUBLE) FROM range({n}) t(f))",
             "r0 AS (SELECT rowId, g, 0 AS node FROM h)"]
    for d in range(_TREE_DEPTH):
        open_ = f"SELECT * FROM r{d}" + (f" WHERE node >= {2 ** d - 1}" if d else "")
        parts += [
            f"o{d} AS ({open_})",
            f"t{d} AS (SELECT node, sum(g) AS gt, count(*) AS nt FROM o{d} GROUP BY node)",
            f"k{d} AS (SELECT node, f, v, sum(g) AS g, count(*) AS n FROM o{d} JOIN u USING (rowId) GROUP BY ALL)",
            f"c{d} AS (SELECT k.node, f, cut, dl, coalesce(sum(g) FILTER (WHERE v < cut OR v IS NULL AND dl), 0) AS gl, "
            "coalesce(sum(n) FILTER (WHERE v < cut OR v IS NULL AND dl), 0) AS nl, "
            f"coalesce(sum(n) FILTER (WHERE v IS NULL), 0) AS nm FROM k{d} k JOIN edges USING (f), "
            "(VALUES (false), (true)) AS s(dl) GROUP BY ALL)",
            f"g{d} AS (SELECT *, gl * gl / (nl + {_TREE_LAMBDA}) + (gt - gl) * (gt - gl) / (nt - nl + {_TREE_LAMBDA}) "
            f"- gt * gt / (nt + {_TREE_LAMBDA}) AS gain FROM c{d} JOIN t{d} USING (node) "
            "WHERE nl >= 1 AND nt - nl >= 1 AND (nm > 0 OR NOT dl))",
            f"b{d} AS (SELECT * FROM g{d} WHERE gain > 1e-6 QUALIFY row_number() OVER (PARTITION BY node "
            "ORDER BY CAST(printf('%.10e', gain) AS DOUBLE) DESC, f, cut, dl) = 1)",
            f"r{d + 1} AS (SELECT r.rowId, r.g, CASE WHEN b.node IS NULL THEN r.node WHEN u.v < b.cut OR u.v IS NULL AND b.dl "
            f"THEN 2 * r.node + 1 ELSE 2 * r.node + 2 END AS node FROM r{d} r LEFT JOIN b{d} b ON r.node = b.node "
            "LEFT JOIN u ON u.rowId = r.rowId AND u.f = b.f)"]
    last = f"r{_TREE_DEPTH}"
    splits = " UNION ALL ".join(f"SELECT node, f, cut, dl, gain, nt FROM b{d}" for d in range(_TREE_DEPTH))
    parts += [f"leaves AS (SELECT node, -{_TREE_ETA} * sum(g) / (count(*) + {_TREE_LAMBDA}) AS w, count(*) AS n FROM {last} GROUP BY node)",
              f"nodes AS (SELECT node, false AS is_leaf, f AS feature, cut, dl, CAST(NULL AS DOUBLE) AS w, gain, nt AS n FROM ({splits}) "
              "UNION ALL SELECT node, true, NULL, NULL, NULL, w, NULL, n FROM leaves)",
              f"scored AS (SELECT rowId, {_TREE_BASE} + w AS prediction FROM {last} JOIN leaves USING (node))"]
    return "WITH " + ",\n".join(parts)


def _one_tree(spark, sf):
    from tabfit.operators.boosting import BoostParams, BoostTrainer
    h = S.hourly(spark, sf).select(
        "rowId", F.col("count").cast("double").alias("label"),
        *[F.col(c).cast("double").alias(c) for c in _BINNED[:4]],
        F.when(F.col("rowId") % 100 == 7, 1.0).otherwise(0.0).alias("rareDay"),
        F.when(F.col("rowId") % 20 == 0, (F.col("humidity") % 10).cast("double")).alias("mostlyMissing"))
    p = BoostParams(objective="reg:squarederror", num_round=1, eta=_TREE_ETA, base_score=_TREE_BASE, reg_lambda=_TREE_LAMBDA, max_depth=_TREE_DEPTH)
    return BoostTrainer(p, feature_cols=_BINNED).fit(h), h


@register("tree_nodes", _tree_sql() + """
SELECT CAST(node AS BIGINT) AS node, is_leaf, CAST(feature AS BIGINT) AS feature, CASE WHEN isinf(cut) THEN 1e300 ELSE cut END AS threshold,
       dl AS default_left, round(w, 4) AS leaf_value, round(gain, 2) AS gain, CAST(n AS BIGINT) AS cover FROM nodes""")
def q_tree_nodes(spark, sf):
    """The nodes of one tree on features with few values, one of them mostly missing."""
    model, _ = _one_tree(spark, sf)
    t = model.nodes(spark)
    return t.select(big("node").alias("node"), "is_leaf", big("feature").alias("feature"),
                    F.when(F.col("threshold") == float("inf"), 1e300).otherwise(F.col("threshold")).alias("threshold"),
                    "default_left", r4("leaf_value").alias("leaf_value"), F.round("gain", 2).alias("gain"),
                    big("cover").alias("cover"))


@register("tree_scored", _tree_sql() + "\nSELECT rowId, round(prediction, 4) AS prediction FROM scored")
def q_tree_scored(spark, sf):
    """The rows scored by that tree, saved and loaded again."""
    from tabfit.operators.boosting import BoostModel
    model, h = _one_tree(spark, sf)
    path = _stage(spark, "one-tree")
    model.save(spark, path)
    return BoostModel.load(spark, path).transform(h).select("rowId", r4("prediction").alias("prediction"))


def _train_binary(spark, sf):
    from tabfit.operators.boosting import BoostParams, BoostTrainer
    from tabfit.operators.tuning import hash_split
    fr = _sales_frame(spark, sf)
    train, test = hash_split(fr, "rowId", 0.8)
    p = BoostParams(objective="binary:logistic", num_round=20, eta=0.3, max_depth=6,
                    subsample=0.8, seed=7)
    model = BoostTrainer(p, features_col="features", label_col="label", id_col="rowId").fit(train)
    return model, fr, test


def flagship(spark, sf):
    model, fr, test = _train_binary(spark, sf)
    return model.transform(test).select("rowId", "storeId", big("label").alias("label"),
                                        "margin", "probability", "prediction")


@register("train_binary")
def q_train_binary(spark, sf):
    return flagship(spark, sf)


@register("train_regression")
def q_train_regression(spark, sf):
    from tabfit.operators.boosting import BoostParams, BoostTrainer
    from tabfit.operators.tuning import hash_split
    from tabfit.plans.frames import hourly_features
    fr = hourly_features(S.hourly(spark, sf))
    train, test = hash_split(fr, "rowId", 0.8)
    p = BoostParams(objective="reg:squarederror", num_round=100, eta=0.1, max_depth=6, subsample=0.8)
    model = BoostTrainer(p, metric="rmsle", id_col="rowId").fit(train)
    return model.transform(test).select("rowId", "label", "prediction")


@register("metric_rmsle_model")
def q_metric_rmsle_model(spark, sf):
    """A trained regression model evaluated on a named set with RMSLE."""
    from tabfit.functions.metrics import rmsle
    from tabfit.operators.boosting import BoostParams, BoostTrainer
    from tabfit.operators.evaluate import evaluate
    from tabfit.operators.tuning import hash_split
    from tabfit.plans.frames import hourly_features
    fr = hourly_features(S.hourly(spark, sf))
    train, test = hash_split(fr, "rowId", 0.8)
    p = BoostParams(objective="reg:squarederror", num_round=100, eta=0.1, max_depth=6, subsample=0.8)
    model = BoostTrainer(p, id_col="rowId").fit(train)
    return evaluate(model.transform(test), rmsle, "prediction", "label", set_name="test")


@register("train_margin")
def q_train_margin(spark, sf):
    from tabfit.operators.boosting import BoostParams, BoostTrainer
    from tabfit.plans.frames import passenger_features
    fr = passenger_features(S.passengers(spark, sf))
    p = BoostParams(objective="binary:logitraw", num_round=20, eta=0.1, max_depth=6)
    model = BoostTrainer(p).fit(fr)
    return model.transform(fr).select("passengerId", "label", "margin")


@register("train_softprob")
def q_train_softprob(spark, sf):
    from tabfit.operators.boosting import BoostParams, BoostTrainer
    v = S.vectors(spark, sf)
    p = BoostParams(objective="multi:softprob", num_class=10, num_round=10, eta=0.3, max_depth=3)
    model = BoostTrainer(p, features_col="x", label_col="label").fit(v)
    s = model.transform(v)
    return s.select("rowId", "label", "prediction",
                    F.array_max("probabilities").alias("probability"))


@register("train_watch")
def q_train_watch(spark, sf):
    from tabfit.operators.boosting import BoostParams, BoostTrainer
    from tabfit.operators.tuning import hash_split
    from tabfit.plans.frames import census_features
    fr = census_features(S.census(spark, sf)).withColumn("key", F.concat_ws("-", "orderKey", "lineNumber"))
    train, test = hash_split(fr, "key", 0.8)
    p = BoostParams(objective="binary:logistic", num_round=100, eta=0.3, max_depth=6)
    model = BoostTrainer(p, label_col="labelIdx").fit(train, watches={"test": test})
    return model.history_frame(spark)


@register("tune_tvs")
def q_tune_tvs(spark, sf):
    from tabfit.operators.boosting import BoostParams
    from tabfit.operators.tuning import TrainValidationSplit, param_grid
    fr = _sales_frame(spark, sf)
    grid = param_grid(num_round=[20, 50], eta=[0.1, 0.4])
    base = BoostParams(objective="binary:logistic", max_depth=6, subsample=0.8)
    res = TrainValidationSplit(base, grid, key_col="rowId", train_ratio=0.8).fit(fr)
    return res.results(spark).withColumn("validation_auc", F.round("validation_auc", 6))


@register("score_preview")
def q_score_preview(spark, sf):
    model, fr, test = _train_binary(spark, sf)
    # a preview is the feature here: the first 20 scored rows by key
    return (model.transform(fr).orderBy("rowId").limit(20)
            .select("rowId", "storeId", big("label").alias("label"), "probability", "prediction"))


@register("score_saved_model")
def q_score_saved_model(spark, sf):
    from tabfit.operators.boosting import BoostModel
    model, fr, test = _train_binary(spark, sf)
    path = _stage(spark, "model")
    model.save(spark, path)
    loaded = BoostModel.load(spark, path)
    return loaded.transform(fr).select("rowId", "probability", "prediction")


@register("score_tree_limit")
def q_score_tree_limit(spark, sf):
    model, fr, test = _train_binary(spark, sf)
    first = model.transform(fr, tree_limit=1).select("rowId", F.col("margin").alias("margin1"))
    full = model.transform(fr, tree_limit=1000).select("rowId", F.col("margin").alias("marginAll"))
    return first.join(full, "rowId")


@register("model_dump")
def q_model_dump(spark, sf):
    model, fr, test = _train_binary(spark, sf)
    return model.nodes(spark)


# =================================================================== streaming
@register("score_stream")
def q_score_stream(spark, sf):
    """The sales frame lands as files; a streaming query scores every file
    with the trained model; the scored rows are read back from the sink."""
    from tabfit.streaming.scoring import score_files
    model, fr, test = _train_binary(spark, sf)
    src = _stage(spark, "stream-in")
    fr.select("rowId", "features").repartition(4).write.parquet(src)
    schema = spark.read.parquet(src).schema
    sink, ckpt = _stage(spark, "stream-out"), _stage(spark, "stream-ckpt")
    q = score_files(spark, model, src, schema, sink, ckpt, keep_cols=["rowId"],
                    max_files_per_trigger=1)
    q.awaitTermination()
    return spark.read.parquet(sink).select("rowId", "probability", "prediction")


# ============================================== the reference apps end to end
@register("tune_sales_scored")
def q_tune_sales_scored(spark, sf):
    """Store sales: 2x2 grid (rounds x eta), 0.8 split by key, best model refit
    on all rows and applied to the same frame (as the sales app does)."""
    from tabfit.operators.boosting import BoostParams
    from tabfit.operators.tuning import TrainValidationSplit, param_grid
    fr = _sales_frame(spark, sf)
    base = BoostParams(objective="binary:logistic", max_depth=6, subsample=0.8,
                       eval_metric="logloss")
    res = TrainValidationSplit(base, param_grid(num_round=[20, 50], eta=[0.1, 0.4]),
                               key_col="rowId").fit(fr)
    return res.transform(fr).select("rowId", big("label").alias("label"), "probability",
                                    "prediction")


@register("tune_sales_pipeline")
def q_tune_sales_pipeline(spark, sf):
    """The sales app in Spark's own words: a pipeline of StringIndexer, VectorAssembler and
    Booster under TrainValidationSplit with the 2x2 grid, the best model applied to the
    same frame."""
    from pyspark.ml import Pipeline
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
    from tabfit.functions.dates import split_date_parts
    from tabfit.ml import Booster
    from tabfit.operators.features import impute_non_positive, label_above_mean
    from tabfit.plans.frames import SALES_CATEGORICAL, SALES_FEATURES, sales_joined
    ds = sales_joined(S.sales(spark, sf), S.stores(spark, sf)).withColumns(split_date_parts("date"))
    ds = ds.withColumn("logSales", F.log(F.col("sales").cast("double")))
    ds = impute_non_positive(ds, "competitionDistance", "transformedCompetitionDistance")
    ds = label_above_mean(ds, "logSales", "label")
    index = StringIndexer(inputCols=SALES_CATEGORICAL, outputCols=[c + "Index" for c in SALES_CATEGORICAL])
    frame = Pipeline(stages=[index, VectorAssembler(inputCols=SALES_FEATURES, outputCol="features")]).fit(ds).transform(ds)
    booster = Booster(objective="binary:logistic", maxDepth=6, subsample=0.8, idCol="rowId")
    grid = ParamGridBuilder().addGrid(booster.numRound, [20, 50]).addGrid(booster.eta, [0.1, 0.4]).build()
    tuned = TrainValidationSplit(estimator=booster, estimatorParamMaps=grid, trainRatio=0.8, seed=1, evaluator=
                                 BinaryClassificationEvaluator(rawPredictionCol="probabilities", labelCol="label")).fit(frame)
    return tuned.transform(frame).select("rowId", big("label").alias("label"), "probability", "prediction")


@register("tune_census_lambda")
def q_tune_census_lambda(spark, sf):
    """Census rows: eta {0.1, 0.6} x lambda {0.5, 1}, label = indexed income class."""
    from tabfit.operators.boosting import BoostParams
    from tabfit.operators.tuning import TrainValidationSplit, param_grid
    from tabfit.plans.frames import census_features
    fr = census_features(S.census(spark, sf)).withColumn(
        "key", F.concat_ws("-", "orderKey", "lineNumber"))
    base = BoostParams(objective="binary:logistic", num_round=100, max_depth=6)
    res = TrainValidationSplit(base, param_grid(eta=[0.1, 0.6], reg_lambda=[0.5, 1.0]),
                               key_col="key", label_col="labelIdx").fit(fr)
    return res.results(spark).withColumn("validation_auc", F.round("validation_auc", 6))


@register("tune_passenger_margin")
def q_tune_passenger_margin(spark, sf):
    """Passengers: raw-margin objective, rounds x eta grid, 0.8 split."""
    from tabfit.operators.boosting import BoostParams
    from tabfit.operators.tuning import TrainValidationSplit, param_grid
    from tabfit.plans.frames import passenger_features
    fr = passenger_features(S.passengers(spark, sf))
    base = BoostParams(objective="binary:logitraw", max_depth=6)
    res = TrainValidationSplit(base, param_grid(num_round=[20, 50], eta=[0.1, 0.4]),
                               key_col="passengerId").fit(fr)
    return res.results(spark).withColumn("validation_auc", F.round("validation_auc", 6))


@register("train_libsvm_scored")
def q_train_libsvm_scored(spark, sf):
    """libsvm rows read with their indices as written, 5 rounds at eta 1 and
    depth 6, test rows scored; the first 2000 by label and score are shown."""
    from tabfit.operators.boosting import BoostParams, BoostTrainer
    from tabfit.plans.extractors import LibsvmExtractor
    from tabfit.sources.libsvm import libsvm_line
    v = S.vectors(spark, sf)
    # a binary label for the vectors: class 5 and above
    lines = v.select(F.col("rowId"), libsvm_line(F.when(F.col("label") >= 5, 1.0).otherwise(0.0),
                                                 F.col("x"), index_base=1).alias("value"))
    train_path, test_path = _stage(spark, "libsvm-train"), _stage(spark, "libsvm-test")
    from tabfit.operators.tuning import in_train
    split = in_train("rowId", 0.8)
    lines.where(split).select("value").write.text(train_path)
    lines.where(~split).select("value").write.text(test_path)
    reader = LibsvmExtractor(spark, width=65, index_base=0, sparse=True)
    train, test = reader.labeled_points(train_path), reader.labeled_points(test_path)
    # what a line leaves out is missing, not 0
    model = BoostTrainer(BoostParams(objective="binary:logistic", num_round=5, eta=1.0,
                                     max_depth=6, missing=0.0)).fit(train)
    scored = model.transform(test)
    # a preview of up to 2000 scored rows is the feature here; in equal scores the entries decide
    return (scored.orderBy("label", "probability", F.unwrap_udt("features")).limit(2000)
            .select("label", "probability", "prediction"))


@register("train_watch_multiclass")
def q_train_watch_multiclass(spark, sf):
    """10-class softprob, depth 3, eta 0.3, with a caller-named metric on the
    training set after every round."""
    from tabfit.operators.boosting import BoostParams, BoostTrainer
    v = S.vectors(spark, sf)
    p = BoostParams(objective="multi:softprob", num_class=10, num_round=10, eta=0.3, max_depth=3)
    model = BoostTrainer(p, features_col="x", metric="merror").fit(v, watches={"train": v})
    return model.history_frame(spark)


@register("train_watch_rmsle")
def q_train_watch_rmsle(spark, sf):
    """Hourly regression (eta 0.1, depth 6, subsample 0.8) with the custom
    RMSLE metric on the test set after every round."""
    from tabfit.operators.boosting import BoostParams, BoostTrainer
    from tabfit.operators.tuning import hash_split
    from tabfit.plans.frames import hourly_features
    fr = hourly_features(S.hourly(spark, sf))
    train, test = hash_split(fr, "rowId", 0.8)
    p = BoostParams(objective="reg:squarederror", num_round=100, eta=0.1, max_depth=6, subsample=0.8)
    model = BoostTrainer(p, metric="rmsle", id_col="rowId").fit(train, watches={"test": test})
    return model.history_frame(spark)


@register("tune_libsvm_depth")
def q_tune_libsvm_depth(spark, sf):
    """libsvm rows: eta {0.2, 0.6} x depth {5, 6}, 2 rounds, split ratio 0.9."""
    from tabfit.operators.boosting import BoostParams
    from tabfit.operators.tuning import TrainValidationSplit, param_grid
    v = S.vectors(spark, sf).withColumn("label", F.when(F.col("label") >= 5, 1.0).otherwise(0.0))
    base = BoostParams(objective="binary:logistic", num_round=2)
    res = TrainValidationSplit(base, param_grid(eta=[0.2, 0.6], max_depth=[5, 6]), key_col="rowId",
                               train_ratio=0.9, features_col="x").fit(v)
    return res.results(spark).withColumn("validation_auc", F.round("validation_auc", 6))


def _holdout_sql() -> str:
    cols = ["pClass", "sex", "cabin", "embarked"]
    split = "substr(md5(CAST(passengerId AS VARCHAR)), 1, 8) < 'cccccccd'"
    ctes = ["p AS (" + S.PASSENGERS_SQL + ")", f"tr AS (SELECT * FROM p WHERE {split})",
            f"te AS (SELECT * FROM p WHERE NOT ({split}))"]
    ctes += [f"v_{c} AS ({_first_seen_sql(c, 'tr')})" for c in cols]
    hot = [f"CAST(CASE WHEN {_EMPTY_SQL[c]} OR v_{c}.idx IS NULL THEN -1 ELSE v_{c}.idx END AS BIGINT)"
           f" AS {c}Hot" for c in cols]
    std = []
    for c in ["age", "sibsp", "parch", "fare"]:
        m = f"CASE WHEN {c} <> -1 THEN {c} END"
        std.append(f"round((te.{c} - (SELECT avg({m}) FROM tr)) / (SELECT stddev_pop({m}) FROM tr), 4) AS {c}Std")
    joins = " ".join(f"LEFT JOIN v_{c} ON CAST(te.{c} AS VARCHAR) = v_{c}.value" for c in cols)
    return (f"WITH {', '.join(ctes)}\nSELECT passengerId, {', '.join(hot)}, {', '.join(std)}\n"
            f"FROM te {joins}")


@register("feat_passenger_holdout", _holdout_sql())
def q_feat_passenger_holdout(spark, sf):
    """Vocabularies and moments fitted on the train part only, applied to the
    held-out part: unseen categories encode as all zeros."""
    from tabfit.operators.tuning import hash_split
    from tabfit.plans.frames import PASSENGER_ONEHOT, PASSENGER_SCALED, fit_passenger_encoder
    p = S.passengers(spark, sf)
    train, test = hash_split(p, "passengerId", 0.8)
    enc = fit_passenger_encoder(train)
    r = enc.transform(test, with_vector=False)
    return r.select("passengerId", *[_hot_position(c + "Vec").alias(c + "Hot") for c in PASSENGER_ONEHOT],
                    *[r4(c + "Std").alias(c + "Std") for c in PASSENGER_SCALED])
