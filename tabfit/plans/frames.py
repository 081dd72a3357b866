"""The reference's four feature frames, re-expressed as DataFrame plans.

Each function takes reference-shaped input frames (see ``standins``) and
returns a DataFrame with a ``features`` vector and a ``label``; the scalar
columns stay alongside so they can be checked one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabfit.functions.dates import date_parts, split_date_parts
from tabfit.functions.sentinels import optional_label
from tabfit.operators.encode import FrequencyIndexer, OneHot
from tabfit.operators.features import (assemble, impute_non_positive, keep_positive,
                                       label_above_mean)
from tabfit.operators.joins import join_dimension
from tabfit.operators.stats import Standardizer, means_of

# Feature order of the sales frame.
SALES_FEATURES = ["storeId", "daysOfWeek", "promo", "competitionDistance", "promo2", "day",
                  "month", "year", "transformedCompetitionDistance", "stateHolidayIndex",
                  "schoolHolidayIndex", "storeTypeIndex", "assortmentIndex", "promoIntervalIndex"]
SALES_CATEGORICAL = ["stateHoliday", "schoolHoliday", "storeType", "assortment", "promoInterval"]
# Columns the sales frame drops after assembly (promoInterval is listed twice).
SALES_DROP = ["stateHoliday", "schoolHoliday", "storeType", "assortment", "promoInterval", "sales",
              "promo2SinceWeek", "customers", "promoInterval", "competitionOpenSinceYear",
              "competitionOpenSinceMonth", "promo2SinceYear", "competitionDistance", "date"]

# Census categorical columns (label included) and feature order.
CENSUS_CATEGORICAL = ["workClass", "education", "maritalStatus", "occupation", "relationship",
                      "race", "sex", "nativeCountry", "label"]
CENSUS_FEATURES = ["age", "workClassIdx", "fnlwgt", "educationIdx", "educationNum",
                   "maritalStatusIdx", "occupationIdx", "relationshipIdx", "raceIdx", "sexIdx",
                   "capitalGain", "capitalLoss", "hoursPerWeek", "nativeCountryIdx"]

# Passenger one-hot columns, standardised columns, and the sentinel.
PASSENGER_ONEHOT = ["pClass", "sex", "cabin", "embarked"]
PASSENGER_SCALED = ["age", "sibsp", "parch", "fare"]
PASSENGER_SENTINEL = -1.0

# The 13 slots of the hourly vector, in order.
HOURLY_SLOTS = ["year", "month", "day", "hour", "dayOfWeek", "season", "holiday", "workingDay",
                "weather", "temp", "atemp", "humidity", "windspeed"]


# --------------------------------------------------------------------- sales
def sales_joined(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Sales joined to store attributes on storeId (key once), open days with sales."""
    return keep_positive(join_dimension(sales, stores, "storeId"), "sales", "open")


def sales_features(sales: DataFrame, stores: DataFrame, with_vector: bool = True) -> DataFrame:
    ds = sales_joined(sales, stores)
    ds = ds.withColumns(split_date_parts("date"))
    ds = ds.withColumn("logSales", F.log(F.col("sales").cast("double")))
    # both global means (imputation, label threshold) from one scalar subquery
    means = means_of(ds, ["competitionDistance", "logSales"])
    ds = impute_non_positive(ds, "competitionDistance", "transformedCompetitionDistance",
                             mean=means["competitionDistance"])
    # one multi-column fit (one aggregation) instead of one job per column
    idx = FrequencyIndexer(SALES_CATEGORICAL).fit(ds)
    r = idx.transform(ds)
    if with_vector:
        r = assemble(r, SALES_FEATURES)
    r = r.drop(*SALES_DROP)
    # same rows as ds (the indexers keep every row), so the mean taken there holds
    return label_above_mean(r, "logSales", "label", mean=means["logSales"])


# -------------------------------------------------------------------- census
def census_features(census: DataFrame, with_vector: bool = True,
                    include_label_in_features: bool = False) -> DataFrame:
    out_cols = [c + "Idx" for c in CENSUS_CATEGORICAL]
    idx = FrequencyIndexer(CENSUS_CATEGORICAL, out_cols).fit(census)
    r = idx.transform(census)
    if with_vector:
        cols = CENSUS_FEATURES + (["labelIdx"] if include_label_in_features else [])
        r = assemble(r, cols, label_col="labelIdx", allow_label=include_label_in_features)
    return r.drop(*CENSUS_CATEGORICAL)


# ---------------------------------------------------------------- passengers
@dataclass
class PassengerEncoder:
    """Fitted once (vocabularies + masked moments), applied to any passenger frame."""
    onehot: object
    scaler: object

    def transform(self, df: DataFrame, with_vector: bool = True) -> DataFrame:
        r = self.onehot.transform(df, suffix="Vec")
        r = self.scaler.transform(r, suffix="Std")
        r = r.withColumn("label", F.col("survived").cast("double"))
        if with_vector:
            arr = F.concat(*[F.col(c + "Vec") for c in PASSENGER_ONEHOT],
                           F.array(*[F.col(c + "Std") for c in PASSENGER_SCALED]))
            from pyspark.ml.functions import array_to_vector
            r = r.withColumn("features", array_to_vector(arr))
        return r


def fit_passenger_encoder(df: DataFrame, order_col: str = "passengerId") -> PassengerEncoder:
    oh = OneHot(PASSENGER_ONEHOT, order_col,
                empty_values={"pClass": PASSENGER_SENTINEL, "sex": "", "cabin": "", "embarked": ""}
                ).fit(df)
    sc = Standardizer(PASSENGER_SCALED, PASSENGER_SENTINEL).fit(df)
    return PassengerEncoder(oh, sc)


def passenger_features(df: DataFrame, order_col: str = "passengerId",
                       with_vector: bool = True) -> DataFrame:
    return fit_passenger_encoder(df, order_col).transform(df, with_vector)


# -------------------------------------------------------------------- hourly
def hourly_features(df: DataFrame, has_label: bool = True, with_vector: bool = True,
                    label_col: str = "count") -> DataFrame:
    """13-slot vector: date parts then the raw measurements; label = last column
    (or -1 for every row when the file has no ground truth)."""
    r = df.withColumns(date_parts("date", "yyyy-MM-dd HH:mm:ss"))
    r = r.withColumn("label", optional_label(label_col if has_label else None, has_label))
    if with_vector:
        r = assemble(r, HOURLY_SLOTS)
    return r
