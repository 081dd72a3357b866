"""Explicit schemas of the reference's input files (no inference)."""

from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# hourly rentals: date string, 8 measurements, ..., label last
HOURLY = _s(("date", StringType()), ("season", IntegerType()), ("holiday", IntegerType()),
            ("workingDay", IntegerType()), ("weather", IntegerType()), ("temp", DoubleType()),
            ("atemp", DoubleType()), ("humidity", IntegerType()), ("windspeed", DoubleType()),
            ("count", IntegerType()))
HOURLY_NO_LABEL = StructType(HOURLY.fields[:-1])

SALES = _s(("storeId", LongType()), ("daysOfWeek", IntegerType()), ("date", StringType()),
           ("sales", DoubleType()), ("customers", IntegerType()), ("open", IntegerType()),
           ("promo", IntegerType()), ("stateHoliday", StringType()), ("schoolHoliday", StringType()))

STORE = _s(("storeId", LongType()), ("storeType", StringType()), ("assortment", StringType()),
           ("competitionDistance", IntegerType()), ("competitionOpenSinceMonth", IntegerType()),
           ("competitionOpenSinceYear", IntegerType()), ("promo2", IntegerType()),
           ("promo2SinceWeek", IntegerType()), ("promo2SinceYear", IntegerType()),
           ("promoInterval", StringType()))
# store fields that may be empty and then take the -1 sentinel
STORE_SENTINELS = {"competitionDistance": -1, "competitionOpenSinceMonth": -1,
                   "competitionOpenSinceYear": -1, "promo2SinceWeek": -1, "promo2SinceYear": -1,
                   "promoInterval": ""}
# without the second promotion its start is the sentinel, whatever the file holds
STORE_PROMO2_START = ["promo2SinceWeek", "promo2SinceYear"]

PASSENGER = _s(("passengerId", LongType()), ("survived", IntegerType()), ("pClass", DoubleType()),
               ("sex", StringType()), ("age", DoubleType()), ("sibsp", DoubleType()),
               ("parch", DoubleType()), ("fare", DoubleType()), ("cabin", StringType()),
               ("embarked", StringType()))
# the passenger file as it is handed out: with the quoted name and the ticket
PASSENGER_FILE = _s(("passengerId", LongType()), ("survived", IntegerType()), ("pClass", DoubleType()),
                    ("name", StringType()), ("sex", StringType()), ("age", DoubleType()),
                    ("sibsp", DoubleType()), ("parch", DoubleType()), ("ticket", StringType()),
                    ("fare", DoubleType()), ("cabin", StringType()), ("embarked", StringType()))
PASSENGER_SENTINELS = {"pClass": -1.0, "sex": "", "age": -1.0, "sibsp": -1.0, "parch": -1.0,
                       "fare": -1.0, "cabin": "", "embarked": ""}

CENSUS = _s(("age", IntegerType()), ("workClass", StringType()), ("fnlwgt", IntegerType()),
            ("education", StringType()), ("educationNum", IntegerType()),
            ("maritalStatus", StringType()), ("occupation", StringType()),
            ("relationship", StringType()), ("race", StringType()), ("sex", StringType()),
            ("capitalGain", IntegerType()), ("capitalLoss", IntegerType()),
            ("hoursPerWeek", IntegerType()), ("nativeCountry", StringType()),
            ("label", StringType()))

ORDERS_TEXT = _s(("o_orderkey", LongType()), ("o_custkey", LongType()),
                 ("o_orderstatus", StringType()), ("o_totalprice", DoubleType()),
                 ("o_orderpriority", StringType()))
