"""Feature extractors: a path (and whether it holds labels) in, labelled rows out.

``labeled_points`` returns a (label double, features vector) DataFrame; an
extractor for a new file kind implements the same two methods.
"""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, SparkSession


class FeatureExtractor(Protocol):
    def frame(self, path: str, has_label: bool = True) -> DataFrame: ...

    def labeled_points(self, path: str, has_label: bool = True) -> DataFrame: ...


class HourlyExtractor:
    """Headerless hourly CSV -> 13-slot vector; the label is the last field of the
    line, however many stand before it, and is ignored if not asked for."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def frame(self, path: str, has_label: bool = True) -> DataFrame:
        from tabfit.plans.frames import hourly_features
        from tabfit.sources.csv import read_csv
        from tabfit.sources.schemas import HOURLY, HOURLY_NO_LABEL
        raw = (read_csv(self.spark, path, HOURLY, fields="first+last") if has_label
               else read_csv(self.spark, path, HOURLY_NO_LABEL, fields="first"))
        return hourly_features(raw, has_label=has_label)

    def labeled_points(self, path: str, has_label: bool = True) -> DataFrame:
        return self.frame(path, has_label).select("label", "features").toDF("label", "features")


class LibsvmExtractor:
    """libsvm text with indices kept as written (``width`` slots; dense unless ``sparse``)."""

    def __init__(self, spark: SparkSession, width: int = 129, index_base: int = 0, sparse: bool = False):
        self.spark, self.width, self.index_base, self.sparse = spark, width, index_base, sparse

    def frame(self, path: str, has_label: bool = True) -> DataFrame:
        from tabfit.sources.libsvm import read_libsvm
        return read_libsvm(self.spark, path, self.width, self.index_base, self.sparse)

    def labeled_points(self, path: str, has_label: bool = True) -> DataFrame:
        return self.frame(path, has_label)
