"""libsvm text: ``label idx:value idx:value ...``.

``index_base=1`` is the usual 1-based format and uses Spark's own ``libsvm``
reader (sparse vectors).  ``index_base=0`` keeps every index as written, in a
vector of ``num_features`` slots (slot 0 stays empty for 1-based data); when an
index repeats, the last value wins.  An index outside the vector fails the job.
With ``sparse`` the vectors hold what the lines hold, however wide they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_libsvm(spark: SparkSession, path: str, num_features: int,
                index_base: int = 1, sparse: bool = False) -> DataFrame:
    """(label double, features vector)."""
    if index_base == 1:
        return (spark.read.format("libsvm").option("numFeatures", str(num_features))
                .load(path).select("label", "features"))
    from pyspark.ml.functions import array_to_vector
    parts = F.split(F.trim(F.col("value")), " +")
    entries = F.transform(F.slice(parts, 2, F.size(parts)), lambda e: F.struct(
        F.split(e, ":").getItem(0).cast("int").alias("i"),
        F.split(e, ":").getItem(1).cast("double").alias("v")))
    t = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    # entries by (index, place); of equal indices the last one stays
    t = t.select(parts.getItem(0).cast("double").alias("label"), entries.alias("_e"))
    placed = F.transform("_e", lambda e, k: F.struct(e["i"].alias("i"), k.alias("k"), e["v"].alias("v")))
    t = t.select("label", F.sort_array(placed).alias("_s"))
    t = t.select("label", F.filter("_s", lambda e, k: F.coalesce(
        F.get("_s", k + 1)["i"] != e["i"], F.lit(True))).alias("_u"))
    outside = F.exists("_u", lambda e: e["i"].isNull() | (e["i"] < 0) | (e["i"] >= num_features))
    if sparse:
        ok = F.when(outside, F.raise_error(F.lit(
            f"libsvm index outside 0 to {num_features - 1}")).cast("boolean")).otherwise(True)
        rows = t.where(ok).select("label", F.transform("_u", lambda e: e["i"]).alias("ind"),
                                  F.transform("_u", lambda e: e["v"]).alias("val"))
        return sparse_vectors(rows, num_features)
    # zeros up to each entry, the entry, zeros to the end: linear in the width
    gap = F.transform("_u", lambda e, k: F.concat(
        F.array_repeat(F.lit(0.0), e["i"] - F.coalesce(F.get("_u", k - 1)["i"], F.lit(-1)) - 1),
        F.array(e["v"])))
    tail = F.lit(num_features - 1) - F.coalesce(F.get("_u", F.size("_u") - 1)["i"], F.lit(-1))
    dense = F.concat(F.flatten(gap), F.array_repeat(F.lit(0.0), tail))
    checked = F.when(outside, F.raise_error(F.lit(
        f"libsvm index outside 0 to {num_features - 1}")).cast("array<double>")).otherwise(dense)
    return t.select("label", array_to_vector(checked).alias("features"))


def sparse_vectors(rows: DataFrame, size: int) -> DataFrame:
    """``label, features`` of rows ``label, ind, val`` (indices ascending), as sparse vectors."""
    from collections.abc import Iterator

    import pyarrow as pa
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import DoubleType, StructField, StructType

    def wrap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            v = pa.StructArray.from_arrays(
                [pa.array([0] * n, pa.int8()), pa.array([size] * n, pa.int32()), b.column(1), b.column(2)],
                ["type", "size", "indices", "values"])
            yield pa.RecordBatch.from_arrays([b.column(0), v], ["label", "features"])

    return rows.mapInArrow(wrap, StructType([StructField("label", DoubleType()), StructField("features", VectorUDT())]))


def libsvm_line(label: Column, x: Column, index_base: int = 1) -> Column:
    """Text of one libsvm line from a label and an array<double> of values
    (zero entries are omitted)."""
    pairs = F.transform(x, lambda v, i: F.when(
        v != 0, F.concat((i + index_base).cast("string"), F.lit(":"), v.cast("string"))))
    return F.concat_ws(" ", label.cast("string"), F.filter(pairs, lambda p: p.isNotNull()))


def write_libsvm(df: DataFrame, path: str, label_col: str = "label", x_col: str = "x",
                 index_base: int = 1) -> None:
    df.select(libsvm_line(F.col(label_col), F.col(x_col), index_base).alias("value")) \
        .write.mode("error").text(path)
