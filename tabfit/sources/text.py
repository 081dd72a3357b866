"""Line numbers of text files, computed split by split.

Each input split is read by one task in file order, so inside a split the
row id from ``monotonically_increasing_id`` grows by one per line.  A line's
number in its file is its offset inside its split plus the number of lines in
the file's earlier splits; the per-split table (one row per split) supplies
that prefix.  No data moves to the driver or into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value): every line of every file with its 1-based number."""
    raw = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("_id"))
    splits = raw.groupBy("file", "block").agg(F.min("_id").alias("_first"),
                                              F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return (raw.join(splits, ["file", "block"])
            .select("file", (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line"),
                    "value"))
