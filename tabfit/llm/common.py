"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import io
import os
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabfit.session import staging_path

#: The white space that separates words: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"

#: Rows of one range when places are found, and copies of one row that a task writes.
ROWS_PER_RANGE = 200_000
COPIES_PER_CHUNK = 65_536

#: A key is hot with more than one row in HOT_SHARE, and more than HOT_ROWS rows.
HOT_SHARE, HOT_ROWS = 2_000, 1_000

_SHIPPED: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back: cuts
    the lineage, survives lost executors, and later reads prune columns."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the maximal runs without ``SPACES``; built-in functions only."""
    return F.array_remove(F.split(text, r"[ \t\n\x0B\f\r]+"), "")


def places(rows: DataFrame, group: str, order: list[Column], name: str,
           rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``rows`` with ``__place`` and ``__size``: the copies (sums of ``__n``) before each row in
    its group, and of the whole group, in the order given (rows must be distinct in it).

    The rows are range-partitioned by group and order, and written; a row's place
    is what lies before it in its range, and in the group's earlier ranges.  No key
    of a join or window holds more rows than a range, whatever the groups are."""
    ranges = max(1, -(-rows.count() // rows_per_range))
    parted = materialise(rows.repartitionByRange(ranges, F.col(group).asc(), *order)
                         .withColumn("__range", F.spark_partition_id()), name)
    # a row for every group and every range that it reaches
    parts = parted.groupBy(F.col("__range").alias("__r"), F.col(group).alias("__g")).agg(F.sum("__n").alias("__part"))
    whole = Window.partitionBy("__g")
    earlier = whole.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("__r", "__g", F.sum("__part").over(whole).alias("__size"),
                         F.coalesce(F.sum("__part").over(earlier), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__range", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = parted.withColumn("__in", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    joined = placed.join(parts, (F.col("__range") == F.col("__r")) & F.col(group).eqNullSafe(F.col("__g")))
    return joined.select(*rows.columns, (F.col("__before") + F.col("__in")).alias("__place"), "__size")


def copies(rows: DataFrame) -> DataFrame:
    """``__n`` rows for each row, numbered ``__i`` from 0, written in chunks by several tasks."""
    last = F.col("__n") - 1
    chunk = rows.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / COPIES_PER_CHUNK))))
    low = F.col("__chunk") * COPIES_PER_CHUNK
    return chunk.withColumn("__i", F.explode(F.sequence(low, F.least(last, low + (COPIES_PER_CHUNK - 1)))))


def join_spread(left: DataFrame, right: DataFrame, key: str, count: str, how: str = "inner") -> DataFrame:
    """``left`` joined (inner or left) with the written table ``right``: one row per ``key``, whose
    column ``count`` says how many rows of ``left`` have it.

    Keys with more than a ``HOT_SHARE``-th of all counted rows are joined where their
    rows lie, from a broadcast table that has fewer than ``HOT_SHARE`` rows for that
    reason; only the others are shuffled, and none of them is large."""
    total = right.agg(F.sum(count)).first()[0] or 0
    hot = right.where(F.col(count) * HOT_SHARE > F.lit(total)).where(F.col(count) > HOT_ROWS)
    n_hot = hot.count()  # below HOT_SHARE
    if n_hot == 0:
        return left.join(right, key, how)
    cold = right.join(F.broadcast(hot.select(key)), key, "left_anti")
    spread = left.join(F.broadcast(hot), key)
    rest = left.join(F.broadcast(hot.select(key)), key, "left_anti")
    return spread.unionByName(rest.join(cold, key, how))


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers.  Does nothing where
    ``PYTHONPATH`` has its folder already; else a zip of it goes to the shared
    folder, once per application, and Spark hands it to the executors."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    sc = spark.sparkContext
    if root in known or _SHIPPED.get("app") == sc.applicationId:
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "tabfit")):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, root))
    path = staging_path(spark, "package") + "/tabfit-package.zip"
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target)
    out.write(packed.getvalue())
    out.close()
    sc.addPyFile(path)
    _SHIPPED["app"] = sc.applicationId
