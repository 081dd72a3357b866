"""Apply a fitted ``BoostModel`` to a stream of files.

Scoring is a projection (the trees are CASE expressions), so the streaming
plan is stateless: no watermark or state store is needed, every micro-batch
is scored independently and in parallel across its partitions.  The sink and
its checkpoint live in the shared folder, so a restarted query resumes from
the last committed batch (exactly-once for the file sink).
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tabfit.operators.boosting import BoostModel


def score_files(spark: SparkSession, model: BoostModel, source_dir: str, schema: StructType,
                sink_dir: str, checkpoint_dir: str, keep_cols: list[str] | None = None,
                source_format: str = "parquet", max_files_per_trigger: int | None = None,
                available_now: bool = True) -> StreamingQuery:
    """Start a streaming query reading ``source_dir`` and writing scored rows
    (``keep_cols`` + margin / probability / prediction) as Parquet to ``sink_dir``."""
    reader = spark.readStream.schema(schema).format(source_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    scored = model.transform(reader.load(source_dir))
    out_cols = list(keep_cols or []) + [c for c in ("margin", "probability", "prediction")
                                        if c in scored.columns]
    writer = (scored.select(*out_cols).writeStream.format("parquet")
              .option("path", sink_dir).option("checkpointLocation", checkpoint_dir)
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="10 seconds")
    return writer.start()
