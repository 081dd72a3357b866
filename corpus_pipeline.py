"""A corpus pipeline of five operators: toxic documents go, repeated runs of lines
are cut, one document of each near-duplicate group stays, personal data is masked,
and what is left is packed into token sequences.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes
it as Parquet in the shared folder and gives the table read back to the next stage.
All stages but the last return the columns of ``docs`` (``n_chars`` follows the text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfit.llm import line_dedup, near_dedup, packing, pii, toxicity
from tabfit.llm.common import materialise, table


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that score as toxic; null and empty texts stay."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, out="__toxic")
    empty = F.coalesce(F.col("text"), F.lit("")) == ""
    return scored.where((F.col("__toxic") < toxicity.THRESHOLD) | empty).select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts later copies of repeated runs of lines; a document of which nothing is
    left goes, one that never had a line with a word stays."""
    clean = line_dedup.dedup_lines(docs)
    gone = (F.col("n_removed_lines") > 0) & ~F.col("text").rlike(r"[^ \t\n\x0B\f\r]")
    return _counted(clean.where(~gone).select(*docs.columns))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the least doc_id of each group linked by five-word shingles at 0.8."""
    found = near_dedup.near_duplicates(docs, words=5, percent=80)
    dropped = found.where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data in every text."""
    return _counted(pii.redact(docs, pii.fit(docs))).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    pieces = materialise(packing.token_pieces(docs), "pieces")
    return packing.pack(pieces)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: Trained stages have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
