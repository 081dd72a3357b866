"""Typed CSV reading with an explicit bad-row policy.

``on_bad``:

* ``"fail"``       - the first malformed row fails the job that reads it.
* ``"drop"``       - malformed rows are skipped (read with "quarantine" to count them).
* ``"quarantine"`` - every line parsed with ``from_csv`` (PERMISSIVE, with a
  corrupt-record field): returns the good rows and a report of the bad ones
  (raw text, cause, source file, parsable fields), both lazy.

Wrong field counts and unparsable numbers are both malformed.  Blank lines
are skipped by the reader.  Values are trimmed (``ignore*WhiteSpace``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


@dataclass
class CsvRead:
    good: DataFrame
    bad: DataFrame


@dataclass
class StagedCsv:
    """The rows of one pass: written tables of the good and the bad ones, and their counts."""
    good: DataFrame
    bad: DataFrame
    counts: dict[str, int]


def read_csv(spark: SparkSession, path: str, schema: StructType, header: bool = False,
             sep: str = ",", on_bad: str = "fail", trim: bool = True, quote: str = '"',
             line_numbers: bool = False, fields: str = "all"):
    """Read CSV text with ``schema``; see the module doc for ``on_bad``.

    ``fields`` (for files without quoted separators): "all" takes lines of just
    the schema's fields; "first" the schema's fields from the left and ignores
    what follows; "first+last" all but the last from the left and the last one
    from the line's end, whatever stands between.

    Returns a DataFrame for ``fail`` and ``drop``, a ``CsvRead`` for
    ``quarantine``.  With ``line_numbers`` the bad-row report also gives the
    1-based line of each bad row in its file (header and blank lines count).
    """
    if on_bad not in ("fail", "drop", "quarantine"):
        raise ValueError(f"on_bad must be fail, drop or quarantine, not {on_bad!r}")
    if fields not in ("all", "first", "first+last"):
        raise ValueError(f"fields must be all, first or first+last, not {fields!r}")
    parsed = _parse_lines(spark, path, schema, header, sep, trim, quote,
                          "FAILFAST" if on_bad == "fail" else "PERMISSIVE", line_numbers, fields)
    good, bad = _good_and_bad(parsed, [f.name for f in schema.fields])
    return CsvRead(good, bad) if on_bad == "quarantine" else good


def _parse_lines(spark: SparkSession, path: str, schema: StructType, header: bool, sep: str,
                 trim: bool, quote: str, mode: str, line_numbers: bool = False,
                 fields: str = "all") -> DataFrame:
    """``value, file, [line], r, bad, reason``.  Lines are read as text and parsed with ``from_csv``.

    The CSV file source prunes unread columns and then only validates the
    fields a query asks for (a bare ``count()`` validates nothing), so "good"
    would depend on the consumer.  An expression parses every field of every
    line, so good and bad split the lines exactly, whatever is selected later.
    (Records spanning several lines are not supported.)
    """
    names = [f.name for f in schema.fields]
    full = StructType(schema.fields + [StructField(CORRUPT, StringType(), True)])
    opts = {"mode": mode, "columnNameOfCorruptRecord": CORRUPT, "sep": sep,
            "quote": quote, "escape": quote, "ignoreLeadingWhiteSpace": str(trim).lower(),
            "ignoreTrailingWhiteSpace": str(trim).lower()}
    # Each line verbatim as one string column: the CSV source still skips the
    # header of every file (first line of the first split) and blank lines.
    if line_numbers:
        from tabfit.sources.text import numbered_lines
        lines = numbered_lines(spark, path)
        if header:
            lines = lines.where(F.col("line") > 1)
        lines = lines.where(F.length(F.trim("value")) > 0)
    else:
        lines = (spark.read.schema("value string").option("header", str(header).lower())
                 .option("sep", "\u0001").option("quote", "").option("enforceSchema", "true")
                 .option("ignoreLeadingWhiteSpace", "false")
                 .option("ignoreTrailingWhiteSpace", "false")
                 .csv(path)
                 .select("value", F.col("_metadata.file_path").alias("file"))
                 .where(F.col("value").isNotNull() & (F.length(F.trim("value")) > 0)))
    extra = ["line"] if line_numbers else []
    sep_re = sep if sep not in ".$|()[{^?*+\\" else "\\" + sep
    parts, n = F.split(F.col("value"), sep_re), len(names)
    if fields == "all":
        line = F.col("value")
    elif fields == "first":
        line = F.concat_ws(sep, F.slice(parts, 1, n))
    else:  # a line with too few fields stays as it is, and is malformed
        line = F.when(F.size(parts) >= n, F.concat_ws(sep, F.concat(
            F.slice(parts, 1, n - 1), F.array(F.element_at(parts, -1))))).otherwise(F.col("value"))
    parsed = lines.select("value", "file", *extra,
                          F.from_csv(line, full.simpleString(), opts).alias("r"))
    bad_flag = F.col("r").getField(CORRUPT).isNotNull() | F.col("r").isNull()
    # separators inside quotes do not count
    bare = F.regexp_replace("value", f"{quote}([^{quote}]|{quote}{quote})*{quote}", "") if quote else F.col("value")
    count = F.size(F.split(bare, sep_re))
    short = count < n if fields != "all" else count != n
    reason = F.when(short, F.format_string("expected %d fields, found %d", F.lit(n), count)).otherwise(
        F.lit("unparsable value"))
    return parsed.select("value", "file", *extra, "r", bad_flag.alias("bad"), reason.alias("reason"))


def _good_and_bad(parsed: DataFrame, names: list[str]) -> tuple[DataFrame, DataFrame]:
    values = [F.col("r").getField(n).alias(n) for n in names]
    extra = ["line"] if "line" in parsed.columns else []
    return (parsed.where(~F.col("bad")).select(*values),
            parsed.where("bad").select(F.col("value").alias("raw"), "reason", "file", *extra, *values))


def stage_csv(spark: SparkSession, path: str, schema: StructType, header: bool = False, sep: str = ",",
              trim: bool = True, quote: str = '"', line_numbers: bool = False, fields: str = "all") -> StagedCsv:
    """Read text once: the parsed rows are written to the shared folder, good and bad ones
    apart, and counted on the way (``DataFrame.observe``).  The report and the good
    rows are then read from there; the text is not scanned again."""
    from pyspark.sql import Observation
    from tabfit.session import staging_path
    parsed = _parse_lines(spark, path, schema, header, sep, trim, quote, "PERMISSIVE", line_numbers, fields)
    seen = Observation()
    counted = parsed.observe(seen, F.coalesce(F.sum((~F.col("bad")).cast("long")), F.lit(0)).alias("good"),
                             F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("bad"))
    target = staging_path(spark, "csv")
    # the raw text of good rows is not kept
    kept = counted.withColumn("value", F.when(F.col("bad"), F.col("value"))).withColumn("reason", F.when(F.col("bad"), F.col("reason")))
    kept.write.partitionBy("bad").parquet(target)
    # an empty input writes no folder that names ``bad``: the schema says it
    table = spark.read.schema(kept.schema).option("basePath", target).parquet(target)
    good, bad = _good_and_bad(table, [f.name for f in schema.fields])
    return StagedCsv(good, bad, dict(seen.get))


def read_stores(spark: SparkSession, path: str, header: bool = True, on_bad: str = "fail") -> DataFrame:
    """The store file: empty fields become sentinels, and where promo2 is 0 so does the
    start of the second promotion, even if the file names one."""
    from tabfit.functions.sentinels import fill_sentinels
    from tabfit.sources.schemas import STORE, STORE_PROMO2_START, STORE_SENTINELS
    read = read_csv(spark, path, STORE, header=header, on_bad=on_bad)
    filled = fill_sentinels(read.good if on_bad == "quarantine" else read, STORE_SENTINELS)
    return filled.withColumns({c: F.when(F.col("promo2") == 0, F.lit(STORE_SENTINELS[c]))
                               .otherwise(F.col(c)) for c in STORE_PROMO2_START})


def write_csv(df: DataFrame, path: str, header: bool = False, sep: str = ",") -> None:
    """Write a DataFrame as CSV text (empty string for NULL, quoted when needed)."""
    (df.write.mode("error").option("header", str(header).lower()).option("sep", sep)
     .option("quote", '"').option("escape", '"').option("nullValue", "")
     .option("emptyValue", '""').csv(path))
