"""Categorical encoders as DataFrame jobs.

* ``FrequencyIndexer`` - most frequent value gets 0, ties by value ascending
  (the ordering of ``StringIndexer(stringOrderType='frequencyDesc')``); one
  aggregation for all columns.
* ``FirstSeenVocab`` - values numbered by first appearance along an order key.
* ``OneHot`` - first-seen vocabulary to 0/1 arrays; an empty value (blank
  string or sentinel) keeps its slot but encodes as all zeros, as does a value
  never seen at fit time.

A fitted vocabulary is a DataFrame ``(column, value, index)``, checkpointed
to the shared folder, never a driver-side dictionary; rows get their index
by a join (broadcast when the per-column size is within the checked bound).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabfit.operators.joins import MAX_BROADCAST_ROWS
from tabfit.operators.ranking import global_index
from tabfit.session import shared_dir


def _stack_values(df: DataFrame, cols: list[str], extra: list[Column] | None = None) -> DataFrame:
    """One row per (column name, value as string) pair, for every input row."""
    extra = extra or []
    structs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"),
                        *extra) for c in cols]
    return df.select(F.explode(F.array(*structs)).alias("_s")).select("_s.*")


def _number_within_column(vocab: DataFrame, order_cols: list[str],
                          n_rows: int | None = None) -> DataFrame:
    """Global index over (column, order...) minus the first index of each column."""
    ranked = global_index(vocab, ["column", *order_cols], index_col="_g", n_rows=n_rows)
    starts = ranked.groupBy("column").agg(F.min("_g").alias("_start"))  # one row per column
    return (ranked.join(F.broadcast(starts), "column")
            .withColumn("index", (F.col("_g") - F.col("_start")).cast("long"))
            .drop("_g", "_start"))


def _materialise(spark, df: DataFrame) -> DataFrame:
    shared_dir(spark)  # make sure a reliable checkpoint folder is registered
    return df.checkpoint(eager=True)


def _rank_small(spark, rows, order_cols: list[str], sizes: dict[str, int]):
    """Same numbering as the distributed path, for bounded statistics.
    Order keys compare like Spark's ascending sort (strings by code point,
    which is UTF-8 byte order; NULL first)."""
    def key(r):
        return tuple((r[c] is not None, r[c]) for c in order_cols)
    by_col: dict[str, list] = {}
    for r in rows:
        by_col.setdefault(r["column"], []).append(r)
    out, inline = [], {}
    for c, rs in by_col.items():
        rs.sort(key=key)
        small = sizes.get(c, 0) <= INLINE_VOCAB_MAX
        if small:
            inline[c] = {}
        for i, r in enumerate(rs):
            out.append((c, r["value"], i))
            if small and r["value"] is not None:
                inline[c][r["value"]] = i
    vocab = spark.createDataFrame(out, "column string, value string, index long")
    return vocab, sizes, inline


def _fit_vocab(stats: DataFrame, order_cols: list[str]
               ) -> tuple[DataFrame, dict[str, int], dict[str, dict[str, int]]]:
    """Rank the per-value statistics (one pass over the data, kept in memory
    while the small ranking jobs run), then store the vocabulary reliably.
    Small vocabularies (at most INLINE_VOCAB_MAX values) are also returned as
    dictionaries: their total size is bounded by columns x INLINE_VOCAB_MAX."""
    stats = stats.persist(StorageLevel.MEMORY_AND_DISK)
    sizes = {r["column"]: r["n"] for r in
             stats.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per column
    if sizes and sum(sizes.values()) <= LOCAL_RANK_MAX:
        # the statistics have at most LOCAL_RANK_MAX rows in total (counted
        # above), so rank them here in one step
        rows = stats.collect()
        stats.unpersist()
        return _rank_small(stats.sparkSession, rows, order_cols, sizes)
    vocab = _materialise(stats.sparkSession,
                         _number_within_column(stats, order_cols, n_rows=sum(sizes.values())))
    stats.unpersist()
    small = [c for c, n in sizes.items() if n <= INLINE_VOCAB_MAX]
    inline: dict[str, dict[str, int]] = {c: {} for c in small}
    if small:
        for r in vocab.where(F.col("column").isin(*small) & F.col("value").isNotNull()) \
                .select("column", "value", "index").collect():
            inline[r["column"]][r["value"]] = int(r["index"])
    return vocab, sizes, inline


# vocabularies up to this size are looked up from a literal map (no join, no job)
INLINE_VOCAB_MAX = 64
# value statistics up to this many rows in total are ranked on the driver
LOCAL_RANK_MAX = 4096


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass
class VocabModel:
    """A fitted vocabulary: ``vocab`` has (column, value, index, ...).

    ``inline`` holds the (value -> index) pairs of columns whose vocabulary has
    at most ``INLINE_VOCAB_MAX`` entries (collected once at fit time; bounded);
    those columns are looked up from a literal map instead of a join."""
    input_cols: list[str]
    output_cols: list[str]
    vocab: DataFrame
    sizes: dict[str, int]
    handle_invalid: str = "error"
    max_broadcast_rows: int = MAX_BROADCAST_ROWS
    inline: dict[str, dict[str, int]] = field(default_factory=dict)

    def labels(self, column: str) -> DataFrame:
        return (self.vocab.where(F.col("column") == column)
                .select("value", "index").orderBy("index"))

    def _lookup(self, df: DataFrame, c: str, out: str) -> DataFrame:
        pairs = self.inline.get(c)
        if pairs is not None:
            if not pairs:
                return df.withColumn(out, F.lit(None).cast("double"))
            m = "map(" + ", ".join(f"{_sql_str(k)}, {float(i)!r}D" for k, i in pairs.items()) + ")"
            return df.withColumn(out, F.expr(f"try_element_at({m}, CAST(`{c}` AS STRING))"))
        v = (self.vocab.where(F.col("column") == c)
             .select(F.col("value").alias(f"_v_{out}"), F.col("index").cast("double").alias(out)))
        # no hint: the vocabulary is a written table, so its size is known, and
        # Spark broadcasts it only below autoBroadcastJoinThreshold
        return df.join(v, F.col(c).cast("string") == F.col(f"_v_{out}"), "left").drop(f"_v_{out}")

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for c, o in zip(self.input_cols, self.output_cols):
            out = self._lookup(out, c, o)
            n = self.sizes.get(c, 0)
            if self.handle_invalid == "keep":
                out = out.withColumn(o, F.coalesce(F.col(o), F.lit(float(n))))
            elif self.handle_invalid == "skip":
                out = out.where(F.col(o).isNotNull())
            else:
                out = out.withColumn(o, F.when(F.col(o).isNull(), F.raise_error(
                    F.concat(F.lit(f"unseen or null value in {c}: "),
                             F.coalesce(F.col(c).cast("string"), F.lit("NULL")))))
                    .otherwise(F.col(o)))
        return out


class FrequencyIndexer:
    """Index string values by descending frequency, ties by value ascending."""

    def __init__(self, input_cols: list[str], output_cols: list[str] | None = None,
                 handle_invalid: str = "error", max_broadcast_rows: int = MAX_BROADCAST_ROWS):
        self.input_cols = list(input_cols)
        self.output_cols = list(output_cols or [c + "Index" for c in input_cols])
        self.handle_invalid = handle_invalid
        self.max_broadcast_rows = max_broadcast_rows

    def counts(self, df: DataFrame) -> DataFrame:
        """(column, value, count, _neg): one aggregation for all columns."""
        return (_stack_values(df, self.input_cols).where(F.col("value").isNotNull())
                .groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
                .withColumn("_neg", -F.col("count")))

    def vocabulary(self, df: DataFrame) -> DataFrame:
        return _number_within_column(self.counts(df), ["_neg", "value"]).drop("_neg")

    def fit(self, df: DataFrame) -> VocabModel:
        vocab, sizes, inline = _fit_vocab(self.counts(df), ["_neg", "value"])
        return VocabModel(self.input_cols, self.output_cols, vocab.drop("_neg"), sizes,
                          self.handle_invalid, self.max_broadcast_rows, inline)


class FirstSeenVocab:
    """Number distinct values by their first appearance along ``order_col``."""

    def __init__(self, input_cols: list[str], order_col: str,
                 output_cols: list[str] | None = None, handle_invalid: str = "keep",
                 max_broadcast_rows: int = MAX_BROADCAST_ROWS):
        self.input_cols = list(input_cols)
        self.order_col = order_col
        self.output_cols = list(output_cols or [c + "Index" for c in input_cols])
        self.handle_invalid = handle_invalid
        self.max_broadcast_rows = max_broadcast_rows

    def firsts(self, df: DataFrame) -> DataFrame:
        """(column, value, first_seen, _isnull): one aggregation for all columns;
        NULL values form their own category (a value like any other)."""
        return (_stack_values(df, self.input_cols, [F.col(self.order_col).alias("_o")])
                .groupBy("column", "value").agg(F.min("_o").alias("first_seen"))
                .withColumn("_isnull", F.col("value").isNull()))

    def vocabulary(self, df: DataFrame) -> DataFrame:
        return _number_within_column(self.firsts(df),
                                     ["first_seen", "_isnull", "value"]).drop("_isnull")

    def fit(self, df: DataFrame) -> VocabModel:
        vocab, sizes, inline = _fit_vocab(self.firsts(df), ["first_seen", "_isnull", "value"])
        return VocabModel(self.input_cols, self.output_cols, vocab.drop("_isnull"), sizes,
                          self.handle_invalid, self.max_broadcast_rows, inline)


@dataclass
class OneHotModel:
    vocab_model: VocabModel
    empty_values: dict[str, object] = field(default_factory=dict)

    def width(self, c: str) -> int:
        return self.vocab_model.sizes.get(c, 0)

    def _hot(self, df: DataFrame) -> tuple[DataFrame, dict[str, Column], list[str]]:
        """``df`` with helper columns, the slot of each value (-1: none), and the helpers' names."""
        vm = self.vocab_model
        idx_cols = [f"_oh_{c}" for c in vm.input_cols]
        lk = VocabModel(vm.input_cols, idx_cols, vm.vocab, vm.sizes, "keep_null",
                        vm.max_broadcast_rows, vm.inline)
        out, hot = df, {}
        for c, o in zip(vm.input_cols, idx_cols):
            out = lk._lookup(out, c, o)
            empty = self.empty_values.get(c, "")
            is_empty = (F.col(c).isNull() | (F.col(c).cast("string") == F.lit(str(empty)))
                        if isinstance(empty, str)
                        else F.col(c).isNull() | (F.col(c) == F.lit(empty)))
            hot[c] = F.when(is_empty, F.lit(-1.0)).otherwise(F.coalesce(F.col(o), F.lit(-1.0)))
        return out, hot, idx_cols

    def transform(self, df: DataFrame, suffix: str = "Vec") -> DataFrame:
        """Add ``<col><suffix>`` as array<double> for every input column.  Every row carries an
        array as wide as the vocabulary; for wide columns use ``transform_sparse``."""
        out, hot, helpers = self._hot(df)
        for c, h in hot.items():
            n = self.width(c)
            if n == 0:
                arr = F.array().cast("array<double>")
            else:
                arr = F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                                  lambda i: F.when(i.cast("double") == h, 1.0).otherwise(0.0))
            out = out.withColumn(c + suffix, arr)
        return out.drop(*helpers)

    def transform_sparse(self, df: DataFrame, output_col: str = "features",
                         numeric_cols: list[str] | None = None) -> DataFrame:
        """Add one vector of all columns' slots, then ``numeric_cols``.  Slots are sparse
        vectors of Spark's one-hot encoder (an empty or unseen value has no entry), so
        a row costs the same however wide the vocabularies are."""
        from pyspark.ml.feature import OneHotEncoder, VectorAssembler
        out, hot, helpers = self._hot(df)
        wide = [c for c in hot if self.width(c)]
        # the encoder takes a value's slot, and the width for "none"
        slots, vectors = [f"_slot_{c}" for c in wide], [f"_hot_{c}" for c in wide]
        out = out.withColumns({s: F.when(hot[c] < 0, F.lit(float(self.width(c)))).otherwise(hot[c])
                               for c, s in zip(wide, slots)})
        if wide:
            # fitted on one row that holds the greatest slots: the widths are known
            widths = df.sparkSession.createDataFrame([tuple(float(self.width(c) - 1) for c in wide)], slots)
            encoder = OneHotEncoder(inputCols=slots, outputCols=vectors, dropLast=True, handleInvalid="keep").fit(widths)
            out = encoder.transform(out)
        parts = vectors + list(numeric_cols or [])
        out = VectorAssembler(inputCols=parts, outputCol=output_col, handleInvalid="keep").transform(out)
        return out.drop(*helpers, *slots, *vectors)


class OneHot:
    """One-hot by first appearance; empty values keep a slot but encode as zeros."""

    def __init__(self, input_cols: list[str], order_col: str,
                 empty_values: dict[str, object] | None = None,
                 max_broadcast_rows: int = MAX_BROADCAST_ROWS):
        self.input_cols = list(input_cols)
        self.order_col = order_col
        self.empty_values = dict(empty_values or {})
        self.max_broadcast_rows = max_broadcast_rows

    def fit(self, df: DataFrame) -> OneHotModel:
        vm = FirstSeenVocab(self.input_cols, self.order_col,
                            max_broadcast_rows=self.max_broadcast_rows).fit(df)
        return OneHotModel(vm, self.empty_values)
