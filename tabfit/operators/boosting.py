"""Second-order gradient boosting on feature histograms, as DataFrame jobs.

Method: Newton boosting of regression trees (Friedman 2001; Chen & Guestrin
2016), with missing values sent to the better side of each split.  The rows are
quantised once into pages (``operators/pages.py``).  Trees grow level by level, and a
level of ALL trees of a round - every class, and every point of a parameter
grid - is one job:

    pages -> node, (G, H, rows) by feature and bin   numpy, summed over the partition:
             a task returns one record per open node, at most as long as the
             node has slots, however skewed the data is
          -> shuffled by node, summed; best split of each node, one record per open
             node to the driver (the sums themselves, where one task has all rows or
             those of all tasks are a few megabytes at most)

    gain  G_L^2/(H_L+lambda) + G_R^2/(H_R+lambda) - G^2/(H+lambda)

A node's histogram is bounded by the features and their bins, not by the data.  What a task gets is the splits
found so far; a row's node follows from them by one comparison a level, on bins,
so the plan of a job is the same short one in every level and round, and
nothing is compiled anew.  Leaf values are added to the margins by the job of the
next round's first level.

Feature bins ignore NaN and NULL: a feature with at most ``max_bins`` distinct
values gets an edge at each of them, any other its quantiles and its maximum.
Bin ``j`` of a feature holds values in ``[edge_{j-1}, edge_j)``; a split at
bin ``j`` sends ``value < edge_j`` left.  NaN and NULL - and values equal to
``missing``, if that is set - go to the side that gains most, or right where
training saw none.  With ``missing=0.0`` pages are sparse: entries that a sparse
vector, a libsvm line or a one-hot code leaves out cost nothing, and the same
trees come from sparse and from dense input.

While trees grow, pages are records of an RDD: the hundreds of short jobs of a fit then
cost no query planning, and nodes travel as a few arrays each, not as a row per bin.
Pages are persisted with their margins; each round's copy is materialised by the
first job on it, before its parent is released, and lineage is cut every
``checkpoint_interval`` rounds with a reliable checkpoint in the folder named
by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from tabfit.functions.metrics import METRICS, Metric, StateMetric
from tabfit.operators import pages
from tabfit.operators.pages import Bins, Growing, Level
from tabfit.operators.scorer import LeafMasks
from tabfit.session import shared_dir, ship

OBJECTIVES = ("reg:squarederror", "reg:linear", "binary:logistic", "binary:logitraw",
              "multi:softprob", "multi:softmax")
# the split table of one level has at most classes * 2^depth rows
MAX_LEVEL_NODES = 1 << 16
HESS_FLOOR = 1e-16
MIN_GAIN = 1e-6
# pages are spread to about this many rows per task, and merged up to the other number
ROWS_PER_TASK = 300_000
MOST_ROWS_PER_TASK = 2_000_000
# histograms of a level with at most this many slots, over all tasks, are added up on the driver
# (32 bytes a slot); larger ones are shuffled by node
COLLECTED_SLOTS = 1 << 20
# up to this many features read by a model, scoring uses one scalar column for each
SCALAR_FEATURES_MAX = 256
# ensembles with more splits than this are scored by leaf masks, not by CASE expressions
SQL_SPLITS_MAX = 250
# features looked up by literal when their distinct values are fetched
FEATURES_BY_LITERAL = 1000


@dataclass
class BoostParams:
    objective: str = "binary:logistic"
    num_round: int = 10
    eta: float = 0.3
    max_depth: int = 6
    reg_lambda: float = 1.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    subsample: float = 1.0
    num_class: int = 1
    max_bins: int = 64
    base_score: float = 0.5
    seed: int = 0
    checkpoint_interval: int = 10
    eval_metric: str | None = None
    # a value that counts as missing, beside NaN and NULL; 0.0: pages are sparse
    missing: float | None = None

    def classes(self) -> int:
        return self.num_class if self.objective.startswith("multi:") else 1

    def validate(self) -> "BoostParams":
        if self.objective not in OBJECTIVES:
            raise ValueError(f"unknown objective {self.objective!r}")
        if self.objective.startswith("multi:") and self.num_class < 2:
            raise ValueError("multi-class objectives need num_class >= 2")
        if not 0 < self.subsample <= 1:
            raise ValueError("subsample must be in (0, 1]")
        if self.max_depth < 0 or self.classes() * (1 << self.max_depth) > MAX_LEVEL_NODES:
            raise ValueError("classes * 2^max_depth exceeds the per-level node bound")
        if not 2 <= self.max_bins <= 1024:
            raise ValueError("max_bins must be in [2, 1024]")
        return self

    def replace(self, **kw) -> "BoostParams":
        d = asdict(self)
        d.update(kw)
        return BoostParams(**d)


def default_metric(objective: str) -> str:
    if objective.startswith("reg:"):
        return "rmse"
    if objective.startswith("binary:"):
        return "logloss"
    return "mlogloss"


# --------------------------------------------------------------- objectives
def _sigmoid(m: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-m))


def _softmax(m: Column, k: int) -> list[Column]:
    mx = F.array_max(m)
    e = [F.exp(m[i] - mx) for i in range(k)]
    s = e[0]
    for x in e[1:]:
        s = s + x
    return [x / s for x in e]


def grad_hess(objective: str, margin: Column, label: Column, k: int = 1) -> tuple[Column, Column]:
    """Arrays (length k) of first and second derivatives of the loss at ``margin``."""
    y = label.cast("double")
    if objective.startswith("reg:"):
        return F.array(margin[0] - y), F.array(F.lit(1.0))
    if objective.startswith("binary:"):
        p = _sigmoid(margin[0])
        return F.array(p - y), F.array(F.greatest(p * (1 - p), F.lit(HESS_FLOOR)))
    ps = _softmax(margin, k)
    g = [ps[i] - F.when(y == i, 1.0).otherwise(0.0) for i in range(k)]
    h = [F.greatest(2.0 * ps[i] * (1 - ps[i]), F.lit(HESS_FLOOR)) for i in range(k)]
    return F.array(*g), F.array(*h)


def leaf_weight(g_sum: Column, h_sum: Column, reg_lambda: float) -> Column:
    """Optimal leaf value -G / (H + lambda)."""
    return -g_sum / (h_sum + F.lit(reg_lambda))


def leaf_weights(df: DataFrame, leaf_col: str, g_col: str, h_col: str,
                 reg_lambda: float = 1.0) -> DataFrame:
    """Per-leaf optimal weights from per-row gradient statistics."""
    return df.groupBy(leaf_col).agg(
        F.sum(g_col).alias("G"), F.sum(h_col).alias("H"),
        leaf_weight(F.sum(g_col), F.sum(h_col), reg_lambda).alias("weight"))


def scored_columns(objective: str, margin: Column, k: int) -> dict[str, Column]:
    """Prediction columns derived from the margin array."""
    if objective.startswith("reg:"):
        return {"margin": margin[0], "prediction": margin[0]}
    if objective.startswith("binary:"):
        p = _sigmoid(margin[0])
        out = {"margin": margin[0], "probability": p,
               "prediction": F.when(p > 0.5, 1.0).otherwise(0.0)}
        return out
    ps = _softmax(margin, k)
    arr = F.array(*ps)
    best = F.array_position(arr, F.array_max(arr)) - 1
    return {"margin": margin, "probabilities": arr, "prediction": best.cast("double")}


# ------------------------------------------------------------------ the tree
@dataclass
class Tree:
    round: int
    cls: int
    # node id -> (feature, bin, threshold, gain, cover, missing go left) for splits
    splits: dict[int, tuple[int, int, float, float, float, bool]] = field(default_factory=dict)
    # node id -> (value, cover) for leaves
    leaves: dict[int, tuple[float, float]] = field(default_factory=dict)

    def sql(self, x: str, node: int = 0) -> str:
        """SQL CASE text giving this tree's leaf value.  ``x`` is an array
        column name, or a column-name template such as ``"x_{f}"``."""
        if node in self.leaves:
            return _dlit(self.leaves[node][0])
        f, _, thr, _, _, default_left = self.splits[node]
        v = _ref(x, f)
        # features hold no NULLs (see BoostModel._x); NaN < t is false: NaN goes right
        cond = f"NOT isnan({v})" if math.isinf(thr) else f"{v} < {_dlit(thr)}"
        if default_left:
            cond = f"({cond} OR isnan({v}))"
        return (f"CASE WHEN {cond} THEN {self.sql(x, 2 * node + 1)} "
                f"ELSE {self.sql(x, 2 * node + 2)} END")

    def rows(self, tree_id: int) -> list[tuple]:
        out = []
        for n, (f, b, thr, gain, cover, default_left) in self.splits.items():
            out.append((tree_id, self.round, self.cls, n, False, f, thr, 2 * n + 1, 2 * n + 2,
                        None, gain, cover, default_left))
        for n, (v, cover) in self.leaves.items():
            out.append((tree_id, self.round, self.cls, n, True, None, None, None, None, v, None, cover, None))
        return sorted(out, key=lambda r: r[3])

    def features(self) -> set[int]:
        return {s[0] for s in self.splits.values()}


NODE_SCHEMA = ("tree int, round int, class int, node int, is_leaf boolean, feature int, "
               "threshold double, left int, right int, leaf_value double, gain double, cover double, "
               "default_left boolean")


def _dlit(v: float) -> str:
    """A SQL double literal that round-trips ``v`` exactly."""
    v = float(v)
    if math.isnan(v):
        return "CAST('NaN' AS DOUBLE)"
    if math.isinf(v):
        return "CAST('Infinity' AS DOUBLE)" if v > 0 else "CAST('-Infinity' AS DOUBLE)"
    return f"({v!r}D)"


def _ref(x: str, f: int) -> str:
    """SQL reference to feature ``f``: ``x[f]`` for an array column, or the
    column named by a template like ``b_{f}``."""
    return x.format(f=f) if "{f}" in x else f"{x}[{f}]"


# -------------------------------------------------------------------- model
@dataclass
class BoostModel:
    params: BoostParams
    num_features: int
    base_margin: list[float]
    trees: list[Tree]
    history: list[tuple] = field(default_factory=list)
    features_col: str = "features"
    feature_cols: list[str] | None = None

    def _x(self, df: DataFrame) -> Column:
        """Features as array<double> without NULLs (a NULL becomes NaN)."""
        nan = F.lit(float("nan"))
        if self.feature_cols:
            return F.array(*[F.coalesce(F.col(c).cast("double"), nan) for c in self.feature_cols])
        dt = df.schema[self.features_col].dataType
        if isinstance(dt, ArrayType):
            return F.transform(F.col(self.features_col).cast("array<double>"),
                               lambda v: F.coalesce(v, nan))
        from pyspark.ml.functions import vector_to_array
        return vector_to_array(F.col(self.features_col))

    def _entries(self, df: DataFrame) -> tuple[Column, Column]:
        """Feature numbers and values of a row; the numbers are NULL where all values
        are given in order (arrays, dense vectors)."""
        none = F.lit(None).cast("array<int>")
        if self.feature_cols or isinstance(df.schema[self.features_col].dataType, ArrayType):
            return none, self._x(df)
        v = F.unwrap_udt(self.features_col)
        return v["indices"], v["values"]

    def _missing(self, v: Column) -> Column:
        missing = self.params.missing
        return v if missing is None else F.when(v == F.lit(missing), F.lit(float("nan"))).otherwise(v)

    def margin_sql(self, x: str, tree_limit: int | None = None) -> str:
        k = self.params.classes()
        sums = [[_dlit(self.base_margin[i])] for i in range(k)]
        for t in self.trees:
            if tree_limit is not None and t.round >= tree_limit:
                continue
            sums[t.cls].append(t.sql(x))
        return "array(" + ", ".join(" + ".join(parts) for parts in sums) + ")"

    def transform(self, df: DataFrame, tree_limit: int | None = None,
                  keep_margin_array: bool = False, engine: str = "auto") -> DataFrame:
        """Append margin / probability / prediction (and ``probabilities``)
        columns; row-local, so it scales with the input partitions.

        ``engine``: "sql" (CASE expressions), "masks" (``operators/scorer.py``), or "auto":
        masks beyond ``SQL_SPLITS_MAX`` splits.  Both give the same margins to the bit."""
        if engine not in ("auto", "sql", "masks"):
            raise ValueError(f"engine must be auto, sql or masks, not {engine!r}")
        k = self.params.classes()
        trees = [t for t in self.trees if tree_limit is None or t.round < tree_limit]
        used = sorted(set().union(*[t.features() for t in trees])) if trees else []
        nan = F.lit(float("nan"))
        indices, values = self._entries(df)
        if self.params.missing == 0.0 and not self.feature_cols and not isinstance(
                df.schema[self.features_col].dataType, ArrayType):
            # a sparse vector: what it leaves out is missing, nothing is made dense
            places = F.coalesce(indices, F.when(F.size(values) > 0, F.sequence(F.lit(0), F.size(values) - 1))
                                .otherwise(F.array().cast("array<int>")))
            t = df.withColumn("_x", F.map_from_arrays(places, values))
            value = [self._missing(F.coalesce(F.try_element_at("_x", F.lit(f)), nan)) for f in used]
        else:
            t = df.withColumn("_x", self._x(df))
            value = [self._missing(F.col("_x")[f]) for f in used]
        by_masks = engine == "masks" or engine == "auto" and sum(len(x.splits) for x in trees) > SQL_SPLITS_MAX
        if by_masks and used:
            t = t.withColumn("_margin", self._masks(df.sparkSession, trees, used, value)).drop("_x")
        elif len(used) <= SCALAR_FEATURES_MAX:
            # one scalar column per feature read: tree comparisons on plain doubles
            # evaluate several times faster than array element reads
            names = [f"_x_{f}" for f in used]
            t = t.select("*", *[v.alias(n) for v, n in zip(value, names)])
            t = t.withColumn("_margin", F.expr(self.margin_sql("_x_{f}", tree_limit)))
            t = t.drop("_x", *names)
        else:
            # the values read, in the order of ``used``
            t = t.withColumn("_x", F.array(*value))
            place = {f: i for i, f in enumerate(used)}
            t = t.withColumn("_margin", F.expr(self._renumbered(place).margin_sql("_x", tree_limit))).drop("_x")
        cols = scored_columns(self.params.objective, F.col("_margin"), k)
        out = t.withColumns(cols)
        if self.params.objective.startswith("binary:"):
            from pyspark.ml.functions import array_to_vector
            if self.params.objective == "binary:logitraw":
                score = F.array(-F.col("margin"), F.col("margin"))
            else:
                score = F.array(1 - F.col("probability"), F.col("probability"))
            out = out.withColumn("probabilities", array_to_vector(score))
        return out if keep_margin_array else out.drop("_margin")

    def _masks(self, spark: SparkSession, trees: list[Tree], used: list[int], value: list[Column]) -> Column:
        """The margins as a Pandas UDF over the values read; the tables are broadcast (their size
        follows from the trees)."""
        ship(spark)
        tables = spark.sparkContext.broadcast(LeafMasks(trees, self.base_margin, used))
        k = len(self.base_margin)
        names = [f"m{i}" for i in range(k)]

        @F.pandas_udf(", ".join(f"{n} double" for n in names))
        def margins(x: pd.DataFrame) -> pd.DataFrame:
            m = tables.value.margins([x.iloc[:, i].to_numpy(dtype=float) for i in range(x.shape[1])])
            return pd.DataFrame(dict(zip(names, m)))

        m = margins(F.struct(*[v.alias(f"x{i}") for i, v in enumerate(value)]))
        return F.transform(F.array(m), lambda s: F.array(*[s[n] for n in names]))[0]

    def _renumbered(self, place: dict[int, int]) -> "BoostModel":
        trees = [Tree(t.round, t.cls, {n: (place[s[0]], *s[1:]) for n, s in t.splits.items()}, t.leaves)
                 for t in self.trees]
        return BoostModel(self.params, len(place), self.base_margin, trees)

    def first_rounds(self, params: BoostParams) -> "BoostModel":
        """The model after ``params.num_round`` rounds."""
        trees = [t for t in self.trees if t.round < params.num_round]
        return BoostModel(params, self.num_features, self.base_margin, trees, [], self.features_col, self.feature_cols)

    def nodes(self, spark: SparkSession) -> DataFrame:
        """One row per node: (tree, round, class, node, is_leaf, feature,
        threshold, left, right, leaf_value, gain, cover)."""
        rows = [r for i, t in enumerate(self.trees) for r in t.rows(i)]
        return spark.createDataFrame(rows, NODE_SCHEMA)

    def history_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.history, "round int, set string, metric string, value double")

    # ---- persistence: node table as Parquet, metadata as one JSON row
    def meta(self) -> dict:
        return {"params": asdict(self.params), "num_features": self.num_features,
                "base_margin": self.base_margin, "features_col": self.features_col,
                "feature_cols": self.feature_cols, "num_trees": len(self.trees)}

    def save(self, spark: SparkSession, path: str, mode: str = "error") -> None:
        self.nodes(spark).coalesce(1).write.mode(mode).parquet(f"{path}/nodes")
        spark.createDataFrame([(json.dumps(self.meta()),)], "meta string") \
            .coalesce(1).write.mode(mode).text(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "BoostModel":
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        n_trees = meta["num_trees"]
        # the node table is bounded by rounds * classes * 2^(depth+1)
        rows = spark.read.parquet(f"{path}/nodes").collect()
        trees = [None] * n_trees
        for r in rows:
            t = trees[r["tree"]]
            if t is None:
                t = trees[r["tree"]] = Tree(r["round"], r["class"])
            if r["is_leaf"]:
                t.leaves[r["node"]] = (r["leaf_value"], r["cover"])
            else:
                t.splits[r["node"]] = (r["feature"], -1, r["threshold"], r["gain"], r["cover"], r["default_left"])
        return BoostModel(BoostParams(**meta["params"]), meta["num_features"], meta["base_margin"],
                          trees, [], meta["features_col"], meta["feature_cols"])


# ------------------------------------------------------------------ trainer
@dataclass
class Prepared:
    """Quantised pages shared by fits, plus the bin edges."""
    state: DataFrame
    edges: list[list[float]]
    n_feat: int
    parts: int

    def bins(self) -> Bins:
        return Bins(self.edges)

    def release(self) -> None:
        self.state.unpersist()


def page_frame(spark: SparkSession, state: RDD) -> DataFrame:
    """The records of an RDD of pages as a DataFrame."""
    return spark.createDataFrame(state, pages.PAGE_SCHEMA, verifySchema=False)


def state_rows(state: DataFrame, n_feat: int, point: int = 0, classes: int = 1) -> DataFrame:
    """``set, rid, y, m``: the rows of pages with the margins of one grid point."""
    def rows(batches):
        return pages.rows_of(batches, n_feat, point * classes, classes)
    return state.mapInArrow(rows, pages.ROW_SCHEMA)


def grid_growths(points: list[BoostParams]) -> tuple[list[BoostParams], list[int]]:
    """The models to grow for parameter points, and each point's place among them: points
    that differ in their number of rounds only are one model, read after several rounds."""
    if any(p.num_round < 1 for p in points):
        raise ValueError("grid points need one round at least")
    growths: list[BoostParams] = []
    known: dict[str, int] = {}
    at = []
    for p in points:
        i = known.setdefault(repr(p.replace(num_round=0)), len(growths))
        if i == len(growths):
            growths.append(p)
        elif p.num_round > growths[i].num_round:
            growths[i] = p
        at.append(i)
    return growths, at


class BoostTrainer:
    """Fit a ``BoostModel``.  Features come from a vector / array column
    (``features_col``) or a list of numeric columns (``feature_cols``)."""

    def __init__(self, params: BoostParams | None = None, features_col: str = "features",
                 label_col: str = "label", feature_cols: list[str] | None = None,
                 id_col: str | None = None, metric: Metric | StateMetric | str | None = None,
                 num_features: int | None = None):
        self.params = (params or BoostParams()).validate()
        self.features_col = features_col
        self.label_col = label_col
        self.feature_cols = feature_cols
        self.id_col = id_col
        # known width (e.g. the feature_cols list) saves a look at the first row
        self.num_features = num_features or (len(feature_cols) if feature_cols else None)
        m = metric or self.params.eval_metric or default_metric(self.params.objective)
        self.metric = METRICS[m] if isinstance(m, str) and m != "auc" else m

    # -- helpers
    def _reader(self) -> BoostModel:
        return BoostModel(self.params, 0, [], [], [], self.features_col, self.feature_cols)

    def _x(self, df: DataFrame) -> Column:
        return self._reader()._x(df)

    @property
    def _sparse(self) -> bool:
        return self.params.missing == 0.0

    def _width(self, df: DataFrame) -> int:
        if self.num_features:
            return self.num_features
        dt = None if self.feature_cols else df.schema[self.features_col].dataType
        if dt is None or isinstance(dt, ArrayType):
            size = F.size(self._x(df))
        else:
            v = F.unwrap_udt(self.features_col)
            size = F.coalesce(v["size"], F.size(v["values"]))
        return df.select(size).first()[0]  # one value

    def _values(self, df: DataFrame) -> DataFrame:
        """``f, v``: the values present."""
        missing = self.params.missing
        if self._sparse:
            ind, val = self._reader()._entries(df)
            t = df.select(F.arrays_zip(F.coalesce(ind, F.sequence(F.lit(0), F.size(val) - 1)).alias("f"),
                                       val.alias("v")).alias("e"))
            values = t.select(F.inline("e").alias("f", "v"))
        else:
            values = df.select(F.posexplode(self._x(df)).alias("f", "v"))
        values = values.select("f", F.col("v").cast("double").alias("v"))
        values = values.where(F.col("v").isNotNull() & ~F.isnan("v"))
        return values if missing is None else values.where(F.col("v") != missing)

    def _edges(self, values: DataFrame, n_feat: int) -> list[list[float]]:
        """Bin edges per feature over its present values ``f, v`` (no NaN, no NULL).

        With at most ``max_bins`` distinct values every value but the least is an
        edge, however rare it is.  Otherwise the edges are the quantiles, the
        value after each one that fills several of them, and the maximum.
        Features are aggregated by key, so their sketches spread over tasks."""
        bins = self.params.max_bins
        qs = [i / bins for i in range(1, bins)]
        # sketch accuracy sized to the bins needed (relative rank error 1/(16 bins)),
        # which keeps the per-task sketch small even with many features
        acc = max(256, 16 * bins)
        # bounded: one row per feature
        rows = values.groupBy("f").agg(
            F.array_distinct(F.percentile_approx("v", qs, acc)).alias("q"), F.min("v").alias("lo"),
            F.max("v").alias("hi"), F.approx_count_distinct("v").alias("d")).collect()
        edges: list[list[float]] = [[] for _ in range(n_feat)]
        for r in rows:
            edges[r["f"]] = sorted({v for v in [*r["q"], r["hi"]] if v > r["lo"]})
        # the estimate is within a few per cent: twice the bins cannot miss a candidate;
        # a feature with one value has no edge
        few = [r["f"] for r in rows if r["d"] <= 2 * bins and r["lo"] < r["hi"]]
        if few:
            if len(few) < n_feat and len(few) <= FEATURES_BY_LITERAL:
                values = values.where(F.col("f").isin(few))
            elif len(few) < n_feat:
                chosen = values.sparkSession.createDataFrame([(f,) for f in few], "f int")
                values = values.join(chosen, "f", "left_semi")
            # bounded: features x about 2 * max_bins distinct values
            exact: dict[int, list[float]] = {f: [] for f in few}
            for r in values.distinct().collect():
                exact[r["f"]].append(r["v"])
            for f, vals in exact.items():
                if len(vals) <= bins:
                    edges[f] = sorted(vals)[1:]
        return edges

    def bin_edges(self, df: DataFrame) -> list[list[float]]:
        """The bin edges that ``prepare`` would choose on ``df``, by feature."""
        return self._edges(self._values(df), self._width(df))

    def _base_margin(self, params: BoostParams | None = None) -> list[float]:
        p = params or self.params
        k = p.classes()
        if p.objective.startswith("binary:"):
            b = min(max(p.base_score, 1e-12), 1 - 1e-12)
            return [math.log(b / (1 - b))]
        if p.objective.startswith("multi:"):
            return [0.0] * k
        return [p.base_score]

    def prepare(self, df: DataFrame, watches: dict[str, DataFrame] | None = None,
                set_col: Column | None = None,
                edge_sets: tuple[str, ...] | None = None) -> "Prepared":
        """Quantise the rows once: one quantile pass, one pass that writes pages,
        one reliable checkpoint.  Rows are tagged ``set`` = "train" (or the
        value of ``set_col``) and, for each watch frame, its name.  Several
        fits (a parameter grid) can share the result.  ``edge_sets``: only rows
        of these sets choose the bin edges (default: all but watch rows).
        Subsampling takes rows by ``id_col``, which it therefore needs."""
        if self.params.subsample < 1.0 and self.id_col is None:
            raise ValueError("subsample < 1 needs id_col: rows are sampled by a hash of it")
        spark = df.sparkSession
        shared_dir(spark)
        ship(spark)
        tagged = df.withColumn("_set", set_col if set_col is not None else F.lit("train"))
        n_feat = self._width(df)
        chosen = tagged if edge_sets is None else tagged.where(F.col("_set").isin(*edge_sets))
        edges = self._edges(self._values(chosen), n_feat)
        bins, sparse, missing = Bins(edges), self._sparse, self.params.missing

        def quantise(frame: DataFrame, tag: Column, with_id: bool) -> DataFrame:
            if sparse:
                ind, val = self._reader()._entries(frame)
                entries = [ind.alias("ind"), val.alias("val")]
            else:
                entries = [self._x(frame).alias("val")]  # a column of nulls would double the time of this step
            rid = F.xxhash64(self.id_col) if with_id and self.id_col else F.lit(0).cast("long")
            rows = frame.select(tag.alias("set"), rid.alias("rid"), F.col(self.label_col).cast("double").alias("y"),
                                *entries)

            def build(batches):
                return pages.build_pages(batches, bins, sparse, missing)
            return rows.mapInArrow(build, pages.PAGE_SCHEMA)

        state = quantise(tagged, F.col("_set"), True)
        for name, w in (watches or {}).items():
            state = state.unionByName(quantise(w, F.lit(name), False))
        # Pages in the shared folder: later plans start from a scan of them, and a
        # lost executor re-reads them instead of the source.
        state = state.checkpoint(eager=True)
        # A coalesced input (AQE merges small partitions; a single unsplittable
        # file) can arrive in very few partitions: its pages are spread once.
        parts = state.rdd.getNumPartitions()
        n_rows = state.agg(F.sum("n")).first()[0] or 0
        want = min(spark.sparkContext.defaultParallelism, max(1, math.ceil(n_rows / ROWS_PER_TASK)))
        if parts < want:
            state, parts = state.repartition(want), want
        else:
            # a task has its price in every level: no more of them than cores and rows ask for
            want = max(want, math.ceil(n_rows / MOST_ROWS_PER_TASK))
            if parts > want:
                state, parts = state.coalesce(want), want
        return Prepared(state, edges, n_feat, parts)

    def fit(self, df: DataFrame, watches: dict[str, DataFrame] | None = None) -> BoostModel:
        prep = self.prepare(df, watches)
        try:
            return self.fit_prepared(prep, track=bool(watches))
        finally:
            prep.release()

    def fit_grid(self, df: DataFrame, points: list[BoostParams]) -> list[BoostModel]:
        """The models of several parameter points on the same rows, grown in the same jobs."""
        growths, at = grid_growths(points)
        prep = self.prepare(df)
        try:
            models = self.fit_points(prep, growths)
        finally:
            prep.release()
        return [models[i].first_rounds(p) for p, i in zip(points, at)]

    def fit_prepared(self, prep: "Prepared", train_sets: tuple[str, ...] = ("train",),
                     track: bool = False, keep_state: bool = False):
        """Boost on prepared pages.  Rows whose ``set`` is in ``train_sets``
        grow the trees; every row's margin is updated, so the metric of every
        set can be tracked per round (``track``).  With ``keep_state`` the final
        (persisted) pages with margins are returned alongside the model;
        ``state_rows`` reads them."""
        kept = []

        def after(r: int, state: RDD, models: list[BoostModel]) -> None:
            models[0].history.extend(self._metrics(state, prep.n_feat, r))

        models = self.fit_points(prep, [self.params], train_sets, after if track else None,
                                 keep=kept if keep_state else None)
        return (models[0], kept[0]) if keep_state else models[0]

    def fit_points(self, prep: "Prepared", points: list[BoostParams], train_sets: tuple[str, ...] = ("train",),
                   after=None, after_rounds: set[int] | None = None, keep: list | None = None) -> list[BoostModel]:
        """Boost several parameter points on the same pages, all in the same jobs; a
        point stops at its own ``num_round``.  ``after(round, pages, models)`` is called
        after each round (or those in ``after_rounds``) with the margins up to date in the
        RDD of pages (``page_frame`` makes it a DataFrame)."""
        for p in points:
            p.validate()
        k = points[0].classes()
        if any(p.classes() != k for p in points):
            raise ValueError("points of one fit need the same number of classes")
        bins = prep.bins()
        base = np.array([v for p in points for v in self._base_margin(p)])
        models = [BoostModel(p, prep.n_feat, self._base_margin(p), [], [], self.features_col, self.feature_cols)
                  for p in points]
        total = max(p.num_round for p in points)
        # margins are needed after the last round only by ``after`` or ``keep``
        n_feat, with_id = prep.n_feat, keep is not None or any(p.subsample < 1.0 for p in points)

        def join(records):
            return pages.merged(records, n_feat, with_id)

        first = prep.state.rdd.map(tuple).mapPartitions(join).persist(StorageLevel.MEMORY_AND_DISK)
        state, held = first, None  # ``held``: the persisted pages before ``state``'s
        interval = self.params.checkpoint_interval
        for r in range(total):
            grown = self._grow(state, train_sets, bins, r, k, points, base, prep.parts)
            # the jobs above have materialised ``state``: its parent can go
            if held is not None:
                held.unpersist()
            held = None
            for i, m in enumerate(models):
                m.trees.extend(grown.get(i, []))
            call = after is not None and (after_rounds is None or r in after_rounds)
            if r + 1 == total and not call and keep is None:
                break
            update = [(i * k + t.cls, t.splits, t.leaves) for i, trees in grown.items() for t in trees]
            nxt = self._add(state, update, base, bins).persist(StorageLevel.MEMORY_AND_DISK)
            if interval and (r + 1) % interval == 0 and r + 1 < total:
                # cut lineage: reliable copy in the shared checkpoint folder, written after the next job
                nxt.checkpoint()
            state, held = nxt, state
            if call:
                after(r, state, models)
        if keep is not None:
            final = page_frame(prep.state.sparkSession, state).persist(StorageLevel.MEMORY_AND_DISK)
            final.count()
            keep.append(final)
        if held is not None:
            held.unpersist()
        state.unpersist()
        return models

    @staticmethod
    def _add(state: RDD, update: list[tuple], base: np.ndarray, bins: Bins) -> RDD:
        def add(records):
            return pages.add_trees(records, update, base, bins)
        return state.mapPartitions(add, preservesPartitioning=True)

    def _metrics(self, state: RDD, n_feat: int, r: int) -> list[tuple]:
        """The metric of every set after a round.  A metric that is a mean over rows is summed
        on the pages; others read the rows."""
        k = self.params.classes()
        if isinstance(self.metric, Metric) and self.metric.terms is not None and k == 1:
            return sorted((r, name, self.metric.name, v) for name, v in self._means(state, n_feat).items())
        rows = state_rows(page_frame(SparkSession.active(), state), n_feat, 0, k)
        if self.metric == "auc":
            from tabfit.operators.evaluate import auc
            if k > 1:
                raise ValueError("auc needs one score per row: choose another metric for multi-class")
            res = auc(rows.select("set", F.col("m")[0].alias("s"), "y"), "s", "y", ["set"]).collect()
            return sorted((r, row["set"], "auc", row["auc"]) for row in res)
        cols = scored_columns(self.params.objective, F.col("m"), k)
        pred = cols.get(self.metric.reads, cols["prediction"])
        if isinstance(self.metric, StateMetric):
            res = self.metric.by_set(rows, pred, F.col("y")).collect()
            return sorted((r, row["set"], self.metric.name, row["value"]) for row in res)
        res = rows.groupBy("set").agg(self.metric(pred, F.col("y")).alias("v")).collect()
        return sorted((r, row["set"], self.metric.name, row["v"]) for row in res)

    def _means(self, state: RDD, n_feat: int) -> dict[str, float]:
        metric, objective = self.metric, self.params.objective

        def fold(records):
            sums: dict[str, np.ndarray] = {}
            for record in records:
                page = pages.page_of(record, n_feat)
                score = pages.scores(objective, page.m[0], metric.reads)
                term = metric.terms(score, page.y)
                sums[record[0]] = sums.get(record[0], 0.0) + np.array([term.sum(), len(term)])
            return iter(sums.items())

        totals: dict[str, np.ndarray] = {}
        for name, part in state.mapPartitions(fold).collect():  # two numbers for each set and task
            totals[name] = totals.get(name, 0.0) + part
        return {name: metric.finish(*total) for name, total in totals.items()}

    def _best(self, state: RDD, sets: tuple[str, ...], level: Level, bins: Bins, points: list[BoostParams],
              parts: int) -> dict[int, dict]:
        """The best split of every open node of a level, by ``t``: one job."""
        width, classes = level.width, level.classes
        lam = [float(p.reg_lambda) for p in points]
        mcw = [float(p.min_child_weight) for p in points]

        def sums(records):
            return pages.histograms((x for x in records if x[0] in sets), level, bins)

        def search(records):
            return pages.best_splits(records, bins, width, classes, lam, mcw)

        nodes = sum(len(t.open) for t in level.trees)
        if parts == 1:
            # the task has all rows: its sums are the whole histogram
            best = state.mapPartitions(lambda records: search(sums(records))).collect()
        elif parts * nodes * int(bins.slot[-1]) <= COLLECTED_SLOTS:
            # a few megabytes however many rows there are: a second stage would cost more
            best = search(state.mapPartitions(sums).collect())
        else:
            # one shuffle by node; a node's histogram is bounded by the features' bins
            best = state.mapPartitions(sums).partitionBy(min(parts, nodes)).mapPartitions(search).collect()
        return {row[0]: dict(zip(pages.BEST_FIELDS, row)) for row in best}  # one record per open node

    def _grow(self, state: RDD, sets: tuple[str, ...], bins: Bins, r: int, k: int, points: list[BoostParams],
              base: np.ndarray, parts: int) -> dict[int, list[Tree]]:
        """One tree per class of every point that still grows, level by level (one job per level)."""
        active = [i for i, p in enumerate(points) if r < p.num_round]
        width = (1 << (max(points[i].max_depth for i in active) + 1)) - 1
        ids = [i * k + c for i in active for c in range(k)]
        splits: dict[int, dict[int, tuple]] = {t: {} for t in ids}
        leaves: dict[int, dict[int, tuple]] = {t: {} for t in ids}
        # node -> (G, H); the sums of the root come with its split
        opened: dict[int, dict[int, tuple[float, float] | None]] = {t: {0: None} for t in ids}

        def leaf(t: int, n: int, G: float, H: float) -> None:
            p = points[t // k]
            leaves[t][n] = (p.eta * (-G / (H + p.reg_lambda)), H)

        for d in range(max(points[i].max_depth for i in active) + 1):
            level = Level(width, r, k, [base[i * k:(i + 1) * k] for i in range(len(points))],
                          [p.objective for p in points], [p.seed for p in points], [p.subsample for p in points])
            for t in ids:
                if d >= points[t // k].max_depth and d > 0:
                    # the last level only holds leaves, whose sums came with their parent's split
                    for n, (G, H) in opened[t].items():
                        leaf(t, n, G, H)
                    opened[t] = {}
                if opened[t]:
                    level.trees.append(Growing(t, splits[t], np.array(sorted(opened[t]), dtype=np.int64)))
            if not level.trees:
                break
            found = self._best(state, sets, level, bins, points, parts)
            for g in level.trees:
                t, p, nxt = g.tree, points[g.tree // k], {}
                for n, sums in opened[t].items():
                    row = found.get(t * width + n)
                    if row is None:  # no rows in this round's sample
                        leaf(t, n, *(sums or (0.0, 0.0)))
                    elif p.max_depth > d and row["gain"] is not None and row["gain"] > max(p.gamma, MIN_GAIN):
                        f, b = row["f"], row["bin"]
                        edges = bins.of(f)
                        # a cut after the last bin parts the values present from the missing
                        thr = float(edges[b]) if b < len(edges) else math.inf
                        splits[t][n] = (f, b, thr, row["gain"], row["Ht"], row["default_left"])
                        nxt[2 * n + 1] = (row["GL"], row["HL"])
                        nxt[2 * n + 2] = (row["GR"], row["HR"])
                    else:
                        leaf(t, n, row["Gt"], row["Ht"])
                opened[t] = nxt
        return {i: [Tree(r, c, splits[i * k + c], leaves[i * k + c]) for c in range(k)] for i in active}
