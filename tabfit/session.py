"""Session and shared-folder helpers.

Everything that must survive executor loss (checkpoints, staged text files,
saved models written by catalogue queries) goes below the folder the cluster
names in ``spark.checkpoint.dir``.  Only when the session has no such folder
(unit tests, a laptop) do we create one of our own.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_OWN_DIR_CONF = "spark.tabfit.ownCheckpointDir"


# Settings for a large cluster (e.g. 1000 executors, ~100 TB of input).  Spark
# starts from many shuffle partitions and AQE coalesces them to the advisory
# size, so partitions stay near 256 MB whatever the stage; skewed join
# partitions (a key holding a third of the rows) are split; file splits are
# 256 MB so a task's input fits comfortably in executor memory.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", app: str = "tabfit",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """A session with the settings the library assumes (AQE on, UTC, no UI)."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         # per-round training checkpoints are deleted once no longer referenced
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.driver.memory", "16g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The reliable shared folder for this application.

    Reads ``spark.checkpoint.dir`` (or a directory already given to
    ``SparkContext.setCheckpointDir``).  If neither is set a ``local[...]``
    session makes a scratch folder and registers it; a cluster session fails.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(d)
        return d.rstrip("/")
    existing = sc.getCheckpointDir()
    if existing:
        # setCheckpointDir appends a per-application uuid folder; use its parent.
        return existing.rstrip("/").rsplit("/", 1)[0]
    if not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = spark.conf.get(_OWN_DIR_CONF, None)
    if not own:
        own = tempfile.mkdtemp(prefix="tabfit-ckpt-")
        spark.conf.set(_OWN_DIR_CONF, own)
    sc.setCheckpointDir(own)
    return own


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder (never reused)."""
    base = shared_dir(spark)
    return f"{base}/tabfit-staging/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers.  Does nothing where
    ``PYTHONPATH`` has its folder already; else a zip of it goes to the shared
    folder, once per application, and Spark hands it to the executors."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
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
