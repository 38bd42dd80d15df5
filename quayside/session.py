"""Session and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime settings the operators count on: hot keys of joins are split, also
# where that costs a later step its partitioning.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Rows of one batch that goes to a Python worker. The batch is held three times, as Arrow by the
# executor and the worker and as objects, so its size in bytes must not follow the length of the texts.
TEXT_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500"}

#: Rows of a few numbers that are sent to every executor; beyond, the join shuffles.
BROADCAST_ROWS = 2_000_000

_LOCAL_DIRS: dict[str, str] = {}
#: What was written inside the open scopes, the innermost last.
_SCOPES: list[list[str]] = []


def build_session(app: str = "quayside", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library relies on; `conf` keys use `__` for dots."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **ADAPTIVE,
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def tune(spark: SparkSession) -> None:
    """Apply the runtime settings to a session built elsewhere."""
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)


def tune_texts(spark: SparkSession) -> None:
    """`tune`, and small batches for steps that send whole texts to Python workers."""
    tune(spark)
    for key, value in TEXT_BATCH.items():
        spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder: `spark.checkpoint.dir`.

    Only a local-mode session without that setting gets a temporary folder of
    its own; on a cluster a machine-local folder would not be readable by the
    other executors, so the setting is required there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="quayside-")
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never reused between calls."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Remove what is written to the shared folder inside, at the end.

    Results are lazy and read those intermediates, so write or collect them
    inside. Without a scope the intermediates stay with the shared folder.
    """
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def materialise(df: DataFrame, name: str = "step") -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Used where one expensive intermediate feeds several jobs: the written
    table survives the loss of executors and is computed once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame) -> DataFrame:
    """A written table of a few numbers a row, sent to every executor where it has at most BROADCAST_ROWS rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df
