"""Session defaults, and the shared folder that intermediate tables go to."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a batch of rows that goes to a Python worker, unless one row has more.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20

_LOCAL_DIRS: dict[str, str] = {}
_SHREDDING = threading.Lock()
_WITHIN: list[int] = []
_BEFORE: list[str] = []


def build_session(app_name: str = "questlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects; ``conf`` uses ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def share_code(spark: SparkSession) -> None:
    """Let Python workers import the library from the folder that the driver has it from, wherever
    the session was started. Where executors have other file systems, install it there."""
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if here not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [here, known]))


def bound_batches(spark: SparkSession) -> None:
    """Let Python workers get rows in batches of a few MB; Spark's own bound, of 64 MB, is about a whole
    split of texts, which each worker and the JVM beside it keep in memory several times. Spark reads
    it when a job starts, so it stays set for the session; a value that the session has is left."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may leave it unset; it then gets a temporary folder. On a
    cluster an unset value is an error, as a machine-local folder is lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="questlake-")
    return _LOCAL_DIRS[app]


def new_dir(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shredded_variants(spark: SparkSession) -> Iterator[None]:
    """Within it, parquet writes store the common paths of variants as typed columns. A scan
    then reads the paths a query extracts and not whole documents. Jobs of one session may be in it
    at the same time: the setting is put back when the last one leaves."""
    name = "spark.sql.variant.inferShreddingSchema"
    with _SHREDDING:
        if not _WITHIN:
            _BEFORE.append(spark.conf.get(name))
            spark.conf.set(name, "true")
        _WITHIN.append(1)
    try:
        yield
    finally:
        with _SHREDDING:
            _WITHIN.pop()
            if not _WITHIN:
                spark.conf.set(name, _BEFORE.pop())


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage in a way that survives lost executors, and freezes values that depend on
    how rows were placed. The files stay until the folder's owner removes them, as Spark's
    own checkpoints do.
    """
    spark = df.sparkSession
    path = new_dir(spark, name)
    with shredded_variants(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
