"""Session helpers.

Library functions never create a session; they take DataFrames. These
helpers exist for tests, the bench and the command-line entry points.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library relies on. ANSI stays on (Spark 4 default); the
# transforms use try_* functions wherever the input may be malformed.
LIBRARY_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "trendflow") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TRENDFLOW_DRIVER_MEM", "8g"))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in LIBRARY_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is. Only when it is unset (local tests) a scratch folder is made.
    The folder is registered once; later calls return the same one.
    """
    sc = spark.sparkContext
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="trendflow-ckpt-")
    sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, where it is not installed on them: the
    operators whose tasks run Python import it there."""
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="trendflow-ship-")  # the driver's own; Spark serves the file
    archive = os.path.join(folder, "trendflow.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for at, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(at, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)


#: Session setting: Spark deletes the shuffle files of a query at its end.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_tidy_lock = threading.Lock()
#: Per session, how many writes are on, and its own setting.
_tidy: dict[int, tuple[int, str | None]] = {}


@contextmanager
def tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries planned inside leave no shuffle files behind: otherwise those of
    all writes of a run stay until the driver happens to collect garbage. Writes
    run side by side; once the last one is out, the session's own setting holds again."""
    session = spark._jsparkSession.hashCode()
    with _tidy_lock:
        n, own = _tidy.get(session) or (0, spark.conf.get(TIDY, None))
        spark.conf.set(TIDY, "true")
        _tidy[session] = (n + 1, own)
    try:
        yield
    finally:
        with _tidy_lock:
            n, own = _tidy.pop(session)
            if n > 1:
                _tidy[session] = (n - 1, own)
            elif own is None:
                spark.conf.unset(TIDY)
            else:
                spark.conf.set(TIDY, own)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder (never machine-local
    on a cluster, because the checkpoint folder is shared storage there)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
