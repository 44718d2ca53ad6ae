"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of characters other than space and the five ASCII line and
#: tab controls; every operator of this subpackage uses the same ones.
SPACES = r"[\x20\x09-\x0D]+"
_LOCAL: dict[str, str] = {}


def words(text: Column) -> Column:
    """Array of the words of a text; empty for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES, -1), "")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a session whose executors live in the driver's own process
    (``local[n]``, as in tests) may go without the setting; there a temporary
    folder of this process serves.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _LOCAL.setdefault("root", tempfile.mkdtemp(prefix="trendflow-scratch-"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared scratch folder."""
    return f"{scratch_root(spark)}/trendflow-llm/{name}-{uuid.uuid4().hex}"


#: Session setting: Spark deletes the shuffle files of a query at its end.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str, *, tidy: bool = True, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet to shared scratch and read it back.

    Cuts lineage with files that survive the loss of any executor; the
    reread has exact sizes, so later joins are planned on them. ``tidy`` has
    the write's shuffle files deleted at its end; the session's own setting
    holds again afterwards.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(TIDY, None)
    if tidy:
        spark.conf.set(TIDY, "true")
        df = df.select("*")  # planned under the setting
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        if tidy and before is None:
            spark.conf.unset(TIDY)
        elif tidy:
            spark.conf.set(TIDY, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing reads any more, i.e. once
    all that was derived from them is itself written."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(conf).delete(path, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
