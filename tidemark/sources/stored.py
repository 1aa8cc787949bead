"""Tables written once to the cluster's shared folder, so that what reads them again finds the same rows."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a local one where it is unset and all executors are local."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("on a cluster, spark.checkpoint.dir must name a folder that all executors share")
    return _own.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="tidemark-"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet and read again: a lost executor costs a reread.  The files go when Python ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(remove, spark, path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, most: int = 200_000) -> DataFrame:
    """df in tasks of about most rows each, as many as the executors have cores at least.

    Files are read in pieces of equal bytes, which hold millions of narrow rows; a tree fit keeps some hundred bytes of each.  The shuffle
    files also serve every pass of a fit, so that df is computed once, after a count.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // most))
    return df.repartition(tasks, F.monotonically_increasing_id())


def remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may be gone
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
