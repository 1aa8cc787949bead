"""Tables written to the cluster's shared folder between the steps of a job.

Writing a step as Parquet cuts its lineage: a lost executor costs a reread,
not a recomputation, and a step that several others use runs once.
"""

from __future__ import annotations

import atexit
import contextlib
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where that is unset (as in tests) a local one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("on a cluster, spark.checkpoint.dir must name a folder that all executors share")
        key = spark.sparkContext.applicationId
        if key not in _own:
            _own[key] = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        root = _own[key]
    return root.rstrip("/")


class Scratch:
    """A folder of one job's intermediate tables; removed when Python ends, or earlier with drop()."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.names = spark, set()
        self.root = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
        atexit.register(self.drop)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write df once and return the reread table."""
        path = f"{self.root}/{name}"
        self.names.add(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        with contextlib.suppress(Exception):  # the session may be gone
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        """Let Spark remove the shuffle files of steps whose tables are written; they go when their plans are collected as garbage."""
        gc.collect()
        self.spark._jvm.System.gc()

    def drop_all_but(self, *names: str) -> None:
        for name in self.names - set(names):
            self.drop(name)
