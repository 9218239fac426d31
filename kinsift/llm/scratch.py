"""Intermediate tables in the folder that all executors share.

The folder is the session's ``spark.checkpoint.dir``.  Where that is unset, a local session (tests on one
machine) gets a temporary folder, and on a cluster it is an error.  Tables are Parquet with zstd; reading them
back cuts the lineage, so a lost executor costs at most the stage that reads or writes one of them.  An
operator's tables go when its results can't be read any more: when the driver's JVM ends.
"""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder's URI."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="kinsift-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Scratch:
    """Tables of one operator run, below ``<shared folder>/kinsift-<uuid>``."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{shared_dir(spark)}/kinsift-{uuid.uuid4().hex}"
        system, path = self._system()
        system.mkdirs(path)
        system.deleteOnExit(path)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Writes df and returns it as read back."""
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def _system(self, name: str = ""):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name) if name else self.root)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def drop(self, name: str = "") -> None:
        """Deletes one table, or all."""
        system, path = self._system(name)
        system.delete(path, True)

    def release(self) -> None:
        """Lets Spark's cleaner remove the shuffle files of plans that nothing refers to any more."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()
