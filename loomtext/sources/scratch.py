"""Written intermediate tables: they cut lineage and outlive lost executors."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting to delete shuffle files at the end of an execution.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only in local mode where none is configured."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="loomtext-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


class Scratch:
    """Written intermediate tables of one run.

    Results read from them lazily, so the folder stays until the application ends and is removed then.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/loomtext-{uuid.uuid4().hex}"
        top, fs = self._open(self.root)
        fs.mkdirs(top)
        fs.deleteOnExit(top)

    def _open(self, path: str):
        top = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return top, top.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table and read it again; Spark deletes the shuffle files behind it once it is written."""
        before = self.spark.conf.get(CLEANUP, None)
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.mode("overwrite").parquet(self.path(name))
        finally:
            if before is None:
                self.spark.conf.unset(CLEANUP)
            else:
                self.spark.conf.set(CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Remove a table that no later step reads."""
        path, fs = self._open(self.path(name))
        fs.delete(path, True)


def durable(spark: SparkSession) -> Callable[[DataFrame], DataFrame]:
    """A function that writes a table under a name of its own and reads it back, for the rounds of a search."""
    scratch, count = Scratch(spark), iter(range(1 << 30))
    return lambda df: scratch.put(df, f"round-{next(count)}")
