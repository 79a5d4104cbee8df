"""Folders that the driver and all executors reach, one for each piece of work."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


class NoSharedFolderError(RuntimeError):
    """spark.checkpoint.dir is unset, so there is no folder that all executors share."""


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, or the one given to setCheckpointDir.

    Where neither is set, a temporary one if the driver is its own only executor; on a cluster that is an error.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise NoSharedFolderError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="sparkloom-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(at)
    return at


class Scratch:
    """A folder of its own in the shared one, for the tables of one run. It goes as a whole, and nothing else with it."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path = spark, f"{shared_folder(spark)}/sparkloom-{uuid.uuid4().hex}"

    def new(self) -> str:
        """A path inside that nothing has."""
        return f"{self.path}/{uuid.uuid4().hex}"

    def land(self, df: DataFrame, *by: str) -> DataFrame:
        """df written as a Parquet table inside, in folders by some columns if they are named, and read again: computed once, and there however many executors are lost."""
        at = self.new()
        (df.write.partitionBy(*by) if by else df.write).parquet(at)
        return df.sparkSession.read.schema(df.schema).parquet(at)

    def remove(self, path: str | None = None) -> None:
        """The folder, or one path inside, once nothing reads it any more."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path or self.path)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.remove()
