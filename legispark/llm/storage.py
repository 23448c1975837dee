"""Where operators keep tables and files that every executor must see."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, a new local one is set in local mode, else it is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def reachable(spark: SparkSession) -> None:
    """Workers import this package from where the driver does, whatever folder the driver was started in."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *known])


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI that every executor can reach."""
    return pafs.FileSystem.from_uri(uri)


#: The setting by which Spark removes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a written table: cuts the lineage, and survives lost executors; the shuffle files behind it go at once."""
    spark = df.sparkSession
    path = fresh(spark, name)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def removed(df: DataFrame) -> None:
    """Removes a written table that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.written_to)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
