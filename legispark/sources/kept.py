"""Tables between steps, in the folder that spark.checkpoint.dir names: they cut the lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def kept_path(spark: SparkSession, name: str = "kept") -> str:
    """A new path in that folder. In local mode a local one is set where the setting is unset, else that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-kept-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str = "kept") -> DataFrame:
    """df as a written table."""
    path = kept_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def removed(df: DataFrame) -> None:
    """Removes a table that nothing reads any more."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_to)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
