"""Tables that a computation writes on its way, in the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; a temporary one only where none is set and all run on this machine (tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        at = known.get() if known.isDefined() else None
    if not at and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not at:
        at = tempfile.mkdtemp(prefix="larkspur-")
        atexit.register(shutil.rmtree, at, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def _on_disk(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read again: the lineage ends there, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/larkspur/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    system, at = _on_disk(spark, path)
    system.deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out._larkspur_path = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes a table that written() made and nothing reads any more."""
    if path := getattr(df, "_larkspur_path", None):
        system, at = _on_disk(df.sparkSession, path)
        system.delete(at, True)
