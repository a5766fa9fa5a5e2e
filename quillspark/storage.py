"""Folders that driver and executors share, and tables written there."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def root(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, a local session (as in tests) takes a temporary folder and any other the warehouse."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return "file://" + tempfile.gettempdir()
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def file_system(spark: SparkSession, path: str):
    """The path as Hadoop's, and its file system."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared one; it goes when the driver's JVM ends."""
    path = f"{root(spark)}/quillspark-queries/{name}-{uuid.uuid4().hex}"
    hpath, fs = file_system(spark, path)
    fs.mkdirs(hpath)
    fs.deleteOnExit(hpath)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    hpath, fs = file_system(spark, path)
    return fs.exists(hpath)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files in a folder."""
    hpath, fs = file_system(spark, path)
    return fs.getContentSummary(hpath).getLength()


def delete(spark: SparkSession, path: str) -> None:
    hpath, fs = file_system(spark, path)
    fs.delete(hpath, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, whatever reads them, and safe from lost executors."""
    path = folder(df.sparkSession, name) + "/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def once(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table at a path, which is made and written only if no earlier run has written it whole."""
    if not exists(spark, f"{path}/_SUCCESS"):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
