"""Shared working folders, their files, and Arrow helpers for the operators."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def work_root(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    spark.checkpoint.dir names it.  Where that is unset, a local session (as in
    tests) uses a temporary folder and any other one the warehouse folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local":
        return "file://" + tempfile.gettempdir()
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


_scopes: list[list[str]] = []


@contextlib.contextmanager
def freed(spark: SparkSession):
    """Removes the folders that are made inside when it ends: for results that are written elsewhere by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder's path in the shared folder; removed when its scope or the driver's JVM ends."""
    path = f"{work_root(spark)}/quillspark/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hpath)
    fs.deleteOnExit(hpath)
    if _scopes:
        _scopes[-1].append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, name) + "/table"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def store(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path for Python code on executors; any scheme that pyarrow knows."""
    fs, at = pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return fs, at


def put_file(path: str, parts, attempt: str) -> None:
    """Write a file under an attempt's own name, then move it: a repeated task replaces it with equal bytes."""
    fs, at = store(path)
    tmp = f"{at}.{attempt}.tmp"
    with fs.open_output_stream(tmp) as out:
        for x in parts:
            out.write(x)
    try:
        fs.move(tmp, at)
    except OSError:  # some stores do not move onto the file of an earlier attempt
        fs.delete_file(at)
        fs.move(tmp, at)


def attempt_name() -> str:
    return uuid.uuid4().hex


def one_text(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text (null: empty) and more columns, whatever else the table holds."""
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def carried(keep: tuple[str, ...], own: tuple[str, ...]) -> tuple[list[Column], dict[str, str]]:
    """Columns to carry under names that clash with none, and what each is called in the end: one that is named like an own column gets _in added."""
    taken, names = {*own, *keep}, {}
    for k, c in enumerate(keep):
        name = c
        while name in own or name != c and name in taken:
            name += "_in"
        taken.add(name)
        names[f"_keep_{k}"] = name
    return [F.col(c).alias(k) for k, c in zip(names, keep, strict=True)], names


def text_bytes(docs: DataFrame, column: str | Column = "text") -> int:
    """All bytes of a text column."""
    got = docs.agg(F.sum(F.octet_length(column)).alias("n")).first()
    return int(got["n"] or 0)


def parts_for(spark: SparkSession, amount: int, each: int) -> int:
    """How many partitions of about each units an amount needs; never fewer than the session's cores on larger inputs."""
    n = -(-amount // each)
    return max(1, n if amount < each else max(n, min(spark.sparkContext.defaultParallelism, -(-amount // (each // 8)))))


_kept: dict = {}


def kept(key, make):
    """This process's own object for a key, from an earlier task or made now.  It keeps one: another key's takes its place."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def release(keep: bool = False) -> None:
    """Give freed memory back: workers live on after a task and would hold its peak.  keep: the kept object stays."""
    if not keep:
        _kept.clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def lean(run, keep: bool = False):
    """A function of batches that releases memory when it ends, all but the kept object if told so."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release(keep)

    return wrapped
