"""Readers: metadata JSON lines, Parquet, whole texts, archives, listings."""

from __future__ import annotations

import io
import tarfile
import uuid
from collections.abc import Iterable
from urllib.parse import urlsplit

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage
from ..plans import schema as tables


def metadata(spark: SparkSession, path: str, schema: T.StructType = tables.METADATA, fail_fast: bool = True) -> DataFrame:
    """JSON lines; a malformed line fails the job unless told otherwise."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if fail_fast else "PERMISSIVE").json(path)


def peek(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).limit(1)


def whole_text(spark: SparkSession, path: str) -> DataFrame:
    """path and value of whole files."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")


def listing(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Paths below a folder that match a pattern; file contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path).select("path", "length")


def archives(spark: SparkSession, path: str, pattern: str = "*.tar.gz") -> DataFrame:
    """path, members and has_tex of archives; unsafe member names are left out, unreadable archives have status error."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path).select("path", "content")

    def run(frames):
        for f in frames:
            rows = []
            for p, raw in zip(f["path"], f["content"], strict=True):
                try:
                    with tarfile.open(fileobj=io.BytesIO(raw), mode="r:*") as tar:
                        names = [m.name for m in tar.getmembers() if m.isfile() and not m.name.startswith("/") and ".." not in m.name.split("/")]
                    rows.append((p, names, any(n.endswith(".tex") for n in names), "ok"))
                except Exception as e:
                    rows.append((p, None, None, f"error: {e}"))
            yield pd.DataFrame(rows, columns=["path", "members", "has_tex", "status"])

    return files.mapInPandas(run, "path string, members array<string>, has_tex boolean, status string")


def extract(spark: SparkSession, path: str, target: str, pattern: str = "*.tar.gz") -> DataFrame:
    """path, folder, n_files, has_tex and status of archives whose files are written to <target>/<name>/.

    An archive's name is its path below the given one without the pattern's suffix;
    slashes (and percent signs) of deeper paths are percent-escaped, so each archive
    has a folder of its own.  Each is written by one task, file by file in pieces,
    under names of its own and then moved, so a repeated task leaves the same files.
    Unsafe member names are left out.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path).select("path", "content")
    hpath, hfs = storage.file_system(spark, path)
    above = hfs.makeQualified(hpath).toUri().getPath().rstrip("/") + "/"
    suffix = pattern[1:] if pattern.startswith("*") and not set(pattern[1:]) & set("*?[{") else ""

    def run(frames):
        fs, at = store(target)
        for f in frames:
            rows = []
            for p, raw in zip(f["path"], f["content"], strict=True):
                folder, n, tex = f"{at}/{archive_name(p, above, suffix)}", 0, False
                try:
                    with tarfile.open(fileobj=io.BytesIO(raw), mode="r:*") as tar:
                        for m in tar:
                            if m.isfile() and not m.name.startswith("/") and ".." not in m.name.split("/"):
                                member = tar.extractfile(m)
                                put(fs, f"{folder}/{m.name}", iter(lambda member=member: member.read(PIECE), b""))
                                n, tex = n + 1, tex or m.name.endswith(".tex")
                    rows.append((p, folder, n, tex, "ok"))
                except Exception as e:
                    rows.append((p, None, n, None, f"error: {e}"))
            yield pd.DataFrame(rows, columns=["path", "folder", "n_files", "has_tex", "status"])

    return files.mapInPandas(run, "path string, folder string, n_files int, has_tex boolean, status string")


PIECE = 1 << 20


def archive_name(path: str, above: str, suffix: str) -> str:
    """An archive's path below a folder, without its suffix, as one name; the bare file name where it is not below it."""
    plain = urlsplit(path).path
    name = plain.removeprefix(above) if plain.startswith(above) else plain.rsplit("/", 1)[-1]
    return name.removesuffix(suffix).replace("%", "%25").replace("/", "%2F")


def store(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path for code on executors; any scheme that pyarrow knows."""
    return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def put(fs: pafs.FileSystem, at: str, body: bytes | Iterable[bytes]) -> None:
    """Writes a file, whole or in pieces, beside its place, then moves it there; each attempt has a name of its own."""
    fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
    tmp = f"{at}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(tmp, compression=None) as out:
        for piece in [body] if isinstance(body, bytes) else body:
            out.write(piece)
    try:
        fs.move(tmp, at)
    except OSError:  # some stores do not move onto the file of an earlier attempt
        fs.delete_file(at)
        fs.move(tmp, at)


def finished(spark: SparkSession, folder: str, suffix: str = ".md") -> DataFrame:
    """Ids (file stems) whose last artefact is there."""
    return listing(spark, folder, f"*{suffix}").select(F.regexp_extract("path", r"([^/]+)" + suffix.replace(".", r"\.") + "$", 1).alias("arxiv_id")).distinct()


def table_exists(spark: SparkSession, name: str) -> bool:
    if not name.isidentifier():
        raise ValueError(f"not a table name: {name!r}")
    return spark.catalog.tableExists(name)


def pages_of(files: DataFrame, load, max_pages: int | None = None, dpi: int = 192) -> DataFrame:
    """path, page (from 0) and image of documents; load gives render(bytes, dpi) -> images, once a task."""

    def run(frames):
        render = load()
        for f in frames:
            rows = [(p, k, im) for p, raw in zip(f["path"], f["content"], strict=True) for k, im in enumerate(render(raw, dpi)[:max_pages])]
            yield pd.DataFrame(rows, columns=["path", "page", "image"])

    return files.select("path", "content").mapInPandas(run, "path string, page int, image binary")
