"""Fetching with an injected transport: retries, pauses, one status a row."""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Callable
from urllib.parse import quote

import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import readers


def with_retry(call: Callable, attempts: int = 3, least: float = 2.0, most: float = 10.0, errors=(OSError,), sleep=time.sleep):
    """call(), again after a growing pause; the last error is raised."""
    for k in range(attempts):
        try:
            return call()
        except errors:
            if k + 1 == attempts:
                raise
            sleep(min(most, max(least, 2.0 * 2**k)))


def next_turn(now: float, pause: float, part: int, parts: int, last: float) -> float:
    """When a task may call next: time is cut into slots of one pause, a slot belongs to one task, and a task calls once in a slot."""
    slot = math.floor(now / pause) + 1
    slot = max(slot, math.floor(last / pause) + 1)
    return (slot + (part - slot) % parts) * pause


def fetch(queue: DataFrame, load: Callable, key: str = "arxiv_id", pause: float = 3.0, parts: int = 1, attempts: int = 3, wait: tuple[float, float] = (2.0, 10.0)) -> DataFrame:
    """key, path and status of each row.  load: once a task, gives get(key) -> path.  parts: how many tasks may fetch at once.

    All tasks together make one call a pause, retries too: slots of the clock are
    dealt to them in turn.  Each get is tried so often, with pauses that grow from the
    least to the most wait.
    """
    kind = dict(queue.dtypes)[key]

    def run(frames):
        get, part, last = load(), TaskContext.get().partitionId(), 0.0

        def in_turn(k):
            nonlocal last
            if pause:
                last = next_turn(time.time(), pause, part, parts, last)
                time.sleep(max(0.0, last - time.time()))
            return get(k)

        for f in frames:
            rows = []
            for k in f[key]:
                try:
                    rows.append((k, with_retry(lambda k=k: in_turn(k), attempts, *wait), "ok"))
                except Exception as e:
                    rows.append((k, None, f"failed: {e}"))
            yield pd.DataFrame(rows, columns=[key, "path", "status"])

    return queue.select(key).repartition(parts).mapInPandas(run, f"{key} {kind}, path string, status string")


def to_store(load: Callable, target: str, suffix: str = ".tar.gz") -> Callable:
    """A loader for fetch of a transport's loader: files are streamed to <target>/<key><suffix>.

    load: once a task, gives open(key, offset) -> pieces of bytes from there on.  What
    has come stays in the store as parts, so a call after a failure, by this task or
    another, asks for the rest; the file is put in place when it is whole.
    """

    def loader():
        open_at = load()
        fs, at = readers.store(target)

        def get(key):
            folder = f"{at}/.parts/{quote(str(key), safe='')}"
            fs.create_dir(folder, recursive=True)
            have = _parts(fs, folder)
            offset = sum(size for _, size in have)
            with fs.open_output_stream(f"{folder}/{offset:020d}.{uuid.uuid4().hex}", compression=None) as out:
                for piece in open_at(key, offset):
                    out.write(piece)
            readers.put(fs, f"{at}/{key}{suffix}", (piece for path, _ in _parts(fs, folder) for piece in _pieces(fs, path)))
            fs.delete_dir(folder)
            return f"{target.rstrip('/')}/{key}{suffix}"

        return get

    return loader


def _parts(fs: pafs.FileSystem, folder: str) -> list[tuple[str, int]]:
    """Path and size of the parts that follow on each other from the start; of several that begin alike the longest."""
    found: dict[int, tuple[str, int]] = {}
    for info in fs.get_file_info(pafs.FileSelector(folder)):
        start = int(info.base_name.split(".")[0])
        if info.size and info.size > found.get(start, ("", 0))[1]:
            found[start] = (info.path, info.size)
    out, at = [], 0
    while at in found:
        out.append(found[at])
        at += found[at][1]
    return out


def _pieces(fs: pafs.FileSystem, path: str):
    with fs.open_input_stream(path, compression=None) as f:
        while piece := f.read(readers.PIECE):
            yield piece


def pending(subset: DataFrame, local: DataFrame, key: str = "arxiv_id") -> DataFrame:
    """Rows without a fetched file; rows that repeat stay."""
    return subset.join(local.where("pdf_path is not null").select(key), key, "left_anti")


def keyword(topic: str | None, table: str) -> str:
    return topic or table


def paths_for_keyword(local: DataFrame, topic: str, key: str = "arxiv_id") -> DataFrame:
    """Key and path of the fetched documents of one topic, so that a shared folder's other topics stay out."""
    return local.where((F.col("keyword_for_ocr") == topic) & F.col("pdf_path").isNotNull()).select(key, "pdf_path")


def extraction_queue(local: DataFrame) -> DataFrame:
    return local.where("latex_source_path is not null and latex_extracted = false").select("arxiv_id", "latex_source_path")


def extraction_status(results: DataFrame) -> DataFrame:
    """OK, NOTEX or FAIL; only OK counts as extracted."""
    return results.withColumn("outcome", F.when(F.col("status") != "ok", "FAIL").when(F.col("has_tex"), "OK").otherwise("NOTEX"))
