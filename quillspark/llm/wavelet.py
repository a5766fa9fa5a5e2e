"""Token ids in wavelet matrices: one compressed file a shard.

A file holds one bit-plane a bit of the ids, from the highest, each stably
partitioned by the bit before it.  Planes are cut into blocks of BLOCK bits,
compressed one by one; an index gives the place of each block and the ones
before it.  Rank and select on single blocks give access, counting and
occurrence lookup without reading more of the file than a block or two a plane;
reversing the partitions gives the whole sequence back.

Documents are in ascending order of (doc_id, hash of the text); nulls first,
null texts as empty ones (the end id alone).  Rows that repeat an id stand side
by side, each as a document of its own.  An empty table writes no file; other
columns are not read.  A text is never cut: a worker holds some 60 times the
bytes of the longest one.
"""

from __future__ import annotations

import json
import struct
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe, scan
from .work import attempt_name, lean, new_folder, one_text, parts_for, put_file, store, text_bytes, written

MAGIC, BLOCK = b"QWM2", 1 << 15
#: A file is closed once it has so many tokens.
SHARD_TOKENS = 2_000_000
#: Bytes of text that a writing task gets, about.
TASK = 16 << 20
#: Writing tasks whose sizes are summed together.
TASKS = 4096


class WaveletMatrix:
    """block(k, b): packed bits (lowest first) of block b of the k-th highest bit's plane; ones[k]: set bits before each block, and all; zeros[k]: how many bits are 0."""

    def __init__(self, n: int, zeros: list[int], ones: np.ndarray, block):
        self.n, self.zeros, self.levels, self.ones, self.block = n, zeros, len(zeros), ones, block

    @classmethod
    def build(cls, ids: np.ndarray, levels: int) -> "WaveletMatrix":
        x = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        step = BLOCK // 8
        blocks = -(-len(x) // BLOCK)
        planes, zeros, ones = [], [], np.zeros((levels, blocks + 1), np.int64)
        for k in range(levels - 1, -1, -1):
            bit = (x >> k) & 1 > 0
            plane = np.packbits(bit, bitorder="little")
            if blocks:
                each = np.add.reduceat(np.bitwise_count(plane), np.arange(0, len(plane), step), dtype=np.int64)
                np.cumsum(each, out=ones[len(planes), 1:])
            low = x[~bit]
            planes.append(plane)
            zeros.append(len(low))
            x = np.concatenate([low, x[bit]])
        return cls(len(ids), zeros, ones, lambda k, b: planes[k][b * step : (b + 1) * step])

    def decode(self) -> np.ndarray:
        """The whole sequence."""
        x = np.zeros(self.n, np.uint16 if self.levels <= 16 else np.uint32)
        blocks = self.ones.shape[1] - 1
        for k in range(self.levels - 1, -1, -1):
            plane = np.concatenate([self.block(k, b) for b in range(blocks)]) if blocks else np.zeros(0, np.uint8)
            bit = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            up = np.empty_like(x)
            up[~bit] = x[: self.zeros[k]]
            up[bit] = x[self.zeros[k] :] | x.dtype.type(1 << (self.levels - 1 - k))
            x = up
        return x.astype("<u4")

    def rank1(self, k: int, i: int) -> int:
        """Ones among the first i bits of plane k."""
        b, rest = divmod(i, BLOCK)
        total = int(self.ones[k, b])
        if rest:
            got = self.block(k, b)
            total += int(np.bitwise_count(got[: rest // 8]).sum())
            if rest % 8:
                total += (int(got[rest // 8]) & ((1 << (rest % 8)) - 1)).bit_count()
        return total

    def bit(self, k: int, i: int) -> int:
        b, rest = divmod(i, BLOCK)
        return int(self.block(k, b)[rest // 8]) >> (rest % 8) & 1

    def select(self, k: int, which: int, nth: int) -> int:
        """Where the nth (from 0) bit of that value stands in plane k."""
        ones = self.ones[k]
        before = ones if which else np.minimum(np.arange(len(ones)) * BLOCK, self.n) - ones
        b = int(np.searchsorted(before, nth, "right")) - 1
        bits = np.unpackbits(self.block(k, b), count=min(BLOCK, self.n - b * BLOCK), bitorder="little")
        return b * BLOCK + int(np.flatnonzero(bits == which)[nth - int(before[b])])

    def access(self, i: int) -> int:
        """The token at a place."""
        out = 0
        for k in range(self.levels):
            b, r = self.bit(k, i), self.rank1(k, i)
            out = out << 1 | b
            i = self.zeros[k] + r if b else i - r
        return out

    def _range(self, token: int, past: int) -> tuple[int, int]:
        a, z = 0, past
        for k in range(self.levels):
            ra, rz = self.rank1(k, a), self.rank1(k, z)
            a, z = (self.zeros[k] + ra, self.zeros[k] + rz) if token >> (self.levels - 1 - k) & 1 else (a - ra, z - rz)
        return a, z

    def count(self, token: int, past: int | None = None) -> int:
        """How often a token stands before a place."""
        if token >> self.levels:
            return 0
        a, z = self._range(token, self.n if past is None else past)
        return z - a

    def locate(self, token: int, nth: int) -> int:
        """Where its nth (from 0) occurrence stands."""
        if not 0 <= nth < self.count(token):
            raise IndexError("the token does not stand there so often")
        i = self._range(token, self.n)[0] + nth
        for k in range(self.levels - 1, -1, -1):
            b = token >> (self.levels - 1 - k) & 1
            i = self.select(k, b, i - self.zeros[k] if b else i)
        return i

    def to_bytes(self, doc_ids: pa.Array, edge: np.ndarray) -> list[bytes]:
        """The parts of a file.  doc_ids: of the documents, may hold nulls; edge: where each starts, and the end."""
        pack = zstandard.ZstdCompressor(level=1).compress
        none = np.asarray(doc_ids.is_null()).astype(np.uint8)
        docs = [np.diff(edge).astype("<i8"), np.asarray(doc_ids.fill_null(0)).astype("<i8"), none]
        docs = [pack(x.tobytes()) for x in docs]
        body = []
        for k in range(self.levels):
            for b in range(self.ones.shape[1] - 1):
                raw = self.block(k, b).tobytes()
                small = pack(raw)
                body.append(small if len(small) < len(raw) else raw)
        index = np.array([len(x) for x in body], "<i4").tobytes() + self.ones.astype("<i8").tobytes()
        head = json.dumps({"n": self.n, "levels": self.levels, "zeros": self.zeros, "docs": [len(x) for x in docs], "index": len(index)}).encode()
        return [MAGIC, struct.pack("<I", len(head)), head, index, *docs, *body]


class WaveletFile(WaveletMatrix):
    """A written matrix.  read(place, size) gives bytes of the file; of the planes only blocks that are asked for are read."""

    def __init__(self, read):
        if read(0, 4) != MAGIC:
            raise ValueError("not a wavelet matrix file")
        (size,) = struct.unpack("<I", read(4, 4))
        head = json.loads(read(8, size))
        levels, blocks = head["levels"], -(-head["n"] // BLOCK)
        index = read(8 + size, head["index"])
        length = np.frombuffer(index, "<i4", levels * blocks).astype(np.int64)
        ones = np.frombuffer(index, "<i8", levels * (blocks + 1), 4 * levels * blocks).reshape(levels, blocks + 1)
        self._docs, self._docs_at, self._read = head["docs"], 8 + size + head["index"], read
        place = self._docs_at + sum(self._docs) + np.cumsum(length) - length
        unpack = zstandard.ZstdDecompressor().decompress

        def block(k, b):
            at = k * blocks + b
            raw = read(int(place[at]), int(length[at]))
            whole = -(-min(BLOCK, head["n"] - b * BLOCK) // 8)
            return np.frombuffer(raw if len(raw) == whole else unpack(raw), np.uint8)

        super().__init__(head["n"], head["zeros"], ones, lru_cache(4 * max(levels, 1))(block))

    @classmethod
    def open(cls, path: str) -> "WaveletFile":
        """For lookups: reads the places that are needed."""
        fs, at = store(path)
        f = fs.open_input_file(at)
        return cls(lambda place, size: f.read_at(size, place))

    @classmethod
    def whole(cls, path: str) -> "WaveletFile":
        """For decoding: reads the file once."""
        fs, at = store(path)
        with fs.open_input_stream(at, compression=None) as f:
            raw = f.read()
        return cls(lambda place, size: raw[place : place + size])

    def documents(self) -> tuple[pa.Array, np.ndarray]:
        """Ids of the documents, and where each starts, with the end."""
        at, got = self._docs_at, []
        for size in self._docs:
            got.append(zstandard.ZstdDecompressor().decompress(self._read(at, size)))
            at += size
        edge = np.concatenate([[0], np.cumsum(np.frombuffer(got[0], "<i8"))])
        return pa.array(np.frombuffer(got[1], "<i8"), mask=np.frombuffer(got[2], np.uint8) > 0), edge


MANIFEST = "part int, shard int, path string, part_start long, n_tokens long, n_docs long, file_bytes long"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write_shards(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = 1, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Writes the files and returns their manifest, itself a written table: one row a file."""
    path = vocabulary or bpe.default_path()
    spark = docs.sparkSession
    rows = one_text(docs).withColumn("tie", F.xxhash64("text"))
    parts = parts_for(spark, text_bytes(docs), TASK)
    rows = rows.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")

    def run(batches):
        encoder = bpe.Encoder.kept(path)
        levels = int(encoder.lib.n_ids - 1).bit_length()
        part = TaskContext.get().partitionId()
        held, sizes, names, n, shard, before = [], [], [], 0, 0, 0

        def flush():
            nonlocal n, shard, before
            ids = np.concatenate(held)
            edge = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            docs = pa.concat_arrays(names)
            held.clear(), sizes.clear(), names.clear()
            raw = WaveletMatrix.build(ids, levels).to_bytes(docs, edge)
            at = f"{folder}/part-{part:06d}-{shard:06d}.qwm"
            put_file(at, raw, attempt_name())
            row = pa.RecordBatch.from_pylist([{"part": part, "shard": shard, "path": at, "part_start": before, "n_tokens": n, "n_docs": len(docs), "file_bytes": sum(map(len, raw))}], schema=pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("path", pa.string()), ("part_start", pa.int64()), ("n_tokens", pa.int64()), ("n_docs", pa.int64()), ("file_bytes", pa.int64())]))
            before, shard, n = before + n, shard + 1, 0
            return row

        for b in batches:
            doc = b.column(0).cast(pa.int64())
            data, offs = scan.view(scan.text_column(b))
            for i, j, ids, edge in encoder.encode(data, offs):
                flat = np.full(len(ids) + j - i, end_id, np.uint32)
                keep = np.ones(len(flat), bool)
                keep[edge[1:] + np.arange(j - i)] = False
                flat[keep] = ids
                held.append(flat)
                sizes.append(np.diff(edge) + 1)
                names.append(doc.slice(i, j - i))
                n += len(flat)
                if n >= shard_tokens:
                    yield flush()
        if names:
            yield flush()

    return written(rows.mapInArrow(lean(run, keep=True), MANIFEST), "wavelet-manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest and base: tokens of all parts before.  Sums over TASKS parts at a time, so no task sees a row of each part."""
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("chunk", F.floor(F.col("part") / F.lit(TASKS)))
    earlier = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chunks = parts.groupBy("chunk").agg(F.sum("n").alias("n")).select("chunk", earlier(Window.orderBy("chunk")).alias("chunk_base"))
    base = parts.withColumn("in_chunk", earlier(Window.partitionBy("chunk").orderBy("part"))).join(chunks, "chunk")
    return manifest.join(base.select("part", (F.col("chunk_base") + F.col("in_chunk")).alias("base")), "part")


def read_shards(manifest: DataFrame) -> DataFrame:
    """Per document: start over all files, token count and crc32 of the ids, decoded from the files."""

    def run(batches):
        for b in batches:
            for path, start in zip(b["path"].to_pylist(), b["start"].to_pylist(), strict=True):
                matrix = WaveletFile.whole(path)
                docs, edge = matrix.documents()
                raw = memoryview(matrix.decode()).cast("B")
                at = (4 * edge).tolist()
                crc = [crc32(raw[a:z]) for a, z in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([docs, pa.array(edge[:-1] + start), pa.array(np.diff(edge)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = manifest.count()
    spread = with_starts(manifest).select("path", (F.col("base") + F.col("part_start")).alias("start"))
    spread = spread.repartition(max(1, min(files, 4 * max(manifest.sparkSession.sparkContext.defaultParallelism, files // 32))))
    return spread.mapInArrow(lean(run), ROWS)


def occurrences(manifest: DataFrame, token: int) -> DataFrame:
    """path, n and first (place in its file, null if none) of a token in each file, from a few blocks of it."""

    def run(batches):
        for b in batches:
            got = []
            for path in b["path"].to_pylist():
                f = WaveletFile.open(path)
                n = f.count(token)
                got.append({"path": path, "n": n, "first": f.locate(token, 0) if n else None})
            yield pa.RecordBatch.from_pylist(got, schema=pa.schema([("path", pa.string()), ("n", pa.int64()), ("first", pa.int64())]))

    return manifest.select("path").mapInArrow(run, "path string, n long, first long")


def binary_output(docs: DataFrame, vocabulary: str | None = None, end_id: int = 1, folder: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    folder = folder or new_folder(docs.sparkSession, "wavelet")
    return read_shards(write_shards(docs, folder, vocabulary, end_id, shard_tokens))
