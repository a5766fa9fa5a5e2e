"""Media columns of progressive JPEGs.

``write_media`` stores each text's bytes, filled with bytes 255 to a positive
multiple of UNIT, losslessly as the coefficients of a progressive JPEG;
``read_media`` accumulates the scans of stored files into coefficient arrays and
gives the payload back; ``tensors`` also inverse-transforms, upsamples chroma
and gives full-resolution RGB tensors.  Files are handled in batches of about
BATCH bytes, so a task holds a few of them at a time; a longer one is a batch of
its own.

Nulls are empty texts (a payload of UNIT bytes 255).  Equal texts give equal
files, tensors and features.
"""

from __future__ import annotations

from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import jpeg, scan
from .work import lean, one_text

UNIT = 576
BATCH = 1 << 21


def padded(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = np.diff(offs)
    whole = np.maximum(1, -(-size // UNIT)) * UNIT
    edge = np.concatenate([[0], np.cumsum(whole)])
    out = np.full(int(edge[-1]), 255, np.uint8)
    out[scan.segment_positions(edge[:-1], size)] = data
    return out, edge


def write_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media (a JPEG file) of each row."""

    def run(batches):
        for b in batches:
            doc = b.column(0).cast(pa.int64())
            data, offs = scan.view(scan.text_column(b))
            for i, j in scan.chunks(data, offs, BATCH):
                files = jpeg.store(*padded(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]))
                yield pa.RecordBatch.from_arrays([doc.slice(i, j - i), pa.array(np.diff(offs[i : j + 1])), pa.array(files, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return one_text(docs).mapInArrow(lean(run), "doc_id long, n_bytes long, media binary")


def _batches(b: pa.RecordBatch):
    """(first, past, files) of about BATCH bytes each."""
    files = b.column(b.schema.get_field_index("media"))
    i, n = 0, len(files)
    while i < n:
        j, size, got = i, 0, []
        while j < n and (not got or size < BATCH):
            got.append(files[j].as_py())
            size += len(got[-1])
            j += 1
        yield i, j, got
        i = j


def read_media(media: DataFrame) -> DataFrame:
    """doc_id, n_bytes and payload of each row, from the coefficients of its file."""

    def run(batches):
        for b in batches:
            for i, j, files in _batches(b):
                part = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["n_bytes"], pa.array(jpeg.load(*jpeg.decode(files)), pa.binary())], names=["doc_id", "n_bytes", "payload"])

    return media.select("doc_id", "n_bytes", "media").mapInArrow(lean(run), "doc_id long, n_bytes long, payload binary")


def tensors(media: DataFrame) -> DataFrame:
    """doc_id, height, width and rgb (bytes, row by row, three a pixel) of each row."""

    def run(batches):
        for b in batches:
            for i, j, files in _batches(b):
                got = jpeg.tensors(*jpeg.decode(files))
                yield pa.RecordBatch.from_arrays([b["doc_id"].slice(i, j - i), pa.array([t.shape[0] for t in got], pa.int32()), pa.array([t.shape[1] for t in got], pa.int32()), pa.array([t.tobytes() for t in got], pa.binary())], names=["doc_id", "height", "width", "rgb"])

    return media.select("doc_id", "media").mapInArrow(lean(run), "doc_id long, height int, width int, rgb binary")


def features(media: DataFrame) -> DataFrame:
    """Digests of what is read back, and a feature of the RGB tensor: its size, channel sums and crc32."""
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kinds = [None, None, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches):
        for b in batches:
            for i, j, files in _batches(b):
                part = b.slice(i, j - i)
                coef, images = jpeg.decode(files)
                rows = []
                for raw, payload, rgb in zip(files, jpeg.load(coef, images), jpeg.tensors(coef, images), strict=True):
                    sums = rgb.reshape(-1, 3).sum(axis=0, dtype=np.int64).tolist()
                    feature = f"{rgb.shape[1]}x{rgb.shape[0]}:{sums[0]}:{sums[1]}:{sums[2]}:{crc32(rgb):08x}"
                    rows.append((len(payload), sha256(payload).hexdigest(), crc32(payload[-32:]), len(raw), sha256(raw).hexdigest(), feature))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["n_bytes"], *(pa.array(c, k) for c, k in zip(cols, kinds[2:], strict=True))], names=names)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(lean(run), "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
