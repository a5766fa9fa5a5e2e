"""Best-two-fit packing of token pieces into sequences.

A document's ids plus a separator are cut into pieces of at most the sequence
length.  Pieces are dealt evenly to groups of a bounded size; each group is
packed on its own, which costs at most about one open sequence a group.  In a
group a sequence is filled greedily with the longest piece that fits; then, if
it holds more than one piece, its smallest is taken out and replaced by the two
unpacked pieces that fit the expanded gap more tightly, if there are such.

Nulls are empty texts: a piece of the separator alone.  Rows with repeated or
missing ids are packed like any other, an empty table gives no row, and other
columns are not read.  A text is never cut before it is encoded: a worker holds
some 60 times the bytes of the longest one.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe, scan
from .work import lean, one_text, written

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, deal long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
#: Pieces that a packing task gets, about.
GROUP = 50_000


def cut_pieces(docs: DataFrame, vocabulary: str | None = None, length: int = 2048, separator: int = 0) -> DataFrame:
    """One row a piece; deal spreads pieces evenly whatever their keys."""
    path = vocabulary or bpe.default_path()

    def run(batches):
        encoder = bpe.Encoder.kept(path)
        task, row = TaskContext.get().partitionId(), 0
        for b in batches:
            doc = b.column(0).cast(pa.int64())
            data, offs = scan.view(scan.text_column(b))
            for i, j, ids, edge in encoder.encode(data, offs):
                total = np.diff(edge) + 1
                flat = np.full(len(ids) + j - i, separator, "<u4")
                keep = np.ones(len(flat), bool)
                keep[edge[1:] + np.arange(j - i)] = False
                flat[keep] = ids
                pieces = -(-total // length)
                of = np.repeat(np.arange(j - i), pieces)
                k = scan.segment_positions(np.zeros(j - i, np.int64), pieces)
                start = k * length
                size = np.minimum(total[of] - start, length)
                at = (edge[:-1] + np.arange(j - i))[of] + start
                raw = memoryview(flat.tobytes())
                crc = [crc32(raw[4 * a : 4 * z]) for a, z in zip(at.tolist(), (at + size).tolist(), strict=True)]
                deal = scan.mix(np.arange(row, row + len(of), dtype=np.uint64) + (np.uint64(task) << np.uint64(40)))
                row += len(of)
                yield pa.RecordBatch.from_arrays(
                    [doc.slice(i, j - i).take(pa.array(of)), pa.array(k.astype(np.int32)), pa.array(start), pa.array(size), pa.array(crc, pa.int64()), pa.array((deal >> np.uint64(1)).astype(np.int64))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "deal"],
                )

    return one_text(docs).mapInArrow(lean(run, keep=True), PIECES)


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each length, and the number of bins.  Lengths are 1 to capacity; equal ones go in their order."""
    order = np.argsort(lengths, kind="stable")
    edge = np.searchsorted(lengths[order], np.arange(capacity + 2))
    left = np.diff(edge)  # left[x]: unpacked pieces of length x
    place = edge[1:].copy()  # the next piece of length x is order[place[x] - 1]
    have = np.flatnonzero(left).tolist()
    bins = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    ar = np.arange(capacity + 1)
    floor = np.maximum.accumulate(np.where(left > 0, ar, 0))  # longest unpacked length up to x
    stale = False
    n = 0

    def take(x):
        nonlocal stale
        left[x] -= 1
        if not left[x]:
            del have[bisect_left(have, x)]
            stale = True

    while have:
        chosen, gap = [], capacity
        while have and have[0] <= gap:
            x = have[bisect_right(have, gap) - 1]
            times = min(int(left[x]), gap // x) if x * 2 <= gap else 1
            for _ in range(times):
                take(x)
                chosen.append(x)
            gap -= x * times
        if gap and len(chosen) > 1 and have:
            small = chosen[-1]
            room = gap + small
            if stale:
                floor = np.maximum.accumulate(np.where(left > 0, ar, 0))
                stale = False
            hi = bisect_left(have, room)
            if hi:
                a = np.array(have[:hi])
                b = floor[np.minimum(room - a, a)]
                twice = (b == a) & (left[a] < 2)
                if twice.any():
                    b[twice] = floor[a[twice] - 1]
                both = np.where(b > 0, a + b, 0)
                best = int(both.argmax())
                if both[best] > small:
                    if not left[small]:
                        insort(have, small)
                    left[small] += 1
                    stale = True
                    chosen.pop()
                    for x in (int(a[best]), int(b[best])):
                        take(x)
                        chosen.append(x)
        at = 0
        for x in chosen:
            place[x] -= 1
            k = order[place[x]]
            bins[k], offset[k] = n, at
            at += x
        n += 1
    return bins, offset, n


def pack(pieces: DataFrame, length: int = 2048, group: int = GROUP) -> DataFrame:
    """Places written pieces into sequences."""
    spark, total = pieces.sparkSession, pieces.count()
    groups = max(1, -(-total // group))

    def run(key, pdf):
        pdf = pdf.sort_values(["length", "deal"], ignore_index=True)
        bins, offset, _ = best_two_fit(pdf["length"].to_numpy(), length)
        return pdf.assign(sequence_id=bins + (int(key[0]) << 32), offset=offset)[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    dealt = pieces.withColumn("packing_group", F.pmod("deal", F.lit(groups)))
    return dealt.groupBy("packing_group").applyInPandas(run, PACKED)


def pack_documents(docs: DataFrame, vocabulary: str | None = None, length: int = 2048, separator: int = 0, group: int = GROUP) -> DataFrame:
    return pack(written(cut_pieces(docs, vocabulary, length, separator), "pieces"), length, group)
