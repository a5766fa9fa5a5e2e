"""Substring dedup by prefix-partitioned suffix trees.

Every word position starts a suffix.  Nodes at least ``width`` words deep that
more than one document reaches are repeats; suffixes are kept to a depth of
twice that.

1. Words that make up a large share of the corpus are counted (all texts).
2. Suffixes whose window cannot repeat are set aside: of each window the
   smallest 6-word gram hash is taken, and a gram found in one document only
   rules out all its windows.
3. Each bucket of texts sorts its other suffixes word by word and, by the common
   prefixes of neighbours, cuts its own tree at depth ``width``: one entry a
   node.  For maximal repeats it has the words of its path down to where its
   suffixes part; for the dedup nodes whose windows follow one another are sent
   as one stretch of words.  So a
   passage that fills a third of all documents gives a group no more entries
   than there are buckets.
4. Entries are split by prefixes.  Stretches go by the smallest gram of the
   first ``width`` words, or by all of these where that gram is hot; entries of
   maximal repeats by the words up to and with the first that is not frequent.  So each prefix is rare, and a hash deals
   prefixes to groups that fit in memory.
5. A group sorts the entries of all buckets word by word.  Common prefixes of
   neighbours give the subtree's internal nodes: runs with at least ``width``
   words in common, as deep as all their suffixes agree; where the words before
   differ too, the node is a maximal repeat.  The smallest doc_id below a node
   goes back to the buckets that hold later documents.
6. The buckets mark the covered words, comparing windows word by word.

Words are compared as words: hashes only choose candidates, groups and places
to look.  Groups get their entries in passes of at most FAN parts, so bodies
stay large, and few, however many buckets and groups there are.

Nulls are empty texts.  Rows without doc_id are kept whole and remove nothing.
Rows that share a doc_id do not remove each other's words; rows equal in doc_id
and text share a bucket.  An empty table gives none.  A text is never cut: a
worker holds some 20 times the bytes of a bucket or of the longest text.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import scan
from .work import carried, lean, one_text, parts_for, release, text_bytes, written

GRAM = 6
#: Bytes of text in a bucket, about; a worker holds some 20 times as much.
BUCKET = 3 << 20
#: A worker reports words with at least this share of its own words.
LEAST_SHARE = 1 / 65536
#: Frequent words are found for so many groups; for more, prefixes take further words.
MOST_GROUPS = 4096
#: Parts that a body is split into at once.
FAN = 512
#: Bytes of bodies that are merged before a further split.
MERGE = 4 << 20
#: A gram that is the smallest of more windows than this is no prefix by itself.
HOT = 1 << 14
#: Windows of a stretch; longer ones are sent as several.
LONGEST = 1 << 12

_BODIES = "to long, body binary"
_SCHEMA = pa.schema([("to", pa.int64()), ("body", pa.binary())])


class Run:
    """Rows of fixed columns; ``sizes`` and ``codes`` give each row words of a dictionary (-1: none)."""

    def __init__(self, cols: dict[str, np.ndarray], sizes=None, codes=None, words=None):
        self.cols, self.sizes, self.codes, self.words = cols, sizes, codes, words

    def __len__(self) -> int:
        return len(self.cols["to"])

    def take(self, at: np.ndarray) -> "Run":
        cols = {k: v[at] for k, v in self.cols.items()}
        if self.sizes is None:
            return Run(cols)
        first = np.cumsum(self.sizes) - self.sizes
        return Run(cols, self.sizes[at], self.codes[scan.segment_positions(first[at], self.sizes[at])], self.words)

    def pack(self) -> bytes:
        parts = [np.array([len(self), self.sizes is not None], "<i8").tobytes()]
        parts += [v.tobytes() for _, v in sorted(self.cols.items())]
        if self.sizes is not None:
            used, local = np.unique(self.codes, return_inverse=True)
            used = used[used >= 0]
            local = local - (len(self.codes) and self.codes.min() < 0)
            kind = "<i2" if len(used) < 1 << 15 else "<i4"
            words = self.words.take(pa.array(used))
            data, offs = scan.view(words.cast(pa.large_binary()))
            parts += [self.sizes.astype("<i2").tobytes(), np.array([len(self.codes), len(used)], "<i8").tobytes(), np.diff(offs).astype("<i4").tobytes(), local.astype(kind).tobytes(), data.tobytes()]
        return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))

    @classmethod
    def unpack(cls, body: bytes, kinds: dict[str, str]) -> "Run":
        raw, at = zstandard.ZstdDecompressor().decompress(body), 0

        def column(kind, n):
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out

        n, ragged = column("<i8", 2).tolist()
        cols = {k: column(kinds[k], n) for k in sorted(kinds)}
        if not ragged:
            return cls(cols)
        sizes = column("<i2", n).astype(np.int64)
        total, used = column("<i8", 2).tolist()
        length = column("<i4", used)
        codes = column("<i2" if used < 1 << 15 else "<i4", total).astype(np.int32)
        offs = np.concatenate([[0], np.cumsum(length, dtype=np.int64)])
        return cls(cols, sizes, codes, pa.LargeBinaryArray.from_buffers(pa.large_binary(), used, [None, pa.py_buffer(offs), pa.py_buffer(raw[at:])]))

    @classmethod
    def joined(cls, runs: list["Run"], kinds: dict[str, str]) -> "Run":
        """All rows, with one dictionary."""
        cols = {k: np.concatenate([r.cols[k] for r in runs]) if runs else np.zeros(0, kinds[k]) for k in kinds}
        if not runs or runs[0].sizes is None:
            return cls(cols)
        both = pa.chunked_array([r.words for r in runs]).combine_chunks().dictionary_encode()
        code = np.append(np.asarray(both.indices), -1).astype(np.int32)
        base = np.cumsum([0, *(len(r.words) for r in runs)])
        codes = np.concatenate([code[np.where(r.codes < 0, len(code) - 1, r.codes + b)] for r, b in zip(runs, base.tolist(), strict=False)])
        return cls(cols, np.concatenate([r.sizes for r in runs]), codes, both.dictionary)

    def matrix(self, columns: int) -> np.ndarray:
        """The codes, one column of words after another; -1 past a row's words."""
        out = np.full((len(self), columns), -1, np.int32)
        of = np.repeat(np.arange(len(self)), self.sizes)
        out[of, scan.segment_positions(np.zeros(len(self), np.int64), self.sizes)] = self.codes
        return np.ascontiguousarray(out.T)


def _bodies(run: Run, step: int) -> pa.RecordBatch:
    """One body for each value of to // step."""
    part = run.cols["to"] // step
    order = np.argsort(part, kind="stable")
    edge = np.flatnonzero(np.diff(part[order], prepend=-1)).tolist() + [len(order)]
    to = [int(part[order[a]]) for a in edge[:-1]]
    return pa.RecordBatch.from_arrays([pa.array(to, pa.int64()), pa.array([run.take(order[a:z]).pack() for a, z in zip(edge[:-1], edge[1:], strict=True)], pa.binary())], schema=_SCHEMA)


def steps_for(count: int) -> list[int]:
    """What ``to`` is divided by in each pass, for count values of it."""
    passes = max(1, math.ceil(math.log(max(count, 2)) / math.log(FAN)))
    fan = math.ceil(max(count, 2) ** (1 / passes))
    return [fan**k for k in range(passes - 1, -1, -1)]


def further(bodies: DataFrame, kinds: dict[str, str], count: int) -> DataFrame:
    """Splits bodies until each is for one value of ``to``."""
    steps = steps_for(count)

    def split(batches, step):
        held, size, last = [], 0, None
        for b in batches:
            for to, body in zip(b["to"].to_pylist(), b["body"].to_pylist(), strict=True):
                if held and (to != last or size > MERGE):
                    yield _bodies(Run.joined(held, kinds), step)
                    held, size = [], 0
                run = Run.unpack(body, kinds)
                held.append(run)
                size, last = size + sum(c.nbytes for c in run.cols.values()), to
        if held:
            yield _bodies(Run.joined(held, kinds), step)

    parts = int(bodies.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for before, step in zip(steps[:-1], steps[1:], strict=True):
        salt = F.pmod(F.xxhash64("body"), F.lit(-(-parts // -(-count // before))))
        bodies = bodies.repartition(parts, "to", salt).sortWithinPartitions("to").mapInArrow(lean(partial(split, step=step)), _BODIES)
    return bodies


def frequent_words(docs: DataFrame, groups: int) -> np.ndarray:
    """Hashes of the words with a share of at least 1 / (4 * groups); at most so many."""

    def run(batches):
        held, total = [], 0

        def counted(parts):
            keys = np.concatenate([p[0] for p in parts])
            n = np.concatenate([p[1] for p in parts])
            keys, inv = np.unique(keys, return_inverse=True)
            return keys, np.bincount(inv, n).astype(np.int64)

        for b in batches:
            data, offs = scan.view(scan.text_column(b))
            for i, j in scan.chunks(data, offs):
                part, o = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
                starts, ends, _ = scan.words(part, o)
                total += len(starts)
                keys, n = np.unique(scan.span_hash(part, starts, ends), return_counts=True)
                some = n >= len(starts) * LEAST_SHARE / 2
                held.append((keys[some], n[some]))
                if len(held) >= 16:
                    held = [counted(held)]
        if held:
            keys, n = counted(held)
            some = n >= total * LEAST_SHARE
            yield pa.RecordBatch.from_arrays([pa.array(np.append(keys[some].view(np.int64), 0)), pa.array(np.append(n[some], 0)), pa.array(np.append(np.zeros(int(some.sum()), np.int64), total))], names=["word", "n", "total"])

    seen = docs.select("text").mapInArrow(lean(run), "word long, n long, total long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    seen = written(seen, "frequent-words")
    total = seen.agg(F.sum("total").alias("n")).first()["n"] or 0
    rows = seen.where(F.col("n") * (4 * groups) >= F.lit(total)).where("n > 0").select("word").collect()
    return np.sort(np.array([r["word"] for r in rows], np.int64).view(np.uint64))


class _Words:
    """The words of some texts, joined by single spaces, and the first word of each text."""

    def __init__(self, texts: pa.Array):
        data, offs = scan.view(texts)
        parts, sizes, edges, at = [], [], [np.zeros(1, np.int64)], 0
        for i, j in scan.chunks(data, offs):
            part, o = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
            s, e, edge = scan.words(part, o)
            n = e - s
            past = np.cumsum(n + 1)
            joined = np.full(int(n.sum()) + len(n), 0x20, np.uint8)
            joined[scan.segment_positions(past - n - 1, n)] = part[scan.segment_positions(s, n)]
            parts.append(joined)
            sizes.append(n.astype(np.int32))
            edges.append(edge[1:] + at)
            at += len(s)
        self.data = np.concatenate(parts or [np.zeros(0, np.uint8)])
        self.size = np.concatenate(sizes or [np.zeros(0, np.int32)])
        self.edge = np.concatenate(edges)
        self.past = np.concatenate([[0], np.cumsum(self.size + 1, dtype=np.int64)])  # past the space after each word

    def kept(self, stay: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The texts of the words that stay, joined by one space; and how many stay in each."""
        if stay.all():
            data, ends = self.data, self.past[self.edge]
        else:
            size = self.size[stay].astype(np.int64)
            data = self.data[np.repeat(stay, self.size + 1)]
            ends = np.concatenate([[0], np.cumsum(size + 1)])[np.concatenate([[0], np.cumsum(stay)])[self.edge]]
        run = np.concatenate([[0], np.cumsum(stay)])
        text = pa.LargeStringArray.from_buffers(len(self.edge) - 1, pa.py_buffer(np.ascontiguousarray(ends, np.int64)), pa.py_buffer(data))
        text = pc.utf8_rtrim(text, " ")
        return text.cast(pa.string()) if len(data) < 1 << 31 else text, run[self.edge[1:]] - run[self.edge[:-1]]


class _Bucket(_Words):
    """The words of a bucket's texts, numbered, and their windows.  Texts stand in one order in all passes."""

    def __init__(self, table: pa.Table, width: int):
        order = np.argsort(np.asarray(table.column("_row")), kind="stable")
        self.table = table.take(pa.array(order))
        super().__init__(scan.text_column(self.table))
        self.doc = np.asarray(self.table.column("doc_id").combine_chunks().cast(pa.int64()))
        each = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.size), [None, pa.py_buffer(self.past), pa.py_buffer(self.data)]).dictionary_encode()
        self.code, self.words = np.asarray(each.indices), each.dictionary  # each with its space
        data, offs = scan.view(self.words)
        self.word = scan.span_hash(data, offs[:-1], offs[1:] - 1)  # of each distinct word, as frequent_words has them
        self.hash = self.word[self.code]
        n = np.diff(self.edge)
        self.text_of = np.repeat(np.arange(len(n), dtype=np.int32), n)
        self.width = width
        ok = np.zeros(len(self.code) + 1, np.int32)
        full = n >= width
        np.add.at(ok, self.edge[:-1][full], 1)
        np.add.at(ok, self.edge[1:][full] - width + 1, -1)
        self.window = np.flatnonzero(np.cumsum(ok[:-1]) > 0)

    def grams(self) -> np.ndarray:
        """The smallest gram hash in each window."""
        gram = min(GRAM, self.width)
        g = scan.window_hash(self.hash, gram, 3)
        span, low = self.width - gram + 1, g
        have = 1
        while have < span:
            step = min(have, span - have)
            low = np.minimum(low[: len(low) - step], low[step:])
            have += step
        return low[self.window] if len(self.window) else np.zeros(0, np.uint64)

    def repeated(self, again: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The windows whose smallest gram is one of these, that gram, and whether it is hot."""
        low = self.grams()
        order = np.argsort(again["low"])
        known, hot = again["low"][order], again["hot"][order] > 0
        new = np.ones(len(low), bool)
        new[1:] = low[1:] != low[:-1]
        place = np.minimum(np.searchsorted(known, low[new]), max(len(known) - 1, 0))[np.cumsum(new) - 1]
        on = np.flatnonzero(known[place] == low) if len(known) else np.zeros(0, np.int64)
        return self.window[on], low[on], hot[place[on]]

    def suffixes(self, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the suffixes at these words: codes of the word before (-1: none) and of depth words, one after another (-1: past the text); and their lengths."""
        first, past = self.edge[self.text_of[at]], self.edge[self.text_of[at] + 1]
        out = np.full((depth + 1, len(at)), -1, np.int32)
        for k in range(-1, depth):
            inside = (at + k >= first) & (at + k < past)
            out[k + 1, inside] = self.code[at[inside] + k]
        return out, np.minimum(past - at, depth)

    def prefixes(self, at: np.ndarray, frequent: np.ndarray, more: int) -> np.ndarray:
        """Hash of the words up to the first that is not frequent, and of so many more."""
        common = np.isin(self.word, frequent) if len(frequent) else np.zeros(len(self.word), bool)
        out = self.hash[at].copy()
        left = np.where(common[self.code[at]], self.width, more)
        on = np.flatnonzero(left > 0)
        for k in range(1, self.width):
            if not len(on):
                break
            out[on] = out[on] * scan.U(scan._BASE) + self.hash[at[on] + k]
            rare = ~common[self.code[at[on] + k]]
            left[on] = np.where(left[on] <= more, left[on] - 1, np.where(rare, more, left[on]))
            on = on[left[on] > 0]
        return scan.mix(out)


def suffix_tree(codes: np.ndarray, length: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of suffixes word by word, where each node of depth width begins in it, and how deep its suffixes agree.

    codes: one row a depth; -1 past the end.  Each of at least width words.
    """
    rows = [(codes[k].astype(np.int64) << 32) + (codes[k + 1] + 1 if k + 1 < len(codes) else 0) for k in range(0, len(codes), 2)]
    order = np.lexsort(rows[::-1])
    del rows
    common = np.zeros(max(len(order) - 1, 0), np.int32)  # words that neighbours share
    alive = np.ones(len(common), bool)
    for row in codes:
        x = row[order]
        alive &= (x[1:] == x[:-1]) & (x[1:] >= 0)
        common += alive
    new = np.concatenate([[True], common < width])[: len(order)]
    edge = np.flatnonzero(new)
    depth = np.where(new, length[order], np.concatenate([[0], common])[: len(order)])
    return order, edge, np.minimum.reduceat(depth, edge) if len(edge) else depth


ENTRY = {"to": "<i8", "bucket": "<i4", "at": "<i4", "least": "<i8", "many": "u1", "n": "<i8"}
STRETCH = {"to": "<i8", "bucket": "<i4", "at": "<i4", "least": "<i8", "many": "u1"}
GRAMS = {"to": "<i8", "bucket": "<i4", "low": "<u8", "many": "u1", "n": "<i4"}
AGAIN = {"to": "<i8", "low": "<u8", "hot": "u1"}
NODES = {"to": "<i8", "at": "<i4", "n": "<i4", "least": "<i8"}


def stretches(at: np.ndarray, *alike: np.ndarray) -> np.ndarray:
    """Where a stretch begins: of positions that follow one another, with equal values, at most LONGEST."""
    new = np.ones(len(at), bool)
    new[1:] = np.diff(at) != 1
    for x in alike:
        new[1:] |= x[1:] != x[:-1]
    first = np.flatnonzero(new)
    own = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    return np.flatnonzero(own % LONGEST == 0)


def _table(run: Run, step: int) -> pa.Table:
    return pa.Table.from_batches([_bodies(run, step)])


def _read(table: pa.Table, kinds: dict[str, str]) -> Run:
    return Run.joined([Run.unpack(x.as_py(), kinds) for x in table.column("body")], kinds)


def _light(f):
    def one(key, table):
        try:
            return f(table)
        finally:
            release()

    def two(key, left, right):
        try:
            return f(left, right)
        finally:
            release()

    return two if f.__code__.co_argcount == 2 else one


class _Plan:
    """The passes over one table of texts with ids."""

    def __init__(self, docs: DataFrame, width: int, *more):
        spark = docs.sparkSession
        self.width, self.depth = width, 2 * width
        known = docs.where("doc_id is not null")
        self.buckets = self.groups = parts_for(spark, text_bytes(known), BUCKET)
        self.known = known
        self.more = math.ceil(math.log(max(self.groups / MOST_GROUPS, 1)) / math.log(MOST_GROUPS))
        row = F.xxhash64("doc_id", "text")
        texts = one_text(known, *more).withColumn("_row", row)
        # a long, as the bodies' to is: Spark deals equal ints and longs to different partitions, and cogroup would not bring them together
        self.texts = texts.withColumn("_bucket", F.pmod(row, F.lit(self.buckets).cast("long"))).groupBy("_bucket")

    def again(self) -> DataFrame:
        """Bodies of AGAIN for each bucket: the grams that stand in several documents, and whether they are hot."""
        width, groups = self.width, self.groups
        first, back = steps_for(groups)[0], steps_for(self.buckets)[0]

        def grams_out(table):
            b = _Bucket(table, width)
            low = b.grams()
            doc = b.doc[b.text_of[b.window]]
            new = np.ones(len(low), bool)
            new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])
            n = np.diff(np.append(np.flatnonzero(new), len(low)))
            low, doc = low[new], doc[new]
            order = np.argsort(low)
            low, doc, n = low[order], doc[order], n[order]
            edge = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]])) if len(low) else np.zeros(0, np.int64)
            many = np.minimum.reduceat(doc, edge) != np.maximum.reduceat(doc, edge) if len(edge) else np.zeros(0, bool)
            n = np.add.reduceat(n, edge) if len(edge) else n
            low = low[edge]
            to = (scan.mix(low) % scan.U(groups)).astype(np.int64)
            return _table(Run({"to": to, "bucket": np.full(len(low), table.column("_bucket")[0].as_py(), np.int32), "low": low, "many": many.view(np.uint8), "n": n.astype(np.int32)}), first)

        def grams_back(table):
            run = _read(table, GRAMS)
            run = run.take(np.argsort(run.cols["low"], kind="stable"))
            low = run.cols["low"]
            edge = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]])[: len(low)])
            size = np.diff(np.append(edge, len(low)))
            again = np.flatnonzero(np.repeat((size > 1) | (np.maximum.reduceat(run.cols["many"], edge) > 0), size))
            hot = np.repeat(np.add.reduceat(run.cols["n"].astype(np.int64), edge) > HOT, size)
            return _table(Run({"to": run.cols["bucket"][again].astype(np.int64), "low": low[again], "hot": hot[again].view(np.uint8)}), back)

        grams = further(self.texts.applyInArrow(_light(grams_out), _BODIES), GRAMS, groups)
        return further(grams.groupBy("to").applyInArrow(_light(grams_back), _BODIES), AGAIN, self.buckets)

    def stretches(self) -> DataFrame:
        """Bodies of STRETCH for each group: the words of windows that follow one another, one window a node of a bucket's tree."""
        width, groups = self.width, self.groups
        first = steps_for(groups)[0]

        def stretches_out(left, right):
            if not left.num_rows or not right.num_rows:
                return _table(Run({k: np.zeros(0, v) for k, v in STRETCH.items()}, np.zeros(0, np.int64), np.zeros(0, np.int32), pa.array([], pa.large_binary())), 1)
            b = _Bucket(left, width)
            again = _read(right, AGAIN).cols
            at, low, hot = b.repeated(again)
            codes, length = b.suffixes(at, width)
            order, edge, _ = suffix_tree(codes[1:], length, width)
            doc = b.doc[b.text_of[at[order]]]
            least = np.minimum.reduceat(doc, edge) if len(edge) else doc
            many = (np.maximum.reduceat(doc, edge) != least) if len(edge) else np.zeros(0, bool)
            own = order[edge]  # a suffix of each node: the first of them, so that those of a passage follow one another
            place = np.argsort(own)
            own, least, many = own[place], least[place], many[place]
            at, low, hot = at[own], low[own], hot[own]
            if hot.any():
                low = np.where(hot, scan.window_hash(b.hash, width, 7)[at], low)
            to = (scan.mix(low ^ scan.U(1)) % scan.U(groups)).astype(np.int64)
            new = stretches(at, to, least, many)
            n = np.diff(np.append(new, len(at))) + width - 1
            cols = {"to": to[new], "bucket": np.full(len(new), left.column("_bucket")[0].as_py(), np.int32), "at": at[new].astype(np.int32), "least": least[new], "many": many[new].view(np.uint8)}
            return _table(Run(cols, n, b.code[scan.segment_positions(at[new], n)], b.words), first)

        return further(self.texts.cogroup(self.again().groupBy("to")).applyInArrow(_light(stretches_out), _BODIES), STRETCH, groups)

    def entries(self) -> DataFrame:
        """Bodies of ENTRY for each group."""
        width, depth, groups, more = self.width, self.depth, self.groups, self.more
        frequent = frequent_words(one_text(self.known), min(groups, MOST_GROUPS))
        first = steps_for(groups)[0]

        def entries_out(left, right):
            if not left.num_rows or not right.num_rows:
                return _table(Run({k: np.zeros(0, v) for k, v in ENTRY.items()}, np.zeros(0, np.int64), np.zeros(0, np.int32), pa.array([], pa.large_binary())), 1)
            b = _Bucket(left, width)
            at, _, _ = b.repeated(_read(right, AGAIN).cols)
            codes, length = b.suffixes(at, depth)
            order, edge, deep = suffix_tree(codes[1:], length, width)
            own = order[edge]  # a suffix of each node
            doc = b.doc[b.text_of[at[order]]]
            size = np.diff(np.append(edge, len(order)))
            least = np.minimum.reduceat(doc, edge) if len(edge) else doc
            before = codes[0, order]
            alike = (np.minimum.reduceat(before, edge) == np.maximum.reduceat(before, edge)) if len(edge) else np.zeros(0, bool)
            words = codes.T[own]
            words[~alike, 0] = -1
            inside = np.arange(depth + 1) <= deep[:, None]
            to = (b.prefixes(at[own], frequent, more) % scan.U(groups)).astype(np.int64)
            cols = {"to": to, "bucket": np.full(len(own), left.column("_bucket")[0].as_py(), np.int32), "at": at[own].astype(np.int32), "least": least, "many": (np.maximum.reduceat(doc, edge) != least).view(np.uint8) if len(edge) else np.zeros(0, np.uint8), "n": size}
            return _table(Run(cols, deep.astype(np.int64) + 1, words[inside], b.words), first)

        return further(self.texts.cogroup(self.again().groupBy("to")).applyInArrow(_light(entries_out), _BODIES), ENTRY, groups)


def _nodes(run: Run, width: int, depth: int):
    """The subtree of a group: its matrix of words, the order of its entries, the node each begins and how deep it goes."""
    codes = run.matrix(depth + 1)
    return codes, *suffix_tree(codes[1:], run.sizes - 1, width)


def maximal_repeats(docs: DataFrame, width: int = 13) -> DataFrame:
    """words, n_words, n (occurrences) and doc_id (the smallest) of the maximal repeats of width words or more that stand in several documents.

    Of each width words those that all their occurrences go on with, up to twice
    width; only where the words before differ, or a text begins.
    """
    plan = _Plan(docs, width)
    depth = plan.depth

    def repeats(table):
        run = _read(table, ENTRY)
        codes, order, edge, deep = _nodes(run, width, depth)
        least = run.cols["least"][order]
        lowest = np.minimum.reduceat(least, edge) if len(edge) else least
        many = np.maximum.reduceat(run.cols["many"][order], edge) > 0 if len(edge) else np.zeros(0, bool)
        many |= np.maximum.reduceat(least, edge) != lowest if len(edge) else False
        before = codes[0, order]
        apart = np.minimum.reduceat(before, edge) < 0 if len(edge) else many
        apart |= np.minimum.reduceat(before, edge) != np.maximum.reduceat(before, edge) if len(edge) else False
        n = np.add.reduceat(run.cols["n"][order], edge) if len(edge) else least
        on = np.flatnonzero(many & apart)
        words = run.words.to_pylist() if len(on) else []
        text = [b"".join(words[c] for c in codes[1 : deep[k] + 1, order[edge[k]]].tolist()).rstrip(b" ").decode() for k in on.tolist()]
        return pa.table([pa.array(text, pa.string()), pa.array(deep[on].astype(np.int64)), pa.array(n[on]), pa.array(lowest[on])], names=["words", "n_words", "n", "doc_id"])

    return plan.entries().groupBy("to").applyInArrow(_light(repeats), "words string, n_words long, n long, doc_id long")


def dedup_substrings(docs: DataFrame, width: int = 13, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text (kept words joined by one space), n_words, n_removed, removed (maximal spans of removed words: first, past), and the columns in keep.

    A word goes if a window of width words that covers it also starts in a
    document with a smaller doc_id.  A column in keep that is named like one of
    these comes back as <name>_in.
    """
    kept, names = carried(keep, ("doc_id", "text", "n_words", "n_removed", "removed"))
    plan = _Plan(docs, width, *kept)
    back = steps_for(plan.buckets)[0]

    def nodes_back(table):
        run = _read(table, STRETCH)
        n = run.sizes - width + 1  # windows of each stretch
        of = np.repeat(np.arange(len(run)), n)
        begin = scan.segment_positions(np.cumsum(run.sizes) - run.sizes, n)
        codes = np.array([run.codes[begin + k] for k in range(width)])
        order, edge, _ = suffix_tree(codes, np.full(len(of), width), width)
        least, many = run.cols["least"][of[order]], run.cols["many"][of[order]]
        lowest = np.repeat(np.minimum.reduceat(least, edge), np.diff(np.append(edge, len(order)))) if len(edge) else least
        want = (many > 0) | (least > lowest)
        own = order[want]
        at = run.cols["at"][of[own]] + scan.segment_positions(np.zeros(len(n), np.int64), n)[own]
        to, lowest = run.cols["bucket"][of[own]].astype(np.int64), lowest[want]
        place = np.lexsort((at, to))
        at, to, lowest = at[place], to[place], lowest[place]
        new = stretches(at, to, lowest)
        return _table(Run({"to": to[new], "at": at[new].astype(np.int32), "n": np.diff(np.append(new, len(at))).astype(np.int32), "least": lowest[new]}), back)

    def out_table(table, words, stay):
        text, left = words.kept(stay)
        n = np.diff(words.edge)
        gone = np.concatenate([~stay, [False]]).astype(np.int8)
        new = np.diff(gone, prepend=0)  # a span ends where its text ends
        cut = words.edge[1:-1]
        cut = np.unique(cut[(cut > 0) & (cut < len(stay))])
        split = cut[(gone[cut] > 0) & (gone[cut - 1] > 0)]
        first = np.sort(np.concatenate([np.flatnonzero(new > 0), split]))
        past = np.sort(np.concatenate([np.flatnonzero(new < 0), split]))
        of = np.searchsorted(words.edge, first, "right") - 1
        base = words.edge[of]
        spans = pa.StructArray.from_arrays([pa.array(first - base), pa.array(past - base)], names=["first", "past"])
        spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(n) + 1)).astype(np.int32)), spans)
        return pa.table([table.column("doc_id"), text, pa.array(n), pa.array(n - left), spans, *(table.column(c) for c in names)], names=["doc_id", "text", "n_words", "n_removed", "removed", *names])

    def cut_out(left, right):
        if not left.num_rows:
            return out_table(left, _Words(scan.text_column(left)), np.zeros(0, bool))
        b = _Bucket(left, width)
        nodes = _read(right, NODES).cols
        covered = np.zeros(len(b.code) + 1, np.int32)
        if len(nodes["at"]):
            h = scan.window_hash(b.hash, width, 5)
            rep = scan.segment_positions(nodes["at"].astype(np.int64), nodes["n"].astype(np.int64))
            own, lowest = h[rep], np.repeat(nodes["least"], nodes["n"])
            order = np.argsort(own, kind="stable")
            own, rep, lowest = own[order], rep[order], lowest[order]
            place = np.minimum(np.searchsorted(own, h[b.window]), len(own) - 1)
            on = np.flatnonzero(own[place] == h[b.window])
            place, at = place[on], b.window[on]
            while len(at):
                same = np.ones(len(at), bool)
                for k in range(width):
                    same &= b.code[at + k] == b.code[rep[place] + k]
                hit = at[same & (lowest[place] < b.doc[b.text_of[at]])]
                np.add.at(covered, hit, 1)
                np.add.at(covered, hit + width, -1)
                # other words of an equal hash stand next
                on = np.flatnonzero(~same & (place + 1 < len(own)))
                on = on[own[place[on] + 1] == own[place[on]]]
                place, at = place[on] + 1, at[on]
        return out_table(b.table, b, np.cumsum(covered[:-1]) <= 0)

    def whole(batches):
        for x in batches:
            words = _Words(scan.text_column(x))
            yield from out_table(x, words, np.ones(len(words.size), bool)).to_batches()

    nodes = further(plan.stretches().groupBy("to").applyInArrow(_light(nodes_back), _BODIES), NODES, plan.buckets)
    spans = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("past", T.LongType())]))
    rows = one_text(docs, *kept)
    schema = rows.schema
    schema = T.StructType([schema["doc_id"], schema["text"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("removed", spans), *(schema[c] for c in names)])
    out = plan.texts.cogroup(nodes.groupBy("to")).applyInArrow(_light(cut_out), schema)
    out = out.unionByName(rows.where("doc_id is null").mapInArrow(lean(whole), schema))
    return out.select("doc_id", "text", "n_words", "n_removed", "removed", *(F.col(c).alias(name) for c, name in names.items()))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, s, array_to_string(words[s:s + 12], ' ') AS win FROM d, unnest(generate_series(1, len(words) - 12)) AS t(s)),
f AS (SELECT win, min(doc_id) AS least FROM w GROUP BY win),
g AS (SELECT DISTINCT doc_id, k FROM w JOIN f USING (win), unnest(generate_series(s, s + 12)) AS t(k) WHERE least < doc_id),
k AS (SELECT doc_id, generate_subscripts(words, 1) AS k, unnest(words) AS word FROM d),
j AS (SELECT k.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY k.k) AS kept FROM k LEFT JOIN g ON k.doc_id = g.doc_id AND k.k = g.k WHERE g.k IS NULL GROUP BY k.doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN j USING (doc_id)
"""
