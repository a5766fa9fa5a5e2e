"""N-gram Jaccard join by chosen paths.

Documents are sets of five-word shingles (all words, if there are one to four);
documents with equal sets are one node.  In each of several runs a set is split
recursively: of a node's set, the shingles whose hash under the path so far is
below 1 / (THRESHOLD * size) each lead to a child, so two sets that share much
share children at every level.  After DEPTH levels the nodes that stand in one
bucket are compared by brute force over small sketches, a larger bucket block by
block; in the largest, only blocks whose sizes allow the threshold.  No bucket is
sampled.  Runs are repeated until a pair at the threshold meets with the target
probability.

Met pairs only say which nodes hang together.  In each such component all pairs
are then compared exactly, blocks against blocks, so links and classes come from
exact similarities and no more than a block pair is ever in one task.

Result: one row a document with class_id (smallest doc_id of its connected
class) and n_links (other documents of at least the threshold, equal sets
included).  Nulls are empty texts; texts without words have equal, empty sets.
Rows without doc_id are classed too, and class_id is null if none has one.  Rows
that repeat, or share a doc_id, are documents of their own; an empty table gives
none.  Other columns are not read.  A text is never cut: a worker holds some 60
times the bytes of the longest one.

Shingles are known by 44 bits of a hash and sets by 128, so sets that differ in
equal hashes alone would count as equal.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scan
from .work import lean, one_text, written

U = np.uint64
THRESHOLD, WORDS, DEPTH, TARGET = 0.8, 5, 3, 0.999
BITS = 44  # of a shingle's hash, beside the place of its text in a chunk
BINS = 64
#: Nodes that are compared at once.
BLOCK = 512
#: Buckets beyond this are dealt by size as well before blocks are compared.
SPLIT = 16 * BLOCK
#: Bytes of keys that may be broadcast, and of one row as the JVM holds it.
BROADCAST, KEY_ROW = 32 << 20, 200
#: Parts that a band of a large bucket is dealt to where it meets the blocks beside it.
SALTS = 16


def runs_for(target: float, depth: int) -> int:
    """Runs after which a pair at the threshold has met with the target probability: a branching process with one child each on average."""
    miss = 0.0
    for _ in range(depth):
        miss = math.exp(miss - 1)
    return math.ceil(math.log(1 - target) / math.log(miss))


def shingles(data: np.ndarray, offs: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text of a chunk, ascending; and the edges of the texts."""
    starts, ends, edge = scan.words(data, offs)
    h = scan.span_hash(data, starts, ends)
    n = np.diff(edge)
    text = np.repeat(np.arange(len(n), dtype=np.uint64), n)
    grams = scan.window_hash(h, words, 7)
    whole = text[: len(grams)] == text[words - 1 :] if len(grams) else np.zeros(0, bool)
    key = (text[: len(grams)][whole] << U(BITS)) | (grams[whole] >> U(64 - BITS))
    short = np.flatnonzero((n > 0) & (n < words))
    if len(short):
        one = np.array([reduce(lambda a, x: (a * 0x9E3779B97F4A7C15 + x) % (1 << 64), h[edge[k] : edge[k + 1]].tolist(), 1) for k in short.tolist()], np.uint64)
        key = np.concatenate([key, (short.astype(np.uint64) << U(BITS)) | (scan.mix(one) >> U(64 - BITS))])
    key = np.unique(key)
    cut = np.searchsorted(key, np.arange(len(n) + 1, dtype=np.uint64) << U(BITS))
    return key & U((1 << BITS) - 1), cut


def signatures(tokens: np.ndarray, cut: np.ndarray) -> list[bytes]:
    """16 bytes for each set, equal for equal sets."""
    out = np.zeros((len(cut) - 1, 2), np.uint64)
    full = np.flatnonzero(np.diff(cut))
    if len(full):
        for k, seed in enumerate((0x1234567, 0x89ABCDEF01)):
            out[full, k] = np.add.reduceat(scan.mix(tokens ^ U(seed)), cut[full])
    raw = out.tobytes()
    return [raw[k : k + 16] for k in range(0, len(raw), 16)]


def sketches(tokens: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """One byte for the smallest hash in each of BINS bins of each set; 0: an empty bin."""
    out = np.zeros((len(cut) - 1, BINS), np.uint8)
    if len(tokens):
        of = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
        place = of * BINS + (tokens >> U(BITS - 6)).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        out.reshape(-1)[place[first]] = (scan.mix(tokens[first] + U(99)) % U(255)).astype(np.uint8) + 1
    return out


def chosen_paths(tokens: np.ndarray, cut: np.ndarray, runs: int, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """(set, path) of all leaves of all runs, sorted by set."""
    size = np.diff(cut)
    with np.errstate(divide="ignore"):
        share = np.minimum(1.0, 1 / (THRESHOLD * np.maximum(size, 1)))
    below = np.minimum(share * 2.0**64, 2.0**64 - 2049).astype(np.uint64)
    below[share >= 1] = U(2**64 - 1)
    full = np.flatnonzero(size)
    sets, paths = [], []
    for run in range(runs):
        node = full
        path = np.full(len(node), scan.mix(np.array([run + 1], np.uint64))[0], np.uint64)
        for _ in range(depth):
            count = size[node]
            at = scan.segment_positions(cut[node], count)
            own = np.repeat(np.arange(len(node)), count)
            x = tokens[at] ^ path[own]
            x *= U(0xFF51AFD7ED558CCD)
            x ^= x >> U(32)
            x *= U(0xC4CEB9FE1A85EC53)
            x ^= x >> U(29)
            pick = x <= below[node][own]
            own = own[pick]
            path = scan.mix(path[own] * U(0x9E3779B97F4A7C15) + tokens[at[pick]])
            node = node[own]
        sets.append(node)
        paths.append(path)
    node, path = np.concatenate(sets), np.concatenate(paths)
    order = np.argsort(node, kind="stable")
    return node[order], path[order].view(np.int64)


def signed(docs: DataFrame, runs: int) -> DataFrame:
    """doc_id, th (hash of the text), sig, n, sketch, paths of each row."""

    def run(batches):
        for b in batches:
            doc = b.column(0).cast(pa.int64())
            data, offs = scan.view(scan.text_column(b))
            for i, j in scan.chunks(data, offs):
                tokens, cut = shingles(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                node, path = chosen_paths(tokens, cut, runs)
                edge = np.searchsorted(node, np.arange(j - i + 1)).astype(np.int32)
                sk = sketches(tokens, cut).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [doc.slice(i, j - i), b.column(2).slice(i, j - i), pa.array(signatures(tokens, cut), pa.binary()), pa.array(np.diff(cut).astype(np.int32)), pa.array([sk[k : k + BINS] for k in range(0, len(sk), BINS)], pa.binary()), pa.ListArray.from_arrays(pa.array(edge), pa.array(path))],
                    names=["doc_id", "th", "sig", "n", "sketch", "paths"],
                )

    return hashed(docs).mapInArrow(lean(run), "doc_id long, th long, sig binary, n int, sketch binary, paths array<long>")


def hashed(docs: DataFrame) -> DataFrame:
    """doc_id, text and th: with doc_id the hash of its text says which row is meant, also if ids repeat or are null."""
    return one_text(docs).withColumn("th", F.xxhash64("text"))


def small(keys: DataFrame) -> DataFrame:
    """Broadcast if all rows take few bytes; else they meet the others in a shuffle."""
    return F.broadcast(keys) if keys.count() * KEY_ROW <= BROADCAST else keys


def _groups(batches, keys: list[str]):
    """Tables of the rows of one key each, from batches sorted by it."""
    held = []
    for b in batches:
        t = pa.Table.from_batches([b])
        if not t.num_rows:
            continue
        code = [np.asarray(t.column(k)) if t.column(k).type != pa.binary() else np.array(t.column(k).to_pylist(), object) for k in keys]
        new = np.flatnonzero(reduce(np.logical_or, [c[1:] != c[:-1] for c in code])) + 1
        edges = [0, *new.tolist(), t.num_rows]
        first = tuple(c[0] for c in code)
        for a, z in zip(edges[:-1], edges[1:], strict=True):
            if held and (a > 0 or first != held_key):
                yield pa.concat_tables(held)
                held = []
            held_key = tuple(c[a] for c in code)
            held.append(t.slice(a, z - a))
    if held:
        yield pa.concat_tables(held)


def _heads(near: np.ndarray) -> np.ndarray:
    """For each member of a symmetric relation the first member of its component."""
    label = np.arange(len(near))
    while True:
        new = np.where(near, label[None, :], len(near)).min(axis=1, initial=len(near))
        new = np.minimum(new, label)
        new = new[new]
        if (new == label).all():
            return label
        label = new


_EDGES = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _star(sig: list, heads: np.ndarray) -> pa.RecordBatch:
    on = np.flatnonzero(heads != np.arange(len(heads))).tolist()
    return pa.RecordBatch.from_arrays([pa.array([sig[heads[k]] for k in on], pa.binary()), pa.array([sig[k] for k in on], pa.binary())], schema=_EDGES)


def _blocked(rows: DataFrame, key: str, size: str) -> DataFrame:
    """Deals each row to all pairs of its block with the blocks of its key; a key of up to BLOCK rows is one block."""
    k = F.ceil(F.col(size) / F.lit(BLOCK)).cast("int")
    rows = rows.withColumn("blocks", k).withColumn("own", F.pmod(F.xxhash64("sig", F.lit(5)), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")).drop("other", "blocks")


def _by_size(rows: DataFrame) -> DataFrame:
    """Deals each row to all pairs of its block with blocks of its bucket that may hold near sets: sizes of a pair at the threshold are in the same band or in neighbouring ones."""
    # a step of a band is more than 1 / THRESHOLD, so that rounding puts no pair two bands apart
    rows = rows.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(1.01 / THRESHOLD))).cast("int"))
    sizes = rows.groupBy("path", "band").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
    # of each band: the blocks of its own and of those beside it; a band of a large bucket stands for many rows
    beside = sizes.select("path", F.explode(F.array(*(F.col("band") + k for k in (-1, 0, 1)))).alias("band"), F.col("band").alias("other_band"), F.col("blocks").alias("others"))
    known = sizes.join(beside, ["path", "band"]).groupBy("path", "band", "blocks").agg(F.collect_list(F.struct("other_band", "others")).alias("beside"))
    # a band may hold most rows, so it is dealt to salts
    salted = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("sig", F.lit(6)), F.lit(SALTS)).cast("int")).join(salted, ["path", "band", "salt"])
    block = lambda band, k: band.cast("long") * F.lit(1 << 32) + k
    rows = rows.withColumn("own", block(F.col("band"), F.pmod(F.xxhash64("sig", F.lit(5)), "blocks")))
    rows = rows.withColumn("other", F.explode(F.flatten(F.transform("beside", lambda x: F.transform(F.sequence(F.lit(0), x["others"] - 1), lambda k: block(x["other_band"], k))))))
    return rows.select("path", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "sig", "n", "sketch")


def met_pairs(nodes: DataFrame, parts: int) -> DataFrame:
    """Edges (a, b) that link the nodes of each bucket that look near by their sketches."""
    leaves = nodes.select("sig", F.explode(F.array_distinct("paths")).alias("path"))

    def shared(rows):
        many = rows.groupBy("path").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
        return rows.join(many, "path")

    rows = shared(leaves).join(nodes.select("sig", "n", "sketch"), "sig")
    rows = written(rows.select("path", "sig", "n", "sketch", "members"), "buckets")
    dealt = _blocked(rows.where(F.col("members") <= SPLIT), "path", "members").select("path", "lo", "hi", "sig", "n", "sketch")
    large = rows.where(F.col("members") > SPLIT)
    if not large.isEmpty():
        dealt = dealt.unionByName(_by_size(large))

    def brute(batches):
        for t in _groups(batches, ["path", "lo", "hi"]):
            if t.num_rows < 2:
                continue
            sig = t.column("sig").to_pylist()
            n = np.asarray(t.column("n"))
            sk = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(-1, BINS)
            same = np.zeros((len(n), len(n)), np.int16)
            used = np.zeros((len(n), len(n)), np.int16)
            for k in range(BINS):
                c = sk[:, k]
                some = c > 0
                same += (c[:, None] == c[None, :]) & some[:, None]
                used += some[:, None] | some[None, :]
            used = np.maximum(used, 1)
            near = same / used >= THRESHOLD - 4 * np.sqrt(0.16 / used)
            near &= np.minimum(n[:, None], n[None, :]) >= THRESHOLD * np.maximum(n[:, None], n[None, :])
            got = _star(sig, _heads(near))
            if got.num_rows:
                yield got

    keyed = dealt.repartition(parts, "path", "lo", "hi").sortWithinPartitions("path", "lo", "hi")
    return fewer_edges(keyed.mapInArrow(lean(brute), "a binary, b binary"))


def fewer_edges(edges: DataFrame) -> DataFrame:
    """Edges that connect the same nodes: of all a of a b, the smallest takes b and the others.

    A node has at most an edge for each leaf it stands in, so its list is bounded
    by the runs; where many buckets hold the same nodes, most edges fall together.
    """
    heads = edges.groupBy("b").agg(F.array_sort(F.collect_set("a")).alias("heads"))
    rest = F.concat(F.array("b"), F.slice("heads", F.lit(2), F.size("heads")))
    return heads.select(F.col("heads")[0].alias("a"), F.explode(rest).alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, label (smallest node of its component) of all nodes of the edges."""
    both = written(edges.select(F.col("a").alias("node"), F.col("b").alias("to")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("to"))).distinct(), "links")
    labels = written(both.groupBy("node").agg(F.min("to").alias("least")).select("node", F.least("node", "least").alias("label")), "labels")
    while True:
        reach = both.join(labels.select(F.col("node").alias("to"), F.col("label").alias("seen")), "to").groupBy("node").agg(F.min("seen").alias("seen"))
        step = labels.join(reach, "node").select("node", F.col("label").alias("old"), F.least("label", "seen").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = written(step.join(jump, "label").select("node", "old", F.least("label", "further").alias("label")), "labels")
        labels = new.select("node", "label")
        if new.where("label != old").isEmpty():
            return labels


def _overlaps(tokens: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections: products of 0/1 columns of the shingles that stand in two sets or more."""
    g = len(tokens)
    flat = np.concatenate(tokens)
    of = np.repeat(np.arange(g), [len(t) for t in tokens])
    if g == 2:
        out = np.diag([len(t) for t in tokens])
        out[0, 1] = out[1, 0] = len(flat) - len(np.unique(flat))
        return out
    order = np.argsort(flat, kind="stable")
    flat, of = flat[order], of[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    column = np.cumsum(new) - 1
    often = np.bincount(column) > 1
    keep = often[column]
    column, of = (np.cumsum(often) - 1)[column[keep]], of[keep]
    out = np.zeros((g, g), np.float32)
    width = max(64, min(4096, (8 << 20) // (4 * g)))
    total = int(often.sum())
    for at in range(0, total, width):
        a, z = np.searchsorted(column, [at, at + width])
        m = np.zeros((g, min(width, total - at)), np.float32)
        m[of[a:z], column[a:z] - at] = 1
        out += m @ m.T
    return np.rint(out).astype(np.int64)


def exact_links(docs: DataFrame, nodes: DataFrame, hung: DataFrame, parts: int) -> DataFrame:
    """Written rows (kind, a, b, links): of each node its links in a block pair, and edges of linked nodes."""
    sizes = hung.groupBy("label").agg(F.count(F.lit(1)).alias("members"))
    wanted = hung.join(sizes, "label").join(nodes.select(F.col("sig").alias("node"), "rep.doc_id", "rep.th", "mult"), "node")
    wanted = written(wanted.select(F.col("label").alias("component"), F.col("node").alias("sig"), "doc_id", "th", "mult", "members"), "components")
    # the text of one row of each node: of rows without doc_id, equal texts stand once
    texts = hashed(docs)
    own = texts.where("doc_id is not null").join(small(wanted.where("doc_id is not null")), ["doc_id", "th"])
    none = texts.where("doc_id is null").join(small(wanted.where("doc_id is null").drop("doc_id")), "th").drop("doc_id").dropDuplicates(["th", "text"])
    columns = ["component", "sig", "mult", "members", "text"]
    rows = own.select(columns).unionByName(none.select(columns))

    def tokens_of(batches):
        for b in batches:
            data, offs = scan.view(scan.text_column(b))
            sig = b["sig"].to_pylist()
            for i, j in scan.chunks(data, offs):
                tokens, cut = shingles(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                got = signatures(tokens, cut)
                on = [k for k in range(j - i) if got[k] == sig[i + k]]
                raw = tokens.tobytes()
                at = pa.array(np.array(on, np.int64) + i)
                yield pa.RecordBatch.from_arrays([*(b[c].take(at) for c in ("component", "sig", "mult", "members")), pa.array([raw[8 * cut[k] : 8 * cut[k + 1]] for k in on], pa.binary())], names=["component", "sig", "mult", "members", "tokens"])

    sets = rows.mapInArrow(lean(tokens_of), "component binary, sig binary, mult long, members long, tokens binary")
    dealt = _blocked(sets, "component", "members")
    out = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("links", pa.int64())])

    def compare(batches):
        for t in _groups(batches, ["component", "lo", "hi"]):
            sig, own = t.column("sig").to_pylist(), np.asarray(t.column("own"))
            first = {}
            for k, s in enumerate(sig):  # rows that repeat stand once
                first.setdefault(s, k)
            at = list(first.values())
            sig, own, mult = [sig[k] for k in at], own[at], np.asarray(t.column("mult"))[at]
            sets = [np.frombuffer(t.column("tokens")[k].as_py(), np.uint64) for k in at]
            lo, hi = t.column("lo")[0].as_py(), t.column("hi")[0].as_py()
            if len(sig) < 2:
                continue
            n = np.array([len(s) for s in sets])
            inter = _overlaps(sets)
            near = 5 * inter >= 4 * (n[:, None] + n[None, :] - inter)
            np.fill_diagonal(near, False)
            if lo != hi:
                near &= own[:, None] != own[None, :]
            links = near.astype(np.int64) @ mult
            on = np.flatnonzero(links).tolist()
            star = _star(sig, _heads(near))
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array([sig[k] for k in on], pa.binary()), star.column(0)]), pa.concat_arrays([pa.nulls(len(on), pa.binary()), star.column(1)]), pa.concat_arrays([pa.array(links[on]), pa.nulls(star.num_rows, pa.int64())])], schema=out)

    keyed = dealt.repartition(parts, "component", "lo", "hi").sortWithinPartitions("component", "lo", "hi")
    return written(keyed.mapInArrow(lean(compare), "a binary, b binary, links long"), "exact-links")


def classed(docs: DataFrame, target: float = TARGET) -> DataFrame:
    """doc_id, th, class_id, n_links and first (doc_id and th of the first document of the class) of each row."""
    spark = docs.sparkSession
    runs = runs_for(target, DEPTH)
    rows = written(signed(docs, runs), "signed")
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("rep")
    nodes = rows.groupBy("sig").agg(rep, F.count(F.lit(1)).alias("mult"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("paths").alias("paths"))
    nodes = written(nodes, "nodes")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), nodes.count() // 20_000)
    hung = components(met_pairs(nodes.where("n > 0"), parts))
    found = exact_links(docs, nodes, hung, parts)
    links = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "sig")
    label = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "sig")
    known = nodes.select("sig", "rep", "mult").join(links, "sig", "left").join(label, "sig", "left")
    known = known.withColumn("label", F.coalesce("label", "sig"))
    known = written(known.select("sig", "label", "rep", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links")), "linked")
    classes = known.groupBy("label").agg(F.min("rep").alias("first"))
    per_node = known.join(classes, "label").select("sig", "first", "n_links")
    return rows.select("doc_id", "th", "sig").join(per_node, "sig").select("doc_id", "th", F.col("first.doc_id").alias("class_id"), "n_links", F.struct("first.doc_id", "first.th").alias("first"))


def similar_documents(docs: DataFrame, target: float = TARGET) -> DataFrame:
    """doc_id, class_id and n_links of each row."""
    return classed(docs, target).select("doc_id", "class_id", "n_links")


def first_of_class(docs: DataFrame, target: float = TARGET) -> DataFrame:
    """One row of each class, with all its columns: that with the smallest doc_id (of equal ids that with the least hash of the text, of equal rows any one); one without doc_id only if no row of the class has one."""
    found = written(classed(docs, target), "classes")
    first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th"))
    keys = F.struct(F.col("doc_id").alias("_gone_id"), F.col("th").alias("_gone_th"))
    gone = small(written(found.where(~first).select(keys.alias("k")).distinct().select("k.*"), "gone"))
    text_hash = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    kept = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_gone_id")) & (text_hash == F.col("_gone_th")), "left_anti")
    if found.where(first).groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").isEmpty():
        return kept
    # repeated rows: all but those stay as they are
    again = found.where(first).groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    again = small(written(again.select(F.col("doc_id").alias("_gone_id"), F.col("th").alias("_gone_th")), "again"))
    same = F.col("doc_id").eqNullSafe(F.col("_gone_id")) & (text_hash == F.col("_gone_th"))
    single = kept.join(again, same, "left_anti")
    return single.unionByName(kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(CASE WHEN len(w) < 5 THEN w ELSE w[i:i + 4] END, ' ') AS gram FROM d, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 5 * c >= 4 * (x.size + y.size - c)
      UNION ALL SELECT x.doc_id, y.doc_id FROM d x JOIN d y ON len(x.w) = 0 AND len(y.w) = 0 AND x.doc_id <> y.doc_id),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
k AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT r.a AS doc_id, min(r.b) AS class_id, coalesce(any_value(k.n), 0) AS n_links FROM r LEFT JOIN k ON k.a = r.a GROUP BY r.a
"""
