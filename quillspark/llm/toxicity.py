"""Toxicity by a support vector machine on a subsequence string kernel of sentences.

A sentence is a sequence of units: chunks between white space, folded to
lower-case letters (those with accents apart) with a mark at each border;
characters that stand for no letter are left out, and single letters in a row
count as one more unit.  The kernel of two units sums, over all subsequences of
three symbols that span at most SPAN symbols, the products of DECAY**span, and is
divided by both norms; a gap or an inserted character lowers it but does not end
it.  The kernel of two sentences sums the POWERth power of that over all pairs of
their distinct units.

A sentence's vector holds its kernel values to landmarks (one-unit sentences of
the labelled texts), whitened (Nystrom).  Labels are a document's, so the machine
is trained on sentences as multiple instances: all sentences of clean documents
against one of each toxic document, at first the one of the units that set the
labels apart most, in further ``rounds`` the one that the machine scores highest.
Toxic documents whose sentence looks clean are taken for wrong labels.  A
document's score is a fitted logistic curve of its highest sentence, of how many
sentences are on the toxic side, and of its length.

A sentence's value is the sum of its distinct units' values, so each distinct unit
meets the landmarks once a worker.

Letters beyond Latin-1 fall into 32 symbols by their last byte.  Nulls are empty
texts, which score as a sentence without units.  Without both labels in the
training rows every score is 0.  Labels that disagree count as toxic if at least
half say so; of rows that share a doc_id the one with the least text hash trains.
Only a bounded sample of labelled rows trains: ``sample`` rows of each label at
most, texts of ``train_bytes`` at most.  An empty table gives no row.  Kept
columns may have any name: one named like a result's own comes back as <name>_in.
A text is never cut: a worker holds some 60 times the bytes of the longest one.
"""

from __future__ import annotations

from itertools import combinations
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import scan
from .work import carried, kept, lean, one_text

DECAY, SPAN, PIECE = 0.7, 8, 24
#: The kernel of two units is raised to it, so that likeness of common syllables does not add up over a sentence.
POWER = 4
LETTERS, BORDER_A, BORDER_Z, BASE = 58, 58, 59, 60  # 26 letters, 32 letters with marks, two borders
TABLE_UNITS = 600_000
LONGEST_SENTENCE = 40

_FOLD = np.full(256, LETTERS, np.int16)
for _b in range(26):
    _FOLD[0x41 + _b] = _FOLD[0x61 + _b] = _b
_SKIP = -1
_FOLD[0xC3] = _SKIP  # first byte of the Latin-1 letters; the second says which
for _b in range(32):  # upper and lower case of a letter with a mark are 0x20 apart
    _FOLD[0x80 + _b] = _FOLD[0xA0 + _b] = 26 + _b
_SYMBOL = np.clip(_FOLD, 0, LETTERS).astype(np.uint8).tobytes()
_NO_LETTER = bytes(b for b in range(256) if not 0 <= _FOLD[b] < LETTERS)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_CLOSE = np.zeros(256, bool)
_CLOSE[[ord(c) for c in ".,;:!?"]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?"]] = True


def symbols(unit: bytes) -> np.ndarray:
    s = np.frombuffer(unit.translate(_SYMBOL, _NO_LETTER), np.uint8)
    return np.concatenate([[BORDER_A], s, [BORDER_Z]])


_grids: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def grid(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all three-symbol subsequences of n symbols, and their weights."""
    if n not in _grids:
        at = np.array([(i, i + j, i + k) for i in range(n) for j, k in combinations(range(1, SPAN), 2) if i + k < n], np.int64).reshape(-1, 3)
        _grids[n] = at, (DECAY ** (at[:, 2] - at[:, 0] + 1)).astype(np.float64)
    return _grids[n]


def ssk(a: bytes, b: bytes) -> float:
    """The kernel of two units of up to PIECE symbols, as defined; for tests."""

    def features(unit):
        s, out = symbols(unit).tolist(), {}
        for at in combinations(range(len(s)), 3):
            if at[2] - at[0] < SPAN:
                key = tuple(s[i] for i in at)
                out[key] = out.get(key, 0) + DECAY ** (at[2] - at[0] + 1)
        return out

    x, y = features(a), features(b)
    norm = (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5
    return sum(v * y.get(k, 0) for k, v in x.items()) / norm if norm else 0.0


def pieces(units: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """Symbol strings of units; a long one gives overlapping pieces.  Also the unit of each string."""
    out, of = [], []
    for k, u in enumerate(units):
        s = symbols(u)
        at = 0
        while True:
            out.append(s[at : at + PIECE])
            of.append(k)
            if at + PIECE >= len(s):
                break
            at += PIECE // 2
    return out, np.array(of, np.int64)


def coded(strings: list[np.ndarray]):
    """Yields (which strings, the codes of all their subsequences, these places' weights) for strings of equal length."""
    length = np.array([len(s) for s in strings], np.int64)
    for n in np.unique(length):
        which = np.flatnonzero(length == n)
        at, w = grid(int(n))
        if not len(at):
            continue
        step = max(1, 100_000 // len(at))
        for k in range(0, len(which), step):
            part = which[k : k + step]
            s = np.stack([strings[i] for i in part]).astype(np.int32)
            yield part, (s[:, at[:, 0]] * BASE + s[:, at[:, 1]]) * BASE + s[:, at[:, 2]], w


def _merged(code: np.ndarray, w: np.ndarray):
    """(row, code, sum of weights) of the distinct codes of each row."""
    order = np.argsort(code, axis=1)
    code = np.take_along_axis(code, order, 1)
    first = np.ones(code.shape, bool)
    first[:, 1:] = code[:, 1:] != code[:, :-1]
    edge = np.flatnonzero(first.ravel())
    return edge // code.shape[1], code.ravel()[edge], np.add.reduceat(w[order].ravel(), edge)


def _square_sums(code: np.ndarray, w: np.ndarray) -> np.ndarray:
    row, _, sums = _merged(code, w.astype(np.float64))
    return np.bincount(row, sums * sums, len(code))


class Landmarks:
    """Kernel features of landmark units: ``rows`` of the codes that any has, ``index`` of each code (0: none has it)."""

    def __init__(self, features: list[tuple[np.ndarray, np.ndarray]]):
        codes = np.unique(np.concatenate([c for c, _ in features]))
        self.index = np.zeros(BASE**3, np.int32)
        self.index[codes] = np.arange(1, len(codes) + 1)
        self.rows = np.zeros((len(codes) + 1, len(features)), np.float32)
        for k, (c, w) in enumerate(features):
            self.rows[self.index[c], k] = w


def features_of(unit: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Codes and weights of a unit's first piece."""
    for _, code, w in coded([symbols(unit)[:PIECE]]):
        _, code, sums = _merged(code, w)
        return code, sums / np.sqrt((sums * sums).sum())
    return np.zeros(0, np.int64), np.zeros(0)


def kernel_to(strings: list[np.ndarray], landmarks: Landmarks) -> np.ndarray:
    """Kernel values of strings to landmarks."""
    out = np.zeros((len(strings), landmarks.rows.shape[1]), np.float32)
    for part, code, w in coded(strings):
        order = np.sort(code, axis=1) if code.shape[1] > 1 else code
        at = landmarks.index[code]
        w = w.astype(np.float32)
        step = max(1, 8_192 // len(w))
        got = np.concatenate([w @ landmarks.rows[at[k : k + step]] for k in range(0, len(part), step)])
        norm = np.sqrt((w * w).sum(dtype=np.float64)) * np.ones(len(part))
        again = np.flatnonzero((order[:, 1:] == order[:, :-1]).any(axis=1))
        if len(again):  # subsequences that stand there more than once count together
            norm[again] = np.sqrt(_square_sums(code[again], w))
        out[part] = got / norm[:, None]
    return out


def split(data: np.ndarray, offs: np.ndarray):
    """Units of texts: (bytes in lower case, starts, ends, sentence of each unit, text of each sentence, extra units).

    extra units: (sentence, bytes) for runs of three or more single letters.
    """
    n = len(data)
    low = _LOWER[data]
    inside = scan.WORD_BYTE[data]
    ends_word = np.ones(n, bool)
    if n:
        ends_word[:-1] = ~inside[1:]
        cut = offs[1:-1]
        ends_word[cut[(cut > 0) & (cut <= n)] - 1] = True
    closing = _CLOSE[data] & ends_word
    starts, ends = scan.spans(inside & ~closing, offs)
    edge = scan.per_text(starts, offs)
    stop = np.zeros(len(starts), bool)
    if len(starts):
        marks = np.concatenate([[0], np.cumsum(_STOP[data] & closing | (data == 10), dtype=np.int64)])
        stop[:-1] = marks[starts[1:]] > marks[ends[:-1]]
        count = np.diff(edge)
        first = edge[:-1][count > 0]
        stop[edge[1:][count > 0] - 1] = True
        begin = np.concatenate([[True], stop[:-1]])
        begin[first] = True
        # a sentence of more units than the longest is taken in parts
        at = np.flatnonzero(begin)
        place = np.arange(len(starts)) - np.repeat(at, np.diff(np.append(at, len(starts))))
        begin |= place % LONGEST_SENTENCE == 0
        sentence = np.cumsum(begin) - 1
        text = np.repeat(np.arange(len(offs) - 1), count)[begin]
    else:
        sentence = text = np.zeros(0, np.int64)
    extra = []
    size = ends - starts
    single = (size == 1) | (size == 2) & (data[starts] >= 0xC3) if len(starts) else np.zeros(0, bool)
    if single.any():
        same = np.zeros(len(single), bool)
        same[1:] = single[1:] & single[:-1] & (sentence[1:] == sentence[:-1])
        runs = np.flatnonzero(single & ~same)
        past = np.flatnonzero(single & ~np.append(same[1:], False)) + 1
        for a, z in zip(runs.tolist(), past.tolist(), strict=True):
            if z - a >= 3:
                extra.append((int(sentence[a]), b"".join(low[starts[k] : ends[k]].tobytes() for k in range(a, z))))
    return low, starts, ends, sentence, text, extra


class Model:
    """table: the landmarks; weights: of each landmark's kernel; bias of a sentence; curve: weights of the logistic curve's inputs."""

    def __init__(self, table, weights, bias, curve):
        self.table, self.weights, self.bias, self.weight = table, weights, bias, curve
        self.name = uuid4().hex

    def units(self, units: list[bytes]) -> np.ndarray:
        """What each unit adds to its sentence."""
        return unit_kernels(units, self.table) @ self.weights

    def curve(self, inputs: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(inputs @ self.weight, -50, 50)))


def unit_kernels(units: list[bytes], table: Landmarks) -> np.ndarray:
    """Kernel values of units to landmarks; a long unit stands as its piece nearest to them."""
    strings, of = pieces(units)
    got = kernel_to(strings, table)
    if len(strings) != len(units):
        best = np.lexsort((-got.max(1), of))
        got = got[best[np.searchsorted(of[best], np.arange(len(units)))]]
    return got**POWER


def curve_inputs(best: np.ndarray, hits: np.ndarray, sentences: np.ndarray) -> np.ndarray:
    return np.stack([best, np.log1p(hits), np.maximum(hits > 1, 0), np.log1p(sentences) * (hits > 0), np.ones(len(best))], 1).astype(float)


class Scorer:
    @classmethod
    def kept(cls, model: Model) -> "Scorer":
        """This process's own for a model, with the units of its earlier tasks."""
        return kept(("scorer", model.name), lambda: cls(model))

    def __init__(self, model: Model):
        self.model, self.index, self.value = model, scan.HashIndex(), np.zeros(0)

    def texts(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """The curve's inputs of each text."""
        out = curve_inputs(*np.tile([[self.model.bias], [0.0], [0.0]], len(offs) - 1))
        for i, j in scan.chunks(data, offs):
            part, o = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
            low, starts, ends, sentence, text, extra = split(part, o)
            if not len(starts):
                continue
            h = scan.span_hash(low, starts, ends)
            at = self.index.find(h)
            new = np.flatnonzero(at < 0)
            if len(new):
                if self.index.n > TABLE_UNITS:
                    self.index.clear()
                    self.value, new = np.zeros(0), np.arange(len(h))
                keys, first = np.unique(h[new], return_index=True)
                first = new[first]
                raw = low.tobytes()
                self.value = np.concatenate([self.value, self.model.units([raw[a:z] for a, z in zip(starts[first].tolist(), ends[first].tolist(), strict=True)])])
                self.index.add(keys)
                at = self.index.find(h)
            pair = np.unique(sentence * len(self.value) + at)
            margin = np.bincount(pair // len(self.value), self.value[pair % len(self.value)], len(text)) + self.model.bias
            if extra:
                np.add.at(margin, [k for k, _ in extra], self.model.units([u for _, u in extra]))
            best = np.full(j - i, -np.inf)
            np.maximum.at(best, text, margin)
            out[i:j] = curve_inputs(np.where(np.isfinite(best), best, self.model.bias), np.bincount(text[margin > 0], minlength=j - i), np.bincount(text, minlength=j - i))
        return out


def _svm(parts: list[tuple[np.ndarray, float, np.ndarray]], width: int, reg: float) -> np.ndarray:
    """Linear machine with squared hinge loss, by Newton steps.  parts: rows, their label and their weights; the last column is the bias."""
    w = np.zeros(width)
    ridge = np.full(width, reg)
    ridge[-1] = reg * 1e-3
    for _ in range(30):
        grad, curve = ridge * w, np.diag(ridge)
        for rows, label, weight in parts:
            for k in range(0, len(rows), 10_000):
                x, ws = rows[k : k + 10_000].astype(np.float64), weight[k : k + 10_000]
                on = label * (x @ w) < 1
                x, ws = x[on], ws[on]
                grad = grad - x.T @ (ws * (label - x @ w))
                curve = curve + (x * ws[:, None]).T @ x
        step = np.linalg.solve(curve, grad)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w


class _Instances:
    """The sentences of labelled texts: ``unit`` and ``sentence`` of each unit of each sentence, ``doc`` of each sentence, the distinct ``units``."""

    def __init__(self, texts: list[str]):
        data, offs = scan.view(pa.array(texts, pa.large_string()))
        name, hashes, sentences, docs, n = {}, [], [], [], 0
        for i, j in scan.chunks(data, offs, 1 << 20):
            low, starts, ends, sentence, text, extra = split(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
            if not len(starts):
                continue
            h = scan.span_hash(low, starts, ends)
            own, first = np.unique(h, return_index=True)
            raw = low.tobytes()
            name |= {k: raw[a:z] for k, a, z in zip(own.tolist(), starts[first].tolist(), ends[first].tolist(), strict=True)}
            if extra:
                flat, past = b"".join(u for _, u in extra), np.cumsum([len(u) for _, u in extra])
                more = scan.span_hash(np.frombuffer(flat, np.uint8), np.append(0, past[:-1]), past)
                name |= dict(zip(more.tolist(), (u for _, u in extra), strict=True))
                h, sentence = np.append(h, more), np.append(sentence, [k for k, _ in extra])
            hashes.append(h)
            sentences.append(sentence + n)
            docs.append(text + i)
            n += len(text)
        none = [np.zeros(0, np.int64)]
        keys, unit = np.unique(np.concatenate(hashes or [np.zeros(0, np.uint64)]), return_inverse=True)
        self.units = [name.pop(k) for k in keys.tolist()]
        self.doc = np.concatenate(docs or none)
        pair = np.unique(np.concatenate(sentences or none) * max(1, len(keys)) + unit)
        self.unit, self.sentence = (pair % max(1, len(keys))).astype(np.int32), (pair // max(1, len(keys))).astype(np.int32)
        self.size = np.bincount(self.sentence, minlength=n)

    def vectors(self, phi: np.ndarray) -> np.ndarray:
        """Sums of units' vectors by sentence, and a column of ones."""
        out = np.ones((len(self.doc), phi.shape[1] + 1), np.float32)
        edge = np.concatenate([[0], np.cumsum(self.size)])
        for a in range(0, len(self.doc), 2_000):
            z = min(a + 2_000, len(self.doc))
            out[a:z, :-1] = np.add.reduceat(phi[self.unit[edge[a] : edge[z]]], edge[a:z] - edge[a], axis=0)
        return out


def _landmarks(units: list[bytes], apart: np.ndarray, common: np.ndarray, landmarks: int) -> Landmarks | None:
    """Units that set the labels apart and common ones, none too like another."""
    chosen, v = [], np.zeros(BASE**3, np.float32)
    for candidates, most, like in ((apart, landmarks // 2, 0.5), (apart, landmarks * 3 // 4, 0.9), (common, landmarks, 0.9)):
        for k in candidates.tolist():
            code, w = features_of(units[k])
            v[code] = w
            if len(chosen) < most and len(code) and all(v[c] @ x < like for c, x in chosen):
                chosen.append((code, w))
            v[code] = 0
    return Landmarks(chosen) if chosen else None


def fit(texts: list[str], toxic: np.ndarray, landmarks: int = 64, rounds: int = 1, reg: float = 1e-3, least: float = 3.0, against: float = 1.5) -> Model | None:
    """Trains on whole labelled texts.  least: how many standard errors set apart a unit that may tell the first sentences."""
    toxic = np.asarray(toxic, bool)
    if toxic.all() or not toxic.any():
        return None
    got = _Instances(texts)
    n_units = len(got.units)
    if not n_units:
        return None
    pairs = np.unique(got.doc[got.sentence].astype(np.int64) * n_units + got.unit)
    in_toxic = toxic[pairs // n_units]
    df1 = np.bincount(pairs % n_units, in_toxic, n_units)
    df0 = np.bincount(pairs % n_units, ~in_toxic, n_units)
    del pairs, in_toxic
    n1, n0 = toxic.sum(), (~toxic).sum()
    p1, p0 = (df1 + 0.5) / (n1 + 1), (df0 + 0.5) / (n0 + 1)
    both = (df1 + df0 + 1) / (n1 + n0 + 2)
    z = (p1 - p0) / np.sqrt(both * (1 - both) * (1 / n1 + 1 / n0))
    telling = (z >= least) & (p1 >= 4 * p0)
    apart = np.argsort(-z, kind="stable")[: 8 * landmarks]
    apart = apart[telling[apart]] if telling[apart].any() else apart[:1]
    table = _landmarks(got.units, apart, np.argsort(-(df0 + df1), kind="stable")[: 2 * landmarks], landmarks)
    if table is None:
        return None
    values, basis = np.linalg.eigh((table.rows.T @ table.rows) ** POWER)
    good = values > 1e-6 * values.max()
    white = basis[:, good] / np.sqrt(values[good])
    x = got.vectors(unit_kernels(got.units, table) @ white.astype(np.float32))
    # multiple instances: a toxic document stands by its most toxic sentence
    of_toxic = np.flatnonzero(toxic[got.doc])
    clean = x[~toxic[got.doc]]

    def top(of_sentence: np.ndarray) -> np.ndarray:
        order = of_toxic[np.lexsort((of_sentence[of_toxic], got.doc[of_toxic]))]
        return order[np.append(np.diff(got.doc[order]), 1) > 0]

    odds = np.maximum.reduceat(np.where(telling, np.log(p1 / p0), 0.0)[got.unit], np.cumsum(got.size) - got.size)
    chosen = top(odds)
    chosen = chosen[odds[chosen] > 0] if (odds[chosen] > 0).any() else chosen
    for _ in range(rounds):
        w = _svm([(x[chosen], 1.0, np.full(len(chosen), 1 / len(chosen))), (clean, -1.0, np.full(len(clean), against / max(1, len(clean))))], x.shape[1], reg)
        margin = x @ w
        best = top(margin)
        # one that looks clean, or that is no better than most clean documents' best, stands for a wrong label
        chosen = best[margin[best] > 0] if (margin[best] > 0).any() else best
    best = np.full(len(toxic), w[-1])
    np.maximum.at(best, got.doc, margin)
    hits = np.bincount(got.doc, margin > 0, len(toxic))
    curve = _logistic(curve_inputs(best, hits, np.bincount(got.doc, minlength=len(toxic))), toxic)
    return Model(table, (white @ w[:-1]).astype(np.float32), float(w[-1]), curve)


def _logistic(x: np.ndarray, label: np.ndarray) -> np.ndarray:
    # targets drawn in a little, as is usual for such curves
    n1, n0 = label.sum(), (~label).sum()
    t = np.where(label, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1]), x.T @ (p - t) + 1e-2 * w)
        size = np.abs(step).max()
        w -= step if size < 2 else step * (2 / size)
        if size < 1e-8:
            break
    w[0] = max(w[0], 0.0)
    return w


def fold(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 5; rows with 0 are held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def train(docs: DataFrame, labels: DataFrame, sample: int = 1000, train_bytes: int = 50_000) -> Model | None:
    """Fits on at most sample rows of each label, drawn by a hash of the id from rows that are not held out."""
    known = labels.where("doc_id is not null and toxic is not null").where(fold() != 0)
    known = known.groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    drawn = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for k in (0, 1)]
    few = drawn[0].unionAll(drawn[1])  # at most 2 * sample rows, so it can be broadcast
    rows = one_text(docs).where(F.octet_length("text") <= train_bytes).join(F.broadcast(few), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min_by(F.struct("text", "toxic"), F.struct(F.xxhash64("text"), "text")).alias("x")).select("doc_id", "x.*").toArrow()
    order = np.argsort(np.asarray(rows["doc_id"]), kind="stable")
    texts = rows["text"].to_pylist()
    toxic = np.asarray(rows["toxic"])
    return fit([texts[k] for k in order], toxic[order] == 1)


def score(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, columns in keep, and score of each row."""
    carry, renamed = carried(keep, ("doc_id", "text", "score"))
    rows = one_text(docs, *carry)
    last = ["doc_id", "text", *(F.col(c).alias(name) for c, name in renamed.items()), "score"]
    if model is None:
        return rows.withColumn("score", F.lit(0.0)).select(last)
    schema = T.StructType([*rows.schema, T.StructField("score", T.DoubleType())])
    names = [*rows.columns, "score"]

    def run(batches):
        scorer = Scorer.kept(model)
        for b in batches:
            got = scorer.model.curve(scorer.texts(*scan.view(scan.text_column(b))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got)], names=names)

    return rows.mapInArrow(lean(run, keep=True), schema).select(last)


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = 1000) -> DataFrame:
    """doc_id, held_out, score and predicted of each row."""
    out = score(docs, train(docs, labels, sample))
    held = F.coalesce(fold() == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
