"""Vectorised scanning of whole texts in Arrow batches.

Texts are cut into spans (words) with numpy over the UTF-8 bytes that Arrow
already holds; each span gets a 64-bit hash, so later steps handle arrays and
not Python strings.  Batches are handled in chunks of whole texts of about
CHUNK bytes; a longer text is a chunk of its own and is never cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19
U = np.uint64
_rng = np.random.default_rng(20240229)
_BASE = int(_rng.integers(1 << 40, 1 << 62)) | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept and grown by doubling."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << int(n).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 8 * CHUNK:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> U(33))
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


def text_column(batch: pa.RecordBatch | pa.Table, name: str = "text") -> pa.Array:
    """The column as large_string, nulls as empty texts."""
    col = batch.column(batch.schema.get_field_index(name))
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.cast(pa.large_string()).fill_null("")


def view(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (len + 1) of a large_string or large_binary array, without a copy."""
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def chunks(data: np.ndarray, offs: np.ndarray, size: int = CHUNK):
    """(first, past) ranges of texts with about size bytes each."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + size, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def spans(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of inside bytes; runs end where a text ends."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = offs[(offs > 0) & (offs < n)]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[starts:ends], equal for equal bytes wherever they stand."""
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * powers(_BASE_INV, len(data) + 1)[starts]
    return mix(h + (ends - starts).astype(np.uint64) * U(0x9E3779B97F4A7C15))


def window_hash(h: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hashes of the len(h) - width + 1 runs of width consecutive span hashes."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    odd = U((_BASE ^ (seed * 2)) | 1)
    for k in range(width):
        out *= odd
        out += h[k : k + n]
    return mix(out)


def per_text(starts: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """For each text the index of its first span; len(offs) entries."""
    return np.searchsorted(starts, offs, "left")


WORD_BYTE = np.ones(256, bool)
WORD_BYTE[[0x20, *range(0x09, 0x0E)]] = False


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+``: starts, ends, first word of each text."""
    starts, ends = spans(WORD_BYTE[data], offs)
    return starts, ends, per_text(starts, offs)


class HashIndex:
    """An open-addressing map from 64-bit hashes to 0, 1, 2, ...; arrays in, arrays out."""

    def __init__(self, bits: int = 16):
        self.clear(bits)

    def clear(self, bits: int = 16) -> None:
        self.bits, self.n = bits, 0
        self.keys = np.zeros(1 << bits, np.uint64)
        self.vals = np.full(1 << bits, -1, np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash, or -1."""
        slot = (h >> U(64 - self.bits)).astype(np.int64)
        out = self.vals[slot]
        todo = np.flatnonzero((out >= 0) & (self.keys[slot] != h))
        slot = slot[todo]
        while len(todo):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            got = self.vals[slot]
            out[todo] = got
            more = (got >= 0) & (self.keys[slot] != h[todo])
            todo, slot = todo[more], slot[more]
        return out

    def add(self, h: np.ndarray) -> None:
        """Number new distinct hashes in the order given."""
        if 2 * (self.n + len(h)) > (1 << self.bits):
            used = np.flatnonzero(self.vals >= 0)
            keys, vals = self.keys[used], self.vals[used]
            bits = max(self.bits + 1, int(2 * (self.n + len(h))).bit_length())
            n = self.n
            self.clear(bits)
            self.n = n
            self._put(keys, vals)
        self._put(h, np.arange(self.n, self.n + len(h), dtype=np.int32))
        self.n += len(h)

    def _put(self, h: np.ndarray, v: np.ndarray) -> None:
        slot = (h >> U(64 - self.bits)).astype(np.int64)
        while len(h):
            free = self.vals[slot] < 0
            at = slot[free]
            self.vals[at] = v[free]  # of several for one slot the last stays
            self.keys[at] = h[free]
            left = self.vals[slot] != v
            slot, h, v = (slot[left] + 1) & ((1 << self.bits) - 1), h[left], v[left]


def segment_positions(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... (count[i] of them) for each i, one after another."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(count)
    return np.arange(total, dtype=np.int64) + np.repeat(first - (ends - count), count)
