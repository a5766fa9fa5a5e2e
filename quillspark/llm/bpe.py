"""Byte-pair counting and encoding of whole texts for word-end BPE vocabularies.

The vocabulary file is a ``tokenizers`` JSON: NFC, white space folded, lower
case, a split into contractions, letter runs, single digits and other runs,
then byte-level BPE with a word-end suffix.  A pre-token's result depends on
the pre-token alone, so texts are cut with numpy and each distinct pre-token
is handled once for each worker (a bounded table, emptied when full).

Chunks between white space that hold anything but ASCII and the Latin-1
letters, or that could hold a special string, go to the library's own
normaliser and splitter, so every text is handled as the library does.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from functools import cached_property

import numpy as np

from . import scan
from .work import kept

SPACE, LETTER, DIGIT, OTHER, ODD = 0, 1, 2, 3, 4
_CLASS = np.full(256, OTHER, np.uint8)
_CLASS[[*range(0x09, 0x0E), 0x20]] = SPACE
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = LETTER
_CLASS[0x30:0x3A] = DIGIT
# The library's white space is Unicode's, which counts 0x1C-0x1F for some engines: left to the library.
_DOUBT = np.zeros(256, bool)
_DOUBT[[*range(0x1C, 0x20)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
#: Words kept by a worker; beyond this the table starts anew.
TABLE_WORDS = 600_000


def default_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def units(data: np.ndarray, offs: np.ndarray):
    """Pre-tokens of texts: (bytes in lower case, starts, ends, odd flags)."""
    n = len(data)
    cls = _CLASS[data]
    low = _LOWER[data]
    high = data >= 0x80
    bad = _DOUBT[data]
    if n:
        bad[:-1] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)  # "<|" may begin a special string
    if high.any():
        lead = np.zeros(n, bool)
        nxt = data[1:]
        lead[:-1] = (data[:-1] == 0xC3) & (nxt >= 0x80) & (nxt < 0xC0) & (nxt != 0x97) & (nxt != 0xB7)
        trail = np.zeros(n, bool)
        trail[1:] = lead[:-1]
        bad |= high & ~(lead | trail)
        up = np.flatnonzero(trail & (data < 0x9F))
        low[up] += 0x20
    starts_of_text = offs[:-1][offs[:-1] < n]
    if bad.any():
        ws, we = scan.spans(scan.WORD_BYTE[data], offs)
        run = np.concatenate([[0], np.cumsum(bad, dtype=np.int64)])
        hit = np.flatnonzero(run[we] > run[ws])
        at = scan.segment_positions(ws[hit], we[hit] - ws[hit])
        cls[at] = ODD
        low[at] = data[at]
    first = np.empty(n, bool)
    if n:
        first[0] = True
        first[1:] = cls[1:] != cls[:-1]
        first |= cls == DIGIT
    border = first.copy()
    border[starts_of_text] = True
    first = border & (cls != SPACE)
    at = np.flatnonzero((data == 0x27) & first & (cls == OTHER))
    if len(at):
        inside = np.zeros(n + 4, bool)  # a byte that continues its text
        inside[:n] = True
        inside[starts_of_text] = False
        wide = np.zeros(n + 4, np.uint8)
        wide[:n] = low
        letter = np.zeros(n + 4, bool)
        letter[:n] = cls == LETTER
        a, b = wide[at + 1], wide[at + 2]
        one = inside[at + 1] & letter[at + 1] & ((a == 0x73) | (a == 0x74) | (a == 0x6D) | (a == 0x64))
        two = inside[at + 1] & inside[at + 2] & letter[at + 1] & letter[at + 2] & (((a == 0x72) & (b == 0x65)) | ((a == 0x76) & (b == 0x65)) | ((a == 0x6C) & (b == 0x6C)))
        for hit, length in ((at[one], 2), (at[two & ~one], 3)):
            border[hit + 1] = first[hit + 1] = False
            past = hit + length
            past = past[inside[past] & letter[past]]
            border[past] = first[past] = True
    last = np.ones(n, bool)
    last[:-1] = border[1:]
    last &= cls != SPACE
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return low, starts, ends, cls[starts] == ODD


class Library:
    """The vocabulary as the tokenizers library handles it; loaded once in each process."""

    _loaded: dict[str, "Library"] = {}

    def __new__(cls, path: str):
        if path not in cls._loaded:
            self = super().__new__(cls)
            self._load(path)
            cls._loaded[path] = self
        return cls._loaded[path]

    def _load(self, path: str) -> None:
        # a task has one core: the library's threads would only get in each other's way
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        model = json.load(open(path))
        self.special = [x["content"] for x in model["added_tokens"]]
        self.special_split = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        suffix = model["model"]["end_of_word_suffix"] or ""
        self.suffix = suffix
        vocab = model["model"]["vocab"]
        self.path, self.width = path, len(vocab) + 1
        self.n_ids = self.tokenizer.get_vocab_size(with_added_tokens=True)
        shown = byte_letters()
        self.inner = [vocab[c] for c in shown]
        self.final = [vocab[c + suffix] for c in shown]
        self.ends_word = np.zeros(self.n_ids, bool)
        if suffix:
            self.ends_word[[i for w, i in vocab.items() if w.endswith(suffix)]] = True

    @cached_property
    def pairs(self) -> dict[int, tuple[int, int]]:
        """Rank and result of each adjacent pair, by a single integer key; only counting needs them."""
        model = json.load(open(self.path))["model"]
        vocab, out = model["vocab"], {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            out[vocab[a] * self.width + vocab[b]] = (rank, vocab[a + b])
        return out

    def ids(self, words: list[bytes], odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after another, and how many each has."""
        plain = np.flatnonzero(~odd)
        if not len(plain):
            return self._each(words)
        # plain words are one pre-token each, so they can stand in one text; a word's last id says that it ends
        got = self.tokenizer.encode_batch_fast([b" ".join([words[k] for k in plain.tolist()] if len(plain) < len(words) else words).decode()], add_special_tokens=False)[0].ids
        flat = np.array(got, np.uint32)
        last = np.flatnonzero(self.ends_word[flat])
        if len(last) != len(plain) or last[-1] != len(flat) - 1:
            return self._each(words)
        n = np.diff(last, prepend=-1)
        if len(plain) == len(words):
            return flat, n
        other, m = self._each([words[k] for k in np.flatnonzero(odd).tolist()])
        count = np.zeros(len(words), np.int64)
        count[plain], count[odd] = n, m
        out = np.zeros(len(flat) + len(other), np.uint32)
        first = np.cumsum(count) - count
        out[scan.segment_positions(first[plain], n)] = flat
        out[scan.segment_positions(first[odd], m)] = other
        return out, count

    def _each(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]
        n = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter((x for w in got for x in w), np.uint32, int(n.sum())), n

    def counts(self, words: list[bytes], odd: np.ndarray) -> list[int]:
        return [self.count_odd(w.decode()) if o else self.count(w) for w, o in zip(words, odd.tolist(), strict=True)]

    def count_odd(self, chunk: str) -> int:
        """Tokens of a chunk whose pre-tokens the library finds."""
        total, t = 0, self.tokenizer
        parts = self.special_split.split(chunk) if self.special_split else [chunk]
        for part in parts:
            shown = t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(part)) if part else []
            total += sum(self.count(bytes(map(_LETTER_BYTE.__getitem__, word))) for word, _ in shown)
        return total + len(parts) - 1

    def count(self, word: bytes) -> int:
        """Initial symbols minus merges: a heap of adjacent pairs over a doubly linked list."""
        n = len(word)
        if n < 2:
            return n
        pairs, width, inner = self.pairs, self.width, self.inner
        sym = [inner[b] for b in word]
        sym[-1] = self.final[word[-1]]
        after = [*range(1, n), -1]
        before = [-1, *range(n - 1)]
        heap = []
        for i in range(n - 1):
            got = pairs.get(sym[i] * width + sym[i + 1])
            if got is not None:
                heap.append((got[0], i, got[1]))
        heapq.heapify(heap)
        left = n
        while heap:
            rank, i, merged = heapq.heappop(heap)
            if sym[i] < 0 or (j := after[i]) < 0:
                continue
            got = pairs.get(sym[i] * width + sym[j])
            if got is None or got[0] != rank:  # the pair that stood here has gone
                continue
            sym[i], sym[j] = merged, -1
            left -= 1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                got = pairs.get(merged * width + sym[k])
                if got is not None:
                    heapq.heappush(heap, (got[0], i, got[1]))
            if (h := before[i]) >= 0:
                got = pairs.get(sym[h] * width + merged)
                if got is not None:
                    heapq.heappush(heap, (got[0], h, got[1]))
        return left


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones stand for themselves."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


_LETTER_BYTE = {c: b for b, c in enumerate(byte_letters())}


class Counter:
    """Token counts of texts."""

    @classmethod
    def kept(cls, path: str) -> "Counter":
        """This process's own, with the words of its earlier tasks."""
        return kept((cls.__name__, path), lambda: cls(path))

    def __init__(self, path: str):
        self.lib, self.index, self.value = Library(path), scan.HashIndex(), np.zeros(0, np.int64)

    def _fill(self, low, starts, ends, odd, h) -> np.ndarray:
        at = self.index.find(h)
        new = np.flatnonzero(at < 0)
        if len(new):
            if self.index.n > TABLE_WORDS:
                self.index.clear()
                self.value = np.zeros(0, np.int64)
                new = np.arange(len(h))
            keys, first = np.unique(h[new], return_index=True)
            first = new[first]
            raw = low.tobytes()
            words = [raw[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
            self._learn(words, odd[first])
            self.index.add(keys)
            at = self.index.find(h)
        return at

    def _learn(self, words, odd) -> None:
        self.value = np.concatenate([self.value, np.array(self.lib.counts(words, odd), np.int64)])

    def texts(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """The token count of each text."""
        out = np.zeros(len(offs) - 1, np.int64)
        for i, j in scan.chunks(data, offs):
            part, o = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
            low, starts, ends, odd = units(part, o)
            at = self._fill(low, starts, ends, odd, scan.span_hash(low, starts, ends))
            run = np.concatenate([[0], np.cumsum(self.value[at])])
            edge = scan.per_text(starts, o)
            out[i:j] = run[edge[1:]] - run[edge[:-1]]
        return out


class Encoder(Counter):
    """Token ids of texts, as the library gives them without special tokens added."""

    def __init__(self, path: str):
        super().__init__(path)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.begin = np.zeros(0, np.int64)

    def _learn(self, words, odd) -> None:
        if not len(self.value):
            self.used, self.begin = 0, np.zeros(0, np.int64)
        flat, n = self.lib.ids(words, odd)
        total = len(flat)
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + total] = flat
        self.begin = np.concatenate([self.begin, self.used + np.cumsum(n) - n])
        self.used += total
        self.value = np.concatenate([self.value, n])

    def encode(self, data: np.ndarray, offs: np.ndarray):
        """Yields (first text, past, ids of these texts, offsets of each text's ids) chunk by chunk."""
        for i, j in scan.chunks(data, offs):
            part, o = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
            low, starts, ends, odd = units(part, o)
            at = self._fill(low, starts, ends, odd, scan.span_hash(low, starts, ends))
            n = self.value[at]
            ids = self.flat[scan.segment_positions(self.begin[at], n)]
            run = np.concatenate([[0], np.cumsum(n)])
            yield i, j, ids, run[scan.per_text(starts, o)]
