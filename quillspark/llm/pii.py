"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The patterns (email, ip, card, phone) give base spans, which always stay.  The
field adds spans in forms that no pattern fits: addresses spelt with words or
brackets, phone numbers without a plus, cards with other separators.  Tokens are
runs of letters, runs of digits, and single other signs; a token's shape class
(case, length, sign, a few listed cue words, space before it) and those of its
neighbours give the state scores.  Weights are learnt from the small table in
pii_examples by the exact gradient of the likelihood; batches are decoded by
Viterbi in numpy, many stretches in lockstep.

A span needs a digit, an @ or a word for a dot, so only stretches of REACH tokens
around these are decoded; a stretch ends at a line's end.  One of more than LONGEST
tokens is decoded in windows that overlap by 2 * REACH tokens.  A found span is
added if it touches no base span and an exact check holds: a card's digits pass
Luhn, an ip has four parts of at most 255 (or is a valid address of version 6), a
phone has 7 to 15 digits, an email has names, one sign or word for @ and dots behind it.

Null and empty texts have no spans.  Each row gives one row, also if ids repeat or
are null; an empty table gives none.  Kept columns may have any name: one that is
named like a result's own comes back as <name>_in.  Texts are scanned whole.
"""

from __future__ import annotations

import ipaddress
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scan
from .fim import Checkpoints
from .pii_examples import EXAMPLES
from .work import carried, kept, lean

KINDS = ("email", "ip", "card", "phone")
STATES = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
REACH, LONGEST = 8, 512
SPANS = "array<struct<kind:string,start:long,end:long,base:boolean>>"

# ---- base patterns, over UTF-8 bytes: they hold ASCII only, so they match there as in the text

#: The patterns of the contract.  Runs that a match would take whole are possessive, so time is linear.
_AT = re.compile(rb"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(rb"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: bytes) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = d - 48
        total += x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x)
    return total % 10 == 0


def _digits(raw: bytes) -> bytes:
    return bytes(c for c in raw if 48 <= c < 58)


def base_spans(raw: bytes) -> list[tuple[int, int, int]]:
    """(kind, first byte, past byte) of the patterns' matches in a text, kind by kind."""
    out, past = [], 0
    for m in _AT.finditer(raw):  # an address's local part is what stands before its @, from the last address on
        at = m.start()
        while at > past and raw[at - 1] in _LOCAL:
            at -= 1
        if at < m.start():
            out.append((0, at, m.end()))
            past = m.end()
    for m in _IP.finditer(raw):
        if all(len(p.lstrip(b"0")) <= 3 and int(p) <= 255 for p in m[0].split(b".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(raw):
        d = _digits(m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(raw):
        if 9 <= len(_digits(m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


# ---- tokens and their shape classes

#: Cue words by group: words of one group are one class.
CUES = [
    "at ät arroba", "dot punkt punto point", "com org net de fr es edu gov", "email mail write contact schreiben escriba",
    "phone call dial tel telefon mobile mobil cell fax whatsapp appelez llame number", "card visa amex kreditkarte tarjeta carte mastercard credit pay",
    "ip host server login peer block adresse address", "version license section chapter page pages figure table part room row",
    "token password key sha uuid mac id isbn order invoice lot", "price total costs euros euro dollars", "january february march april may june july august september october november december",
    "dezember juillet octubre uhr",
]
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.where(_LETTER, 1, np.where(_DIGIT, 2, np.where(scan.WORD_BYTE, 3, 0))).astype(np.int8)


def _cue_table() -> tuple[np.ndarray, np.ndarray]:
    words = {w: k for k, group in enumerate(CUES) for w in group.split()}
    raw = [w.encode() for w in words]
    data, ends = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(w) for w in raw])
    h = scan.span_hash(data, np.concatenate([[0], ends[:-1]]), ends)
    order = np.argsort(h)
    return h[order], np.array(list(words.values()))[order]


_CUE_HASH, _CUE_GROUP = _cue_table()
# classes: 0 none; letters by case and length; digits by length; signs by byte; cues.  Odd: no space before.
_LETTERS, _DIGITS, _SIGNS = 1, 1 + 5 * 6, 1 + 5 * 6 + 22
_WORDS = _SIGNS + 128
CLASSES = 2 * (_WORDS + len(CUES))
PAIRS, RUNS = 1 << 13, 21 * 7


@dataclass
class Tokens:
    starts: np.ndarray
    ends: np.ndarray
    kind: np.ndarray  # 1 letters, 2 digits, 3 sign
    line: np.ndarray  # a number of the line; lines of other texts differ
    cls: np.ndarray
    run: np.ndarray  # digits and groups of the number-like run that a token stands in
    trigger: np.ndarray


def tokens(data: np.ndarray, offs: np.ndarray) -> Tokens:
    kind = _KIND[data]
    first = kind > 0
    first[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 3)
    edge = offs[(offs > 0) & (offs < len(data))]
    first[edge] = kind[edge] > 0
    starts = np.flatnonzero(first)
    n = len(starts)
    last = kind > 0
    last[:-1] &= (kind[1:] != kind[:-1]) | (kind[:-1] == 3)
    last[edge - 1] = kind[edge - 1] > 0
    ends = np.flatnonzero(last) + 1
    k, size = kind[starts], ends - starts
    breaks = np.flatnonzero((data == 10) | (data == 13))
    line = np.searchsorted(breaks, starts) + np.searchsorted(offs, starts, "right")
    glued = np.zeros(n, bool)
    glued[1:] = (ends[:-1] == starts[1:]) & (line[1:] == line[:-1])
    cls = np.zeros(n, np.int64)
    # letters: upper and lower case by ASCII, other letters apart
    upper = np.concatenate([[0], np.cumsum((data >= 65) & (data < 91))])
    high = np.concatenate([[0], np.cumsum(data >= 128)])
    n_up, n_high = upper[ends] - upper[starts], high[ends] - high[starts]
    begins_up = (data[starts] >= 65) & (data[starts] < 91) if n else np.zeros(0, bool)
    case = np.select([n_high > 0, n_up == 0, (n_up == 1) & begins_up, n_up == size], [4, 0, 1, 2], 3)
    length = np.searchsorted([2, 3, 4, 6, 9], size, "right")
    cls = np.where(k == 1, _LETTERS + case * 6 + length, cls)
    # digits: the length, and of up to three digits whether they are at most 255 and begin with 0
    d = k == 2
    at = starts[d]
    value = np.zeros(len(at), np.int64)
    for j in range(3):
        more = size[d] > j
        value[more] = value[more] * 10 + data[at[more] + j] - 48
    bucket = np.minimum(size[d], 20)
    bucket = np.where((size[d] == 3) & (value > 255), 21, np.where(size[d] == 3, 3, bucket))
    cls[d] = _DIGITS + bucket
    s = k == 3
    cls[s] = _SIGNS + data[starts[s]]
    letters = np.flatnonzero(k == 1)
    low = _LOWER[data]
    h = scan.span_hash(low, starts[letters], ends[letters])
    place = np.minimum(np.searchsorted(_CUE_HASH, h), len(_CUE_HASH) - 1)
    group = np.where(_CUE_HASH[place] == h, _CUE_GROUP[place], -1)
    cls[letters] = np.where(group >= 0, _WORDS + group, cls[letters])
    cue = np.full(n, -1)
    cue[letters] = group
    cls = 2 * cls + glued
    # runs of digits and the signs that part numbers, at most one space between
    sign = data[starts] if n else np.zeros(0, np.uint8)
    inside = d | (s & np.isin(sign, np.frombuffer(b"+-.()/_:", np.uint8)))
    joined = np.zeros(n, bool)
    joined[1:] = inside[1:] & inside[:-1] & (line[1:] == line[:-1]) & (starts[1:] - ends[:-1] <= 1)
    group_of = np.cumsum(~joined) - 1 if n else np.zeros(0, np.int64)
    m = int(group_of[-1]) + 1 if n else 0
    many = np.bincount(group_of, np.where(d, size, 0), m).astype(np.int64)
    groups = np.bincount(group_of, d, m).astype(np.int64)
    run = np.where(inside, np.minimum(many, 20)[group_of] * 7 + np.minimum(groups, 6)[group_of], 0) if n else np.zeros(0, np.int64)
    # an at-word counts where a bracket or a dot inside a name follows soon
    near = np.zeros(n, bool)
    dot = np.zeros(n, bool)
    if n > 2:
        dot[1:-1] = (sign[1:-1] == 46) & glued[1:-1] & glued[2:]
    for j in range(1, 5):
        near[:-j] |= (dot[j:] if n > j else dot[:0])
    trigger = d | (sign == 64) | (cue == 1) | ((cue == 0) & near)
    return Tokens(starts, ends, k, line, cls, run, trigger)


def _shifted(c: np.ndarray, line: np.ndarray, at: np.ndarray, by: int) -> np.ndarray:
    """The class of the token so many places on in the same line; 0 if there is none."""
    j = at + by
    ok = (j >= 0) & (j < len(c))
    j = np.clip(j, 0, max(len(c) - 1, 0))
    return np.where(ok & (line[j] == line[at]), c[j], 0)


AROUND = range(-3, 4)


def features(t: Tokens, at: np.ndarray) -> list[np.ndarray]:
    """A row number in each weight table for each token."""
    out = [_shifted(t.cls, t.line, at, by) for by in AROUND]
    here = out[3]
    out += [(out[2] * CLASSES + here) * 31 % PAIRS, (here * CLASSES + out[4]) * 31 % PAIRS, t.run[at]]
    return out


TABLES = [CLASSES] * len(AROUND) + [PAIRS, PAIRS, RUNS]


def stretches(t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """First and past tokens of what is decoded."""
    n = len(t.starts)
    hit = np.flatnonzero(t.trigger)
    if not len(hit):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, np.maximum(hit - REACH, 0), 1)
    np.add.at(cover, np.minimum(hit + REACH + 1, n), -1)
    inside = np.cumsum(cover[:n]) > 0
    # a stretch may reach into lines without a trigger: these give no span, which costs time alone
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (t.line[1:] != t.line[:-1])
    first = np.flatnonzero(new)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | (t.line[1:] != t.line[:-1])
    return first, np.flatnonzero(last) + 1


# ---- the field

NEVER = -1e9


def _allowed() -> np.ndarray:
    """0 where a state may follow another (the last row: where it may begin), else NEVER."""
    a = np.zeros((STATES + 1, STATES))
    for k in range(len(KINDS)):
        a[:, 2 + 2 * k] = NEVER
        a[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = 0
    return a


@dataclass
class Model:
    tables: list[np.ndarray]
    moves: np.ndarray  # (STATES + 1, STATES), the last row for the first token

    def scores(self, feats: list[np.ndarray]) -> np.ndarray:
        out = self.tables[0][feats[0]].copy()
        for w, f in zip(self.tables[1:], feats[1:], strict=True):
            out += w[f]
        return out


def viterbi(scores: np.ndarray, moves: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The best states of all sequences, whose scores stand from first on; the sequences go in lockstep, longest first."""
    out = np.zeros(len(scores), np.int8)
    order = np.argsort(-size, kind="stable")
    for lo in range(0, len(order), 4096):
        part = order[lo : lo + 4096]
        f, n = first[part], size[part]
        best = scores[f] + moves[-1]
        back = np.zeros((int(n[0]), len(part), STATES), np.int8)
        for j in range(1, int(n[0])):
            live = int(np.searchsorted(-n, -j, "left"))  # sequences with more than j tokens come first
            step = best[:live, :, None] + moves[None, :-1]
            back[j, :live] = step.argmax(1)
            best[:live] = step.max(1) + scores[f[:live] + j]
        state = best.argmax(1)
        for j in range(int(n[0]) - 1, -1, -1):
            live = int(np.searchsorted(-n, -j, "left"))
            out[f[:live] + j] = state[:live]
            state[:live] = back[j, np.arange(live), state[:live]]
    return out


def parse_example(line: str) -> tuple[bytes, list[tuple[int, int, int]]]:
    """Text and (kind, first byte, past byte) of an example."""
    raw, spans = b"", []
    for part in re.split("(«[^»]*»)", line):
        if part.startswith("«"):
            kind, body = part[1:-1].split("|", 1)
            spans.append((KINDS.index(kind), len(raw), len(raw) + len(body.encode())))
            part = body
        raw += part.encode()
    return raw, spans


def _varied(line: str, rng: np.random.Generator) -> str:
    """The example with other digits; parts of an ip stay below 256."""

    def number(m):
        size = len(m[0])
        if size == 3:  # the same side of 255
            return str(int(rng.integers(100, 256) if int(m[0]) <= 255 else rng.integers(256, 1000))) if m[0][0] != "0" else m[0]
        return m[0][0] + "".join(str(int(x)) for x in rng.integers(0, 10, size - 1))

    return re.sub("[0-9]+", number, line)


def train(examples: list[str] | None = None, copies: int = 4, rounds: int = 80, decay: float = 0.02, seed: int = 3) -> Model:
    """Weights from examples (lines with marked spans) and their spans alone, each in so many copies with other digits; the gradient is exact."""
    rng = np.random.default_rng(seed)
    given = EXAMPLES if examples is None else examples
    spans_alone = [m for x in given for m in re.findall("«[^»]*»", x)]
    given = [*given, *spans_alone, *(f"of thender {m} onthe and" for m in spans_alone)]  # spans also stand without a cue
    lines = [x if k == 0 else _varied(x, rng) for x in given for k in range(copies)]
    parsed = [parse_example(x) for x in lines]
    offs = np.cumsum([0, *(len(raw) for raw, _ in parsed)])
    t = tokens(np.frombuffer(b"".join(raw for raw, _ in parsed), np.uint8), offs)
    gold = np.zeros(len(t.starts), np.int64)
    for (_, spans), o in zip(parsed, offs.tolist(), strict=False):
        for kind, a, z in spans:
            lo, hi = np.searchsorted(t.starts, [o + a, o + z])
            gold[lo:hi] = 2 + 2 * kind
            gold[lo] = 1 + 2 * kind
    first = np.searchsorted(t.starts, offs[:-1])
    size = np.diff(np.append(first, len(t.starts)))
    first, size = first[size > 0], size[size > 0]
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    feats = features(t, np.arange(len(t.starts)))
    allowed = _allowed()
    model = Model([np.zeros((n, STATES)) for n in TABLES], np.zeros((STATES + 1, STATES)))
    params = [*model.tables, model.moves]
    slow, fast = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    one = np.eye(STATES)
    begins = np.zeros(len(gold), bool)
    begins[first] = True
    seen = np.zeros_like(model.moves)
    np.add.at(seen, (np.where(begins, STATES, np.roll(gold, 1)), gold), 1.0)
    for step in range(1, rounds + 1):
        score, moves = model.scores(feats), model.moves + allowed
        grad, pairs = _expected(score, moves, first, size)
        diff = grad - one[gold]
        grads = []
        for w, f in zip(model.tables, feats, strict=True):
            g = decay * w
            np.add.at(g, f, diff)
            grads.append(g)
        grads.append(pairs - seen + decay * model.moves)
        for p, g, a, b in zip(params, grads, slow, fast, strict=True):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= 0.1 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return Model([w.astype(np.float32) for w in model.tables], (model.moves + allowed).astype(np.float32))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - m).sum(axis=axis)) + m.squeeze(axis)


def _expected(score: np.ndarray, moves: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of each token's states, and expected counts of moves, by forward and backward sums; longest sequences first."""
    ahead, behind = np.zeros_like(score), np.zeros_like(score)
    longest = int(size[0])
    live_at = [int(np.searchsorted(-size, -j, "left")) for j in range(longest)]
    ahead[first] = score[first] + moves[-1]
    for j in range(1, longest):
        at = first[: live_at[j]] + j
        ahead[at] = score[at] + _log_sum(ahead[at - 1][:, :, None] + moves[None, :-1], 1)
    pairs = np.zeros_like(moves)
    total = _log_sum(ahead[first + size - 1], 1)
    for j in range(longest - 1, 0, -1):
        at = first[: live_at[j]] + j
        onward = moves[None, :-1] + (score[at] + behind[at])[:, None, :]
        behind[at - 1] = _log_sum(onward, 2)
        pairs[:-1] += np.exp(ahead[at - 1][:, :, None] + onward - total[: live_at[j], None, None]).sum(0)
    whole = np.repeat(total[np.argsort(first)], size[np.argsort(first)])
    p = np.exp(ahead + behind - whole[:, None])
    pairs[-1] += p[first].sum(0)
    return p, pairs


#: How a found address is built: names, a sign or word for @, and names parted by signs or words for dots.  A dot has space on both sides or on none.
_OPEN, _SHUT, _NAME = rb"[ \t]?[\[({<][ \t]?", rb"[ \t]?[\])}>][ \t]?", rb"[A-Za-z0-9%+_-]+"
_AT_WORD, _DOT_WORD = rb"(?:@|at|arroba|\xc3\xa4t)", rb"(?:\.|dot|punkt|punto|point)"
_AT_SIGN = rb"(?:" + _OPEN + _AT_WORD + _SHUT + rb"|[ \t]" + _AT_WORD + rb"[ \t]|@)"
_DOT_SIGN = rb"(?:" + _OPEN + _DOT_WORD + _SHUT + rb"|[ \t]" + _DOT_WORD + rb"[ \t]|\.)"
_SPELT = re.compile(_NAME + rb"(?:" + _DOT_SIGN + _NAME + rb")*+" + _AT_SIGN + _NAME + rb"(?:" + _DOT_SIGN + _NAME + rb")+", re.I)


def holds(kind: int, raw: bytes) -> bool:
    """The exact check of a found span."""
    d = _digits(raw)
    if kind == 0:
        return _SPELT.fullmatch(raw) is not None
    if kind == 1:
        parts = re.findall(rb"[0-9]+", raw)
        if len(parts) == 4 and b":" not in raw and all(len(p) <= 3 and int(p) <= 255 for p in parts):
            return True
        try:
            return ipaddress.ip_address(raw.decode()).version == 6
        except ValueError:
            return False
    if kind == 2:
        return 12 <= len(d) <= 19 and luhn(d)
    return 7 <= len(d) <= 15


class Finder:
    """Spans of the texts of a chunk."""

    def __init__(self, model: Model):
        self.model = model

    def added(self, data: np.ndarray, offs: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(text, kind, first byte, past byte) of the field's spans; bytes are those of the chunk."""
        t = tokens(data, offs)
        first, past = stretches(t)
        if not len(first):
            return []
        lo, hi, keep_lo, keep_hi = _windows(first, past)
        size = hi - lo
        at = scan.segment_positions(lo, size)
        states = viterbi(self.model.scores(features(t, at)), self.model.moves, np.cumsum(size) - size, size)
        keep = (at >= np.repeat(keep_lo, size)) & (at < np.repeat(keep_hi, size))
        tag = np.zeros(len(t.starts), np.int8)
        tag[at[keep]] = states[keep]
        begin = np.flatnonzero((tag > 0) & (tag % 2 == 1))
        out = []
        for b in begin.tolist():
            kind, e = (int(tag[b]) - 1) // 2, b + 1
            while e < len(tag) and tag[e] == tag[b] + 1:
                e += 1
            while e > b and t.kind[e - 1] == 3:  # signs at the ends belong to the sentence, but for those that begin a number
                e -= 1
            while b < e and t.kind[b] == 3 and data[t.starts[b]] not in b"(+":
                b += 1
            if b == e:
                continue
            a, z = int(t.starts[b]), int(t.ends[e - 1])
            k = int(np.searchsorted(offs, a, "right")) - 1
            glued = (a > offs[k] and _LETTER[data[a - 1]] and t.kind[b] == 2) or (z < offs[k + 1] and _LETTER[data[z]] and t.kind[e - 1] == 2)
            if not glued and holds(kind, data[a:z].tobytes()):
                out.append((k, kind, a, z))
        return out

    def spans(self, data: np.ndarray, offs: np.ndarray) -> list[list[tuple[str, int, int, bool]]]:
        """(kind, start, end, base) in code points of each text, by start, then kind."""
        n = len(offs) - 1
        found: list[list] = [[] for _ in range(n)]
        sums = np.concatenate([[0], np.cumsum(_DIGIT[data] | (data == 64))])
        for k in np.flatnonzero(sums[offs[1:]] > sums[offs[:-1]]).tolist():  # no pattern fits a text without a digit or @
            found[k] = [(kind, offs[k] + a, offs[k] + z, True) for kind, a, z in base_spans(data[offs[k] : offs[k + 1]].tobytes())]
        for k, kind, a, z in self.added(data, offs):
            if all(z <= x or y <= a for _, x, y, base in found[k] if base):
                found[k].append((kind, a, z, False))
        rows = [(k, *s) for k, f in enumerate(found) for s in f]
        if rows:
            marks = Checkpoints(data, offs)
            ends = marks.count(np.array([[r[2], r[3]] for r in rows], np.int64).ravel()).reshape(-1, 2).tolist()
        out: list[list] = [[] for _ in range(n)]
        for (k, kind, _, _, base), (a, z) in zip(rows, ends if rows else [], strict=True):
            at = int(marks.first[k])
            out[k].append((a - at, kind, z - at, base))
        return [[(KINDS[kind], a, z, base) for a, kind, z, base in sorted(x)] for x in out]


def _windows(first: np.ndarray, past: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches, long ones in windows of LONGEST tokens that overlap: first, past, and what counts of each."""
    if (past - first).max() <= LONGEST:
        return first, past, first, past
    rows = []
    for a, z in zip(first.tolist(), past.tolist(), strict=True):
        step = LONGEST - 4 * REACH
        for s in range(a, z, step) if z - a > LONGEST else [a]:
            e = min(s + step, z) if z - a > LONGEST else z
            rows.append((max(a, s - 2 * REACH), min(z, e + 2 * REACH), s, e))
    return tuple(np.array(x, np.int64) for x in zip(*rows, strict=True))


# ---- operators


def find_spans(docs: DataFrame, model: Model | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, spans (kind, start, end in code points, base) and kept columns of each row."""
    return _mapped(docs, model, keep, False)


def redact(docs: DataFrame, model: Model | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the text with each span (or spans that overlap) as [KIND], the spans, and kept columns of each row."""
    return _mapped(docs, model, keep, True)


def _mapped(docs: DataFrame, model: Model | None, keep: tuple[str, ...], with_text: bool) -> DataFrame:
    own = ("doc_id", "text", "spans") if with_text else ("doc_id", "spans")
    extra, names = carried(keep, own)
    kinds = dict(docs.dtypes)
    model = model or train()
    schema = "doc_id long, " + ("text string, " if with_text else "") + f"spans {SPANS}" + "".join(f", {k} {kinds[c]}" for k, c in zip(names, keep, strict=True))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(batches):
        finder = kept("pii", lambda: Finder(model))
        for b in batches:
            data, offs = scan.view(scan.text_column(b))
            for i, j in scan.chunks(data, offs):
                part, at = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
                found = finder.spans(part, at)
                rows = b.slice(i, j - i)
                cols = [pa.array([[dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in x] for x in found], kind)]
                if with_text:
                    raw = part.tobytes()
                    cols.insert(0, pa.array([_redacted(raw[a:z].decode(), s) for a, z, s in zip(at[:-1].tolist(), at[1:].tolist(), found, strict=True)], pa.string()))
                yield pa.RecordBatch.from_arrays([rows.column(0), *cols, *rows.columns[2:]], names=[*own, *names])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *extra)
    out = rows.mapInArrow(lean(run), schema)
    return out.select(*own, *(F.col(k).alias(v) for k, v in names.items()))


def _redacted(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    out, past = [], 0
    for kind, a, z, _ in spans:
        if a >= past:
            out += [text[past:a], f"[{kind.upper()}]"]
        past = max(past, z)
    return "".join([*out, text[past:]])


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, the counts of base spans by kind, a digest of the base spans, and all spans."""
    out = find_spans(docs, model)
    base = F.filter("spans", lambda s: s["base"])
    of = lambda kind: F.filter(base, lambda s: s["kind"] == kind)
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return out.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added"))
