"""Progressive JPEG coding of many images at once, in numpy.

``decode`` reads baseline-free progressive files (SOF2): it follows each file's
scans (spectral selection and successive approximation, restart intervals,
interleaved or not) and accumulates them into coefficient arrays.  Restart
intervals are independent, so those of all files of a batch are decoded in
lockstep: each step reads one Huffman symbol in every interval.

``store`` keeps bytes in the format's own unit, the quantised coefficient: a
byte b is the coefficient b - 130 below 128, else b - 125, so each has a
magnitude of 3 to 130 and unused blocks are zero.  64 bytes are a block; blocks
fill Y, then Cb, then Cr of a 4:2:0 image that is about square.  ``load`` takes
them out of the accumulated coefficients again.
"""

from __future__ import annotations

import struct

import numpy as np

from . import scan as S

RESTART = 8  # blocks in a restart interval
BANDS = ((1, 5), (6, 63))
ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, (i // 8 if (i // 8 + i % 8) % 2 else i % 8))))
#: Code lengths are all 4 bits; these are the symbols of the two tables that store() uses.
DC_SYMBOLS = bytes(range(12))
AC_SYMBOLS = bytes(range(9)) + bytes([0xF0])


def _table_segment(kind: int, symbols: bytes) -> bytes:
    return struct.pack(">BBHB", 0xFF, 0xC4, 19 + len(symbols), kind << 4) + bytes([0, 0, 0, len(symbols)] + [0] * 12) + symbols


def _dimensions(blocks: int) -> tuple[int, int]:
    """MCUs across and down for so many blocks, six in an MCU."""
    mcus = -(-blocks // 6)
    across = min(4095, max(1, int(np.ceil(np.sqrt(mcus)))))
    return across, max(1, -(-mcus // across))


def _header(across: int, down: int) -> bytes:
    out = b"\xff\xd8" + b"\xff\xdb" + struct.pack(">HB", 67, 0) + b"\x01" * 64
    out += b"\xff\xc2" + struct.pack(">HBHHB", 17, 8, down * 16, across * 16, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
    return out + _table_segment(0, DC_SYMBOLS) + _table_segment(1, AC_SYMBOLS) + b"\xff\xdd" + struct.pack(">HH", 4, RESTART)


def _scan_header(component: int, first: int, last: int, high: int, low: int) -> bytes:
    return b"\xff\xda" + struct.pack(">HB", 8, 1) + bytes([component + 1, 0, first, last, high << 4 | low])


def _sizes(v: np.ndarray) -> np.ndarray:
    """Bits of magnitudes."""
    return np.frexp(v.astype(np.float32))[1].astype(np.int64)


def _streams(bits: np.ndarray, code: np.ndarray, stream: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Items (bits, code) of n streams, in order, as bytes; each stream ends on a byte, filled with ones.  Also the byte edges."""
    total = np.bincount(stream, bits, n).astype(np.int64)
    size = (total + 7) // 8
    edge = np.concatenate([[0], np.cumsum(size)])
    run = np.cumsum(bits)
    first = np.concatenate([[0], np.cumsum(total)])[:-1]
    at = run - bits + (edge[:-1] * 8 - first)[stream]
    byte = at >> 3
    wide = code << (24 - bits - (at & 7))
    out = np.bincount(byte, wide >> 16, int(edge[-1]) + 2)
    out[1:] += np.bincount(byte, (wide >> 8) & 255, int(edge[-1]) + 1)
    out[2:] += np.bincount(byte, wide & 255, int(edge[-1]))
    out = out[: int(edge[-1])].astype(np.int64)
    fill = size * 8 - total
    out[edge[1:][size > 0] - 1] |= ((1 << fill) - 1)[size > 0]
    return out.astype(np.uint8), edge


def store(data: np.ndarray, offs: np.ndarray) -> list[bytes]:
    """A progressive JPEG for each payload; their lengths are multiples of 64."""
    n_files = len(offs) - 1
    blocks = np.diff(offs) // 64
    dims = [_dimensions(int(k)) for k in blocks]
    quads = np.array([a * d for a, d in dims], np.int64)
    rows_of = 6 * quads
    edge = np.concatenate([[0], np.cumsum(rows_of)])
    coef = np.zeros((int(edge[-1]), 64), np.int16)
    used = np.zeros(len(coef), bool)
    at = S.segment_positions(edge[:-1], blocks)
    b = data.reshape(-1, 64).astype(np.int16)
    coef[at] = np.where(b < 128, b - 130, b - 125)
    used[at] = True
    # one scan a component; the blocks of a component are consecutive rows, and so are those of a restart interval
    count = np.stack([4 * quads, quads, quads], 1).reshape(-1)
    per = -(-count // RESTART)
    n_streams = int(per.sum())
    of_component = np.repeat(np.arange(len(count)), count)
    within = S.segment_positions(np.zeros(len(count), np.int64), count)
    stream = np.concatenate([[0], np.cumsum(per)])[:-1][of_component] + within // RESTART
    last_of_scan = np.zeros(n_streams, bool)
    last_of_scan[np.cumsum(per) - 1] = True
    scans = []  # (header parameters, bytes of all scans, edge of each scan)

    def finish(params, packed, cut):
        # restart markers between the intervals of a scan, a zero after each byte of ones
        mark = ~last_of_scan
        number = S.segment_positions(np.zeros(len(per), np.int64), per) % 8
        start = cut[:-1] + 2 * np.concatenate([[0], np.cumsum(mark)])[:-1]
        out = np.zeros(len(packed) + 2 * int(mark.sum()), np.uint8)
        size = np.diff(cut)
        place = S.segment_positions(start, size)
        out[place] = packed
        after = (start + size)[mark]
        out[after], out[after + 1] = 0xFF, 0xD0 + number[mark]
        plain = np.zeros(len(out), bool)
        plain[place] = True
        more = (out == 0xFF) & plain
        where = np.arange(len(out)) + np.concatenate([[0], np.cumsum(more)])[:-1]
        final = np.zeros(len(out) + int(more.sum()), np.uint8)
        final[where] = out
        first = np.concatenate([[0], np.cumsum(per)])[:-1]
        begin = np.append(start[first], len(out))
        scans.append((params, final.tobytes(), np.append(where, len(final))[begin].tolist()))

    dc = coef[:, 0] >> 1
    diff = dc.astype(np.int64)
    diff[1:] -= dc[:-1]
    fresh = within % RESTART == 0
    diff[fresh] = dc[fresh]
    size = _sizes(np.abs(diff))
    finish((0, 0, 0, 1), *_streams(4 + size, (size << size) + np.where(diff < 0, diff + (1 << size) - 1, diff), stream, n_streams))
    for lo, hi in BANDS:
        v = coef[:, lo : hi + 1].astype(np.int64)
        m = np.abs(v) >> 1
        size = _sizes(m)
        bits = np.zeros((len(v), hi - lo + 2), np.int64)
        code = np.zeros_like(bits)
        bits[:, 1:] = 4 + size
        code[:, 1:] = (size << size) + np.where(v < 0, (1 << size) - 1 - m, m)
        bits[~used] = 0
        bits[~used, 0] = 4  # an empty block ends at once (symbol 0)
        code[~used] = 0
        some = bits.reshape(-1) > 0
        finish((lo, hi, 0, 1), *_streams(bits.reshape(-1)[some], code.reshape(-1)[some], np.repeat(stream, hi - lo + 2)[some], n_streams))
    finish((0, 0, 1, 0), *_streams(np.ones(len(coef), np.int64), (coef[:, 0] & 1).astype(np.int64), stream, n_streams))
    for lo, hi in BANDS:
        # no coefficient is new here: the block ends at once, then one bit for each that is not zero
        width = 4 + hi - lo + 1
        bit = np.zeros((len(coef), width), np.uint8)
        bit[:, 4:] = np.abs(coef[:, lo : hi + 1]) & 1
        n_bits = np.where(used, width, 4)
        total = np.bincount(stream, n_bits, n_streams).astype(np.int64)
        size = (total + 7) // 8
        cut = np.concatenate([[0], np.cumsum(size)])
        flat = np.ones(int(cut[-1]) * 8, np.uint8)
        run = np.cumsum(n_bits) - n_bits
        place = run + (cut[:-1] * 8 - np.concatenate([[0], np.cumsum(total)])[:-1])[stream]
        flat[S.segment_positions(place, n_bits)] = bit[np.arange(width)[None, :] < n_bits[:, None]]
        finish((lo, hi, 1, 0), np.packbits(flat), cut)
    files = []
    for k in range(n_files):
        parts = [_header(*dims[k])]
        for params, raw, cut in scans:
            for c in range(3):
                parts += [_scan_header(c, *params), raw[cut[3 * k + c] : cut[3 * k + c + 1]]]
        files.append(b"".join([*parts, b"\xff\xd9"]))
    return files


class Image:
    """Where a file's coefficients stand, and how its components lie."""

    def __init__(self, width, height, parts):
        self.width, self.height, self.parts = width, height, parts  # parts: [id, h, v, quant]
        self.h, self.v = max(p[1] for p in parts), max(p[2] for p in parts)
        self.across, self.down = -(-width // (8 * self.h)), -(-height // (8 * self.v))
        self.sizes = [self.across * p[1] * self.down * p[2] for p in parts]
        self.base = 0

    def first_row(self, c: int) -> int:
        return self.base + sum(self.sizes[:c])

    def order(self, comps: list[int]) -> np.ndarray:
        """Rows of a scan's blocks in coding order."""
        if len(comps) == 1:
            c = comps[0]
            _, h, v, _ = self.parts[c]
            wide = -(-(-(-self.width * h // self.h)) // 8)
            high = -(-(-(-self.height * v // self.v)) // 8)
            stride = self.across * h
            if wide == stride:
                return self.first_row(c) + np.arange(wide * high)
            return self.first_row(c) + (np.arange(high)[:, None] * stride + np.arange(wide)[None, :]).reshape(-1)
        y, x = np.divmod(np.arange(self.across * self.down), self.across)
        out = []
        for c in comps:
            _, h, v, _ = self.parts[c]
            for j in range(v):
                for i in range(h):
                    out.append(self.first_row(c) + (y * v + j) * (self.across * h) + x * h + i)
        return np.stack(out, 1).reshape(-1)


_lookup: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}


def lookup(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and code length for each 16 bits that may come, from a table's lengths and symbols."""
    if body not in _lookup:
        symbol, length = np.zeros(65536, np.int64), np.full(65536, 17, np.int64)
        code, k = 0, 16
        for n in range(1, 17):
            for _ in range(body[n - 1]):
                a = code << (16 - n)
                symbol[a : a + (1 << (16 - n))], length[a : a + (1 << (16 - n))] = body[k], n
                code, k = code + 1, k + 1
            code <<= 1
        _lookup[body] = symbol, length
    return _lookup[body]


def _parse(raw: bytes, base: int, stops: list[int], at: int):
    """The image and its scans: [(params, components, tables, restart, start, end)]; stops: marker places from index at."""
    image, quant, dc, ac, restart, scans = None, {}, {}, {}, 0, []
    pos, n = 2, len(raw)
    if raw[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG file")
    while pos + 4 <= n:
        kind = raw[pos + 1]
        if raw[pos] != 0xFF:
            raise ValueError("a JPEG marker is missing")
        if kind == 0xD9:
            break
        size = raw[pos + 2] << 8 | raw[pos + 3]
        body = raw[pos + 4 : pos + 2 + size]
        pos += 2 + size
        if kind == 0xDB:
            while body:
                wide = body[0] >> 4
                quant[body[0] & 15] = np.frombuffer(body[1 : 65 + 64 * wide], ">u2" if wide else "u1").astype(np.int64)
                body = body[65 + 64 * wide :]
        elif kind == 0xC2:
            _, high, width, n_parts = struct.unpack(">BHHB", body[:6])
            image = Image(width, high, [[body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]] for k in range(n_parts)])
        elif kind in (0xC0, 0xC1, 0xC3) or 0xC5 <= kind <= 0xCF and kind not in (0xC8, 0xCC):
            raise ValueError("not a progressive JPEG with Huffman codes")
        elif kind == 0xC4:
            while body:
                length = 17 + sum(body[1:17])
                (ac if body[0] >> 4 else dc)[body[0] & 15] = body[1:length]
                body = body[length:]
        elif kind == 0xDD:
            restart = body[0] << 8 | body[1]
        elif kind == 0xDA:
            ids = [p[0] for p in image.parts]
            comps = [ids.index(body[1 + 2 * k]) for k in range(body[0])]
            lo, hi, hl = body[1 + 2 * body[0] : 4 + 2 * body[0]]
            table = tuple(dc.get(body[2 + 2 * k] >> 4) for k in range(body[0])) if lo == 0 else (ac.get(body[2] & 15),)
            while stops[at] < base + pos:
                at += 1
            end = stops[at] - base
            scans.append(((lo, hi, hl >> 4, hl & 15, table if lo or not hl >> 4 else ()), comps, restart, base + pos, base + end))
            pos = end
    image.quant = [quant[p[3]] for p in image.parts]
    return image, scans, at


class _Bits:
    """Windows of 32 bits at any bit of a buffer."""

    def __init__(self, data: np.ndarray):
        d = np.concatenate([data, np.full(16, 255, np.uint8)]).astype(np.uint64)
        self.word = d[:-7] << np.uint64(32) | d[1:-6] << np.uint64(24) | d[2:-5] << np.uint64(16) | d[3:-4] << np.uint64(8) | d[4:-3]
        self.word = self.word.view(np.int64)  # 40 bits each
        self.data = d.astype(np.uint8)

    def peek(self, pos: np.ndarray) -> np.ndarray:
        """The next 32 bits."""
        return (self.word[pos >> 3] >> (8 - (pos & 7))) & 0xFFFFFFFF

    def bit(self, pos: np.ndarray) -> np.ndarray:
        return (self.data[pos >> 3] >> (7 - (pos & 7)).astype(np.uint8)) & 1


def decode(files: list[bytes]) -> tuple[np.ndarray, list[Image]]:
    """Coefficients (blocks x 64, zigzag order) of all files, and the images."""
    whole = np.frombuffer(b"".join(files) + b"\xff\xd9", np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(f) for f in files])])
    ones = np.flatnonzero(whole[:-1] == 0xFF)
    after = whole[ones + 1]
    stuffed = ones[after == 0] + 1
    rst = ones[(after >= 0xD0) & (after <= 0xD7)]
    stops = ones[(after != 0) & (after != 0xFF) & ~((after >= 0xD0) & (after <= 0xD7))].tolist()
    images, phases, at, rows = [], {}, 0, 0
    for k, raw in enumerate(files):
        image, scans, at = _parse(raw, int(offs[k]), stops, at)
        image.base = rows
        rows += sum(image.sizes)
        images.append(image)
        # scans of different components with the same parameters go together
        step, seen, before = -1, set(), None
        for params, comps, restart, start, end in scans:
            if params != before or seen & set(comps):
                step, seen, before = step + 1, set(), params
            seen |= set(comps)
            phases.setdefault((step, params), []).append((k, comps, restart, start, end))
    coef = np.zeros((rows, 64), np.int32)
    keep = np.ones(len(whole), bool)
    keep[stuffed] = False
    bits = _Bits(whole[keep])
    gone = np.concatenate([[0], np.cumsum(~keep)])
    for (_, params), scans in sorted(phases.items(), key=lambda x: x[0][0]):
        starts, counts, orders, units = [], [], [], []
        los = np.searchsorted(rst, [s[3] for s in scans])
        his = np.searchsorted(rst, [s[4] for s in scans])
        for (k, comps, restart, start, end), lo, hi in zip(scans, los.tolist(), his.tolist(), strict=True):
            order = images[k].order(comps)
            unit = 1 if len(comps) == 1 else sum(images[k].parts[c][1] * images[k].parts[c][2] for c in comps)
            each = restart * unit if restart else len(order)
            begin = [start, *(rst[lo:hi] + 2).tolist()]
            if len(begin) != -(-len(order) // each):
                raise ValueError("a scan has the wrong number of restart intervals")
            starts += begin
            counts += [min(each, len(order) - j) for j in range(0, len(order), each)]
            orders.append(order)
            if unit > 1:
                units += [(images[k], comps)] * len(begin)
        first = np.concatenate([[0], np.cumsum(counts)])[:-1]
        begin = np.array(starts, np.int64)
        pos = (begin - gone[begin]) * 8
        order = np.concatenate(orders)
        counts = np.array(counts, np.int64)
        # intervals with many blocks first, so that those still running are always a prefix
        by = np.argsort(-counts, kind="stable")
        args = coef, bits, pos[by], order, first[by], counts[by]
        lo, hi, high, low, table = params
        if lo == 0:
            of = None
            if len(set(table)) > 1 or units:
                pattern = [[c for c in comps for _ in range(im.parts[c][1] * im.parts[c][2])] for im, comps in (units or [(images[k], comps) for k, comps, *_ in scans])]
                if len({tuple(p) for p in pattern}) > 1:
                    raise ValueError("files with unlike interleaved scans must be decoded apart")
                of = pattern[0], scans[0][1]
            (_dc_refine if high else _dc_first)(*args, low, table, of)
        else:
            (_ac_refine if high else _ac_first)(*args, lo, hi, low, lookup(table[0]))
    return coef, images


def _extend(v: np.ndarray, s: np.ndarray) -> np.ndarray:
    return np.where(v < (1 << s >> 1), v - (1 << s) + 1, v)


def _dc_first(coef, bits, pos, order, first, counts, low, table, of) -> None:
    tables = [lookup(t) for t in table]
    last = {}
    for t in range(int(counts[0]) if len(counts) else 0):
        n = int(np.searchsorted(-counts, -t, "left"))
        comp = of[0][t % len(of[0])] if of else 0
        symbol, length = tables[of[1].index(comp) if of else 0]
        w = bits.peek(pos[:n])
        top = w >> 16
        size, used = symbol[top], length[top]
        v = _extend(w >> (32 - used - size) & ((1 << size) - 1), size)
        if comp not in last:
            last[comp] = np.zeros(len(counts), np.int64)
        last[comp][:n] += v
        coef[order[first[:n] + t], 0] = last[comp][:n] << low
        pos[:n] += used + size


def _dc_refine(coef, bits, pos, order, first, counts, low, table, of) -> None:
    stream = np.repeat(np.arange(len(counts)), counts)
    t = S.segment_positions(np.zeros(len(counts), np.int64), counts)
    rows = order[first[stream] + t]
    coef[rows, 0] |= bits.bit(pos[stream] + t).astype(np.int32) << low


def _ac_first(coef, bits, pos, order, first, counts, lo, hi, low, table) -> None:
    symbol, length = table
    flat = coef.reshape(-1)
    live = np.arange(len(counts))
    block = first.copy()
    past = first + counts
    k = np.full(len(counts), lo, np.int64)
    row = order[block] * 64
    while len(live):
        w = bits.peek(pos)
        top = w >> 16
        rs, used = symbol[top], length[top]
        size, run = rs & 15, rs >> 4
        if int(used.max()) > 16:
            raise ValueError("unknown Huffman code")
        pos = pos + used + size
        value = _extend(w >> (32 - used - size) & ((1 << size) - 1), size)
        k = k + run
        on = size > 0
        if on.all():
            flat[row + k] = value << low
            k += 1
            done = k > hi
        else:
            flat[row[on] + k[on]] = (value << low)[on]
            k += 1
            end = ~on & (run < 15)
            at = np.flatnonzero(end)
            if len(at):  # a run of blocks that end here: 2**run and as many more as the next bits say
                r = run[at]
                more = w[at] >> (32 - used[at] - r) & ((1 << r) - 1)
                pos[at] += r
                block[at] += (1 << r) + more - 1
            done = (k > hi) | end
        at = np.flatnonzero(done)
        if len(at):
            block[at] += 1
            k[at] = lo
            left = block < past
            if not left.all():
                pos, block, past, k, live = pos[left], block[left], past[left], k[left], live[left]
                row = order[block] * 64
            else:
                row[at] = order[block[at]] * 64


def _ac_refine(coef, bits, pos, order, first, counts, lo, hi, low, table) -> None:
    symbol, length = table
    ended = np.zeros(len(counts), np.int64)  # blocks, with this one, that hold corrections only
    for t in range(int(counts[0]) if len(counts) else 0):
        n = int(np.searchsorted(-counts, -t, "left"))
        rows = order[first[:n] + t]
        here = coef[rows, lo : hi + 1]
        was = here != 0
        cursor = np.zeros(n, np.int64)  # next coefficient of each block
        busy = np.flatnonzero(ended[:n] == 0)
        while len(busy):
            w = bits.peek(pos[busy])
            top = w >> 16
            rs, used = symbol[top], length[top]
            if int(used.max()) > 16:
                raise ValueError("unknown Huffman code")
            size, run = rs & 15, rs >> 4
            sign = w >> (31 - used) & 1
            end = (size == 0) & (run < 15)
            pos[busy] += used + size
            if end.any():
                at, r = busy[end], run[end]
                more = w[end] >> (32 - used[end] - r) & ((1 << r) - 1)
                pos[at] += r
                ended[at] = (1 << r) + more
            go = ~end
            busy, run, size, sign = busy[go], run[go], size[go], sign[go]
            for j, (i, r) in enumerate(zip(busy.tolist(), run.tolist(), strict=True)):
                # a new coefficient after r zeros; those that are not zero on the way get a bit each
                zeros = np.flatnonzero(~was[i, cursor[i] :]) + cursor[i]
                if len(zeros) <= r:
                    raise ValueError("a refinement run leaves its band")
                to = int(zeros[r])
                _correct(here, was, bits, pos, i, int(cursor[i]), to, low)
                if size[j]:
                    here[i, to] = (1 if sign[j] else -1) << low
                cursor[i] = to + 1
            busy = busy[cursor[busy] <= hi - lo]
        ready = np.flatnonzero(ended[:n] > 0)
        if len(ready):
            left = was[ready] & (np.arange(hi - lo + 1)[None, :] >= cursor[ready][:, None])
            count = left.sum(axis=1)
            r, c = np.nonzero(left)
            at = S.segment_positions(pos[ready], count)
            one = bits.bit(at) > 0
            r, c = ready[r[one]], c[one]
            here[r, c] += np.sign(here[r, c]) << low
            pos[ready] += count
            ended[ready] -= 1
        coef[rows, lo : hi + 1] = here


def _correct(here, was, bits, pos, i, a, z, low) -> None:
    at = np.flatnonzero(was[i, a:z]) + a
    if len(at):
        one = bits.bit(pos[i] + np.arange(len(at))) > 0
        here[i, at[one]] += np.sign(here[i, at[one]]) << low
        pos[i] += len(at)


_SCALE = 12


def _inverse() -> np.ndarray:
    """The inverse transform of zigzag coefficients as whole numbers, scaled: sums of products are exact in any order."""
    x, u = np.meshgrid(np.arange(8), np.arange(8), indexing="ij")
    c = np.cos((2 * x + 1) * u * np.pi / 16) / 2
    c[:, 0] /= np.sqrt(2)
    both = np.einsum("yv,xu->vuyx", c, c).reshape(64, 64)
    return np.rint(both * (1 << _SCALE))[ZIGZAG]


_INVERSE = _inverse()


def tensors(coef: np.ndarray, images: list[Image]) -> list[np.ndarray]:
    """Full-resolution RGB, height x width x 3, of each image; chroma samples are repeated."""
    out = []
    plain = all((q == 1).all() for im in images for q in im.quant)
    if plain:
        # whole numbers below 2**24 are exact in single precision
        exact = np.float32 if np.abs(coef).max(initial=0) * 64 * 1024 < 1 << 24 else np.float64
        pixels = _pixels(coef, exact)
    for im in images:
        planes = []
        for c, (_, h, v, _) in enumerate(im.parts):
            a = im.first_row(c)
            rows = slice(a, a + im.sizes[c])
            px = pixels[rows] if plain else _pixels(coef[rows] * im.quant[c], np.float64)
            px = px.reshape(im.down * v, im.across * h, 8, 8).transpose(0, 2, 1, 3).reshape(im.down * v * 8, im.across * h * 8)
            if (h, v) != (im.h, im.v):
                px = px.repeat(im.v // v, axis=0).repeat(im.h // h, axis=1)
            planes.append(px[: im.height, : im.width])
        if len(planes) == 1:
            out.append(np.repeat(planes[0][:, :, None], 3, axis=2))
            continue
        y, cb, cr = planes[0].astype(np.int32), planes[1].astype(np.int32) - 128, planes[2].astype(np.int32) - 128
        rgb = np.empty((*y.shape, 3), np.uint8)
        rgb[:, :, 0] = np.clip(y + ((91881 * cr + 32768) >> 16), 0, 255)
        rgb[:, :, 1] = np.clip(y - ((22554 * cb + 46802 * cr - 32768) >> 16), 0, 255)
        rgb[:, :, 2] = np.clip(y + ((116130 * cb + 32768) >> 16), 0, 255)
        out.append(rgb)
    return out


def _pixels(coef: np.ndarray, kind) -> np.ndarray:
    out = np.empty(coef.shape, np.uint8)
    matrix = _INVERSE.astype(kind)
    for k in range(0, len(coef), 8192):
        s = (coef[k : k + 8192].astype(kind) @ matrix).astype(np.int64)
        out[k : k + 8192] = np.clip(((s + (1 << (_SCALE - 1))) >> _SCALE) + 128, 0, 255)
    return out


def load(coef: np.ndarray, images: list[Image]) -> list[bytes]:
    """The bytes that store() put into coefficients: all blocks that are not zero."""
    c = coef.astype(np.int16)
    raw = np.where(c < 0, c + 130, c + 125).astype(np.uint8)
    used = c[:, 0] != 0
    out = []
    for im in images:
        n = sum(im.sizes)
        k = int(used[im.base : im.base + n].sum())
        out.append(raw[im.base : im.base + k].tobytes())
    return out
