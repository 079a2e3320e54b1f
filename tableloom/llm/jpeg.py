"""Progressive JPEG in numpy: many images at a time, restart interval beside restart interval.

The decoder keeps one array of coefficients for all images of a batch. Each scan
adds to it: a band of the spectrum (spectral selection) at some precision, or one more bit
of it (successive approximation). Entropy-coded data is serial only inside a
restart interval, so all intervals of all images are decoded in step, one symbol
of each at a time. Then the coefficients are inverse-transformed as one matrix
product, chroma is upsampled and the planes become RGB tensors.

The encoder stores bytes as coefficients: each byte plus 256 is one coefficient of a
three-component 4:2:0 image, written in eleven scans with restart markers.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass, field

import numpy as np

#: The order in which a block's coefficients are stored: diagonals, alternately down and up.
ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, (i // 8 if (i // 8 + i % 8) % 2 else i % 8))))
#: Blocks or units between restart markers, and the widest image in units of 16 samples.
INTERVAL, WIDEST = 8, 64
#: Units in 16 bits of samples; an image grows wider than WIDEST when it would be higher.
HIGHEST = 4095
OFFSET = 256
_AC = {0x08: (0, 1)} | {n << 4: (0b10000 + n, 5) for n in range(15)}
_SCANS = [("dc", 0, 1)] + [("ac", c, lo, hi) for lo, hi in ((1, 5), (6, 63)) for c in range(3)] + [("dc", 1, 0)] + [("fine", c) for c in range(3)]


def _matrix() -> np.ndarray:
    """The inverse transform of a zigzag block as one 64 by 64 matrix."""
    u = np.arange(8)
    one = np.cos((2 * u[None, :] + 1) * u[:, None] * np.pi / 16) * np.where(u == 0, np.sqrt(0.125), 0.5)[:, None]
    return np.kron(one, one)[ZIGZAG].astype(np.float32)


_INVERSE = _matrix()


# --- storing bytes -----------------------------------------------------------------------------------------------


def shape_for(blocks: int) -> tuple[int, int]:
    """Width and height, in units of 16 samples, of the image for so many blocks of 64 bytes."""
    units = -(-blocks // 6)
    wide = min(units, max(WIDEST, -(-units // HIGHEST)))
    if wide > HIGHEST:
        raise ValueError(f"a payload of {64 * blocks} bytes is more than an image of {16 * HIGHEST} by {16 * HIGHEST} samples holds")
    return wide, -(-units // wide)


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _head(wide: int, high: int, size: int) -> bytes:
    parts = [b"\xff\xd8", _segment(0xE0, b"JFIF\0\x01\x01\0\0\x01\0\x01\0\0"), _segment(0xDB, b"\0" + b"\x01" * 64)]
    parts.append(_segment(0xFE, b"payload %d" % size))
    parts.append(_segment(0xC2, struct.pack(">BHHB", 8, 16 * high, 16 * wide, 3) + b"\x01\x22\0\x02\x11\0\x03\x11\0"))
    parts.append(_segment(0xC4, b"\0" + bytes([0, 0, 0, 12] + [0] * 12) + bytes(range(12))))
    parts.append(_segment(0xC4, b"\x10" + bytes([1, 0, 0, 0, 15] + [0] * 11) + bytes(_AC)))
    return b"".join([*parts, _segment(0xDD, struct.pack(">H", INTERVAL))])


def _scan_head(scan: tuple) -> bytes:
    if scan[0] == "dc":
        return _segment(0xDA, b"\x03\x01\0\x02\0\x03\0" + bytes([0, 0, scan[1] << 4 | scan[2]]))
    lo, hi, bits = (scan[2], scan[3], 0x01) if scan[0] == "ac" else (1, 63, 0x10)
    return _segment(0xDA, bytes([1, scan[1] + 1, 0, lo, hi, bits]))


def _unit_order(wide: int, high: int) -> np.ndarray:
    """Blocks of an image, counted through its components, in the order of interleaved units."""
    n = wide * high
    y, x = np.divmod(np.arange(n), wide)
    corner = 4 * wide * y + 2 * x
    return np.stack([corner, corner + 1, corner + 2 * wide, corner + 2 * wide + 1, 4 * n + np.arange(n), 5 * n + np.arange(n)], 1)


class _Bits:
    """Codes of all intervals of one kind of scan, packed row by row."""

    @staticmethod
    def pack(codes: np.ndarray, lengths: np.ndarray, group: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of each group one after the other, filled up with ones, and the bytes in each group."""
        total = np.bincount(group, lengths, groups).astype(np.int64)
        size = -(-total // 8)
        begin = 8 * (np.cumsum(size) - size)
        bits = np.ones(8 * int(size.sum()), np.uint8)
        before = np.cumsum(lengths) - lengths
        first = before[np.searchsorted(group, np.arange(groups))] if len(group) else before
        at = begin[group] + before - first[group]
        inner = np.arange(int(lengths.sum())) - np.repeat(before, lengths)
        shift = np.repeat(lengths, lengths) - 1 - inner
        bits[np.repeat(at, lengths) + inner] = (np.repeat(codes, lengths) >> shift) & 1
        return np.packbits(bits), size


def _join(data: np.ndarray, sizes: np.ndarray, first: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Interval data with stuffing and, before all but the first interval of a scan, restart markers; bytes of each interval."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    full = data == 0xFF
    stuffed = sizes + np.bincount(owner[full], minlength=len(sizes))
    number = np.arange(len(sizes)) - np.maximum.accumulate(np.where(first, np.arange(len(sizes)), 0))
    total = stuffed + np.where(first, 0, 2)
    start = np.cumsum(total) - total
    out = np.zeros(int(total.sum()), np.uint8)
    marked = ~first
    out[start[marked]] = 0xFF
    out[start[marked] + 1] = 0xD0 + (number[marked] - 1) % 8
    shift = np.cumsum(full) - full
    in_row = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + shift - np.repeat(np.append(shift, shift[-1:])[np.cumsum(sizes) - sizes], sizes)
    out[start[owner] + np.where(first, 0, 2)[owner] + in_row] = data
    return out.tobytes(), total


def store(payloads: list[bytes]) -> list[bytes]:
    """Each payload, of a multiple of 64 bytes, as a progressive JPEG whose coefficients hold its bytes."""
    if not payloads:
        return []
    shapes = [shape_for(len(p) // 64) for p in payloads]
    units = np.array([w * h for w, h in shapes])
    coded = np.zeros((int(6 * units.sum()), 64), np.uint8)
    starts = 6 * (np.cumsum(units) - units)
    for p, at in zip(payloads, starts):
        coded[at:at + len(p) // 64] = np.frombuffer(p, np.uint8).reshape(-1, 64)
    value = coded.astype(np.int32) + OFFSET
    scans: list[list[bytes]] = []
    # blocks of one component of all images, with the interval of each
    rows = {c: np.concatenate([np.arange(a + o * n, a + e * n) for a, n in zip(starts, units)]) for c, (o, e) in enumerate(((0, 4), (4, 5), (5, 6)))}
    order = np.concatenate([(_unit_order(w, h) + a).ravel() for (w, h), a in zip(shapes, starts)])
    for scan in _SCANS:
        kind = scan[0]
        per = units * (1 if kind == "dc" or scan[1] else 4)
        intervals = -(-per // INTERVAL)
        width = 6 if kind == "dc" else 1
        inside = np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per)
        group = np.repeat(np.cumsum(intervals) - intervals, per) + inside // INTERVAL
        groups = int(intervals.sum())
        if kind == "dc" and scan[1] == 0:
            now = value[order, 0] >> 1
            owner = np.repeat(group, 6)
            comp = np.tile([0, 0, 0, 0, 1, 2], len(group))
            difference = np.empty_like(now)
            for c in range(3):
                at = np.flatnonzero(comp == c)
                before = np.concatenate(([0], now[at][:-1]))
                before[np.concatenate(([True], owner[at][1:] != owner[at][:-1]))] = 0
                difference[at] = now[at] - before
            size = np.ceil(np.log2(np.abs(difference) + 1)).astype(np.int64)
            extra = np.where(difference < 0, difference + (1 << size) - 1, difference)
            data, sizes = _Bits.pack(size << size | extra, 4 + size, owner, groups)
        elif kind == "dc":
            data, sizes = _Bits.pack(value[order, 0] & 1, np.ones(len(order), np.int64), np.repeat(group, 6), groups)
        else:
            mine = coded[rows[scan[1]]]
            if kind == "ac":
                high = (mine[:, scan[2]:scan[3] + 1] >> 1) | 0x80
                bits = np.zeros((*high.shape, 9), np.uint8)
                bits[..., 1:] = np.unpackbits(high[..., None], axis=2)
                bits, head = bits.reshape(len(mine), -1), None
            else:
                bits = mine[:, 1:] & 1
                # all blocks of an interval end at once: one end-of-block run, then a correction bit for each coefficient
                head = np.bincount(group, minlength=groups)
            data, sizes = _rows(bits, group, groups, head)
        first = np.zeros(groups, bool)
        first[np.cumsum(intervals) - intervals] = True
        whole, total = _join(data, sizes, first)
        ends = np.cumsum(total)[np.cumsum(intervals) - 1]
        scans.append([whole[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())])
    heads = [_scan_head(s) for s in _SCANS]
    return [
        _head(w, h, len(p)) + b"".join(x for head, scan in zip(heads, scans) for x in (head, scan[i])) + b"\xff\xd9"
        for i, (p, (w, h)) in enumerate(zip(payloads, shapes))
    ]


def _rows(bits: np.ndarray, group: np.ndarray, groups: int, runs: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of equally many bits packed by interval; ``runs`` puts an end-of-block run before each interval."""
    count = np.bincount(group, minlength=groups)
    each = bits.shape[1]
    body = np.ones((groups, int(count.max()) * each), np.uint8)
    place = np.arange(len(group)) - np.searchsorted(group, np.arange(groups))[group]
    body.reshape(groups, -1, each)[group, place] = bits
    if runs is None:
        used, out = count * each, body
    else:
        power = np.floor(np.log2(runs)).astype(np.int64)
        lead = 5 + power
        used = lead + count * each
        out = np.ones((groups, int(lead.max()) + body.shape[1]), np.uint8)
        code = (0b10000 + power) << power | (runs - (1 << power))
        for n in np.unique(lead):
            rows = np.flatnonzero(lead == n)
            out[rows, :n] = (code[rows, None] >> (n - 1 - np.arange(n))) & 1
            out[rows, n:n + body.shape[1]] = body[rows]
    size = -(-used // 8)
    packed = np.packbits(out, axis=1)
    # what lies beyond an interval's last bit is ones, as the format fills up
    packed = np.pad(packed, ((0, 0), (0, max(0, int(size.max()) - packed.shape[1]))), constant_values=255)
    spare = size * 8 - used
    packed[np.arange(groups), size - 1] |= ((1 << spare) - 1).astype(np.uint8)
    return packed[np.arange(packed.shape[1]) < size[:, None]], size


# --- reading ----------------------------------------------------------------------------------------------------


@dataclass
class Image:
    """What the markers of one file say; ``blocks`` is the row of its first block among all."""

    wide: int = 0
    high: int = 0
    comps: list = field(default_factory=list)
    scans: list = field(default_factory=list)
    payload: int = 0
    blocks: int = 0


def _table(counts: bytes, symbols: bytes) -> tuple:
    """A table from the next 16 bits to (code length, symbol)."""
    size, value, code, at = np.zeros(65536, np.uint8), np.zeros(65536, np.uint8), 0, 0
    for n in range(1, 17):
        for _ in range(counts[n - 1]):
            lo = code << (16 - n)
            size[lo:lo + (1 << (16 - n))], value[lo:lo + (1 << (16 - n))] = n, symbols[at]
            code, at = code + 1, at + 1
        code <<= 1
    return size, value


def parse(data: bytes, tables: dict) -> Image:
    """Headers and the byte ranges of the scans of a progressive file."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG file")
    image, at, quant, huff, interval = Image(), 2, {}, {}, 0
    while at < len(data):
        marker, size = data[at + 1], 0
        if marker == 0xD9:
            break
        size = struct.unpack(">H", data[at + 2:at + 4])[0]
        body = data[at + 4:at + 2 + size]
        at += 2 + size
        if marker == 0xDB:
            while body:
                n = 128 if body[0] >> 4 else 64
                quant[body[0] & 15] = np.frombuffer(body[1:1 + n], ">u2" if n == 128 else np.uint8).astype(np.float32)
                body = body[1 + n:]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                key = body[1:17 + n]
                if key not in tables:
                    tables[key] = _table(key[:16], key[16:])
                huff[body[0]], body = key, body[17 + n:]
        elif marker == 0xDD:
            interval = struct.unpack(">H", body)[0]
        elif marker == 0xFE and body.startswith(b"payload "):
            image.payload = int(body[8:])
        elif marker == 0xC2:
            bits, image.high, image.wide, n = struct.unpack(">BHHB", body[:6])
            if bits != 8 or n not in (1, 3):
                raise ValueError("only 8-bit images of one or three components")
            image.comps = [{"id": body[6 + 3 * i], "h": body[7 + 3 * i] >> 4, "v": body[7 + 3 * i] & 15, "q": body[8 + 3 * i]} for i in range(n)]
            _lay_out(image)
        elif 0xC0 <= marker <= 0xCF:
            raise ValueError("not a progressive file")
        elif marker == 0xDA:
            n = body[0]
            ids = [c["id"] for c in image.comps]
            used = [(ids.index(body[1 + 2 * i]), body[2 + 2 * i]) for i in range(n)]
            lo, hi, bits = body[1 + 2 * n:4 + 2 * n]
            end = at
            while True:
                end = data.index(b"\xff", end)
                if data[end + 1] != 0 and not 0xD0 <= data[end + 1] <= 0xD7:
                    break
                end += 2
            named = [(c, huff.get(t >> 4) if lo == 0 else huff.get(16 | t & 15)) for c, t in used]
            image.scans.append((named, lo, hi, bits >> 4, bits & 15, interval, at, end))
            at = end
    for c in image.comps:
        c["quant"] = quant[c["q"]]
    return image


def _lay_out(image: Image) -> None:
    """Blocks of each component: those of its own scans, and those that whole units hold."""
    hmax, vmax = max(c["h"] for c in image.comps), max(c["v"] for c in image.comps)
    units_x, units_y = -(-image.wide // (8 * hmax)), -(-image.high // (8 * vmax))
    at = 0
    for c in image.comps:
        c["own_x"], c["own_y"] = -(-(-(-image.wide * c["h"] // hmax)) // 8), -(-(-(-image.high * c["v"] // vmax)) // 8)
        c["x"], c["y"], c["at"] = units_x * c["h"], units_y * c["v"], at
        at += c["x"] * c["y"]
    image.units, image.size = (units_x, units_y), at


def _plan(image: Image, scan: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of a scan in coding order, a row for each unit, and the component of each column."""
    used = [c for c, _ in scan[0]]
    if len(used) == 1:
        c = image.comps[used[0]]
        y, x = np.divmod(np.arange(c["own_x"] * c["own_y"]), c["own_x"])
        return (image.blocks + c["at"] + y * c["x"] + x)[:, None], np.array(used)
    y, x = np.divmod(np.arange(image.units[0] * image.units[1]), image.units[0])
    columns, comps = [], []
    for i in used:
        c = image.comps[i]
        for v in range(c["v"]):
            for h in range(c["h"]):
                columns.append(image.blocks + c["at"] + (y * c["v"] + v) * c["x"] + x * c["h"] + h)
                comps.append(i)
    return np.stack(columns, 1), np.array(comps)


class _Lanes:
    """The restart intervals of scans alike, as lanes over one buffer of bits."""

    def __init__(self, parts: list[tuple[bytes, int, int]]):
        joined, starts, owner, at = [], [], [], 0
        for i, (data, lo, hi) in enumerate(parts):
            raw = np.frombuffer(data, np.uint8)[lo:hi]
            full = np.flatnonzero(raw[:-1] == 0xFF)
            after = raw[full + 1]
            restarts, keep = full[after != 0], np.ones(len(raw), bool)
            keep[full + 1] = False
            keep[restarts] = False
            kept_before = np.cumsum(keep)
            begin = np.concatenate(([0], kept_before[restarts]))
            clean = raw[keep]
            joined.append(clean)
            starts.append(at + begin)
            owner.append(np.full(len(begin), i))
            at += len(clean)
        data = np.concatenate([*joined, np.zeros(8, np.uint8)]).astype(np.uint32)
        self.words = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
        self.start, self.owner = np.concatenate(starts) * 8, np.concatenate(owner)

    def peek(self, at: np.ndarray) -> np.ndarray:
        """The next 16 bits at each position; beyond the end zeros."""
        at = np.minimum(at, (len(self.words) - 1) * 8)
        return (self.words[at >> 3] >> (16 - (at & 7)).astype(np.uint32)).astype(np.int64) & 0xFFFF

    def bits(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.peek(at) >> (16 - n)


def _extend(v: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where((n > 0) & (v < (1 << np.maximum(n - 1, 0))), v - (1 << n) + 1, v)


def decode(files: list[bytes]) -> tuple[list[Image], np.ndarray]:
    """Headers and coefficients, in zigzag order, of all blocks of all files."""
    tables: dict = {}
    images = [parse(f, tables) for f in files]
    total = 0
    for image in images:
        image.blocks, total = total, total + image.size
    coef = np.zeros((total, 64), np.int16)
    for step in range(max((len(i.scans) for i in images), default=0)):
        alike: dict[tuple, list[int]] = {}
        for n, image in enumerate(images):
            if step < len(image.scans):
                named, lo, hi, before, low, *_ = image.scans[step]
                alike.setdefault((tuple(named), lo, hi, before, low, tuple((c["h"], c["v"]) for c in image.comps)), []).append(n)
        for (named, lo, hi, before, low, _), who in alike.items():
            scans = [images[n].scans[step] for n in who]
            lanes = _Lanes([(files[n], s[6], s[7]) for n, s in zip(who, scans)])
            units, comps, first = [], None, []
            at = 0
            for n, s in zip(who, scans):
                order, comps = _plan(images[n], s)
                every = s[5] or len(order)
                first.append(at + np.arange(0, len(order), every))
                units.append(order)
                at += len(order)
            order = np.concatenate(units)
            begin = np.concatenate(first)
            end = np.concatenate((begin[1:], [len(order)]))
            if len(begin) != len(lanes.start):
                raise ValueError("restart markers do not fit the image")
            luts = {c: tables[k] for c, k in named if k is not None}
            if lo == 0 and before == 0:
                _dc_first(coef, lanes, order, comps, begin, end, luts, low)
            elif lo == 0:
                count = (end - begin) * order.shape[1]
                inside = np.arange(order.size) - np.repeat(np.cumsum(count) - count, count)
                bit = lanes.peek(np.repeat(lanes.start, count) + inside) >> 15
                coef[order.ravel(), 0] |= (bit << low).astype(np.int16)
            elif before == 0:
                _ac_first(coef, lanes, order[:, 0], begin, end, luts[comps[0]], lo, hi, low)
            else:
                _ac_refine(coef, lanes, order[:, 0], begin, end, luts[comps[0]], lo, hi, low)
    return images, coef


def _dc_first(coef, lanes, order, comps, begin, end, luts, low):
    at, unit = lanes.start.copy(), begin.copy()
    last = np.zeros((max(comps) + 1, len(at)), np.int64)
    while True:
        live = np.flatnonzero(unit < end)
        if not len(live):
            return
        for column, c in enumerate(comps):
            length, symbol = luts[c]
            code = lanes.peek(at[live])
            n = symbol[code].astype(np.int64)
            pos = at[live] + length[code]
            last[c, live] += _extend(lanes.bits(pos, n), n)
            at[live] = pos + n
            coef[order[unit[live], column], 0] = last[c, live] << low
        unit[live] += 1


def _ac_first(coef, lanes, order, begin, end, lut, lo, hi, low):
    length, symbol = lut
    flat = coef.reshape(-1)
    at, block, stop = lanes.start.copy(), begin.copy(), end
    k, skip = np.full(len(at), lo), np.zeros(len(at), np.int64)
    while len(at):
        code = lanes.peek(at)
        both = symbol[code].astype(np.int64)
        run, n = both >> 4, both & 15
        pos = at + length[code]
        value = lanes.bits(pos, np.where((n == 0) & (run < 15), run, n))
        coded = n > 0
        k = k + run
        if coded.all():
            flat[order[block] * 64 + k] = _extend(value, n) << low
            at, k = pos + n, k + 1
        else:
            w = np.flatnonzero(coded)
            flat[order[block[w]] * 64 + k[w]] = _extend(value[w], n[w]) << low
            ends = ~coded & (run < 15)
            at = pos + np.where(ends, run, n)
            k = np.where(ends, hi + 1, k + 1)
            skip = np.where(ends, (1 << run) - 1 + value, 0)
            block = block + skip
        over = k > hi
        if over.any():
            block = block + over
            k = np.where(over, lo, k)
            live = block < stop
            if not live.all():
                at, block, stop, k, skip = at[live], block[live], stop[live], k[live], skip[live]


def _ac_refine(coef, lanes, order, begin, end, lut, lo, hi, low):
    length, symbol = lut
    at, block, stop = lanes.start.copy(), begin.copy(), end
    k, skip = np.full(len(at), lo), np.zeros(len(at), np.int64)
    place = np.arange(64, dtype=np.int16)
    while len(at):
        # a symbol is read unless a run of ended blocks is under way
        code = lanes.peek(at)
        both = symbol[code].astype(np.int64)
        run, n = both >> 4, both & 15
        fresh = skip == 0
        pos = np.where(fresh, at + length[code], at)
        ends = fresh & (n == 0) & (run < 15)
        skip = np.where(ends, (1 << run) + lanes.bits(pos, np.where(ends, run, 0)), skip)
        pos = pos + np.where(ends, run, 0)
        new = fresh & (n > 0)
        sign = lanes.peek(pos) >> 15
        pos = pos + new
        rows = order[block]
        held = coef[rows]
        band = (place >= k[:, None]) & (place <= hi)
        some = held != 0
        target = np.full(len(at), hi + 1)
        open_ = np.flatnonzero(fresh & ~ends)
        if len(open_):
            # up to the zero that takes the new coefficient, or the last one that a long run passes
            free = band[open_] & ~some[open_]
            reached = free & (np.cumsum(free, axis=1, dtype=np.int8) > run[open_, None])
            target[open_] = np.where(reached.any(1), reached.argmax(1), hi + 1)
            band &= place < target[:, None]
        fix = band & some
        count = fix.sum(1)
        old = held[fix]
        first = np.cumsum(count) - count
        bit = lanes.peek(np.repeat(pos - first, count) + np.arange(len(old))) >> 15
        held[fix] = old + np.where(bit == 1, np.where(old > 0, 1 << low, -(1 << low)), 0).astype(np.int16)
        at = pos + count
        put = np.flatnonzero(new & (target <= hi))
        held[put, target[put]] = np.where(sign[put] == 1, 1 << low, -(1 << low))
        coef[rows] = held
        closed = skip > 0
        skip = np.where(closed, skip - 1, 0)
        k = np.where(closed, hi + 1, target + 1)
        over = k > hi
        block, k = block + over, np.where(over, lo, k)
        live = block < stop
        if not live.all():
            at, block, stop, k, skip = at[live], block[live], stop[live], k[live], skip[live]


def payload(image: Image, coef: np.ndarray) -> bytes:
    """The bytes that ``store`` has put into an image."""
    rows = coef[image.blocks:image.blocks + image.payload // 64]
    return (rows - OFFSET).astype(np.uint8).tobytes()


def tensor(image: Image, coef: np.ndarray) -> np.ndarray:
    """The full-resolution picture: height by width by 3 (RGB), or by 1 for a single component."""
    hmax, vmax = max(c["h"] for c in image.comps), max(c["v"] for c in image.comps)
    planes = []
    for c in image.comps:
        rows = coef[image.blocks + c["at"]:image.blocks + c["at"] + c["x"] * c["y"]].astype(np.float32) * c["quant"]
        samples = np.clip(np.rint(rows @ _INVERSE) + 128, 0, 255)
        plane = samples.reshape(c["y"], c["x"], 8, 8).transpose(0, 2, 1, 3).reshape(8 * c["y"], 8 * c["x"])
        if (c["h"], c["v"]) != (hmax, vmax):
            plane = plane.repeat(vmax // c["v"], 0).repeat(hmax // c["h"], 1)
        planes.append(plane[:image.high, :image.wide])
    if len(planes) == 1:
        return planes[0][..., None].astype(np.uint8)
    y, cb, cr = planes[0], planes[1] - 128, planes[2] - 128
    out = np.empty((image.high, image.wide, 3), np.uint8)
    for i, plane in enumerate((y + 1.402 * cr, y - 0.344136 * cb - 0.714136 * cr, y + 1.772 * cb)):
        out[..., i] = np.clip(np.rint(plane), 0, 255)
    return out
