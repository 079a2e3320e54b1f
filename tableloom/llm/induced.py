"""External suffix sorting by induction, with common-prefix values.

Suffixes are of kind L (larger than the next one) or S (smaller). The S suffixes
behind an L suffix (the leftmost of their runs) are sorted first: their substrings are named by
one round of induction, and names are paired over and over, each time covering twice the
text, until all differ or ``cap`` characters are covered. From their order all L suffixes
are induced in a scan upwards and from these all S suffixes in a scan downwards: each suffix
scanned puts the one before it into the queue of its first character.

The queues are monotone priority queues: first character, then order of arrival. Their
tuples (position, common prefix with the tuple before) go to a file when more than
``HELD`` of them wait, and the text is mapped from a file. Kinds, hashes, names, order and marks are
whole arrays in memory, some 50 bytes for a character at the peak: the caller keeps shards small.
The common prefix of two tuples is one more than the smallest
common prefix scanned between their sources. Values are cut at ``cap``.
"""

from __future__ import annotations

import tempfile
from collections import deque
from collections.abc import Iterator

import numpy as np

#: Tuples that wait in memory, and tuples scanned at once.
HELD, SCANNED = 1 << 21, 1 << 16
#: Codes in the text: end, separator, then bytes.
END, BREAK, FIRST = 0, 1, 2
CODES = 258
_L, _S = 0, 1


class Queues:
    """One first-in first-out queue of (position, prefix) for each character, backed by a file."""

    def __init__(self):
        self.parts = [deque() for _ in range(CODES)]
        self.held, self.file = 0, None

    def push(self, code: int, at: np.ndarray, lcp: np.ndarray) -> None:
        self.parts[code].append((at, lcp))
        self.held += len(at)
        if self.held > HELD:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for parts in self.parts:
            for i, part in enumerate(parts):
                if isinstance(part[0], np.ndarray):
                    where = self.file.tell()
                    self.file.write(part[0].astype("<i8").tobytes())
                    self.file.write(part[1].tobytes())
                    parts[i] = (where, len(part[0]))
        self.held = 0

    def _load(self, part) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(part[0], np.ndarray):
            return part
        self.file.seek(part[0])
        data = self.file.read(9 * part[1])
        return np.frombuffer(data, "<i8", part[1]), np.frombuffer(data, np.uint8, part[1], 8 * part[1])

    def take(self, code: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Everything in a queue in order of arrival, in pieces; what arrives meanwhile comes last."""
        while self.parts[code]:
            batch, size = [], 0
            while self.parts[code] and size < SCANNED:
                part = self.parts[code].popleft()
                self.held -= len(part[0]) if isinstance(part[0], np.ndarray) else 0
                batch.append(self._load(part))
                size += len(batch[-1][0])
            yield _joined(batch)

    def backwards(self, code: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Everything in a queue in pieces, the last piece first."""
        parts = list(self.parts[code])
        while parts:
            batch, size = [], 0
            while parts and size < SCANNED:
                batch.append(self._load(parts.pop()))
                size += len(batch[-1][0])
            yield _joined(batch[::-1])


def _joined(batch: list) -> tuple[np.ndarray, np.ndarray]:
    return batch[0] if len(batch) == 1 else tuple(map(np.concatenate, zip(*batch)))


class Shard:
    """The suffixes of texts joined with breaks; a break equals a break only for the order, never in a match."""

    def __init__(self, texts: Iterator[bytes], cap: int):
        self.cap = cap
        self.file = tempfile.TemporaryFile()
        size = 0
        for text in texts:
            codes = np.frombuffer(text, np.uint8).astype("<i2") + FIRST
            self.file.write(codes.tobytes() + np.array([BREAK], "<i2").tobytes())
            size += len(codes) + 1
        self.file.write(np.array([END], "<i2").tobytes())
        self.file.flush()
        self.text = np.memmap(self.file, "<i2", "r", shape=(size + 1,))
        self.kind = self._kinds()

    def _kinds(self) -> np.ndarray:
        t = self.text
        change = np.flatnonzero(t[1:] != t[:-1])
        up = (t[change] < t[change + 1]).astype(np.uint8)
        lengths = np.diff(np.concatenate(([-1], change)))
        return np.concatenate((np.repeat(up, lengths), np.full(len(t) - lengths.sum(), _S, np.uint8)))

    def _same(self, a: int, b: int) -> int:
        """The common prefix of two suffixes, compared directly."""
        x, y = self.text[a:a + self.cap], self.text[b:b + self.cap]
        n = min(len(x), len(y))
        differ = np.flatnonzero(x[:n] != y[:n])
        return int(differ[0]) if len(differ) else n

    def _scan(self, at, lcp, kind, queues, least) -> None:
        """Put the suffix before each of ``at``, if it is of ``kind``, into its queue."""
        for lo in range(0, len(at), SCANNED):
            self._scan_part(at[lo:lo + SCANNED], lcp[lo:lo + SCANNED], kind, queues, least)

    def _scan_part(self, at, lcp, kind, queues, least) -> None:
        before = np.maximum(at - 1, 0)
        from_ = np.flatnonzero((at > 0) & (self.kind[before] == kind))
        n = len(at)
        code = self.text[before[from_]]
        order = np.argsort(code, kind="stable")
        code, from_ = code[order], from_[order]
        heads = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else np.empty(0, np.int64)
        lows = [lcp]
        while (1 << len(lows)) <= n:
            half = 1 << (len(lows) - 1)
            lows.append(np.minimum(lows[-1][:-half], lows[-1][half:]))
        first = np.concatenate(([0], from_[:-1] + 1)) if len(code) else from_
        first[heads] = 0
        span = from_ - first + 1
        level = np.frexp(span.astype(float))[1] - 1
        smallest = np.empty(len(code), np.uint8)
        for v in np.unique(level):
            w = np.flatnonzero(level == v)
            smallest[w] = np.minimum(lows[v][first[w]], lows[v][from_[w] - (1 << int(v)) + 1])
        tails = np.concatenate((heads[1:], [len(code)]))
        whole = int(lcp.min()) if n else 255
        seen = least.copy()
        np.minimum(least, whole, out=least)
        for a, b in zip(heads.tolist(), tails.tolist()):
            c = int(code[a])
            smallest[a] = min(int(smallest[a]), int(seen[c]))
            last = int(from_[b - 1])
            least[c] = lcp[last + 1:].min() if last + 1 < n else 255
            queues.push(c, before[from_[a:b]], np.minimum(smallest[a:b].astype(np.int16) + 1, self.cap).astype(np.uint8))

    def _upwards(self, starts: np.ndarray, lcp: np.ndarray) -> Queues:
        """All L suffixes in order, from the sorted leftmost S suffixes."""
        waiting, done = Queues(), Queues()
        least = np.full(CODES, 255, np.uint8)
        edges = np.searchsorted(self.text[starts], np.arange(CODES + 1))
        for c in range(CODES):
            last = -1
            for at, shared in waiting.take(c):
                shared = shared.copy()
                if last < 0:
                    shared[0] = 0
                done.push(c, at, shared)
                last = int(at[-1])
                self._scan(at, shared, _L, waiting, least)
            mine, shared = starts[edges[c]:edges[c + 1]], lcp[edges[c]:edges[c + 1]].copy()
            if len(mine):
                shared[0] = self._same(last, int(mine[0])) if last >= 0 else 0
                self._scan(mine, shared, _L, waiting, least)
        return done

    def _downwards(self, larger: Queues) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All suffixes but the end from the largest to the smallest, each with its prefix shared with the one before."""
        waiting = Queues()
        least = np.full(CODES, 255, np.uint8)
        for c in range(CODES - 1, 0, -1):
            last = -1
            for at, shared in waiting.take(c):
                shared = shared.copy()
                if last < 0:
                    shared[0] = 0
                last = int(at[-1])
                yield at, shared
                self._scan(at, shared, _S, waiting, least)
            carried = None
            for at, shared in larger.backwards(c):
                down = at[::-1].copy()
                # going down, a suffix shares with the one before what that one, going up, shared with it
                low = np.concatenate(([0], shared[::-1][:-1])).astype(np.uint8)
                low[0] = carried if carried is not None else (self._same(last, int(down[0])) if last >= 0 else 0)
                carried = int(shared[0])
                yield down, low
                self._scan(down, low, _S, waiting, least)

    def _leftmost(self) -> np.ndarray:
        return np.flatnonzero((self.kind[1:] == _S) & (self.kind[:-1] == _L)) + 1

    def _hashes(self) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            power = np.multiply.accumulate(np.full(len(self.text) + 1, np.uint64(0x9E3779B97F4A7C15)))
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((self.text.astype(np.uint64) + np.uint64(7)) * power[:-1])))
        return sums, power

    def _equal(self, a, b, n, sums, power) -> np.ndarray:
        """Whether the strings of ``n`` characters at ``a`` and ``b`` have one hash."""
        with np.errstate(over="ignore"):
            x, y = sums[a + n] - sums[a], sums[b + n] - sums[b]
            return np.where(a < b, x * _power(power, b - a) == y, y * _power(power, a - b) == x)

    def _sorted_leftmost(self) -> tuple[np.ndarray, np.ndarray]:
        """The leftmost S suffixes in order, to ``cap`` characters at least, and what neighbours share."""
        found = self._leftmost()
        rough = found[np.argsort(self.text[found], kind="stable")]
        order = [at for at, _ in self._downwards(self._upwards(rough, np.zeros(len(rough), np.uint8)))]
        every = np.concatenate(order)[::-1] if order else np.empty(0, np.int64)
        is_left = np.zeros(len(self.text), bool)
        is_left[found] = True
        ranked = np.concatenate(([len(self.text) - 1], every[is_left[every]])) if len(found) else found
        index = np.zeros(len(self.text), np.int64)
        index[found] = np.arange(len(found))
        reach = np.append(np.diff(found) + 1, 1)[index[ranked]]
        sums, power = self._hashes()
        a, b = ranked[:-1], ranked[1:]
        same = (reach[:-1] == reach[1:]) & self._equal(a, b, np.minimum(reach[:-1], len(self.text) - np.maximum(a, b)), sums, power)
        name = np.empty(len(found), np.int64)
        name[index[ranked]] = np.cumsum(np.concatenate(([0], ~same)))
        step = 1
        while len(found) and name.max() < len(found) - 1 and step < self.cap:
            nxt = np.append(name[step:], np.full(min(step, len(name)), -1)) + 1
            _, name = np.unique(name * (len(found) + 1) + nxt, return_inverse=True)
            step *= 2
        final = found[np.argsort(name, kind="stable")]
        return final, self._shared(final, sums, power)

    def _shared(self, order: np.ndarray, sums, power) -> np.ndarray:
        """Common prefixes of neighbours, up to ``cap``, by bisection over hashes."""
        if not len(order):
            return np.empty(0, np.uint8)
        a, b = order[:-1], order[1:]
        most = np.minimum(self.cap, len(self.text) - np.maximum(a, b))
        low, high = np.zeros(len(a), np.int64), most.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            same = self._equal(a, b, mid, sums, power)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return np.concatenate(([0], low)).astype(np.uint8)

    def descending(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions from the largest suffix to the smallest, each with the prefix it shares with the one before."""
        starts, lcp = self._sorted_leftmost()
        yield from self._downwards(self._upwards(starts, lcp))

    def repeated(self, length: int) -> np.ndarray:
        """Marks of the positions whose next ``length`` characters also start elsewhere in the shard."""
        marks, last = np.zeros(len(self.text), bool), -1
        for at, shared in self.descending():
            near = np.flatnonzero(shared >= length)
            marks[at[near]] = True
            marks[at[near[near > 0] - 1]] = True
            if len(near) and near[0] == 0 and last >= 0:
                marks[last] = True
            last = int(at[-1])
        # a string with a break in it is none of the texts'
        stop = np.flatnonzero(self.text <= BREAK)
        left = stop[np.searchsorted(stop, np.arange(len(self.text)))] - np.arange(len(self.text))
        return marks & (left >= length)


def _power(power: np.ndarray, by: np.ndarray) -> np.ndarray:
    """The base to a power, 0 allowed."""
    return np.where(by > 0, power[np.maximum(by, 1) - 1], np.uint64(1))
