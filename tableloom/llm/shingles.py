"""Sets of word shingles as sorted 64-bit numbers, worked out in numpy over pieces of text."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SLICE = 1 << 20
#: White space of the shingle contract, and A-Z to a-z.
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the input reaches every bit of the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Distinct hashed shingles of ``words`` words of each text."""

    def __init__(self, words: int):
        self.words = words
        with np.errstate(over="ignore"):
            self.power = np.multiply.accumulate(np.full(_SLICE + 1, _BASE))
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            self.back = np.multiply.accumulate(np.full(_SLICE + 1, inverse))

    def word_hashes(self, raw: bytes) -> np.ndarray:
        """One number for each word of a text, equal words alike."""
        out, at = [], 0
        whole = np.frombuffer(raw, np.uint8)
        while at < len(whole):
            end = min(at + _SLICE, len(whole))
            if end < len(whole):
                # cut between words; a word longer than a slice is hashed by itself
                gaps = np.flatnonzero(_BLANK[whole[at:end]])
                if len(gaps):
                    end = at + int(gaps[-1]) + 1
                else:
                    rest = np.flatnonzero(_BLANK[whole[end:]])
                    end = end + int(rest[0]) if len(rest) else len(whole)
                    out.append(self._long(_LOWER[whole[at:end]]))
                    at = end
                    continue
            out.append(self._slice(_LOWER[whole[at:end]]))
            at = end
        return np.concatenate(out) if out else np.empty(0, np.uint64)

    def _slice(self, b: np.ndarray) -> np.ndarray:
        solid = np.concatenate(([False], ~_BLANK[b], [False]))
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        start, end = edges[::2], edges[1::2]
        with np.errstate(over="ignore"):
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.power[:len(b)])))
            return mix((sums[end] - sums[start]) * self.back[start])

    def _long(self, b: np.ndarray) -> np.ndarray:
        import xxhash

        return np.array([xxhash.xxh64_intdigest(b.tobytes())], np.uint64)

    def __call__(self, text: str) -> np.ndarray:
        """The sorted distinct shingles; all words as one shingle when there are fewer than asked for."""
        w = self.word_hashes(text.encode())
        k = min(self.words, len(w))
        if not k:
            return w
        with np.errstate(over="ignore"):
            grams = np.full(len(w) - k + 1, np.uint64(k))
            for i in range(k):
                grams = mix(grams * _BASE + w[i:len(w) - k + 1 + i])
        return np.unique(grams)
