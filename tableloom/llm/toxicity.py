"""Toxicity by compression distance: which of two dictionaries makes a window shorter.

Two zstandard dictionaries are trained on a bounded, documented sample of
labelled rows: one on toxic and one on ordinary text. A dictionary is the telling
words and word beginnings of its own class followed by the words common to both
classes. The class with fewer telling words (ordinary text may have none, when
toxic text is ordinary text with words added) is filled up with common words in
front; the common part sits at the same distance from a window in both, so
that two lengths of a window differ only by what tells the classes apart. Each
text, whole, is cut into short overlapping windows, every window is compressed
with both dictionaries, and the distribution of the differences is turned into a
score by a logistic calibration on sample rows the dictionaries have not seen.

Defined cases: a null text is an empty one; an empty text has no window and gets
the calibrated score of "no difference anywhere"; rows with equal texts get equal
scores; without labelled rows of both classes every row gets the smoothed share
of toxic labels (0.5 when there are none); labels with a null class are not used.
Extra columns are carried along; one named like the score is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame, functions as F

from tableloom.llm.batches import with_columns

#: Rows of each class the model may be fitted on, and the longest text among them in bytes.
SAMPLE_ROWS = 3000
SAMPLE_BYTES = 64 << 10
#: A window is WINDOW bytes and reaches OVERLAP bytes into the next, so a word at an edge is whole in one of them.
WINDOW, OVERLAP, LEVEL = 48, 12, 4
COMMON_WORDS = 900
#: A telling word leans to its class by LEAN standard errors (less on small samples) and is RATIO times as usual there.
LEAN, RATIO = 4.2, 4
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    """Two raw dictionaries and a calibration; a few kilobytes."""

    toxic: bytes
    ordinary: bytes
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    prior: float


def held_out(key: str = "doc_id"):
    """True for the fifth of the rows whose labels are never learnt."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> list[tuple[str, int]]:
    """At most ``rows`` labelled texts of each class, chosen by the hash of their id and not held out."""
    known = labels.filter(~held_out()).filter("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.md5(F.col("doc_id").cast("string"))
    picked = None
    for value in (0, 1):
        part = known.filter(F.col("toxic") == value).orderBy(order, "doc_id").limit(rows)
        picked = part if picked is None else picked.unionByName(part)
    texts = docs.select("doc_id", "text").filter(F.octet_length("text") <= SAMPLE_BYTES)
    found = texts.join(F.broadcast(picked), "doc_id").select("text", "toxic", order.alias("o"), "doc_id")
    return [(r.text, r.toxic) for r in found.orderBy("o", "doc_id", "text").limit(2 * rows).collect()]


def fit(rows: list[tuple[str, int]], share: float = 0.5) -> Model:
    """Train both dictionaries on one half of the sample and calibrate on the other.

    ``share`` is the part of toxic rows among all labelled ones; the sample may hold another.
    """
    rows = _distinct(rows)
    by_class = [[x for x, t in rows if t == value] for value in (0, 1)]
    if min(map(len, by_class)) < 4:
        return Model(b"", b"", (), (), (), share)
    halves = [(part[::2], part[1::2]) for part in by_class]
    toxic, ordinary = _dictionaries(halves[1][0], halves[0][0])
    texts = halves[0][1] + halves[1][1]
    truth = np.array([0.0] * len(halves[0][1]) + [1.0] * len(halves[1][1]))
    seen = Scorer(Model(toxic, ordinary, (), (), (), share)).features(texts)
    mean, scale = seen.mean(0), seen.std(0) + 1e-6
    weights = _logistic((seen - mean) / scale, truth)
    weights[0] += np.log(share / (1 - share)) - np.log(truth.mean() / (1 - truth.mean()))
    return Model(toxic, ordinary, tuple(mean), tuple(scale), tuple(weights), share)


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """The model for ``docs`` from the labels that are not held out."""
    known = labels.filter(~held_out()).filter("toxic IN (0, 1)")
    n, toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    return fit(sample(docs, labels), (toxic + 1) / (n + 2))


def _distinct(rows: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Rows without near copies of earlier ones, which would make their rare words look telling."""
    seen: set[tuple[int, int]] = set()
    out = []
    for text, label in rows:
        words = text.lower().split()
        grams = [_hash(" ".join(words[i:i + 3])) for i in range(max(1, len(words) - 2))]
        marks = {(j, min(g * m & 0xFFFFFFFFFFFF for g in grams)) for j, m in enumerate((0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))}
        if not marks & seen:
            out.append((text, label))
        seen |= marks
    return out


def _hash(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text)


def _segments(text: str) -> set[str]:
    """The words of a text and, marked, the beginnings of the longer ones."""
    words = set(WORD.findall(text.lower()))
    return {w for w in words if 2 <= len(w) <= 12} | {w[:5] + "~" for w in words if len(w) > 5}


def _dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """Dictionary contents for both classes, of equal length."""
    count = [Counter(), Counter()]
    for side, texts in zip(count, (toxic, ordinary)):
        for text in texts:
            side.update(_segments(text))
    n, m = len(toxic), len(ordinary)

    def lean(word: str) -> float:
        a, b = count[0][word], count[1][word]
        p = (a + b) / (n + m)
        return (a / n - b / m) / (p * (1 - p) * (1 / n + 1 / m) + 1e-12) ** 0.5

    words = [w for w in count[0].keys() | count[1].keys() if count[0][w] + count[1][w] >= 5]
    least = min(LEAN, (n + m) ** 0.5 / 4)

    def telling(sign: int, here: Counter, there: Counter, h: int, t: int) -> list[str]:
        own = {w for w in words if sign * lean(w) > least and here[w] / h > RATIO * (there[w] + 0.5) / t}
        # a telling beginning stands for its rarer continuations, whose ends are ordinary text
        own = {w for w in own if "~" in w or w[:5] + "~" not in own or len(w) <= 5 or here[w] >= 0.3 * here[w[:5] + "~"]}
        return sorted(own, key=lambda w: (sign * lean(w), w))

    sides = [telling(1, count[0], count[1], n, m), telling(-1, count[1], count[0], m, n)]
    known = {w for side in sides for w in side}
    common = sorted((w for w in words if w not in known and "~" not in w), key=lambda w: (count[0][w] / n + count[1][w] / m, w))
    shared = " ".join(common[-COMMON_WORDS:]).encode() + b" "
    own = [" ".join(dict.fromkeys(w.rstrip("~") for w in side)).encode() + b" " for side in sides]
    size = max(map(len, own))
    filler = shared * (size // len(shared) + 1)
    one, two = (filler[:size - len(x)] + x + shared for x in own)
    return one, two


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 40) -> np.ndarray:
    z = np.c_[np.ones(len(x)), x]
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        w += np.linalg.solve(h, z.T @ (y - p) - ridge * w)
    return w


class Scorer:
    """Scores lists of texts; built once in each task."""

    def __init__(self, model: Model):
        self.model = model
        self.both = [self._compressor(d) for d in (model.ordinary, model.toxic)] if model.toxic else []

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)

    def features(self, texts: list[str]) -> np.ndarray:
        """Shares and counts of the windows by how much shorter the toxic dictionary makes them."""
        raw = [t.lower().encode() for t in texts]
        sizes = np.array([len(b) for b in raw], dtype=np.int64)
        per = -(-sizes // WINDOW)
        owner = np.repeat(np.arange(len(raw)), per)
        first = np.cumsum(sizes) - sizes
        step = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        start = first[owner] + step * WINDOW
        length = np.minimum(WINDOW + OVERLAP, first[owner] + sizes[owner] - start)
        data, saved = b"".join(raw), np.zeros(len(owner), dtype=np.int64)
        if len(owner):
            edges = np.ascontiguousarray(np.c_[start, length].astype(np.uint64)).tobytes()
            windows = zstandard.BufferWithSegments(data, edges)
            lengths = [np.fromiter((len(got[i]) for i in range(len(got))), np.int64, len(got)) for got in (c.multi_compress_to_buffer(windows) for c in self.both)]
            saved = lengths[0] - lengths[1]
        level = np.clip(saved, -2, 8) + 2
        hist = np.bincount(owner * 11 + level, minlength=11 * len(raw)).reshape(-1, 11).astype(float)
        total = np.maximum(hist.sum(1, keepdims=True), 1)
        best = np.full(len(raw), -2.0)
        np.maximum.at(best, owner, saved.astype(float))
        best[per == 0] = 0
        many = [np.log1p(hist[:, k:].sum(1)) for k in (5, 6, 7, 8)]
        spread = (hist * (np.arange(11) - 2)).sum(1, keepdims=True) / total
        return np.c_[hist / total, spread, best, np.column_stack(many)]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if not self.both or not texts:
            return [np.full(len(texts), self.model.prior)]
        z = (self.features(texts) - self.model.mean) / self.model.scale
        # row by row, so that equal texts score alike whatever stands beside them
        logit = self.model.weights[0] + (z * np.array(self.model.weights[1:])).sum(1)
        return [np.round(1 / (1 + np.exp(-np.clip(logit, -30, 30))), 9)]


def score_toxicity(docs: DataFrame, model: Model, text: str = "text", out: str = "score", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the toxicity of each whole text as a double from 0 to 1."""
    return with_columns(docs, text, f"`{out}` double", lambda: Scorer(model), keep)


def classify(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """Fit on the labelled rows and give ``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    model = learn(docs, labels)
    scored = score_toxicity(docs.select("doc_id", text), model, text, "score", ["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
