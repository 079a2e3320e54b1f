"""Personal data by patterns and a skip-chain conditional random field.

The base finds e-mail and network addresses, card and phone numbers by pattern. The
field labels the tokens that could be personal data, those with a digit or an at
sign, as one of the four kinds or as none; all other tokens are no data. A token's
own features, the label of the candidate right before it, and the labels of its
repetitions speak for a label: equal or similar tokens (the same digits whatever
stands between them) are joined by skip edges, each occurrence with the next one, so
the number of edges stays linear in the tokens. Loopy message passing makes
the labels of a document's mentions agree. Tokens inside base spans are observed.
Labels that reach ``CERTAIN`` outside the base become additional spans.

The field is fitted on a bounded sample of texts with the base as its labels.

Defined cases: a null text is an empty one and has no spans; repeated rows give equal
results; ties in position are ordered by kind; an empty table gives an empty result (the
field is then the prior: none everywhere). Extra columns are carried along by
``find_private``; one named like a result column is replaced.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tableloom.llm.batches import with_columns

KINDS = ("email", "ip", "card", "phone")
#: Texts the field may be fitted on, and the longest of them in bytes.
SAMPLE_TEXTS, SAMPLE_BYTES = 2000, 64 << 10
ROUNDS, CERTAIN = 8, 0.95

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*[0-9@]\S*")
_DIGITS = re.compile(r"[0-9]")


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of the base, by kind and start."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        # the longest run before the sign, from where the last match ended
        start = done + len(text[done:at].rstrip(_LOCAL)) if at - done < 400 else _back(text, done, at)
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            out.append((0, start, done))
        at = text.find("@", max(at + 1, done))
    if _HINT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append((2, m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= len(_DIGITS.findall(m.group())) <= 15:
                    out.append((3, m.start(), m.end()))
    return out


def _back(text: str, lo: int, at: int) -> int:
    """Where the run of local-part characters before ``at`` begins, looking back in steps."""
    end = at
    while end > lo:
        begin = max(lo, end - 256)
        kept = len(text[begin:end].rstrip(_LOCAL))
        if kept:
            return begin + kept
        end = begin
    return lo


@dataclass(frozen=True)
class Field:
    """Weights of the features, of neighbours and of repetitions."""

    unary: np.ndarray
    chain: np.ndarray
    repeat: float


def _tokens(text: str) -> list[tuple[int, int, str]]:
    """Candidate tokens without the punctuation around them."""
    out = []
    for m in _TOKEN.finditer(text):
        word = m.group()
        left = len(word) - len(word.lstrip("\"'([{<*#$%&!?.,;:|"))
        core = word[left:].rstrip("\"'])}>*#$%&!?.,;:|")
        if core:
            out.append((m.start() + left, m.start() + left + len(core), core))
    return out


def _features(word: str) -> list[float]:
    digits = sum(c.isdigit() for c in word)
    letters = sum(c.isalpha() for c in word)
    dots, at = word.count("."), "@" in word
    return [
        1.0, at, at and dots > 0, letters > 0, dots == 3 and digits + 3 == len(word), dots > 0, digits == len(word), digits >= 16,
        digits >= 13, 8 <= digits <= 15, 3 <= digits <= 7, digits < 3, "-" in word, word[0] == "+", word[0] in "()", digits > 19,
    ]


def _key(word: str) -> str:
    """What repeated or similar tokens have in common; short numbers have nothing."""
    digits = "".join(_DIGITS.findall(word))
    if "@" in word:
        return word.lower()
    return digits if len(digits) >= 6 else ""


class Labeler:
    """Base spans and the spans that the field adds, for lists of texts."""

    def __init__(self, field: Field | None):
        self.field = field

    def graph(self, texts: list[str]):
        """Tokens of all texts with features, observed labels, and both kinds of edges."""
        base, place, feats, seen, chain, skip = [], [], [], [], [], []
        for i, text in enumerate(texts):
            spans = base_spans(text)
            base.append(spans)
            if not _HINT.search(text):
                continue
            cover = sorted((s, e, k) for k, s, e in spans)
            last: dict[str, int] = {}
            j, end = 0, -9
            for start, stop, word in _tokens(text):
                n = len(place)
                while j < len(cover) and cover[j][1] <= start:
                    j += 1
                label = next((k + 1 for s, e, k in cover[j:j + 4] if s < stop and e > start), 0)
                place.append((i, start, stop))
                feats.append(_features(word))
                seen.append(label)
                if 0 <= start - end <= 3 and n and place[n - 1][0] == i:
                    chain.append((n - 1, n))
                end = stop
                if key := _key(word):
                    if key in last:
                        skip.append((last[key], n))
                    last[key] = n
        shape = lambda e: np.array(e, np.int64).reshape(-1, 2)
        return base, place, np.array(feats, float), np.array(seen, np.int64), shape(chain), shape(skip)

    def __call__(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        base, place, feats, seen, chain, skip = self.graph(texts)
        out = [[(KINDS[k], s, e) for k, s, e in spans] for spans in base]
        if self.field is None or not len(seen):
            return out
        label, sure = self.infer(feats, seen, chain, skip)
        for n in np.flatnonzero((seen == 0) & (label > 0) & (sure >= CERTAIN)):
            i, start, stop = place[n]
            if not any(s < stop and e > start for _, s, e in base[i]):
                kind, before = "crf_" + KINDS[label[n] - 1], out[i][-1] if out[i] else ("", 0, 0)
                if before[0] == kind and 0 <= start - before[2] <= 3:
                    out[i][-1] = (kind, before[1], stop)  # tokens of one mention stand side by side
                else:
                    out[i].append((kind, start, stop))
        order = {k: i for i, k in enumerate([*KINDS, *("crf_" + k for k in KINDS)])}
        return [sorted(spans, key=lambda x: (order[x[0]], x[1])) for spans in out]

    def infer(self, feats, seen, chain, skip) -> tuple[np.ndarray, np.ndarray]:
        """The likeliest label of each token and its belief, after loopy sum-product message passing."""
        unary = feats @ self.field.unary
        unary[seen > 0] = -50.0
        unary[seen > 0, seen[seen > 0]] = 0.0
        k = unary.shape[1]
        pairs = np.concatenate([chain, skip])
        tables = np.concatenate([np.broadcast_to(self.field.chain, (len(chain), k, k)), np.broadcast_to(self.field.repeat * np.eye(k), (len(skip), k, k))])
        source = np.concatenate([pairs[:, 0], pairs[:, 1]])
        target = np.concatenate([pairs[:, 1], pairs[:, 0]])
        tables = np.concatenate([tables, tables.transpose(0, 2, 1)])
        reverse = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
        messages = np.zeros((len(source), k))
        for _ in range(ROUNDS if len(source) else 0):
            belief = unary.copy()
            np.add.at(belief, target, messages)
            sent = belief[source] - messages[reverse]
            new = _logsum(sent[:, :, None] + tables, 1)
            new -= new.max(1, keepdims=True)
            messages = 0.5 * messages + 0.5 * new
        belief = unary.copy()
        np.add.at(belief, target, messages)
        belief = np.exp(belief - _logsum(belief, 1)[:, None])
        return belief.argmax(1), belief.max(1)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def fit(texts: list[str]) -> Field | None:
    """Piecewise training: features by multinomial regression, edges by the log odds of their label pairs."""
    _, _, x, y, chain, skip = Labeler(None).graph(texts)
    if not len(y) or not (y > 0).any():
        return None
    k = len(KINDS) + 1
    truth = np.eye(k)[y]
    w = np.zeros((x.shape[1], k))
    step = 4.0 / max(1.0, np.linalg.eigvalsh(x.T @ x / len(x))[-1])
    for _ in range(600):
        p = x @ w
        p = np.exp(p - _logsum(p, 1)[:, None])
        w += step * (x.T @ (truth - p) / len(x) - 1e-4 * w)
    prior = (truth.sum(0) + 1) / (len(y) + k)
    counts = np.zeros((k, k))
    np.add.at(counts, (y[chain[:, 0]], y[chain[:, 1]]), 1)
    chain_table = np.log((counts + prior[:, None] * prior * 10) / (counts.sum() + 10) / (prior[:, None] * prior))
    same = (y[skip[:, 0]] == y[skip[:, 1]]).sum()
    agree = float(np.clip(np.log((same + 1) / (len(skip) - same + 1)), 0.5, 4.0))
    return Field(w, np.clip(chain_table, -4, 4), agree)


def sample(docs: DataFrame, text: str = "text", rows: int = SAMPLE_TEXTS) -> list[str]:
    """At most ``rows`` texts with candidate tokens, chosen by the hash of the text."""
    known = docs.select(F.col(text).alias("t")).filter((F.octet_length("t") <= SAMPLE_BYTES) & F.col("t").rlike("[0-9@]"))
    # the few smallest hashes first, then their texts
    return [r.t for r in known.withColumn("h", F.xxhash64("t")).orderBy("h", "t").limit(rows).collect()]


def find_private(docs: DataFrame, field: Field | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``spans``: the base and the added ones, by kind and start, in code points."""
    def make():
        run = Labeler(field)
        return lambda texts: [[[{"kind": k, "start": s, "end": e} for k, s, e in spans] for spans in run(texts)]]

    return with_columns(docs, text, "spans array<struct<kind:string,start:long,end:long>>", make, keep)


def private_digest(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and digest of the base and all spans of each document."""
    field = fit(sample(docs, text))

    def make():
        run = Labeler(field)

        def work(texts):
            rows = []
            for spans in run(texts):
                base = [s for s in spans if s[0] in KINDS]
                joined = lambda some: ",".join(f"{k}:{s}:{e}" for k, s, e in some)
                counts = [sum(s[0] == k for s in base) for k in KINDS]
                rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            return list(zip(*rows)) or [[]] * 6

        return work

    return with_columns(docs, text, "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string", make, [key])
