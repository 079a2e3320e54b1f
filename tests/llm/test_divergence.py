"""The audit of sources against counting term by term."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

pytest.importorskip("tableloom.llm")

from tableloom.llm import divergence  # noqa: E402

PARTS = 10**9


def plain_audit(rows):
    """``{(lang, source, part, item): (value, rank)}`` by loops over Python integers."""
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for lang, source, text in rows]
    within, often, groups = Counter(), Counter(), defaultdict(set)
    for lang, source, words in docs:
        groups[lang].add(source)
        within.update((lang, w) for w in set(words))
        often.update((lang, source, w) for w in words)
    out = {}
    for lang, sources in groups.items():
        kept = sorted(w for (g, w), n in within.items() if g == lang and n >= 3)
        words = {s: sum(often[lang, s, w] for w in kept) for s in sources}
        part = lambda n, total: 1 + PARTS * (n + 1) // (total + len(kept))
        p = {s: {w: part(often[lang, s, w], words[s]) for w in kept} for s in sources}
        q = {w: part(sum(often[lang, s, w] for s in sources), sum(words.values())) for w in kept}
        apart = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(sum(apart(p[s][w], p[o][w]) for w in kept), o) for o in sources if o != s]
            terms = [(apart(p[s][w], q[w]), w) for w in kept if often[lang, s, w] and p[s][w] > q[w]]
            for name, found in (("pair", pairs), ("term", terms)):
                order = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                for rank, (value, item) in enumerate(order, 1):
                    if name == "pair" or rank <= 200:
                        out[lang, s, name, item] = (value, rank)
    return out


def audited(frame, rows):
    df = frame("lang string, source string, text string, value string, Term int, part map<string,int>", [(*r, "v", 1, {"a": 1}) for r in rows])
    got = divergence.audit(df).collect()
    found = {(r.lang, r.source, r.part, r["item"]): (r.value, r.rank) for r in got}
    assert len(found) == len(got)
    return found


def corpus(rng, sources):
    words = [f"{a}{b}" for a in "abcdefghij" for b in ("", "x", "é", "ÉÀ", "日本", "Q", "z" * 40)]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = []
    for i in range(220):
        source = rng.choice(sources[:1] * len(sources) + sources)
        text = rng.choice([" ", "1", "-", "\x7f", "_", "[\n"]).join(rng.choices(words, weights, k=rng.randint(0, 60)))
        rows.append((rng.choice(["en", "en", "de", None]), source, text))
    rows += rows[:5] + [("en", None, None), ("xx", "lonely", "one two one"), ("xx", "other", ""), ("yy", "single", "same same"), ("", "s1", "K ſ K")]
    rows += [("en", "long", "abc " * 400_000 + "d" * 3_000_000)] * 3
    return rows


@pytest.mark.parametrize("block,widths", [(64, divergence.WIDTHS), (2, ((3, 8), (0, 16)))])
def test_audit_equals_counting(frame, monkeypatch, block, widths):
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", block)
    monkeypatch.setattr(divergence, "WIDTHS", widths)
    monkeypatch.setattr(divergence, "ENTRIES", 50)
    monkeypatch.setattr(divergence, "_SLICE", 1000)
    rows = corpus(random.Random(block), ["s1", "s2", "s3", "s4", "s5", None])
    assert audited(frame, rows) == plain_audit(rows)


def test_many_terms_keep_two_hundred_ranks(frame):
    rows = [("en", "a" if i % 2 else "b", " ".join(f"w{chr(97 + j % 26)}{chr(97 + j // 26)}" for j in range(i % 4, 400, 1 + i % 3))) for i in range(24)]
    assert audited(frame, rows) == plain_audit(rows)


def test_no_rows_and_no_kept_terms(frame):
    assert audited(frame, []) == {}
    rows = [("en", "a", "one"), ("en", "b", "two"), ("en", "b", None)]
    assert audited(frame, rows) == {("en", "a", "pair", "b"): (0, 1), ("en", "b", "pair", "a"): (0, 1)}


def test_large_counts_are_exact(spark):
    from pyspark.sql import functions as F

    df = spark.sql("SELECT 40000000000L AS n, 90000000000L AS total, 7L AS kept")
    got = df.select(divergence.share(F.col("n"), F.col("total"), F.col("kept"))).first()[0]
    assert got == 1 + PARTS * 40000000001 // 90000000007
