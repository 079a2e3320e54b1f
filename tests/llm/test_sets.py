"""Joins, search and mixing against brute force, and the pipeline."""

from __future__ import annotations

import random
import time
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("tableloom.llm")

from tableloom.llm import curriculum, fragment_join, induced, jpeg, topk  # noqa: E402
from tableloom.llm.induced import Shard  # noqa: E402
from tableloom.llm.shingles import Shingler  # noqa: E402


def linked(texts, words, t):
    """Smallest index reachable by links of Jaccard similarity ``t`` and the set sizes."""
    def grams(text):
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split(" ")
        w = [x for x in " ".join(w).replace("\n", " ").replace("\t", " ").split(" ") if x]
        k = min(words, len(w))
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if k else set()
    sets = [grams(x) for x in texts]
    home = list(range(len(texts)))
    def root(i):
        while home[i] != i:
            i = home[i]
        return i
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= t * len(sets[i] | sets[j]) - 1e-12:
                a, b = sorted((root(i), root(j)))
                home[b] = a
    return [(len(s), root(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("words,threshold", [(3, "0.9"), (5, "0.8")])
def test_components_equal_all_pairs(frame, monkeypatch, words, threshold):
    monkeypatch.setattr(fragment_join, "COMMON", 6)
    monkeypatch.setattr(fragment_join, "BLOCK", 4)
    rng = random.Random(7)
    word = lambda: rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randint(0, 400))
    prose = lambda n: [word() for _ in range(n)]
    texts = [None, "", " \n", "one", "One", "one two", "ONE TWO", "é É"]
    line = prose(30)
    for size in (4, 9, 12, 17, 18, 19, 20, 40, 90, 300, 1500):
        base = prose(size)
        for edits in (0, 0, 1, 1, 2, 3, size // 60, size // 40, size // 25, size // 12):
            copy = list(base)
            for _ in range(edits):
                at = rng.randrange(len(copy))
                rng.choice([lambda: copy.__setitem__(at, word()), lambda: copy.insert(at, word()), lambda: copy.pop(at) if len(copy) > 1 else None])()
            texts.append(" ".join(copy))
    texts += [" ".join(line + prose(10)) for _ in range(12)]
    rng.shuffle(texts)
    docs = frame("doc_id long, text string, n_shingles string", [(i, t, "x") for i, t in enumerate(texts)])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in fragment_join.components(docs, words=words, threshold=threshold).collect()}
    assert [got[i] for i in range(len(texts))] == linked(texts, words, float(threshold))
    kept = {r.doc_id for r in fragment_join.one_of_each(docs, words=words, threshold=threshold).collect()}
    assert kept == {i for i, (_, c) in enumerate(linked(texts, words, float(threshold))) if c == i}


def test_null_and_repeated_ids_link_like_others(frame):
    rng = random.Random(11)
    texts, ids = [], []
    for base in range(12):
        words = [f"w{rng.randint(0, 9999)}" for _ in range(60)]
        for i, name in enumerate([10 + base, None, 40 + base] if base % 3 else [None, None, None]):
            texts.append(" ".join(words[:58 + i]))
            ids.append(name)
    ids[3], ids[8] = 5, 5  # one id in two classes
    ids[6] = 2
    want = linked(texts, 3, 0.95)
    least = {c: min((ids[i] for i, (_, d) in enumerate(want) if d == c and ids[i] is not None), default=None) for _, c in want}
    docs = frame("doc_id long, text string, lang string", [(i, t, "x") for i, t in zip(ids, texts)])
    got = fragment_join.components(docs, words=3, threshold="0.95").collect()
    rows = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got)
    assert rows == sorted((str(i), n, str(least[c])) for i, (n, c) in zip(ids, want))
    kept = [r.text for r in fragment_join.one_of_each(docs, words=3, threshold="0.95").collect()]
    assert sorted(want[texts.index(x)][1] for x in kept) == sorted({c for _, c in want})


@pytest.mark.parametrize("name", ["_doc", "_H", "_nth", "row", "_id", "node", "members", "Text2"])
def test_columns_named_like_internal_ones_stay(frame, name):
    long = " ".join(f"w{i}" for i in range(60))
    df = frame(f"doc_id long, text string, `{name}` map<string,int>", [(1, long, {"a": 1}), (2, long + " x", {"b": 2}), (3, "other", None), (3, "other", {"c": 1})])
    kept = fragment_join.one_of_each(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]
    assert len(fragment_join.components(df).collect()) == 4


@pytest.mark.parametrize("name", ["turn", "_hash", "_KEY", "_block", "_offset", "_row", "_id", "copy", "row", "Size", "_start", "w"])
def test_a_mix_carries_columns_of_any_name(frame, name):
    df = frame(f"doc_id long, text string, source string, `{name}` map<string,int>", [(i, "a b c d", f"s{i % 2}", {"k": i}) for i in range(8)])
    mixed = curriculum.in_training_order(curriculum.mix(df), repeat=True)
    want = [c for c in df.columns if c.lower() not in ("size", "_start")]
    assert mixed.columns == [*want, "size", "source_size", "target", "taken", "position"]
    rows = mixed.collect()
    assert {r.doc_id for r in rows} == set(range(8))
    if name in want:
        assert all(r[name] == {"k": r.doc_id} for r in rows)


def test_components_of_no_rows(frame):
    assert fragment_join.components(frame("doc_id long, text string", [])).count() == 0


def test_shingles_do_not_depend_on_slices(monkeypatch):
    from tableloom.llm import shingles

    text = "Some WORDS of " + "x" * 50 + " different\tlengths and\nlines " * 20
    whole = Shingler(3)(text)
    monkeypatch.setattr(shingles, "_SLICE", 40)
    small = Shingler(3)(text)
    assert len(whole) == len(small)


def brute_top(rows, k):
    ok = [(i, np.floor(np.array(v, float) * 64).astype(int)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in ok:
        if q % 20 == 0:
            scored = sorted((-int(v @ w), i) for i, w in ok if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def test_top_k_equals_brute_force(frame, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 40)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 5)
    monkeypatch.setattr(topk, "SLACK", 21)
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6)]) for i in range(260)]
    rows += [(i, [0.5, 0.25, -0.5, 0.0, 1.0, 0.125]) for i in range(300, 380)]  # many ties
    rows += [(400, None), (420, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (440, [float("nan")] + [0.0] * 5), (460, [float("inf")] + [0.0] * 5), (None, [0.0] * 6)]
    docs = frame("vec_id long, embedding array<float>, rank string", [(i, v, "x") for i, v in rows])
    got = sorted(tuple(r) for r in topk.top_k(docs, "vec_id", "embedding", F.col("id") % 20 == 0).collect())
    assert got == brute_top(rows, 20)


def test_top_k_of_few_rows(frame):
    few = frame("vec_id long, embedding array<float>", [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])])
    got = topk.top_k(few, "vec_id", "embedding", F.col("id") % 20 == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 32 * 64), (2, -64 * 64)]
    assert topk.top_k(few.limit(0), "vec_id", "embedding", F.col("id") % 20 == 0).count() == 0


def test_mix_meets_targets(frame):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), rng.choice(["a", "b", "c", "hot", "hot", "hot", None]), "x") for i in range(500)]
    rows += [(900, None, "b", "x"), (901, "", None, "x"), (None, "three small words", "a", "x"), (3, "again", "a", "x"), (3, "again", "a", "x")]
    docs = frame("doc_id long, text string, source string, target string", rows)
    got = curriculum.mix(docs).collect()
    sizes: dict = {}
    for _, text, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        level = rest / sum(weight[s] for s in sizes if s not in full)
        over = {s for s in sizes if s not in full and level * weight[s] > 2 * sizes[s]}
        if not over:
            break
        full |= over
    want = {s: 2 * sizes[s] if s in full else level * weight[s] for s in sizes}
    taken: dict = {}
    for r in got:
        assert abs(r.target - want[r.source]) < 1e-6 and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 2 * r.size and (r.position is None) == (r.taken == 0)
        assert r.position is None or 0 <= r.position <= 1 + 1e-9
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 + 1e-9 for s in sizes) and len(got) == len(rows)
    copies = curriculum.in_training_order(curriculum.mix(docs), repeat=True)
    assert copies.count() == sum(-(-r.taken // r.size) for r in got if r.taken)
    assert curriculum.mix(docs.limit(0)).count() == 0


def test_schedules_are_inverted(spark):
    for knots in curriculum.SCHEDULES:
        rows = spark.range(0, 101).select((F.col("id") / 100).alias("u")).select("u", curriculum.when_reached(F.col("u"), knots).alias("t")).collect()
        for r in rows:
            area = 0.0
            for (t0, r0), (t1, r1) in zip(knots, knots[1:]):
                end = min(max(r.t, t0), t1)
                area += (r0 + r0 + (r1 - r0) * (end - t0) / (t1 - t0)) / 2 * (end - t0)
            whole = sum((a[1] + b[1]) / 2 * (b[0] - a[0]) for a, b in zip(knots, knots[1:]))
            assert abs(area / whole - r.u) < 1e-9


@pytest.mark.parametrize("held,scanned", [(3, 2), (50, 7), (1 << 21, 1 << 16)])
def test_induced_sorting_finds_repeats(monkeypatch, held, scanned):
    monkeypatch.setattr(induced, "HELD", held)
    monkeypatch.setattr(induced, "SCANNED", scanned)
    rng = random.Random(held)
    for _ in range(60):
        letters, n = rng.choice(["a", "ab", "abc", "abcdefgh"]), rng.choice([1, 2, 3, 5, 9])
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))).encode() for _ in range(rng.randint(1, 8))]
        count: dict = {}
        for t in texts:
            for i in range(len(t) - n + 1):
                count[t[i:i + n]] = count.get(t[i:i + n], 0) + 1
        marks, at = Shard(iter(texts), n).repeated(n), 0
        for t in texts:
            assert marks[at:at + len(t)].tolist() == [i + n <= len(t) and count[t[i:i + n]] > 1 for i in range(len(t))]
            at += len(t) + 1


class Bits:
    def __init__(self):
        self.out, self.bits = bytearray(), ""

    def put(self, value, n):
        self.bits += format(value, f"0{n}b") if n else ""

    def done(self):
        bits = self.bits + "1" * (-len(self.bits) % 8)
        data = bytes(int(bits[i:i + 8], 2) for i in range(0, len(bits), 8))
        return data.replace(b"\xff", b"\xff\x00")


def plain_progressive(coef, wide, high):
    """A serial encoder of one grey component: DC, two AC bands and their refinements, with runs of ended blocks."""
    import struct

    seg = lambda m, b: struct.pack(">BBH", 255, m, len(b) + 2) + b
    table = bytes([0] * 7 + [255] + [1] + [0] * 7) + bytes(range(256))
    code = lambda s: (s, 8) if s < 255 else (510, 9)
    size = lambda v: abs(v).bit_length()
    extra = lambda v: v if v > 0 else v + (1 << size(v)) - 1
    out = b"\xff\xd8" + seg(0xDB, b"\0" + b"\x01" * 64) + seg(0xC2, struct.pack(">BHHB", 8, high, wide, 1) + b"\x01\x11\0")
    out += seg(0xC4, b"\0" + table) + seg(0xC4, b"\x10" + table)
    scan = lambda lo, hi, bits: seg(0xDA, bytes([1, 1, 0, lo, hi, bits]))
    b, last = Bits(), 0
    for row in coef:
        v = int(row[0]) >> 1
        d, last = v - last, v
        b.put(*code(size(d)))
        b.put(extra(d), size(d))
    out += scan(0, 0, 0x01) + b.done()
    shift = lambda v, n: int(v) >> n if v >= 0 else -(int(-v) >> n)
    for lo, hi in ((1, 5), (6, 63)):
        b, ended = Bits(), 0
        def flush(b, ended):
            if ended:
                p = ended.bit_length() - 1
                b.put(*code(p << 4))
                b.put(ended - (1 << p), p)
        for row in coef:
            run, some = 0, False
            for k in range(lo, hi + 1):
                v = shift(row[k], 1)
                if v == 0:
                    run += 1
                    continue
                flush(b, ended)
                ended = 0
                while run > 15:
                    b.put(*code(0xF0))
                    run -= 16
                b.put(*code(run << 4 | size(v)))
                b.put(extra(v), size(v))
                run = 0
            if run:
                ended += 1
        flush(b, ended)
        out += scan(lo, hi, 0x01) + b.done()
    b = Bits()
    for row in coef:
        b.put(int(row[0]) & 1, 1)
    out += scan(0, 0, 0x10) + b.done()
    b = Bits()
    for row in coef:
        run, kept = 0, []
        old = [shift(v, 1) for v in row]
        final = max([k for k in range(1, 64) if abs(int(row[k])) == 1], default=0)
        for k in range(1, 64):
            if k > final:
                kept += [abs(int(row[k])) & 1] if old[k] else []
                continue
            if old[k]:
                kept.append(abs(int(row[k])) & 1)
            elif abs(int(row[k])) == 1:
                b.put(*code(run << 4 | 1))
                b.put(int(row[k] > 0), 1)
                for x in kept:
                    b.put(x, 1)
                run, kept = 0, []
            else:
                if run == 15:
                    b.put(*code(0xF0))
                    for x in kept:
                        b.put(x, 1)
                    run, kept = 0, []
                else:
                    run += 1
        if final < 63:
            b.put(*code(0x00))
            for x in kept:
                b.put(x, 1)
    out += scan(1, 63, 0x10) + b.done()
    return out + b"\xff\xd9"


def test_decoder_reads_a_serial_encoders_files():
    rng = np.random.default_rng(9)
    for density in (0.02, 0.1, 0.5, 1.0):
        coef = rng.integers(-200, 201, (12, 64)) * (rng.random((12, 64)) < density)
        small = rng.random((12, 64)) < 0.3
        coef = np.where(small, rng.integers(-1, 2, (12, 64)), coef)
        images, got = jpeg.decode([plain_progressive(coef, 30, 20), plain_progressive(coef[::-1], 32, 24)])
        assert (got[:12] == coef).all() and (got[12:] == coef[::-1]).all()
        assert jpeg.tensor(images[0], got).shape == (20, 30, 1)


def test_flat_picture_has_its_colour():
    coef = np.zeros((6, 64), np.int16)
    coef[:4, 0], coef[4, 0], coef[5, 0] = 8 * 20, 8 * -30, 8 * 40
    image = jpeg.parse(jpeg.store([b"x" * 384])[0], {})
    rgb = jpeg.tensor(image, coef)
    assert rgb.shape == (16, 16, 3) and tuple(rgb[5, 5]) == (204, 130, 95)


def test_pipeline_on_the_smallest_tables(spark):
    import corpus_pipeline
    from pathlib import Path

    folder = "/root/testdata/sf0.001"
    if not Path(folder).exists():
        pytest.skip("test tables are not here")
    assert [n for n, _ in corpus_pipeline.STAGES][1:4] == ["n-gram Jaccard join", "secret scans", "mixing sources to target weights"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    clean = corpus_pipeline.drop_toxic(spark, docs, folder)
    assert clean.columns == docs.columns and clean.count() > 0.7 * docs.count()
    texts = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, folder).collect()}
    want = linked([t for _, t in texts], 5, 0.8)
    assert kept == {d for (d, _), (i, (_, c)) in zip(texts, enumerate(want)) if c == i}
    hidden = corpus_pipeline.hide_secrets(spark, docs, folder)
    assert hidden.count() == docs.count() and hidden.filter("text rlike '[0-9a-f]{16,}'").isEmpty()
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0


def test_very_long_payloads_get_wider_images():
    for blocks in (1, 6 * 64, 6 * 64 * 4095, 6 * 64 * 4095 + 1, 6 * 4095 * 4095):
        wide, high = jpeg.shape_for(blocks)
        assert 6 * wide * high >= blocks and max(wide, high) * 16 < 1 << 16
    assert jpeg.shape_for(6 * 64 * 4095) == (64, 4095)
    with pytest.raises(ValueError):
        jpeg.shape_for(6 * 4095 * 4095 + 1)


def test_parities_never_differ_in_more_places_than_sets_in_members(spark, frame):
    t, rng = Fraction("0.8"), np.random.default_rng(3)
    for n in (5, 40, 300, 2000):
        a = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
        for gone in (0, 1, n // 9, n // 2, n):
            b = np.unique(np.concatenate((a[gone:], rng.integers(0, 1 << 63, gone, np.uint64))))
            scheme = next(x for x in fragment_join.schemes(t) if x.cuts and x.lo <= n <= x.hi)
            x, y = (fragment_join._parities(m, scheme.wide) for m in (a, b))
            assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))
    # unlike sets of one size are dropped without their texts
    docs = frame("doc_id long, text string", [(i, " ".join(f"w{rng.integers(0, 10**6)}" for _ in range(200))) for i in range(8)])
    rows = fragment_join.nodes(docs, "doc_id", "text", 5, t)
    bits = rows.select("node", "n", F.explode("parities").alias("p")).select("node", "n", "p.s", "p.bits")
    pairs = bits.select(F.col("node").alias("a"), "s").join(bits.select(F.col("node").alias("b"), "s"), "s")
    assert fragment_join._possible(pairs, bits, t).filter("a <> b").count() == 0
    assert fragment_join._possible(pairs, bits, t).count() == bits.count()


def test_settled_tables_leave_no_shuffle_files(spark, monkeypatch):
    from tableloom import session

    before = spark.conf.get(session.GIVE_BACK, None)
    seen = []
    with session.giving_back(spark):
        seen.append(spark.conf.get(session.GIVE_BACK))
    assert seen == ["true"] and spark.conf.get(session.GIVE_BACK, None) == before

    def held():
        roots = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f.getName() for f in (roots.apply(i) for i in range(roots.size())) if f.getName().startswith("shuffle_")}

    were = held()
    df = session.settle(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count(), "kept")
    for _ in range(50):
        if not (left := held() - were):
            break
        time.sleep(0.1)
    assert not left and df.count() == 7
