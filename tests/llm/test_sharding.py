"""The tree of weighted draws against a plain descent, and its promises."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

pytest.importorskip("tableloom.llm")

from tableloom.llm import hash_tree  # noqa: E402
from tableloom.llm.hash_tree import FORTY, NEXT, Tree  # noqa: E402


def draw(key, name):
    return int(hashlib.md5(f"{key}|{name}".encode()).hexdigest()[:13], 16)


def clock(key, name, weight):
    return -math.log((draw(key, name) + 1) / 2**52) / weight if weight > 0 else math.inf


def plain_shard(key, tree):
    first = {(r, k): 0 for r, racks in enumerate(tree.base) for k, _ in enumerate(racks)}
    n = 0
    for r, racks in enumerate(tree.base):
        for k, rack in enumerate(racks):
            first[r, k] = n
            n += len(rack)
    best, region = min((clock(key, f"region {r}", sum(map(sum, racks))), r) for r, racks in enumerate(tree.base))
    _, rack = min((clock(key, f"rack {region}.{k}", sum(ws)), k) for k, ws in enumerate(tree.base[region]))
    _, leaf = min((clock(key, f"shard {region}.{rack}.{s}", w), s) for s, w in enumerate(tree.base[region][rack]))
    late = [(clock(key, f"added {tree.built + i} in region {a.region}, rack {a.rack}", a.weight), tree.built + i) for i, a in enumerate(tree.added)]
    return min([(best, first[region, rack] + leaf), *late])[1]


@pytest.fixture
def docs(frame):
    texts = [None, "", "same", "same", "é 😀" * 40, "x" * 3_000_000]
    rows = [(i, texts[i % 5], "law", 1) for i in range(400)] + [(None, "no id", "a", 2), (None, "no id", "a", 2), (7, "again", "b", 3), (500, texts[5], None, 4)]
    return frame("doc_id long, text string, law string, slot int", rows)


def test_assignment_equals_a_plain_descent(docs):
    got = hash_tree.assign(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id != 7}
    assert len(got) == docs.count()
    for r in got:
        key = "" if r.doc_id is None else str(r.doc_id)
        assert (r.law, r.shard, r.grown_shard) == ("key", plain_shard(key, FORTY), plain_shard(key, FORTY.grown(NEXT.region, NEXT.rack)))
        if r.doc_id != 7:
            body = (texts[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(body) + 16, zlib.crc32(body))
    for shard in {r.shard for r in got}:
        mine = sorted((r for r in got if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in mine] == list(range(len(mine)))
        order = [draw("" if r.doc_id is None else r.doc_id, "slot") for r in mine]
        assert order == sorted(order)


def test_further_shards_take_rows_only_into_themselves(spark):
    keys = spark.range(4000).withColumnRenamed("id", "doc_id")
    trees = {"s0": FORTY}
    for i, (region, rack, weight) in enumerate([(2, 0, 1.0), (0, 9, 3.0), (5, 0, 0.5), (2, 0, 1.0)]):
        trees[f"s{i + 1}"] = trees[f"s{i}"].grown(region, rack, weight)
    rows = hash_tree.shards(keys, trees).collect()
    for before, after, new in [(f"s{i}", f"s{i + 1}", 40 + i) for i in range(4)]:
        assert {r[after] for r in rows if r[after] != r[before]} == {new}
    share = Counter(r.s4 for r in rows)
    assert share[41] == pytest.approx(4000 * 3 / 45.5, rel=0.25)


def test_weights_and_moves_stay_in_their_subtree(spark):
    tree = Tree((((4.0, 2.0), (1.0,)), ((1.0, 1.0), (1.0,)), ((2.0,),)))
    keys = spark.range(6000).withColumnRenamed("id", "doc_id")
    before = {r.doc_id: r.s for r in hash_tree.shards(keys, {"s": tree}).collect()}
    share = Counter(before.values())
    for shard, weight in enumerate((4, 2, 1, 1, 1, 1, 2)):
        assert share[shard] == pytest.approx(6000 * weight / 12, rel=0.15)
    after = {r.doc_id: r.s for r in hash_tree.shards(keys, {"s": tree.reweighted(0, 0, 1, 0.0)}).collect()}
    assert 1 not in after.values()
    for key, old in before.items():
        # all moves begin or end in the region, and inside it in the rack, whose weight fell
        assert old == after[key] or old in (0, 1, 2)
        assert not (old == 2 and after[key] in (0, 1))


def test_one_key_with_a_third_of_all_rows_is_numbered_in_ranges(spark):
    df = spark.range(900).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text"))
    got = hash_tree.assign(df).filter("doc_id IS NULL").collect()
    assert len(got) == 300 and len({(r.shard, r.slot) for r in got}) == 300


def test_empty_tables_and_written_shards(spark, frame, docs, tmp_path):
    empty = frame("doc_id long, text string", [])
    assert hash_tree.assign(empty).collect() == []
    hash_tree.write_shards(docs, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    want = {(r.doc_id, r.shard) for r in hash_tree.assign(docs).collect()}
    assert {(r.doc_id, r.shard) for r in back.collect()} == want and back.count() == docs.count()


@pytest.mark.parametrize("name", ["_key", "row", "_FIRST", "_region", "_Tie", "__range", "shard", "Shard0"])
def test_clashing_names(frame, name):
    df = frame(f"doc_id long, text string, `{name}` map<string,int>", [(1, "a", {"x": 1})])
    assert len(hash_tree.assign(df).collect()) == 1
    assert hash_tree.shards(df, {"shard": FORTY}).columns == [c for c in df.columns if c.lower() != "shard"] + ["shard"]
