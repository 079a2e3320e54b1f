from __future__ import annotations

import random

import numpy as np
import pytest
from helpers import as_set
from pyspark.sql import functions as F

from tableloom.operators import candidates, graph
from tableloom.operators.candidates import similar_texts, similar_word_sets
from tableloom.operators.resolve import Comparison, MatchSpec, resolve, resolve_step
from tableloom.spec import SpecError


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def roots(edges):
    parent = {}
    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {(x, find(x)) for x in parent}


def test_components_of_chains_hubs_and_noise(frame):
    rnd = random.Random(3)
    edges = [(rnd.randrange(80), rnd.randrange(80)) for _ in range(45)] + [(200 + i, 201 + i) for i in range(33)] + [(500, 501 + i) for i in range(60)]
    assert as_set(graph.connected_components(frame("a bigint, b bigint", edges))) == roots(edges)


def test_hierarchy_depth_and_cycle(frame):
    tree = frame("id string, up string", [("a", None), ("b", "a"), ("c", "b"), ("z", None)])
    assert as_set(graph.flatten_hierarchy(tree, "id", "up")) == {("a", "a", 0, "a"), ("b", "a", 1, "a>b"), ("c", "a", 2, "a>b>c"), ("z", "z", 0, "z")}
    with pytest.raises(SpecError):
        graph.flatten_hierarchy(tree, "id", "up", max_depth=1)


def test_deep_hierarchies_take_logarithmic_rounds(spark, monkeypatch):
    n, rounds = 5000, []
    settled = graph.settle
    monkeypatch.setattr(graph, "settle", lambda df, label, *more: rounds.append(label) or settled(df, label, *more))
    chain = spark.range(n).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("up"))
    got = graph.flatten_hierarchy(chain, "id", "up", paths=False)
    assert got.filter("depth <> node OR root <> 0").count() == 0 and got.count() == n
    assert len(rounds) <= 15  # the first state and at most 14 rounds
    cyclic = chain.withColumn("up", F.when(F.col("id") == 0, F.lit(n - 1)).otherwise(F.col("up")))
    with pytest.raises(SpecError, match="5000 nodes hang on no root"):
        graph.flatten_hierarchy(cyclic, "id", "up", paths=False)


def test_nodes_with_two_parents_and_nodes_without_a_root(frame):
    nodes = frame("id string, up string", [("r", None), ("q", None), ("m", "r"), ("m", "q"), ("x", "m"), ("lost", "nobody"), ("below", "lost"), ("c1", "c2"), ("c2", "c1")])
    got = as_set(graph.flatten_hierarchy(nodes, "id", "up", keep_unrooted=True))
    assert got == {("r", "r", 0, "r"), ("q", "q", 0, "q"), ("m", "r", 1, "r>m"), ("m", "q", 1, "q>m"), ("x", "r", 2, "r>m>x"), ("x", "q", 2, "q>m>x"),
                   ("lost", None, None, None), ("below", None, None, None), ("c1", None, None, None), ("c2", None, None, None)}
    assert graph.flatten_hierarchy(nodes.limit(0), "id", "up").count() == 0


@pytest.mark.parametrize("floor", [0.5, 0.6, 0.67, 0.75, 0.85, 1.0])
def test_no_similar_text_is_lost(frame, floor):
    rnd = random.Random(int(floor * 100))
    words = ["".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 12))) for _ in range(60)]
    df = frame("id bigint, t string", list(enumerate(words))).withColumn("block", F.lit(1))
    found = as_set(similar_texts(df, None, floor))
    for i, a in enumerate(words):
        for j in range(i + 1, len(words)):
            b = words[j]
            if 1 - edit_distance(a, b) / max(len(a), len(b)) >= floor:
                assert (i, j) in found, (a, b)


@pytest.mark.parametrize("floor", [0.5, 0.8])
def test_no_similar_text_of_two_tables_is_lost(frame, floor):
    rnd = random.Random(3)
    words = ["common beginning " + "".join(rnd.choice("abcd") for _ in range(rnd.randrange(0, 9))) for _ in range(60)]
    left = frame("id bigint, t string", list(enumerate(words[:30]))).withColumn("block", F.col("id") % 2)
    right = frame("id bigint, t string", list(enumerate(words[30:] + [None, ""]))).withColumn("block", F.col("id") % 2)
    found = as_set(similar_texts(left, right, floor))
    for i, a in enumerate(words[:30]):
        for j, b in enumerate(words[30:]):
            if i % 2 == j % 2 and 1 - edit_distance(a, b) / max(len(a), len(b)) >= floor:
                assert (i, j) in found, (a, b)
    assert all(i % 2 == j % 2 for i, j in found)


def test_a_common_beginning_is_no_piece(frame):
    rnd = random.Random(8)
    texts = ["the same long beginning " + "".join(rnd.choice("0123456789abcdef") for _ in range(16)) for _ in range(300)]
    found = as_set(similar_texts(frame("id bigint, t string", list(enumerate(texts))).withColumn("block", F.lit(1)), None, 0.9))
    assert len(found) < 4485  # a tenth of the 44,850 pairs that share the beginning


def test_no_similar_word_set_is_lost(frame):
    rnd = random.Random(9)
    texts = [" ".join(rnd.sample("a b c d e f g h".split(), rnd.randrange(1, 8))) for _ in range(50)]
    got = {(a, b): s for a, b, s in similar_word_sets(frame("id bigint, t string", list(enumerate(texts))), None, "t", 0.7).collect()}
    want = {}
    for i, a in enumerate(texts):
        for j in range(i + 1, len(texts)):
            x, y = set(a.split()), set(texts[j].split())
            if len(x & y) / len(x | y) >= 0.7:
                want[(i, j)] = len(x & y) / len(x | y)
    assert got == pytest.approx(want)


SPEC = MatchSpec(
    [Comparison("grp", "grp", "exact"), Comparison("name", "name", "fuzzy"), Comparison("amt", "amt", "percent_difference")],
    "a_grp_b_grp_exact = 1.0 AND a_name_b_name_fuzzy > 0.85", "a_name_b_name_fuzzy > 0.7", "id", fuzzy_floor=0.7,
)


@pytest.fixture
def people(frame):
    return frame("id bigint, name string, grp string, amt double", [
        (1, "John Smith", "a", 100.0), (2, "Jon Smith", "a", 101.0), (3, "Jane Doe", "b", 5.0), (4, "Jane Doe", "b", 5.0),
        (5, "Zed", "a", 1.0), (6, "john smith!", "c", 100.0), (7, "Jane Dos", "b", 0.0), (8, None, None, None),
    ])


def test_self_resolution(people):
    out = resolve(people, SPEC)
    assert as_set(out.records, "id", "match_group_id") == {(1, 1), (2, 1), (3, 3), (4, 3), (5, None), (6, None), (7, 3), (8, None)}
    table = resolve_step(people, SPEC)
    assert as_set(table, "a_match_id", "b_match_id", "match_outcome") >= {(1, 2, "Auto_Match"), (3, 4, "Auto_Match"), (5, None, "No_Match")}
    assert table.count() == 6


def test_many_copies_make_a_star_not_all_pairs(spark):
    df = spark.range(300).select("id", F.lit("same").alias("v"))
    spec = MatchSpec([Comparison("v", "v", "exact")], "a_v_b_v_exact = 1.0", None, "id")
    out = resolve(df, spec)
    assert out.pairs.count() == 299
    assert out.records.filter("match_group_id = 0 AND match_outcome = 'Auto_Match'").count() == 300


def test_two_tables_keep_equal_ids_apart(frame):
    left = frame("id bigint, v string", [(1, "x"), (2, "y"), (3, "q")])
    right = frame("id bigint, v string", [(1, "y"), (2, "x"), (9, "x"), (3, "r")])
    spec = MatchSpec([Comparison("v", "v", "exact")], "a_v_b_v_exact = 1.0", None, "id")
    out = resolve(left, spec, right)
    assert as_set(out.records, "side", "id", "match_outcome") == {
        ("a", 1, "Auto_Match"), ("a", 2, "Auto_Match"), ("a", 3, "No_Match"), ("b", 1, "Auto_Match"), ("b", 2, "Auto_Match"),
        ("b", 9, "Auto_Match"), ("b", 3, "No_Match"),
    }
    assert as_set(out.pairs, "id_a", "id_b") == {(1, 2), (1, 9), (2, 1)}


def test_soundex_and_step_attributes(frame):
    df = frame("id bigint, n string", [(1, "Robert"), (2, "Rupert"), (3, "Ann")])
    spec = MatchSpec.parse({
        "primary_dataset_comparison_fields": "n", "comparison_types": "soundex", "auto_match_logic": "a_n_b_n_soundex = 1.0", "id_column": "id",
    })
    assert as_set(resolve(df, spec).records, "id", "match_group_id") == {(1, 1), (2, 1), (3, None)}
    with pytest.raises(SpecError):
        MatchSpec.parse({"primary_dataset_comparison_fields": "n", "comparison_types": "psychic", "auto_match_logic": "x", "id_column": "id"})


def test_fuzzy_needs_a_floor(people):
    loose = MatchSpec(SPEC.comparisons, SPEC.auto_rule, None, "id", fuzzy_floor=0.3)
    with pytest.raises(SpecError):
        resolve(people, loose)


@pytest.mark.parametrize("floor", [0.03, 0.5, 0.7, 1.0])
@pytest.mark.parametrize("tables", [1, 2])
def test_word_sets_equal_all_pairs_compared(frame, floor, tables):
    rng = random.Random(5)
    base = [[f"w{rng.randrange(300)}" for _ in range(rng.choice([1, 3, 20, 90]))] for _ in range(25)]
    texts = [" ".join(w if rng.random() > rate else f"x{rng.randrange(50)}" for w in words) for words in base for rate in (0.0, 0.1, 0.3)]
    sets = [set(t.split()) for t in texts]
    want = {}
    for i in range(len(texts)):
        for j in range(len(texts)):
            score = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
            if (i < j if tables == 1 else i % 2 == 0 and j % 2 == 1) and score >= floor:
                want[i, j] = score
    rows = frame("id bigint, t string", [*enumerate(texts), (900, ""), (901, None)])
    sides = (rows, None) if tables == 1 else (rows.filter("id % 2 = 0"), rows.filter("id % 2 = 1"))
    got = {(a, b): s for a, b, s in similar_word_sets(*sides, "t", floor).collect()}
    assert got == pytest.approx(want)


def test_texts_that_only_share_a_rare_word_are_not_compared_by_their_words(frame, monkeypatch):
    rng = random.Random(6)
    texts = [" ".join([f"rare{n % 10}", *(f"w{i}" for i in rng.sample(range(20000), 400))]) for n in range(200)]
    compared = []
    written = candidates.settle

    def counting(df, label="stage", *rest):
        out = written(df, label, *rest)
        if label == "pairs":
            compared.append(out.count())
        return out

    monkeypatch.setattr(candidates, "settle", counting)
    rows = frame("id bigint, t string", [*enumerate(texts), (500, texts[7] + " more")])
    assert [(a, b) for a, b, _ in similar_word_sets(rows, None, "t", 0.7).collect()] == [(7, 500)]
    assert compared == [1]


def test_pieces_of_short_texts_are_disjoint_rare_and_one_more_than_edits():
    rng = random.Random(7)
    _, cells, pieces = candidates._in_tasks(0.8)
    texts = ["building " + "".join(rng.choice("0123456789abcdef") for _ in range(12)) for _ in range(300)]
    uses = np.zeros(candidates.CELLS, np.int64)
    for t in texts:
        for q in (2, 3, 4):
            np.add.at(uses, cells(t, q), 1)
    for t in [*texts, "a", "ab", "abcde", "x" * 64, "y" * 65, "z" * 200]:
        edits, places, sizes = pieces(t, uses)
        assert edits == int(len(t) * 0.2 + 1e-9) and len(places) == len(sizes) == edits + 1
        assert all(at + q <= after for at, q, after in zip(places, sizes, [*places[1:], len(t)]))
    # with one length for all of them, twelve letters of their own would give five pieces of two
    assert sum(len(set(pieces(t, uses)[2])) > 1 for t in texts) > 250
