"""What has to hold on large tables, shown on small ones."""

from __future__ import annotations

import random

import duckdb
import pytest
from helpers import as_set
from pyspark.sql import functions as F
from test_matching import edit_distance

import __spark_entry__ as driver
from tableloom.operators import candidates, graph, profile, ranges, resolve
from tableloom.operators.joins import join_data
from tableloom.operators.candidates import similar_texts


def similar(a, b, floor):
    return 1 - edit_distance(a, b) / max(len(a), len(b)) >= floor - 1e-9


def test_no_plan_of_similar_texts_repeats_the_uses_of_grams(spark, frame):
    texts = ["common beginning " + "".join(random.Random(i).choice("abcd") for _ in range(8)) for i in range(40)]
    got = similar_texts(frame("id bigint, t string", list(enumerate(texts))).withColumn("block", F.lit(1)), None, 0.8)
    assert len(got._jdf.queryExecution().toString()) < candidates.CELLS  # less than a letter for each cell


@pytest.mark.parametrize("floor", [0.55, 0.85])
def test_copies_of_texts_are_compared_once_and_all_paired(frame, monkeypatch, floor):
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abc") for _ in range(rnd.randrange(3, 9))) for _ in range(12)] * 4
    compared = []
    chosen = candidates.rarest_pieces
    monkeypatch.setattr(candidates, "rarest_pieces", lambda items, *more: compared.append(items.count()) or chosen(items, *more))
    df = frame("id bigint, t string", list(enumerate(words))).withColumn("block", F.lit("b"))
    got = similar_texts(df, None, floor)
    assert got.count() == len(as_set(got))
    assert as_set(got) == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if i < j and similar(a, b, floor)}
    assert compared == [len(set(words))]
    two = similar_texts(df.filter("id < 20"), df.filter("id >= 20"), floor)
    assert as_set(two) == {(i, j) for i, a in enumerate(words[:20]) for j, b in enumerate(words) if j >= 20 and similar(a, b, floor)}
    assert two.count() == len(as_set(two))


def test_texts_longer_and_shorter_than_the_placed_ones_meet(frame):
    rnd = random.Random(6)
    texts = []
    for n in (60, 62, 64, 66, 70, 90):
        base = "".join(rnd.choice("abcdefgh") for _ in range(n))
        texts += [base, base[:-5], "zz" + base[4:], base[:20] + "yy" + base[20:], base[:30] + base[33:] + "qq"]
    got = as_set(similar_texts(frame("id bigint, t string", list(enumerate(texts))).withColumn("block", F.lit(1)), None, 0.85))
    assert got == {(i, j) for i, a in enumerate(texts) for j, b in enumerate(texts) if i < j and similar(a, b, 0.85)}


def test_near_balances_leave_copies_out_as_their_sql_does(spark, frame, tmp_path):
    rows = [(i, f"n{i}", i % 2, 100.0 + i % 6, "s") for i in range(18)] + [(90 + i, "z", 1, b, "s") for i, b in enumerate((0.0, -0.0, -5.0, None, None))]
    df = frame("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", rows)
    df.coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM read_parquet('{tmp_path}/customer.parquet/*.parquet')")
    got = driver.queries()["er_near_balances"](spark, str(tmp_path))
    want = con.execute(driver.oracle_sql()["er_near_balances"]).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) != []


def test_points_meet_few_intervals_beside_them(spark, monkeypatch):
    points = spark.range(2000).selectExpr("id AS i", "id / 20D AS x")
    bands = spark.range(500).selectExpr("id AS j", "id / 5D AS lo", "id / 5D + CASE WHEN id % 5 = 0 THEN 0.5D ELSE 0.02D END AS hi")
    laid = []
    spread = ranges._spread
    monkeypatch.setattr(ranges, "_spread", lambda *args: laid.append(spread(*args)) or laid[-1])
    got = join_data(points, bands, "a.x >= b.lo AND a.x < b.hi", "inner", "i", "j")
    want = points.join(bands, F.expr("x >= lo AND x < hi"))
    assert as_set(got) == as_set(want.select("i", "j")) and got.count() == want.count()
    met = laid[0].drop("own", "first", "last").join(laid[1].select("at", "bin"), ["at", "bin"]).count()
    assert met <= 2 * want.count()


def test_exact_counts_are_taken_of_small_parts(spark):
    df = spark.range(0, 1000, 1, 1).selectExpr("id", "id % 7 AS few")
    got = profile.profile(df, exact_distinct=True)
    assert as_set(got, "Column_Name", "Approx_Distinct_Values", "Total_Rows") == {("id", 1000, 1000), ("few", 7, 1000)}
    assert "RoundRobinPartitioning(4)" in got._jdf.queryExecution().executedPlan().toString()


def test_hierarchies_with_stops_write_few_rows(spark, frame, monkeypatch):
    n, written = 4000, []
    settled = graph.settle
    monkeypatch.setattr(graph, "settle", lambda df, label, *more: written.append(settled(df, label, *more)) or written[-1])
    chain = spark.range(n).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("up"))

    def rows():
        total = sum(df.count() for df in written)
        written.clear()
        return total

    plain = graph.flatten_hierarchy(chain, "id", "up", paths=False)
    before = rows()
    monkeypatch.setattr(graph, "FEW", 10)
    got = graph.flatten_hierarchy(chain, "id", "up", paths=False)
    assert as_set(got) == as_set(plain) == {(i, 0, i) for i in range(n)}
    assert rows() < before
    nodes = [(f"n{i}", f"n{i // 2}" if i > 1 else None) for i in range(1, 60)] + [("n50", "n3"), ("lost", "nobody"), ("below", "lost")]
    nodes += [(f"c{i}", f"c{(i + 1) % 30}") for i in range(30)] + [("hung", "c4"), ("c7", "n5")]
    df = frame("id string, up string", nodes)
    got = graph.flatten_hierarchy(df.filter("id NOT IN ('c7')"), "id", "up", keep_unrooted=True)
    monkeypatch.setattr(graph, "FEW", 1000)
    assert as_set(got) == as_set(graph.flatten_hierarchy(df.filter("id NOT IN ('c7')"), "id", "up", keep_unrooted=True))
    assert got.count() == len(nodes) - 2


@pytest.mark.parametrize("tables", [1, 2])
def test_links_of_near_numbers_are_neither_written_nor_shuffled(spark, frame, monkeypatch, tables):
    written = []
    settled = resolve.settle
    monkeypatch.setattr(resolve, "settle", lambda df, label="stage", *more: written.append(label) or settled(df, label, *more))
    df = frame("id bigint, grp bigint, amt double", [(i, i % 2, 100.0 + i % 23) for i in range(60)] + [(90, 0, None), (91, 1, 0.0), (92, 1, 0.0)])
    spec = resolve.MatchSpec(
        [resolve.Comparison("grp", "grp", "exact"), resolve.Comparison("amt", "amt", "percent_difference")],
        "a_grp_b_grp_exact = 1.0 AND a_amt_b_amt_percent_difference < 4", None, "id", percent_ceiling=4.0,
    )
    sides = (df, None) if tables == 1 else (df.filter("id % 3 = 0"), df.filter("id % 3 <> 0"))
    found = resolve.resolve(sides[0], spec, sides[1])
    assert set(written) == {"profiles"}
    # one shuffle for each side of the one join, none of pairs
    assert found.links._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 2
    first = [{}, {}]
    for i, grp, amt in df.collect():
        first[0 if tables == 1 else i % 3 > 0].setdefault((grp, amt), i)
    mine, other = first[0], first[0] if tables == 1 else first[1]
    want = {(i, j) for (g, x), i in mine.items() for (h, y), j in other.items() if g == h and (i < j or tables == 2) and x and y is not None and abs(y - x) / x * 100 < 4}
    assert as_set(found.links, "id_a", "id_b") == want and found.links.count() == len(want) > 100
    groups = {r.id: r.match_group_id for r in found.records.filter("side = 'a'").collect()}
    assert {i for i, g in groups.items() if g is None} <= {90, 91, 92} and len(groups) == sides[0].count()
    assert as_set(found.pairs, "id_a", "id_b") >= want


@pytest.mark.parametrize("floor", [0.55, 0.8])
@pytest.mark.parametrize("tables", [1, 2])
def test_texts_are_moved_in_parts_of_their_blocks_and_not_by_their_grams(frame, monkeypatch, floor, tables):
    monkeypatch.setattr(candidates, "LEAST_PART", 300)
    monkeypatch.setattr(candidates, "PARTS", 6)
    rnd = random.Random(11)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.choice((5, 9, 10, 40)))) for _ in range(60)]
    words += [w[:3] + rnd.choice("xyz") + w[4:] for w in words[:40]] + [w[2:] + "q" for w in words[:20]] + ["r" * 66 + w for w in words[:12]]
    df = frame("id bigint, t string", list(enumerate(words))).withColumn("block", F.col("id") % 3 % 2)
    sides = (df, None) if tables == 1 else (df.filter("id < 60 OR id > 125"), df.filter("id BETWEEN 60 AND 125"))
    got = similar_texts(*sides, floor)
    plan = got._jdf.queryExecution().executedPlan().toString()
    # parts meet in a task: no join of grams, and what is moved are the texts and the pairs
    assert plan.count("SortMergeJoin") == 0 and plan.count("MapInArrow") == 1 + tables
    want = {
        (i, j) for i, a in enumerate(words) for j, b in enumerate(words)
        if i % 3 % 2 == j % 3 % 2 and (i < j if tables == 1 else not 60 <= i <= 125 and 60 <= j <= 125) and similar(a, b, floor)
    }
    assert as_set(got) == want and got.count() == len(want) > 20


def test_large_sets_that_share_a_few_words_do_not_meet(frame, monkeypatch):
    rng = random.Random(6)
    # every two texts share 40 words that are no more frequent than their own ones, which no parity tells apart
    texts = [" ".join([f"w{i}" for i in rng.sample(range(20000), 900)]) for _ in range(60)]
    texts += [" ".join(w if rng.random() > 0.12 else f"x{rng.randrange(10**6)}" for w in texts[n].split()) for n in range(20)]
    rows, met = frame("id bigint, t string", list(enumerate(texts))), []
    grouped = type(rows).groupBy
    monkeypatch.setattr(type(rows), "groupBy", lambda df, *by: (met.append(df) if "more" in map(str, by) else None) or grouped(df, *by))
    got = {(a, b): s for a, b, s in candidates.similar_word_sets(rows, None, "t", 0.7).collect()}
    sets = [set(t.split()) for t in texts]
    score = lambda i, j: len(sets[i] & sets[j]) / len(sets[i] | sets[j])
    assert got == pytest.approx({(i, j): score(i, j) for i in range(80) for j in range(i + 1, 80) if score(i, j) >= 0.7}) and len(got) > 9
    assert met[0].select("id_a", "id_b").distinct().count() < 1000  # of 3,160; by single words all of them meet


@pytest.mark.parametrize("floor", [0.55, 0.7, 0.9])
def test_sets_about_the_size_from_which_they_meet_by_neighbours(frame, floor):
    rng = random.Random(int(floor * 100))
    texts = []
    for n in (56, 63, 64, 65, 70, 90, 128, 200):
        words = [f"w{rng.randrange(2000)}" for _ in range(n)]
        texts.append(" ".join(words))
        for rate in (0.02, 0.1, 0.2, 0.3):
            texts += [" ".join(w for w in words if rng.random() > rate), " ".join(w if rng.random() > rate / 2 else f"x{rng.randrange(10**6)}" for w in words), " ".join([*words, *(f"y{i}" for i in range(int(n * rate)))])]
    sets = [set(t.split()) for t in texts]
    score = lambda i, j: len(sets[i] & sets[j]) / len(sets[i] | sets[j])
    got = {(a, b): s for a, b, s in candidates.similar_word_sets(frame("id bigint, t string", list(enumerate(texts))), None, "t", floor).collect()}
    assert got == pytest.approx({(i, j): score(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if score(i, j) >= floor - 1e-9}) and len(got) > 30


@pytest.mark.parametrize("turned", [False, True])
def test_intervals_meet_points_at_their_own_level_only(spark, monkeypatch, turned):
    points = spark.range(500).selectExpr("id AS i", "id / 20D AS x")
    bands = spark.range(120).selectExpr("id AS j", "id / 5D AS lo", "id / 5D + CASE WHEN id % 5 = 0 THEN 0.5D WHEN id % 7 = 0 THEN 0D ELSE 0.02D END AS hi")
    laid = []
    spread = ranges._spread
    monkeypatch.setattr(ranges, "_spread", lambda *args: laid.append(spread(*args)) or laid[-1])
    if turned:
        got = join_data(bands, points, "b.x >= a.lo AND b.x <= a.hi", "inner", "j", "i").select("i", "j")
    else:
        got = join_data(points, bands, "a.x >= b.lo AND a.x <= b.hi", "inner", "i", "j")
    want = points.join(bands, F.expr("x >= lo AND x <= hi")).select("i", "j")
    assert as_set(got) == as_set(want) and got.count() == want.count() > 100
    assert laid[0 if turned else 1].filter("at <> own").isEmpty()
