import random

import pytest
from pyspark.sql import functions as F

from gneiss.operators import corpus, dedup, lookups, validity
from gneiss.operators.pairs import pairs_within

RESULT = "attempt bigint, success boolean, error string, volume double, surface_area double, bbox array<double>, principal_moments array<double>, n_faces int, n_edges int, n_vertices int, n_solids int"
BOX = [0.0, 0.0, 0.0, 40.0, 30.0, 6.0]


def result(attempt=0, success=True, error=None, volume=1000.0, bbox=BOX, solids=1, moments=(1.0, 2.0, 3.0), faces=6):
    return (attempt, success, error, volume, 500.0, bbox, list(moments), faces, 12, 8, solids)


@pytest.mark.parametrize(
    "row,reason",
    [
        (result(), ""),
        (result(volume=0.001), "volume too small"),
        (result(success=False, error="OCC error"), "execution failed: OCC error"),
        (result(success=None), "execution failed: missing execution result"),
        (result(solids=2, volume=0.0), "disconnected geometry"),
        (result(solids=None), "disconnected geometry"),
        (result(bbox=[0, 0, 0, 4.0, 0, 4.0], volume=5.0), "degenerate bounding box"),
        (result(bbox=[0, 0, 0, 20.0, 1.0, 1.0]), ""),
        (result(bbox=[0, 0, 0, 20.1, 1.0, 1.0]), "extreme aspect ratio"),
        (result(volume=float("nan")), ""),
        (result(volume=None), "volume too small"),
        (result(bbox=None), "degenerate bounding box"),
        (result(bbox=[1.0]), "degenerate bounding box"),
    ],
)
def test_validity_rules_in_order(spark, row, reason):
    row = tuple([float(x) for x in v] if isinstance(v, list) else v for v in row)
    got = validity.with_validity(spark.createDataFrame([row], RESULT)).first()
    assert got.reason == reason and got.valid == (reason == "")


def test_first_wins_is_the_same_for_any_partitioning(spark, rows):
    rng = random.Random(3)
    data = [(i, rng.choice("abcd") if i % 7 else None, i % 5 != 0) for i in range(300)]
    seen, want = set(), []
    for i, k, ok in data:
        want.append((i, "invalid" if not ok else "duplicate" if k in seen else "accepted"))
        if ok:
            seen.add(k)
    rng.shuffle(data)
    df = spark.createDataFrame(data, "i int, k string, ok boolean")
    for n in (1, 3, 16):
        got = dedup.first_wins(df.repartition(n), [F.col("k")], ["i"], F.col("ok")).select("i", "decision")
        assert sorted(map(tuple, got.collect())) == want
    firsts = dedup.accepted_firsts(df.where("ok"), [F.col("k")], ["i"]).select("i")
    assert sorted(r.i for r in firsts.collect()) == [i for i, d in want if d == "accepted"]


def test_first_wins_accepts_one_of_equal_rows_or_none_of_no_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "i int, k string")
    assert dedup.accepted_firsts(df, [F.lit(1)], ["i"]).count() == 1
    assert dedup.first_wins(df.limit(0), [F.col("k")], ["i"]).count() == 0
    data = [(1, "a", {"x": 1})] * 25_000 + [(2, "a", {"x": 1})] * 3 + [(3, "b", None)] * 2 + [(4, "c", None)] + [(5, None, None)] * 2
    many = spark.createDataFrame(data, "i int, k string, m map<string,int>")
    for n in (1, 3, 16):
        marked = dedup.first_wins(many.repartition(n), [F.col("k")], ["i"], F.col("i") < 5)
        got = {(r.i, r.decision): r["count"] for r in marked.groupBy("i", "decision").count().collect()}
        assert got == {(1, "accepted"): 1, (1, "duplicate"): 24_999, (2, "duplicate"): 3, (3, "accepted"): 1, (3, "duplicate"): 1, (4, "accepted"): 1, (5, "invalid"): 2}
        assert marked.columns == ["i", "k", "m", "decision"]


def test_an_outlier_does_not_crowd_the_ranges(spark):
    df = spark.range(0, 20_000).selectExpr("case when id = 19999 then 1L << 55 else id end as i", "id % 3 = 0 as ok")
    got = dedup.running_accepts(df.repartition(4), F.col("ok"), "i", 1 << 40, 100)
    rows = sorted((r.i, r.n_before, r.accepts) for r in got.collect())
    assert [n for _, n, _ in rows] == list(range(1, 20_001)) and rows[-1][2] == 6667


def greedy(rows):
    a, b, out = set(), set(), set()
    for i, x, y in rows:
        if x not in a and y not in b:
            out.add(i)
            a |= {x} - {None}
            b |= {y} - {None}
    return out


@pytest.mark.parametrize("rounds", [1, 50])
def test_greedy_two_keys(spark, rounds):
    rng = random.Random(4)
    for data in ([(0, "h0", "s0"), (1, "h0", "s1"), (2, "h2", "s1")], [(i, f"h{rng.randint(0, 30)}" if i % 9 else None, f"s{rng.randint(0, 30)}") for i in range(150)]):
        got = dedup.greedy_two_keys(spark.createDataFrame(data, "i int, h string, s string"), ["i"], "h", "s", rounds)
        assert {r.i for r in got.where("accepted").collect()} == greedy(data)


def test_mark_duplicates_shares_the_empty_key(spark):
    df = spark.createDataFrame([(1, None, True), (2, None, True), (3, "x", False), (4, "x", True), (5, "x", True)], "i int, h string, ok boolean")
    got = {r.i: r.status for r in dedup.mark_duplicates(df, [F.col("h")], ["i"], F.col("ok")).collect()}
    assert got == {1: "ok", 2: "DUP", 3: "FAIL", 4: "ok", 5: "DUP"}


@pytest.mark.parametrize("buckets", [1, 7, 1000])
def test_running_accepts(spark, buckets):
    rng = random.Random(5)
    data = [(i * 3, rng.random() < 0.3) for i in range(400)]
    k, want = 0, []
    for n, (i, ok) in enumerate(data, 1):
        k += ok
        want.append((i, n, k))
        if k == 40:
            break
    got = dedup.running_accepts(spark.createDataFrame(data, "i int, ok boolean").repartition(5), F.col("ok"), "i", 40, buckets)
    assert sorted((r.i, r.n_before, r.accepts) for r in got.collect()) == want


def test_prefixes_nest_and_come_before_filters(spark):
    df = corpus.with_ordinal(spark.createDataFrame([(i, f"p{i}" if i != 2 else "", i % 4) for i in range(40)], "i int, part_id string, tier int"), "i")
    ids = lambda n: {r.i for r in corpus.prefix_slice(df, n).collect()}
    assert ids(10) < ids(20) < ids(None) and len(ids(10)) == 10
    assert corpus.tier_cap(corpus.prefix_slice(df, 6), 2).count() == 5
    assert corpus.with_id(corpus.prefix_slice(df, 6)).count() == 5
    assert corpus.tier_cap(spark.createDataFrame([(None,), (1,)], "tier int"), 3).count() == 1


def test_shares_break_ties_by_first_appearance(spark):
    df = spark.createDataFrame([(0, "z"), (1, "a"), (2, "z"), (3, "a"), (4, "m")], "i int, f string")
    got = corpus.shares(df, F.col("f"), "f", "i").orderBy("rank").collect()
    assert [(r.f, r.n, r.pct) for r in got] == [("z", 2, 40.0), ("a", 2, 40.0), ("m", 1, 20.0)]


def test_small_reports(spark):
    files = spark.createDataFrame([("b", "depth"), ("a", "edge"), ("a", "shaded")], "part_id string, pass string")
    assert corpus.available_passes(files, ["shaded", "normal", "depth", "edge"]).first().passes == ["shaded", "edge"]
    mesh = spark.createDataFrame([("m", 0.0, 0.0, 0.0), ("m", 2.0, 4.0, 4.0)], "part_id string, x double, y double, z double")
    r = corpus.mesh_bounds(mesh).first()
    assert (r.centre_x, r.centre_y, r.centre_z, r.radius) == (1.0, 2.0, 2.0, 3.0)
    params = spark.createDataFrame([("p", 0, "w", "Body"), ("p", 1, "d", "Holes"), ("p", 2, "h", "Body")], "part_id string, pos int, name string, grp string")
    assert [(r.grp, r.names) for r in corpus.grouped_params(params).orderBy("place").collect()] == [("Body", "w, h"), ("Holes", "d")]


def test_lookups(spark):
    parts = spark.createDataFrame([("a",), ("b",)], "part_id string")
    have = spark.createDataFrame([("a", "stl"), ("a", "step"), ("b", "stl")], "part_id string, format string")
    assert [r.part_id for r in lookups.parts_to_export(parts, ["stl", "step"], have).collect()] == ["b"]
    weights = spark.createDataFrame([(0, "x", 1.0), (1, "y", 3.0)], "pos int, family string, weight double")
    got = lookups.weighted_choice(spark.createDataFrame([(0.1,), (0.25,), (0.99,)], "u double"), weights, F.col("u"))
    assert [r.family for r in got.orderBy("u").collect()] == ["x", "y", "y"]
    assert spark.range(1).select(lookups.clamp_tier(F.lit(5), F.lit(0), F.lit(2)).alias("t")).first().t == 2


@pytest.mark.parametrize("block", [1, 3, 2000])
def test_pairs_within(spark, block):
    rng = random.Random(6)
    data = [(rng.choice("abc"), i) for i in range(30)] + [("hot", 100 + i) for i in range(20)] + [(None, 7), ("a", None)]
    want = {(x, y) for k, x in data for j, y in data if k == j and k is not None and x is not None and y is not None and x < y}
    got = pairs_within(spark.createDataFrame(data + data[:5], "k string, i int"), "k", "i", block).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert pairs_within(spark.createDataFrame([], "k string, i int"), "k", "i").count() == 0
