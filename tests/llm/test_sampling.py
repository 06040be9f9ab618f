import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gneiss.llm import sampling
from gneiss.llm.sampling import Category, clean_family, rake, repair, sample_to_targets, smallest

MANIFEST = "part_id string, family string, tier int, loaded_at timestamp, plan_id string, category_id string"
PLANS = "plan_id string, sample_rows bigint, family string"
TARGETS = "plan_id string, category_id string, family string, tier int, target_share double, min_rows bigint, part_id string"


def test_families_are_cleaned(spark):
    df = spark.createDataFrame([("\tPlate  ",), ("  ",), ("",), (None,), ("　gEAR\n",)], "f string").coalesce(1)
    assert [r.x for r in df.select(clean_family(F.col("f")).alias("x")).collect()] == ["plate", None, None, None, "gear"]


def cat(i, family=None, tier=None, share=0.0, minimum=0):
    return Category(i, family, tier, share, minimum, 0.0)


def test_raking_meets_margins():
    cells = {(f, t): n for f, row in zip("abc", ([10, 20, 30], [5, 5, 5], [100, 0, 1])) for t, n in enumerate(row) if n}
    cats = [cat("a", "a", None, 0.5), cat("b", "b", None, 0.3), cat("c", "c", None, 0.2), cat("0", None, 0, 0.6), cat("1", None, 1, 0.4 - 0.1), cat("2", None, 2, 0.1)]
    w = rake(cells, cats)
    for c in cats:
        assert sum(v for x, v in w.items() if c.holds(x)) == pytest.approx(c.share, abs=1e-6)
    assert rake({}, cats) == {}
    half = rake({("a", 0): 1, ("b", 0): 3}, [cat("a", "a", None, 0.9)])
    assert half[("a", 0)] == pytest.approx(0.9) and half[("b", 0)] == pytest.approx(0.1)
    over = rake({("a", 0): 1, ("b", 0): 3}, [cat("a", "a", None, 1.5), cat("b", "b", None, 0.5)])
    assert over[("a", 0)] == pytest.approx(0.75)


@pytest.mark.parametrize("seed", range(20))
def test_repair_keeps_minimums_and_size(seed):
    rng = random.Random(seed)
    cells = {(f, t): rng.randint(1, 30) for f in "abcd" for t in range(3)}
    cats = [cat(f, f, None, 0.25, rng.choice([0, 2, 8])) for f in "abcd"] + [cat(str(t), None, t, 1 / 3, rng.choice([0, 3])) for t in range(3)]
    size = rng.randint(40, 60)
    left, drawn = size, Counter()
    for x in rng.sample([x for x, n in cells.items() for _ in range(n)], min(left, sum(cells.values()))):
        drawn[x] += 1
    take = repair(drawn, cells, rake(cells, cats), cats, size)
    assert all(0 <= k <= cells[x] for x, k in take.items()) and sum(take.values()) == min(size, sum(cells.values()))
    for c in cats:
        have = sum(n for x, n in cells.items() if c.holds(x))
        assert sum(k for x, k in take.items() if c.holds(x)) >= min(c.minimum, have)


@pytest.mark.parametrize("lo,hi", [(0.0, 1.0), (0.2, 0.3), (0.9, 0.95), (0.0, 1e-9)])
def test_smallest_needs_no_good_guess(spark, lo, hi):
    rng = random.Random(1)
    data = [(g, rng.random() if i % 5 else 0.5, f"i{i}") for g in "ab" for i in range(100)]
    df = spark.createDataFrame(data, "g string, v double, i string")
    wanted = spark.createDataFrame([("a", 30, lo, hi), ("b", 500, lo, hi), ("none", 3, lo, hi)], "g string, k long, lo double, hi double")
    got = smallest(df, ["g"], "v", "i", wanted).collect()
    for g, k in (("a", 30), ("b", 100)):
        assert sorted((r.v, r.i) for r in got if r.g == g) == sorted((v, i) for x, v, i in data if x == g)[:k]
    assert smallest(df, ["g"], "v", "i", wanted.limit(0)).count() == 0


def corpus(rng, n):
    rows = []
    for i in range(n):
        f, t = rng.choice(["plate"] * 6 + ["gear", "bracket", "odd"]), rng.randint(0, 3)
        rows.append((f"p{i}", rng.choice([f, f.upper(), f"\t{f} "]), t, None, "clash", "clash"))
    return rows + rows[:20] + [("x1", None, 1, None, "", ""), ("x2", "  ", 1, None, "", ""), (None, "plate", 1, None, "", ""), ("x3", "plate", None, None, "", ""), ("p0", "swept", 9, None, "", "")]


def test_samples_match_targets(spark):
    rng = random.Random(2)
    rows = corpus(rng, 900)
    targets = [("a", "a1", "Plate ", None, 0.2, None, ""), ("a", "a2", "gear", None, 0.4, 3, ""), ("a", "a3", None, 0, 0.5, 0, ""), ("a", "a4", "swept", None, None, 1, ""), ("a", "a5", "swept", None, 0.0, 2, ""),
               ("b", "b1", None, None, 1.0, 2000, ""), ("c", "c1", "plate", 2, 0.5, None, ""), ("c", "c2", "bracket", 9, 0.1, None, "")]
    plans = [("a", 120, ""), ("b", 5000, ""), ("c", None, ""), ("unused", 7, "")]
    sample = sample_to_targets(spark.createDataFrame(rows, MANIFEST).repartition(4), spark.createDataFrame(plans, PLANS), spark.createDataFrame(targets, TARGETS))
    report = {r.category_id: r for r in sample.report.collect()}
    records = sample.records.collect()
    good = {(p, f.strip().lower(), t) for p, f, t, *_ in rows if p and f and f.strip()}
    for p, c, f, t, share, least, _ in targets:
        have = {i for i, g, u in good if (f is None or g == f.strip().lower()) and (t is None or u == t)}
        need = max(least or 0, (share or 0) * (dict((x, n) for x, n, _ in plans)[p] or 0))
        r = report[c]
        assert (r.available, r.need, r.unfillable) == (len(have), pytest.approx(need), need > len(have))
    by_plan = Counter(r.plan_id for r in records)
    assert by_plan == {"a": 120, "b": len({i for i, *_ in good})} and len({(r.plan_id, r.part_id) for r in records}) == len(records)
    assert abs(report["a1"].drawn_share - 0.2) < 0.02 and abs(report["a2"].drawn_share - 0.4) < 0.02 and abs(report["a3"].drawn_share - 0.5) < 0.02
    assert report["a4"].drawn == 1 and report["a5"].gap == 1.0 and report["b1"].unfillable and report["c1"].drawn == 0
    again = sample_to_targets(spark.createDataFrame(rows[::-1], MANIFEST).repartition(2), spark.createDataFrame(plans, PLANS), spark.createDataFrame(targets, TARGETS))
    assert sorted(map(tuple, again.records.select("plan_id", "part_id").collect())) == sorted((r.plan_id, r.part_id) for r in records)


def test_returned_records_are_those_the_keys_drew(spark):
    rng = random.Random(11)
    rows = [(f"p{i}", rng.choice(["plate"] * 6 + ["gear", "bracket"]), rng.randint(0, 2), None, "", "") for i in range(1500)]
    targets = [("a", "a1", "plate", None, 0.3, None, ""), ("a", "a2", "gear", None, 0.4, 3, ""), ("a", "a3", None, 0, 0.5, 0, ""), ("a", "a4", "bracket", 2, None, 40, ""), ("a", "a5", "gear", 1, 0.0, 4000, "")]
    manifest, plans = spark.createDataFrame(rows, MANIFEST).repartition(3), spark.createDataFrame([("a", 300, "")], PLANS)
    sample = sample_to_targets(manifest, plans, spark.createDataFrame(targets, TARGETS))
    got = {(r.family or sampling.OTHER_FAMILY, sampling.OTHER_TIER if r.tier is None else r.tier, r.part_id) for r in sample.records.collect()}
    cats = [Category(c, f, t, s or 0.0, m or 0, max(m or 0.0, (s or 0) * 300)) for _, c, f, t, s, m, _ in targets]
    cell = {i: (f, t) for i, f, t, *_ in rows}
    cells = Counter(cell.values())
    rate = {x: w / cells[x] for x, w in rake(cells, cats).items()}
    u = {r.part_id: r.u for r in manifest.withColumn("plan_id", F.lit("a")).select("part_id", sampling._key_uniform(0).alias("u")).collect()}
    drew = sorted(cell, key=lambda i: -math.log(u[i]) / max(rate[cell[i]], 1e-300))[:300]
    drawn = Counter(cell[i] for i in drew)
    take = repair(drawn, cells, rake(cells, cats), cats, 300)
    stayed = sum(min(drawn[x], k) for x, k in take.items())
    assert (len(got), len({i for *_, i in got} & set(drew))) == (300, stayed) and stayed > 180
    report = {r.category_id: r for r in sample.report.collect()}
    assert report["a5"].cause == "manifest" and report["a5"].gap > 0 and report["a2"].cause is None


def test_causes_of_gaps(spark):
    rows = [(f"p{i}", "plate" if i % 2 else "gear", i % 3, None, "", "") for i in range(400)]
    targets = [("over", "o1", "plate", None, 0.9, 0, ""), ("over", "o2", "gear", None, 0.6, 0, ""), ("odd", "m1", "plate", None, 0.5, 0, ""), ("odd", "m2", "plate", 1, 0.9, 0, ""), ("round", "r1", "plate", None, 0.333, 0, "")]
    report = {r.category_id: r for r in sample_to_targets(spark.createDataFrame(rows, MANIFEST), spark.createDataFrame([("over", 100, ""), ("odd", 60, ""), ("round", 100, "")], PLANS), spark.createDataFrame(targets, TARGETS)).report.collect()}
    assert report["o1"].cause == report["o2"].cause == "plan" and report["r1"].cause in ("rounding", None)
    assert report["m2"].cause in ("margins", None) and all((r.gap > 0) == (r.cause is not None) for r in report.values())


def test_empty_tables(spark):
    m, p, t = spark.createDataFrame(corpus(random.Random(3), 30), MANIFEST), spark.createDataFrame([("a", 5, "")], PLANS), spark.createDataFrame([("a", "a1", "plate", None, 1.0, 1, "")], TARGETS)
    for args in ((m.limit(0), p, t), (m, p.limit(0), t), (m, p, t.limit(0))):
        s = sample_to_targets(*args)
        assert s.records.count() == (0 if args[1] is p else s.records.count()) and s.report.count() == args[2].count()
    assert sample_to_targets(m.limit(0), p, t).report.first().unfillable
