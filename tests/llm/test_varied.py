import numpy as np
import pytest

from gneiss.llm.varied import Centres, FeatureTree, shape_vectors, summarise, varied_subset, ward

MANIFEST = "part_id string, family string, loaded_at timestamp, geometry_signature struct<volume: double, surface_area: double, principal_moments: array<double>>, group_no int, distance string"


def plain_ward(x, n, k):
    groups = [[i] for i in range(len(x))]
    while len(groups) > k:
        best = None
        for a in range(len(groups)):
            for b in range(a):
                na, nb = n[groups[a]].sum(), n[groups[b]].sum()
                ca, cb = (np.average(x[g], 0, n[g]) for g in (groups[a], groups[b]))
                d = na * nb / (na + nb) * ((ca - cb) ** 2).sum()
                if best is None or d < best[0]:
                    best = (d, a, b)
        _, a, b = best
        groups[b] += groups.pop(a)
    return {frozenset(g) for g in groups}


@pytest.mark.parametrize("seed", range(6))
def test_ward_equals_plain_ward(seed):
    rng = np.random.default_rng(seed)
    x, n = rng.normal(size=(30, 3)), rng.integers(1, 9, 30).astype(float)
    for k in (1, 4, 11, 30):
        got = ward(n, x * n[:, None], k)
        assert {frozenset(np.flatnonzero(got == g)) for g in set(got)} == plain_ward(x, n, k)


def test_features_keep_sums_and_bounds():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(3000, 4)) * 0.01, rng.normal(size=(500, 4)), np.zeros((400, 4))])
    tree = FeatureTree(50)
    for part in np.array_split(x, 7):
        tree.add(np.ones(len(part)), (part**2).sum(1), part)
        assert len(tree.features()[0]) == tree.entries <= 50
    n, ss, ls = tree.features()
    assert n.sum() == len(x) and np.allclose(ls.sum(0), x.sum(0)) and np.isclose(ss.sum(), (x**2).sum())
    assert (ss / n - ((ls / n[:, None]) ** 2).sum(1) <= tree.threshold**2 + 1e-9).all()


def test_summaries_of_nodes_are_those_of_their_leaves():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 3))
    tree = FeatureTree(5000)
    tree.add(np.ones(4000), (x**2).sum(1), x)
    levels = [tree.root]
    while levels:
        node = levels.pop()
        assert 0 < node.size <= FeatureTree.WIDTH
        for i, kid in enumerate(node.kids or []):
            n, ss, ls = kid.total()
            assert np.isclose(node.n[i], n) and np.isclose(node.ss[i], ss) and np.allclose(node.ls[i], ls)
            levels.append(kid)
    assert tree.entries == 4000 == tree.root.total()[0]


def corpus(rng, sizes):
    centres = rng.uniform(2, 20, (len(sizes), 5))
    rows = []
    for g, n in enumerate(sizes):
        for i in range(n):
            v = np.exp(centres[g] + rng.normal(size=5) * 0.01)
            rows.append((f"g{g}_{i}", "plate", None, (float(v[0]), float(v[1]), [float(a) for a in v[2:]]), 1, "clash"))
    return rows


@pytest.mark.parametrize("entries", [None, 60])
def test_large_groups_are_not_over_represented(spark, entries):
    rng = np.random.default_rng(2)
    sizes = [900, 5, 5, 200, 5, 5, 5, 5, 60, 5]
    rows = corpus(rng, sizes)
    rows += rows[:50] + [("bad1", "plate", None, None, 1, ""), ("bad2", "plate", None, (1.0, None, [1.0, 2.0, 3.0]), 1, ""), ("bad3", "x", None, (1.0, 1.0, [1.0, 2.0]), 1, ""), ("bad4", "x", None, (0.0, 1.0, [1.0, 2.0, 3.0]), 1, ""), ("bad5", None, None, (1.0, 1.0, None), 1, ""), (None, "plate", None, rows[0][3], 1, "")]
    got = varied_subset(spark.createDataFrame(rows, MANIFEST).repartition(5), 10, entries=entries).collect()
    assert sorted(r.part_id.split("_")[0] for r in got) == [f"g{i}" for i in range(10)]
    assert sorted(r.group_records for r in got) == sorted(sizes) and len({r.part_id for r in got}) == 10


@pytest.mark.parametrize("entries,size", [(None, 15), (60, 40), (20, 30)])
def test_crowds_do_not_cut_the_subset_short(spark, entries, size):
    rows = corpus(np.random.default_rng(2), [900, 5, 5, 200, 5, 5, 5, 5, 60, 5])
    got = varied_subset(spark.createDataFrame(rows, MANIFEST).repartition(5), size, entries=entries).collect()
    assert len(got) == len({r.part_id for r in got}) == size and sum(r.group_records for r in got) == len(rows)
    assert {r.part_id.split("_")[0] for r in got} == {f"g{i}" for i in range(10)}


def test_vectors_that_differ_by_rounding_fill_the_subset(spark):
    rows = [(str(i), "f", None, (2.0 + 1e-12 * i, 3.0, [1.0, 2.0, 3.0]), 1, "") for i in range(6)] + [("z", "f", None, (9.0, 3.0, [1.0, 2.0, 3.0]), 1, "")]
    df = spark.createDataFrame(rows + rows[:3], MANIFEST)
    assert len({r.part_id for r in varied_subset(df, 5).collect()}) == 5 and varied_subset(df, 20).count() == 7


@pytest.mark.parametrize("most,least", [(50, 50), (60, 45), (200, 10), (2, 2)])
def test_rebuilds_keep_the_least_number_of_entries(most, least):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(600, 4)) * 1e-4, np.ones((100, 4)), rng.normal(size=(20, 4)), np.eye(4)])
    rng.shuffle(x)
    tree = FeatureTree(most, least=least)
    tree.add(np.ones(len(x)), (x**2).sum(1), x)
    assert least <= tree.entries == len(tree.features()[0]) <= most and tree.features()[0].sum() == len(x)


def test_fewer_records_than_wanted_ties_and_nothing(spark):
    same = (2.0, 3.0, [1.0, 2.0, 3.0])
    df = spark.createDataFrame([("b", "f", None, same, 1, ""), ("a", "f", None, same, 1, ""), ("c", "f", None, (9.0, 3.0, [3.0, 2.0, 1.0]), 1, "")], MANIFEST)
    got = {r.part_id: r.group_records for r in varied_subset(df, 10).collect()}
    assert got == {"a": 2, "c": 1}
    assert varied_subset(df, 0).count() == 0 and varied_subset(df.limit(0), 5).count() == 0
    assert [r.part_id for r in varied_subset(df, 1).collect()] == ["a"]
    assert shape_vectors(df).count() == 3


def test_summaries_are_merged_in_rounds(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(str(i), [float(v) for v in rng.normal(size=3)]) for i in range(900)], "id string, x array<double>").repartition(20)
    n, ls = summarise(df, 40)
    assert n.sum() == 900 and len(n) <= 40 and ls.shape[1] == 3


def test_cells_find_the_nearest_centre():
    rng = np.random.default_rng(12)
    centres = np.concatenate([rng.normal(size=(900, 11)), rng.normal(0, 0.01, (100, 11)), np.ones((2, 11))])
    x = np.concatenate([rng.normal(size=(3000, 11)), centres[::7], np.ones((1, 11))])
    found, square = Centres(centres).nearest(x)
    full = ((x[:, None, :] - centres[None, :, :]) ** 2).sum(2)
    assert np.allclose(square, full.min(1), atol=1e-9) and np.allclose(full[np.arange(len(x)), found], full.min(1), atol=1e-9)
    assert found[-1] == 1000
