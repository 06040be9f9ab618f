import random
from collections import Counter

import pytest
import regex

from gneiss.llm.packing import best_fit, pack_texts, plan_containers, reduce_by_dominance

TOKENS = regex.compile(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\p{Z}\p{C}]")


def least_bins(items, c):
    """The optimum of a small instance, by branch and bound."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in sorted(set(range(len(bins))), key=lambda k: bins[k]):
            if bins[k] >= items[i] and bins[k] not in bins[:k]:
                go(i + 1, [*bins[:k], bins[k] - items[i], *bins[k + 1 :]])
        go(i + 1, [*bins, c - items[i]])

    go(0, [])
    return best[0] if items else 0


@pytest.mark.parametrize("seed", range(40))
def test_reduction_keeps_an_optimum(seed):
    rng = random.Random(seed)
    c = rng.choice([10, 20, 50])
    items = [rng.randint(1, c) for _ in range(rng.randint(0, 10))]
    fixed, left = reduce_by_dominance(Counter(items), c)
    contents = [s for content, k in fixed for s in content * k] + list(Counter(left).elements())
    assert sorted(contents) == sorted(items) and all(sum(content) <= c for content, _ in fixed)
    assert sum(k for _, k in fixed) + least_bins(list(Counter(left).elements()), c) == least_bins(items, c)


def plain_best_fit(items, c):
    bins = []
    for s in sorted(items, reverse=True):
        fits = [k for k, room in enumerate(bins) if room >= s]
        if fits:
            bins[min(fits, key=lambda k: bins[k])] -= s
        else:
            bins.append(c - s)
    return Counter(bins)


@pytest.mark.parametrize("seed", range(30))
def test_best_fit_on_counts_equals_best_fit_on_items(seed):
    rng = random.Random(seed)
    c = rng.choice([7, 30, 100])
    items = [rng.randint(1, c) for _ in range(rng.randint(0, 200))]
    found = best_fit(Counter(items), c)
    assert Counter({}) + sum((Counter({c - sum(content): k}) for content, k in found), Counter()) == plain_best_fit(items, c)


def test_plan_bounds():
    with pytest.raises(ValueError):
        plan_containers({5: 1}, 4)
    assert plan_containers({}, 4) == ({}, 0)


PACKS = "pack_id string, capacity long, doc_id string, text int"
DOCS = "doc_id long, text string, tokens string, capacity string"


@pytest.mark.parametrize("slice_rows", [3, 50_000])
def test_texts_are_packed_whole(spark, slice_rows):
    rng = random.Random(9)
    texts = [None, "", " \n", "a", "a" * 10_000, "word " * 95, "— Ø x_y", "é"] + [" ".join(rng.choices(["ab", "c,", "(d)"], k=rng.randint(1, 60))) for _ in range(200)] + ["same text here"] * 40
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(texts)] + [(3, "a", "x", "x")], DOCS).repartition(4)
    packs = spark.createDataFrame([("s", 20, "x", 1), ("m", 64, "x", 1), ("none", None, "x", 1), ("zero", 0, "x", 1)], PACKS)
    got = pack_texts(docs, packs, slice_rows=slice_rows).collect()
    sizes = {i: len(TOKENS.findall(t or "")) for i, t in enumerate(texts)}
    for pack, c in (("s", 20), ("m", 64)):
        rows = [r for r in got if r.pack_id == pack]
        fill = Counter()
        for r in rows:
            fill[r.bin_no] += r.tokens
        assert max(fill.values()) <= c and sorted(fill) == list(range(len(fill)))
        for i, n in sizes.items():
            mine = sorted((r.piece_no, r.first_token, r.tokens) for r in rows if r.doc_id == i)
            want = [(k, k * c, min(c, n - k * c)) for k in range(-(-n // c))]
            assert mine == (sorted(want * 2) if i == 3 else want)
        assert len(fill) <= -(-sum(fill.values()) // c) * 1.1 + 1
    assert {r.pack_id for r in got} == {"s", "m"}


def test_no_texts_or_no_packs(spark):
    docs, packs = spark.createDataFrame([(1, "a", "", "")], DOCS), spark.createDataFrame([("s", 20, "x", 1)], PACKS)
    assert pack_texts(docs.limit(0), packs).count() == 0 and pack_texts(docs, packs.limit(0)).count() == 0
    assert [tuple(r) for r in pack_texts(docs, packs).collect()] == [("s", 0, 1, 0, 0, 1)]
