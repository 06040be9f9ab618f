import random

import numpy as np
import pytest

from gneiss.llm import leakage
from gneiss.llm.leakage import BlockIndex, leaked_windows, simhash_windows, words_of

ITEMS = "item_id long, passage string, doc_id string, text int"
DOCS = "doc_id long, text string, item_id string, passage int"


def brute(items, docs, n=12):
    out = set()
    for i, p, *_ in items:
        w = words_of(p)
        runs = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
        for d, t, *_ in docs:
            x = words_of(t)
            if i is not None and d is not None and any(tuple(x[k : k + n]) in runs for k in range(len(x) - n + 1)):
                out.add((i, d))
    return out


def frames(spark, items, docs):
    return spark.createDataFrame([(i, p, "clash", 1) for i, p in items], ITEMS), spark.createDataFrame([(d, t, "clash", 1) for d, t in docs], DOCS)


def test_words():
    assert words_of("A­b_c ﬁne １２.5 Straße​ É") == ["ab", "c", "fine", "12", "5", "strasse", "é"]
    assert words_of(None) == words_of("") == words_of("_ .") == []


def test_exact_runs_equal_brute_force(spark):
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(60)]
    passages = [" ".join(rng.choices(vocab, k=rng.randint(0, 40))) for _ in range(30)]
    items = [*enumerate(passages), (100, None), (101, ""), (102, "too short to leak"), (3, passages[7]), (None, passages[8])]
    docs = []
    for d in range(120):
        words = rng.choices(vocab, k=rng.randint(0, 80))
        if d % 2:
            p = rng.choice(passages).split()
            a = rng.randint(0, max(0, len(p) - 1))
            piece = p[a : a + rng.randint(5, 20)]
            if d % 4 == 1 and len(piece) > 6:
                piece.insert(rng.randint(1, len(piece) - 1), "x")
            at = rng.randint(0, len(words))
            words[at:at] = piece
        docs.append((d, (", " if d % 3 else "\n> ").join(w.upper() if d % 5 == 0 else w for w in words)))
    docs += [(200, None), (201, ""), (5, docs[1][1]), (None, passages[0]), (202, passages[0]), (202, passages[0])]
    i, d = frames(spark, items, docs)
    got = leaked_windows(i, d.repartition(3)).where("run_words >= 12").collect()
    assert {(r.item_id, r.doc_id) for r in got} == brute(items, docs) and len(got) == len(brute(items, docs))
    assert all(r.run_words >= 12 and r.similarity == 1.0 for r in got)


def test_items_in_blocks_and_a_very_long_text(spark):
    rng = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(30))
    long = " ".join(f"q{rng.randint(0, 999)}" for _ in range(450_000))
    cut = long.find(" ", long.rfind(" ", 0, len(long) // 2 + 10))
    long = long[:cut] + " " + passage + long[cut:]
    items, docs = frames(spark, [(1, passage), (2, "other " * 20)], [(1, long), (2, long[-1000:])])
    for mb in (256, 1e-3):
        assert [(r.item_id, r.doc_id) for r in leaked_windows(items, docs, index_mb=mb).collect()] == [(1, 1)]
    assert leaked_windows(items, docs).first().run_words == 30


def test_similar_windows_are_reported(spark):
    p = " ".join(f"word{i}" for i in range(40))
    near = p.split()
    near[20] = "changed"
    items, docs = frames(spark, [(1, p)], [(1, " ".join(near[14:27])), (2, " ".join(near[15:27])), (3, "unrelated " * 30)])
    assert leaked_windows(items, docs).where('run_words > 0').count() == 0
    got = {r.doc_id: r for r in leaked_windows(items, docs, radius=20, threshold=0.2).collect()}
    assert set(got) == {1, 2} and all(r.run_words == 0 and 0.2 <= r.similarity < 1 for r in got.values())


def test_blocks_of_items_do_not_change_the_result(spark):
    rng = random.Random(5)
    passages = [[f"v{rng.randint(0, 50)}" for _ in range(25)] for _ in range(20)]
    docs = []
    for d, p in enumerate(passages * 2):
        q = list(p)
        q[rng.randint(0, 24)] = "other"
        docs.append((d, " ".join(q)))
    items, texts = frames(spark, [(i, " ".join(p)) for i, p in enumerate(passages)], docs)
    whole = sorted(map(tuple, leaked_windows(items, texts, radius=12, threshold=0.3).collect()))
    assert len(whole) >= 40 and sorted(map(tuple, leaked_windows(items, texts, radius=12, threshold=0.3, index_mb=0.05).collect())) == whole


def test_empty_tables(spark):
    items, docs = frames(spark, [(1, "a " * 20)], [(1, "a " * 20)])
    assert leaked_windows(items.limit(0), docs).count() == 0 and leaked_windows(items, docs.limit(0)).count() == 0
    assert leaked_windows(items, docs).count() == 1


@pytest.mark.parametrize("radius", [0, 3, 7])
def test_block_index_finds_all_within_the_radius(radius):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 50, np.int64).astype(np.uint64)
    flips = rng.integers(0, 64, (400, 9))
    queries = base[rng.integers(0, 50, 400)]
    for k in range(9):
        queries = np.where(rng.random(400) < 0.5, queries ^ (np.uint64(1) << flips[:, k].astype(np.uint64)), queries)
    q, e = BlockIndex(base, radius).within(queries)
    want = {(i, j) for i in range(400) for j in range(50) if int(queries[i] ^ base[j]).bit_count() <= radius}
    assert set(zip(q.tolist(), e.tolist())) == want and len(q) == len(want)


def test_simhash_of_equal_windows_is_equal():
    ids = np.random.default_rng(4).integers(0, 1 << 63, 30, np.int64).astype(np.uint64)
    twice = np.concatenate([ids, ids])
    h = simhash_windows(twice, np.ones(60, np.uint8), 12)
    assert (h[:19] == h[30:49]).all() and len(h) == 49


def shingled(words, weights, number):
    ids = np.array([number.setdefault(w, len(number)) for w in words])
    sh = leakage.shingles_of(ids)
    return sh, leakage._sums(np.array([weights.get(w, 1.0) for w in words]), 5) if len(sh) else np.zeros(0), leakage.met_before(sh)


def brute_similarity(a, b, weights):
    x, y = ({tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (a, b))
    total = lambda s: sum(sum(weights.get(w, 1.0) for w in t) for t in s)
    return total(x & y) / total(x | y) if x or y else 0.0


def test_shingles():
    rng = random.Random(6)
    number = {}
    for k in range(200):
        weights = {w: rng.uniform(1, 6) for w in "abcdef"}
        a = rng.choices("abcdef"[: rng.randint(1, 6)], k=rng.randint(12, 30))
        b = list(a)
        for _ in range(rng.randint(0, 2)):
            b[rng.randrange(len(b))] = rng.choice("abcdef")
        got = leakage.shingle_similarity(shingled(a, weights, number), np.array([0]), shingled(b, weights, number), np.array([0]), len(a) - 4)
        assert got[0] == pytest.approx(brute_similarity(a, b, weights))


def test_recall_of_near_windows_with_default_arguments(spark):
    """Planted windows with one edited word at an end, and whole passages with two edits: what is similar by brute force is found."""
    rng = random.Random(7)
    vocab = [f"v{int(abs(rng.gauss(0, 80)))}" for _ in range(600)]
    passages = {i: rng.choices(vocab, k=rng.randint(66, 120)) for i in range(40)}
    docs, planted = [], []
    for i, p in passages.items():
        for k in range(9):
            a = rng.randrange(len(p) - 12)
            x = p[a : a + 12] if k < 8 else list(p)
            for _ in range(1 if k < 8 else 2):
                x[rng.choice([0, 11]) if k < 8 else rng.randrange(len(x))] = rng.choice([rng.choice(vocab), f"new{k}"])
            planted.append((len(docs), i, x))
            docs.append((len(docs), " ".join(x)))
    n = {w: sum(w in p for p in passages.values()) for p in passages.values() for w in p}
    weights = {w: 1 + float(np.log(40 / c)) for w, c in n.items()}
    want = set()
    for d, i, x in planted:
        for size in {12, len(passages[i]) // 32 * 32}:
            p = passages[i]
            if any(brute_similarity(x[s : s + size], p[t : t + size], weights) >= 0.8 for s in range(len(x) - size + 1) for t in range(len(p) - size + 1) if size == 12 or abs(s - t) < 6):
                want.add((i, d))
    items, texts = frames(spark, [(i, " ".join(p)) for i, p in passages.items()], docs)
    rows = leaked_windows(items, texts).collect()
    got = {(r.item_id, r.doc_id) for r in rows}
    near = {(i, d) for i, d in want if (i, d) not in brute([(i, " ".join(p)) for i, p in passages.items()], docs)}
    assert len(near) > 40 and len(near & got) >= 0.9 * len(near) and len(want & got) >= 0.95 * len(want)
    assert all(r.similarity >= 0.8 for r in rows) and any(r.run_words == 0 for r in rows)
