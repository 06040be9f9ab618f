import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from gneiss.llm.subjects import SubjectModel, _labelled, factorise, fit_subjects, main_subjects, sentences_of, subject_sentences

WORDS = {"gears": "pinion tooth mesh backlash sprocket involute".split(), "law": "court clause licence statute waiver royalty".split(), "sport": "rider saddle racket trail goal paddle".split()}
GENERAL = ["the drawing is on the shelf", "thanks for the quick answer", "the saddle block is mm wide", "we made more of these last year", "see the card for the other dimensions"]
DOCS = "doc_id long, text string, subject_id string, labels int"
LABELS = "doc_id long, subject_id string, text string"


def sentence(rng, s):
    a, b = rng.sample(WORDS[s], 2)
    return rng.choice([f"nobody likes a {a} next to a {b}", f"the {a} arrived late and the {b} had to be checked", f"it took long until {a} and {b} agreed"])


def corpus(n, seed=1):
    rng = random.Random(seed)
    docs, truth = [], {}
    for i in range(n):
        main = rng.sample(list(WORDS), rng.choice([0, 1, 1, 1, 1, 2]))
        counts = {s: rng.randint(4, 9) for s in main}
        said = [sentence(rng, s) for s in main for _ in range(counts[s])]
        if main and rng.random() < 0.3:
            said.append(sentence(rng, rng.choice([s for s in WORDS if s not in main])))
        said += rng.choices(GENERAL, k=rng.randint(1, 6))
        rng.shuffle(said)
        joiner = rng.choice([". ", ".\n", "</p>\n<p>", "\n- "])
        docs.append((i, joiner.join(x.capitalize() for x in said) + ".", "clash", 1))
        truth[i] = set(main)
    return docs, truth, rng


def labelled(truth, rng):
    out = []
    for i, s in truth.items():
        if rng.random() < 0.6 and s:
            out.append((i, rng.choice([x := rng.choice(sorted(s)), x.upper(), f" {x} "]) if rng.random() > 0.05 else rng.choice(list(WORDS)), "clash"))
    return out + out[:20] + [(3, None, ""), (4, "astrology", ""), (None, "law", ""), (10**9, "law", "")]


SUBJECTS = [(s, s.title()) for s in WORDS] + [(None, "none")]


@pytest.fixture(scope="module")
def fitted(spark):
    docs, truth, rng = corpus(500)
    d = spark.createDataFrame(docs, DOCS).repartition(4)
    return d, truth, fit_subjects(d, spark.createDataFrame(labelled(truth, rng), LABELS), spark.createDataFrame(SUBJECTS, "subject_id string, title string"))


def test_held_out_documents(spark, fitted):
    _, _, model = fitted
    docs, truth, _ = corpus(400, seed=2)
    mixture = subject_sentences(spark.createDataFrame(docs, DOCS).repartition(3), model)
    found = {i: set() for i in truth}
    for r in main_subjects(mixture).collect():
        found[r.doc_id].add(r.subject_id)
    right = sum(found[i] == truth[i] for i in truth)
    assert right >= 0.98 * len(truth)
    assert all(abs(sum(r.share for r in mixture.where(f"doc_id = {i}").collect()) - 1) < 1e-9 for i, s in truth.items() if s and i < 3)


def test_anchored_terms_belong_to_their_subject(fitted):
    _, _, model = fitted
    own = {w: s for s, words in WORDS.items() for w in words}
    assert all(model.subjects[int(h.argmax())] == own[w] for w, h in model.loading.items()) and len(model.loading) >= 14
    assert "the" not in model.loading and "drawing" not in model.loading


def test_odd_texts(spark, fitted):
    _, _, model = fitted
    law = "The court and the clause agreed"
    odd = [(1, None, "", 1), (2, "", "", 1), (3, "   \n<p></p>", "", 1), (None, law, "", 1), (4, law, "", 1), (4, law, "", 1), (5, (law + ". ") * 20_000, "", 1), (6, "12 34", "", 1), (7, "co​urt statute", "", 1)]
    got = {r.doc_id: (r.subject_id, r.sentences) for r in subject_sentences(spark.createDataFrame(odd, DOCS), model).collect()}
    assert got == {4: ("law", 2), 5: ("law", 20_000), 7: ("law", 1)}


def test_without_labels_subjects_or_documents(spark, fitted):
    d, _, model = fitted
    labels, subjects = spark.createDataFrame([(1, "law", "")], LABELS), spark.createDataFrame(SUBJECTS, "subject_id string, title string")
    for args in ((d, labels.limit(0), subjects), (d, labels, subjects.limit(0)), (d.limit(0), labels, subjects), (d, labels, subjects)):
        empty = fit_subjects(*args)
        assert not empty.loading and subject_sentences(d, empty).count() == 0
    assert subject_sentences(d.limit(0), model).count() == 0


def test_two_subjects_at_most_and_ties_by_name(spark):
    rows = [(1, "b", 2, 0.34), (1, "a", 2, 0.33), (1, "c", 2, 0.33), (2, "a", 3, 0.75), (2, "b", 1, 0.25), (3, "a", 4, 0.8), (3, "b", 1, 0.2)]
    got = main_subjects(spark.createDataFrame(rows, "doc_id long, subject_id string, sentences long, share double"))
    assert sorted(map(tuple, got.collect())) == [(1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "a")]


def test_sentences():
    assert sentences_of("A b. C 1.5 d!\n\n- E<br>f? g") == [["a", "b"], ["c", "d"], ["e"], ["f"], ["g"]]
    assert sentences_of(None) == sentences_of("") == sentences_of("12 . ") == []


def test_factors_explain_the_matrix_and_keep_zeros():
    rng = np.random.default_rng(3)
    h = np.array([[5, 4, 3, 0, 0, 1], [0, 0, 0, 6, 5, 1], [1, 0, 0, 0, 1, 9]], float)
    w = np.zeros((400, 3))
    w[np.arange(400), rng.integers(0, 2, 400)] = rng.uniform(0.3, 0.9, 400)
    w[:, 2] = 1 - w.sum(1)
    v = rng.poisson(w @ h * 3)
    docs, terms = np.nonzero(v)
    seeds = (w > 0).astype(float)
    uses, mixtures = factorise(docs, terms, v[docs, terms].astype(float), seeds, 6, rounds=20, block=500)
    again, _ = factorise(docs, terms, v[docs, terms].astype(float), seeds, 6, rounds=20)
    assert np.allclose(uses, again) and (mixtures[seeds == 0] == 0).all()
    assert np.allclose(uses.sum(), v.sum()) and np.allclose(mixtures.sum(1), v.sum(1))
    explained = uses / uses.sum(0)
    assert (explained[0, 1:3] > 0.9).all() and explained[1, 3] > 0.9 and explained[2, 5] > 0.7


def right(spark, model):
    docs, truth, _ = corpus(400, seed=2)
    found = {i: set() for i in truth}
    for r in main_subjects(subject_sentences(spark.createDataFrame(docs, DOCS).repartition(3), model)).collect():
        found[r.doc_id].add(r.subject_id)
    return sum(found[i] == truth[i] for i in truth) / len(truth)


def test_loadings_decide(spark, fitted):
    """With every loading replaced by one, or by equal parts, hardly a document that has a subject is right."""
    _, _, model = fitted
    for flat in (1.0, 1 / len(WORDS)):
        same = SubjectModel(model.subjects, {t: np.full(len(WORDS), flat) for t in model.loading}, model.general, model.enough)
        assert right(spark, same) < 0.5
    assert right(spark, model) >= 0.98


def test_sample_is_the_smallest_hashes(spark, fitted):
    d, truth, _ = fitted
    labels = spark.createDataFrame([(i, "law", "") for i in truth], LABELS)
    subjects = spark.createDataFrame(SUBJECTS, "subject_id string, title string")
    rows, _ = _labelled(d, labels, subjects, 60, "doc_id", "text")
    want = [r.doc_id for r in d.select("doc_id").orderBy(F.xxhash64("doc_id")).limit(60).collect()]
    assert sorted(r.doc_id for r in rows.collect()) == sorted(want)
