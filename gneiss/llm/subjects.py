"""Subject areas of documents by seeded non-negative factorisation of the document-term matrix.

The matrix of labelled documents and all their terms is factored into one component per subject and one for what is said in any document. Labels
anchor the components: a document's mixture starts with its subjects and the common component, and what starts at 0 stays 0 under multiplicative updates. The
loadings so fitted tell of each term which part of its use each component explains. A sentence is folded into these: what falls to its
strongest subject must be `enough`. A document's mixture is the share of its sentences that speak of each subject.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gneiss.llm.leakage import _format_characters
from gneiss.session import written

_WORD = re.compile(r"[^\W\d_]+")
_TAG = re.compile(r"<[^<>]*>")
_END = re.compile(r"(?<=[.!?…。])\s+|\n+")


def sentences_of(text: str | None) -> list[list[str]]:
    """The words of each sentence: mark-up and line breaks end a sentence as stops do; digits are no words; [] for null or empty."""
    if not text:
        return []
    if not text.isascii():
        text = _format_characters().sub("", unicodedata.normalize("NFKC", text))
    if "<" in text:
        text = _TAG.sub("\n", text)
    return [w for s in _END.split(text.casefold()) if (w := _WORD.findall(s))]


@dataclass
class SubjectModel:
    """subjects in order; for each term the part of its use that each subject's component explains; pairs of words that are general."""

    subjects: list[str]
    loading: dict[str, np.ndarray]
    general: set[tuple[str, str]]
    enough: float
    seen: dict[tuple[str, ...], int] = field(default_factory=dict, repr=False)

    def terms(self, words: list[str]) -> tuple[str, ...]:
        """A sentence's terms with loadings, less those that stand in a pair known to be general."""
        have = self.loading
        if have.keys().isdisjoint(words):
            return ()
        return tuple(w for i, w in enumerate(words) if w in have and (i == 0 or (words[i - 1], w) not in self.general) and (i + 1 == len(words) or (w, words[i + 1]) not in self.general))

    def subject(self, words: list[str]) -> int:
        """The subject that a sentence speaks of, -1 if none: its terms' loadings are summed up, and the largest sum must be `enough` (ties: the first)."""
        terms = self.terms(words)
        if not terms:
            return -1
        found = self.seen.get(terms)
        if found is None:
            total = sum(self.loading[t] for t in terms)
            best = int(total.argmax())
            found = best if total[best] >= self.enough else -1
            if len(self.seen) < 200_000:
                self.seen[terms] = found
        return found


def factorise(docs: np.ndarray, terms: np.ndarray, counts: np.ndarray, mixtures: np.ndarray, n_terms: int, rounds: int = 3, block: int = 200_000) -> tuple[np.ndarray, np.ndarray]:
    """(uses, mixtures) after alternating multiplicative updates under Kullback-Leibler loss: how often (components x terms) and in which documents each component is used.

    docs, terms, counts: the entries of the matrix, taken in blocks, so memory stays bounded. mixtures (documents x components) are the seeds; what is 0 stays
    0, which anchors the components. Few rounds are meant: with more, a component takes over words that merely go along with its documents.
    """
    k = mixtures.shape[1]
    loadings, start = None, mixtures
    for _ in range(rounds + 1):
        uses, new = np.zeros((k, n_terms)), np.zeros(mixtures.shape)
        for a in range(0, len(docs), block):
            d, t, c = docs[a : a + block], terms[a : a + block], counts[a : a + block]
            part = mixtures[d] if loadings is None else mixtures[d] * loadings[:, t].T
            part *= (c / np.maximum(part.sum(1), 1e-300))[:, None]
            for s in range(k):
                uses[s] += np.bincount(t, part[:, s], n_terms)
                new[:, s] += np.bincount(d, part[:, s], len(mixtures))
        mixtures = start if loadings is None else new
        loadings = uses / np.maximum(uses.sum(1, keepdims=True), 1e-300)
    return uses, mixtures


def _labelled(docs: DataFrame, labels: DataFrame, subjects: DataFrame, sample_docs: int, doc_id: str, text: str) -> tuple[DataFrame, list[str]]:
    names = sorted({r[0] for r in subjects.select("subject_id").where("subject_id is not null").collect()})
    clean = {n.strip().lower(): i for i, n in enumerate(names)}
    key = F.lower(F.regexp_replace("subject_id", r"(?U)^\s+|\s+$", ""))
    numbers = labels.sparkSession.createDataFrame([(k, i) for k, i in clean.items()], "name string, s int")
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("name")).dropna().join(F.broadcast(numbers), "name")
    per_doc = rows.groupBy("doc_id").agg(F.array_sort(F.collect_set("s")).alias("labels"))
    per_doc = written(per_doc, "doc_labels")
    have = per_doc.count()
    if have > sample_docs:  # no task sends more than its share: only hashes that can be among the smallest are sorted
        part = (sample_docs + 8 * sample_docs**0.5 + 8) / have
        per_doc = per_doc.where(F.xxhash64("doc_id") <= F.lit(min((1 << 63) - 1, int(-(1 << 63) + part * (1 << 64)))))
    sample = per_doc.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("text is not null")
    return texts.join(F.broadcast(written(sample, "labelled")), "doc_id"), names


def _frequent(rows: DataFrame, k: int, least: int) -> dict[str, tuple[int, np.ndarray]]:
    """(documents, documents with each label) of terms in `least` documents or more."""
    counts = rows.groupBy("term").agg(F.sum("n").alias("n"), *(F.sum(F.col("by")[i]).alias(f"s{i}") for i in range(k))).where(F.col("n") >= least)
    return {r["term"]: (r["n"], np.array([r[f"s{i}"] for i in range(k)], float)) for r in counts.toLocalIterator()}


def _plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as lines of words, one sentence a line, so that they are taken apart once."""
    for batch in batches:
        lines = ["\n".join(" ".join(s) for s in sentences_of(x)) for x in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string()), batch.column("labels")], names=["lines", "labels"])


def _lines(text: str) -> list[list[str]]:
    return [s.split(" ") for s in text.split("\n")] if text else []


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by word, summed per batch."""
    for batch in batches:
        found: Counter[str] = Counter()
        for lines in batch.column("lines").to_pylist():
            found.update(set(lines.replace("\n", " ").split(" ")) - {""})
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["term", "n"])


def _count(k: int, terms):
    """Documents by term and label, summed per batch before they are sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter[str] = Counter()
            by: list[Counter[str]] = [Counter() for _ in range(k)]
            for lines, labels in zip(batch.column("lines").to_pylist(), batch.column("labels").to_pylist()):
                own = {t for s in _lines(lines) for t in terms(s)}
                found.update(own)
                for s in labels:
                    by[s].update(own)
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64()), pa.array([[c[t] for c in by] for t in found], pa.list_(pa.int64()))], names=["term", "n", "by"])

    return run


def fit_subjects(docs: DataFrame, labels: DataFrame, subjects: DataFrame, *, sample_docs: int = 40_000, doc_id: str = "doc_id", text: str = "text", enough: float = 0.65, least_docs: int = 6, common: float = 1.0) -> SubjectModel:
    """The model, from at most `sample_docs` labelled documents (those with the smallest hash; whole texts).

    Labels are cleaned of case and blanks; null and unknown ones do not count, doubled ones count once, and of those in conflict each seeds its component. `common` is the seed
    of the common component, to 1 for a label. Terms in fewer than `least_docs` documents of the sample are left out, and of the others those of which no subject explains 0.4 have no loadings.
    A pair of words, one of them with loadings, whose documents' labels are spread (under 0.35 or 1.25 times the label's usual share for each subject) makes its words general there. Without subjects or labels the model has no
    terms. The driver holds the terms and, of the sample, their counts by document.
    """
    rows, names = _labelled(docs, labels, subjects, sample_docs, doc_id, text)
    rows = written(rows.select("text", "labels").mapInArrow(_plain, "lines string, labels array<int>"), "labelled_texts")
    k = len(names)
    sizes = np.zeros(k)
    for r in rows.select(F.explode("labels").alias("s")).groupBy("s").count().collect():
        sizes[r.s] = r["count"]
    total = rows.count()
    if not k or not total:
        return SubjectModel(names, {}, set(), enough)
    found = rows.mapInArrow(_words, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).where(F.col("n") >= least_docs)
    vocabulary = {t: i for i, t in enumerate(sorted(r["term"] for r in found.toLocalIterator()))}
    if not vocabulary:
        return SubjectModel(names, {}, set(), enough)

    def matrix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            per = [Counter(filter(None.__ne__, map(vocabulary.get, x.replace("\n", " ").split(" ")))) for x in batch.column("lines").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([list(c) for c in per], pa.list_(pa.int32())), pa.array([list(c.values()) for c in per], pa.list_(pa.int32())), batch.column("labels")], names=["terms", "counts", "labels"])

    table = rows.mapInArrow(matrix, "terms array<int>, counts array<int>, labels array<int>").toArrow()
    lengths = lambda c: np.diff(table.column(c).combine_chunks().offsets.to_numpy())
    flat = lambda c: table.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    seeds = np.zeros((table.num_rows, k + 1))
    seeds[np.repeat(np.arange(table.num_rows), lengths("labels")), flat("labels")] = 1
    seeds[:, k] = common
    uses, _ = factorise(np.repeat(np.arange(table.num_rows, dtype=np.int32), lengths("terms")), flat("terms"), flat("counts"), seeds, len(vocabulary))
    explained = (uses / np.maximum(uses.sum(0), 1e-300))[:k]
    loading = {t: explained[:, i] for t, i in vocabulary.items() if explained[:, i].max() >= 0.4}

    prior, near = sizes / total, set(loading)
    pairs = _frequent(rows.mapInArrow(_count(k, lambda s: () if near.isdisjoint(s) else (f"{a} {b}" for a, b in zip(s, s[1:]) if a in near or b in near)), "term string, n long, by array<bigint>"), k, least_docs)
    general = {tuple(t.split(" ")) for t, (n, by) in pairs.items() if (by < np.maximum(0.35, 1.25 * prior) * (n + 1)).all()}
    return SubjectModel(names, loading, general, enough)


def subject_sentences(docs: DataFrame, model: SubjectModel, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, subject_id, sentences, share): how many of a text's sentences speak of each subject, and their share of those that speak of any.

    Texts that are null, empty or speak of no subject have no row; texts that share a doc_id are one document; the rows are not shuffled but for such documents.
    """
    plain = (model.subjects, model.loading, model.general, model.enough)  # executors may lack the package, so no class of it is sent
    shared = docs.sparkSession.sparkContext.broadcast(plain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = SubjectModel(*shared.value)
        for batch in batches:
            ids, subjects, counts = [], [], []
            for i, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = Counter(s for words in sentences_of(x) if (s := model.subject(words)) >= 0)
                for s, c in found.items():
                    ids.append(i)
                    subjects.append(model.subjects[s])
                    counts.append(c)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(subjects, pa.string()), pa.array(counts, pa.int64())], names=["doc_id", "subject_id", "sentences"])

    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null and text is not null")
    rows = texts.mapInArrow(run, "doc_id long, subject_id string, sentences long")
    per = rows.groupBy("doc_id", "subject_id").agg(F.sum("sentences").alias("sentences"))
    return per.withColumn("share", F.col("sentences") / F.sum("sentences").over(Window.partitionBy("doc_id")))


def main_subjects(mixture: DataFrame, least: float = 0.25, most: int = 2) -> DataFrame:
    """(doc_id, subject_id): subjects with a share of `least` or more, the `most` largest (ties by name)."""
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("sentences"), "subject_id"))
    return mixture.where(F.col("share") >= least).withColumn("rank", rank).where(F.col("rank") <= most).select("doc_id", "subject_id")
