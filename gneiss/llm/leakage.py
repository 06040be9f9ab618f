"""Evaluation texts leaking into training text.

Items are cut into windows of `window` words, the size of the shortest passage that counts as leaked, and into windows of about their own
size. Every window of a text is compared with those of its size by 64-bit weighted SimHashes in a multi-index of Hamming blocks: fingerprints are cut into blocks, and
two fingerprints within the radius are within `PER_BLOCK` bits in at least one of them (pigeonhole), so none is missed. Candidates are verified on
the words themselves by weighted-shingle similarity. Before that, windows go that cannot reach the threshold, since too many of their
shingles have words that no item has.
"""

from __future__ import annotations

import itertools
import math
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.session import written

WORD = re.compile(r"[^\W_]+")
_FORMAT: list[re.Pattern] = []
HITS = "item_id long, doc_id long, run_words int, similarity double, hamming int, window int, doc_word int, item_word int"


def _format_characters() -> re.Pattern:
    """Runs of characters of Unicode category Cf; a class of ranges is matched far faster than one of single characters."""
    if not _FORMAT:
        codes = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Cf"]
        starts = [c for c, before in zip(codes, [-1, *codes]) if c != before + 1]
        ends = [c for c, after in zip(codes, [*codes[1:], -1]) if c + 1 != after]
        _FORMAT.append(re.compile("[" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in zip(starts, ends)) + "]+"))
    return _FORMAT[0]


def words_of(text: str | None) -> list[str]:
    """Runs of letters and digits after NFKC, removal of format characters and case folding; [] for null or empty."""
    if not text:
        return []
    if not text.isascii():
        text = _format_characters().sub("", unicodedata.normalize("NFKC", text))
    return WORD.findall(text.casefold())


#: Bits in which a block may differ, for radii of more than twice as many bits.
PER_BLOCK = 2
#: Item-sized windows have a multiple of so many words.
STEP = 32
SHINGLE = 5
_MIX = np.array([xxhash.xxh64_intdigest(bytes([k])) | 1 for k in range(SHINGLE)], np.uint64)


def _sums(x: np.ndarray, window: int) -> np.ndarray:
    """Sums over every run of `window` rows, put together from sums over runs of 1, 2, 4, ... rows."""
    n, at, width, total = len(x) - window + 1, 0, 1, None
    while width <= window:
        if window & width:
            part = x[at : at + n]
            total = part.copy() if total is None else np.add(total, part, out=total)
            at += width
        x = x[:-width] + x[width:]
        width *= 2
    return total


def simhash_windows(hashes: np.ndarray, weights: np.ndarray, window: int) -> np.ndarray:
    """64-bit SimHash of every run of `window` words: bit by bit, the weighted majority of the words' hashes (ties give 0). Weights are small whole numbers."""
    kind = np.uint8 if int(weights.max(initial=0)) * window < 256 else np.uint32
    weights = weights.astype(kind)
    bits = np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8), axis=1) * weights[:, None]
    return np.packbits(_sums(bits, window) > (_sums(weights, window) >> 1)[:, None], axis=1).view(np.uint64).ravel()


class BlockIndex:
    """Multi-index over fingerprints: for each block of bits, the fingerprints by all values at most `per` bits from the block's own."""

    def __init__(self, prints: np.ndarray, radius: int):
        self.prints, self.radius = prints, radius
        self.per = PER_BLOCK if radius > 2 * PER_BLOCK else 0
        edges = np.linspace(0, 64, radius // (self.per + 1) + 2).astype(int)
        self.blocks = []
        for lo, hi in zip(edges.tolist(), edges[1:].tolist()):
            width = hi - lo
            masks = np.array([sum(1 << b for b in c) for n in range(min(self.per, width) + 1) for c in itertools.combinations(range(width), n)], np.uint64)
            values = (self._cut(prints, lo, hi)[:, None] ^ masks).ravel()
            order = np.argsort(values.astype(np.uint16) if width <= 16 else values, kind="stable")
            starts = np.r_[0, np.cumsum(np.bincount(values.astype(np.int64), minlength=1 << width))] if width <= 20 else None
            self.blocks.append((lo, hi, values[order] if starts is None else None, (order // len(masks)).astype(np.int32), starts))

    @staticmethod
    def _cut(prints: np.ndarray, lo: int, hi: int) -> np.ndarray:
        return (prints >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)

    def within(self, queries: np.ndarray, most: int = 2_000_000) -> tuple[np.ndarray, np.ndarray]:
        """(query, entry) index pairs, once each, of all fingerprints at most `radius` bits apart; about `most` candidates are held at a time."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for k, (lo, hi, values, order, starts) in enumerate(self.blocks):
            cut = self._cut(queries, lo, hi)
            if starts is None:
                first, last = np.searchsorted(values, cut, "left"), np.searchsorted(values, cut, "right")
            else:
                cut = cut.astype(np.int64)
                first, last = starts[cut], starts[cut + 1]
            held = np.cumsum(last - first) // most
            for part in np.split(np.arange(len(queries)), np.flatnonzero(np.diff(held)) + 1):
                count = (last - first)[part]
                q = np.repeat(part, count)
                e = order[np.repeat(first[part] - (np.cumsum(count) - count), count) + np.arange(len(q))]
                apart = queries[q] ^ self.prints[e]
                near = np.bitwise_count(apart) <= self.radius
                q, e, apart = q[near], e[near], apart[near]
                for lo2, hi2, *_ in self.blocks[:k]:  # a pair that is near in an earlier block was found there
                    later = np.bitwise_count(self._cut(apart, lo2, hi2)) > self.per
                    q, e, apart = q[later], e[later], apart[later]
                found.append((q, e))
        return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found]).astype(np.int64)


def shingles_of(ids: np.ndarray) -> np.ndarray:
    """A number for every run of SHINGLE words."""
    x = ids.astype(np.uint64) + np.uint64(1)
    n = max(0, len(x) - SHINGLE + 1)
    total = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        total = (total ^ (x[k : k + n] * _MIX[k])) * _MIX[0]
    return total


def met_before(shingles: np.ndarray) -> np.ndarray:
    """Where each shingle stood last before, -1 if nowhere."""
    order = np.argsort(shingles, kind="stable")
    out = np.full(len(shingles), -1)
    again = shingles[order[1:]] == shingles[order[:-1]]
    out[order[1:][again]] = order[:-1][again]
    return out


def shingle_similarity(a: tuple, at: np.ndarray, b: tuple, there: np.ndarray, n: int, most: int = 20_000_000) -> np.ndarray:
    """Weighted Jaccard of the sets of the n shingles from at[k] in a and from there[k] in b; a and b are (shingles, weights, met_before)."""
    out = np.zeros(len(at))
    step = np.arange(n)
    for k in range(0, len(at), max(1, most // (n * n))):
        part = slice(k, k + max(1, most // (n * n)))
        x, y = at[part, None] + step, there[part, None] + step
        new_x, new_y = a[2][x] < at[part, None], b[2][y] < there[part, None]
        found = (a[0][x][:, :, None] == b[0][y][:, None, :]).any(1)
        of_x, of_y = (a[1][x] * new_x).sum(1), b[1][y] * new_y
        both = (of_y * found).sum(1)
        out[part] = both / np.maximum(of_x + of_y.sum(1) - both, 1e-300)
    return out


class _Items:
    """The items' words, windows and index, as the executors use them."""

    def __init__(self, passages: list[tuple[int, list[str]]], window: int, radius: int, item_radius: int, threshold: float, counts: dict[str, int] | None, items: int):
        self.window, self.radius, self.item_radius, self.threshold = window, radius, item_radius, threshold
        df: dict[str, int] = {}
        for _, x in passages:
            for w in set(x):
                df[w] = df.get(w, 0) + 1
        self.number = {w: i for i, w in enumerate(df)}
        weight = np.array([1 + math.log(items / (n if counts is None else counts[w])) for w, n in df.items()] + [1.0])  # the last is any other word's
        self.hash = np.array([xxhash.xxh3_64_intdigest(w) for w in df] + [0], np.uint64)
        self.weight, self.vote = weight, np.append(np.rint(2 * weight[:-1]), 0).astype(np.uint8)
        self.item = [i for i, _ in passages]
        self.start = np.cumsum([0, *(len(x) for _, x in passages)])
        self.words = self.ids([w for _, x in passages for w in x])
        self.shingles = _shingled(self, self.words)
        self.sizes = sorted({s for _, x in passages for s in (window, len(x) // STEP * STEP) if window <= s <= len(x)})
        self.index: dict[int, tuple[np.ndarray, BlockIndex]] = {}

    def ids(self, words: list[str]) -> np.ndarray:
        """Numbers of words; -1 is a word that no item has."""
        return np.fromiter(map(self.number.get, words, itertools.repeat(-1)), np.int32, len(words))

    def prints(self, ids: np.ndarray, size: int) -> np.ndarray:
        return simhash_windows(self.hash[ids], self.vote[ids], size)

    def build(self, size: int) -> tuple[np.ndarray, BlockIndex]:
        """(places, index) of the windows of `size` words; made once by each worker."""
        if size not in self.index:
            length = np.diff(self.start)
            for_size = length >= size if size == self.window else length // STEP * STEP == size
            at = np.concatenate([np.arange(a, b - size + 1) for a, b, mine in zip(self.start, self.start[1:], for_size) if mine])
            self.index[size] = at, BlockIndex(self.prints(self.words, size)[at], self.radius if size == self.window else self.item_radius)
        return self.index[size]

    def hopeful(self, ids: np.ndarray, shingles: tuple, size: int) -> np.ndarray:
        """Starts of windows whose shingles without foreign words weigh enough for the threshold. A shingle that was met shortly before counts as weight only: windows compare sets."""
        n = size - SHINGLE + 1
        if n < 1:
            return np.arange(len(ids) - size + 1)
        _, weights, before = shingles
        bad = weights * ((_sums((ids < 0).astype(np.int32), SHINGLE) > 0) & (before < np.arange(len(weights)) - n + 1))
        total, lost = (np.concatenate([[0.0], np.cumsum(x)]) for x in (weights, bad))
        return np.flatnonzero(lost[n:] - lost[:-n] <= (1 - self.threshold) * (total[n:] - total[:-n]) + 1e-6)


def _shingled(items: _Items, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingles, weights, where each was met before) of a row of words."""
    shingles = shingles_of(ids)
    return shingles, _sums(items.weight[ids], SHINGLE) if len(shingles) else np.zeros(0), met_before(shingles)


def leaked_windows(items: DataFrame, docs: DataFrame, *, window: int = 12, radius: int = 11, item_radius: int = 4, threshold: float = 0.8, item_id: str = "item_id", passage: str = "passage", doc_id: str = "doc_id", text: str = "text", index_mb: float = 256) -> DataFrame:
    """The best match of each item and document that share a window: columns item_id, doc_id, run_words, similarity, hamming, window, doc_word, item_word.

    An item has windows of `window` words and, if it is long enough, of the largest multiple of 32 words in it. Two windows match if their SimHashes differ in at most `radius` bits (`item_radius` for the larger windows, where an edit moves fewer) and their weighted
    five-word shingles are similar by `threshold` or more. The weight of a word is 1 + log(items / items that hold it), 1 for words no item has. run_words is the longest run of
    words both texts share around equal windows of `window` words (0 if windows are only similar); the best match is the one with the longest run, then the most similar. Equal windows have distance 0,
    so all of them are found. Of similar windows the index finds those within the radius: see README for its recall.

    Null, empty and short texts (fewer words than a window) have no windows and are in no row; repeated ids count as
    one item or document with several texts; other columns are ignored. The documents are read once and not shuffled.
    The items are the query set: their index is broadcast if it stays under `index_mb`, else the items are taken in
    blocks that do, one pass over the documents each, with the same result.
    """
    spark = docs.sparkSession
    queries = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(passage).alias("passage")).dropna()
    size = queries.agg(F.sum(F.length("passage")).alias("n"), F.count("*").alias("items")).first()
    blocks = max(1, -(-(size["n"] or 0) * 60 // max(1, int(index_mb * (1 << 20)))))  # an item's words and windows take less than 60 bytes a character; workers make the index from them
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    held = written(_word_counts(queries), "item_words") if blocks > 1 else None
    parts = []
    for b in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        counts = {r.w: r.n for r in held.join(_word_counts(block).select("w"), "w", "left_semi").collect()} if blocks > 1 else None
        passages = [(r.item_id, x) for r in block.collect() if len(x := words_of(r.passage)) >= window or counts is None]
        parts.append(texts.mapInArrow(_matcher(spark.sparkContext.broadcast((passages, window, radius, item_radius, threshold, counts, size["items"]))), HITS))
    found = parts[0]
    for x in parts[1:]:
        found = found.unionByName(x)
    best = F.max(F.struct("run_words", "similarity", -F.col("hamming"), -F.col("doc_word"), -F.col("item_word"), "hamming", "window", "doc_word", "item_word"))
    return found.groupBy("item_id", "doc_id").agg(best.alias("m")).select("item_id", "doc_id", *(f"m.{c}" for c in ("run_words", "similarity", "hamming", "window", "doc_word", "item_word")))


def _word_counts(queries: DataFrame) -> DataFrame:
    """(w, n): how many items hold each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [w for x in batch.column("passage").to_pylist() for w in set(words_of(x))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["w"])

    return queries.mapInArrow(run, "w string").groupBy("w").agg(F.count("*").alias("n"))


_BUILT: dict[int, _Items] = {}


def _matcher(shared):
    """The function that matches batches of texts with the items broadcast."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = shared.value
        items = _BUILT.get(id(plain))
        if items is None:  # a worker keeps its last index
            _BUILT.clear()
            items = _BUILT[id(plain)] = _Items(*plain)
        for batch in batches:
            best: dict[tuple, tuple] = {}
            chunk: list[tuple[int, np.ndarray]] = []
            held = 0
            for n, (doc, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if doc is not None and len(x := items.ids(words_of(text))) >= items.window and items.sizes:
                    chunk.append((doc, x))
                    held += len(x)
                if chunk and (held > 100_000 or n + 1 == batch.num_rows):
                    _match_chunk(chunk, items, best)
                    chunk, held = [], 0
            if best:
                out = [(*k, *v) for k, v in best.items()]
                types = [pa.int64(), pa.int64(), pa.int32(), pa.float64(), *[pa.int32()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=[x.split()[0] for x in HITS.split(", ")])

    return match


def _match_chunk(chunk: list, items: _Items, best: dict) -> None:
    """Windows of some documents at a time; very long texts go in slices that overlap by the largest window, so memory stays bounded."""
    over = items.sizes[-1] - 1
    slices = [(doc, x, at, x[at : at + 200_000 + over]) for doc, x in chunk for at in range(0, max(1, len(x) - items.window + 1), 200_000)]
    for group in _grouped(slices):
        ids = np.concatenate([x for *_, x in group])
        starts = np.cumsum([0, *(len(x) for *_, x in group)])
        shingles = _shingled(items, ids)
        for size in items.sizes:
            if len(ids) < size:
                continue
            at = items.hopeful(ids, shingles, size)
            text = np.searchsorted(starts, at, "right") - 1
            inside = at + size <= starts[text + 1]  # a window that crosses into the next text is none
            at, text = at[inside], text[inside]
            if not len(at):
                continue
            _match_windows(items, group, starts, ids, shingles, at, text, size, best)


def _match_windows(items: _Items, group: list, starts: np.ndarray, ids: np.ndarray, shingles: tuple, at: np.ndarray, text: np.ndarray, size: int, best: dict) -> None:
    """Matches the windows of `size` words at the places `at`; equal ones are looked up once."""
    n = size - SHINGLE + 1
    once, first, copy = np.unique(_content(ids, shingles[0], at, size), return_index=True, return_inverse=True)
    by_copy = np.argsort(copy, kind="stable")
    copies = np.searchsorted(copy[by_copy], np.arange(len(once) + 1))
    one = at[first]
    prints = _prints_at(items, ids, one, size)
    places, index = items.build(size)
    q, e = index.within(prints)
    there = places[e]
    same = np.ones(len(q), bool)
    for k in range(size):
        left = np.flatnonzero(same)
        same[left] = ids[one[q[left]] + k] == items.words[there[left] + k]
    alike = np.ones(len(q))
    alike[~same] = shingle_similarity(shingles, one[q[~same]], items.shingles, there[~same], n) if n > 0 else 0.0
    good = alike >= items.threshold
    q, e, there, same, alike = q[good], e[good], there[good], same[good], alike[good]
    count = copies[q + 1] - copies[q]
    pick = np.repeat(np.arange(len(q)), count)
    where = by_copy[np.repeat(copies[q] - (np.cumsum(count) - count), count) + np.arange(len(pick))]
    same, there, alike = same[pick], there[pick], alike[pick]
    _keep_equal(items, group, starts, at[where[same]], text[where[same]], there[same], size, best)
    number = np.searchsorted(items.start, there, "right") - 1
    pair = text[where] * len(items.item) + number
    near = np.flatnonzero(~same & ~np.isin(pair, pair[same]))  # windows beside equal ones tell nothing more
    near = near[np.lexsort((there[near], at[where[near]], -alike[near], pair[near]))]
    near = near[np.r_[True, np.diff(pair[near]) != 0][: len(near)]]
    for k in near.tolist():
        w, m = int(text[where[k]]), int(number[k])
        doc, _, cut, _ = group[w]
        match = (0, float(alike[k]), int(np.bitwise_count(prints[q[pick[k]]] ^ index.prints[e[pick[k]]])), size, int(at[where[k]] - starts[w]) + cut, int(there[k] - items.start[m]))
        key = (items.item[m], doc)
        if key not in best or match[:2] > best[key][:2]:
            best[key] = match


def _content(ids: np.ndarray, shingles: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A number for the words of each window."""
    x, step = (shingles, SHINGLE) if size >= SHINGLE else (ids.astype(np.uint64), 1)
    total = np.zeros(len(at), np.uint64)
    for k in [*range(0, size - step, step), size - step]:
        total = (total ^ x[at + k]) * _MIX[1] + _MIX[2]
    return total


def _prints_at(items: _Items, ids: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of the windows at these places: only the stretches of words that they cover are summed up."""
    at, back = np.unique(places, return_inverse=True)
    first = np.r_[True, np.diff(at) >= size]
    stretch = np.cumsum(first) - 1
    begin, end = at[first], np.r_[at[:-1][first[1:]], at[-1]] + size
    offset = np.cumsum(np.r_[0, end - begin])
    words = np.concatenate([ids[a:b] for a, b in zip(begin.tolist(), end.tolist())])
    return items.prints(words, size)[at - begin[stretch] + offset[stretch]][back]


def _keep_equal(items: _Items, group: list, starts: np.ndarray, at: np.ndarray, text: np.ndarray, there: np.ndarray, size: int, best: dict) -> None:
    """Notes runs of equal windows, each from its first."""
    order = np.lexsort((at, at - there))
    at, text, there = at[order], text[order], there[order]
    begins = np.ones(len(at), bool)
    begins[1:] = (np.diff(at) != 1) | (np.diff(there) != 1)
    for a, w, i in zip(at[begins].tolist(), text[begins].tolist(), there[begins].tolist()):
        doc, x, cut, _ = group[w]
        number = int(np.searchsorted(items.start, i, "right")) - 1
        d, i = a - int(starts[w]) + cut, i - int(items.start[number])
        run = _run(x, items.words[items.start[number] : items.start[number + 1]], d, i, size)
        key, match = (items.item[number], doc), (run, 1.0, 0, size, d, i)
        if key not in best or match[:2] > best[key][:2]:
            best[key] = match


def _grouped(slices: list) -> Iterator[list]:
    group, size = [], 0
    for s in slices:
        group.append(s)
        size += len(s[3])
        if size > 100_000:
            yield group
            group, size = [], 0
    if group:
        yield group


def _run(x: np.ndarray, y: np.ndarray, d: int, i: int, window: int) -> int:
    n = window
    while d + n < len(x) and i + n < len(y) and x[d + n] == y[i + n]:
        n += 1
    while d > 0 and i > 0 and x[d - 1] == y[i - 1]:
        d, i, n = d - 1, i - 1, n + 1
    return n
