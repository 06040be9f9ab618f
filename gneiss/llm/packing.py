"""Filling fixed-capacity containers with items: Martello-Toth dominance reduction, then best fit, over counts of sizes.

Items of one size are interchangeable, so the solver works on the number of items of each size, at most `capacity` numbers
however many items there are. Its plan gives, for each size, which ranks go to which containers; items get
their rank within a size in parallel, a hot size being cut into slices whose offsets are known.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gneiss.session import written

#: A public token rule: runs of letters and digits, and single other visible characters.
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\p{Z}\p{C}]"
PACKED = "pack_id string, bin_no long, doc_id long, piece_no long, first_token long, tokens int"


class _Sizes:
    """A multiset of sizes, with the questions that the dominance rules ask."""

    def __init__(self, counts: dict[int, int]):
        self.n = {s: k for s, k in counts.items() if k > 0}
        self.order = sorted(self.n)

    def take(self, size: int, k: int) -> None:
        self.n[size] -= k
        if not self.n[size]:
            del self.n[size]
            self.order.remove(size)

    def largest(self, limit: int) -> int | None:
        i = bisect_right(self.order, limit)
        return self.order[i - 1] if i else None

    def smallest(self, k: int, above: int = 0) -> list[int]:
        """The k smallest items above a size, copies included; fewer if there are not so many."""
        out: list[int] = []
        for s in self.order[bisect_right(self.order, above) :]:
            out += [s] * min(self.n[s], k - len(out))
            if len(out) == k:
                break
        return out

    def best_pair(self, limit: int) -> int:
        """The largest sum of two items that is at most limit, 0 if there is none."""
        best, i, j = 0, 0, len(self.order) - 1
        while i <= j:
            a, b = self.order[i], self.order[j]
            if a + b > limit:
                j -= 1
                continue
            if i < j or self.n[a] > 1:
                best = max(best, a + b)
            i += 1
        return best


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """(containers that some optimal solution has, as contents and how many; the sizes left over).

    For the largest item j the set {j, ...} is fixed if it dominates every other set that could hold j: if nothing goes with
    it; if one item k fills it up, or only one can go with it and k is the largest; if at most two can go with it and none of
    these pairs is larger than k; or if k and the largest item beside it match any such pair item by item.
    """
    left, fixed = _Sizes(counts), []
    for j in sorted(counts, reverse=True):
        while left.n.get(j):
            room = capacity - j
            left.take(j, 1)
            low, k = left.smallest(3), left.largest(room)
            content: tuple[int, ...] | None = None
            if k is None:
                content = (j,)
            elif k == room or sum(low[:2]) > room or len(low) < 2:
                content = (j, k)
            elif len(low) < 3 or sum(low) > room:
                if left.best_pair(room) <= k:
                    content = (j, k)
                else:
                    left.take(k, 1)
                    q = left.largest(room - k)
                    left.n[k] = left.n.get(k, 0) + 1
                    if k not in left.order:
                        left.order.insert(bisect_right(left.order, k), k)
                    if q is not None and sum((left.smallest(2, q) + [room, room])[:2]) > room:
                        content = (j, k, q)
            left.n[j] = left.n.get(j, 0) + 1
            if j not in left.order:
                left.order.insert(bisect_right(left.order, j), j)
            if content is None:
                break
            need = Counter(content)
            times = min(left.n[s] // c for s, c in need.items())
            for s, c in need.items():
                left.take(s, c * times)
            fixed.append((content, times))
    return fixed, left.n


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit in order of falling size, run on counts: containers with equal contents are one entry."""
    open_bins: dict[int, list[list]] = defaultdict(list)  # by free space
    free: list[int] = []

    def put(space: int, content: tuple[int, ...], k: int) -> None:
        if not open_bins[space]:
            free.insert(bisect_right(free, space), space)
        open_bins[space].append([content, k])

    for s in sorted(counts, reverse=True):
        n = counts[s]
        while n:
            i = bisect_right(free, s - 1)
            if i < len(free):
                space = free[i]
                entry = open_bins[space][-1]
            else:
                space, entry = capacity, [(), n]
            each = min(space // s, n)
            k = min(entry[1], n // each)
            if space < capacity or entry[0]:
                entry[1] -= k
                if not entry[1]:
                    open_bins[space].pop()
                    if not open_bins[space]:
                        free.remove(space)
            put(space - each * s, entry[0] + (s,) * each, k)
            n -= each * k
    return [(content, k) for entries in open_bins.values() for content, k in entries]


def plan_containers(counts: dict[int, int], capacity: int) -> tuple[dict[int, tuple[np.ndarray, ...]], int]:
    """(by size: first ranks, items per container, first container of each run of ranks; number of containers)."""
    if any(s < 1 or s > capacity for s in counts):
        raise ValueError("sizes lie between 1 and the capacity")
    fixed, left = reduce_by_dominance(counts, capacity)
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    used: Counter[int] = Counter()
    bins = 0
    for content, k in [*fixed, *best_fit(left, capacity)]:
        for s, each in Counter(content).items():
            runs[s].append((used[s], each, bins))
            used[s] += each * k
        bins += k
    return {s: tuple(np.array(c, np.int64) for c in zip(*r)) for s, r in runs.items()}, bins


def pieces_of(docs: DataFrame, kinds: list[tuple[str, int]], *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(pack_id, capacity, doc_id, piece_no, first_token, tokens): a text, whole unless it exceeds the pack's capacity."""
    sizes = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.regexp_count(F.col(text), F.lit(TOKEN)).alias("total")).where("total > 0")
    packs = F.array(*(F.struct(F.lit(p).cast("string").alias("pack_id"), F.lit(c).cast("long").alias("capacity")) for p, c in kinds))
    rows = sizes.select("doc_id", "total", F.explode(packs).alias("pack")).select("doc_id", "total", "pack.*")
    cut = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("total") - 1) / F.col("capacity")))).alias("piece_no")
    first = F.col("piece_no") * F.col("capacity")
    return rows.select("pack_id", "capacity", "doc_id", "total", cut).select("pack_id", "capacity", "doc_id", "piece_no", first.alias("first_token"), F.least("capacity", F.col("total") - first).cast("int").alias("tokens"))


def pack_texts(docs: DataFrame, packs: DataFrame, slice_rows: int = 50_000, *, doc_id: str = "doc_id", text: str = "text", pack_id: str = "pack_id", capacity: str = "capacity") -> DataFrame:
    """Which container of each pack holds which text: pack_id, bin_no, doc_id, piece_no, first_token, tokens.

    A text of no more tokens than the capacity has one piece, number 0; a longer one is cut at multiples of the capacity. Null
    and empty texts, and texts without tokens, need no container and have no row; packs with a null or non-positive capacity
    are passed over; repeated rows are items of their own; either table may be empty. At most 1,000 kinds of packs are taken. Of the
    items, the driver sees how many have each size: at most the sum of the capacities.
    """
    spark = docs.sparkSession
    usable = packs.select(F.col(pack_id), F.col(capacity).cast("long")).where(F.col(capacity) > 0).distinct()
    kinds = [tuple(r) for r in usable.take(1001)]
    if len(kinds) > 1000:
        raise ValueError("more than 1,000 kinds of containers")
    if not kinds:
        return spark.createDataFrame([], PACKED)
    items = written(pieces_of(docs, kinds, doc_id=doc_id, text=text), "pack_items")
    counts = items.groupBy("pack_id", "capacity", "tokens").count().collect()
    by_pack: dict[tuple, dict[int, int]] = defaultdict(dict)
    for r in counts:
        by_pack[r.pack_id, r.capacity][r.tokens] = r["count"]
    plans = spark.sparkContext.broadcast({key: plan_containers(sizes, key[1])[0] for key, sizes in by_pack.items()})
    slices = items.groupBy("pack_id", "capacity", "tokens").agg(F.ceil(F.count("*") / slice_rows).cast("int").alias("slices"))
    if len(counts) <= 200_000:  # rows of two numbers and a name
        slices = F.broadcast(slices)
    salted = items.join(slices, ["pack_id", "capacity", "tokens"]).withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece_no"), F.col("slices")).cast("int"))
    key = ["pack_id", "capacity", "tokens", "slice"]
    offsets = salted.groupBy(*key).count().withColumn("offset", F.sum("count").over(Window.partitionBy(*key[:3]).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)))
    ranked = salted.withColumn("r", F.row_number().over(Window.partitionBy(*key).orderBy("doc_id", "piece_no")))
    ranked = ranked.join(offsets.select(*key, "offset"), key).withColumn("rank", F.col("r") - 1 + F.coalesce("offset", F.lit(0)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pack, capacity, tokens, rank = (batch.column(k).to_pylist() if k == "pack_id" else batch.column(k).to_numpy() for k in ("pack_id", "capacity", "tokens", "rank"))
            bins = np.zeros(batch.num_rows, np.int64)
            groups: dict[tuple, list[int]] = defaultdict(list)
            for i, one in enumerate(zip(pack, capacity.tolist(), tokens.tolist())):
                groups[one].append(i)
            for (p, c, s), rows in groups.items():
                first, each, start = plans.value[p, c][s]
                at = np.searchsorted(first, rank[rows], "right") - 1
                bins[rows] = start[at] + (rank[rows] - first[at]) // each[at]
            yield pa.RecordBatch.from_arrays([batch.column("pack_id"), pa.array(bins), *(batch.column(k) for k in ("doc_id", "piece_no", "first_token", "tokens"))], names=[x.split()[0] for x in PACKED.split(", ")])

    return ranked.select("pack_id", "capacity", "tokens", "rank", "doc_id", "piece_no", "first_token").mapInArrow(assign, PACKED)
