"""Choosing a varied subset: clustering-feature summaries, Ward linkage of their entries, and the record nearest each group centre.

A clustering feature is (records, sum of vectors, sum of squares). Each partition is summarised by at most `entries` features;
summaries are merged in rounds of a few at a time; the last summary is joined by Ward's criterion down to k groups. The
memory of every step is bounded by the number of entries, which depends on k alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.llm.sampling import clean_family
from gneiss.session import written

FAN_IN = 8
_CF = "part int, n double, ss double, ls array<double>"


class _Node:
    """Entries of one node: sizes, sums of squares and vector sums, and the child of each (none in a leaf)."""

    def __init__(self, width: int, dims: int, leaf: bool):
        self.n, self.ss, self.ls = np.zeros(width), np.zeros(width), np.zeros((width, dims))
        self.centre = np.zeros((width, dims))
        self.kids: list[_Node] | None = None if leaf else []
        self.size = 0

    def put(self, i: int, n: float, ss: float, ls: np.ndarray) -> None:
        self.n[i], self.ss[i], self.ls[i], self.centre[i] = n, ss, ls, ls / n

    def append(self, n: float, ss: float, ls: np.ndarray, kid: _Node | None) -> None:
        self.put(self.size, n, ss, ls)
        self.size += 1
        if self.kids is not None:
            self.kids.append(kid)

    def total(self) -> tuple[float, float, np.ndarray]:
        k = self.size
        return self.n[:k].sum(), self.ss[:k].sum(), self.ls[:k].sum(0)


class FeatureTree:
    """A clustering-feature tree of at most `most` leaf entries.

    A feature goes down to the leaf whose centres are nearest at each level, and joins the nearest entry there if that entry's radius
    stays within the threshold; else it becomes an entry of its own. A full node is split around its two entries farthest apart. When
    there are more than `most` entries the threshold grows and the entries are put into a new tree, of `least` entries at least: the
    threshold follows the nearest entries, and is taken back if too many would join.
    """

    WIDTH = 32
    #: Thresholds tried between one that joins too few and one that joins too many.
    TRIES = 8

    def __init__(self, most: int, threshold: float = 0.0, least: int = 1):
        self.most, self.threshold, self.entries, self.root = most, threshold, 0, None
        self.least = min(least, most)

    def add(self, n: np.ndarray, ss: np.ndarray, ls: np.ndarray) -> None:
        """Puts features in; equal vectors of a batch are joined first."""
        if not len(n):
            return
        _, owner = np.unique(ls / n[:, None], axis=0, return_inverse=True)
        owner = owner.ravel()
        k = owner.max() + 1
        sums = np.stack([np.bincount(owner, ls[:, d], k) for d in range(ls.shape[1])], axis=1)
        for feature in zip(np.bincount(owner, n, k), np.bincount(owner, ss, k), sums):
            self._insert(*feature)
            if self.entries > self.most:
                self._rebuild()

    def _leaves(self) -> list[_Node]:
        leaves = []
        todo = [self.root] if self.root else []
        while todo:
            node = todo.pop()
            if node.kids is None:
                leaves.append(node)
            else:
                todo += node.kids
        return leaves

    def features(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sizes, sums of squares and vector sums of the leaf entries."""
        leaves = self._leaves()
        if not leaves:
            return np.zeros(0), np.zeros(0), np.zeros((0, 0))
        return tuple(np.concatenate([getattr(x, c)[: x.size] for x in leaves]) for c in ("n", "ss", "ls"))

    def _near(self) -> float:
        """The radius within which so many entries meet their nearest in the leaf as have to go, to be midway between `least` and `most`."""
        found = []
        for leaf in self._leaves():
            if leaf.size > 1:
                n, ss, ls, c = (x[: leaf.size] for x in (leaf.n, leaf.ss, leaf.ls, leaf.centre))
                square = (c**2).sum(1)
                apart = square[:, None] + square[None, :] - 2 * c @ c.T
                np.fill_diagonal(apart, np.inf)
                j = apart.argmin(1)
                total = n + n[j]
                found.append((ss + ss[j]) / total - ((ls + ls[j]) ** 2).sum(1) / total**2)
        radii = np.sqrt(np.maximum(0, np.concatenate(found))) if found else np.zeros(1)
        return float(np.quantile(radii, (self.most - self.least) / (2 * self.most)))

    def _rebuild(self) -> None:
        kept, low, high, tries = self.features(), self.threshold, np.inf, self.TRIES
        while True:
            if high == np.inf:
                self.threshold = max(1.1 * low, self._near()) or 1e-9
            else:
                self.threshold, tries = (low + high) / 2 if tries else high, tries - 1
            spare = self._refill(kept)
            if self.entries > self.most:
                low = self.threshold
                if high == np.inf:
                    kept = self.features()
            elif spare or tries < 0:
                return
            else:
                high = self.threshold

    def _refill(self, kept: tuple[np.ndarray, np.ndarray, np.ndarray]) -> int:
        """Puts features into a new tree with at most len - least joins; joins left over."""
        self.entries, self.root = 0, None
        spare = len(kept[0]) - self.least
        for i, feature in enumerate(zip(*kept)):
            self._insert(*feature, join=i - self.entries < spare)
        return spare - (len(kept[0]) - self.entries)

    def _insert(self, n: float, ss: float, ls: np.ndarray, join: bool = True) -> None:
        if self.root is None:
            self.root = _Node(self.WIDTH + 1, len(ls), True)
        path, node, centre = [], self.root, ls / n
        while True:
            apart = node.centre[: node.size] - centre
            i = int(np.einsum("ij,ij->i", apart, apart).argmin()) if node.size else -1
            if node.kids is None:
                break
            path.append((node, i))
            node = node.kids[i]
        joined = False
        if i >= 0 and join:
            total, squares, sums = node.n[i] + n, node.ss[i] + ss, node.ls[i] + ls
            if squares / total - (sums @ sums) / total**2 <= self.threshold**2 + 1e-12 * squares / total:
                node.put(i, total, squares, sums)
                joined = True
        if not joined:
            node.append(n, ss, ls, None)
            self.entries += 1
        for parent, i in reversed(path):
            parent.put(i, parent.n[i] + n, parent.ss[i] + ss, parent.ls[i] + ls)
        while node.size > self.WIDTH:
            left, right = self._split(node)
            if not path:
                self.root = _Node(self.WIDTH + 1, len(ls), False)
                for half in (left, right):
                    self.root.append(*half.total(), half)
                break
            node, i = path.pop()
            node.put(i, *left.total())
            node.kids[i] = left
            node.append(*right.total(), right)

    def _split(self, node: _Node) -> tuple[_Node, _Node]:
        c = node.centre[: node.size]
        square = (c**2).sum(1)
        apart = square[:, None] + square[None, :] - 2 * c @ c.T
        a, b = np.unravel_index(int(apart.argmax()), apart.shape)
        near_a = apart[:, a] <= apart[:, b]
        near_a[b], near_a[a] = False, True
        halves = _Node(len(node.n), c.shape[1], node.kids is None), _Node(len(node.n), c.shape[1], node.kids is None)
        for i in range(node.size):
            halves[0 if near_a[i] else 1].append(node.n[i], node.ss[i], node.ls[i], node.kids[i] if node.kids is not None else None)
        return halves


def ward(n: np.ndarray, ls: np.ndarray, k: int) -> np.ndarray:
    """Group number of each feature after joining by Ward linkage down to k groups: nearest-neighbour chains, then the k - 1 dearest joins undone.

    Distances are worked out from sizes and centres as they are needed, so memory stays in proportion to the features. Ties fall to the lower number.
    """
    m = len(n)
    if m <= k:
        return np.arange(m)
    size, centre = n.astype(float).copy(), ls / n[:, None]
    alive = np.ones(m, bool)
    joins: list[tuple[float, int, int]] = []
    chain: list[int] = []
    square = (centre**2).sum(1)
    start = 0
    while len(joins) < m - 1:
        if not chain:
            while not alive[start]:
                start += 1
            chain = [start]
        a = chain[-1]
        d = (size * size[a] / (size + size[a])) * np.maximum(0, square + square[a] - 2 * centre @ centre[a])
        d[~alive] = np.inf
        d[a] = np.inf
        b = int(d.argmin())
        if len(chain) > 1 and d[chain[-2]] <= d[b]:
            b = chain[-2]
            chain = chain[:-2]
            joins.append((float(d[b]), a, b))
            centre[b] = (size[a] * centre[a] + size[b] * centre[b]) / (size[a] + size[b])
            size[b] += size[a]
            square[b] = (centre[b] ** 2).sum()
            alive[a] = False
        else:
            chain.append(b)
    parent = np.arange(m)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for _, a, b in sorted(joins, key=lambda j: j[0])[: m - k]:
        parent[root(a)] = root(b)
    return np.unique([root(i) for i in range(m)], return_inverse=True)[1].ravel()


def shape_vectors(manifest: DataFrame) -> DataFrame:
    """(id, family, x): a vector for each record with a usable signature: logarithms of volume, area and sorted moments.

    A record's last loaded usable row counts; ties fall to the largest values. Sizes other than positive numbers have no
    logarithm and leave the row unusable.
    """
    g = "geometry_signature"
    moments = F.array_sort(f"{g}.principal_moments")
    sizes = F.array(F.col(f"{g}.volume"), F.col(f"{g}.surface_area"), *(F.get(moments, i) for i in range(3)))
    rows = manifest.select(F.col("part_id").cast("string").alias("id"), clean_family(F.col("family")).alias("family"), sizes.alias("x"), F.size(moments).alias("m"), F.col("loaded_at").cast("timestamp").alias("at"))
    good = rows.where("id is not null and m = 3").where(F.forall("x", lambda v: v.isNotNull() & (v > 0) & (v < float("inf"))))
    last = good.groupBy("id").agg(F.max(F.struct("at", "x", "family")).alias("r"))
    return last.select("id", F.coalesce("r.family", F.lit("")).alias("family"), F.transform("r.x", lambda v: F.log(v)).alias("x"))


def _standardised(vectors: DataFrame, family_weight: float) -> DataFrame:
    """(id, x): each component less its mean, over its deviation, and six components that set families apart."""
    d = 5
    stats = vectors.agg(*(F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(d)), *(F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(d))).first()
    scaled = [(F.col("x")[i] - F.lit(stats[f"m{i}"])) / F.lit(stats[f"s{i}"] or 1.0) for i in range(d)]
    turns = [F.pmod(F.xxhash64("family", F.lit(i)), F.lit(1 << 20)) * F.lit(2 * np.pi / (1 << 20)) for i in range(3)]
    weight = F.lit(family_weight / np.sqrt(3))
    return vectors.select("id", F.array(*scaled, *(f(t) * weight for t in turns for f in (F.cos, F.sin))).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _features(tree: FeatureTree, part: int) -> pa.RecordBatch:
    n, ss, ls = tree.features()
    return pa.RecordBatch.from_arrays([pa.array([part] * len(n), pa.int32()), pa.array(n), pa.array(ss), pa.array(ls.tolist(), pa.list_(pa.float64()))], names=["part", "n", "ss", "ls"])


def summarise(points: DataFrame, entries: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(records, vector sums) of at most `entries` clustering features over all points (id, x); no summary is joined down to fewer than `least`."""
    from pyspark import TaskContext

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = FeatureTree(entries, least=least)
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(0))
                tree.add(np.ones(len(x)), (x**2).sum(1), x)
        if tree.root:
            yield _features(tree, TaskContext.get().partitionId())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, part = FeatureTree(entries, least=least), 0
        for b in batches:
            if b.num_rows:
                part = b.column("part")[0].as_py()
                tree.add(b.column("n").to_numpy(), b.column("ss").to_numpy(), _matrix(b.column("ls")))
        if tree.root:
            yield _features(tree, part)

    level = written(points.select("x").mapInArrow(leaf, _CF), "features")
    parts = level.agg(F.max("part")).first()[0]
    while parts is not None and parts > 0:
        parts //= FAN_IN
        groups = level.withColumn("part", (F.col("part") / FAN_IN).cast("int"))
        level = written(groups.repartitionById(parts + 1, "part").mapInArrow(merge, _CF), "features")
    tree = FeatureTree(entries, least=least)
    rows = level.toArrow()  # at most FAN_IN * entries features
    if rows.num_rows:
        tree.add(rows.column("n").to_numpy(), rows.column("ss").to_numpy(), _matrix(rows.column("ls").combine_chunks()))
    n, _, ls = tree.features()
    return n, ls


def varied_subset(manifest: DataFrame, size: int, *, entries: int | None = None, family_weight: float = 1.0) -> DataFrame:
    """A subset of `size` records that spans the shapes: group_no, part_id, distance, group_records.

    One record per group: of the records that lie nearer to its centre than to any other, the nearest (ties fall to the smaller part_id). Groups
    of which no record does so then take, in turn, the nearest records that are left, so that the subset has its full size. group_records counts the
    records summed up in the group; a record added because there are fewer groups than `size` has 0, being counted in another. Records without a usable signature have no place among the shapes and are left out; repeated rows
    are one record; if there are fewer distinct vectors than `size`, one record for each is returned; size 0 or an
    empty table gives no rows.

    entries (by default 4 * size, but 1,000 at least and size + 10,000 at most) bounds every summary; the centres sent to the executors are `size` vectors of eleven numbers.
    """
    spark = manifest.sparkSession
    schema = "group_no int, part_id string, distance double, group_records long"
    vectors = written(shape_vectors(manifest), "shape_vectors")
    if size <= 0 or vectors.isEmpty():
        return spark.createDataFrame([], schema)
    points = _standardised(vectors, family_weight)
    n, ls = summarise(points, entries or max(1000, min(4 * size, size + 10_000)), size)
    group = ward(n, ls, size)
    k = int(group.max()) + 1
    count = np.bincount(group, n, k)
    centres = np.stack([np.bincount(group, ls[:, d], k) for d in range(ls.shape[1])], axis=1) / count[:, None]
    picked: dict[int, tuple[str, float]] = {}
    first = True
    while len(picked) < k:
        missing = np.array([c for c in range(k) if c not in picked])
        found = _nearest(points, centres if first else centres[missing], first, {name for name, _ in picked.values()})
        won: dict[str, tuple[float, int]] = {}
        for c, distance, name in found:
            won[name] = min(won.get(name, (np.inf, 0)), (distance, c if first else int(missing[c])))
        if not won and not first:
            break
        picked |= {c: (name, distance) for name, (distance, c) in won.items()}
        first = False
    # Vectors that agree but for rounding are one entry, so there may be fewer groups than vectors.
    for name, distance in _others(points, centres, [name for name, _ in picked.values()], size - len(picked)):
        picked[k] = (name, distance)
        count = np.append(count, 0)
        k += 1
    rows = [(c, name, distance, int(round(count[c]))) for c, (name, distance) in sorted(picked.items())]
    return spark.createDataFrame(rows, schema)


class Centres:
    """Centres in cells about some of them, so that a record's nearest centre is found without a comparison with each: a cell whose pivot lies further off than the nearest pivot by more than the cell's radius holds none."""

    def __init__(self, centres: np.ndarray):
        k = len(centres)
        self.centres, self.square = centres, (centres**2).sum(1)
        if k <= 256:
            self.cells = None
            return
        pivots = np.unique(np.linspace(0, k - 1, max(int(np.sqrt(k)), k // 16)).astype(int))
        near = self._squares(centres, centres[pivots]).argmin(1)
        self.pivots = centres[pivots]
        self.cells = [np.flatnonzero(near == p) for p in range(len(pivots))]
        self.radius = np.array([np.sqrt(self._squares(centres[c], self.pivots[p : p + 1]).max(initial=0)) for p, c in enumerate(self.cells)])

    @staticmethod
    def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.maximum(0, (x**2).sum(1)[:, None] - 2 * x @ y.T + (y**2).sum(1)[None, :])

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centre, squared distance) of each row's nearest centre; the first of those as near."""
        if self.cells is None:
            d = self._squares(x, self.centres)
            found = d.argmin(1)
            return found, d[np.arange(len(x)), found]
        to_pivot = np.sqrt(self._squares(x, self.pivots))
        best, found = np.full(len(x), np.inf), np.zeros(len(x), np.int64)
        home = to_pivot.argmin(1)  # its cell gives a first bound, which spares most others
        for own in (True, False):
            for p, cell in enumerate(self.cells):
                rows = np.flatnonzero(home == p if own else (home != p) & (to_pivot[:, p] - self.radius[p] <= np.sqrt(best) * (1 + 1e-9) + 1e-9))
                if not len(rows) or not len(cell):
                    continue
                d = self._squares(x[rows], self.centres[cell])
                at = d.argmin(1)
                low, which = d[np.arange(len(rows)), at], cell[at]
                better = (low < best[rows]) | ((low == best[rows]) & (which < found[rows]))
                best[rows[better]], found[rows[better]] = low[better], which[better]
        return found, best


def _others(points: DataFrame, centres: np.ndarray, taken: list[str], wanted: int) -> list[tuple[str, float]]:
    """(id, distance to the nearest centre) of up to `wanted` records whose vectors no taken record has, one for each vector, those farthest from all centres first."""
    if wanted <= 0:
        return []
    names = points.sparkSession.createDataFrame([(n,) for n in taken], "id string")
    used = points.join(names, "id", "left_semi").select("x")
    left = points.groupBy("x").agg(F.min("id").alias("id")).join(used, "x", "left_anti")
    shared = points.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = Centres(shared.value)
        for b in batches:
            for at in range(0, b.num_rows, step := 8192):
                _, d = centres.nearest(_matrix(b.column(1).slice(at, step)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, step), pa.array(np.sqrt(d))], names=["id", "distance"])

    far = left.select("id", "x").mapInArrow(run, "id string, distance double")
    return [(r.id, r.distance) for r in far.orderBy(F.desc("distance"), "id").limit(wanted).collect()]


def _nearest(points: DataFrame, centres: np.ndarray, own: bool, taken: set[str]) -> list[tuple[int, float, str]]:
    """(centre, distance, id) of the record nearest each centre that is not taken; with own, among those that have no nearer centre."""
    shared = points.sparkSession.sparkContext.broadcast((centres, taken))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, taken = shared.value
        best: dict[int, tuple[float, str]] = {}
        square, cells = (centres**2).sum(1), Centres(centres) if own else None
        for b in batches:
            ids = b.column(0).to_pylist()
            for at in range(0, len(ids), step := 8192 if own else max(1, (1 << 22) // len(centres))):
                x = _matrix(b.column(1).slice(at, step))
                names = ids[at : at + len(x)]
                if own:
                    near, d = cells.nearest(x)
                    found = zip(near.tolist(), d.tolist(), names)
                else:
                    d = np.maximum(0, square[None, :] - 2 * x @ centres.T + (x**2).sum(1)[:, None])
                    d[[n in taken for n in names]] = np.inf
                    low = d.min(0)
                    found = ((int(c), float(low[c]), names[r]) for r, c in np.argwhere(d == low[None, :]) if low[c] < np.inf)
                for c, distance, name in found:
                    if c not in best or (distance, name) < best[c]:
                        best[c] = (distance, name)
        yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.int32()), pa.array([float(np.sqrt(v[0])) for v in best.values()], pa.float64()), pa.array([v[1] for v in best.values()], pa.string())], names=["c", "distance", "name"])

    local = points.mapInArrow(run, "c int, distance double, name string")
    return [(r.c, r.m.distance, r.m.name) for r in local.groupBy("c").agg(F.min(F.struct("distance", "name")).alias("m")).collect()]
