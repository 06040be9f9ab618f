"""A sample that matches target category proportions.

Iterative proportional fitting (raking) gives each cell of family and tier a weight for which every target margin holds; records are drawn
by weighted exponential keys; minimums are then repaired, and what is missing is reported with its cause. The records returned are those that the
keys drew, but for the few that the repair moves between cells: a cell gives up its largest keys and adds its next smallest. Cells are bounded by
the targets (their families and tiers, and one "other" of each), so the raking runs on the driver; records stay distributed.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gneiss.session import written

OTHER_TIER = -(1 << 31)
OTHER_FAMILY = "\0other"
REPORT = "plan_id string, category_id string, family string, tier int, need double, available long, target_share double, drawn long, drawn_share double, gap double, unfillable boolean, moved long, cause string"


def clean_family(c: F.Column) -> F.Column:
    """Lower case without surrounding white space; null if nothing is left."""
    bare = F.lower(F.regexp_replace(c, r"(?U)^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    return F.when(bare != "", bare)


@dataclass
class Category:
    category_id: str
    family: str | None
    tier: int | None
    share: float
    minimum: int
    need: float

    def holds(self, cell: tuple[str, int]) -> bool:
        return cell[0] is not None and (self.family is None or self.family == cell[0]) and (self.tier is None or self.tier == cell[1])


def rake(cells: dict[tuple, int], categories: list[Category], rounds: int = 200, close: float = 1e-9) -> dict[tuple, float]:
    """Expected records of each cell in a sample of 1, by iterative proportional fitting.

    Categories of one kind (family, tier, or both given) are one margin. A margin whose shares sum to more than 1 is scaled to 1; what it
    leaves under 1 goes to the cells outside its categories in proportion, or to its categories if no other cell has records. Categories without
    records are left out. Starts from the cells' own shares; an empty table gives no weights.
    """
    total = sum(cells.values())
    if not total:
        return {}
    names, targets = list(cells), _margins(cells, categories)
    w = np.array([cells[c] / total for c in names])
    for _ in range(rounds):
        before = w.copy()
        for part in targets:
            for inside, share in part:
                now = w[inside].sum()
                if now > 0:
                    w[inside] *= share / now
        if np.abs(w - before).max() < close:
            break
    return dict(zip(names, w.tolist()))


def _margins(cells: dict[tuple, int], categories: list[Category]) -> list[list[tuple[np.ndarray, float]]]:
    """The margins that raking works on: per kind of category, which cells belong together and what they should sum to."""
    total = sum(cells.values())
    names = list(cells)
    w = np.array([cells[c] / total for c in names])
    margins: dict[tuple, list[tuple[np.ndarray, float]]] = defaultdict(list)
    for c in categories:
        inside = np.array([c.holds(x) for x in names])
        if w[inside].sum() > 0:
            margins[c.family is None, c.tier is None].append((inside, max(c.share, 0.0)))
    targets = []
    for rows in margins.values():
        wanted, rest = sum(s for _, s in rows), ~np.logical_or.reduce([i for i, _ in rows])
        scale = 1 / wanted if wanted > 1 or wanted > 0 and not w[rest].sum() else 1.0
        part = [(i, s * scale) for i, s in rows]
        if w[rest].sum() > 0:
            part.append((rest, max(0.0, 1 - wanted * scale)))
        targets.append(part)
    return targets


def off_margins(weights: dict[tuple, float], categories: list[Category], close: float = 1e-6) -> set[str]:
    """Categories whose raked weights miss what their margin asks for: the margins contradict one another, or the rounds did not suffice."""
    if not weights:
        return set()
    w = np.array(list(weights.values()))
    kinds: dict[tuple, list[Category]] = defaultdict(list)
    for c in categories:
        kinds[c.family is None, c.tier is None].append(c)
    missed = set()
    for rows in kinds.values():
        held = {c.category_id: w[np.array([c.holds(x) for x in weights])].sum() for c in rows}
        missed |= {c.category_id for c in rows if held[c.category_id] < c.share / max(1.0, sum(r.share for r in rows)) - close}
    return missed


def repair(drawn: dict[tuple, int], cells: dict[tuple, int], expected: dict[tuple, float], categories: list[Category], size: int) -> dict[tuple, int]:
    """Records to take from each cell: the drawn numbers, moved so that categories reach their minimum and then their share.

    First the minimums, smallest first, as far as records go; then each category's raked share of the sample, rounded down, which takes off the chance of the draw. A category
    takes from the cells furthest under their expected number; the same number is given back by the cells furthest over it whose categories
    all keep their share or, if no cell can, their minimum.
    """
    take = {x: drawn.get(x, 0) for x in cells}
    holders = {c.category_id: [x for x in cells if c.holds(x)] for c in categories}
    of_cell = {x: [c.category_id for c in categories if c.holds(x)] for x in cells}
    count = {i: sum(take[x] for x in xs) for i, xs in holders.items()}
    least = {c.category_id: c.minimum for c in categories}
    share = {i: max(least[i], math.floor(size * sum(expected.get(x, 0.0) for x in xs) + 1e-9)) for i, xs in holders.items()}

    def over(x: tuple) -> float:
        return take[x] - size * expected.get(x, 0.0)

    def move(x: tuple, k: int) -> None:
        take[x] += k
        for i in of_cell[x]:
            count[i] += k

    for goal in (least, share):
        for i in sorted(goal, key=lambda i: (goal[i], i)):
            while (short := goal[i] - count[i]) > 0:
                room = [x for x in holders[i] if cells[x] > take[x]]
                if not room:
                    break
                x = min(room, key=lambda x: (over(x), x))
                move(x, min(short, cells[x] - take[x], max(1, math.floor(-over(x)))))
    for floor in (share, least):
        while (extra := sum(take.values()) - size) > 0:
            free = {x: min([k, *(count[i] - floor[i] for i in of_cell[x])]) for x, k in take.items() if k}
            free = {x: k for x, k in free.items() if k > 0}
            if not free:
                break
            x = max(free, key=lambda x: (over(x), x))
            move(x, -min(extra, free[x], max(1, math.floor(over(x)))))
    return take


def smallest(rows: DataFrame, group: list[str], value: str, tie: str, wanted: DataFrame) -> DataFrame:
    """The `wanted` rows of each group with the smallest `value` (ties by `tie`), without sorting any group.

    wanted: group columns, k, and lo and hi between which the k-th value is expected. Rows below lo are taken if they are at most k, and only the rows from lo to hi are
    sorted; groups for which the k-th value lies elsewhere get a wider band.
    """
    wanted = wanted.select(*group, "k", "lo", "hi")
    out = []
    while True:
        near = rows.join(F.broadcast(wanted), group)
        x = F.col(value)
        counts = near.groupBy(*group, "k", "lo", "hi").agg(F.count_if(x < F.col("lo")).alias("below"), F.count_if(x <= F.col("hi")).alias("upto"), F.count("*").alias("n")).collect()
        good = [r for r in counts if r.below <= r.k and (r.upto >= r.k or r.upto == r.n)]
        if good:
            spark = rows.sparkSession
            names = [f.name for f in wanted.schema.fields]
            kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wanted.schema.fields)
            done = spark.createDataFrame([(*(r[c] for c in names), r.below) for r in good], f"{kinds}, below long")
            picked = rows.join(F.broadcast(done), group)
            band = picked.where((F.col(value) >= F.col("lo")) & (F.col(value) <= F.col("hi")))
            rank = F.row_number().over(Window.partitionBy(*group).orderBy(value, tie))
            out.append(picked.where(F.col(value) < F.col("lo")).select(rows.columns))
            out.append(band.withColumn("rank", rank).where(F.col("rank") <= F.col("k") - F.col("below")).select(rows.columns))
        bad = [r for r in counts if r not in good]
        if not bad:
            break
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wanted.schema.fields)
        wider = [(*(r[c] for c in group), r.k, 0.0 if r.below > r.k else r.lo, r.hi if r.upto >= r.k else max(2 * r.hi, 1e-300)) for r in bad]
        wanted = rows.sparkSession.createDataFrame(wider, kinds)
    if not out:
        return rows.limit(0)
    total = out[0]
    for x in out[1:]:
        total = total.unionByName(x)
    return total


@dataclass
class Sample:
    records: DataFrame
    report: DataFrame


def sample_to_targets(manifest: DataFrame, plans: DataFrame, targets: DataFrame, seed: int = 0) -> Sample:
    """For each plan with targets, a sample of the manifest's records and a report on its categories.

    records: plan_id, part_id, family, tier; report: a row per target with its need (the larger of min_rows, null being
    0, and target_share * sample_rows), the distinct part_id available, the number and share drawn, the gap (need - drawn, 0 if negative), whether
    the manifest cannot fill it (need exceeds available), how many of its records the repair added (negative: gave up) after the draw, and the cause of a gap:
    "manifest" (fewer records than needed), "plan" (the needs of its kind of category exceed the sample), "margins" (raking met no weights for all margins at once),
    "rounding" (a gap under one record), else "other" (records that the minimums of other categories hold); null without a gap.

    A row belongs to a category by its own family, apart from case and surrounding white space, and tier; one without family
    belongs to none. A part_id counts once per category; for the draw it stands in the cell of its best row: one that the
    targets name, then the last loaded. Rows without part_id, plans without sample_rows (taken as 0) or larger than the manifest, null
    shares (0), ties, repeated rows and empty tables are in order; other columns are ignored. The targets and plans are
    read on the driver: they are taken to be at most 100,000 rows.
    """
    spark = manifest.sparkSession
    sizes = {r.plan_id: r.sample_rows or 0 for r in plans.select("plan_id", "sample_rows").where("plan_id is not null").limit(100_001).collect()}
    rows = targets.select("plan_id", "category_id", "family", clean_family(F.col("family")).alias("clean"), "tier", "target_share", "min_rows").limit(100_001).collect()
    if len(rows) > 100_000 or len(sizes) > 100_000:
        raise ValueError("more than 100,000 targets or plans")
    by_plan: dict[str, list[Category]] = defaultdict(list)
    for r in rows:
        share, least = r.target_share or 0.0, r.min_rows or 0
        by_plan[r.plan_id].append(Category(r.category_id, r.clean, r.tier, share, least, max(float(least), share * sizes.get(r.plan_id, 0))))
    families = sorted({c.family for cs in by_plan.values() for c in cs if c.family})
    tiers = sorted({c.tier for cs in by_plan.values() for c in cs if c.tier is not None})

    own = manifest.select(F.col("part_id").cast("string").alias("part_id"), clean_family(F.col("family")).alias("f"), F.col("tier").alias("t"), F.col("loaded_at").cast("timestamp").alias("at")).where("part_id is not null and f is not null")
    own = own.withColumn("f", F.when(F.col("f").isin(families), F.col("f")).otherwise(OTHER_FAMILY)).withColumn("t", F.when(F.col("t").isin(tiers), F.col("t")).otherwise(OTHER_TIER))
    rank = F.struct((F.col("f") != OTHER_FAMILY).alias("a"), (F.col("t") != OTHER_TIER).alias("b"), "at", "f", "t")
    parts = own.groupBy("part_id").agg(F.max(rank).alias("best"), F.collect_set(F.struct("f", "t")).alias("pairs"))  # at most (families + 1) * (tiers + 1) pairs
    parts = written(parts.select("part_id", F.col("best.f").alias("f"), F.col("best.t").alias("t"), "pairs"), "sample_parts")
    cells = {(r.f, r.t): r["count"] for r in parts.groupBy("f", "t").count().collect()}
    available = _available(parts, by_plan)

    drawn = _draw(spark, parts, cells, by_plan, sizes, seed)
    taken: dict[tuple, int] = defaultdict(int)
    moved: dict[tuple, int] = defaultdict(int)
    missed: dict[str, set[str]] = {}
    quota = []
    for plan, categories in by_plan.items():
        size = min(sizes.get(plan, 0), sum(cells.values()))
        expected = rake(cells, categories)
        missed[plan] = off_margins(expected, categories)
        take = repair({x: drawn.get((plan, *x), 0) for x in cells}, cells, expected, categories, size)
        for (f, t), k in take.items():
            if k > 0:
                share = min(1.0, k / cells[f, t])
                slack = 8 * math.sqrt(share * (1 - share) / cells[f, t]) + 8 / cells[f, t]
                quota.append((plan, f, t, k, max(0.0, share - slack), min(1.0, share + slack)))
            for c in categories:
                if c.holds((f, t)):
                    taken[plan, c.category_id] += k
                    moved[plan, c.category_id] += k - drawn.get((plan, f, t), 0)
    wanted = spark.createDataFrame(quota, "plan_id string, f string, t int, k long, lo double, hi double")
    keyed = parts.select("part_id", "f", "t", F.explode(F.array(*(F.lit(p).cast("string") for p in by_plan)) if by_plan else F.array().cast("array<string>")).alias("plan_id"))
    keyed = keyed.withColumn("key", 1 - _key_uniform(seed))  # within a cell all weights are equal, so this has the order of the exponential keys
    records = smallest(keyed, ["plan_id", "f", "t"], "key", "part_id", wanted).select("plan_id", "part_id", F.when(F.col("f") != OTHER_FAMILY, F.col("f")).alias("family"), F.when(F.col("t") != OTHER_TIER, F.col("t")).alias("tier"))

    needs: dict[tuple, float] = defaultdict(float)
    for plan, categories in by_plan.items():
        for c in categories:
            needs[plan, c.family is None, c.tier is None] += c.need
    of = {(plan, c.category_id): c for plan, categories in by_plan.items() for c in categories}
    lines = []
    for r in rows:
        c = of[r.plan_id, r.category_id]
        size, n = sizes.get(r.plan_id, 0), taken[r.plan_id, r.category_id]
        have, gap = available.get((r.plan_id, r.category_id), 0), max(0.0, c.need - n)
        if c.need > have:
            cause = "manifest"
        elif gap < 1:
            cause = "rounding" if gap else None
        elif needs[r.plan_id, c.family is None, c.tier is None] > size:
            cause = "plan"
        else:
            cause = "margins" if c.category_id in missed[r.plan_id] else "other"
        lines.append((r.plan_id, r.category_id, c.family, c.tier, c.need, have, c.share, n, n / size if size else None, gap, c.need > have, moved[r.plan_id, r.category_id], cause))
    return Sample(records, spark.createDataFrame(lines, REPORT))


def _key_uniform(seed: int) -> F.Column:
    return (F.shiftrightunsigned(F.xxhash64("part_id", "plan_id", F.lit(seed)), 11).cast("double") + 0.5) / F.lit(float(1 << 53))


def _available(parts: DataFrame, by_plan: dict[str, list[Category]]) -> dict[tuple, int]:
    """Distinct part_id of each category: every pair a part has rows for counts, a part once per category."""
    known = sorted({(c.family, c.tier) for cs in by_plan.values() for c in cs}, key=repr)
    if not known:
        return {}
    shape = parts.sparkSession.createDataFrame([(i, f, t) for i, (f, t) in enumerate(known)], "i int, cf string, ct int")
    pairs = parts.select("part_id", F.explode("pairs").alias("p")).select("part_id", "p.f", "p.t")
    kinds = pairs.groupBy("f", "t").count().drop("count")
    fits = kinds.join(F.broadcast(shape), (F.col("cf").isNull() | (F.col("cf") == F.col("f"))) & (F.col("ct").isNull() | (F.col("ct") == F.col("t"))))
    lists = F.broadcast(fits.groupBy("f", "t").agg(F.collect_list("i").alias("is")))  # as many rows as there are cells
    per_part = pairs.join(lists, ["f", "t"]).select("part_id", F.explode("is").alias("i")).distinct()
    n = {r.i: r["count"] for r in per_part.groupBy("i").count().collect()}
    by_shape = {s: n.get(i, 0) for i, s in enumerate(known)}
    return {(p, c.category_id): by_shape[c.family, c.tier] for p, cs in by_plan.items() for c in cs}


def _draw(spark: SparkSession, parts: DataFrame, cells: dict[tuple, int], by_plan: dict[str, list[Category]], sizes: dict[str, int], seed: int) -> dict[tuple, int]:
    """How many records of each (plan, family, tier) are among the plan's sample_rows smallest exponential keys -ln(u) / weight."""
    weights, wanted = [], []
    for plan, categories in by_plan.items():
        expected = {x: v for x, v in rake(cells, categories).items() if v > 0}
        k = min(sizes.get(plan, 0), sum(cells[x] for x in expected))
        rate = {x: v / cells[x] for x, v in expected.items()}
        if not k:
            continue
        weights += [(plan, *x, w) for x, w in rate.items()]
        lo, hi = 0.0, 1.0
        drawn = lambda at: sum(cells[x] * -math.expm1(-w * at) for x, w in rate.items())
        while drawn(hi) < k * (1 - 1e-12) and hi < 1e300:
            hi *= 2
        for _ in range(100):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if drawn(mid) < k else (lo, mid)
        slack = min(1.0, 6 / math.sqrt(k))
        wanted.append((plan, k, lo * (1 - slack), hi * (1 + 2 * slack)))
    if not wanted:
        return {}
    table = F.broadcast(spark.createDataFrame(weights, "plan_id string, f string, t int, w double"))
    keyed = parts.select("part_id", "f", "t").join(table, ["f", "t"]).withColumn("key", -F.log(_key_uniform(seed)) / F.col("w"))
    first = smallest(keyed.select("plan_id", "f", "t", "part_id", "key"), ["plan_id"], "key", "part_id", spark.createDataFrame(wanted, "plan_id string, k long, lo double, hi double"))
    return {(r.plan_id, r.f, r.t): r["count"] for r in first.groupBy("plan_id", "f", "t").count().collect()}
