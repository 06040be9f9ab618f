"""Near-duplicate records with small edits: a T-occurrence search over the records' elements with DivideSkip.

A record is a set of elements. Two records are near-duplicates if common / distinct elements >= threshold, so they
share at least T = ceil(threshold * size of the larger). Records that share T elements share one of the `size - T + 1` rarest of each, so a
record is sent to the inverted lists of these elements only; in each such group the T-occurrence problem is solved by
merging short lists with a heap and probing long ones.
"""

from __future__ import annotations

import heapq
import json
import math
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from fractions import Fraction

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.operators.pairs import pairs_within
from gneiss.session import written
from gneiss.sources.params_text import params_literal

_STRING = re.compile(r'"[^"\n]*"|\'[^\'\n]*\'')
_BLANK = re.compile(r'("[^"\n]*"|\'[^\'\n]*\')|#[^\n]*|[^\S\n]+')


def parse_params(text: str) -> dict | None:
    """The dict of a `PARAMS = {...}` literal, numbers as floats; None if the text is not complete."""
    return params_literal(text, whole=True, numbers=float)


def build_statements(text: str) -> list[str] | None:
    """Statements between the def line and `return result`, without blanks and comments, in double quotes; None if not complete."""
    text = text.replace("\r", "\n")
    strings = "".join(_STRING.findall(text))
    if "#" in strings or " " in strings or "\t" in strings:
        text = _BLANK.sub(r"\1", text)
        lines = text.split("\n")
    else:
        lines = [x.partition("#")[0] for x in text.replace(" ", "").replace("\t", "").split("\n")]
    lines = [x.strip().replace("'", '"') for x in lines]
    lines = [x for x in lines if x]
    if len(lines) < 2 or not lines[0].replace(" ", "").startswith("defbuild(") or lines[-1].replace(" ", "") != "returnresult":
        return None
    return lines[1:-1]


def source_elements(params: str | None, build: str | None) -> list[int] | None:
    """64-bit numbers of a source's elements: the entries of PARAMS with their specs, and the statements; None if incomplete."""
    if params is None or build is None:
        return None
    entries = parse_params(params)
    statements = build_statements(build) if entries is not None else None
    if statements is None:
        return None
    digest = xxhash.xxh3_64_intdigest
    out = {digest(x) for x in statements}
    for key, spec in entries.items():
        text = repr(sorted(spec.items())) if isinstance(spec, dict) and all(type(v) in (str, float, bool) for v in spec.values()) else json.dumps(spec, sort_keys=True, default=repr)
        out.add(digest(f"{key!r}\0{text}"))
    return sorted(x - (1 << 63) for x in out)


def element_sets(rows: DataFrame, extract: Callable[..., list[int] | None], record: str, *fields: str) -> DataFrame:
    """(id, els): each record's distinct elements, sorted. Rows with a null id or for which extract gives None take no part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [extract(*x) for x in zip(*(batch.column(k).to_pylist() for k in range(1, batch.num_columns)))]
            out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["id", "els"])
            yield out.filter(out.column(1).is_valid())

    picked = rows.select(F.col(record).cast("string").alias("id"), *(F.col(c).alias(f"f{i}") for i, c in enumerate(fields))).where("id is not null")
    one = picked.mapInArrow(run, "id string, els array<bigint>")
    return one.groupBy("id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("els")))).alias("els")).where("size(els) > 0")


def divide_skip(group: list[tuple[int, list[int]]], threshold: Fraction) -> Iterator[tuple[int, int]]:
    """Positions (i, j) of all pairs of a group with similarity >= threshold.

    group: (size, elements) of each record; the size also counts elements that no other record has and that are
    left out of the list. The larger record of a pair is the query, of which T elements
    must be shared. Of a query's inverted lists the L longest are set aside, L by the heuristic of DivideSkip but under T;
    the others are merged with a heap, and a record met at least T - L times is looked up in the long ones by bisection.
    """
    num, den = threshold.numerator, threshold.denominator
    order = sorted(range(len(group)), key=lambda i: group[i][0])
    lists: dict[int, list[int]] = {}
    for rank, i in enumerate(order):
        size, query = group[i]
        need = -(-num * size // den)
        mine = sorted((lists[e] for e in query if e in lists), key=len)
        if len(mine) >= need:
            longest = len(mine[-1])
            skip = min(need - 1, int(need / (0.01 * math.log(longest) + 1)) if longest > 4 else 0)
            short, long = mine[: len(mine) - skip], mine[len(mine) - skip :]
            heap = [(x[0], k, 0) for k, x in enumerate(short)]
            heapq.heapify(heap)
            while heap:
                candidate, count = heap[0][0], 0
                while heap and heap[0][0] == candidate:
                    _, k, at = heap[0]
                    count += 1
                    if at + 1 < len(short[k]):
                        heapq.heapreplace(heap, (short[k][at + 1], k, at + 1))
                    else:
                        heapq.heappop(heap)
                if count < need - skip:
                    continue
                for x in reversed(long):
                    at = bisect_left(x, candidate)
                    count += at < len(x) and x[at] == candidate
                if count * den >= num * (size + group[order[candidate]][0] - count):
                    yield i, order[candidate]
        for e in query:
            lists.setdefault(e, []).append(rank)


def similar_classes(classes: DataFrame, threshold: float = 0.7, block: int = 1000) -> DataFrame:
    """(a, b), a < b: classes (columns cls, els) whose element sets have a Jaccard similarity of at least `threshold`.

    No cap on list lengths: an element's group of more than `block` records is cut into blocks, and each pair of blocks is a
    task's unit of its own. Elements that no other record has are counted but never sent.
    """
    exact = Fraction(str(threshold))
    els = classes.select("cls", F.size("els").alias("n"), F.explode("els").alias("e"))
    known = els.groupBy("e").count().where("count > 1").withColumnRenamed("count", "df")
    ordered = els.join(known, "e").groupBy("cls", "n").agg(F.transform(F.array_sort(F.collect_list(F.struct("df", "e"))), lambda x: x["e"]).alias("els"))
    need = F.ceil(F.col("n") * exact.numerator / exact.denominator - 1e-9).cast("int")
    able = ordered.withColumn("need", need).where("size(els) >= need")
    able = written(able.withColumn("send", F.slice("els", 1, F.size("els") - F.col("need") + 1)), "ordered_elements")
    sent = able.select("cls", "n", "els", F.posexplode("send").alias("at", "e"))
    groups = able.select(F.explode("send").alias("e")).groupBy("e").count().where("count > 1").withColumn("blocks", F.ceil(F.col("count") / block).cast("int"))
    sent = sent.join(groups.select("e", "blocks"), "e").withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    single = sent.where("blocks = 1").withColumn("lo", F.lit(0)).withColumn("hi", F.lit(0))
    cut = sent.where("blocks > 1").withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.withColumn("lo", F.least("own", "o")).withColumn("hi", F.greatest("own", "o")).drop("o")
    spread = single.unionByName(cut).select("e", "lo", "hi", "own", "cls", "n", "els", "at")
    sorted_groups = spread.repartition("e", "lo", "hi").sortWithinPartitions("e", "lo", "hi")
    return sorted_groups.mapInArrow(_search(exact), "a binary, b binary")


def _search(threshold: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            x = batch.to_pydict()
            out: list[tuple[bytes, bytes]] = []
            for row in zip(x["e"], x["lo"], x["hi"], x["own"], x["cls"], x["n"], x["els"], x["at"]):
                if row[:3] != key:
                    out += _pairs_of(key, rows, threshold)
                    key, rows = row[:3], []
                rows.append(row[3:])
            if out:
                yield _as_batch(out)
        if out := _pairs_of(key, rows, threshold):
            yield _as_batch(out)

    return run


def _as_batch(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*pairs)], names=["a", "b"])


def _pairs_of(key: tuple | None, rows: list[tuple], threshold: Fraction) -> list[tuple[bytes, bytes]]:
    """Pairs of one element's group (or pair of blocks of it) that no rarer common element's group has."""
    if len(rows) < 2:
        return []
    e, lo, hi = key
    out = []
    group = [(n, els) for _, _, n, els, _ in rows]
    for i, j in divide_skip(group, threshold):
        own1, c1, _, els1, at1 = rows[i]
        own2, c2, _, els2, at2 = rows[j]
        if {own1, own2} == {lo, hi} and c1 != c2 and not set(els1[:at1]) & set(els2[:at2]):
            out.append((min(c1, c2), max(c1, c2)))
    return out


def near_duplicates(rows: DataFrame, record: str = "part_id", params: str = "params", build: str = "build", threshold: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """(members, links) of sources that share `threshold` of their elements.

    members(id, cls): each record that takes part and its class of equal element sets. links(a, b): pairs of different classes, a < b, that are
    similar; a record of one is a near-duplicate of each record of the other. Rows with a null id, null or incomplete
    texts, or no element at all take no part; rows of one id are one record with the elements of all; other columns
    are ignored; an empty table gives empty results.
    """
    sets = element_sets(rows.select(record, params, build), source_elements, record, params, build)
    digest = F.unhex(F.sha2(F.to_json("els"), 256)).substr(1, 16)
    members = written(sets.withColumn("cls", digest), "element_sets")
    classes = members.groupBy("cls").agg(F.first("els").alias("els"))
    return members.select("id", "cls"), similar_classes(classes, threshold)


def duplicate_pairs(members: DataFrame, links: DataFrame, block: int = 2000) -> DataFrame:
    """All pairs of records, smaller id first, of a class or of two linked classes: columns a, b.

    Linked classes of which one has more than `block` records are cut into blocks, and each pair of blocks is a join key of its own, so that two classes that
    each hold a third of all rows spread over many tasks.
    """
    pair = (F.least("i1", "i2").alias("a"), F.greatest("i1", "i2").alias("b"))
    left, right = members.select(F.col("cls").alias("a"), F.col("id").alias("i1")), members.select(F.col("cls").alias("b"), F.col("id").alias("i2"))
    big = written(members.groupBy("cls").count().where(F.col("count") > block), "large_classes")
    if big.isEmpty():
        return links.join(left, "a").join(right, "b").select(*pair).unionByName(pairs_within(members, "cls", "id", block))
    blocks = lambda c: big.select(F.col("cls").alias(c), F.ceil(F.col("count") / block).cast("int").alias(f"n{c}"))
    sized = links.join(blocks("a"), "a", "left").join(blocks("b"), "b", "left").fillna(1, ["na", "nb"])
    across = sized.where("na = 1 and nb = 1").select("a", "b").join(left, "a").join(right, "b").select(*pair)
    cut = sized.where("na > 1 or nb > 1")
    own = lambda i, n: F.pmod(F.xxhash64(i), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    x = cut.join(left, "a").select("a", "b", "i1", own("i1", "na").alias("ba"), every("nb").alias("bb"))
    y = cut.join(right, "b").select("a", "b", "i2", own("i2", "nb").alias("bb"), every("na").alias("ba"))
    return across.unionByName(x.join(y, ["a", "b", "ba", "bb"]).select(*pair)).unionByName(pairs_within(members, "cls", "id", block))


def duplicate_groups(members: DataFrame, links: DataFrame) -> DataFrame:
    """(id, cls, links): each record with its class, and the number of other classes that are near-duplicates of it."""
    both = links.select(F.col("a").alias("cls")).unionByName(links.select(F.col("b").alias("cls"))).groupBy("cls").count()
    return members.join(both, "cls", "left").select("id", F.lower(F.hex("cls")).alias("cls"), F.coalesce("count", F.lit(0)).alias("links"))
