"""First-wins removal of duplicates in a declared order."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gneiss.session import written


def first_wins(df: DataFrame, key: list[Column], order: list[str], valid: Column | None = None) -> DataFrame:
    """df with `decision`: accepted, duplicate or invalid.

    Of the valid rows that share a key the first in order is accepted. Invalid rows register nothing. Rows that tie in key and order are told apart by
    all their columns; of rows that are equal in these too one is accepted and the others are duplicates. The first of each key and its number of copies are found by aggregations that combine before the shuffle, and the
    decision by a join with these, so a key that a third of all rows share makes no large group. First places are a written table: what is decided does not change if it is worked out again.
    """
    ok = F.lit(True) if valid is None else F.coalesce(valid, F.lit(False))
    digest = F.xxhash64(*[F.to_json(F.struct(c)) if t.startswith("map") else F.col(c) for c, t in df.dtypes])
    rows = df.withColumn("_key", F.struct(*(k.alias(f"k{i}") for i, k in enumerate(key)))).withColumn("_place", F.struct(*order, digest.alias("_digest"))).withColumn("_ok", ok)
    places = rows.where("_ok").groupBy("_key", "_place").agg(F.count("*").alias("_copies"))
    firsts = written(places.groupBy(F.col("_key").alias("_first_key")).agg(F.min(F.struct("_place", "_copies")).alias("_f")), "first_places")
    marked = rows.join(firsts.select("_first_key", "_f.*").withColumnRenamed("_place", "_first"), F.col("_ok") & F.col("_key").eqNullSafe(F.col("_first_key")), "left")
    first = F.coalesce(F.col("_place") == F.col("_first"), F.lit(False))
    decided = marked.withColumn("decision", F.when(~F.col("_ok"), "invalid").when(first, "accepted").otherwise("duplicate"))
    if firsts.where("_f._copies > 1").isEmpty():
        return decided.select(*df.columns, "decision")
    copied = first & (F.col("_copies") > 1)
    one = marked.where(copied).groupBy("_first_key").agg(F.any_value(F.struct(*df.columns)).alias("_row"), F.any_value("_copies").alias("_copies"))
    block = 10_000  # copies are counted out in blocks
    blocks = one.select("_row", "_copies", F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / block))).alias("_b"))
    copies = blocks.select("_row", F.explode(F.sequence(F.col("_b") * block + 1, F.least(F.col("_copies"), (F.col("_b") + 1) * block))).alias("_c"))
    return decided.where(~copied | F.col("_copies").isNull()).select(*df.columns, "decision").unionByName(copies.select("_row.*", F.when(F.col("_c") == 1, "accepted").otherwise("duplicate").alias("decision")))


def accepted_firsts(df: DataFrame, key: list[Column], order: list[str]) -> DataFrame:
    """One row per key: the first in order; no join, for when the rejected rows are not wanted."""
    fields = [F.col(c) for c in df.columns]
    rest = F.struct(*fields) if not any(t.startswith("map") for _, t in df.dtypes) else None
    if rest is None:
        return first_wins(df, key, order).where("decision = 'accepted'").drop("decision")
    best = df.groupBy(*(k.alias(f"_k{i}") for i, k in enumerate(key))).agg(F.min_by(rest, F.struct(*order, F.xxhash64(*fields))).alias("_row"))
    return best.select("_row.*")


def greedy_two_keys(df: DataFrame, order: list[str], first_key: str, second_key: str, rounds: int = 50) -> DataFrame:
    """df with `accepted`: rows in order, each accepted if neither of its keys belongs to a row accepted before it.

    The keys are independent, so whether a row counts depends on rows before it. It is settled in rounds without a global order: a row that is first
    among the open ones for both its keys is accepted, and every later row that shares a key with it falls out. Rows must be unique in order. Null keys
    match nothing. What is still open after `rounds` (long chains of shared keys) is settled by one pass over those rows in order.
    """
    place = F.struct(*order)
    open_rows = written(df.select(place.alias("p"), F.col(first_key).alias("a"), F.col(second_key).alias("b")), "greedy")
    won: DataFrame | None = None
    for _ in range(rounds):
        first_a = open_rows.where("a is not null").groupBy("a").agg(F.min("p").alias("pa"))
        first_b = open_rows.where("b is not null").groupBy("b").agg(F.min("p").alias("pb"))
        marked = open_rows.join(first_a, "a", "left").join(first_b, "b", "left")
        now = written(marked.where((F.col("pa").isNull() | (F.col("pa") == F.col("p"))) & (F.col("pb").isNull() | (F.col("pb") == F.col("p")))).select("p", "a", "b"), "greedy_won")
        if now.isEmpty():
            break
        won = now if won is None else won.unionByName(now)
        left = open_rows.join(now.select("a").dropna(), "a", "left_anti").join(now.select("b").dropna(), "b", "left_anti").join(now.select("p"), "p", "left_anti")
        open_rows = written(left.select("p", "a", "b"), "greedy")
    if won is not None and not open_rows.isEmpty():
        won = won.unionByName(_in_order(open_rows))
    if won is None:
        return df.withColumn("accepted", F.lit(False))
    return df.withColumn("_p", place).join(won.select(F.col("p").alias("_p"), F.lit(True).alias("accepted")), "_p", "left").drop("_p").withColumn("accepted", F.coalesce("accepted", F.lit(False)))


def _in_order(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen_a: set = set()
        seen_b: set = set()
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                good = a not in seen_a and b not in seen_b
                keep.append(good)
                if good:
                    seen_a |= {a} - {None}
                    seen_b |= {b} - {None}
            yield batch.filter(pa.array(keep, pa.bool_()))

    return rows.coalesce(1).sortWithinPartitions("p").mapInArrow(run, rows.schema)


def mark_duplicates(df: DataFrame, key: list[Column], order: list[str], valid: Column) -> DataFrame:
    """df with `status` ok, FAIL or DUP: validity first, then duplicates among the valid; a null key is the empty key and shared."""
    marked = first_wins(df, [F.coalesce(k.cast("string"), F.lit("")) for k in key], order, valid)
    return marked.withColumn("status", F.when(F.col("decision") == "invalid", "FAIL").when(F.col("decision") == "duplicate", "DUP").otherwise("ok")).drop("decision")


def not_seen(df: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows none of whose keys is among those seen: an anti join per key."""
    for k in keys:
        df = df.join(seen.select(k).dropna().distinct(), k, "left_anti")
    return df


def running_accepts(df: DataFrame, accepted: Column, order: str, limit: int, buckets: int = 1000) -> DataFrame:
    """df with `n_before` and `accepts`: rows and accepted rows up to and including each, in order of a whole number; rows after the limit-th accept are dropped.

    Running counts over all rows need no single sorted partition: rows are counted by range of the order, the ranges' totals
    are summed up, and ranks are taken within each range. The ranges' edges are quantiles of the order (of equal rank, to a tenth of a range), so outliers do not crowd
    the other rows into one range. Rows without order are in none and are dropped.
    """
    edges = df.agg(F.percentile_approx(order, [i / buckets for i in range(1, max(2, buckets))], 10 * buckets).alias("e")).first()["e"]
    if edges is None:
        return df.withColumn("n_before", F.lit(0).cast("bigint")).withColumn("accepts", F.lit(0).cast("bigint")).limit(0)
    splits = [-math.inf, *sorted(set(map(float, edges if buckets > 1 else [0.0]))), math.inf]  # a value's range is found by bisection; large whole numbers that are one double share a range
    placed = Bucketizer(splits=splits, inputCol="_at", outputCol="_range").transform(df.where(F.col(order).isNotNull()).withColumn("_at", F.col(order).cast("double"))).drop("_at")
    rows = placed.withColumn("_ok", F.coalesce(accepted, F.lit(False)).cast("bigint"))
    totals = rows.groupBy("_range").agg(F.count("*").alias("n"), F.sum("_ok").alias("k"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # over at most `buckets` rows
    offsets = totals.select("_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_n"), F.coalesce(F.sum("k").over(before), F.lit(0)).alias("_k"))
    within = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    counted = rows.join(F.broadcast(offsets.where(F.col("_k") < limit)), "_range")
    counted = counted.withColumn("n_before", F.col("_n") + F.count("*").over(within)).withColumn("accepts", F.col("_k") + F.sum("_ok").over(within))
    return counted.where((F.col("accepts") < limit) | ((F.col("accepts") == limit) & (F.col("_ok") == 1))).drop("_range", "_ok", "_n", "_k")

