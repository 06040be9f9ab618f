"""A corpus as tables: prefixes, tier caps, counts, shares, pivots and text aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_ordinal(df: DataFrame, order: str, buckets: int = 1000) -> DataFrame:
    """df with `ordinal` from 0 in the order of a unique whole number, without one sorted partition."""
    from gneiss.operators.dedup import running_accepts

    return running_accepts(df, F.lit(True), order, 1 << 62, buckets).withColumn("ordinal", F.col("accepts") - 1).drop("n_before", "accepts")


def prefix_slice(df: DataFrame, n: int | None, ordinal: str = "ordinal") -> DataFrame:
    """The first n rows by ordinal: a filter that is pushed to the scan, not a limit, so it may be followed by other filters."""
    return df if n is None else df.where(F.col(ordinal) < n)


def tier_cap(df: DataFrame, cap: int | None, tier: str = "tier") -> DataFrame:
    """Rows up to a tier; rows without one are dropped only if there is a cap."""
    return df if cap is None else df.where(F.col(tier) <= cap)


def with_id(df: DataFrame, key: str = "part_id") -> DataFrame:
    return df.where(F.col(key).isNotNull() & (F.col(key) != ""))


def shares(df: DataFrame, key: Column, name: str, order: str | None = None) -> DataFrame:
    """name, n, pct (one decimal), rank: groups by falling count, ties by first appearance in `order` (by name without one)."""
    first = F.min(order) if order else F.min(key)
    counts = df.groupBy(key.alias(name)).agg(F.count("*").alias("n"), first.alias("_first"))
    total = F.sum("n").over(Window.partitionBy())
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "_first")).cast("bigint")  # over one row per group
    return counts.withColumn("pct", F.bround(F.col("n") * 100 / F.greatest(total, F.lit(1)), 1)).withColumn("rank", rank).drop("_first")


def stats(df: DataFrame, family: str = "family", tier: str = "tier") -> DataFrame:
    """family, tier, n by grouping sets: one row per family, one per tier, and the total; which is told by `kind`."""
    rows = df.select(F.coalesce(F.col(family), F.lit("unknown")).alias("family"), F.coalesce(F.col(tier), F.lit(-1)).alias("tier"))
    sets = rows.groupingSets([["family"], ["tier"], []], "family", "tier").agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    kind = F.when(F.col("g") == 1, "family").when(F.col("g") == 2, "tier").otherwise("total")
    return sets.select(kind.alias("kind"), "family", "tier", "n")


def yield_report(df: DataFrame, bucket: str, ok: Column, flawed: Column) -> DataFrame:
    """bucket, total, ok, flawed, pct for each bucket, and for all in a row with null bucket."""
    counts = df.withColumn("_ok", F.coalesce(ok, F.lit(False))).withColumn("_bad", F.coalesce(flawed, F.lit(False))).rollup(bucket)
    out = counts.agg(F.count("*").alias("total"), F.count_if("_ok").alias("ok"), F.count_if("_bad").alias("flawed"))
    return out.withColumn("pct", F.col("ok") * 100.0 / F.greatest("total", F.lit(1)))


def run_counters(decisions: DataFrame) -> DataFrame:
    """One row: attempts, invalid, duplicates, accepted."""
    d = F.col("decision")
    return decisions.agg(F.count("*").alias("attempts"), F.count_if(d == "invalid").alias("invalid"), F.count_if(d == "duplicate").alias("duplicates"), F.count_if(d == "accepted").alias("accepted"))


def wide(df: DataFrame, key: str, column: Column, value: str, names: list[str]) -> DataFrame:
    """One row per key with a column for each of `names`; of several values the least is kept."""
    return df.groupBy(key).pivot("_c", names).agg(F.min(value)) if "_c" in df.columns else df.withColumn("_c", column).groupBy(key).pivot("_c", names).agg(F.min(value))


def joined_text(df: DataFrame, key: str, position: str, text: str, separator: str = " ") -> DataFrame:
    """key, text: the texts of a key in order of position; null and empty ones are left out."""
    parts = df.where(F.col(text).isNotNull() & (F.col(text) != "")).groupBy(key).agg(F.array_sort(F.collect_list(F.struct(position, text))).alias("_p"))
    return parts.select(key, F.array_join(F.transform("_p", lambda x: x[text]), separator).alias("text"))


def available_passes(files: DataFrame, canonical: list[str]) -> DataFrame:
    """One row `passes`: shaded, and each further pass that the first part (by id) has a file of, in canonical order."""
    first = files.agg(F.min("part_id").alias("part_id"))
    found = files.join(F.broadcast(first), "part_id").agg(F.collect_set("pass").alias("have"))
    return found.select(F.array_intersect(F.array(*map(F.lit, canonical)), F.array_union(F.array(F.lit("shaded")), "have")).alias("passes"))


def mesh_bounds(vertices: DataFrame, key: str = "part_id") -> DataFrame:
    """Per mesh: extents, the box's centre and the distance of the farthest vertex from it. Boxes and distances combine before the shuffle, so a large mesh makes no large group."""
    axes = ("x", "y", "z")
    box = vertices.groupBy(key).agg(*(f(a).alias(f"{n}_{a}") for a in axes for n, f in (("min", F.min), ("max", F.max))))
    box = box.select("*", *(((F.col(f"min_{a}") + F.col(f"max_{a}")) / 2).alias(f"centre_{a}") for a in axes))
    off = [F.col(a) - F.col(f"centre_{a}") for a in axes]
    far = vertices.select(key, *axes).join(box.select(key, *(f"centre_{a}" for a in axes)), key).groupBy(key).agg(F.sqrt(F.max(off[0] * off[0] + off[1] * off[1] + off[2] * off[2])).alias("radius"))
    return box.join(far, key)


def grouped_params(params: DataFrame) -> DataFrame:
    """part_id, grp, names, place: a part's parameters by display group, both in order of first appearance."""
    groups = params.groupBy("part_id", "grp").agg(F.array_sort(F.collect_list(F.struct("pos", "name"))).alias("_n"), F.min("pos").alias("_first"))
    place = F.row_number().over(Window.partitionBy("part_id").orderBy("_first"))
    return groups.select("part_id", "grp", F.array_join(F.transform("_n", lambda x: x["name"]), ", ").alias("names"), place.alias("place"))
