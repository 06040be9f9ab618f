"""Look-ups between a corpus and its side tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def missing_artifacts(parts: DataFrame, formats: list[str], existing: DataFrame) -> DataFrame:
    """part_id, format: artifacts still to be made (existing has part_id, format)."""
    wanted = parts.select("part_id", F.explode(F.array(*map(F.lit, formats))).alias("format"))
    return wanted.join(existing.select("part_id", "format"), ["part_id", "format"], "left_anti")


def parts_to_export(parts: DataFrame, formats: list[str], existing: DataFrame) -> DataFrame:
    """part_id of parts that lack any of the formats."""
    return missing_artifacts(parts, formats, existing).select("part_id").distinct()


def unknown_tags(requested: DataFrame, ladder: DataFrame) -> DataFrame:
    return requested.select("tag").join(ladder.select("tag"), "tag", "left_anti").distinct()


def ladder_rows(tags: DataFrame, ladder: DataFrame, parse: Column) -> DataFrame:
    """tag, count, seed of each tag; the count is read from the tag and the seed unknown where the ladder has none."""
    known = F.broadcast(ladder.select("tag", "count", F.col("seed").cast("string").alias("seed")))
    return tags.select("tag").join(known, "tag", "left").select("tag", F.coalesce("count", parse).alias("count"), F.coalesce("seed", F.lit("—")).alias("seed"))


def variant_grid(tags: DataFrame, slices: DataFrame, variants: DataFrame) -> DataFrame:
    """Each tag with each tier slice and content variant, and the name of the configuration."""
    grid = tags.crossJoin(F.broadcast(slices)).crossJoin(F.broadcast(variants))
    return grid.withColumn("config_name", F.concat("tag", "part", "suffix"))


def renormalised(weights: DataFrame, known: DataFrame, name: str = "family") -> DataFrame:
    """Weights of the known names, summing to 1."""
    kept = weights.join(known.select(name), name, "left_semi")
    return kept.crossJoin(F.broadcast(kept.agg(F.sum("weight").alias("_sum")))).select(name, (F.col("weight") / F.col("_sum")).alias("share"))


def weighted_choice(df: DataFrame, weights: DataFrame, u: Column, name: str = "family", order: str = "pos") -> DataFrame:
    """df with the name whose interval of the summed weights holds u (a number of [0, 1)); the table of weights is small."""
    rows = weights.orderBy(order).collect()
    total, edge, choice = sum(r["weight"] for r in rows), 0.0, F.when(F.lit(False), F.lit(None).cast("string"))
    for r in rows[:-1]:
        edge += r["weight"]
        choice = choice.when(u * total < edge, F.lit(r[name]))
    return df.withColumn(name, choice.otherwise(F.lit(rows[-1][name]) if rows else F.lit(None)))


def clamp_tier(tier: Column, lowest: Column, highest: Column) -> Column:
    return F.greatest(lowest, F.least(highest, tier))


def stale_tags(remote: DataFrame, built: DataFrame) -> DataFrame:
    """Distinct tags that are published but were not built, in order."""
    return remote.select("tag").distinct().join(built.select("tag"), "tag", "left_anti").orderBy("tag")


def forced(df: DataFrame, family: str | None = None, tier: int | None = None) -> DataFrame:
    """df with its family and tier replaced by those given."""
    out = df if family is None else df.withColumn("family", F.lit(family))
    return out if tier is None else out.withColumn("tier", F.lit(tier).cast("int"))


def picks(df: DataFrame, group: str, n: int, key: Column) -> DataFrame:
    """n rows of each group: those with the smallest key, such as a hash of id and seed. Tasks keep n rows of a group before the shuffle, so a large group is small work."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy("_key"))
    return df.withColumn("_key", key).withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_key", "_rank")
