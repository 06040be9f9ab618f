"""Pairs of the members of a group, for results that are defined as pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.session import written


def pairs_within(df: DataFrame, key: str, item: str, block: int = 2000) -> DataFrame:
    """Every pair (a, b), a < b, of distinct items that share a key; once, if an item has one key only.

    Groups above `block` items are cut into blocks, and each pair of blocks is a join key of its own, so that the work
    on one hot key spreads over many tasks. Null keys and items are in no pair; repeated rows count once; an empty input gives
    no rows. The result holds just the columns a and b.
    """
    rows = written(df.select(F.col(key).alias("k"), F.col(item).alias("i")).dropna().distinct(), "pair_rows")
    sizes = rows.groupBy("k").count().where("count > 1")
    rows = rows.join(sizes, "k").withColumn("blocks", F.ceil(F.col("count") / block).cast("int"))
    rows = rows.withColumn("b", F.pmod(F.xxhash64("i"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o")
    sides = rows.select("k", "i", "b", other).select("k", "i", "b", F.least("b", "o").alias("lo"), F.greatest("b", "o").alias("hi"))
    x = sides.select("k", "lo", "hi", F.col("i").alias("i1"), F.col("b").alias("b1"))
    y = sides.select("k", "lo", "hi", F.col("i").alias("i2"), F.col("b").alias("b2"))
    joined = x.join(y, ["k", "lo", "hi"]).where("(b1 = lo and b2 = hi) and (lo < hi or i1 < i2)")
    return joined.select(F.least("i1", "i2").alias("a"), F.greatest("i1", "i2").alias("b"))
