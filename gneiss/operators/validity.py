"""Ordered validity rules over execution results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.functions.scalars import bbox_dims

MIN_VOLUME, MAX_BBOX_RATIO = 1.0, 20.0


def first_failure(*rules: tuple[Column, Column | str]) -> Column:
    """The reason of the first rule (condition of failure, reason) that holds, '' if none does; a null condition does not hold."""
    out = F.lit("")
    for failed, reason in reversed(rules):
        out = F.when(failed, reason if isinstance(reason, Column) else F.lit(reason)).otherwise(out)
    return out


def invalid_reason(min_volume: float = MIN_VOLUME, max_ratio: float = MAX_BBOX_RATIO) -> Column:
    """Why a result is no valid part, '' if it is: failed run, several solids, too small, flat box, too long for its width.

    NaN passes the tests of volume and ratio, as every comparison with it is false.
    """
    dims = bbox_dims("bbox")
    longest, shortest = F.array_max(dims), F.array_min(dims)
    ratio = longest / F.when(shortest > 0, shortest)
    return first_failure(
        (~F.coalesce(F.col("success"), F.lit(False)), F.concat(F.lit("execution failed: "), F.coalesce("error", F.lit("missing execution result")))),
        (F.coalesce("n_solids", F.lit(0)) != 1, "disconnected geometry"),
        (F.col("volume").isNull() | (~F.isnan("volume") & (F.col("volume") < min_volume)), "volume too small"),
        (F.exists(dims, lambda d: d.isNull() | (~F.isnan(d) & (d <= 0))), "degenerate bounding box"),
        (~F.isnan(ratio) & (ratio > max_ratio), "extreme aspect ratio"),
    )


def with_validity(results: DataFrame, min_volume: float = MIN_VOLUME, max_ratio: float = MAX_BBOX_RATIO) -> DataFrame:
    """results with `reason` and `valid`."""
    marked = results.withColumn("reason", invalid_reason(min_volume, max_ratio))
    return marked.withColumn("valid", F.col("reason") == "")


def attempts_with_results(attempts: DataFrame, results: DataFrame, key: str = "attempt") -> DataFrame:
    """Every attempt with its result; one without is a failed run, error 'missing execution result'."""
    joined = attempts.join(results, key, "left")
    return joined.withColumn("error", F.when(F.col("success").isNull(), F.lit("missing execution result")).otherwise(F.col("error"))).withColumn("success", F.coalesce("success", F.lit(False)))


def first_errors(marked: DataFrame, order: list[str], n: int = 25, reason: str = "reason") -> DataFrame:
    """The first n rows in order that have a reason: each task keeps its own first n."""
    return marked.where(F.col(reason) != "").orderBy(*order).limit(n)
