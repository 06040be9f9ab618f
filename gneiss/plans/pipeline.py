"""The corpus pipeline: decide attempts in order, extend a corpus, annotate it, plan exports and publish slices."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.functions.scalars import content_hash, signature, signature_json
from gneiss.operators.corpus import run_counters, shares
from gneiss.operators.dedup import first_wins, running_accepts
from gneiss.operators.validity import MAX_BBOX_RATIO, MIN_VOLUME, attempts_with_results, with_validity
from gneiss.session import written
from gneiss.sources.manifest import attempts as attempt_range
from gneiss.sources.sinks import TIER_SLICES, VARIANTS, packed, write_jsonl, write_parquet


def decide(results: DataFrame, min_volume: float = MIN_VOLUME, max_ratio: float = MAX_BBOX_RATIO, order: str = "attempt") -> DataFrame:
    """Execution results with reason, signature and decision (invalid, duplicate, accepted): the first valid attempt of each signature is accepted."""
    marked = with_validity(results, min_volume, max_ratio)
    sig = signature("volume", "surface_area", "principal_moments", "n_faces", "n_edges", "n_vertices")
    marked = marked.withColumn("geometry_signature", F.when(F.col("valid"), sig))
    return first_wins(marked, [F.col("geometry_signature")], [order], F.col("valid"))


@dataclass
class Corpus:
    """An accepted prefix of the attempt stream and the cursor from which to go on."""

    records: DataFrame
    accepted: int
    attempted: int


def generate(spark: SparkSession, execute: Callable[[DataFrame], DataFrame], seed: int, count: int, known: Corpus | None = None, window: int = 1000, stop_early: bool = True) -> Corpus:
    """Accepts attempts in order until there are `count`, in growing windows of the stream; `known` is the corpus to extend.

    execute maps (attempt, part_seed) to execution results. Extending gives the same records as starting afresh, since a window's attempts are decided
    against all signatures accepted before. The run ends early, right after an accept, if over 10 * count attempts gave under count // 2.
    """
    accepted, attempted, kept = (known.accepted, known.attempted, known.records) if known else (0, 0, None)
    while accepted < count:
        need = count - accepted
        size = max(window, need + need // 3 + window)
        todo = attempt_range(spark, attempted, attempted + size, seed)
        results = attempts_with_results(todo, execute(todo), "attempt")
        if kept is not None:
            old = kept.select(signature_json("geometry_signature").alias("s")).distinct()
        decided = written(decide(results), "decided")
        if kept is not None:
            new = decided.withColumn("s", signature_json("geometry_signature")).join(old.withColumn("known", F.lit(True)), "s", "left")
            seen = F.coalesce("known", F.lit(False)) & (F.col("decision") == "accepted")
            decided = new.withColumn("decision", F.when(seen, "duplicate").otherwise(F.col("decision"))).drop("s", "known")
        ok = F.col("decision") == "accepted"
        taken = written(running_accepts(decided, ok, "attempt", need), "taken")
        poor = (F.col("attempt") + 1 > 10 * count) & (F.col("accepts") + accepted < count // 2) & ok
        stop = taken.where(poor).agg(F.min("attempt")).first()[0] if stop_early else None
        if stop is not None:
            taken = taken.where(F.col("attempt") <= stop)
        fresh = taken.where(ok).drop("n_before", "accepts")
        kept = fresh if kept is None else kept.unionByName(fresh, allowMissingColumns=True)
        got = fresh.count()
        # Without the last accept the whole window has been decided; with it, only what came before.
        attempted = (taken.agg(F.max("attempt")).first()[0] + 1) if got == need or stop is not None else attempted + size
        accepted += got
        if stop is not None:
            break
    return Corpus(kept, accepted, attempted)


def may_extend(state: dict | None, seed: int, version: str, force: bool = False) -> None:
    """Refuses to extend a corpus of another seed or version, unless forced."""
    if state and not force and (state.get("seed") != seed or state.get("generator_version") != version):
        raise ValueError(f"the corpus has seed {state.get('seed')} and version {state.get('generator_version')}")


def next_step(state: dict | None, count: int, version: str) -> str:
    """build, rebuild (another version), reuse (enough records) or extend."""
    if state is None:
        return "build"
    if state.get("generator_version") != version:
        return "rebuild"
    return "reuse" if state.get("accepted", 0) >= count else "extend"


def annotate(manifest: DataFrame, derived: DataFrame) -> DataFrame:
    """Records with newly derived text and descriptor (derived: part_id, canon, dimensions, descriptor); others stay as they are, `mismatch` true.

    canon is the canonical form whose hash must be the record's: a record whose content would come out otherwise keeps its old
    text. Geometry and paths are kept in any case.
    """
    new = derived.select("part_id", content_hash("canon").alias("_hash"), F.col("dimensions").alias("_dimensions"), F.col("descriptor").alias("_descriptor"))
    joined = manifest.join(new, "part_id", "left").withColumn("mismatch", ~F.col("ir_hash").eqNullSafe(F.col("_hash")))
    for c in ("dimensions", "descriptor"):
        joined = joined.withColumn(c, F.when(F.col("mismatch"), F.col(c)).otherwise(F.col(f"_{c}")))
    return joined.drop("_hash", "_dimensions", "_descriptor")


def publish(manifest: DataFrame, ladder: list[tuple[str, int | None]], folder: str, *, sources: DataFrame | None = None, params: DataFrame | None = None, variants: list[tuple] = VARIANTS, artifacts: dict[str, DataFrame] | None = None, dry_run: bool = False) -> list[dict]:
    """Packs each (tag, count), tier slice and variant of one base corpus, and returns the configurations made.

    The joined base is written once; a slice is a filter on its ordinal and tier. A slice without rows leaves no file and no configuration.
    """
    artifacts = artifacts or {}
    need = {"renders": 1, "stl": 2, "step": 3}
    base = written(packed(manifest, sources=sources, params=params), "publish_base")
    text = written(packed(manifest, sources=sources, params=params, as_text=True), "publish_text")
    built = []
    for tag, limit in ladder:
        for subdir, part, cap in TIER_SLICES:
            for variant in variants:
                wanted = [k for k, i in need.items() if variant[i]]
                if any(k not in artifacts for k in wanted):
                    continue
                rows = base if not wanted else text
                rows = rows.where(F.col("ordinal") < limit) if limit is not None else rows
                rows = rows.where(F.col("tier") <= cap) if cap is not None else rows
                for k in wanted:
                    rows = rows.join(artifacts[k], "part_id", "left")
                name = f"{tag}{part}{variant[0]}"
                path = "/".join(x for x in (folder, tag, subdir, name) if x)
                if rows.isEmpty():
                    continue
                if not dry_run:
                    write_parquet(rows, path) if wanted else write_jsonl(rows, path)
                built.append({"config_name": name, "data_file": path, **{k: k in wanted for k in need}})
    return built


def corpus_report(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(counters, shares of the accepted by family) of decided results."""
    decided = written(decide(results), "decided")
    return run_counters(decided), shares(decided.where("decision = 'accepted'"), F.coalesce("family", F.lit("unknown")), "family", "attempt")
