"""Sinks: manifests, packed variants, cards and configuration text."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.functions.scalars import signature_json
from gneiss.operators.corpus import prefix_slice, tier_cap, with_id
from gneiss.session import delete_path

# Columns of the packed tables and the views and passes of renders.
BASE_COLUMNS = [("part_id", "string"), ("family", "string"), ("tier", "int32"), ("seed", "int64"), ("symmetry", "string"), ("op_count", "int32"), ("ir_hash", "string"), ("generator_version", "string"), ("license", "string"), ("geometry_signature", "string"), ("dimensions", "string"), ("source", "string"), ("params", "string")]
VIEWS = ["front", "top", "right", "iso", "iso_fr", "iso_fl", "iso_br", "iso_bl"]
VIEW_SETS = {"all": VIEWS, "iso-corners": ["iso_fr", "iso_fl", "iso_br", "iso_bl"], "ortho": ["front", "top", "right"], "cad": ["front", "top", "right", "iso"]}
PASSES = ["shaded", "normal", "depth", "edge"]
VARIANTS = [("", False, False, False), ("-renders", True, False, False), ("-stl", False, True, False), ("-step", False, False, True), ("-geo", True, True, False), ("-full", True, True, True)]
TIER_SLICES = [("", "", None), ("tier0-2", "-t0-2", 2)]
DEFAULT_LICENSE = "CC0-1.0"


def resolve_views(wanted: str | None) -> list[str]:
    """A set's views, or those of a comma-separated list in its order; all if none is given; an unknown one is an error."""
    chosen = VIEW_SETS.get((wanted or "all").strip().lower()) or [v.strip() for v in wanted.split(",") if v.strip()]
    if bad := set(chosen) - set(VIEWS):
        raise ValueError(f"unknown views: {sorted(bad)}")
    return list(chosen)


def resolve_passes(wanted: str | None) -> list[str]:
    """Passes of a comma-separated list, once each and in canonical order; shaded if none is given; an unknown one is an error."""
    chosen = {p.strip().lower() for p in (wanted or "shaded").split(",") if p.strip()}
    if bad := chosen - set(PASSES):
        raise ValueError(f"unknown passes: {sorted(bad)}")
    return [p for p in PASSES if p in chosen]


def resolve_formats(wanted: list[str], known: list[str]) -> list[str]:
    """The known formats among those wanted, in order; an unknown one is an error."""
    if bad := set(wanted) - set(known):
        raise ValueError(f"unknown formats: {sorted(bad)}")
    return [f for f in dict.fromkeys(wanted)]


def render_columns(views: list[str], passes: list[str]) -> list[tuple[str, str]]:
    """(column, file name) of each view and pass, view by view; the shaded pass has the bare name."""
    named = [v if p == "shaded" else f"{v}_{p}" for v in views for p in passes]
    return [(f"render_{x}", f"{x}.png") for x in named]


def active_variants(renders: bool = True, stl: bool = True, step: bool = True) -> list[tuple]:
    """Variants that need nothing that is switched off."""
    allowed = (renders, stl, step)
    return [v for v in VARIANTS if all(a or not need for a, need in zip(allowed, v[1:]))]


def _version(columns: list[str]) -> Column:
    own = F.when(F.col("generator_version") != "", F.col("generator_version"))
    return F.coalesce(own, F.col("legacy_version")) if "legacy_version" in columns else F.coalesce(own, F.lit(None).cast("string"))


def packed(manifest: DataFrame, *, limit: int | None = None, tier_max: int | None = None, sources: DataFrame | None = None, params: DataFrame | None = None, as_text: bool = False, license_known: Column | None = None) -> DataFrame:
    """Rows of a packed variant: the prefix first, then rows with an id, then the tier cap; sources and params are joined by the record's own `paths` (py and params) if they have a column
    path (path, text; one row a path), else by id (name, text).

    manifest needs `ordinal`. as_text gives signature, dimensions and params as text (the Parquet form) instead of structs.
    A licence that is absent defaults; license_known tells rows where a null one is present and stays null.
    """
    rows = tier_cap(with_id(prefix_slice(manifest, limit)), tier_max)
    licence = F.coalesce("license", F.lit(DEFAULT_LICENSE)) if license_known is None else F.when(license_known, F.col("license")).otherwise(DEFAULT_LICENSE)
    sig, dims = ("geometry_signature", "dimensions") if not as_text else (signature_json("geometry_signature"), F.col("dimensions.text"))
    out = rows.select(
        "ordinal", "part_id", "family", F.col("tier").cast("int"), F.col("seed").cast("bigint"), "symmetry", F.col("op_count").cast("int"), "ir_hash", _version(manifest.columns).alias("generator_version"),
        licence.alias("license"), (F.col(sig) if isinstance(sig, str) else sig).alias("geometry_signature"), (F.col(dims) if isinstance(dims, str) else dims).alias("dimensions"),
        *([F.col("paths").alias("_paths")] if "paths" in rows.columns else []),
    )
    at = {"source": "py", "params": "params"}
    sides = {name: side for name, side in (("source", sources), ("params", params)) if side is not None}
    for name in [n for n, side in sides.items() if "path" in side.columns]:
        out = out.withColumn(f"_{name}", F.col("_paths")[at[name]])
    for name, side in sides.items():
        if "path" in side.columns:
            out = out.join(side.select(F.col("path").alias(f"_{name}"), F.col("text").alias(name)), f"_{name}", "left").drop(f"_{name}")
        else:
            out = out.join(side.select(F.col("name").alias("part_id"), F.col("text").alias(name)), "part_id", "left")
    return out.drop("_paths")


def with_artifacts(rows: DataFrame, *sides: tuple[str, DataFrame]) -> DataFrame:
    """rows with a binary column for each (column, files by name): the file's content, null if there is none."""
    for column, files in sides:
        rows = rows.join(files.select(F.col("name").alias("part_id"), F.col("content").alias(column)), "part_id", "left")
    return rows


def write_jsonl(rows: DataFrame, path: str) -> None:
    """JSON lines in order of ordinal over the files."""
    rows.orderBy("ordinal").drop("ordinal").write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_parquet(rows: DataFrame, path: str, group_bytes: int = 32 << 20) -> bool:
    """Snappy Parquet in order of ordinal with row groups of bounded size; nothing is left at the path, and False returned, if there are no rows."""
    if rows.isEmpty():
        delete_path(rows.sparkSession, path)
        return False
    rows.orderBy("ordinal").drop("ordinal").write.mode("overwrite").option("compression", "snappy").option("parquet.block.size", group_bytes).parquet(path)
    return True


def write_manifest(records: DataFrame, path: str, order: str = "attempt") -> None:
    """Manifest lines in order, written beside the old ones and then put in their place."""
    spark, staging = records.sparkSession, f"{path}.new"
    records.orderBy(order).write.mode("overwrite").json(staging)
    replace_path(spark, staging, path)


def replace_path(spark: SparkSession, staging: str, path: str) -> None:
    """Puts a staged folder at path. What was there is moved aside, and deleted once the new one is in its place: at any moment one of the two is whole."""
    jvm = spark.sparkContext._jvm
    old, new, aside = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, staging, f"{path}.old"))
    fs = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(old):
        fs.delete(aside, True)
        if not fs.rename(old, aside):
            raise OSError(f"{path} could not be moved aside")
    if not fs.rename(new, old):
        if fs.exists(aside):
            fs.rename(aside, old)
        raise OSError(f"{staging} could not be put at {path}")
    fs.delete(aside, True)


def write_state(folder: str | Path, seed: int, version: str, accepted: int, attempted: int) -> None:
    text = json.dumps({"seed": seed, "generator_version": version, "accepted": accepted, "attempted": attempted}, indent=2)
    (Path(folder) / "state.json").write_text(text, "utf-8")


def write_parts(parts: DataFrame, path: str) -> None:
    """Sources, parameters, metadata and dimension texts as one table partitioned by kind (part_id, kind, text)."""
    parts.select("part_id", "kind", "text").write.mode("overwrite").partitionBy("kind").parquet(path)


def _table(header: tuple[str, ...], rows: list[tuple]) -> str:
    line = lambda cells: "| " + " | ".join(map(str, cells)) + " |"
    return "\n".join([line(header), line("---" for _ in header), *map(line, rows)])


def card(families: DataFrame, tiers: DataFrame, title: str, facts: dict[str, object]) -> str:
    """A dataset card in Markdown from the shares of families and tiers (see operators.corpus.shares)."""
    family = [(r[0], r["n"], f"{r['pct']:.1f}%") for r in families.orderBy("rank").collect()]
    tier = [(f"Tier {r[0]}", r["n"], f"{r['pct']:.1f}%") for r in tiers.orderBy(tiers.columns[0]).collect()]
    return "\n\n".join([f"# {title}", _table(("Field", "Value"), list(facts.items())), "## Part families", _table(("Family", "Count", "Share"), family), "## Complexity tiers", _table(("Tier", "Count", "Share"), tier)]) + "\n"


def features_yaml(renders: bool, stl: bool, step: bool, passes: list[str] | None = None) -> str:
    """The feature list of a packed table; its names are the table's columns."""
    columns = list(BASE_COLUMNS)
    columns += [(c, "image") for c, _ in render_columns(VIEWS, passes or ["shaded"])] if renders else []
    columns += [("stl_bytes", "binary")] * stl + [("step_bytes", "binary")] * step
    return "\n".join(["  features:", *(f"  - name: {n}\n    dtype: {t}" for n, t in columns)])


def configs_yaml(built: list[dict]) -> str:
    """Configurations (config_name, data_file, renders, stl, step, passes); the first that holds only code is the default."""
    out, default_given = [], False
    for b in built:
        code = not (b["renders"] or b["stl"] or b["step"])
        out.append(f'- config_name: "{b["config_name"]}"\n  data_files: "{b["data_file"]}"')
        if code and not default_given:
            out.append("  default: true")
            default_given = True
        if not code:
            out.append(features_yaml(b["renders"], b["stl"], b["step"], b.get("passes")))
    return "\n".join(out)


def possible_variants(present: dict[str, bool]) -> list[tuple]:
    """Variants all of whose artifacts (renders, stl, step) the corpus has at all."""
    return [v for v in VARIANTS if all(present.get(k, False) or not need for k, need in zip(("renders", "stl", "step"), v[1:]))]
