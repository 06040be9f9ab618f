"""Sources: attempt ranges, manifests, side files, meshes and configuration."""

from __future__ import annotations

import json
import struct
import tomllib
import warnings
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.functions.scalars import SIGNATURE_TYPE, id_suffix, part_seed

MANIFEST_TYPE = (
    "part_id string, family string, tier int, seed bigint, symmetry string, op_count int, ir_hash string, generator_version string, legacy_version string, license string, "
    f"descriptor string, dimensions struct<lines: array<string>, text: string>, geometry_signature {SIGNATURE_TYPE}, paths map<string,string>"
)


def attempts(spark: SparkSession, start: int, end: int, seed: int, partitions: int | None = None) -> DataFrame:
    """attempt, part_seed of the range [start, end)."""
    return spark.range(start, end, 1, partitions).select(F.col("id").alias("attempt"), part_seed(seed, "id").alias("part_seed"))


def read_manifest(spark: SparkSession, path: str, schema: str = MANIFEST_TYPE) -> DataFrame:
    """Manifest lines with `attempt`, the order key in the id; malformed lines and blanks are passed over, a missing file is empty."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        rows = spark.createDataFrame([], schema)
    else:
        rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return rows.withColumn("attempt", id_suffix("part_id"))


def read_texts(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """name (the file's name without suffix), text of whole files."""
    rows = spark.read.option("wholetext", "true").option("pathGlobFilter", f"*{suffix}").text(path)
    name = F.regexp_replace(F.col("_metadata.file_name"), f"{suffix.replace('.', '[.]')}$", "")
    return rows.select(name.alias("name"), F.col("value").alias("text"))


def read_params(spark: SparkSession, path: str) -> DataFrame:
    """name, params (JSON text) of parameter side files; null where the file is broken or has none."""
    return read_texts(spark, path, ".params.json").select("name", params_of("text").alias("params"))


def params_of(text: str) -> F.Column:
    return F.get_json_object(F.to_json(F.try_parse_json(F.col(text))), "$.params")


def read_artifacts(spark: SparkSession, path: str, pattern: str, content: bool = True) -> DataFrame:
    """name, path, length and content of binary files; without content it is a listing and reads none of it."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    name = F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1)
    return rows.select(name.alias("name"), "path", "length", *(["content"] if content else []))


def source_files(spark: SparkSession, path: str) -> DataFrame:
    """Names of source files in order."""
    return read_artifacts(spark, path, "*.py", content=False).select("name").orderBy("name")


def stl_triangles(content: bytes) -> np.ndarray:
    """Corners of an STL file's triangles, n x 3 x 3; text or binary is told by the length that the count of triangles asks for."""
    count = struct.unpack_from("<I", content, 80)[0] if len(content) >= 84 else -1
    if len(content) == 84 + 50 * count:
        record = np.dtype([("normal", "<f4", 3), ("corners", "<f4", (3, 3)), ("extra", "<u2")])
        return np.frombuffer(content, record, count, 84)["corners"].astype(float)
    numbers = [x.split()[1:4] for x in content.decode("ascii", "replace").splitlines() if x.lstrip().startswith("vertex")]
    corners = np.array(numbers, float)
    return corners[: len(corners) // 3 * 3].reshape(-1, 3, 3)


def stl_vertices(files: DataFrame) -> DataFrame:
    """(part_id, x, y, z) of files (name, content); a file that cannot be read has no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content").to_pylist()):
                try:
                    points = stl_triangles(content).reshape(-1, 3)
                except (ValueError, TypeError):
                    continue
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(points), pa.string()), *(pa.array(np.ascontiguousarray(points[:, k])) for k in range(3))], names=["part_id", "x", "y", "z"])

    return files.select("name", "content").mapInArrow(run, "part_id string, x double, y double, z double")


def step_counts(texts: DataFrame, entities: tuple[str, ...] = ("ADVANCED_FACE", "EDGE_CURVE", "VERTEX_POINT", "MANIFOLD_SOLID_BREP", "SHELL_BASED_SURFACE_MODEL")) -> DataFrame:
    """name and the number of each kind of entity in STEP texts."""
    return texts.select("name", *(F.regexp_count("text", F.lit(rf"=\s*{e}\s*\(")).alias(e.lower()) for e in entities))


def candidate_meshes(files: DataFrame, suffixes: list[str], cap: int, n: int, smallest: bool) -> DataFrame:
    """The n smallest (or first by path) files of the given kinds that are not empty nor above the cap."""
    kind = F.lower(F.substring_index("path", ".", -1))
    good = files.where(kind.isin(suffixes) & (F.col("length") > 0) & (F.col("length") <= cap))
    return good.orderBy(*(["length", "path"] if smallest else ["path"])).limit(n)


def load_toml(path: str | Path) -> dict:
    """A TOML file as a dict; {} if it is missing, with a warning if it cannot be read."""
    try:
        return tomllib.loads(Path(path).read_text("utf-8"))
    except FileNotFoundError:
        return {}
    except (OSError, ValueError) as e:
        warnings.warn(f"{path} is not used: {e}", stacklevel=2)
        return {}


def load_state(folder: str | Path) -> dict | None:
    """The resume cursor of a corpus, None if it is absent or broken."""
    try:
        found = json.loads((Path(folder) / "state.json").read_text("utf-8"))
    except (OSError, ValueError):
        return None
    return found if isinstance(found, dict) else None


def load_ladder(spark: SparkSession, config: dict) -> DataFrame:
    """pos, tag, count, seed of a publishing ladder; tags without a seed take the base seed; an empty ladder is an error."""
    section = config.get("publish", {})
    rows = [(i, str(x["tag"]), int(x["count"]), x.get("seed", section.get("base_seed"))) for i, x in enumerate(section.get("corpus", []))]
    if not rows:
        raise ValueError("the ladder has no entries")
    return spark.createDataFrame(rows, "pos int, tag string, count bigint, seed bigint")


def ladder_meta(config: dict) -> dict:
    """mode, base_seed, base_tag and base_count of a ladder."""
    section = config.get("publish", {})
    most = max((int(x["count"]) for x in section.get("corpus", [])), default=0)
    return {"mode": section.get("mode", "independent"), "base_seed": section.get("base_seed"), "base_tag": section.get("base_tag", "base"), "base_count": most}


def load_corpora(spark: SparkSession, config: dict, default_config: str = "configs/default.toml") -> DataFrame:
    """Sample corpora; the seed falls back to the sample seed of the meta section."""
    seed = config.get("meta", {}).get("sample_seed")
    rows = [(str(x.get("name", "")), x.get("count"), x.get("seed", seed), str(x.get("config", default_config))) for x in config.get("corpus", [])]
    return spark.createDataFrame(rows, "name string, count bigint, seed bigint, config string")


def seed_list(folder: str | Path, version: str) -> Path:
    """The seed list to use: seeds.toml; else the v*.toml made for the version, the highest if several; else the highest number."""
    folder = Path(folder)
    single = folder / "seeds.toml"
    if single.exists():
        return single
    number = lambda p: int("".join(c for c in p.stem if c.isdigit()) or 0)
    ranked = [(str(load_toml(p).get("meta", {}).get("generator_version")) == version, number(p), p) for p in folder.glob("v*.toml")]
    return max(ranked)[2] if ranked else single
