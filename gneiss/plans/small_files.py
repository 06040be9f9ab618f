"""Queries of the small-files problem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.operators.compaction import compact, read_records, validate
from gneiss.operators.json_values import json_keys
from gneiss.operators.pairs import pairs_within


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of small files whose payloads are the same JSON value, read back from the containers they were joined into."""
    index = compact(spark.read.parquet(f"{sf_dir}/small_files.parquet"))
    pairs = pairs_within(json_keys(read_records(index)), "value_key", "file_id")
    return pairs.select(F.col("a").alias("file_id_a"), F.col("b").alias("file_id_b"))


def p5_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each small file's length and checksum in the containers; file_id must come out as often as it went in."""
    index = compact(spark.read.parquet(f"{sf_dir}/small_files.parquet"))
    return index.select("file_id", F.col("length").alias("bytes_kept"))


def p5_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over the validated containers; nothing may be damaged or missing."""
    checked = validate(compact(spark.read.parquet(f"{sf_dir}/small_files.parquet")))
    return checked.agg(F.sum("records").alias("records"), F.sum("bytes").alias("payload_bytes"), F.sum("damaged").alias("damaged"), F.sum("missing_bytes").alias("missing_bytes"))


QUERIES = {"p5_found": p5_found, "p5_index": p5_index, "p5_containers": p5_containers}
SQL = {
    "p5_index": "select file_id, octet_length(encode(payload)) as bytes_kept from small_files",
    "p5_containers": "select count(payload) as records, coalesce(sum(octet_length(encode(payload))),0)::bigint as payload_bytes, 0::bigint as damaged, 0::bigint as missing_bytes from small_files",
}
