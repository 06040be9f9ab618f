"""Plans: what is read, pushed down and joined."""

import pytest
from pyspark.sql import functions as F

from gneiss.operators import corpus, dedup
from gneiss.plans import part_texts
from gneiss.plans.reference import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name,columns",
    [
        ("signature_quantize", {"l_orderkey", "l_partkey", "l_extendedprice", "l_quantity"}),
        ("validity_rate", {"family", "success", "error", "volume", "bbox", "n_solids"}),
        ("tier_share", {"p_size"}),
        ("staged_semi", {"part_id", "rel_path"}),
        ("content_hash", {"doc_id", "text"}),
    ],
)
def test_scans_read_only_what_is_used(spark, sf, name, columns):
    schema = plan(QUERIES[name](spark, sf)).split("ReadSchema: struct<")[1].split("\n")[0]
    assert all(f"{c}:" in schema for c in columns)
    assert not any(f"{c}:" in schema for c in ("l_tax", "ingested_at", "traceback", "p_name", "job_id"))


def test_prefixes_and_caps_are_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "m")
    corpus.with_ordinal(spark.range(100).withColumn("tier", (F.col("id") % 4).cast("int")), "id").write.parquet(path)
    df = corpus.tier_cap(corpus.prefix_slice(spark.read.parquet(path), 10), 2)
    assert "LessThan(ordinal,10)" in plan(df) and "LessThanOrEqual(tier,2)" in plan(df) and "Limit" not in plan(df)


def test_first_wins_combines_before_the_shuffle(spark):
    text = plan(dedup.accepted_firsts(spark.range(100).withColumn("k", F.col("id") % 7), [F.col("k")], ["id"]))
    assert text.count("Exchange hashpartitioning") == 1 and "Window" not in text and "partial_min_by" in text


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"variant_grid", "render_column_grid", "family_weights"}))
def test_no_query_pairs_all_rows(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["op_bodies", "op_features", "op_holes"])
def test_phrases_and_statements_are_made_in_one_pass(spark, tmp_path, name):
    keys = [(1, 5), (1, 6), (None, 7), (2, 8)]
    spark.createDataFrame(keys, "p_partkey long, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    df = part_texts.QUERIES[name](spark, str(tmp_path))
    assert "Join" not in plan(df)  # its size is taken for that of the rows before they are told apart by kind, and so broadcast
    got = df.groupBy("part_id").count().collect()
    kinds = sum(r["count"] for r in got if r.part_id == 2)
    assert kinds > 1 and {r.part_id: r["count"] for r in got} == {1: 2 * kinds, None: kinds, 2: kinds}


@pytest.mark.parametrize("name", ["op_features", "op_holes"])
def test_texts_of_one_row_group_are_made_in_many_tasks(spark, tmp_path, name):
    spark.range(64).selectExpr("id p_partkey", "cast(id % 50 + 1 as int) p_size").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    df = part_texts.QUERIES[name](spark, str(tmp_path))
    per_task = df.groupBy(F.spark_partition_id()).agg(F.countDistinct("part_id").alias("n")).collect()
    assert len(per_task) > 1 and max(r.n for r in per_task) < 64 and df.select("part_id").distinct().count() == 64
