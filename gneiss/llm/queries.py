"""Queries of the training-data problems, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.llm.leakage import leaked_windows
from gneiss.llm.neardup import duplicate_groups, duplicate_pairs, near_duplicates
from gneiss.llm.packing import pack_texts
from gneiss.llm.sampling import sample_to_targets
from gneiss.llm.shapes import ShapeStore, repeats_by_batch, usable_signatures
from gneiss.llm.subjects import fit_subjects, main_subjects, subject_sentences
from gneiss.llm.varied import varied_subset
from gneiss.session import fresh_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sample(spark: SparkSession, sf_dir: str):
    return sample_to_targets(*(_table(spark, sf_dir, t) for t in ("manifest", "sample_plans", "sample_targets")))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories that the samples drawn leave short because the manifest cannot fill them."""
    return _sample(spark, sf_dir).report.where("gap > 0 and cause = 'manifest'").select("plan_id", "category_id")


def p1_needs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each target needs and what the manifest has, as reported beside the sample."""
    return _sample(spark, sf_dir).report.select("plan_id", "category_id", "need", "available", (F.col("drawn") <= F.col("available")).alias("in_stock"), (F.col("gap") == F.greatest(F.lit(0.0), F.col("need") - F.col("drawn"))).alias("gap_adds_up"))


def p1_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records drawn for each plan; a plan without targets draws none."""
    return _sample(spark, sf_dir).records.groupBy("plan_id").agg(F.count("*").alias("records"), F.countDistinct("part_id").alias("distinct_records"))


def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was drawn for each target, and what is missing."""
    return _sample(spark, sf_dir).report


def p1_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records drawn for each plan."""
    return _sample(spark, sf_dir).records


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of records whose sources share at least 0.7 of their elements."""
    pairs = duplicate_pairs(*near_duplicates(_table(spark, sf_dir, "parts")))
    return pairs.select(F.col("a").alias("part_id_a"), F.col("b").alias("part_id_b"))


def p2_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record's class of equal sources and the number of its near-duplicate classes."""
    return duplicate_groups(*near_duplicates(_table(spark, sf_dir, "parts"))).withColumnRenamed("id", "part_id")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates that repeat a signature of the manifest or an earlier candidate, admitted to the store six batches at a time."""
    store = ShapeStore(spark, fresh_path(spark, "shape_store"), buckets=16)
    store.append(usable_signatures(_table(spark, sf_dir, "manifest")))
    return repeats_by_batch(store, _table(spark, sf_dir, "exec_results"), together=6)


def p4_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records that stand for the groups of plan-varied."""
    size = _table(spark, sf_dir, "sample_plans").where("plan_id = 'plan-varied'").agg(F.max("sample_rows")).first()[0] or 0
    return varied_subset(_table(spark, sf_dir, "manifest"), size)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that were cut, being larger than the pack."""
    packed = pack_texts(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "packs"))
    return packed.where("piece_no = 1").select("pack_id", "doc_id").distinct()


def p6_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers, tokens and share of the space in use, by pack."""
    packed = pack_texts(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "packs"))
    total = packed.groupBy("pack_id", "bin_no").agg(F.sum("tokens").alias("t"), F.count("*").alias("n")).groupBy("pack_id").agg(F.count("*").alias("bins"), F.sum("t").alias("tokens"), F.max("t").alias("fullest"), F.sum("n").alias("pieces"))
    sizes = _table(spark, sf_dir, "packs").select("pack_id", "capacity")
    return total.join(F.broadcast(sizes), "pack_id").withColumn("used_share", F.col("tokens") / (F.col("bins") * F.col("capacity")))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of which at least 12 words in a row stand in a document, from the matches of windows."""
    return leaked_windows(_table(spark, sf_dir, "eval_items"), _table(spark, sf_dir, "documents")).where("run_words >= 12").select("item_id", "doc_id")


def p7_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best match of each item and document, near matches of windows included."""
    return leaked_windows(_table(spark, sf_dir, "eval_items"), _table(spark, sf_dir, "documents"))


def _mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return subject_sentences(docs, fit_subjects(docs, _table(spark, sf_dir, "doc_labels"), _table(spark, sf_dir, "subjects")))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one or two subjects that each document deals with."""
    return main_subjects(_mixture(spark, sf_dir))


def p8_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus by subject: documents, sentences and the sum of the documents' shares."""
    return _mixture(spark, sf_dir).groupBy("subject_id").agg(F.count("*").alias("documents"), F.sum("sentences").alias("sentences"), F.round(F.sum("share"), 6).alias("share_sum"))


QUERIES = {"p1_found": p1_found, "p1_report": p1_report, "p1_needs": p1_needs, "p1_sizes": p1_sizes, "p1_sample": p1_sample, "p2_found": p2_found, "p2_groups": p2_groups, "p3_found": p3_found, "p4_subset": p4_subset, "p6_found": p6_found, "p6_fill": p6_fill, "p7_found": p7_found, "p7_similar": p7_similar, "p8_found": p8_found, "p8_composition": p8_composition}
SQL: dict[str, str] = {
    "p1_found": r"""
        with m as (select distinct part_id, lower(regexp_replace(family, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) f, tier t from manifest)
        select g.plan_id, g.category_id from sample_targets g left join sample_plans s using (plan_id)
        where greatest(coalesce(g.min_rows, 0), coalesce(g.target_share * s.sample_rows, 0)) >
              (select count(distinct part_id) from m where f <> '' and (g.family is null or f = lower(trim(g.family))) and (g.tier is null or t = g.tier))""",
    "p1_needs": r"""
        with m as (select distinct part_id, lower(regexp_replace(family, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) f, tier t from manifest)
        select g.plan_id, g.category_id, greatest(coalesce(g.min_rows, 0)::double, coalesce(g.target_share * s.sample_rows, 0)) need,
               (select count(distinct part_id) from m where f <> '' and (g.family is null or f = lower(trim(g.family))) and (g.tier is null or t = g.tier)) available,
               true in_stock, true gap_adds_up
        from sample_targets g left join sample_plans s using (plan_id)""",
    "p1_sizes": r"""
        with m as (select count(distinct part_id) n from manifest where part_id is not null and lower(regexp_replace(family, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) <> '')
        select plan_id, least(sample_rows, n) records, least(sample_rows, n) distinct_records from sample_plans, m
        where plan_id in (select plan_id from sample_targets) and least(sample_rows, n) > 0""",
    "p3_found": """
        with m as (select distinct geometry_signature.volume v, geometry_signature.surface_area a, list_sort(geometry_signature.principal_moments) p,
                   geometry_signature.n_faces f, geometry_signature.n_edges e, geometry_signature.n_vertices n from manifest),
        c as (select distinct cand_id, batch_no, volume v, surface_area a, list_sort(principal_moments) p, n_faces f, n_edges e, n_vertices n
              from exec_results where success and n_solids = 1 and volume is not null and surface_area is not null and list_count(principal_moments) = 3),
        k as (select -1 batch_no, 0 cand_id, * from m where list_count(p) = 3 and v is not null and a is not null union all
              select batch_no, cand_id, v, a, p, f, e, n from c)
        select distinct c.cand_id from c, k where c.f = k.f and c.e = k.e and c.n = k.n and (k.batch_no, k.cand_id) < (c.batch_no, c.cand_id)
        and abs(c.v - k.v) <= 0.01 * greatest(c.v, k.v) and abs(c.a - k.a) <= 0.01 * greatest(c.a, k.a)
        and abs(c.p[1] - k.p[1]) <= 0.01 * greatest(c.p[1], k.p[1]) and abs(c.p[2] - k.p[2]) <= 0.01 * greatest(c.p[2], k.p[2])
        and abs(c.p[3] - k.p[3]) <= 0.01 * greatest(c.p[3], k.p[3])""",
    "p6_found": r"select p.pack_id, d.doc_id from documents d, packs p where len(regexp_extract_all(d.text, '[\p{L}\p{N}]+|[^\p{L}\p{N}\p{Z}\p{C}]')) > p.capacity group by 1, 2",
}
