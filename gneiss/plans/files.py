"""Queries of sinks and sources (written, read back and compared), of choices and small functions, beside their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gneiss.functions import scalars as fx
from gneiss.functions.expressions import source_text
from gneiss.functions.standards import STOCK_THICKNESSES, acme_pitch, metric_pitches, trapezoidal_pitch
from gneiss.operators import corpus, lookups, validity
from gneiss.plans.part_texts import expression
from gneiss.session import fresh_path
from gneiss.sources.manifest import candidate_meshes, read_manifest
from gneiss.sources.sinks import PASSES, packed, write_jsonl, write_manifest, write_parquet, write_parts
from gneiss.streaming.dedup import windowed_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
_SUFFIX = "case when instr(part_id, '_') > 0 then coalesce(try_cast(regexp_extract(part_id, '([^_]*)$', 1) as bigint), 0) else 0 end"
_PACKED = "(select *, row_number() over (order by attempt) - 1 ordinal from (select * from manifest qualify row_number() over (partition by attempt order by loaded_at, part_id) = 1)) where part_id <> '' and tier <= 2"


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(f"select part_id, {_SUFFIX} attempt, family, tier, ir_hash, geometry_signature.volume volume, geometry_signature.n_faces n_faces, len(dimensions.lines) n_lines, paths['py'] py from manifest")
def manifest_round_trip(spark, sf_dir):
    """The manifest written as lines, replaced by a second writing, and read again."""
    path = fresh_path(spark, "manifest")
    rows = table(spark, sf_dir, "manifest").drop("accepted_at", "loaded_at")
    write_manifest(rows.where("tier = 0"), path)
    write_manifest(rows, path)
    g = F.col("geometry_signature")
    return read_manifest(spark, path).select("part_id", "attempt", "family", "tier", "ir_hash", g["volume"].alias("volume"), g["n_faces"].alias("n_faces"), F.when(F.size("dimensions.lines") >= 0, F.size("dimensions.lines")).alias("n_lines"), F.col("paths")["py"].alias("py"))


def _pack(spark: SparkSession, sf_dir: str, as_text: bool) -> DataFrame:
    rows = table(spark, sf_dir, "manifest")
    first = rows.groupBy("attempt").agg(F.min_by(F.struct(*(c for c in rows.columns if c != "attempt")), F.struct("loaded_at", "part_id")).alias("r")).select("attempt", "r.*")
    return packed(corpus.with_ordinal(first, "attempt"), tier_max=2, as_text=as_text)


@query(f"select part_id, family, tier, coalesce(license, 'CC0-1.0') license, nullif(generator_version, '') generator_version, geometry_signature.surface_area surface_area, dimensions.text said from {_PACKED}")
def jsonl_round_trip(spark, sf_dir):
    """A packed table as JSON lines, read again: signatures and dimensions are objects."""
    path = fresh_path(spark, "pack_jsonl")
    rows = _pack(spark, sf_dir, False)
    write_jsonl(rows, path)
    back = spark.read.schema(rows.drop("ordinal").schema).json(path)
    return back.select("part_id", "family", "tier", "license", "generator_version", F.col("geometry_signature.surface_area").alias("surface_area"), F.col("dimensions.text").alias("said"))


@query(f"select part_id, family, tier, seed, op_count, ir_hash, coalesce(license, 'CC0-1.0') license, dimensions.text dimensions from {_PACKED}")
def parquet_round_trip(spark, sf_dir):
    """A packed table as Parquet, read again: signatures and dimensions are text."""
    path = fresh_path(spark, "pack_parquet")
    write_parquet(_pack(spark, sf_dir, True), path)
    return spark.read.parquet(path).select("part_id", "family", "tier", "seed", "op_count", "ir_hash", "license", "dimensions")


@query("select part_id, 'source' kind, build \"text\" from parts union all select part_id, 'params', params from parts")
def parts_round_trip(spark, sf_dir):
    """Sources and parameters of all parts, written by kind and read again."""
    path = fresh_path(spark, "parts")
    rows = table(spark, sf_dir, "parts")
    write_parts(rows.select("part_id", F.lit("source").alias("kind"), F.col("build").alias("text")).unionByName(rows.select("part_id", F.lit("params").alias("kind"), F.col("params").alias("text"))), path)
    return spark.read.parquet(path).select("part_id", "kind", "text")


@query("""with b as (select l_orderkey k, min(l_quantity) x0, max(l_quantity) x1, min(l_linenumber) y0, max(l_linenumber) y1, min(l_discount) z0, max(l_discount) z1 from lineitem group by 1)
    select k::varchar part_id, round((x0 + x1) / 2, 6) cx, round(max(sqrt((l_quantity - (x0 + x1) / 2) ** 2 + (l_linenumber - (y0 + y1) / 2.0::double) ** 2 + (l_discount - (z0 + z1) / 2) ** 2)), 6) radius from b join lineitem on l_orderkey = k group by k, x0, x1""")
def mesh_bounds(spark, sf_dir):
    """Centre and radius of clouds of points."""
    points = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("part_id"), F.col("l_quantity").cast("double").alias("x"), F.col("l_linenumber").cast("double").alias("y"), F.col("l_discount").cast("double").alias("z"))
    return corpus.mesh_bounds(points).select("part_id", F.round("centre_x", 6).alias("cx"), F.round("radius", 6).alias("radius"))


@query("select rel_path path, n_bytes \"length\" from small_files where lower(regexp_extract(rel_path, '[^.]*$')) in ('json', 'txt') and n_bytes > 0 and n_bytes <= 200 order by n_bytes, rel_path limit 50")
def mesh_candidates(spark, sf_dir):
    """The 50 smallest files of two kinds that are not empty nor above a cap."""
    files = table(spark, sf_dir, "small_files").select(F.col("rel_path").alias("path"), F.col("n_bytes").alias("length"))
    return candidate_meshes(files, ["json", "txt"], 200, 50, True)


_FACES = "(['>Z', '<Z', '>X', '<X', '>Y', '<Y', '|Q'])[p_size % 7 + 1]"


@query(f"""select p_partkey, case {_FACES} when '>Z' then 'top face' when '<Z' then 'bottom face' when '>X' then 'right face' when '<X' then 'left face' when '>Y' then 'back face' when '<Y' then 'front face' else 'the |Q face' end face,
    case (['|Z', '|X', '|Y', '>Z', '<Z', '#Q'])[p_size % 6 + 1] when '|Z' then 'vertical edges' when '|X' then 'edges along X' when '|Y' then 'edges along Y' when '>Z' then 'top edges' when '<Z' then 'bottom edges' else 'the #Q edges' end edge,
    (p_size * 1.25)::double pitch from part""")
def selector_names(spark, sf_dir):
    size = F.col("p_size")
    pick = lambda *xs: F.element_at(F.array(*map(F.lit, xs)), (size % len(xs) + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", fx.face_name(pick(">Z", "<Z", ">X", "<X", ">Y", "<Y", "|Q")).alias("face"), fx.edge_name(pick("|Z", "|X", "|Y", ">Z", "<Z", "#Q")).alias("edge"), fx.pitch_diameter(F.lit(1.25), size).alias("pitch"))


@query("select event_id, trim(event_type) name, case when event_id % 2 = 0 then user_id::varchar else '\"u ' || user_id || '\"' end val from events")
def settings_parse(spark, sf_dir):
    """NAME=VALUE texts: values that are JSON stand, others become JSON strings."""
    text = F.concat(F.lit(" "), "event_type", F.lit(" ="), F.when(F.col("event_id") % 2 == 0, F.col("user_id").cast("string")).otherwise(F.concat(F.lit("u "), F.col("user_id").cast("string"))))
    return table(spark, sf_dir, "events").select("event_id", text.alias("t")).select("event_id", fx.setting_name("t").alias("name"), fx.setting_value("t").alias("val"))


@query("select part_id, rel_path, case when starts_with(rel_path, 'parts/') then substr(rel_path, 7) else rel_path end below from parts")
def relative_paths(spark, sf_dir):
    return table(spark, sf_dir, "parts").select("part_id", "rel_path", fx.relative_path("rel_path", F.lit("parts//")).alias("below"))


@query("""select p_partkey, case when p_size % 2 = 0 then greatest(10.0::double, least(60.0::double, round_even((10 + p_size), 0) * 1.0)) else (10 + p_size)::double end v from (select p_partkey, p_size // 5 * 5 p_size from part)""")
def nice_values(spark, sf_dir):
    """Draws of 10 to 60 from given uniforms: every second one snaps to a multiple of five."""
    size = F.floor(F.col("p_size") / 5) * 5
    return table(spark, sf_dir, "part").select("p_partkey", fx.nice((size / 50.0), 10.0, 60.0, F.when(size % 2 == 0, 0.1).otherwise(0.9)).alias("v"))


@query("select cand_id, batch_no, reason from (select cand_id, batch_no, 'execution failed: ' || coalesce(error, 'missing execution result') reason from exec_results where not coalesce(success, false)) order by batch_no, cand_id, reason limit 25")
def first_errors(spark, sf_dir):
    """The first 25 failed runs, by batch and candidate."""
    rows = table(spark, sf_dir, "exec_results").where(~F.coalesce("success", F.lit(False)))
    return validity.first_errors(validity.with_validity(rows), ["batch_no", "cand_id", "reason"]).select("cand_id", "batch_no", "reason")


@query("select family, part_id from (select family, part_id, row_number() over (partition by family order by md5('7:' || part_id)) r from (select distinct family, part_id from manifest)) where r <= 3")
def family_picks(spark, sf_dir):
    """Three records of each family, by a seeded hash of the id."""
    rows = table(spark, sf_dir, "manifest").select("family", "part_id").distinct()
    return lookups.picks(rows, "family", 3, F.md5(F.concat(F.lit("7:"), "part_id")))


@query("select tag from (values ('1k'), ('77k'), ('3k'), ('77k')) t(tag) where tag not in (select tag from ladder) group by 1")
def stale_tags(spark, sf_dir):
    return lookups.stale_tags(spark.createDataFrame([("1k",), ("77k",), ("3k",), ("77k",)], "tag string"), table(spark, sf_dir, "ladder"))


@query("select attempt, 'gear' family, 3 tier from manifest")
def forced_choice(spark, sf_dir):
    return lookups.forced(table(spark, sf_dir, "manifest").select("attempt", "family", "tier"), "gear", 3)


@query(f"""select p_partkey, case when len(f) > 0 then f[least(floor(u * len(f))::int, len(f) - 1) + 1] else round_even(lo + u * (hi - lo), 2) end size
    from (select *, list_filter({STOCK_THICKNESSES}::double[], lambda x: x >= lo and x <= hi) f from (select p_partkey, (p_partkey % 8) / 8.0::double u, (p_size % 30)::double lo, (p_size % 30 + p_size % 4)::double hi from part))""")
def standard_picks(spark, sf_dir):
    """Standard sizes chosen among those in range; where there is none, a size of the range."""
    lo = (F.col("p_size") % 30).cast("double")
    rows = table(spark, sf_dir, "part").select("p_partkey", ((F.col("p_partkey") % 8) / 8.0).alias("u"), lo.alias("lo"), (lo + F.col("p_size") % 4).alias("hi"))
    return rows.select("p_partkey", fx.pick_standard(STOCK_THICKNESSES, "u", "lo", "hi").alias("size"))


@query("select path, row_number() over (order by stem nulls last, path) place from (select path, try_cast(regexp_extract(path, '([^/.]+)[.][a-z]+$', 1) as bigint) stem from (select distinct case when l_orderkey % 3 = 0 then 'm/x' || l_orderkey else 'm/' || l_orderkey end || '.stl' path from lineitem)) qualify place <= 200")
def numeric_stems(spark, sf_dir):
    """Files in the order of the numbers that they are named by, other names last: the first 200 of them."""
    key = F.col("l_orderkey").cast("string")
    paths = table(spark, sf_dir, "lineitem").select(F.concat(F.when(F.col("l_orderkey") % 3 == 0, "m/x").otherwise("m/"), key, F.lit(".stl")).alias("path")).distinct()
    first = paths.orderBy(fx.stem_number("path").asc_nulls_last(), "path").limit(200)
    return first.withColumn("place", F.row_number().over(Window.orderBy(fx.stem_number("path").asc_nulls_last(), "path")))


@query("""select p_partkey, case d when 8 then [1.25, 1.0, 0.75] when 16 then [2.0, 1.5] when 24 then [3.0, 2.0] when 36 then [4.0, 3.0] end::double[] metric, case s when '1/2' then 25.4 / 10.0::double when '1' then 25.4 / 5.0::double when '3/4' then 25.4 / 6.0::double end acme,
    case t when '8x1.5' then 1.5 when '40x7' then 7.0 end::double trapezoidal from (select p_partkey, ([8, 16, 24, 36, 37])[p_size % 5 + 1] d, (['1/2', '1', '3/4', '9'])[p_size % 4 + 1] s, (['8x1.5', '40x7', '9x9'])[p_size % 3 + 1] t from part)""")
def pitch_lookups(spark, sf_dir):
    """Pitches of threads by size; null for what is not standard."""
    pick = lambda *xs: F.element_at(F.array(*map(F.lit, xs)), (F.col("p_size") % len(xs) + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", metric_pitches(pick(8, 16, 24, 36, 37)).alias("metric"), acme_pitch(pick("1/2", "1", "3/4", "9")).alias("acme"), trapezoidal_pitch(pick("8x1.5", "40x7", "9x9")).alias("trapezoidal"))


@query("""select p_partkey, 'p["a"]' param, 'p["a"] * ' || (p_size + 0.5) scaled, 'min(p["a"], p["b"])' lesser, 'min(p["a"], p["b"]) * 0.25' part_of_lesser, 'min(p["a"], ' || p_size || '.0)' clamped, 'p["a"] / 2' half, p_size || '.0' literal from part""")
def expression_sources(spark, sf_dir):
    """Source text of each kind of expression."""
    size = F.col("p_size").cast("double")
    made = {"param": {"type": "param"}, "scaled": {"type": "scaled", "factor": size + 0.5}, "lesser": {"type": "min2", "factor": 1.0}, "part_of_lesser": {"type": "min2", "factor": 0.25}, "clamped": {"type": "clamp", "limit": size}, "half": {"type": "half"}, "literal": {"type": "literal", "value": size}}
    of = {"param": "a", "param_a": "a", "param_b": "b"}
    return table(spark, sf_dir, "part").select("p_partkey", *(source_text(expression(**of, **fields)).alias(name) for name, fields in made.items()))


@query("""select event_id, 0.12::double + (0.02::double - 0.12::double) * k n_lo, 0.45::double + (0.12::double - 0.45::double) * k n_hi, 0.040::double + (0.008::double - 0.040::double) * k d_lo, 0.120::double + (0.035::double - 0.120::double) * k d_hi,
    1.7::double + (1.0::double - 1.7::double) * k width from (select event_id, greatest(0.0::double, least(1.0::double, (event_id % 7 - 1) / 4.0::double)) k from events)""")
def edge_bounds(spark, sf_dir):
    """The edge detector's five numbers, for crispness below, within and above its range."""
    return table(spark, sf_dir, "events").select("event_id", fx.edge_params((F.col("event_id") % 7 - 1) / 4.0).alias("e")).select("event_id", "e.*")


@query("""select part_id, grp, names, row_number() over (partition by part_id order by f) place from
    (select l_orderkey part_id, l_returnflag grp, string_agg('p' || l_linenumber, ', ' order by l_linenumber) names, min(l_linenumber) f from (select l_orderkey, l_linenumber, min(l_returnflag) l_returnflag from lineitem group by 1, 2) group by 1, 2)""")
def parameter_groups(spark, sf_dir):
    """Names by display group, groups and names in order of first appearance."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("part_id"), F.col("l_returnflag").alias("grp"), F.col("l_linenumber").alias("pos"), F.concat(F.lit("p"), F.col("l_linenumber").cast("string")).alias("name"))
    return corpus.grouped_params(rows.groupBy("part_id", "pos", "name").agg(F.min("grp").alias("grp")))


@query("""select list_filter(['shaded', 'normal', 'depth', 'edge'], lambda x: x = 'shaded' or list_contains(h, x)) passes from
    (select list(distinct case event_type when 'view' then 'normal' when 'purchase' then 'depth' when 'error' then 'edge' else event_type end) h from events where user_id = (select min(user_id) from events))""")
def passes_present(spark, sf_dir):
    """Render passes of which the first part has files."""
    kind = F.col("event_type")
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("part_id"), F.when(kind == "view", "normal").when(kind == "purchase", "depth").when(kind == "error", "edge").otherwise(kind).alias("pass"))
    return corpus.available_passes(rows, PASSES)


@query("select time_bucket(interval 5 minute, ts) \"start\", event_type, count(*) n from events group by 1, 2")
def event_windows(spark, sf_dir):
    """Counts by type and five-minute window; the stream's plan over a table."""
    return windowed_counts(table(spark, sf_dir, "events")).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query(f"select m.part_id, m.paths['py'] py, s.build source from (select * from {_PACKED}) m left join (select rel_path, min(build) build from parts group by 1) s on s.rel_path = m.paths['py']")
def packed_by_path(spark, sf_dir):
    """Packed rows with the source that each record's own paths name, whatever the file's part_id says."""
    rows = table(spark, sf_dir, "manifest")
    first = rows.groupBy("attempt").agg(F.min_by(F.struct(*(c for c in rows.columns if c != "attempt")), F.struct("loaded_at", "part_id")).alias("r")).select("attempt", "r.*")
    ranked = corpus.with_ordinal(first, "attempt")
    texts = table(spark, sf_dir, "parts").groupBy(F.col("rel_path").alias("path")).agg(F.min("build").alias("text"))
    out = packed(ranked, tier_max=2, sources=texts)
    return out.join(ranked.select("ordinal", F.col("paths")["py"].alias("py")), "ordinal").select("part_id", "py", "source")
