"""Queries of the corpus operators, each beside the SQL that states it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gneiss.functions import scalars as fx
from gneiss.functions.expressions import EXPR_TYPE, evaluate, source_text
from gneiss.functions.standards import STOCK_THICKNESSES
from gneiss.operators import corpus, dedup, lookups, validity
from gneiss.plans import pipeline
from gneiss.session import fresh_path
from gneiss.sources import params_text
from gneiss.sources.sinks import PASSES, TIER_SLICES, VARIANTS, VIEWS, packed
from gneiss.streaming.dedup import dedup_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rounding in DuckDB: half to even on the value times a power of ten.
_SIG = "case when {v} = 0 then 0.0 else round_even({v} * pow(10.0::double, 2 - floor(log10(abs({v})))), 0) / pow(10.0::double, 2 - floor(log10(abs({v})))) end"
_SEED = "((42 * 1000003::bigint + {i}) & 4294967295)"


@query("select doc_id, text, lang from (select *, row_number() over (partition by text order by doc_id) r from documents) where r = 1 or text is null")
def first_wins_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return dedup.accepted_firsts(docs.where("text is not null"), [F.sha2("text", 256)], ["doc_id"]).unionByName(docs.where("text is null"))


@query("""select coalesce(lang, '-') lang, count(*) attempts, count(*) filter (r = 1) accepted, count(*) filter (r > 1) duplicates from
    (select lang, row_number() over (partition by text order by doc_id) r from documents where text is not null) group by 1""")
def dedup_decision_report(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.coalesce("lang", F.lit("-")).alias("lang"), F.sha2("text", 256).alias("h"))
    marked = dedup.first_wins(docs, [F.col("h")], ["doc_id"])
    d = F.col("decision")
    return marked.groupBy("lang").agg(F.count("*").alias("attempts"), F.count_if(d == "accepted").alias("accepted"), F.count_if(d == "duplicate").alias("duplicates"))


@query(f"select l_orderkey, l_partkey, {_SIG.format(v='l_extendedprice')} price, {_SIG.format(v='l_quantity')} quantity from lineitem")
def signature_quantize(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", fx.round_sig("l_extendedprice").alias("price"), fx.round_sig("l_quantity").alias("quantity"))


@query(f"""select o_orderkey, price from (select o_orderkey, {_SIG.format(v='o_totalprice')} price,
    row_number() over (partition by {_SIG.format(v='o_totalprice')}, o_orderstatus order by o_orderkey) r from orders) where r = 1""")
def signature_dedup(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", fx.round_sig("o_totalprice").alias("price"))
    return dedup.accepted_firsts(rows, [F.col("price"), F.col("o_orderstatus")], ["o_orderkey"]).select("o_orderkey", "price")


_REASON = """case when not coalesce(success, false) then 'execution failed: ' || coalesce(error, 'missing execution result')
    when coalesce(n_solids, 0) <> 1 then 'disconnected geometry' when volume is null or volume < 1.0 then 'volume too small'
    when bbox[4] - bbox[1] <= 0 or bbox[5] - bbox[2] <= 0 or bbox[6] - bbox[3] <= 0 then 'degenerate bounding box'
    when greatest(bbox[4] - bbox[1], bbox[5] - bbox[2], bbox[6] - bbox[3]) / nullif(least(bbox[4] - bbox[1], bbox[5] - bbox[2], bbox[6] - bbox[3]), 0) > 20.0 then 'extreme aspect ratio' else '' end"""


@query(f"select cand_id, batch_no, {_REASON} reason from exec_results")
def validity_cascade(spark, sf_dir):
    return validity.with_validity(table(spark, sf_dir, "exec_results")).select("cand_id", "batch_no", "reason")


@query(f"select coalesce(family, '-') family, count(*) n, avg(case when {_REASON} = '' then 1.0 else 0.0 end) rate from exec_results group by 1")
def validity_rate(spark, sf_dir):
    marked = validity.with_validity(table(spark, sf_dir, "exec_results")).withColumn("family", F.coalesce("family", F.lit("-")))
    return marked.groupBy("family").agg(F.count("*").alias("n"), F.avg(F.col("valid").cast("double")).alias("rate"))


@query("""select event_type bucket, count(*) total, count(*) filter (value >= 20) ok, count(*) filter (value is null or value < 5) flawed,
    (count(*) filter (value >= 20)) * 100.0 / count(*) pct from events group by rollup (event_type)""")
def yield_rollup(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumnRenamed("event_type", "bucket")
    return corpus.yield_report(rows, "bucket", F.col("value") >= 20, F.col("value").isNull() | (F.col("value") < 5))


@query("""select family, n, round_even(n * 100.0::double / sum(n) over (), 1) pct, row_number() over (order by n desc, f) rank from
    (select p_type family, count(*) n, min(p_partkey) f from part group by 1)""")
def family_share(spark, sf_dir):
    return corpus.shares(table(spark, sf_dir, "part"), F.col("p_type"), "family", "p_partkey")


@query("select tier, n, round_even(n * 100.0::double / sum(n) over (), 1) pct from (select p_size // 13 tier, count(*) n from part group by 1)")
def tier_share(spark, sf_dir):
    return corpus.shares(table(spark, sf_dir, "part"), F.floor(F.col("p_size") / 13).cast("int"), "tier").drop("rank")


@query("""select case when grouping(family) = 0 then 'family' when grouping(tier) = 0 then 'tier' else 'total' end kind, family, tier, count(*) n from
    (select coalesce(family, 'unknown') family, coalesce(tier, -1) tier from manifest) group by grouping sets ((family), (tier), ())""")
def grouping_sets_stats(spark, sf_dir):
    return corpus.stats(table(spark, sf_dir, "manifest"))


@query("select o_orderkey, o_totalprice from (select *, row_number() over (order by o_orderkey) - 1 ordinal from orders) where ordinal < 1000")
def prefix_slice(spark, sf_dir):
    rows = corpus.with_ordinal(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")
    return corpus.prefix_slice(rows, 1000).drop("ordinal")


@query("select o_orderkey from (select *, o_custkey % 4 tier, row_number() over (order by o_orderkey) - 1 ordinal from orders) where ordinal < 1000 and tier <= 2")
def prefix_then_tier(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 4).alias("tier"))
    return corpus.tier_cap(corpus.prefix_slice(corpus.with_ordinal(rows, "o_orderkey"), 1000), 2).select("o_orderkey")


@query("""select tag, s.part, count(*) filter (m.ordinal < l.part_count and (s.cap is null or m.tier <= s.cap)) n from ladder l,
    (values ('', null), ('-t0-2', 2)) s(part, cap), (select tier, row_number() over (order by attempt) - 1 ordinal from (select attempt, min(tier) tier from manifest group by 1)) m group by 1, 2""")
def nested_ladder_counts(spark, sf_dir):
    rows = corpus.with_ordinal(table(spark, sf_dir, "manifest").groupBy("attempt").agg(F.min("tier").alias("tier")), "attempt")
    steps = [r for r in table(spark, sf_dir, "ladder").collect()]
    sizes = [(r.tag, part, r.part_count, cap) for r in steps for _, part, cap in TIER_SLICES]
    counts = rows.agg(*(F.count_if((F.col("ordinal") < n) & (F.lit(True) if cap is None else F.coalesce(F.col("tier") <= cap, F.lit(False)))).alias(f"c{i}") for i, (_, _, n, cap) in enumerate(sizes)))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(tag).alias("tag"), F.lit(part).alias("part"), F.col(f"c{i}").alias("n")) for i, (tag, part, _, _) in enumerate(sizes)))).alias("r")).select("r.*")


@query("""with a as (select event_id, value > 50 ok, sum((value > 50)::int) over (order by event_id) accepts, row_number() over (order by event_id) n from events)
    select count(*) decided, max(accepts)::bigint accepted, max(event_id) + 1 high_water from a where n <= (select coalesce(min(n), 9e18::bigint) from a where ok and accepts = 100)""")
def running_accept_stop(spark, sf_dir):
    rows = dedup.running_accepts(table(spark, sf_dir, "events").select("event_id", "value"), F.col("value") > 50, "event_id", 100)
    return rows.agg(F.count("*").alias("decided"), F.max("accepts").alias("accepted"), (F.max("event_id") + 1).alias("high_water"))


@query("""with a as (select event_id, value > 149 ok, sum((value > 149)::int) over (order by event_id) k, row_number() over (order by event_id) n from events)
    select min(event_id) stop_at from a where ok and n > 10 * 30 and k < 30 // 2""")
def high_rejection_stop(spark, sf_dir):
    wanted, ok = 30, F.col("value") > 149
    rows = dedup.running_accepts(table(spark, sf_dir, "events").select("event_id", "value"), ok, "event_id", wanted)
    return rows.where(ok & (F.col("n_before") > 10 * wanted) & (F.col("accepts") < wanted // 2)).agg(F.min("event_id").alias("stop_at"))


@query("""select doc_id, coalesce(l.n, 0) labels, case when l.n is null then 'missing execution result' end error from documents
    left join (select doc_id, count(*) n from doc_labels group by 1) l using (doc_id)""")
def left_missing_result(spark, sf_dir):
    labels = table(spark, sf_dir, "doc_labels").groupBy("doc_id").agg(F.count("*").alias("labels")).withColumn("success", F.lit(True)).withColumn("error", F.lit(None).cast("string"))
    joined = validity.attempts_with_results(table(spark, sf_dir, "documents").select("doc_id"), labels, "doc_id")
    return joined.select("doc_id", F.coalesce("labels", F.lit(0)).alias("labels"), "error")


@query("""select m.part_id, f.format from (select distinct part_id from manifest) m, (values ('step'), ('stl'), ('py')) f(format)
    where not exists (select 1 from parts p where p.part_id = m.part_id and f.format = 'py')""")
def incremental_todo(spark, sf_dir):
    have = table(spark, sf_dir, "parts").select("part_id", F.lit("py").alias("format"))
    return lookups.missing_artifacts(table(spark, sf_dir, "manifest").select("part_id").distinct(), ["step", "stl", "py"], have)


@query("select distinct part_id from manifest m where not exists (select 1 from parts p where p.part_id = m.part_id)")
def parts_to_export(spark, sf_dir):
    have = table(spark, sf_dir, "parts").select("part_id", F.lit("py").alias("format"))
    return lookups.parts_to_export(table(spark, sf_dir, "manifest").select("part_id").distinct(), ["py"], have)


@query("select p.part_id, p.rel_path from parts p where p.rel_path in (select paths['py'] from manifest)")
def staged_semi(spark, sf_dir):
    names = table(spark, sf_dir, "manifest").select(F.col("paths")["py"].alias("rel_path"))
    return table(spark, sf_dir, "parts").select("part_id", "rel_path").join(names, "rel_path", "left_semi")


@query("""select m.part_id, m.path, p.n_bytes from (select distinct part_id, paths['py'] path from manifest) m left join
    (select rel_path, max(n_bytes) n_bytes from parts group by 1) p on p.rel_path = m.path""")
def source_by_path(spark, sf_dir):
    paths = table(spark, sf_dir, "manifest").select("part_id", F.col("paths")["py"].alias("path")).distinct()
    sizes = table(spark, sf_dir, "parts").groupBy(F.col("rel_path").alias("path")).agg(F.max("n_bytes").alias("n_bytes"))
    return paths.join(sizes, "path", "left").select("part_id", "path", "n_bytes")


_TAGS = "(values ('1k'), ('50k'), ('1.5k'), ('2M'), (' 7 '), ('junk'), ('3g')) t(tag)"


def _tags(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(x,) for x in ("1k", "50k", "1.5k", "2M", " 7 ", "junk", "3g")], "tag string")


@query(f"select tag from {_TAGS} where tag not in (select tag from ladder)")
def unknown_tags(spark, sf_dir):
    return lookups.unknown_tags(_tags(spark), table(spark, sf_dir, "ladder"))


_PARSE = "coalesce(cast(try_cast(regexp_replace(lower(trim(tag)), '[km]$', '') as double) * case right(lower(trim(tag)), 1) when 'k' then 1000 when 'm' then 1000000 else 1 end as bigint), 0)"


@query(f"select tag, {_PARSE} n from {_TAGS}")
def tag_parse(spark, sf_dir):
    return _tags(spark).select("tag", fx.tag_to_int("tag").alias("n"))


@query(f"select tag, coalesce(l.part_count, {_PARSE}) count, coalesce(l.seed::varchar, '—') seed from {_TAGS} left join ladder l using (tag)")
def ladder_table(spark, sf_dir):
    ladder = table(spark, sf_dir, "ladder").select("tag", F.col("part_count").alias("count"), "seed")
    return lookups.ladder_rows(_tags(spark), ladder, fx.tag_to_int("tag"))


@query("select max(part_count) base_count, case when max(part_count) >= 1000000 then '1M<n<10M' when max(part_count) >= 100000 then '100K<n<1M' when max(part_count) >= 10000 then '10K<n<100K' when max(part_count) >= 1000 then '1K<n<10K' else 'n<1K' end bucket from ladder")
def ladder_size(spark, sf_dir):
    return table(spark, sf_dir, "ladder").agg(F.max("part_count").alias("base_count")).withColumn("bucket", fx.size_bucket("base_count"))


@query("""select tag, s.part, v.suffix, tag || s.part || v.suffix config_name from ladder, (values (''), ('-t0-2')) s(part),
    (values (''), ('-renders'), ('-stl'), ('-step'), ('-geo'), ('-full')) v(suffix)""")
def variant_grid(spark, sf_dir):
    slices = spark.createDataFrame([(part,) for _, part, _ in TIER_SLICES], "part string")
    variants = spark.createDataFrame([(v[0],) for v in VARIANTS], "suffix string")
    return lookups.variant_grid(table(spark, sf_dir, "ladder").select("tag"), slices, variants)


@query("""select 'render_' || v || case p when 'shaded' then '' else '_' || p end col, v || case p when 'shaded' then '' else '_' || p end || '.png' file from
    (values ('front'), ('top'), ('right'), ('iso'), ('iso_fr'), ('iso_fl'), ('iso_br'), ('iso_bl')) x(v), (values ('shaded'), ('normal'), ('depth'), ('edge')) y(p)""")
def render_column_grid(spark, sf_dir):
    views, passes = spark.createDataFrame([(v,) for v in VIEWS], "v string"), spark.createDataFrame([(p,) for p in PASSES], "p string")
    return views.crossJoin(F.broadcast(passes)).select(fx.render_column("v", "p").alias("col"), fx.render_filename("v", "p").alias("file"))


@query("select user_id, min(value) filter (event_type = 'view') \"view\", min(value) filter (event_type = 'error') \"error\", min(value) filter (event_type = 'purchase') purchase from events group by 1")
def pivot_views(spark, sf_dir):
    return corpus.wide(table(spark, sf_dir, "events"), "user_id", F.col("event_type"), "value", ["view", "error", "purchase"])


@query(f"select doc_id, {_SEED.format(i='doc_id')} part_seed, 'doc_' || printf('%08x', {_SEED.format(i='doc_id')}) || '_' || case when doc_id < 1000 then printf('%04d', doc_id) else doc_id::varchar end part_id from documents")
def seed_stream(spark, sf_dir):
    seed = fx.part_seed(42, "doc_id")
    return table(spark, sf_dir, "documents").select("doc_id", seed.alias("part_seed"), fx.part_id(F.lit("doc"), seed, "doc_id").alias("part_id"))


@query("select doc_id, substr(sha256(text), 1, 16) h from documents")
def content_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", fx.content_hash("text").alias("h"))


_HEX = "concat('0x', substr(md5(part_id), {a}, {n}))::bigint::double"


@query(f"""select distinct part_id, {_HEX.format(a=1, n=8)} / 4294967296.0::double h, 0.62::double + {_HEX.format(a=9, n=2)} / 255.0::double * 0.23::double s, 0.82::double + {_HEX.format(a=11, n=2)} / 255.0::double * 0.13::double v from manifest""")
def color_hash(spark, sf_dir):
    hsv = fx.color_hsv("part_id")
    return table(spark, sf_dir, "manifest").select("part_id").distinct().select("part_id", hsv["h"].alias("h"), hsv["s"].alias("s"), hsv["v"].alias("v"))


@query("select distinct part_id, case when instr(part_id, '_') > 0 then coalesce(try_cast(regexp_extract(part_id, '([^_]*)$', 1) as bigint), 0) else 0 end attempt from manifest")
def id_suffix(spark, sf_dir):
    return table(spark, sf_dir, "manifest").select("part_id").distinct().select("part_id", fx.id_suffix("part_id").alias("attempt"))


@query("select c_custkey, case when abs(c_acctbal - round(c_acctbal)) < 1e-6 then cast(round(c_acctbal) as bigint)::varchar else rtrim(rtrim(printf('%.3f', c_acctbal), '0'), '.') end n from customer")
def fmt_num(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", fx.fmt_num("c_acctbal").alias("n"))


_PATTERN = "(select p_partkey, (['corners','grid','bolt_circle','staggered','spiral'])[p_size % 5 + 1] placement, p_size % 7 nx, p_size % 3 ny, p_size % 9 bolts from part)"


def _patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(*map(F.lit, ("corners", "grid", "bolt_circle", "staggered", "spiral")))
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select("p_partkey", F.element_at(kinds, (size % 5 + 1).cast("int")).alias("placement"), (size % 7).alias("nx"), (size % 3).alias("ny"), (size % 9).alias("bolts"))


@query(f"""select p_partkey, case placement when 'corners' then 4 when 'grid' then greatest(nx, 1) * greatest(ny, 1) when 'bolt_circle' then greatest(bolts, 1) when 'staggered' then 2 * greatest(nx, 2) - 1 else 0 end n from {_PATTERN}""")
def hole_count(spark, sf_dir):
    return _patterns(spark, sf_dir).select("p_partkey", fx.hole_count("placement", "nx", "ny", "bolts").alias("n"))


@query("select p_partkey, case p_size when 1 then 'One' when 2 then 'Two' when 3 then 'Three' when 4 then 'Four' when 5 then 'Five' when 6 then 'Six' when 7 then 'Seven' when 8 then 'Eight' when 9 then 'Nine' when 10 then 'Ten' when 12 then 'Twelve' else p_size::varchar end || ' ' || case when p_size = 1 then 'hole' else 'holes' end w from part")
def count_word(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", fx.count_word("p_size"), fx.plural("p_size", "hole")).alias("w"))


@query(f"""select p_partkey, case placement when 'corners' then 'at the corners, ' || nx || ' × ' || ny || ' mm spacing' when 'grid' then 'in a ' || greatest(nx, 1) || '×' || greatest(ny, 1) || ' grid, ' || nx || ' × ' || ny || ' mm pitch'
    when 'bolt_circle' then 'on a Ø' || bolts * 2 || ' mm bolt circle' when 'staggered' then 'in two staggered rows, ' || nx || ' × ' || ny || ' mm pitch' else '' end w from {_PATTERN}""")
def placement_phrase(spark, sf_dir):
    return _patterns(spark, sf_dir).select("p_partkey", fx.placement_phrase("placement", "nx", "ny", "nx", "ny", "bolts").alias("w"))


@query("""select standard, size, major, pitch, case standard when 'iso' then 'M' || format('{:g}', major) || 'x' || format('{:g}', pitch) when 'acme' then 'ACME ' || size else 'Tr ' || size end name from
    (values ('iso', null, 8.0::double, 1.25::double), ('iso', null, 16.0, 2.0), ('acme', '1/2', null, null), ('metric_trapezoidal', '8x1.5', null, null)) t(standard, size, major, pitch)""")
def designation(spark, sf_dir):
    rows = spark.createDataFrame([("iso", None, 8.0, 1.25), ("iso", None, 16.0, 2.0), ("acme", "1/2", None, None), ("metric_trapezoidal", "8x1.5", None, None)], "standard string, size string, major double, pitch double")
    return rows.withColumn("name", fx.designation("standard", "size", "major", "pitch"))


@query("""select p_partkey, p_retailprice * 0.7::double scaled, least(p_size::double, p_retailprice) * 0.5::double lesser, least(p_size::double, 10.0) clamped, p_retailprice / 2 half, 40.0::double literal, 'p["a"] * 0.7' code from part""")
def expr_eval(spark, sf_dir):
    params = F.create_map(F.lit("a"), F.col("p_retailprice"), F.lit("b"), F.col("p_size").cast("double"))

    def expr(**fields):
        names = [x.split(":")[0].strip() for x in EXPR_TYPE[7:-1].split(",")]
        kinds = [x.split(":")[1].strip() for x in EXPR_TYPE[7:-1].split(",")]
        return F.struct(*(F.lit(fields.get(n)).cast(k).alias(n) for n, k in zip(names, kinds)))

    made = {
        "scaled": expr(type="scaled", param="a", factor=0.7), "lesser": expr(type="min2", param_a="b", param_b="a", factor=0.5), "clamped": expr(type="clamp", param="b", limit=10.0),
        "half": expr(type="half", param="a"), "literal": expr(type="literal", value=40.0),
    }
    return table(spark, sf_dir, "part").select("p_partkey", *(evaluate(e, params).alias(n) for n, e in made.items()), source_text(made["scaled"]).alias("code"))


@query("""select c, 0.12::double + (0.02::double - 0.12::double) * k n_lo, 1.7::double + (1.0::double - 1.7::double) * k width from (select c, greatest(0.0::double, least(1.0::double, c)) k from (values (-5.0::double), (0.0), (0.25), (0.6), (1.0), (5.0)) t(c))""")
def edge_params(spark, sf_dir):
    rows = spark.createDataFrame([(c,) for c in (-5.0, 0.0, 0.25, 0.6, 1.0, 5.0)], "c double").withColumn("e", fx.edge_params("c"))
    return rows.select("c", "e.n_lo", "e.width")


@query("""select event_id, case when u * 1.2::double < 0.5::double then 'plate' when u * 1.2::double < 0.8::double then 'block' else 'gear' end family from (select event_id, (event_id % 1000) / 1000.0::double u from events)""")
def weighted_bucket(spark, sf_dir):
    weights = spark.createDataFrame([(0, "plate", 0.5), (1, "block", 0.3), (2, "gear", 0.4)], "pos int, family string, weight double")
    rows = table(spark, sf_dir, "events").select("event_id", ((F.col("event_id") % 1000) / F.lit(1000.0)).alias("u"))
    return lookups.weighted_choice(rows, weights, F.col("u")).select("event_id", "family")


@query("select w.family, w.weight / sum(w.weight) over () share from (values ('plate', 0.18::double), ('gear', 0.06::double), ('hinged', 0.2::double)) w(family, weight) where w.family in (select family from manifest)")
def family_weights(spark, sf_dir):
    weights = spark.createDataFrame([("plate", 0.18), ("gear", 0.06), ("hinged", 0.2)], "family string, weight double")
    return lookups.renormalised(weights, table(spark, sf_dir, "manifest").select("family"))


_STOCK = STOCK_THICKNESSES


@query(f"""select p_partkey, coalesce((select s from unnest({_STOCK}::double[]) t(s) where s between 3 and 16 order by abs(s - p_size), s limit 1), p_size) snapped from part""")
def standards_snap(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", fx.snap_to(_STOCK, "p_size", F.lit(3), F.lit(16)).alias("snapped"))


@query("select vec_id, array_to_string(list_transform(list_sort(embedding[1:3]), lambda x: cast(cast(round_even(x::double * 1000, 0) as bigint) as varchar)), ',') moments from embeddings")
def moments_sorted(spark, sf_dir):
    parts = F.transform(F.array_sort(F.slice("embedding", 1, 3)), lambda x: F.rint(x.cast("double") * 1000).cast("bigint").cast("string"))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.array_join(parts, ",").alias("moments"))


@query("select doc_id, substr(sha256(text), 1, 16) h from (select *, row_number() over (partition by text order by doc_id) r from documents where text is not null) where r = 1")
def append_resume(spark, sf_dir):
    """A corpus deduplicated in two steps, the second against the state of the first; equal to one step."""
    docs = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", fx.content_hash("text").alias("h"))
    half = docs.agg(F.expr("percentile_approx(doc_id, 0.5)")).first()[0] or 0
    first = dedup.accepted_firsts(docs.where(F.col("doc_id") <= half), [F.col("h")], ["doc_id"])
    second = dedup.accepted_firsts(dedup.not_seen(docs.where(F.col("doc_id") > half), first, ["h"]), [F.col("h")], ["doc_id"])
    return first.unionByName(second)


@query("select event_id, json_extract_string(props, '$.k') k from events")
def params_defaults(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("select part_id, array_to_string(dimensions.lines, ' ') text from manifest where dimensions.lines is not null and len(dimensions.lines) > 0")
def describe_text(spark, sf_dir):
    """The lines of each record joined again in order, after a shuffle by record."""
    rows = table(spark, sf_dir, "manifest").where("size(dimensions.lines) > 0")
    keyed = rows.withColumn("key", F.struct("part_id", F.col("_metadata.row_index").alias("row"), F.col("_metadata.file_name").alias("file")))
    rows = keyed.select("key", F.posexplode("dimensions.lines").alias("pos", "line"))
    return corpus.joined_text(rows, "key", "pos", "line").select("key.part_id", "text")


@query(f"""select part_id, {_SIG.format(v='geometry_signature.volume')} volume, list_transform(list_sort(geometry_signature.principal_moments), lambda x: {_SIG.format(v='x')})::varchar moments
    from manifest where geometry_signature.version = 2""")
def signature_build(spark, sf_dir):
    g = "geometry_signature"
    rows = table(spark, sf_dir, "manifest").where(f"{g}.version = 2")
    s = fx.signature(f"{g}.volume", f"{g}.surface_area", f"{g}.principal_moments", f"{g}.n_faces", f"{g}.n_edges", f"{g}.n_vertices")
    rows = rows.select("part_id", s.alias("s")).withColumn("s", fx.signature_from_json(fx.signature_json("s")))
    return rows.select("part_id", "s.volume", F.concat(F.lit("["), F.array_join(F.transform("s.principal_moments", lambda x: x.cast("string")), ", "), F.lit("]")).alias("moments"))


SQL.pop("signature_build")  # the engines write doubles differently


@query()
def params_exploded(spark, sf_dir):
    """One row per parameter of every emitted source."""
    return params_text.explode_params(table(spark, sf_dir, "parts"))


@query("""with h as (select *, row_number() over (partition by ir_hash order by attempt, loaded_at) r from manifest)
    select count(*) total, count(*) filter (coalesce(tier, -1) < 0) failed, count(distinct coalesce(ir_hash, '')) filter (coalesce(tier, -1) >= 0) ok from h""")
def verify_marks(spark, sf_dir):
    rows = dedup.mark_duplicates(table(spark, sf_dir, "manifest"), [F.col("ir_hash")], ["attempt", "loaded_at"], F.col("tier") >= 0)
    return rows.agg(F.count("*").alias("total"), F.count_if(F.col("status") == "FAIL").alias("failed"), F.count_if(F.col("status") == "ok").alias("ok"))


@query("select case when kind is null then 'all' else kind end kind, count(*) n from (select regexp_extract(rel_path, '([^/]+)/', 1) kind from small_files where rel_path is not null) group by rollup (kind)")
def export_tallies(spark, sf_dir):
    kinds = table(spark, sf_dir, "small_files").where("rel_path is not null").select(F.regexp_extract("rel_path", "([^/]+)/", 1).alias("kind"))
    return kinds.rollup("kind").agg(F.count("*").alias("n")).select(F.coalesce("kind", F.lit("all")).alias("kind"), "n")


@query("select part_id, family, tier, op_count from manifest where part_id = (select min(part_id) from manifest)")
def part_lookup(spark, sf_dir):
    rows = table(spark, sf_dir, "manifest")
    wanted = rows.agg(F.min("part_id")).first()[0]
    return rows.where(F.col("part_id") == wanted).select("part_id", "family", "tier", "op_count")


@query("""select user_id, min(ts) first_ts, max(ts) last_ts, count(*) n from (select *, sum(new) over (partition by user_id order by ts, event_id) s from
    (select *, case when ts - lag(ts) over (partition by user_id order by ts, event_id) <= interval 30 minute then 0 else 1 end new from events)) group by user_id, s""")
def event_sessions(spark, sf_dir):
    """Sessions of events with gaps of at most 30 minutes, by windows; late or repeated events fall into place."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gap = F.col("ts") - F.lag("ts").over(w) <= F.expr("interval 30 minutes")
    rows = table(spark, sf_dir, "events").withColumn("new", F.when(gap, 0).otherwise(1))
    return rows.withColumn("s", F.sum("new").over(w)).groupBy("user_id", "s").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count("*").alias("n")).drop("s")


_SIGS = ", ".join(_SIG.format(v=v) for v in ("volume", "surface_area", "moments[1]", "moments[2]", "moments[3]"))
_DECIDED = f"""(select *, case when reason <> '' then 'invalid' when row_number() over (partition by reason <> '', {_SIGS}, len(moments), n_faces, n_edges, n_vertices order by cand_id) = 1 then 'accepted' else 'duplicate' end decision
    from (select distinct cand_id, family, {_REASON} reason, volume, surface_area, list_sort(principal_moments) moments, n_faces, n_edges, n_vertices from exec_results))"""


def _decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "exec_results").withColumnRenamed("cand_id", "attempt").drop("arrived_at", "traceback", "batch_no")
    return pipeline.decide(rows.dropDuplicates())


@query(f"""select cand_id, decision, count(*) n from (select cand_id, case when reason <> '' then 'invalid' when row_number() over (partition by reason <> '', {_SIGS}, len(moments), n_faces, n_edges, n_vertices order by cand_id) = 1 then 'accepted' else 'duplicate' end decision
    from (select cand_id, {_REASON} reason, volume, surface_area, list_sort(principal_moments) moments, n_faces, n_edges, n_vertices from exec_results)) group by 1, 2""")
def decisions_with_copies(spark, sf_dir):
    """Decisions over the table as it stands: of a candidate sent twice one row at most is accepted."""
    rows = table(spark, sf_dir, "exec_results").withColumnRenamed("cand_id", "attempt").drop("arrived_at", "traceback")
    return pipeline.decide(rows).groupBy(F.col("attempt").alias("cand_id"), "decision").agg(F.count("*").alias("n"))


@query(f"select cand_id, reason, decision from {_DECIDED}")
def generate_decisions(spark, sf_dir):
    """The flagship: each candidate's validity and, in order, whether it is the first of its signature."""
    return _decided(spark, sf_dir).select(F.col("attempt").alias("cand_id"), "reason", "decision")


@query(f"select count(*) attempts, count(*) filter (decision = 'invalid') invalid, count(*) filter (decision = 'duplicate') duplicates, count(*) filter (decision = 'accepted') accepted from {_DECIDED}")
def generate_counters(spark, sf_dir):
    return corpus.run_counters(_decided(spark, sf_dir))


@query(f"""select family, n, round_even(n * 100.0::double / sum(n) over (), 1) pct, row_number() over (order by n desc, f) rank from
    (select coalesce(family, 'unknown') family, count(*) n, min(cand_id) f from {_DECIDED} where decision = 'accepted' group by 1)""")
def generate_shares(spark, sf_dir):
    kept = _decided(spark, sf_dir).where("decision = 'accepted'")
    return corpus.shares(kept, F.coalesce("family", F.lit("unknown")), "family", "attempt")


@query("""select m.part_id, m.family, m.tier, coalesce(license, 'CC0-1.0') license, nullif(generator_version, '') generator_version, dimensions.text dimensions, p.params from
    (select *, row_number() over (order by attempt) - 1 ordinal from (select * from manifest qualify row_number() over (partition by attempt order by loaded_at, part_id) = 1)) m
    left join (select part_id, min(params) params from parts group by 1) p using (part_id) where ordinal < 500 and part_id <> '' and tier <= 2""")
def packed_slice(spark, sf_dir):
    """A published slice: the first 500 records, tiers 0 to 2, with their parameters."""
    first = table(spark, sf_dir, "manifest").groupBy("attempt").agg(F.min_by(F.struct(*(c for c in table(spark, sf_dir, "manifest").columns if c != "attempt")), F.struct("loaded_at", "part_id")).alias("r")).select("attempt", "r.*")
    params = table(spark, sf_dir, "parts").groupBy(F.col("part_id").alias("name")).agg(F.min("params").alias("text"))
    rows = packed(corpus.with_ordinal(first, "attempt"), limit=500, tier_max=2, params=params, as_text=True)
    return rows.select("part_id", "family", "tier", "license", "generator_version", "dimensions", "params")


@query("select event_id, event_type, value from events qualify row_number() over (partition by event_type, value order by event_id) = 1")
def stream_dedup(spark, sf_dir):
    """First-wins over a stream of ordered ranges, equal to the batch result."""
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    source = fresh_path(spark, "stream_source")
    edges = rows.agg(F.expr("percentile_approx(event_id, array(0.25, 0.5, 0.75))")).first()[0] or []
    for lo, hi in zip([None, *edges], [*edges, None]):
        part = rows if lo is None else rows.where(F.col("event_id") > lo)
        (part if hi is None else part.where(F.col("event_id") <= hi)).coalesce(1).write.mode("append").parquet(source)
    return dedup_stream(spark, source, rows.schema, [F.col("event_type"), F.col("value")], ["event_id"], fresh_path(spark, "stream_state"), fresh_path(spark, "stream_checkpoint"))
