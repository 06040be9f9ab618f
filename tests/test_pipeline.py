import random

import pytest
from pyspark.sql import functions as F

from gneiss.functions.scalars import content_hash
from gneiss.operators.corpus import with_ordinal
from gneiss.plans import pipeline
from gneiss.streaming.dedup import FirstWinsSink, dedup_stream, windowed_counts

RESULT = "attempt bigint, success boolean, error string, volume double, surface_area double, bbox array<double>, principal_moments array<double>, n_faces int, n_edges int, n_vertices int, n_solids int"


def shape_of(i):
    """A fixed execution result for an attempt: some fail, some repeat earlier shapes, some are missing."""
    rng = random.Random(i)
    kind = rng.randint(0, 60)
    ok = rng.random() > 0.1
    v = 1000.0 * (kind + 1) * (1 + rng.random() / 5000)
    return None if rng.random() < 0.03 else (i, ok, None if ok else "boom", v if ok else None, v / 3, [0.0, 0.0, 0.0, 4.0, 5.0, 6.0], [v * 3, v, v * 2], kind % 7, 12, 8, 1)


def sequential(n, count):
    seen, kept = set(), []
    for i in range(n):
        r = shape_of(i)
        if r is None or not r[1]:
            continue
        key = tuple(float(f"{x:.3g}") for x in (r[3], r[4], *sorted(r[6]))) + r[7:10]
        if key not in seen:
            seen.add(key)
            kept.append(i)
            if len(kept) == count:
                break
    return kept


@pytest.fixture(scope="module")
def execute(spark):
    table = spark.createDataFrame([r for i in range(3000) if (r := shape_of(i))], RESULT).repartition(4).cache()
    return lambda todo: table.join(todo.select("attempt"), "attempt", "left_semi")


def ids(c):
    return [r.attempt for r in c.records.orderBy("attempt").collect()]


def test_generate_takes_first_wins_in_order(spark, execute):
    got = pipeline.generate(spark, execute, 42, 40, window=50)
    want = sequential(3000, 40)
    assert ids(got) == want and got.accepted == 40 and got.attempted == want[-1] + 1


@pytest.mark.parametrize("window", [20, 400])
def test_extending_equals_starting_afresh(spark, execute, window):
    first = pipeline.generate(spark, execute, 42, 20, window=window)
    more = pipeline.generate(spark, execute, 42, 40, known=first, window=window)
    fresh = pipeline.generate(spark, execute, 42, 40, window=window)
    assert ids(more) == ids(fresh) == sequential(3000, 40) and more.attempted == fresh.attempted
    again = pipeline.generate(spark, execute, 42, 40, known=more)
    assert again.records is more.records and again.accepted == 40


def test_generate_stops_when_most_is_rejected(spark):
    poor = spark.createDataFrame([(i, True, None, 5000.0 + 100 * (i // 100), 100.0, [0.0, 0.0, 0.0, 4.0, 5.0, 6.0], [1.0, 2.0, 3.0], 1, 2, 3, 1) for i in range(2000)], RESULT)
    got = pipeline.generate(spark, lambda todo: poor.join(todo.select("attempt"), "attempt", "left_semi"), 1, 20, window=2000)
    assert ids(got) == [0, 100, 200] and got.accepted == 3 and got.attempted == 201  # the first accept after 10 * 20 attempts


def test_extension_guards():
    state = {"seed": 1, "generator_version": "0.6", "accepted": 10}
    pipeline.may_extend(state, 1, "0.6")
    pipeline.may_extend(state, 2, "0.6", force=True)
    for seed, version in ((2, "0.6"), (1, "0.7")):
        with pytest.raises(ValueError):
            pipeline.may_extend(state, seed, version)
    assert [pipeline.next_step(s, n, "0.6") for s, n in ((None, 5), (state, 5), (state, 20), (state | {"generator_version": "0.5"}, 5))] == ["build", "reuse", "extend", "rebuild"]


def test_annotate_keeps_records_whose_content_changed(spark):
    h = spark.createDataFrame([("same",)], "canon string").select(content_hash("canon").alias("h")).first().h
    manifest = spark.createDataFrame([("a", h, "old", None), ("b", "other", "old", "x"), ("c", h, "old", None)], "part_id string, ir_hash string, dimensions string, descriptor string")
    derived = spark.createDataFrame([("a", "same", "new", "gear"), ("b", "same", "new", "gear")], "part_id string, canon string, dimensions string, descriptor string")
    got = {r.part_id: (r.dimensions, r.descriptor, r.mismatch) for r in pipeline.annotate(manifest, derived).collect()}
    assert got == {"a": ("new", "gear", False), "b": ("old", "x", True), "c": ("old", None, True)}


def test_publish_slices_one_base(spark, tmp_path):
    rows = [(f"p{i}", "gear", i % 4, i) for i in range(20)]
    m = spark.createDataFrame(rows, "part_id string, family string, tier int, seed bigint").withColumns({"symmetry": F.lit("none"), "op_count": F.lit(1), "ir_hash": F.lit("h"), "license": F.lit("L"), "generator_version": F.lit("1"), "dimensions": F.struct(F.lit("t").alias("text")), "geometry_signature": F.lit(None).cast("struct<volume: double>")})
    stl = spark.createDataFrame([("p0", b"x")], "part_id string, stl_bytes binary")
    built = pipeline.publish(with_ordinal(m, "seed"), [("5", 5), ("all", None), ("0", 0)], str(tmp_path), artifacts={"stl": stl})
    assert [b["config_name"] for b in built] == ["5", "5-stl", "5-t0-2", "5-t0-2-stl", "all", "all-stl", "all-t0-2", "all-t0-2-stl"]
    counts = [spark.read.json(b["data_file"]).count() if not b["stl"] else spark.read.parquet(b["data_file"]).count() for b in built]
    assert counts == [5, 5, 4, 4, 20, 20, 15, 15]
    assert not pipeline.publish(with_ordinal(m.limit(0), "seed"), [("5", 5)], str(tmp_path / "e"))


def test_stream_equals_batch_and_survives_a_repeat(spark, tmp_path):
    rng = random.Random(8)
    data = [(i, rng.randint(0, 40) if i % 11 else None) for i in range(300)]
    source = tmp_path / "in"
    for k in range(3):
        spark.createDataFrame(data[k * 100 : k * 100 + 100], "i long, v int").repartition(1).write.mode("append").parquet(str(source))
    schema = spark.read.parquet(str(source)).schema
    got = dedup_stream(spark, str(source), schema, [F.coalesce("v", F.lit(-1))], ["i"], str(tmp_path / "s"), str(tmp_path / "c"))
    seen, want = set(), []
    for i, v in data:
        if v not in seen:
            seen.add(v)
            want.append(i)
    assert sorted(r.i for r in got.collect()) == want
    sink = FirstWinsSink(spark, str(tmp_path / "s2"), [F.col("v")], ["i"])
    parts = [spark.createDataFrame(data[a : a + 150], "i long, v int").where("v is not null") for a in (0, 150)]
    for number, part in ((0, parts[0]), (1, parts[1]), (1, parts[1])):
        sink(part, number)
    first = {}
    for i, v in data:
        if v is not None:
            first.setdefault(v, i)
    assert sorted(r.i for r in sink.accepted(parts[0].schema).collect()) == sorted(first.values())


def test_windowed_counts(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    got = windowed_counts(events)
    assert got.agg(F.sum("n")).first()[0] == events.count()
