import colorsys
import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from gneiss.functions import scalars as fx
from gneiss.functions.expressions import EXPR_TYPE, evaluate, python_float, source_text


def one(spark, column, **values):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()) or [F.lit(1)]).select(column.alias("x")).first().x


def round_sig(v, n=3):
    if v == 0:
        return 0.0
    p = float(f"1e{n - 1 - math.floor(math.log10(abs(v)))}")
    return round(v * p) / p


def test_round_sig_on_fixed_and_random_values(spark):
    rng = random.Random(1)
    values = [12345.678, 0.001234, 0.0, 1245.0, -7.345, *(rng.uniform(-1, 1) * 10 ** rng.randint(-8, 14) for _ in range(3000))]
    got = [r.x for r in spark.createDataFrame([(v,) for v in values], "v double").coalesce(1).select(fx.round_sig("v").alias("x")).collect()]
    assert got == [round_sig(v) for v in values]
    assert got[:5] == [12300.0, 0.00123, 0.0, 1240.0, -7.34]


def test_signature_sorts_before_rounding_and_survives_json(spark):
    df = spark.createDataFrame([(1000.4, 599.9, [300.0, 100.0, 200.0])], "v double, a double, m array<double>")
    s = fx.signature("v", "a", "m", F.lit(6), F.lit(12), F.lit(8))
    r = df.select(s.alias("s"), fx.signature_from_json(fx.signature_json(s)).alias("t")).first()
    assert r.s == r.t and r.s.principal_moments == [100.0, 200.0, 300.0] and r.s.version == 2
    assert one(spark, fx.signature_json(F.lit(None).cast(fx.SIGNATURE_TYPE))) == "null"
    assert one(spark, fx.signature_from_json(F.lit("null"))) is None
    bare = one(spark, fx.signature_from_json(F.lit('{"volume": 5.0}')))
    assert bare.version == 2 and bare.principal_moments == []


@pytest.mark.parametrize("tag,n", [("50k", 50000), ("1m", 1_000_000), ("1.5K", 1500), (" 7 ", 7), ("junk", 0), ("", 0)])
def test_tag_to_int(spark, tag, n):
    assert one(spark, fx.tag_to_int("t"), t=tag) == n


@pytest.mark.parametrize("name,n", [("plate_0280deff_0042", 42), ("a_b", 0), ("plain7", 0), ("x_10031", 10031)])
def test_id_suffix(spark, name, n):
    assert one(spark, fx.id_suffix("t"), t=name) == n


@pytest.mark.parametrize("v,text", [(80.0, "80"), (5.5, "5.5"), (12.345, "12.345"), (0.0, "0"), (100.0, "100"), (-3.1, "-3.1"), (2.9999999, "3")])
def test_fmt_num(spark, v, text):
    assert one(spark, fx.fmt_num("v"), v=v) == text


def test_seed_and_id(spark):
    seed = 1234
    r = spark.range(5).select(fx.part_id(F.lit("gear"), fx.part_seed(seed, "id"), "id").alias("x")).collect()
    assert [x.x for x in r] == [f"gear_{(seed * 1_000_003 + i) & 0xFFFFFFFF:08x}_{i:04d}" for i in range(5)]
    assert one(spark, fx.part_seed(1 << 62, F.lit(7))) == ((1 << 62) * 1_000_003 + 7) & 0xFFFFFFFF


def test_colours_match_a_model(spark):
    names = [f"part{i}" for i in range(200)] + ["", "Ø"]
    hsv = fx.color_hsv("n")
    got = spark.createDataFrame([(n,) for n in names], "n string").coalesce(1).select(fx.hsv_to_rgb(hsv).alias("c")).collect()
    for n, r in zip(names, got):
        d = hashlib.md5(n.encode()).digest()
        want = colorsys.hsv_to_rgb(int.from_bytes(d[:4], "big") / 2**32, 0.62 + d[4] / 255 * 0.23, 0.82 + d[5] / 255 * 0.13)
        assert tuple(r.c) == pytest.approx(want, abs=1e-12)


def test_words(spark):
    assert [one(spark, fx.count_word(F.lit(n))) for n in (1, 4, 11, 12, 30)] == ["One", "Four", "11", "Twelve", "30"]
    assert one(spark, fx.face_name(F.lit(">Z"))) == "top face" and one(spark, fx.face_name(F.lit("#Z"))) == "the #Z face"
    assert one(spark, fx.edge_name(F.lit("|Z"))) == "vertical edges"
    assert one(spark, fx.designation(F.lit("iso"), F.lit(None), F.lit(16.0), F.lit(2.0))) == "M16x2"
    assert one(spark, fx.whole_or(F.lit(2.5), 9)) == 2 and one(spark, fx.whole_or(F.lit("x"), 9)) == 9


def test_edge_params_clamp(spark):
    low, zero, high, top = (one(spark, fx.edge_params(F.lit(c))) for c in (-5.0, 0.0, 5.0, 1.0))
    assert low == zero and high == top and zero.n_lo == pytest.approx(0.12) and top.width == pytest.approx(1.0)


def test_settings_and_paths(spark):
    assert one(spark, fx.setting_value(F.lit("w=40"))) == "40" and one(spark, fx.setting_value(F.lit("w=a=b"))) == '"a=b"'
    assert one(spark, fx.setting_name(F.lit("w=a=b"))) == "w"
    assert one(spark, fx.relative_path(F.lit("/a/b/c.py"), F.lit("/a/"))) == "b/c.py" and one(spark, fx.relative_path(F.lit("/x/c.py"), F.lit("/a"))) == "/x/c.py"
    assert one(spark, fx.digits_number(F.lit("v0.6.1"))) == 61


def test_snapping(spark):
    table = [2.0, 3.0, 4.0, 5.0]
    assert one(spark, fx.snap_to(table, F.lit(4.5), F.lit(2), F.lit(9))) == 4.0
    assert one(spark, fx.snap_to(table, F.lit(7.777), F.lit(6), F.lit(9))) == 7.78
    assert one(spark, fx.nice(F.lit(0.52), 0.0, 100.0, F.lit(0.1))) == 50.0 and one(spark, fx.nice(F.lit(0.5234), 0.0, 100.0, F.lit(0.9))) == 52.34


EXPRS = [
    (dict(type="literal", value=40.0), {}, 40.0, "40.0"),
    (dict(type="param", param="plate_w"), {"plate_w": 60.0}, 60.0, 'p["plate_w"]'),
    (dict(type="scaled", param="plate_w", factor=0.7), {"plate_w": 100.0}, 70.0, 'p["plate_w"] * 0.7'),
    (dict(type="min2", param_a="a", param_b="b", factor=0.5), {"a": 30.0, "b": 40.0}, 15.0, 'min(p["a"], p["b"]) * 0.5'),
    (dict(type="min2", param_a="a", param_b="b"), {"a": 30.0, "b": 40.0}, 30.0, 'min(p["a"], p["b"])'),
    (dict(type="clamp", param="x", limit=10.0), {"x": 20.0}, 10.0, 'min(p["x"], 10.0)'),
    (dict(type="half", param="outer_d"), {"outer_d": 30.0}, 15.0, 'p["outer_d"] / 2'),
    (dict(type="min2", param_a="a", param_b="b"), {"a": 30.0}, None, 'min(p["a"], p["b"])'),
]


def test_expressions(spark):
    names = ["type", "param", "param_a", "param_b", "factor", "limit", "value"]
    data = [(tuple(e.get(n) for n in names), p) for e, p, _, _ in EXPRS]
    df = spark.createDataFrame(data, f"e {EXPR_TYPE}, p map<string,double>").coalesce(1)
    got = df.select(evaluate(F.col("e"), F.col("p")).alias("v"), source_text(F.col("e")).alias("t")).collect()
    assert [r.t for r in got] == [t for *_, t in EXPRS]
    assert [r.v for r in got] == pytest.approx([v for _, _, v, _ in EXPRS])


def test_python_float_text(spark):
    rng = random.Random(2)
    short = [0.0, -0.0, 1.0, 0.1, 1e-5, 1.5e-4, 0.00099, 1e16, 1.5e15, 12345678.9, 123456789012.0, 1e7, 9.99e22, -2.5e-7, *(round(rng.uniform(-500, 500), rng.randint(0, 6)) for _ in range(1000))]
    long = [rng.uniform(-1, 1) * 10 ** rng.randint(-12, 20) for _ in range(1000)]
    got = [r.x for r in spark.createDataFrame([(v,) for v in short + long], "v double").coalesce(1).select(python_float(F.col("v")).alias("x")).collect()]
    assert got[: len(short)] == [repr(v) for v in short]
    assert [float(x) for x in got[len(short) :]] == long
