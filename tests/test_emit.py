import ast

import numpy as np
import pytest
from pyspark.sql import functions as F

from gneiss.functions.camera import ANGLES, cameras, look_from, orthographic, view_direction
from gneiss.functions.describe import OP_TYPE
from gneiss.functions.emit import emitted, param_entry
from gneiss.sources.params_text import explode_params, params_literal
from tests.test_describe import lit, op, profile, ref, times

SPEC = "array<struct<name: string, type: string, default: string, min: double, max: double, step: double, choices: array<string>, grp: string, label: string>>"
PARAMS = [("w", "float", "33.98", 20.0, 120.0, 1.0, None, "Body", "Width (mm)"), ("n", "int", "4", 3.0, 12.0, 1.0, None, "Holes", "Bolts"), ("on", "bool", "true", None, None, None, None, "Body", "it's on"), ("k", "enum", '"a"', None, None, None, ["a", "b"], "Body", "")]


def emit(spark, *ops):
    df = spark.createDataFrame([("p", PARAMS, list(ops))], f"part_id string, params_spec {SPEC}, operations array<{OP_TYPE}>")
    return emitted(df, F.lit("# made here\n"), F.array(F.lit("import b"), F.lit("import a"), F.lit("import b"))).first().source


def test_a_part_is_whole_python(spark):
    text = emit(spark, op("box", width=ref("w"), depth=times("w", 0.5), height=lit(4)), op("holes", {"placement": "bolt_circle"}, diameter=lit(5.3), bolt_circle_r=ref("w"), n_bolts=ref("n")), op("fillet", radius=lit(2), enabled=ref("on")))
    tree = ast.parse(text)
    assert [type(n).__name__ for n in tree.body] == ["Import", "Import", "Import", "Assign", "FunctionDef", "Assign"]
    assert text.startswith("import cadquery as cq\nimport a\nimport b\n# made here\n")
    body = text[text.index("def build") : text.index("    return result")].splitlines()[2:]
    assert body == ["    result = cq.Workplane('XY').box(p[\"w\"], p[\"w\"] * 0.5, 4.0)", "    result = (", "        result.faces('>Z').workplane()", '        .polarArray(p["w"], 0, 360, p["n"])', "        .hole(5.3)", "    )", '    if p["on"]:', "        result = result.edges('|Z').fillet(2.0)"]
    assert params_literal(text)["k"] == {"type": "enum", "default": "a", "choices": ["a", "b"], "group": "Body", "label": ""} and params_literal(text)["on"]["label"] == "it's on"


def test_entries(spark):
    df = spark.createDataFrame([(PARAMS,)], f"p {SPEC}").select(F.explode("p").alias("p"))
    got = [r.t for r in df.coalesce(1).select(param_entry(F.col("p")).alias("t")).collect()]
    assert got[0] == "    \"w\": {\"type\": 'float', \"default\": 33.98, \"min\": 20.0, \"max\": 120.0, \"step\": 1.0, \"group\": 'Body', \"label\": 'Width (mm)'},"
    assert got[1].startswith("    \"n\": {\"type\": 'int', \"default\": 4, \"min\": 3, \"max\": 12, \"step\": 1,")


@pytest.mark.parametrize(
    "o,text",
    [
        (op("extrude", profile=profile("circle", diameter=lit(30)), distance=lit(5)), "result = (cq.Workplane('XY').circle(30.0 / 2).extrude(5.0))"),
        (op("extrude", {"plane": "YZ"}, profile=profile("polygon", sides=lit(6), circumscribed_r=ref("w")), distance=lit(5), taper=lit(2)), "result = (cq.Workplane('YZ').polygon(6.0, p[\"w\"] * 2).extrude(5.0, taper=2.0))"),
        (op("sketched_revolve", profile=profile("sketched", ("w", "n", [("start", 0.0, 0.0), ("line", 0.5, 1.0)]))), "result = (cq.Workplane('XZ').moveTo(p[\"w\"] * 0.0, p[\"n\"] * 0.0).lineTo(p[\"w\"] * 0.5, p[\"n\"] * 1.0).close().revolve())"),
        (op("shell", thickness=lit(2)), "result = result.faces('>Z').shell(-2.0)"),
        (op("pocket", {"face": "<Z"}, width=lit(2), depth=lit(3), pocket_depth=lit(1)), "result = (\n        result.faces('<Z').workplane()\n        .rect(2.0, 3.0)\n        .cutBlind(-1.0)\n    )"),
        (op("counterbore", diameter=lit(5), cb_diameter=lit(9), cb_depth=lit(3)), "result = (\n        result.faces('>Z').workplane()\n        .rect(20, 20, forConstruction=True)\n        .vertices().cboreHole(5.0, 9.0, 3.0)\n    )"),
        (op("countersink", {"placement": "grid"}, diameter=lit(5), cs_angle=lit(82), nx=ref("n")), "result = (\n        result.faces('>Z').workplane()\n        .rarray(10, 10, p[\"n\"], 2)\n        .cskHole(5.0, 5.0 * 2, 82.0)\n    )"),
    ],
)
def test_statements(spark, o, text):
    assert f"\n    {text}\n" in emit(spark, o)


def sources(spark, *ops):
    """The source of a part of each operation alone."""
    df = spark.createDataFrame([(str(i), PARAMS, [o]) for i, o in enumerate(ops)], f"part_id string, params_spec {SPEC}, operations array<{OP_TYPE}>")
    got = {r.part_id: r.source for r in emitted(df.coalesce(1), F.lit("#")).collect()}
    return [got[str(i)] for i in range(len(ops))]


def whole(*lines):
    return "\n".join("    " + x for x in lines)


TOP, BOX_CENTRE = "    result.faces('>Z').workplane()", ".workplane(centerOption='CenterOfBoundBox')"


WHOLE = [
    (op("boss", {"face": "<Z"}, diameter=lit(9), height=lit(4), bore_d=ref("w")), ["result = (", "    result.faces('<Z').workplane()", "    .circle(9.0 / 2).extrude(4.0)", ")", "result = (", TOP, '    .hole(p["w"])', ")"]),
    (op("holes", {"shape": "square"}, diameter=ref("w"), tilt=lit(15)), ["result = (", TOP + ".transformed(rotate=(15.0, 0, 0))", "    .rect(20, 20, forConstruction=True)", '    .vertices().rect(p["w"], p["w"]).cutThruAll()', ")"]),
    (op("holes", {"shape": "slot", "placement": "grid"}, diameter=lit(5), slot_len=lit(12)), ["result = (", TOP, "    .rarray(10, 10, 2, 2)", "    .slot2D(12.0, 5.0).cutThruAll()", ")"]),
    (op("holes", {"shape": "slot"}, diameter=times("w", 0.5)), ["result = (", TOP, "    .rect(20, 20, forConstruction=True)", '    .vertices().slot2D((p["w"] * 0.5) * 2, p["w"] * 0.5).cutThruAll()', ")"]),
    (op("holes", {"shape": "square", "placement": "bolt_circle"}, diameter=lit(5), nx=lit(3), tilt=lit(3)), ["result = (", TOP + ".transformed(rotate=(3.0, 0, 0))", "    .polarArray(15, 0, 360, 4)", "    .hole(5.0)", ")"]),
    (op("holes", {"placement": "staggered"}, diameter=lit(5), nx=ref("n")), ["_snx = max(2, int(p[\"n\"]))", "_ssx = 10", "_ssy = 10", "_spts = (", "    [(-_ssx * (_snx - 1) / 2 + _ssx * _i, -_ssy / 2) for _i in range(_snx)]", "    + [(-_ssx * (_snx - 2) / 2 + _ssx * _i, _ssy / 2) for _i in range(_snx - 1)]", ")", "result = (", TOP, "    .pushPoints(_spts)", "    .hole(5.0)", ")"]),
    (op("revolve", outer_d=lit(50), height=ref("w"), chamfer_d=lit(1), flange_d=lit(70)), ["result = (", "    cq.Workplane('XZ')", "    .moveTo(0, 0)", "    .lineTo(50.0 / 2, 0)", '    .lineTo(50.0 / 2, p["w"])', "    .close()", "    .revolve()", ")"]),
    (op("revolve", outer_d=lit(50), height=lit(20), inner_d=lit(8), flange_d=lit(70), flange_h=lit(4), groove_depth=lit(2), groove_w=lit(3), groove_pos=lit(9)), ["result = (", "    cq.Workplane('XZ')", "    .moveTo(8.0 / 2, 0)", "    .lineTo(70.0 / 2, 0)", "    .lineTo(70.0 / 2, 4.0)", "    .lineTo(50.0 / 2, 4.0)", "    .lineTo(50.0 / 2, 9.0 - 3.0 / 2)", "    .lineTo(50.0 / 2 - 2.0, 9.0 - 3.0 / 2)", "    .lineTo(50.0 / 2 - 2.0, 9.0 + 3.0 / 2)", "    .lineTo(50.0 / 2, 9.0 + 3.0 / 2)", "    .lineTo(50.0 / 2, 20.0)", "    .lineTo(8.0 / 2, 20.0)", "    .close()", "    .revolve()", ")"]),
    (op("ribs", count=ref("n"), rib_height=lit(3), rib_thickness=lit(2), span=lit(40)), ['_rib_spacing = (40.0 / (p["n"] - 1)) if p["n"] > 1 else 0', "result = (", TOP, '    .rarray(_rib_spacing, 1, p["n"], 1)', "    .rect(2.0, 40.0).extrude(3.0)", ")"]),
    (op("attach", profile=profile("circle", diameter=lit(8)), length=lit(5), bore_d=lit(3)), ["result = (", "    result.faces('>X')" + BOX_CENTRE, "    .circle(8.0 / 2).extrude(5.0)", ")", "result = (", "    result.faces('>X')" + BOX_CENTRE, "    .hole(3.0)", ")"]),
]


def test_all_fields_of_an_operation_are_in_its_text(spark):
    for text, (_, lines) in zip(sources(spark, *(o for o, _ in WHOLE)), WHOLE, strict=True):
        ast.parse(text)
        assert text[text.index("def build(p):\n\n") + 15 :].startswith(whole(*lines) + "\n    return result\n")


def test_a_field_without_place_in_the_text_leaves_none(spark):
    bad = ("odd",) + lit(1)[1:]
    circle = profile("circle", diameter=lit(8))
    none = [
        op("box", width=lit(1), depth=lit(1), height=lit(1), bore_d=lit(1)), op("box", {"plane": "YZ"}, width=lit(1), depth=lit(1), height=lit(1)), op("box", profile=circle, width=lit(1), depth=lit(1), height=lit(1)),
        op("box", stations=[circle], width=lit(1), depth=lit(1), height=lit(1)), op("counterbore", {"shape": "square"}, diameter=lit(5), cb_diameter=lit(9), cb_depth=lit(3)), op("holes", {"shape": "star"}, diameter=lit(5)),
        op("extrude", profile=profile("circle", diameter=lit(8), taper=lit(1)), distance=lit(5)), op("extrude", profile=circle, distance=lit(5), taper=bad), op("extrude", profile=profile("sketched", ("w", "n", [("start", 0.0, 0.0), ("arc", 0.5, 1.0)])), distance=lit(5)),
    ]
    *got, last = sources(spark, *none, op("box", width=lit(1), depth=lit(1), height=lit(1), bore_d=None))
    assert got == [None] * len(none) and last is not None


def test_unknown_operations_have_no_source(spark):
    assert emit(spark, op("box", width=lit(1), depth=lit(1), height=lit(1)), op("gear")) is None and emit(spark, op("box", width=lit(1))) is None


def test_emitted_parameters_read_back(spark):
    text = emit(spark, op("box", width=lit(1), depth=lit(1), height=lit(1)))
    got = explode_params(spark.createDataFrame([("p", text)], "part_id string, params string")).orderBy("pos").collect()
    assert [tuple(r[2:]) for r in got] == [tuple(p) for p in PARAMS]


def test_cameras(spark):
    for e, a in ANGLES.values():
        d = view_direction(e, a)
        m = look_from(d, np.array([1.0, 2.0, 3.0]), 5.0)
        assert np.allclose(m[:3, :3] @ m[:3, :3].T, np.eye(3)) and np.isclose(np.linalg.det(m[:3, :3]), 1)
        assert np.allclose(m @ [1, 2, 3, 1], [0, 0, -5, 1]) and np.allclose(m @ [*(np.array([1, 2, 3]) + 5 * d), 1], [0, 0, 0, 1])
    p = orthographic(2.0, 1.0, 5.0)
    assert np.allclose(p @ [2, -2, -1, 1], [1, -1, -1, 1]) and np.allclose(p @ [0, 0, -5, 1], [0, 0, 1, 1])
    bounds = spark.createDataFrame([("m", 0.0, 0.0, 0.0, 2.0)], "part_id string, centre_x double, centre_y double, centre_z double, radius double")
    got = cameras(bounds, ["top", "front"]).collect()
    assert [r.view for r in got] == ["top", "front"] and len(got[0].view_matrix) == 16
