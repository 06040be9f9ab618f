"""Phrases of the corpus' own fixtures."""

import pytest
from pyspark.sql import functions as F

from gneiss.functions.describe import OP_TYPE, described, descriptors

EXPR = ["type", "param", "param_a", "param_b", "factor", "limit", "value"]


def ref(name):
    return tuple({"type": "param", "param": name}.get(k) for k in EXPR)


def lit(v):
    return tuple({"type": "literal", "value": float(v)}.get(k) for k in EXPR)


def times(name, f):
    return tuple({"type": "scaled", "param": name, "factor": f}.get(k) for k in EXPR)


def profile(kind, sketch=None, **exprs):
    return (kind, exprs, sketch)


def op(kind, attrs=None, profile=None, stations=None, **exprs):
    return (kind, exprs, attrs or {}, profile, stations)


def say(spark, params, *ops):
    df = spark.createDataFrame([("p", {k: float(v) for k, v in params.items()}, list(ops))], f"part_id string, params map<string,double>, operations array<{OP_TYPE}>")
    return described(df).first(), descriptors(df).first().descriptor


PLATE = {"plate_w": 80, "plate_d": 60, "thickness": 10, "hole_d": 5, "filleted": 1}
PLATE_OPS = [
    op("box", width=ref("plate_w"), depth=ref("plate_d"), height=ref("thickness")),
    op("fillet", {"edge_selector": "|Z"}, radius=lit(3), enabled=ref("filleted")),
    op("holes", {"placement": "corners"}, diameter=ref("hole_d"), spacing_x=times("plate_w", 0.75), spacing_y=lit(40)),
]


def test_plate(spark):
    got, about = say(spark, PLATE, *PLATE_OPS)
    assert got.lines == ["Rectangular body, 80 × 60 × 10 mm (W×D×H).", "Fillet radius 3 mm on vertical edges.", "Four Ø5 mm holes at the corners, 60 × 40 mm spacing."]
    assert got.text == " ".join(got.lines) and about is None
    off, _ = say(spark, PLATE | {"filleted": 0}, *PLATE_OPS)
    assert off.lines[1] == "Fillet radius 3 mm on vertical edges (optional, off by default)."


CASES = [
    (op("revolve", outer_d=lit(50), height=lit(20), inner_d=lit(20)), "Revolved body, Ø50 mm × 20 mm tall with Ø20 mm bore."),
    (op("revolve", outer_d=lit(50), height=lit(20)), "Revolved body, Ø50 mm × 20 mm tall."),
    (op("revolve", outer_d=lit(50), height=lit(20), flange_d=lit(70), flange_h=lit(4), groove_depth=lit(2), groove_w=lit(3)), "Revolved body, Ø50 mm × 20 mm tall with Ø70 mm × 4 mm flange, 3 mm-wide groove 2 mm deep."),
    (op("extrude", profile=profile("circle", diameter=lit(30)), distance=lit(5)), "Ø30 mm circular section, extruded 5 mm thick."),
    (op("extrude", profile=profile("polygon", sides=lit(6), circumscribed_r=lit(10)), distance=lit(5), taper=lit(2.5)), "6-sided polygon section, 20 mm across corners, extruded 5 mm thick with a 2.5° draft."),
    (op("loft", stations=[profile("rect", width=lit(40), depth=lit(40)), profile("circle", diameter=lit(16))]), "Lofted body through 2 sections: 40 × 40 mm rectangular section → Ø16 mm circular section."),
    (op("sweep", profile=profile("circle", diameter=lit(10)), path_w=lit(30), path_h=lit(60)), "Ø10 mm circular section swept along a curved path, ~60 mm span."),
    (op("holes", {"placement": "grid", "face": ">X"}, diameter=lit(4), nx=lit(3), ny=lit(2), spacing_x=lit(10), spacing_y=lit(12)), "Six Ø4 mm holes in a 3×2 grid, 10 × 12 mm pitch on the >X face."),
    (op("holes", {"placement": "bolt_circle", "shape": "slot"}, diameter=lit(4), slot_len=lit(9), n_bolts=lit(1), bolt_circle_r=lit(15), tilt=lit(5)), "One 9 × 4 mm slot on a Ø30 mm bolt circle, angled 5°."),
    (op("holes", {"placement": "staggered", "shape": "square"}, diameter=lit(4), nx=lit(3)), "Five 4 mm square holes in two staggered rows."),
    (op("counterbore", {"placement": "corners"}, diameter=lit(5), cb_diameter=lit(9), cb_depth=lit(3)), "Four Ø5 mm counterbored holes (Ø9 mm × 3 mm counterbore) at the corners."),
    (op("countersink", {"placement": "corners"}, diameter=lit(5), cs_angle=lit(82)), "Four Ø5 mm countersunk holes (82°) at the corners."),
    (op("chamfer", {"edge_selector": ">Z"}, distance=lit(1.5)), "Chamfer 1.5 mm on top edges."),
    (op("shell", {"open_face": ">Z"}, thickness=lit(2)), "Hollowed to 2 mm wall thickness, open at top face."),
    (op("pocket", {"face": ">Z"}, width=lit(20), depth=lit(10), pocket_depth=lit(4)), "Pocket 20 × 10 mm, 4 mm deep, in top face."),
    (op("boss", {"face": "<Z"}, diameter=lit(12), height=lit(6), bore_d=lit(4)), "Boss Ø12 mm × 6 mm tall on bottom face with a Ø4 mm bore."),
    (op("ribs", count=lit(3), rib_thickness=lit(2), rib_height=lit(8)), "Three ribs, 2 mm thick, 8 mm tall."),
    (op("attach", {"face": ">X"}, profile=profile("slot", length=lit(20), width=lit(8)), length=lit(15)), "20 × 8 mm slot section attachment, 15 mm long, from right face."),
    (op("lbracket", base_len=lit(40), vert_len=lit(30), width=lit(20), thickness=lit(3), hole_d=lit(5), n_holes=lit(2), gusset_t=lit(4), gusset_enabled=lit(0)), "L-bracket: base leg 40 mm, vertical leg 30 mm, 20 mm wide, 3 mm thick; 2 × Ø5 mm holes per leg; 4 mm corner gusset (optional)."),
    (op("cbracket", base_len=lit(40), vert_len=lit(30), width=lit(20), thickness=lit(3)), "C-channel bracket: base leg 40 mm, vertical leg 30 mm, 20 mm wide, 3 mm thick."),
    (op("zbracket", base_len=lit(40), vert_len=lit(30), top_len=lit(25), width=lit(20), thickness=lit(3)), "Z-bracket: base leg 40 mm, vertical leg 30 mm, top leg 25 mm, 20 mm wide, 3 mm thick."),
    (op("gear", {"kind": "spur"}, module=lit(2), teeth=lit(24), width=lit(10)), "Spur gear, module 2 mm, 24 teeth (pitch Ø48 mm), face width 10 mm."),
    (op("threaded", {"standard": "iso", "external": "true"}, major_d=lit(10), pitch=lit(1.5), length=lit(30)), "M10x1.5 external thread, 30 mm long."),
    (op("threaded", {"standard": "acme", "size": "1/2", "external": "false"}, length=lit(30)), "ACME 1/2 internal thread, 30 mm long."),
    (op("tapped", {"placement": "corners", "body": "box"}, major_d=lit(6), pitch=lit(1)), "Four M6x1 tapped holes in a plate."),
    (op("tapped", {"body": "cylinder"}, major_d=lit(6), pitch=lit(1)), "One M6x1 tapped hole in a cylinder."),
    (op("unknown"), None),
    (op("box", width=ref("missing"), depth=lit(1), height=lit(1)), None),
]


def test_every_kind_of_operation(spark):
    rows = [(f"{i:02d}", {}, [o]) for i, (o, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, f"part_id string, params map<string,double>, operations array<{OP_TYPE}>")
    got = {r.part_id: r.lines for r in described(df).collect()}
    assert [got[f"{i:02d}"] for i in range(len(CASES))] == [[s] if s else [] for _, s in CASES]


def test_sketches(spark):
    points = [("start", 0.0, 0.0), ("line", 0.8, 0.0), ("arc", 0.8, 0.8), ("bezier", 0.4, 0.8), ("line", 0.0, 0.0)]
    sketch = ("w", "h", points)
    got, _ = say(spark, {"w": 80, "h": 60}, op("extrude", profile=profile("sketched", sketch), distance=lit(10)), op("sketched_revolve", profile=profile("sketched", sketch)))
    phrase = "freeform sketched section (4 segments: 2 straight, 1 arc, 1 curve), ~64 × 48 mm"
    assert got.lines == [f"{phrase}, extruded 10 mm thick.", f"Revolved organic body from a {phrase} half-silhouette."]


def test_descriptors(spark):
    gear = op("gear", {"kind": "helical", "herringbone": "true"}, module=lit(2), teeth=lit(24), width=lit(10), helix_angle=lit(18), bore_d=lit(8), hub_d=lit(14), hub_h=lit(5))
    got, about = say(spark, {}, gear)
    assert got.lines == ["Helical gear, module 2 mm, 24 teeth (pitch Ø48 mm), face width 10 mm, 18° helix (herringbone), Ø8 mm bore, Ø14 mm × 5 mm hub."]
    assert about["pitch_diameter"] == "48.0" and about["pressure_angle_deg"] == "20.0" and about["herringbone"] == "true" and "cone_angle_deg" not in about
    _, thread = say(spark, {}, op("threaded", {"standard": "iso"}, major_d=lit(8), pitch=lit(1.25), length=lit(9)))
    assert thread["designation"] == "M8x1.25"
    _, both = say(spark, {}, gear, op("tapped", {"placement": "grid"}, major_d=lit(6), pitch=lit(1), nx=lit(2), ny=lit(3)))
    assert both["family"] == "tapped" and both["hole_count"] == "6" and both["module"] == "2.0"


@pytest.mark.parametrize("ops", [[], None])
def test_parts_without_operations(spark, ops):
    df = spark.createDataFrame([("p", {}, ops)], f"part_id string, params map<string,double>, operations array<{OP_TYPE}>")
    r = described(df).select("text", F.size("lines").alias("n")).first()
    assert (r.text, r.n) == ("", 0) and descriptors(df).first().descriptor is None
