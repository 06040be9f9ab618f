"""Queries of part descriptions and source text: each kind of operation over every row of `part`, beside the SQL that states its text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.functions.describe import OP_TYPE, PROFILE_TYPE, described, descriptors
from gneiss.functions.emit import emitted, statement
from gneiss.functions.expressions import EXPR_TYPE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
# A part's parameters, all whole numbers: in Spark and in SQL.
PARAMS = {"a": "p_size", "b": "p_size + 10", "c": "p_size + 20", "d": "p_size % 7 + 1"}
_EXPR_FIELDS = [x.split(":")[0].strip() for x in EXPR_TYPE[7:-1].split(",")]


def expression(**fields: object) -> Column:
    return F.struct(*(F.lit(fields.get(n)).alias(n) for n in _EXPR_FIELDS)).cast(EXPR_TYPE)


def _exprs(names: dict[str, str]) -> Column:
    """Fields by the parameter that each refers to; "0" is the literal 0."""
    made = [x for field, p in names.items() for x in (F.lit(field), expression(type="literal", value=0.0) if p == "0" else expression(type="param", param=p))]
    return F.create_map(*made).cast(f"map<string,{EXPR_TYPE}>")


def profile(kind: str, points: list[tuple[str, float, float]] | None = None, **fields: str) -> Column:
    """A cross-section; a sketch spans parameter b by parameter c."""
    sketch = F.lit(None)
    if points:
        sketch = F.struct(F.lit("b").alias("w_param"), F.lit("c").alias("h_param"), F.array(*(F.struct(F.lit(k).alias("kind"), F.lit(x).alias("x"), F.lit(y).alias("y")) for k, x, y in points)).alias("points"))
    return F.struct(F.lit(kind).alias("type"), _exprs(fields).alias("exprs"), sketch.alias("sketch")).cast(PROFILE_TYPE)


def operation(kind: str, fields: dict[str, str] | None = None, attrs: dict[str, str] | None = None, section: Column | None = None, stations: list[Column] | None = None) -> Column:
    texts = F.create_map(*(F.lit(x) for item in (attrs or {}).items() for x in item)).cast("map<string,string>")
    return F.struct(
        F.lit(kind).alias("type"), _exprs(fields or {}).alias("exprs"), texts.alias("attrs"), (F.lit(None) if section is None else section).cast(PROFILE_TYPE).alias("profile"),
        F.array(*(stations or [])).cast(f"array<{PROFILE_TYPE}>").alias("stations"),
    ).cast(OP_TYPE)


def parts(spark: SparkSession, sf_dir: str, *operations: Column, spread: bool = False) -> DataFrame:
    """(part_id, params, operations) of every row of part; spread: over all cores, however few row groups its files have."""
    params = F.create_map(*(x for name, sql in PARAMS.items() for x in (F.lit(name), F.expr(sql).cast("double"))))
    rows = spark.read.parquet(f"{sf_dir}/part.parquet")
    if spread:
        rows = rows.select("p_partkey", "p_size").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rows.select(F.col("p_partkey").alias("part_id"), params.alias("params"), F.array(*operations).cast(f"array<{OP_TYPE}>").alias("operations"))


_P = "(select p_partkey part_id, " + ", ".join(f"({sql})::bigint {name}" for name, sql in PARAMS.items()) + " from part) p"


def _word(n: str) -> str:
    words = ("One", "Two", "Three", "Four", "Five", "Six", "Seven", "Eight", "Nine", "Ten", None, "Twelve")
    return f"case {n} " + " ".join(f"when {i} then '{w}'" for i, w in enumerate(words, 1) if w) + f" else ({n})::varchar end"


def _literal(text: str | None) -> str:
    return "null::varchar" if text is None else "'" + text.replace("'", "''") + "'"


def _said(text: str) -> str:
    """SQL of a phrase in which {x} stands for an SQL expression."""
    out = []
    for i, piece in enumerate(text.replace("{", "\0").replace("}", "\0").split("\0")):
        out.append(f"({piece})::varchar" if i % 2 else _literal(piece))
    return " || ".join(out)


def register(name: str, made: list[tuple[str, Column | Callable[[], Column], str, str | None]]) -> None:
    """A query of the phrases and statements of some operations; code has p["x"] written as `x`. One plan for all, since a plan of phrases is large."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ops = F.explode(F.map_from_arrays(F.array(*(F.lit(n) for n, *_ in made)), F.array(*(op() for _, op, *_ in made)))).alias("kind", "op")
        rows = parts(spark, sf_dir, spread=True).select("part_id", "params", ops).select(F.struct("part_id", "kind").alias("part_id"), "params", F.array("op").alias("operations"))
        return described(rows, statement(F.col("operations")[0]).alias("code")).select("part_id.part_id", "part_id.kind", "text", "code")

    QUERIES[name] = run
    each = []
    for kind, _, text, code in made:
        source = None if code is None else "".join(f'p["{x}"]' if i % 2 else x for i, x in enumerate(code.split("`")))
        each.append(f"select part_id, {_literal(kind)} kind, {_said(text)} text, {_literal(source)} code from {_P}")
    SQL[name] = " union all ".join(each)


_FACE = "result = (\n    result.faces('>Z').workplane()%s\n)"
_RECT = lambda: profile("rect", width="b", depth="c")
_DISC = lambda: profile("circle", diameter="a")
_TRIANGLE = [("start", 0.0, 0.0), ("line", 1.0, 0.0), ("line", 0.5, 1.0)]
_HOLE_N = "case when {n} = 1 then 'hole' else 'holes' end"
_HALF_HIDDEN = "\n    .moveTo(`d` / 2, 0)\n    .lineTo(`c` / 2, 0)\n    .lineTo(`c` / 2, `b`)\n    .lineTo(`d` / 2, `b`)\n    .close()\n    .revolve()\n)"
_BRACKET = ": base leg {b} mm, vertical leg {c} mm%s, {a} mm wide, {d} mm thick; 2 × Ø{d} mm holes per leg; {d} mm corner gusset."
_LEGS = {"base_len": "b", "vert_len": "c", "width": "a", "thickness": "d", "hole_d": "d", "gusset_t": "d"}


def _bracket(kind: str, **more: str) -> Column:
    two = F.map_concat(_exprs(_LEGS | more), F.create_map(F.lit("n_holes"), expression(type="literal", value=2.0)).cast(f"map<string,{EXPR_TYPE}>"))
    return operation(kind).withField("exprs", two)


_OPERATIONS = (
    ("box", lambda: operation("box", {"width": "b", "depth": "c", "height": "a"}), "Rectangular body, {b} × {c} × {a} mm (W×D×H).", "result = cq.Workplane('XY').box(`b`, `c`, `a`)"),
    ("extrude", lambda: operation("extrude", {"distance": "a", "taper": "d"}, section=_RECT()), "{b} × {c} mm rectangular section, extruded {a} mm thick with a {d}° draft.", "result = (cq.Workplane('XY').rect(`b`, `c`).extrude(`a`, taper=`d`))"),
    ("extrude_circle", lambda: operation("extrude", {"distance": "b"}, section=_DISC()), "Ø{a} mm circular section, extruded {b} mm thick.", "result = (cq.Workplane('XY').circle(`a` / 2).extrude(`b`))"),
    ("extrude_slot", lambda: operation("extrude", {"distance": "a"}, section=profile("slot", length="c", width="b")), "{c} × {b} mm slot section, extruded {a} mm thick.", "result = (cq.Workplane('XY').slot2D(`c`, `b`).extrude(`a`))"),
    ("extrude_polygon", lambda: operation("extrude", {"distance": "a"}, section=profile("polygon", sides="d", circumscribed_r="b")), "{d}-sided polygon section, {2 * b} mm across corners, extruded {a} mm thick.", "result = (cq.Workplane('XY').polygon(`d`, `b` * 2).extrude(`a`))"),
    ("extrude_rounded", lambda: operation("extrude", {"distance": "a"}, {"plane": "XZ"}, section=profile("rounded_rect", width="b", depth="c")), "{b} × {c} mm rectangular section, extruded {a} mm thick.", "result = (cq.Workplane('XZ').rect(`b`, `c`).extrude(`a`))"),
    ("revolve", lambda: operation("revolve", {"outer_d": "c", "height": "b", "inner_d": "d"}), "Revolved body, Ø{c} mm × {b} mm tall with Ø{d} mm bore.", "result = (\n    cq.Workplane('XZ')" + _HALF_HIDDEN),
    ("sketched_revolve", lambda: operation("sketched_revolve", section=profile("sketched", _TRIANGLE)), "Revolved organic body from a freeform sketched section (2 segments: 2 straight), ~{b} × {c} mm half-silhouette.",
     "result = (cq.Workplane('XZ').moveTo(`b` * 0.0, `c` * 0.0).lineTo(`b` * 1.0, `c` * 0.0).lineTo(`b` * 0.5, `c` * 1.0).close().revolve())"),
    ("loft", lambda: operation("loft", stations=[_RECT(), _DISC()]), "Lofted body through 2 sections: {b} × {c} mm rectangular section → Ø{a} mm circular section.", None),
    ("sweep", lambda: operation("sweep", {"path_w": "b", "path_h": "c"}, section=_DISC()), "Ø{a} mm circular section swept along a curved path, ~{c} mm span.", None),
    ("holes_grid", lambda: operation("holes", {"diameter": "a", "nx": "d", "ny": "d", "spacing_x": "b", "spacing_y": "c", "tilt": "d"}, {"placement": "grid"}),
     "{" + _word("d * d") + "} Ø{a} mm {" + _HOLE_N.format(n="d") + "} in a {d}×{d} grid, {b} × {c} mm pitch, angled {d}°.", _FACE % ".transformed(rotate=(`d`, 0, 0))\n    .rarray(`b`, `c`, `d`, `d`)\n    .hole(`a`)"),
    ("holes_square", lambda: operation("holes", {"diameter": "a", "spacing_x": "b", "spacing_y": "c"}, {"placement": "corners", "shape": "square"}), "Four {a} mm square holes at the corners, {b} × {c} mm spacing.",
     _FACE % "\n    .rect(`b`, `c`, forConstruction=True)\n    .vertices().rect(`a`, `a`).cutThruAll()"),
    ("holes_slot", lambda: operation("holes", {"diameter": "a", "slot_len": "c", "spacing_x": "b", "spacing_y": "c"}, {"placement": "corners", "shape": "slot"}), "Four {c} × {a} mm slots at the corners, {b} × {c} mm spacing.",
     _FACE % "\n    .rect(`b`, `c`, forConstruction=True)\n    .vertices().slot2D(`c`, `a`).cutThruAll()"),
    ("holes_staggered", lambda: operation("holes", {"diameter": "a", "nx": "d", "spacing_x": "b", "spacing_y": "c"}, {"placement": "staggered"}),
     "{" + _word("2 * greatest(d, 2) - 1") + "} Ø{a} mm holes in two staggered rows, {b} × {c} mm pitch.",
     "_snx = max(2, int(`d`))\n_ssx = `b`\n_ssy = `c`\n_spts = (\n    [(-_ssx * (_snx - 1) / 2 + _ssx * _i, -_ssy / 2) for _i in range(_snx)]\n    + [(-_ssx * (_snx - 2) / 2 + _ssx * _i, _ssy / 2) for _i in range(_snx - 1)]\n)\n" + _FACE % "\n    .pushPoints(_spts)\n    .hole(`a`)"),
    ("counterbore", lambda: operation("counterbore", {"diameter": "a", "cb_diameter": "b", "cb_depth": "d", "spacing_x": "b", "spacing_y": "c"}, {"placement": "corners"}),
     "Four Ø{a} mm counterbored holes (Ø{b} mm × {d} mm counterbore) at the corners, {b} × {c} mm spacing.", _FACE % "\n    .rect(`b`, `c`, forConstruction=True)\n    .vertices().cboreHole(`a`, `b`, `d`)"),
    ("countersink", lambda: operation("countersink", {"diameter": "a", "cs_angle": "c", "n_bolts": "d", "bolt_circle_r": "b"}, {"placement": "bolt_circle"}),
     "{" + _word("d") + "} Ø{a} mm countersunk holes ({c}°) on a Ø{2 * b} mm bolt circle.", _FACE % "\n    .polarArray(`b`, 0, 360, `d`)\n    .cskHole(`a`, `a` * 2, `c`)"),
    ("fillet", lambda: operation("fillet", {"radius": "d", "enabled": "0"}, {"edge_selector": "<Q"}), "Fillet radius {d} mm on the <Q edges (optional, off by default).", "if 0.0:\n    result = result.edges('<Q').fillet(`d`)"),
    ("chamfer", lambda: operation("chamfer", {"distance": "d"}, {"edge_selector": "<Q"}), "Chamfer {d} mm on the <Q edges.", "result = result.edges('<Q').chamfer(`d`)"),
    ("shell", lambda: operation("shell", {"thickness": "d"}, {"open_face": "<Q"}), "Hollowed to {d} mm wall thickness, open at the <Q face.", "result = result.faces('<Q').shell(-`d`)"),
    ("pocket", lambda: operation("pocket", {"width": "b", "depth": "c", "pocket_depth": "d"}, {"face": "<Q"}), "Pocket {b} × {c} mm, {d} mm deep, in the <Q face.", _FACE.replace(">Z", "<Q") % "\n    .rect(`b`, `c`)\n    .cutBlind(-`d`)"),
    ("boss", lambda: operation("boss", {"diameter": "b", "height": "c", "bore_d": "d"}, {"face": "<Q"}), "Boss Ø{b} mm × {c} mm tall on the <Q face with a Ø{d} mm bore.",
     _FACE.replace(">Z", "<Q") % "\n    .circle(`b` / 2).extrude(`c`)" + "\n" + _FACE % "\n    .hole(`d`)"),
    ("ribs", lambda: operation("ribs", {"count": "d", "span": "c", "rib_thickness": "a", "rib_height": "b"}), "{" + _word("d") + "} ribs, {a} mm thick, {b} mm tall.",
     "_rib_spacing = (`c` / (`d` - 1)) if `d` > 1 else 0\n" + _FACE % "\n    .rarray(_rib_spacing, 1, `d`, 1)\n    .rect(`a`, `c`).extrude(`b`)"),
    ("attach", lambda: operation("attach", {"length": "b"}, {"face": "<Q"}, section=_DISC()), "Ø{a} mm circular section attachment, {b} mm long, from the <Q face.",
     "result = (\n    result.faces('<Q').workplane(centerOption='CenterOfBoundBox')\n    .circle(`a` / 2).extrude(`b`)\n)"),
    ("lbracket", lambda: _bracket("lbracket"), "L-bracket" + _BRACKET % "", None),
    ("cbracket", lambda: _bracket("cbracket"), "C-channel bracket" + _BRACKET % "", None),
    ("zbracket", lambda: _bracket("zbracket", top_len="a"), "Z-bracket" + _BRACKET % ", top leg {a} mm", None),
    ("gear", lambda: operation("gear", {"module": "d", "teeth": "a", "width": "b", "bore_d": "d", "helix_angle": "c"}, {"kind": "helical", "herringbone": "true"}),
     "Helical gear, module {d} mm, {a} teeth (pitch Ø{d * a} mm), face width {b} mm, {c}° helix (herringbone), Ø{d} mm bore.", None),
    ("threaded", lambda: operation("threaded", {"major_d": "a", "pitch": "d", "length": "b"}, {"standard": "iso", "external": "false"}), "M{a}x{d} internal thread, {b} mm long.", None),
    ("tapped", lambda: operation("tapped", {"major_d": "a", "pitch": "d", "nx": "d", "ny": "d"}, {"placement": "grid", "body": "cylinder"}), "{" + _word("d * d") + "} M{a}x{d} tapped {" + _HOLE_N.format(n="d") + "} in a cylinder.", None),
)
for _group, _kinds in {
    "op_bodies": ("box", "extrude", "revolve", "sketched", "loft", "sweep"), "op_holes": ("holes", "counterbore", "countersink"), "op_features": ("fillet", "chamfer", "shell", "pocket", "boss", "ribs", "attach"),
    "op_components": ("lbracket", "cbracket", "zbracket", "gear", "threaded", "tapped"),
}.items():
    register(_group, [o for o in _OPERATIONS if o[0].split("_")[0] in _kinds])


def part_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole descriptions: the phrases of all operations in order; one of an unknown kind or without its sizes says nothing."""
    rows = parts(spark, sf_dir, operation("box", {"width": "b", "depth": "c", "height": "a"}), operation("unheard_of"), operation("shell", {}, {"open_face": "<Q"}), operation("chamfer", {"distance": "d"}, {"edge_selector": "<Q"}))
    return described(rows).select("part_id", F.size("lines").alias("n_lines"), "text")


QUERIES["part_description"] = part_description
SQL["part_description"] = f"select part_id, 2 n_lines, {_said('Rectangular body, {b} × {c} × {a} mm (W×D×H). Chamfer {d} mm on the <Q edges.')} text from {_P}"


def part_descriptors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What threads and tapped holes a part has, as entries; those of later operations win."""
    rows = parts(spark, sf_dir, operation("tapped", {"major_d": "a", "pitch": "d"}, {"placement": "corners"}), operation("threaded", {"major_d": "b", "pitch": "d", "length": "c"}))
    return descriptors(rows).select("part_id", *(F.col("descriptor")[k].alias(k) for k in ("family", "standard", "external", "body", "designation", "hole_count"))).withColumn("hole_count", F.col("hole_count").cast("int"))


QUERIES["part_descriptors"] = part_descriptors
SQL["part_descriptors"] = f"select part_id, 'threaded' family, 'iso' standard, 'true' external, 'box' body, {_said('M{b}x{d}')} designation, 4 hole_count from {_P}"


def gear_descriptors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of a spur gear: those of other kinds of gear are left out."""
    rows = parts(spark, sf_dir, operation("gear", {"module": "d", "teeth": "a", "width": "b", "helix_angle": "c", "hub_d": "c"}))
    return descriptors(rows).select("part_id", F.array_sort(F.map_keys("descriptor")).alias("keys"), *(F.col("descriptor")[k].cast("double").alias(k) for k in ("module", "teeth", "face_width", "pitch_diameter", "pressure_angle_deg")))


QUERIES["gear_descriptors"] = gear_descriptors
SQL["gear_descriptors"] = f"select part_id, ['face_width', 'family', 'kind', 'module', 'pitch_diameter', 'pressure_angle_deg', 'teeth'] keys, d::double module, a::double teeth, b::double face_width, (d * a)::double pitch_diameter, 20.0::double pressure_angle_deg from {_P}"


def part_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole source files, with one parameter each and two statements."""
    spec = F.array(F.struct(F.lit("a").alias("name"), F.lit("int").alias("type"), F.element_at("params", "a").cast("int").cast("string").alias("default"), F.lit(1.0).alias("min"), F.lit(50.0).alias("max"), F.lit(1.0).alias("step"), F.lit(None).cast("array<string>").alias("choices"), F.lit("size").alias("grp"), F.lit(None).cast("string").alias("label")))
    rows = parts(spark, sf_dir, operation("box", {"width": "a", "depth": "a", "height": "a"}), operation("chamfer", {"distance": "a"})).withColumn("params_spec", spec)
    return emitted(rows, F.concat(F.lit("# part "), F.col("part_id").cast("string")))


QUERIES["part_source"] = part_source
SQL["part_source"] = f"""select part_id, 'import cadquery as cq' || chr(10) || '# part ' || part_id || chr(10) || 'PARAMS = {{' || chr(10) || '    "a": {{"type": ''int'', "default": ' || a || ', "min": 1, "max": 50, "step": 1, "group": ''size''}},' || chr(10) || '}}'
    || repeat(chr(10), 3) || 'def build(p):' || repeat(chr(10), 2) || '    result = cq.Workplane(''XY'').box(p["a"], p["a"], p["a"])' || chr(10) || '    result = result.edges(''|Z'').chamfer(p["a"])' || chr(10)
    || '    return result' || repeat(chr(10), 3) || 'result = build({{k: v["default"] for k, v in PARAMS.items()}})' || chr(10) source from {_P}""".replace("{{", "{").replace("}}", "}")
