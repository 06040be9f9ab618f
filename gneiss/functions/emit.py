"""Source text of parts: parameters, statements and whole files, as expressions over structured operations.

A statement is a template. {field} stands for an expression's source text (expressions.source_text), {nx:=2} for one with a default, {face:>Z} for
an attribute with its default, {profile} for the cross-section, and [ ... ] for text that appears only if each field in it is present, or what follows
a | in it otherwise; brackets without a field are text. A kind not below (brackets, gears, threads, lofts, sweeps) is added to STATEMENTS by the caller.
An operation with a field that no template of its kind uses has no source text.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.functions.expressions import let, python_float, source_text

# The format of emitted statements.
PROFILES = {
    "rect": ".rect({width}, {depth})",
    "rounded_rect": ".rect({width}, {depth})",
    "circle": ".circle({diameter} / 2)",
    "polygon": ".polygon({sides}, {circumscribed_r} * 2)",
    "slot": ".slot2D({length}, {width})",
}
_ON_FACE = "result = (\n    result.faces('{face:>Z}').workplane()%s\n)"
_TILT = "[.transformed(rotate=({tilt}, 0, 0))]"
_CORNERS = "\n    .rect({spacing_x:=20}, {spacing_y:=20}, forConstruction=True)\n    .vertices()%s"
_GRID = "\n    .rarray({spacing_x:=10}, {spacing_y:=10}, {nx:=2}, {ny:=2})\n    %s"
_CIRCLE = "\n    .polarArray({bolt_circle_r:=15}, 0, 360, {n_bolts:=4})\n    %s"
_STAGGERED = (
    "_snx = max(2, int({nx:=3}))\n_ssx = {spacing_x:=10}\n_ssy = {spacing_y:=10}\n_spts = (\n"
    "    [(-_ssx * (_snx - 1) / 2 + _ssx * _i, -_ssy / 2) for _i in range(_snx)]\n    + [(-_ssx * (_snx - 2) / 2 + _ssx * _i, _ssy / 2) for _i in range(_snx - 1)]\n)\n"
)
_FLANGE = ".lineTo({flange_d} / 2, 0)\n    .lineTo({flange_d} / 2, {flange_h})\n    .lineTo({outer_d} / 2, {flange_h})"
_GROOVE = "".join("\n    .lineTo({outer_d} / 2%s, {groove_pos} %s {groove_w} / 2)" % x for x in (("", "-"), (" - {groove_depth}", "-"), (" - {groove_depth}", "+"), ("", "+")))
_ATTACH = "result = (\n    result.faces('{face:>X}').workplane(centerOption='CenterOfBoundBox')\n    %s\n)"
_HOLE, _SQUARE, _SLOT = ".hole({diameter})", ".rect({diameter}, {diameter}).cutThruAll()", "[.slot2D({slot_len}, {diameter})|.slot2D(({diameter}) * 2, {diameter})].cutThruAll()"
STATEMENTS = {
    "box": "result = cq.Workplane('XY').box({width}, {depth}, {height})",
    "extrude": "result = (cq.Workplane('{plane:XY}'){profile}.extrude({distance}[, taper={taper}]))",
    "revolve": f"result = (\n    cq.Workplane('XZ')\n    [.moveTo({{inner_d}} / 2, 0)|.moveTo(0, 0)]\n    [{_FLANGE}|.lineTo({{outer_d}} / 2, 0)][{_GROOVE}]\n    .lineTo({{outer_d}} / 2, {{height}})[\n    .lineTo({{inner_d}} / 2, {{height}})]\n    .close()\n    .revolve()\n)",
    "sketched_revolve": "result = (cq.Workplane('{plane:XZ}'){profile}.revolve())",
    "fillet": "result = result.edges('{edge_selector:|Z}').fillet({radius})",
    "chamfer": "result = result.edges('{edge_selector:|Z}').chamfer({distance})",
    "shell": "result = result.faces('{open_face:>Z}').shell(-{thickness})",
    "pocket": _ON_FACE % "\n    .rect({width}, {depth})\n    .cutBlind(-{pocket_depth})",
    "boss": _ON_FACE % "\n    .circle({diameter} / 2).extrude({height})" + "[\nresult = (\n    result.faces('>Z').workplane()\n    .hole({bore_d})\n)]",
    "ribs": "_rib_spacing = ({span} / ({count} - 1)) if {count} > 1 else 0\n" + _ON_FACE % "\n    .rarray(_rib_spacing, 1, {count}, 1)\n    .rect({rib_thickness}, {span}).extrude({rib_height})",
    "attach": _ATTACH % "{profile}.extrude({length})" + f"[\n{_ATTACH % '.hole({bore_d})'}]",
    "holes/staggered": _STAGGERED + _ON_FACE % f"{_TILT}\n    .pushPoints(_spts)\n    {_HOLE}",
    "holes/bolt_circle": _ON_FACE % (_TILT + _CIRCLE % _HOLE),
} | {
    f"holes/{placement}{shape}": _ON_FACE % (_TILT + where % action)
    for shape, action in (("", _HOLE), ("/square", _SQUARE), ("/slot", _SLOT))
    for placement, where in (("corners", _CORNERS), ("grid", _GRID))
} | {
    f"{kind}/{placement}": _ON_FACE % (where % action)
    for kind, action in (("counterbore", ".cboreHole({diameter}, {cb_diameter}, {cb_depth})"), ("countersink", ".cskHole({diameter}, {diameter} * 2, {cs_angle})"))
    for placement, where in (("corners", _CORNERS), ("grid", _GRID), ("bolt_circle", _CIRCLE))
}
#: Fields that choose a template, or that the format leaves out of the text.
SILENT = {"holes": {"placement", "shape"}, "counterbore": {"placement"}, "countersink": {"placement"}, "revolve": {"chamfer_d"}}
_FIELD = re.compile(r"\[([^\]{]*\{[^\]]*)\]|\{(\w+)(?::(=?)([^}]*))?\}")


def _names(text: str) -> set[str]:
    """The fields that a template uses."""
    return {n for m in _FIELD.finditer(text) for n in (_names(m[1]) if m[1] else {m[2]})}


def _only(found: Column, names: set[str]) -> Column:
    """Whether all keys of a map are among names; a key without value does not count."""
    keys = F.map_keys(F.map_filter(found, lambda _, v: v.isNotNull()))
    return F.coalesce(F.forall(keys, lambda k: k.isin(sorted(names))), F.lit(True))


def _template(text: str, op: Column, section: Column) -> Column:
    """The template's text; null if a field without default is absent."""
    parts: list[Column] = []
    at = 0
    for m in _FIELD.finditer(text):
        parts.append(F.lit(text[at : m.start()]))
        at = m.end()
        if m[1]:
            # a | within a field's default parts nothing
            wanted, *other = re.split(r"\|(?![^{]*\})", m[1], maxsplit=1)
            parts.append(F.coalesce(_template(wanted, op, section), _template(other[0], op, section) if other else F.lit("")))
        elif m[2] == "profile":
            parts.append(section)
        elif m[4] is None or m[3]:
            code = F.try_element_at(op["code"], F.lit(m[2]))
            parts.append(F.coalesce(code, F.lit(m[4])) if m[3] else code)
        else:
            parts.append(F.coalesce(F.try_element_at(op["attrs"], F.lit(m[2])), F.lit(m[4])))
    return F.concat(*parts, F.lit(text[at:]))


def _code(exprs: Column) -> Column:
    """The source text of each expression that is present; null if one has none."""
    code = F.transform_values(F.map_filter(exprs, lambda _, e: e.isNotNull()), lambda _, e: source_text(e))
    none = F.create_map().cast("map<string,string>")
    return F.when(exprs.isNull(), none).otherwise(let(code, lambda c: F.when(F.forall(F.map_values(c), lambda t: t.isNotNull()), c)))


def _sketch(sketch: Column) -> Column:
    scaled = lambda name, v: F.concat(F.lit('p["'), sketch[name], F.lit('"] * '), python_float(v))
    point = lambda s: F.concat(scaled("w_param", s["x"]), F.lit(", "), scaled("h_param", s["y"]))
    moves = F.transform(sketch["points"], lambda s: F.concat(F.when(s["kind"] == "start", ".moveTo(").otherwise(".lineTo("), point(s), F.lit(")")))
    straight = F.forall(sketch["points"], lambda s: s["kind"].isin("start", "line"))
    return F.when(straight, F.concat(F.array_join(moves, ""), F.lit(".close()")))


def profile_source(profile: Column) -> Column:
    """A cross-section's calls; a sketch of straight lines is a closed chain of moves through its points, and one with curves has no text."""

    def calls(p: Column) -> Column:
        out = F.when(p["type"] == "sketched", p["sketch"])
        for kind, text in PROFILES.items():
            out = out.when((p["type"] == kind) & _only(p["code"], _names(text)), _template(text, p, F.lit("")))
        return out

    return let(F.struct(profile["type"].alias("type"), _code(profile["exprs"]).alias("code"), F.when(profile["sketch"].isNotNull(), _sketch(profile["sketch"])).alias("sketch")), calls)


def statement(op: Column) -> Column:
    """An operation's statement, under its condition if it has one; null for a kind without template, and if it has a field that no template of its kind uses."""

    def text(o: Column) -> Column:
        attr = lambda name, default: F.coalesce(F.try_element_at(o["attrs"], F.lit(name)), F.lit(default))
        placed = F.concat(o["type"], F.lit("/"), attr("placement", "corners"))
        shaped = placed.isin("holes/corners", "holes/grid") & (attr("shape", "round") != "round")
        holes = F.when(shaped, F.concat(placed, F.lit("/"), attr("shape", "round"))).otherwise(placed)
        kind = F.when(o["type"].isin("holes", "counterbore", "countersink"), holes).otherwise(o["type"])
        out = F.when(F.lit(False), F.lit(None).cast("string"))
        for name, template in STATEMENTS.items():
            out = out.when(kind == name, _template(template, o, o["section"]))
        known: dict[str, set[str]] = {}
        for name, template in STATEMENTS.items():
            known.setdefault(name.split("/")[0], {"enabled"}).update(_names(template), SILENT.get(name.split("/")[0], ()))
        whole = F.lit(False)
        for name, names in known.items():
            fits = _only(o["code"], names) & _only(o["attrs"], names) & (F.lit("profile" in names) | ~o["profiled"]) & ~o["stationed"]
            whole = F.when(o["type"] == name, fits).otherwise(whole)
        return F.struct(F.when(o["code"].isNotNull() & whole, out).alias("text"), F.try_element_at(o["code"], F.lit("enabled")).alias("switch"))

    def guarded(s: Column) -> Column:
        return F.when(s["switch"].isNull(), s["text"]).otherwise(F.concat(F.lit("if "), s["switch"], F.lit(":\n    "), F.replace(s["text"], F.lit("\n"), F.lit("\n    "))))

    staged = F.struct(op["type"].alias("type"), op["attrs"].alias("attrs"), _code(op["exprs"]).alias("code"), F.when(op["profile"].isNotNull(), profile_source(op["profile"])).alias("section"), op["profile"].isNotNull().alias("profiled"), F.coalesce(F.size(op["stations"]) > 0, F.lit(False)).alias("stationed"))
    return let(let(staged, text), guarded)


def param_entry(p: Column) -> Column:
    """One line of the PARAMS literal from a struct of name, type, default (JSON text), min, max, step, choices, grp and label."""
    quote = lambda s: F.concat(F.lit("'"), F.regexp_replace(F.replace(s, F.lit("\\"), F.lit("\\\\")), "'", r"\\'"), F.lit("'"))
    number = lambda v: F.when(p["type"] == "int", v.cast("bigint").cast("string")).otherwise(python_float(v))
    default = F.when(p["default"] == "true", "True").when(p["default"] == "false", "False").when(F.startswith(p["default"], F.lit('"')), quote(F.get_json_object(F.concat(F.lit('{"v":'), p["default"], F.lit("}")), "$.v"))).otherwise(p["default"])
    pair = lambda key, text: F.concat(F.lit(f'"{key}": '), text)
    pairs = F.array_compact(F.array(
        pair("type", quote(p["type"])), pair("default", default), pair("min", number(p["min"])), pair("max", number(p["max"])), pair("step", number(p["step"])),
        pair("choices", F.concat(F.lit("["), F.array_join(F.transform(p["choices"], quote), ", "), F.lit("]"))), pair("group", quote(p["grp"])), pair("label", quote(p["label"])),
    ))
    return F.concat(F.lit('    "'), p["name"], F.lit('": {'), F.array_join(pairs, ", "), F.lit("},"))


def source(header: Column, imports: Column, params: Column, statements: Column) -> Column:
    """A whole source file: header, imports once each in order, parameters, the build function and the canonical call."""
    lines = lambda a: F.array_join(a, "\n")
    body = F.transform(statements, lambda s: F.concat(F.lit("    "), F.replace(s, F.lit("\n"), F.lit("\n    "))))
    extra = F.array_sort(F.array_distinct(imports))
    return F.concat(
        F.lit("import cadquery as cq\n"), F.when(F.size(extra) > 0, F.concat(lines(extra), F.lit("\n"))).otherwise(""), header, F.lit("\nPARAMS = {\n"), lines(F.transform(params, param_entry)),
        F.lit("\n}\n\n\ndef build(p):\n\n"), lines(body), F.lit('\n    return result\n\n\nresult = build({k: v["default"] for k, v in PARAMS.items()})\n'),
    )


def emitted(parts: DataFrame, header: Column, imports: Column | None = None) -> DataFrame:
    """(part_id, source) of parts with params_spec (array of parameter structs, in order) and operations; source is null if an operation has no template, or a field that its templates do not use."""
    none = F.array().cast("array<string>")
    made = parts.select("part_id", "params_spec", F.transform("operations", lambda op: statement(op)).alias("made"), header.alias("header"), (none if imports is None else imports).alias("imports"))
    whole = F.forall("made", lambda s: s.isNotNull())
    return made.select("part_id", F.when(whole, source(F.col("header"), F.col("imports"), F.col("params_spec"), F.col("made"))).alias("source"))
