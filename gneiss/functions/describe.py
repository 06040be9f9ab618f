"""Plain-English phrases for part operations, and descriptors, as expressions over structured operations.

An operation is a struct: type, exprs (map from field to expression, see expressions.py), attrs (map from field to text), profile
and stations (each a struct of type, exprs and a sketch). Values come from the part's default parameters. An absent
optional field is simply not in the map.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.functions.expressions import EXPR_TYPE, evaluate
from gneiss.functions.scalars import count_word, designation, dia, edge_name, face_name, fmt_num, hole_count, mm, pitch_diameter, placement_phrase, plural, whole_or

SKETCH_TYPE = "struct<w_param: string, h_param: string, points: array<struct<kind: string, x: double, y: double>>>"
PROFILE_TYPE = f"struct<type: string, exprs: map<string,{EXPR_TYPE}>, sketch: {SKETCH_TYPE}>"
OP_TYPE = f"struct<type: string, exprs: map<string,{EXPR_TYPE}>, attrs: map<string,string>, profile: {PROFILE_TYPE}, stations: array<{PROFILE_TYPE}>>"


def _text(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def _if(present: Column, *parts: Column | str) -> Column:
    """The text if what it is about is present, else ''."""
    return F.when(present, F.coalesce(_text(*parts), F.lit(""))).otherwise("")


def _values(exprs: Column, params: Column) -> Column:
    return F.coalesce(F.transform_values(exprs, lambda _, e: evaluate(e, params)), F.create_map().cast("map<string,double>"))


def _staged(op: Column, params: Column) -> Column:
    """An operation with its values worked out and written once: type, attrs, v (numbers), t (texts), section, sections."""
    section = F.when(op["profile"].isNotNull(), profile_phrase(op["profile"], params))
    sections = F.transform(op["stations"], lambda s: profile_phrase(s, params))
    return F.struct(op["type"].alias("type"), op["attrs"].alias("attrs"), _values(op["exprs"], params).alias("v"), section.alias("section"), sections.alias("sections"))


def _written(op: Column) -> Column:
    return op.withField("t", F.transform_values(op["v"], lambda _, v: fmt_num(v)))


class _Op:
    """Access to the fields of a staged operation."""

    def __init__(self, op: Column):
        self.op = op

    def v(self, name: str) -> Column:
        return F.try_element_at(self.op["v"], F.lit(name))

    def t(self, name: str) -> Column:
        return F.try_element_at(self.op["t"], F.lit(name))

    def mm(self, name: str) -> Column:
        return F.concat(self.t(name), F.lit(" mm"))

    def dia(self, name: str) -> Column:
        return F.concat(F.lit("Ø"), self.mm(name))

    def has(self, *names: str) -> Column:
        out = F.lit(True)
        for n in names:
            out = out & F.map_contains_key(self.op["v"], F.lit(n))
        return out

    def attr(self, name: str, default: str | None = None) -> Column:
        found = F.try_element_at(self.op["attrs"], F.lit(name))
        return F.coalesce(found, F.lit(default)) if default is not None else found

    def times(self, *names: str) -> Column:
        """Sizes as 80 × 60 × 10."""
        out: list[Column | str] = []
        for n in names:
            out += [" × ", self.t(n)]
        return _text(*out[1:])

    @property
    def holes(self) -> Column:
        return hole_count(self.attr("placement"), self.v("nx"), self.v("ny"), self.v("n_bolts"))

    @property
    def place(self) -> Column:
        return placement_phrase(self.attr("placement"), self.v("spacing_x"), self.v("spacing_y"), self.v("nx"), self.v("ny"), self.v("bolt_circle_r"))


def sketch_phrase(sketch: Column, params: Column) -> Column:
    """A sketch's kinds of segments and its extent; the first point is its start."""
    segments = F.filter(sketch["points"], lambda s: s["kind"] != "start")
    count = lambda *kinds: F.size(F.filter(segments, lambda s: s["kind"].isin(*kinds)))
    straight, arcs, curves = count("line"), count("arc"), count("bezier", "spline")
    said = [F.when(straight > 0, _text(straight.cast("string"), " straight")), F.when(arcs > 0, _text(arcs.cast("string"), " ", plural(arcs, "arc"))), F.when(curves > 0, _text(curves.cast("string"), " ", plural(curves, "curve")))]
    total = F.size(segments).cast("string")
    mix = F.concat_ws(", ", *said)
    extent = lambda axis, name: (F.array_max(F.transform(sketch["points"], lambda s: s[axis])) - F.array_min(F.transform(sketch["points"], lambda s: s[axis]))) * F.try_element_at(params, sketch[name])
    size = _text(", ~", fmt_num(extent("x", "w_param")), " × ", fmt_num(extent("y", "h_param")), " mm")
    return _text("freeform sketched section (", total, " segments: ", F.when(mix == "", _text(total, " segments")).otherwise(mix), ")", F.coalesce(size, F.lit("")))


def profile_phrase(profile: Column, params: Column) -> Column:
    """A cross-section in words."""

    def say(staged: Column) -> Column:
        p, kind = _Op(staged), staged["type"]
        return (
            F.when(kind.isin("rect", "rounded_rect"), _text(p.times("width", "depth"), " mm rectangular section"))
            .when(kind == "circle", _text(p.dia("diameter"), " circular section"))
            .when(kind == "polygon", _text(whole_or(p.v("sides"), 0).cast("string"), "-sided polygon section, ", mm(p.v("circumscribed_r") * 2), " across corners"))
            .when(kind == "slot", _text(p.times("length", "width"), " mm slot section"))
            .when(kind == "sketched", staged["sketch"])
            .otherwise("profile")
        )

    staged = F.struct(profile["type"].alias("type"), _values(profile["exprs"], params).alias("v"), F.when(profile["sketch"].isNotNull(), sketch_phrase(profile["sketch"], params)).alias("sketch"))
    return F.get(F.transform(F.transform(F.array(staged), _written), say), 0)


def _holes(o: _Op) -> Column:
    n, shape = o.holes, o.attr("shape", "round")
    slot = F.when(o.has("slot_len"), o.times("slot_len", "diameter")).otherwise(o.t("diameter"))
    feature = F.when(shape == "square", _text(o.t("diameter"), " mm square ", plural(n, "hole"))).when(shape == "slot", _text(slot, " mm ", plural(n, "slot"))).otherwise(_text(o.dia("diameter"), " ", plural(n, "hole")))
    face = o.attr("face", ">Z")
    return _text(count_word(n), " ", feature, " ", o.place, _if(o.has("tilt"), ", angled ", o.t("tilt"), "°"), F.when(face != ">Z", _text(" on the ", face, " face")).otherwise(""), ".")


def _optional(o: _Op, *parts: Column | str) -> Column:
    off = o.has("enabled") & (F.coalesce(o.v("enabled"), F.lit(0.0)) == 0)
    return _text(*parts, F.when(off, " (optional, off by default)").otherwise(""), ".")


def _bracket(kind: str) -> Callable[[_Op], Column]:
    def phrase(o: _Op) -> Column:
        holes = F.greatest(whole_or(o.v("n_holes"), 1), F.lit(1))
        off = o.has("gusset_enabled") & (F.coalesce(o.v("gusset_enabled"), F.lit(0.0)) == 0)
        top = _if(o.has("top_len"), ", top leg ", o.mm("top_len")) if kind == "Z-bracket" else ""
        return _text(
            f"{kind}: base leg ", o.mm("base_len"), ", vertical leg ", o.mm("vert_len"), top, ", ", o.mm("width"), " wide, ", o.mm("thickness"), " thick",
            _if(o.has("hole_d") & (F.coalesce(o.v("hole_d"), F.lit(0.0)) != 0), "; ", holes.cast("string"), " × ", o.dia("hole_d"), " ", plural(holes, "hole"), " per leg"),
            _if(o.has("gusset_t"), "; ", o.mm("gusset_t"), " corner gusset", F.when(off, " (optional)").otherwise("")),
            ".",
        )

    return phrase


def _gear(o: _Op) -> Column:
    kind = o.attr("kind", "spur")
    helical = kind == "helical"
    return _text(
        F.concat(F.upper(F.substring(kind, 1, 1)), F.lower(F.substring(kind, F.lit(2), F.length(kind)))), " gear, module ", o.mm("module"), ", ", o.v("teeth").cast("int").cast("string"),
        " teeth (pitch ", dia(pitch_diameter(o.v("module"), o.v("teeth").cast("int"))), "), face width ", o.mm("width"),
        _if(helical & o.has("helix_angle"), ", ", o.t("helix_angle"), "° helix", F.when(o.attr("herringbone", "false") == "true", " (herringbone)").otherwise("")),
        _if((kind == "bevel") & o.has("cone_angle"), ", ", o.t("cone_angle"), "° pitch cone"),
        _if(o.has("bore_d"), ", ", o.dia("bore_d"), " bore"),
        _if(o.has("hub_d", "hub_h"), ", ", o.dia("hub_d"), " × ", o.mm("hub_h"), " hub"),
        ".",
    )


def _thread_name(o: _Op, standard: Column) -> Column:
    return designation(standard, o.attr("size"), o.v("major_d"), o.v("pitch"))


def _tapped_holes(o: _Op) -> Column:
    """Holes of a tapped body: one in its end, four in the corners, or a grid."""
    placement = o.attr("placement")
    at_least = lambda n: F.greatest(F.coalesce(o.v(n).cast("int"), F.lit(2)), F.lit(1))
    return F.when(placement == "corners", 4).when(placement == "grid", at_least("nx") * at_least("ny")).otherwise(1)


#: One phrase per kind of operation; a registry that callers may extend.
PHRASES: dict[str, Callable[[_Op], Column]] = {
    "box": lambda o: _text("Rectangular body, ", o.times("width", "depth", "height"), " mm (W×D×H)."),
    "extrude": lambda o: _text(o.op["section"], ", extruded ", o.mm("distance"), " thick", _if(o.has("taper"), " with a ", o.t("taper"), "° draft"), "."),
    "revolve": lambda o: _text(
        "Revolved body, ", o.dia("outer_d"), " × ", o.mm("height"), " tall",
        _if(o.has("inner_d") | o.has("flange_d", "flange_h") | o.has("groove_depth", "groove_w"), " with ", F.concat_ws(", ", F.array_compact(F.array(
            F.when(o.has("inner_d"), _text(o.dia("inner_d"), " bore")),
            F.when(o.has("flange_d", "flange_h"), _text(o.dia("flange_d"), " × ", o.mm("flange_h"), " flange")),
            F.when(o.has("groove_depth", "groove_w"), _text(o.mm("groove_w"), "-wide groove ", o.mm("groove_depth"), " deep")),
        )))),
        ".",
    ),
    "sketched_revolve": lambda o: _text("Revolved organic body from a ", o.op["section"], " half-silhouette."),
    "loft": lambda o: _text("Lofted body through ", F.size(o.op["sections"]).cast("string"), " sections: ", F.array_join(o.op["sections"], " → "), "."),
    "sweep": lambda o: _text(o.op["section"], " swept along a curved path", F.coalesce(_text(", ~", fmt_num(F.when(o.v("path_w").isNotNull() & o.v("path_h").isNotNull(), F.greatest(o.v("path_w"), o.v("path_h")))), " mm span"), F.lit("")), "."),
    "holes": _holes,
    "counterbore": lambda o: _text(count_word(o.holes), " ", o.dia("diameter"), " counterbored holes (", o.dia("cb_diameter"), " × ", o.mm("cb_depth"), " counterbore) ", o.place, "."),
    "countersink": lambda o: _text(count_word(o.holes), " ", o.dia("diameter"), " countersunk holes (", o.t("cs_angle"), "°) ", o.place, "."),
    "fillet": lambda o: _optional(o, "Fillet radius ", o.mm("radius"), " on ", edge_name(o.attr("edge_selector", "|Z"))),
    "chamfer": lambda o: _optional(o, "Chamfer ", o.mm("distance"), " on ", edge_name(o.attr("edge_selector", "|Z"))),
    "shell": lambda o: _text("Hollowed to ", o.mm("thickness"), " wall thickness, open at ", face_name(o.attr("open_face", ">Z")), "."),
    "pocket": lambda o: _text("Pocket ", o.times("width", "depth"), " mm, ", o.mm("pocket_depth"), " deep, in ", face_name(o.attr("face", ">Z")), "."),
    "boss": lambda o: _text("Boss ", o.dia("diameter"), " × ", o.mm("height"), " tall on ", face_name(o.attr("face", ">Z")), _if(o.has("bore_d"), " with a ", o.dia("bore_d"), " bore"), "."),
    "ribs": lambda o: _text(count_word(whole_or(o.v("count"), 1)), " ribs, ", o.mm("rib_thickness"), " thick, ", o.mm("rib_height"), " tall."),
    "attach": lambda o: _text(o.op["section"], " attachment, ", o.mm("length"), " long, from ", face_name(o.attr("face", ">Z")), _if(o.has("bore_d"), " with a ", o.dia("bore_d"), " bore"), "."),
    "lbracket": _bracket("L-bracket"),
    "cbracket": _bracket("C-channel bracket"),
    "zbracket": _bracket("Z-bracket"),
    "gear": _gear,
    "threaded": lambda o: _text(_thread_name(o, o.attr("standard", "iso")), F.when(o.attr("external", "true") == "true", " external").otherwise(" internal"), " thread, ", o.mm("length"), " long."),
    "tapped": lambda o: _text(count_word(_tapped_holes(o)), " ", _thread_name(o, F.lit("iso")), " tapped ", plural(_tapped_holes(o), "hole"), " in a ", F.when(o.attr("body") == "cylinder", "cylinder").otherwise("plate"), "."),
}


def _phrase(op: Column) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for kind, build in PHRASES.items():
        out = out.when(op["type"] == kind, build(_Op(op)))
    return out


def _operations(params: str = "params") -> Column:
    staged = F.transform("operations", lambda op: _staged(op, F.col(params)))
    return F.transform(staged, _written)


def described(parts: DataFrame, *more: Column) -> DataFrame:
    """(part_id, lines, more, text) of parts (part_id, params map, operations array of OP_TYPE); parts without a phrase have no lines and the text ''.

    An operation of an unknown kind, or one that lacks a size, has no phrase. `more` are other columns of the same rows, which thus need no join.
    """
    spoken = F.filter(F.transform(_operations(), _phrase), lambda s: s.isNotNull() & (s != ""))
    return parts.select("part_id", F.coalesce(spoken, F.array().cast("array<string>")).alias("lines"), *more).withColumn("text", F.array_join("lines", " "))


def _descriptor(op: Column) -> Column:
    """What a gear, thread or tapped body is, as a map of text; null for other operations."""
    o = _Op(op)
    kind = o.attr("kind", "spur")
    standard = F.when(op["type"] == "tapped", "iso").otherwise(o.attr("standard", "iso"))
    iso = standard == "iso"
    fields = {
        "gear": {
            "family": F.lit("gear"), "kind": kind, "module": o.v("module"), "teeth": o.v("teeth").cast("int"), "face_width": o.v("width"),
            "pitch_diameter": pitch_diameter(o.v("module"), o.v("teeth").cast("int")), "pressure_angle_deg": F.lit(20.0),
            "helix_angle_deg": F.when(kind == "helical", o.v("helix_angle")), "herringbone": F.when(kind == "helical", o.attr("herringbone", "false")),
            "cone_angle_deg": F.when(kind == "bevel", o.v("cone_angle")), "profile_shift": F.when(kind != "cycloid", o.v("profile_shift")),
            "root_fillet": o.v("root_fillet"), "bore_d": o.v("bore_d"), "hub_d": F.when(o.has("hub_d", "hub_h"), o.v("hub_d")), "hub_h": F.when(o.has("hub_d", "hub_h"), o.v("hub_h")),
        },
        "threaded": {
            "family": F.lit("threaded"), "standard": standard, "external": o.attr("external", "true"), "length": o.v("length"), "major_diameter": F.when(iso, o.v("major_d")),
            "pitch": F.when(iso, o.v("pitch")), "size": F.when(~iso, o.attr("size")), "designation": _thread_name(o, standard),
        },
        "tapped": {
            "family": F.lit("tapped"), "body": o.attr("body", "box"), "standard": standard, "major_diameter": o.v("major_d"), "pitch": o.v("pitch"),
            "designation": _thread_name(o, standard), "hole_count": _tapped_holes(o),
        },
    }
    out = F.lit(None).cast("map<string,string>")
    for name, values in fields.items():
        made = F.create_map(*(x for k, v in values.items() for x in (F.lit(k), v.cast("string"))))
        out = F.when(op["type"] == name, F.map_filter(made, lambda _, v: v.isNotNull())).otherwise(out)
    return out


def descriptors(parts: DataFrame) -> DataFrame:
    """(part_id, descriptor) of parts: the entries of all operations' descriptors, later ones winning; null if there are none."""
    maps = F.filter(F.transform(_operations(), _descriptor), lambda m: m.isNotNull())
    merged = F.aggregate(maps, F.create_map().cast("map<string,string>"), lambda a, m: F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(m, k)), m))
    return parts.select("part_id", F.when(F.size(maps) > 0, merged).alias("descriptor"))
