"""Scalar functions as builders of Columns: each takes Columns (or names) and stays inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str
# Wording and numbers of the corpus format.
COUNT_WORDS = {1: "One", 2: "Two", 3: "Three", 4: "Four", 5: "Five", 6: "Six", 7: "Seven", 8: "Eight", 9: "Nine", 10: "Ten", 12: "Twelve"}
FACE_NAMES = {">Z": "top face", "<Z": "bottom face", ">X": "right face", "<X": "left face", ">Y": "back face", "<Y": "front face"}
EDGE_NAMES = {"|Z": "vertical edges", "|X": "edges along X", "|Y": "edges along Y", ">Z": "top edges", "<Z": "bottom edges"}
TAG_UNITS = {"k": 1_000, "m": 1_000_000}
SEED_FACTOR, SEED_MASK = 1_000_003, 0xFFFFFFFF
SATURATION, SATURATION_SPAN = 0.62, 0.23
BRIGHTNESS, BRIGHTNESS_SPAN = 0.82, 0.13
#: Edge detector: value when soft, value when crisp.
EDGE_BOUNDS = {"n_lo": (0.12, 0.02), "n_hi": (0.45, 0.12), "d_lo": (0.040, 0.008), "d_hi": (0.120, 0.035), "width": (1.7, 1.0)}


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _map(values: dict) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))


def part_seed(seed: int, attempt: ColumnOrName) -> Column:
    """(seed * 1000003 + attempt) modulo 2**32; exact for any 64-bit seed, since only the seed's low 32 bits count."""
    return (F.lit((seed * SEED_FACTOR) & SEED_MASK) + _c(attempt)).bitwiseAND(F.lit(SEED_MASK))


def part_id(family: ColumnOrName, seed: Column, attempt: ColumnOrName) -> Column:
    """family_hexseed_attempt, the attempt padded to four digits at least."""
    digits = _c(attempt).cast("string")
    return F.concat_ws("_", _c(family), F.lpad(F.lower(F.hex(seed)), 8, "0"), F.when(F.length(digits) < 4, F.lpad(digits, 4, "0")).otherwise(digits))


def id_suffix(name: ColumnOrName) -> Column:
    """The whole number after the last underscore, 0 if there is none."""
    return F.when(F.instr(_c(name), "_") > 0, F.coalesce(F.substring_index(_c(name), "_", -1).try_cast("bigint"), F.lit(0).cast("bigint"))).otherwise(F.lit(0).cast("bigint"))


def round_sig(x: ColumnOrName, digits: int = 3) -> Column:
    """x to so many significant digits, half to even. The power of ten is read from text: pow() is not exact."""
    v = _c(x).cast("double")
    places = F.lit(digits - 1) - F.floor(F.log10(F.abs(v)))
    power = F.concat(F.lit("1e"), places.cast("string")).cast("double")
    return F.when(v == 0, F.lit(0.0)).when(F.isnan(v) | (F.abs(v) == float("inf")), v).otherwise(F.rint(v * power) / power)


def signature(volume: ColumnOrName, area: ColumnOrName, moments: ColumnOrName, faces: ColumnOrName, edges: ColumnOrName, vertices: ColumnOrName, version: int = 2) -> Column:
    """The rounded signature of a shape: moments are sorted before they are rounded."""
    return F.struct(
        F.lit(version).alias("version"),
        round_sig(volume).alias("volume"),
        round_sig(area).alias("surface_area"),
        F.transform(F.array_sort(_c(moments)), lambda m: round_sig(m)).alias("principal_moments"),
        _c(faces).cast("int").alias("n_faces"),
        _c(edges).cast("int").alias("n_edges"),
        _c(vertices).cast("int").alias("n_vertices"),
    )


SIGNATURE_TYPE = "struct<version: int, volume: double, surface_area: double, principal_moments: array<double>, n_faces: int, n_edges: int, n_vertices: int>"


def signature_json(sig: ColumnOrName) -> Column:
    """The signature as JSON text; a missing one is the text null."""
    return F.coalesce(F.to_json(_c(sig)), F.lit("null"))


def signature_from_json(text: ColumnOrName, version: int = 2) -> Column:
    """The signature of JSON text, null if it is none; a missing version is the current one, missing moments are empty."""
    s = F.from_json(_c(text), SIGNATURE_TYPE, {"mode": "PERMISSIVE"})
    filled = s.withField("version", F.coalesce(s["version"], F.lit(version))).withField("principal_moments", F.coalesce(s["principal_moments"], F.array().cast("array<double>")))
    return F.when(F.trim(_c(text)).startswith("{") & s["volume"].isNotNull(), filled)


def bbox_dims(box: ColumnOrName) -> Column:
    """Extents along x, y and z of [x0, y0, z0, x1, y1, z1]; null components stay null."""
    return F.array(*(F.get(_c(box), i + 3) - F.get(_c(box), i) for i in range(3)))


def content_hash(x: ColumnOrName) -> Column:
    """First 16 hexadecimal digits of the SHA-256 of a text."""
    return F.substring(F.sha2(_c(x), 256), 1, 16)


def record_hash(*fields: ColumnOrName) -> Column:
    """content_hash of a canonical form: a JSON object of the fields that keeps nulls, in the order given."""
    return content_hash(F.to_json(F.struct(*(_c(f) for f in fields)), {"ignoreNullFields": "false"}))


def _hex_number(digest: Column, start: int, length: int) -> Column:
    return F.conv(F.substring(digest, start, length), 16, 10).cast("double")


def color_hsv(name: ColumnOrName) -> Column:
    """Hue, saturation and value of a name's colour, from its MD5."""
    digest = F.md5(_c(name).cast("binary"))
    return F.struct(
        (_hex_number(digest, 1, 8) / 4294967296.0).alias("h"),
        (F.lit(SATURATION) + _hex_number(digest, 9, 2) / 255.0 * SATURATION_SPAN).alias("s"),
        (F.lit(BRIGHTNESS) + _hex_number(digest, 11, 2) / 255.0 * BRIGHTNESS_SPAN).alias("v"),
    )


def hsv_to_rgb(hsv: Column) -> Column:
    """Red, green and blue from 0 to 1; each channel is a clipped triangle wave of the hue."""

    def channel(shift: int) -> Column:
        k = F.pmod(hsv["h"] * 6 + shift, F.lit(6.0))
        fall = F.greatest(F.lit(0.0), F.least(k, F.lit(4.0) - k, F.lit(1.0)))
        return hsv["v"] - hsv["v"] * hsv["s"] * fall

    return F.struct(channel(5).alias("r"), channel(3).alias("g"), channel(1).alias("b"))


def tag_to_int(tag: ColumnOrName) -> Column:
    """50k is 50000, 1.5m is 1500000; anything else that is no number is 0."""
    clean = F.lower(F.trim(_c(tag)))
    unit = F.substring(clean, -1, 1)
    factor = F.coalesce(F.try_element_at(_map(TAG_UNITS), unit), F.lit(1))
    number = F.regexp_replace(clean, "[km]$", "").try_cast("double")
    return F.coalesce((number * factor).try_cast("bigint"), F.lit(0).cast("bigint"))


def size_bucket(n: ColumnOrName) -> Column:
    """The size category of a number of rows."""
    v = _c(n)
    return F.when(v >= 1_000_000, "1M<n<10M").when(v >= 100_000, "100K<n<1M").when(v >= 10_000, "10K<n<100K").when(v >= 1_000, "1K<n<10K").otherwise("n<1K")


def digits_number(text: ColumnOrName) -> Column:
    """The number that a text's digits make up, 0 if it has none."""
    return F.coalesce(F.regexp_replace(_c(text), "[^0-9]", "").try_cast("bigint"), F.lit(0).cast("bigint"))


def fmt_num(x: ColumnOrName) -> Column:
    """A number as short text: whole ones (within 1e-6) without a point, others with three decimals at most.

    The decimals are rounded half up on the shortest decimal form, which differs from exact binary rounding on some values of more than three decimals.
    """
    v = _c(x).cast("double")
    whole = F.abs(v - F.rint(v)) < 1e-6
    short = F.regexp_replace(F.format_string("%.3f", v), r"\.?0+$", "")
    return F.when(v.isNull(), None).when(F.isnan(v), "nan").when(whole, F.rint(v).cast("decimal(38,0)").cast("string")).otherwise(short)


def mm(x: ColumnOrName) -> Column:
    return F.concat(fmt_num(x), F.lit(" mm"))


def dia(x: ColumnOrName) -> Column:
    return F.concat(F.lit("Ø"), mm(x))


def count_word(n: ColumnOrName) -> Column:
    """One to Ten and Twelve as words, other numbers as digits."""
    return F.coalesce(F.try_element_at(_map(COUNT_WORDS), _c(n).cast("int")), _c(n).cast("string"))


def plural(n: ColumnOrName, noun: str) -> Column:
    return F.when(_c(n) == 1, noun).otherwise(noun + "s")


def face_name(selector: ColumnOrName) -> Column:
    return F.coalesce(F.try_element_at(_map(FACE_NAMES), _c(selector)), F.concat(F.lit("the "), _c(selector), F.lit(" face")))


def edge_name(selector: ColumnOrName) -> Column:
    return F.coalesce(F.try_element_at(_map(EDGE_NAMES), _c(selector)), F.concat(F.lit("the "), _c(selector), F.lit(" edges")))


def whole_or(x: ColumnOrName, default: int) -> Column:
    """The nearest whole number (half to even), or a default for what is no number."""
    return F.coalesce(F.rint(_c(x).try_cast("double")).try_cast("int"), F.lit(default))


def hole_count(placement: ColumnOrName, nx: ColumnOrName, ny: ColumnOrName, bolts: ColumnOrName) -> Column:
    """Holes of a pattern: four corners, a grid, a bolt circle, two staggered rows; 0 for an unknown placement."""
    p = _c(placement)
    at_least = lambda x, default, least: F.greatest(whole_or(x, default), F.lit(least))
    return (
        F.when(p.isNull() | (p == "corners"), 4)
        .when(p == "grid", at_least(nx, 2, 1) * at_least(ny, 2, 1))
        .when(p == "bolt_circle", at_least(bolts, 4, 1))
        .when(p == "staggered", at_least(nx, 3, 2) * 2 - 1)
        .otherwise(0)
    )


def placement_phrase(placement: ColumnOrName, spacing_x: ColumnOrName, spacing_y: ColumnOrName, nx: ColumnOrName, ny: ColumnOrName, radius: ColumnOrName) -> Column:
    """Where the holes of a pattern lie, in words; spacings that are null are left unsaid."""
    p, both = _c(placement), F.concat(fmt_num(spacing_x), F.lit(" × "), fmt_num(spacing_y))
    with_spacing = lambda start, noun: F.concat(start, F.coalesce(F.concat(F.lit(", "), both, F.lit(f" mm {noun}")), F.lit("")))
    across, down = (F.greatest(whole_or(x, 2), F.lit(1)).cast("string") for x in (nx, ny))
    return (
        F.when(p.isNull() | (p == "corners"), with_spacing(F.lit("at the corners"), "spacing"))
        .when(p == "grid", with_spacing(F.concat(F.lit("in a "), across, F.lit("×"), down, F.lit(" grid")), "pitch"))
        .when(p == "bolt_circle", F.coalesce(F.concat(F.lit("on a "), dia(_c(radius) * 2), F.lit(" bolt circle")), F.lit("on a bolt circle")))
        .when(p == "staggered", with_spacing(F.lit("in two staggered rows"), "pitch"))
        .otherwise("")
    )


def general_number(x: ColumnOrName) -> Column:
    """A number of few digits without a needless point: 16.0 is 16, 1.25 stays."""
    return F.regexp_replace(_c(x).cast("double").cast("string"), r"\.0$", "")


def designation(standard: ColumnOrName, size: ColumnOrName, major: ColumnOrName, pitch: ColumnOrName) -> Column:
    """A thread's name: metric by diameter and pitch, the inch and trapezoidal standards by size."""
    s = F.lower(_c(standard))
    return F.when(s == "iso", F.concat(F.lit("M"), general_number(major), F.lit("x"), general_number(pitch))).when(s == "acme", F.concat(F.lit("ACME "), _c(size))).otherwise(F.concat(F.lit("Tr "), _c(size)))


def pitch_diameter(module: ColumnOrName, teeth: ColumnOrName) -> Column:
    return F.bround(_c(module) * _c(teeth), 4)


def edge_params(crispness: ColumnOrName) -> Column:
    """The edge detector's five numbers, each between its soft and its crisp value."""
    c = F.greatest(F.lit(0.0), F.least(F.lit(1.0), _c(crispness).cast("double")))
    return F.struct(*((F.lit(soft) + F.lit(crisp - soft) * c).alias(name) for name, (soft, crisp) in EDGE_BOUNDS.items()))


def nice(uniform: ColumnOrName, lo: float, hi: float, snap: ColumnOrName, probability: float = 0.5, step: float = 5.0) -> Column:
    """A value of [lo, hi] from two uniform numbers: `snap` under probability rounds to a multiple of step, kept in range."""
    v = F.lit(lo) + _c(uniform) * F.lit(hi - lo)
    return F.when(_c(snap) < probability, F.greatest(F.lit(lo), F.least(F.lit(hi), F.rint(v / step) * step))).otherwise(F.bround(v, 2))


def in_range(table: list[float], lo: ColumnOrName, hi: ColumnOrName) -> Column:
    """Entries of a table of standard sizes between lo and hi."""
    return F.filter(F.array(*map(F.lit, table)), lambda x: (x >= _c(lo)) & (x <= _c(hi)))


def snap_to(table: list[float], value: ColumnOrName, lo: ColumnOrName, hi: ColumnOrName) -> Column:
    """The standard size in range nearest to a value (the smaller on a tie); the value itself, to two places, if there is none."""
    v = _c(value)
    near = F.array_min(F.transform(in_range(table, lo, hi), lambda x: F.struct(F.abs(x - v).alias("gap"), x.alias("size"))))
    return F.coalesce(near["size"], F.bround(v.cast("double"), 2))


def pick_standard(table: list[float], u: ColumnOrName, lo: ColumnOrName, hi: ColumnOrName, places: int = 2) -> Column:
    """A standard size between lo and hi, each as likely, chosen by a number u of [0, 1); if there is none a size of the range itself, rounded."""
    fits = in_range(table, lo, hi)
    at = F.least(F.floor(_c(u) * F.size(fits)).cast("int"), F.size(fits) - 1)
    return F.when(F.size(fits) > 0, F.get(fits, at)).otherwise(F.bround(_c(lo) + _c(u) * (_c(hi) - _c(lo)), places))


def stem_number(path: ColumnOrName) -> Column:
    """The number that a file's name without suffix is; null if it is none. Ordered with nulls last, files 2, 10, x come in this order."""
    return F.regexp_extract(_c(path), r"([^/]+?)(?:\.[^./]*)?$", 1).try_cast("bigint")


def uniform(seed: int, *keys: ColumnOrName) -> Column:
    """A number of [0, 1) fixed by seed and keys, for draws that do not depend on partitions."""
    return F.pmod(F.xxhash64(F.lit(seed), *(_c(k) for k in keys)), F.lit(1 << 52)).cast("double") / float(1 << 52)


def render_filename(view: ColumnOrName, render_pass: ColumnOrName) -> Column:
    return F.concat(_render_name(view, render_pass), F.lit(".png"))


def render_column(view: ColumnOrName, render_pass: ColumnOrName) -> Column:
    return F.concat(F.lit("render_"), _render_name(view, render_pass))


def _render_name(view: ColumnOrName, render_pass: ColumnOrName) -> Column:
    return F.when(_c(render_pass) == "shaded", _c(view)).otherwise(F.concat_ws("_", _c(view), _c(render_pass)))


def setting_name(text: ColumnOrName) -> Column:
    return F.trim(F.substring_index(_c(text), "=", 1))


def setting_value(text: ColumnOrName) -> Column:
    """The value of NAME=VALUE as JSON text: JSON as it stands, anything else as a JSON string."""
    raw = F.substring(_c(text), F.instr(_c(text), "=") + 1, F.length(_c(text)))
    quoted = F.to_json(F.array(raw))
    return F.coalesce(F.to_json(F.try_parse_json(raw)), F.substring(quoted, F.lit(2), F.length(quoted) - 2))


def relative_path(path: ColumnOrName, root: ColumnOrName) -> Column:
    """path below root, as it stands if it lies elsewhere."""
    base = F.concat(F.regexp_replace(_c(root), "/+$", ""), F.lit("/"))
    return F.when(F.startswith(_c(path), base), F.substring(_c(path), F.length(base) + 1, F.length(_c(path)))).otherwise(_c(path))
