import ast
import random
from fractions import Fraction

import pytest

from gneiss.llm import neardup as nd

PARAMS = 'PARAMS = {\n    "w": {"type": "float", "default": 40, "min": 1.0, "label": "Width (mm)"},\n    "on": {"type": "bool", "default": True},\n}'
BUILD = 'def build(p):\n    result = cq.Workplane("XY").box(p["w"], 2, 3)\n    result = result.faces(">Z").hole(1.5)\n    return result'


def test_spelling_does_not_matter():
    other = "PARAMS={  # note\r\n\t'on' : {'default' : True, 'type' : 'bool'},\r\n 'w':{\"min\":1,'default':40.00,'type':'float','label':'Width (mm)'} }"
    build = "def build(p):\r\n\tresult = result.faces('>Z').hole(1.5)   \r\n\tresult=cq.Workplane('XY').box(p['w'],2,3)  # before\r\n\treturn result"
    assert nd.source_elements(PARAMS, BUILD) == nd.source_elements(other, build) and len(nd.source_elements(PARAMS, BUILD)) == 4
    assert nd.source_elements(PARAMS.replace("40", "41"), BUILD) != nd.source_elements(PARAMS, BUILD)
    assert nd.source_elements(PARAMS.replace("True", "1"), BUILD) != nd.source_elements(PARAMS, BUILD)


@pytest.mark.parametrize(
    "text,value",
    [
        ("PARAMS = {'a': {'label': \"it's\", 'default': 1}}", {"a": {"label": "it's", "default": 1.0}}),
        ("PARAMS = {'a': {'label': 'say \"x\"'}}", {"a": {"label": 'say "x"'}}),
        ("PARAMS = {'a': {'label': 'True # no comment'}} # yes", {"a": {"label": "True # no comment"}}),
        (r"PARAMS = {'a': {'label': 'tab\t'}}", {"a": {"label": "tab\t"}}),
        ("PARAMS = {'a': {'choices': ['x', 'y',], 'on': None, 'off': False},}", {"a": {"choices": ["x", "y"], "on": None, "off": False}}),
        ("PARAMS = {}", {}),
        ("PARAMS = {'a': -1.5e3}", {"a": -1500.0}),
        ("PARAMS = {'a': {", None),
        ("PARAMS = {'a': 1}}", None),
        ("PARAMS = [1]", None),
        ("OTHER = {}", None),
        ("PARAMS = {'a': f()}", None),
        ("PARAMS = {'a': NaN}", None),
        ("", None),
    ],
)
def test_parameters_are_read_exactly(text, value):
    assert nd.parse_params(text) == value


def floats(x):
    return {k: {a: float(v) if type(v) is int else v for a, v in s.items()} for k, s in x.items()}


def test_parser_agrees_with_python_on_random_texts():
    rng = random.Random(1)
    for _ in range(300):
        spec = {f"k{i}": {"label": rng.choice(["a b", "x#y", "(mm)", "a; b", "{}"]), "default": rng.choice([1, 2.5, True, None, -3, 1e-7]), "n": rng.randint(0, 9)} for i in range(rng.randint(0, 5))}
        text = "PARAMS = " + repr(spec).replace(", ", rng.choice([", ", ",\n  ", " , "])).replace("{'label'", rng.choice(["{'label'", "{# c\n 'label'"]))
        assert nd.parse_params(text) == floats(ast.literal_eval(text[9:]))


@pytest.mark.parametrize("bad", [BUILD[:-6], "def build(p):", "", "x = 1\nreturn result", BUILD + "\nmore = 1"])
def test_incomplete_builds(bad):
    assert nd.build_statements(bad) is None


def test_strings_keep_their_blanks():
    assert nd.build_statements('def build(p):\n  a = f("x  y # z")  # c\n  return result') == ['a=f("x  y # z")']


def random_sets(rng, n):
    base = [frozenset(rng.sample(range(400), rng.randint(1, 18))) for _ in range(n // 4)]
    out = list(base)
    while len(out) < n:
        s = set(rng.choice(out))
        for _ in range(rng.randint(0, 3)):
            s.symmetric_difference_update({rng.randrange(400)})
        out.append(frozenset(s or {1}))
    return out


def close(x, y, t):
    return Fraction(len(x & y), len(x | y)) >= t


@pytest.mark.parametrize("seed", range(8))
def test_divide_skip_equals_brute_force(seed):
    rng = random.Random(seed)
    t = rng.choice([Fraction(7, 10), Fraction(1, 2), Fraction(9, 10)])
    sets = random_sets(rng, 80) + [frozenset(range(40)) | {500 + i} for i in range(30)]
    got = [tuple(sorted(p)) for p in nd.divide_skip([(len(s), sorted(s)) for s in sets], t)]
    assert sorted(got) == [(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if close(sets[i], sets[j], t)]


@pytest.mark.parametrize("block", [2, 7, 1000])
def test_similar_classes_equal_brute_force(spark, block):
    rng = random.Random(11)
    sets = sorted(set(random_sets(rng, 150)) | {frozenset([*range(12), 600 + i]) for i in range(40)}, key=sorted)
    df = spark.createDataFrame([(bytes([i // 250, i % 250]), [int(e) for e in sorted(s)]) for i, s in enumerate(sets)], "cls binary, els array<bigint>").repartition(5)
    got = [(tuple(r.a), tuple(r.b)) for r in nd.similar_classes(df, 0.7, block).collect()]
    key = lambda i: (i // 250, i % 250)
    want = {(key(i), key(j)) for i in range(len(sets)) for j in range(i + 1, len(sets)) if close(sets[i], sets[j], Fraction(7, 10))}
    assert set(got) == want and len(got) == len(want) and len(want) > 700


def source(elements):
    params = "PARAMS = {" + ", ".join(f'"k{e}": {{"default": {e}}}' for e in sorted(elements) if e % 2) + "}"
    return params, "def build(p):\n" + "".join(f"  step({e})\n" for e in sorted(elements) if not e % 2) + "  return result"


def test_pairs_of_records(spark):
    rng = random.Random(12)
    sets = {f"r{i:03d}": s for i, s in enumerate(random_sets(rng, 60))}
    rows = [(k, *source(s), "clash", 1) for k, s in sets.items()] + [("copy", *source(sets["r003"]), "x", 1), ("r005", *source(sets["r005"]), "again", 1)]
    rows += [(None, *rows[0][1:3], "x", 1), ("nul", None, rows[0][2], "x", 1), ("nul2", rows[0][1], None, "x", 1), ("cut", rows[0][1][:-3], rows[0][2], "x", 1), ("empty", "PARAMS = {}", "def build(p):\n return result", "x", 1)]
    sets["copy"] = sets["r003"]
    df = spark.createDataFrame(rows, "part_id string, params string, build string, id string, cls int").repartition(3)
    members, links = nd.near_duplicates(df)
    got = [tuple(r) for r in nd.duplicate_pairs(members, links).collect()]
    want = {(a, b) for a in sets for b in sets if a < b and close(sets[a], sets[b], Fraction(7, 10))}
    assert set(got) == want and len(got) == len(want)
    groups = {r.id: r for r in nd.duplicate_groups(members, links).collect()}
    assert set(groups) == set(sets) and groups["copy"].cls == groups["r003"].cls
    assert groups["r003"].links == len({groups[b if a == "r003" else a].cls for a, b in want if "r003" in (a, b)} - {groups["r003"].cls})


def test_no_records_and_a_very_long_one(spark):
    schema = "part_id string, params string, build string"
    members, links = nd.near_duplicates(spark.createDataFrame([], schema))
    assert nd.duplicate_pairs(members, links).count() == 0 and nd.duplicate_groups(members, links).count() == 0
    big = set(range(3_000))
    rows = [("a", *source(big)), ("b", *source(big - {1, 2, 3})), ("c", *source({5}))]
    assert [tuple(r) for r in nd.duplicate_pairs(*nd.near_duplicates(spark.createDataFrame(rows, schema))).collect()] == [("a", "b")]


def test_large_linked_classes_are_cut_into_blocks(spark):
    rng = random.Random(21)
    size = {b"a": 23, b"b": 17, b"c": 2, b"d": 1, b"e": 3}
    members = [(f"{c.decode()}{i}", c) for c, n in size.items() for i in range(n)]
    links = [(b"a", b"b"), (b"b", b"c"), (b"c", b"d"), (b"d", b"e")]
    want = {tuple(sorted((x, y))) for x, cx in members for y, cy in members if x != y and (cx == cy or (cx, cy) in links)}
    rng.shuffle(members)
    m, k = spark.createDataFrame(members, "id string, cls binary"), spark.createDataFrame(links, "a binary, b binary")
    for block in (5, 20, 2000):
        got = [(r.a, r.b) for r in nd.duplicate_pairs(m.repartition(3), k, block).collect()]
        assert set(got) == want and len(got) == len(want)
