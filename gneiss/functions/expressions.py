"""Scalar expressions over a part's parameters, as data: evaluated by Catalyst, or written as Python source text.

An expression is a struct (type, param, param_a, param_b, factor, limit, value) of type literal, param, scaled, min2,
clamp or half; parameters are a map from name to number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

EXPR_TYPE = "struct<type: string, param: string, param_a: string, param_b: string, factor: double, limit: double, value: double>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once, however often body uses it: the expression does not grow with each use."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), 0)


def evaluate(e: Column, params: Column) -> Column:
    """The expression's value; null if a parameter is missing or the type unknown."""
    p = lambda field: F.try_element_at(params, e[field])
    both = F.when(p("param_a").isNotNull() & p("param_b").isNotNull(), F.least(p("param_a"), p("param_b")))
    return (
        F.when(e["type"] == "literal", e["value"])
        .when(e["type"] == "param", p("param"))
        .when(e["type"] == "scaled", p("param") * e["factor"])
        .when(e["type"] == "min2", both * F.coalesce(e["factor"], F.lit(1.0)))
        .when(e["type"] == "clamp", F.when(p("param").isNotNull(), F.least(p("param"), e["limit"])))
        .when(e["type"] == "half", p("param") / 2)
    )


def python_float(x: Column) -> Column:
    """A double as Python writes it: the shortest digits, with a point from 1e-4 up to 1e16 and an exponent elsewhere.

    Of values that need more than 15 digits a few come out with one digit more than the shortest form; all read back as the same double.
    """
    size = F.abs(x)
    tries = [F.format_string(f"%.{n}e", size) for n in (14, 15, 16)]  # the JVM's own text may have needless digits
    text = F.coalesce(*(F.when(t.try_cast("double") == size, t) for t in tries), tries[-1])
    sign = F.when((x < 0) | ((x == 0) & F.startswith(x.cast("string"), F.lit("-"))), "-").otherwise("")
    number = F.when(F.isnan(x), "nan").when(size == float("inf"), "inf").otherwise(let(text, _positional))
    return F.when(x.isNotNull(), F.concat(sign, number))


def _positional(text: Column) -> Column:
    digits = F.regexp_replace(F.replace(F.substring_index(text, "e", 1), F.lit("."), F.lit("")), "0+$", "")
    power = F.coalesce(F.substring_index(text, "e", -1).try_cast("int"), F.lit(0))

    def place(parts: Column) -> Column:
        d, n = parts["digits"], parts["power"]
        rest = lambda start: F.substring(d, start, F.length(d))
        large = F.concat(F.rpad(F.substring(d, F.lit(1), n + 1), n + 1, "0"), F.lit("."), F.when(F.length(d) > n + 1, rest(n + 2)).otherwise("0"))
        small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -n - 1), d)
        exponent = F.format_string("e%+03d", n)
        scientific = F.concat(F.substring(d, 1, 1), F.when(F.length(d) > 1, F.concat(F.lit("."), rest(F.lit(2)))).otherwise(""), exponent)
        return F.when((n >= 0) & (n < 16), large).when((n < 0) & (n >= -4), small).otherwise(scientific)

    return let(F.struct(F.when(digits == "", "0").otherwise(digits).alias("digits"), power.alias("power")), place)


def source_text(e: Column) -> Column:
    """The expression as Python source over the parameters p."""
    p = lambda field: F.concat(F.lit('p["'), e[field], F.lit('"]'))
    lesser = lambda a, b: F.concat(F.lit("min("), a, F.lit(", "), b, F.lit(")"))
    pair = lesser(p("param_a"), p("param_b"))
    return (
        F.when(e["type"] == "literal", python_float(e["value"]))
        .when(e["type"] == "param", p("param"))
        .when(e["type"] == "scaled", F.concat(p("param"), F.lit(" * "), python_float(e["factor"])))
        .when(e["type"] == "min2", F.when(F.coalesce(e["factor"], F.lit(1.0)) == 1.0, pair).otherwise(F.concat(pair, F.lit(" * "), python_float(e["factor"]))))
        .when(e["type"] == "clamp", lesser(p("param"), python_float(e["limit"])))
        .when(e["type"] == "half", F.concat(p("param"), F.lit(" / 2")))
    )
