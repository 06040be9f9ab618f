"""Equality of JSON values, whatever their spelling."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from decimal import MAX_EMAX, MIN_EMIN, Context

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

#: Values nested deeper than this are taken apart token by token instead of by the recursive decoder.
DEPTH = 200
_TOKEN = re.compile(r'[ \t\n\r]*(?:([\[\]{},:])|("(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*")|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)|(true|false|null))')
_SPACE = re.compile(r"[ \t\n\r]*")


def _no_constant(name: str) -> None:
    raise ValueError(f"{name} is not JSON")


def _number(text: str) -> float | int | list:
    """A number by its value: whole numbers and short fractions as such, others as their digits and power of ten beside a NaN, which no JSON value holds."""
    if len(text) <= 16 and "e" not in text and "E" not in text:
        x = float(text)
        return int(x) if x.is_integer() else x
    context = Context(prec=len(text) + 2, Emax=MAX_EMAX, Emin=MIN_EMIN, traps=[])
    value = context.create_decimal(text).normalize(context)
    zero = not value and not re.search("[1-9]", re.split("[eE]", text)[0])
    if zero:
        return 0
    if not value or not value.is_finite():  # an exponent that no decimal takes
        return [float("nan"), text]
    sign, digits, power = value.as_tuple()
    found = "".join(map(str, digits))
    if 0 <= power and len(found) + power <= 4000:
        return int(found + "0" * power) * (-1 if sign else 1)
    if power < 0 and len(found) <= 15 and -300 < power:
        return float(f"{'-' * sign}{found}e{power}")
    return [float("nan"), f"{'-' * sign}{found}e{power}"]


def _integer(text: str) -> int | list:
    return int(text) if len(text) <= 4000 else _number(text + "e0")


def _parsed(text: str) -> tuple[int, bytes]:
    """(depth, digest) of a JSON text by a loop over its tokens, without recursion; a ValueError if it is not valid."""
    digest = xxhash.xxh3_128_digest
    stack: list[tuple[list, dict]] = []  # open lists and objects; of an object also the key that waits for its value
    kinds: list[str] = []
    key: list[str | None] = []
    depth, at, want, result = 0, 0, "value", b""
    while True:
        m = _TOKEN.match(text, at)
        if not m:
            if want == "end" and _SPACE.match(text, at).end() == len(text):
                return depth, result
            raise ValueError("not JSON")
        at, (mark, string, number, word) = m.end(), m.groups()
        done = None
        if mark and mark in "[{" and want in ("value", "first"):
            kinds.append(mark)
            stack.append(([], {}))
            key.append(None)
            depth, want = max(depth, len(kinds)), "first" if mark == "[" else "first key"
            continue
        if mark and mark in "]}":
            if not kinds or (mark == "]") != (kinds[-1] == "[") or want not in ("more", "first" if mark == "]" else "first key"):
                raise ValueError("not JSON")
            items, pairs = stack.pop()
            done = digest(b"[" + b"".join(items)) if kinds.pop() == "[" else digest(b"{" + b"".join(digest(k.encode("utf-8", "surrogatepass")) + pairs[k] for k in sorted(pairs)))
            key.pop()
        elif mark == "," and want == "more" and kinds:
            want = "value" if kinds[-1] == "[" else "key"
            continue
        elif mark == ":" and want == "colon":
            want = "value"
            continue
        elif string is not None and want in ("key", "first key"):
            key[-1], want = json.loads(string), "colon"
            continue
        elif mark is None and want in ("value", "first"):
            value = json.loads(string or word) if number is None else _number(number) if re.search("[.eE]", number) else _integer(number)
            done = digest(json.dumps(value))
        else:
            raise ValueError("not JSON")
        if not kinds:
            result, want = done, "end"
            continue
        if kinds[-1] == "[":
            stack[-1][0].append(done)
        else:
            stack[-1][1][key[-1]] = done
        want = "more"


def json_key(data: bytes | None) -> bytes | None:
    """16 bytes that two texts share if they are the same JSON value; None if data is null or not valid JSON.

    Layout, order of keys and escapes do not matter, order in lists does; numbers compare by value, however long; of a repeated key the last
    counts. Values may be nested to any depth.
    """
    if data is None:
        return None
    try:
        text = data.decode("utf-8")
        if data.count(b"[") + data.count(b"{") > DEPTH:
            depth, found = _parsed(text)
            if depth > DEPTH:
                return found
        value = json.loads(text, parse_constant=_no_constant, parse_float=_number, parse_int=_integer)
        return xxhash.xxh3_128_digest(json.dumps(value, sort_keys=True))
    except ValueError:
        return None


def json_keys(records: DataFrame) -> DataFrame:
    """(file_id, payload binary) to (file_id, value_key binary); rows without valid JSON are left out."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [json_key(x) for x in batch.column(1).to_pylist()]
            out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["file_id", "value_key"])
            yield out.filter(out.column(1).is_valid())

    return records.select("file_id", "payload").mapInArrow(keys, "file_id long, value_key binary")
