"""Parameters out of emitted source text, read as a literal and never run."""

from __future__ import annotations

import ast
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARAM_TYPE = "part_id string, pos int, name string, type string, default string, min double, max double, step double, choices array<string>, grp string, label string"


_STRING = re.compile(r'"[^"\n]*"|\'[^\'\n]*\'')
_COMMENT = re.compile(r'("[^"\n]*"|\'[^\'\n]*\')|#[^\n]*')
_TRAILING = re.compile(r",(\s*[}\]])")
_WORDS = re.compile(r"\b(?:True|False|None)\b")
_JSON_WORDS = {"True": "true", "False": "false", "None": "null"}
_ASSIGN = re.compile(r"(?:^|\n)\s*PARAMS\s*=\s*")


def _refuse(name: str) -> None:
    raise ValueError(name)


def params_literal(text: str | None, whole: bool = False, numbers: type = int) -> dict | None:
    """The dict assigned to PARAMS in a source; None if there is none or it is not complete.

    With whole, nothing but comments may stand before or after the literal. numbers=float reads whole numbers as floats. Usual texts are turned into JSON
    and decoded natively; any with escapes, or quotes inside quotes, is read as a Python literal. Nothing is run.
    """
    head = (_ASSIGN.match if whole else _ASSIGN.search)(text) if text else None
    if not head:
        return None
    body = text[head.end() :]
    strings = _STRING.findall(body)
    if "\\" not in body and body.count("'") + body.count('"') == 2 * len(strings) and not _WORDS.search(" ".join(strings)):
        plain = _COMMENT.sub(r"\1", body) if "#" in body else body
        plain = _TRAILING.sub(r"\1", _WORDS.sub(lambda m: _JSON_WORDS[m[0]], plain.replace("'", '"')))
        try:
            value, end = json.JSONDecoder(parse_int=numbers, parse_constant=_refuse).raw_decode(plain)
            if isinstance(value, dict) and (not whole or not plain[end:].strip()):
                return value
        except (ValueError, RecursionError):
            pass
    try:
        tree = ast.parse("PARAMS = " + body.replace("\r\n", "\n").strip())
        value = ast.literal_eval(tree.body[0].value)
    except (ValueError, SyntaxError, TypeError, RecursionError, MemoryError):
        return None
    if not isinstance(value, dict) or whole and len(tree.body) != 1:
        return None
    return _floats(value) if numbers is float else value


def _floats(x: object) -> object:
    if isinstance(x, dict):
        return {k: _floats(v) for k, v in x.items()}
    if isinstance(x, (list, tuple)):
        return [_floats(v) for v in x]
    return float(x) if isinstance(x, int) and not isinstance(x, bool) else x


def explode_params(sources: DataFrame, text: str = "params", key: str = "part_id") -> DataFrame:
    """One row per parameter: position, name and spec (the default as JSON text). Texts that are null or not complete have none."""

    def number(x: object) -> float | None:
        return float(x) if isinstance(x, (int, float)) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part_id", pa.string()), ("pos", pa.int32()), ("name", pa.string()), ("type", pa.string()), ("default", pa.string()), ("min", pa.float64()), ("max", pa.float64()), ("step", pa.float64()), ("choices", pa.list_(pa.string())), ("grp", pa.string()), ("label", pa.string())])
        for batch in batches:
            rows = []
            for i, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for pos, (name, spec) in enumerate((params_literal(source) or {}).items()):
                    if isinstance(spec, dict):
                        choices = spec.get("choices")
                        rows.append({"part_id": i, "pos": pos, "name": str(name), "type": spec.get("type"), "default": json.dumps(spec.get("default")), "min": number(spec.get("min")), "max": number(spec.get("max")), "step": number(spec.get("step")), "choices": [str(c) for c in choices] if isinstance(choices, (list, tuple)) else None, "grp": spec.get("group"), "label": spec.get("label")})
            yield pa.RecordBatch.from_pylist(rows, schema)

    return sources.select(F.col(key).cast("string"), F.col(text)).mapInArrow(run, PARAM_TYPE)


def default_params(params: DataFrame) -> DataFrame:
    """(part_id, params): each part's numeric defaults by name; true and false count as 1 and 0."""
    value = F.when(F.col("default") == "true", 1.0).when(F.col("default") == "false", 0.0).otherwise(F.col("default").try_cast("double"))
    entries = F.array_sort(F.collect_list(F.struct("pos", "name", value.alias("v"))))
    return params.groupBy("part_id").agg(F.map_from_entries(F.transform(entries, lambda x: F.struct(x["name"], x["v"]))).alias("params"))


def sweepable(params: DataFrame) -> DataFrame:
    """Numeric parameters that have both bounds."""
    return params.where(F.col("type").isin("float", "int") & F.col("min").isNotNull() & F.col("max").isNotNull())
