"""Running a kernel over attempts: one call per row, whose failure or delay becomes that row's error."""

from __future__ import annotations

import signal
import time
import traceback
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

MEASURES = [("volume", pa.float64()), ("surface_area", pa.float64()), ("bbox", pa.list_(pa.float64())), ("principal_moments", pa.list_(pa.float64())), ("n_faces", pa.int32()), ("n_edges", pa.int32()), ("n_vertices", pa.int32()), ("n_solids", pa.int32())]
_SQL = {pa.float64(): "double", pa.int32(): "int", pa.list_(pa.float64()): "array<double>"}


class _Late(Exception):
    pass


def _late(*_: object) -> None:
    raise _Late


def execute_with(kernel: Callable[[dict], dict], seconds: float | None = None) -> Callable[[DataFrame], DataFrame]:
    """A function from attempts (a column `attempt` and whatever else the kernel reads) to execution results.

    The kernel gets a row as a dict and returns measures by name; names it leaves out are null. What it raises becomes `error` and
    `traceback` with success false, as does a call that takes longer than `seconds` of wall time (calls that never
    return to Python, such as a hung native library, need a process of their own). Rows that fail never end the job.
    """
    schema = "attempt bigint, success boolean, error string, traceback string, " + ", ".join(f"{n} {_SQL[t]}" for n, t in MEASURES)
    arrow = pa.schema([("attempt", pa.int64()), ("success", pa.bool_()), ("error", pa.string()), ("traceback", pa.string()), *MEASURES])

    def one(row: dict) -> dict:
        began = time.monotonic()
        try:
            if seconds:
                signal.signal(signal.SIGALRM, _late)
                signal.setitimer(signal.ITIMER_REAL, seconds)
            try:
                found = kernel(row)
            finally:
                if seconds:
                    signal.setitimer(signal.ITIMER_REAL, 0)
            return {"attempt": row["attempt"], "success": True} | {n: found.get(n) for n, _ in MEASURES}
        except _Late:
            return {"attempt": row["attempt"], "success": False, "error": f"timeout after {time.monotonic() - began:.1f} s"}
        except Exception as e:  # noqa: BLE001
            return {"attempt": row["attempt"], "success": False, "error": f"{type(e).__name__}: {e}", "traceback": traceback.format_exc()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([one(row) for row in batch.to_pylist()], arrow)

    return lambda attempts: attempts.mapInArrow(run, schema)
