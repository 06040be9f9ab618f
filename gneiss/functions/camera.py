"""Camera matrices of named views, for tables of meshes: numpy over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Elevation and azimuth of the views, in degrees.
ANGLES = {"front": (0, -90), "top": (90, -90), "right": (0, 0), "iso": (28, -55), "iso_fr": (30, -45), "iso_fl": (30, -135), "iso_br": (30, 45), "iso_bl": (30, 135)}


def view_direction(elevation: float, azimuth: float) -> np.ndarray:
    """Unit vector from the target to the eye."""
    e, a = np.radians([elevation, azimuth])
    return np.array([np.cos(e) * np.cos(a), np.cos(e) * np.sin(a), np.sin(e)])


def look_from(direction: np.ndarray, centre: np.ndarray, distance: float) -> np.ndarray:
    """4 x 4 world-to-camera matrix: the rows of its rotation are the camera's right, up and backward axes."""
    upward = np.eye(3)[2] if abs(direction[2]) < 0.99 else np.eye(3)[1]
    right = np.cross(upward, direction)
    right /= np.linalg.norm(right) or 1.0
    axes = np.stack([right, np.cross(direction, right), direction])
    out = np.eye(4)
    out[:3, :3] = axes
    out[:3, 3] = -axes @ (centre + direction * distance)
    return out


def orthographic(half: float, near: float, far: float) -> np.ndarray:
    depth = far - near
    out = np.diag([1 / half, 1 / half, -2 / depth, 1.0])
    out[2, 3] = -(far + near) / depth
    return out


def cameras(bounds: DataFrame, views: list[str], distance: float = 3.0) -> DataFrame:
    """(part_id, view, view_matrix, projection), matrices row by row, for each mesh of bounds (see operators.corpus.mesh_bounds); distance in radii."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                centre, radius = np.array([r["centre_x"], r["centre_y"], r["centre_z"]]), r["radius"] or 1.0
                for v in views:
                    m = look_from(view_direction(*ANGLES[v]), centre, distance * radius)
                    rows.append({"part_id": r["part_id"], "view": v, "view_matrix": m.ravel().tolist(), "projection": orthographic(radius, (distance - 1.5) * radius, (distance + 1.5) * radius).ravel().tolist()})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("part_id", pa.string()), ("view", pa.string()), ("view_matrix", pa.list_(pa.float64())), ("projection", pa.list_(pa.float64()))]))

    columns = ["part_id", "centre_x", "centre_y", "centre_z", "radius"]
    return bounds.select(*columns).mapInArrow(run, "part_id string, view string, view_matrix array<double>, projection array<double>")
