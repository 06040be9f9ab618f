"""Standard sizes of gears and threads, and the look-ups over them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Standard tables, in millimetres. The ACME standard states threads per inch, from which a pitch is worked out in full (25.4 / 14, not 1.81429).
GEAR_MODULES = [1.0, 1.25, 1.5, 2.0, 2.5, 3.0, 4.0, 5.0, 6.0, 8.0]
STOCK_THICKNESSES = [2.0, 3.0, 4.0, 5.0, 6.0, 8.0, 10.0, 12.0, 16.0, 20.0]
CLEARANCES = [3.2, 4.3, 5.3, 6.4, 8.4, 10.5, 13.0]
METRIC_PITCHES = {
    3.0: [0.5, 0.35], 4.0: [0.7, 0.5], 5.0: [0.8, 0.5], 6.0: [1.0, 0.75], 8.0: [1.25, 1.0, 0.75], 10.0: [1.5, 1.25, 1.0], 12.0: [1.75, 1.5, 1.25],
    16.0: [2.0, 1.5], 20.0: [2.5, 1.5], 24.0: [3.0, 2.0], 30.0: [3.5, 2.0], 36.0: [4.0, 3.0],
}
ACME_THREADS_PER_INCH = {"1/4": 16, "5/16": 14, "3/8": 12, "1/2": 10, "5/8": 8, "3/4": 6, "7/8": 6, "1": 5, "1 1/4": 5, "1 1/2": 4}
TRAPEZOIDAL_SIZES = ["8x1.5", "10x2", "12x3", "14x3", "16x4", "18x4", "20x4", "24x5", "28x5", "30x6", "36x6", "40x7"]


def metric_pitches(diameter: Column) -> Column:
    """Pitches of a metric thread, the coarse one first; null for a diameter that is not standard."""
    table = F.create_map(*(x for d, p in METRIC_PITCHES.items() for x in (F.lit(d), F.array(*map(F.lit, p)))))
    return F.try_element_at(table, diameter.cast("double"))


def acme_pitch(size: Column) -> Column:
    """Pitch in millimetres of an ACME size; null for an unknown one."""
    table = F.create_map(*(F.lit(x) for pair in ACME_THREADS_PER_INCH.items() for x in pair))
    return F.lit(25.4) / F.try_element_at(table, size)


def trapezoidal_pitch(size: Column) -> Column:
    """Pitch of a metric trapezoidal size, which names it; null for an unknown one."""
    return F.when(size.isin(TRAPEZOIDAL_SIZES), F.substring_index(size, "x", -1).cast("double"))
