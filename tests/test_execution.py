import time

from pyspark.sql import functions as F

from gneiss.functions.standards import acme_pitch, metric_pitches, trapezoidal_pitch
from gneiss.operators.execution import execute_with
from gneiss.operators.validity import with_validity
from gneiss.plans.pipeline import generate


def kernel(row):
    i = row["attempt"]
    if i % 5 == 0:
        raise ValueError("no solid")
    if i == 7:
        time.sleep(30)
    v = 1000.0 * (i % 11 + 1)
    return {"volume": v, "surface_area": v / 2, "bbox": [0.0, 0.0, 0.0, 2.0, 3.0, 4.0], "principal_moments": [v], "n_faces": 6, "n_edges": 12, "n_vertices": 8, "n_solids": 1}


def test_failures_and_delays_stay_in_their_row(spark):
    df = spark.range(20).withColumnRenamed("id", "attempt").repartition(3)
    got = {r.attempt: r for r in with_validity(execute_with(kernel, 0.5)(df)).collect()}
    assert len(got) == 20 and [i for i, r in got.items() if not r.success and r.error.startswith("ValueError: no solid")] == [i for i in got if i % 5 == 0]
    assert got[7].error.startswith("timeout") and got[3].valid and "no solid" in got[5].traceback


def test_generating_with_a_kernel(spark):
    quick = execute_with(lambda row: kernel({"attempt": row["attempt"] * 10 + 1}))
    got = generate(spark, quick, 1, 5, window=10)
    assert [r.attempt for r in got.records.orderBy("attempt").collect()] == [0, 1, 2, 3, 4] and got.attempted == 5


def test_standards(spark):
    r = spark.range(1).select(metric_pitches(F.lit(8)).alias("m"), metric_pitches(F.lit(7)).alias("n"), acme_pitch(F.lit("1/2")).alias("a"), acme_pitch(F.lit("9")).alias("b"), trapezoidal_pitch(F.lit("8x1.5")).alias("t")).first()
    assert r.m == [1.25, 1.0, 0.75] and r.n is None and abs(r.a - 2.54) < 1e-12 and r.b is None and r.t == 1.5
