"""Sessions, and the shared folder in which lineage is cut."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def get_spark(app: str = "gneiss", master: str = "local[*]", **conf: object) -> SparkSession:
    """A session with the settings the operators assume; on a cluster pass its master, or set these in spark-defaults."""
    builder = SparkSession.builder.master(master).appName(app)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(os.cpu_count() or 8),
    } | {k: str(v) for k, v in conf.items()}
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def setting(spark: SparkSession, key: str) -> str | None:
    """A setting of the session or, failing that, of its context."""
    return spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)


def scratch_dir(spark: SparkSession) -> str:
    """The folder, visible to every executor, for written intermediate tables: spark.checkpoint.dir.

    Where that is unset a local master gets a temporary folder, removed at exit; a cluster gets an error, since a
    folder of one machine would be lost with it.
    """
    base = setting(spark, "spark.checkpoint.dir")
    app = spark.sparkContext.applicationId
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if app not in _OWN:
            _OWN[app] = tempfile.mkdtemp(prefix="gneiss-")
            atexit.register(shutil.rmtree, _OWN[app], ignore_errors=True)
        base = f"file://{_OWN[app]}"
    return f"{base.rstrip('/')}/gneiss-{app}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the scratch folder: its lineage is cut, it is computed once, and it outlives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Removes a folder through Hadoop's file system layer, whatever its scheme."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Deletes what this application wrote to the scratch folder; results read from there must have been used before."""
    delete_path(spark, scratch_dir(spark))
