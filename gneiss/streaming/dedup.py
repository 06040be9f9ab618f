"""First-wins removal of duplicates over a stream: ordered ranges, a table of what has been accepted, and one micro-batch per range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.operators.dedup import accepted_firsts


class FirstWinsSink:
    """foreachBatch function: accepts the first of each key that no earlier batch accepted, and appends it to a table.

    Each batch writes its own folder, named by its number, and reads those of earlier batches only: a batch that is run again
    after a failure sees the same state and overwrites its own output, so each row is accepted once. Batches must be in order of the rows.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[Column], order: list[str]):
        self.spark, self.path, self.key, self.order = spark, path.rstrip("/"), key, order

    def accepted(self, schema, before: int | None = None) -> DataFrame:
        """What batches (before a number) accepted."""
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [x.getPath().getName() for x in fs.listStatus(root)] if fs.exists(root) else []
        numbers = sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))
        folders = [f"{self.path}/batch={n}" for n in numbers if before is None or n < before]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def __call__(self, batch: DataFrame, number: int) -> None:
        firsts = accepted_firsts(batch, self.key, self.order)
        names = [f"_k{i}" for i in range(len(self.key))]
        mark = lambda df: df.select("*", *(k.alias(n) for k, n in zip(self.key, names)))
        old = mark(self.accepted(batch.schema, number)).select(*names).distinct()
        fresh = mark(firsts).join(old, names, "left_anti").select(*batch.columns)
        fresh.write.mode("overwrite").parquet(f"{self.path}/batch={number}")


def dedup_stream(spark: SparkSession, source: str, schema, key: list[Column], order: list[str], path: str, checkpoint: str) -> DataFrame:
    """Runs a folder of Parquet files, each an ordered range in order of arrival, through the sink to its end; returns what was accepted."""
    sink = FirstWinsSink(spark, path, key, order)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sink.accepted(schema)


def windowed_counts(events: DataFrame, time: str = "ts", late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Counts by event_type and tumbling window with a watermark, over a stream or a table; a time without zone is taken as UTC."""
    at = F.to_utc_timestamp(F.col(time).cast("timestamp"), "UTC")
    rows = events.withColumn("_at", at).withWatermark("_at", late)
    return rows.groupBy(F.window("_at", width), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")
