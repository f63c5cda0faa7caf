"""Chunked, resumable runs: micro-batches into a keyed store, each written whole before the next begins."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.store import upsert


def _versions(spark: SparkSession, store: str) -> list[int]:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(store)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(hadoop)]
    done = [n for n in names if n.startswith("v") and fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{store}/{n}/_SUCCESS"))]
    return sorted(int(n[1:]) for n in done)


def read_store(spark: SparkSession, store: str) -> DataFrame | None:
    """The last state that was written whole; None before the first."""
    v = _versions(spark, store)
    return spark.read.parquet(f"{store}/v{v[-1]}") if v else None


def _path(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_batch(store: str, keys: list[str], version: str, stream: str = "", keep: int = 2):
    """A ``foreachBatch`` function that merges each batch into the store.

    A batch is known by its stream and number: one repeated after a crash changes nothing, and the first batch of
    another stream into the same store is no repetition. The last ``keep`` versions stay for readers.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark, fs = _path(spark, f"{store}/_batches/{hashlib.sha1(stream.encode()).hexdigest()[:16]}-{batch_id}")
        if fs.exists(mark):
            return
        known = _versions(spark, store)
        old = read_store(spark, store)
        merged = upsert(batch.limit(0) if old is None else old, batch, keys, version)
        merged.write.mode("overwrite").parquet(f"{store}/v{known[-1] + 1 if known else 1}")
        fs.create(mark, True).close()
        for n in known[: max(0, len(known) + 1 - keep)]:
            fs.delete(_path(spark, f"{store}/v{n}")[0], True)

    return write


def run_available(stream: DataFrame, store: str, checkpoint: str, keys: list[str], version: str) -> None:
    """Consume what the stream has now and stop."""
    q = stream.writeStream.foreachBatch(write_batch(store, keys, version, checkpoint)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def windowed_counts(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Events by type and window of event time, with a watermark; works on streams and tables alike."""
    w = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return w.select(F.col("window.start").alias("start"), "event_type", "n", "total")
