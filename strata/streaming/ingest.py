"""Streaming ingest: commits arrive as a stream, late ones are dropped by the watermark, the log grows by batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import tso
from strata.sources.tables import SCHEMAS


def append_versions(stream: DataFrame, path: str, checkpoint: str, *, once: bool = False):
    """Write a stream of version rows to the log at ``path``; each batch is one atomic append."""
    columns = [c.split()[0] for c in SCHEMAS["versions"].split(", ")]
    writer = stream.select(*columns).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()


def commits_per_window(stream: DataFrame, *, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(window, puts, deletes, newest): commits by the time of their timestamp; later than the watermark are dropped."""
    timed = stream.withColumn("at", tso.to_time(F.col("commit_ts"))).withWatermark("at", late)
    count = lambda op: F.sum(F.when(F.col("op") == op, 1).otherwise(0))
    return timed.groupBy(F.window("at", window).alias("window")).agg(count("put").alias("puts"), count("del").alias("deletes"), F.max("commit_ts").alias("newest"))


def safe_ts_updates(stream: DataFrame) -> DataFrame:
    """(scope, store_id, safe_ts) from progress reports, largest so far; complete mode, one row a store."""
    return stream.groupBy("scope", "store_id").agg(F.max("safe_ts").alias("safe_ts"))
