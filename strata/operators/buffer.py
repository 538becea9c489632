"""A write buffer over a snapshot: own writes first, stages that can be released or discarded.

``buffer``: key, value (null: flags only; empty: delete), flags, stage, op_seq[, generation].
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import flags as fl
from strata.operators.mvcc import in_range

#: Limits of one entry, of the whole buffer and of a key, in bytes.
MOST_ENTRY, MOST_TOTAL, MOST_KEY = 6 << 20, 100 << 20, 65_535
#: A pipelined buffer is flushed at this many keys and bytes.
FLUSH_KEYS, FLUSH_BYTES, FORCE_BYTES = 10_000, 16 << 20, 128 << 20


def newest(buffer: DataFrame) -> DataFrame:
    """(key, value, flags, has_value): the last write of each key and its last flags; later generations win."""
    order = F.struct("generation", "op_seq") if "generation" in buffer.columns else F.struct("op_seq")
    valued = F.when(F.col("value").isNotNull(), order)
    return buffer.groupBy("key").agg(
        F.max_by("value", valued).alias("value"), F.max_by("flags", order).alias("flags"), F.bool_or(F.col("value").isNotNull()).alias("has_value"),
    )


def union_read(buffer: DataFrame, snapshot: DataFrame, lo: bytes | None = None, hi: bytes | None = None) -> DataFrame:
    """(key, value, commit_ts) of own writes merged over the snapshot; own deletes hide keys, own values have commit_ts 0."""
    own = newest(buffer.where(in_range(F.col("key"), lo, hi))).where("has_value")
    below = snapshot.where(in_range(F.col("key"), lo, hi)).join(own.select("key"), "key", "left_anti")
    return below.select("key", "value", "commit_ts").unionByName(own.where(F.octet_length("value") > 0).select("key", "value", F.lit(0).cast("long").alias("commit_ts")))


def union_scan(buffer: DataFrame, snapshot: DataFrame, lo: bytes | None = None, hi: bytes | None = None, *, reverse: bool = False, limit: int | None = None) -> DataFrame:
    rows = union_read(buffer, snapshot, lo, hi).orderBy(F.desc("key") if reverse else F.col("key"))
    return rows if limit is None else rows.limit(limit)


def union_batch_get(buffer: DataFrame, snapshot: DataFrame, keys: DataFrame) -> DataFrame:
    """As ``union_read`` for some keys; those absent or deleted have no row."""
    wanted = keys.select("key").distinct()
    return union_read(buffer.join(wanted, "key", "left_semi"), snapshot.join(wanted, "key", "left_semi"))


def tiered_get(buffer: DataFrame, keys: DataFrame) -> DataFrame:
    """Own flushed writes only; an empty value is a delete and stays visible."""
    return newest(buffer).where("has_value").join(keys.select("key").distinct(), "key", "left_semi").select("key", "value")


def release(buffer: DataFrame, stage: int) -> DataFrame:
    """Merge the top stage into the one below."""
    return buffer.withColumn("stage", F.when(F.col("stage") >= stage, stage - 1).otherwise(F.col("stage")))


def discard(buffer: DataFrame, stage: int) -> DataFrame:
    """Drop the top stage; persistent flags set in it stay, without values, in the stage below."""
    kept = buffer.where(F.col("stage") < stage)
    flags = buffer.where((F.col("stage") >= stage) & (fl.persistent(F.col("flags")) != 0)).withColumns({"value": F.lit(None).cast("binary"), "flags": fl.persistent(F.col("flags")), "stage": F.lit(stage - 1)})
    return kept.unionByName(flags.select(*kept.columns))


def revert_to(buffer: DataFrame, checkpoint: int) -> DataFrame:
    return buffer.where(F.col("op_seq") <= checkpoint)


def inspect_stage(buffer: DataFrame, stage: int) -> DataFrame:
    return newest(buffer.where(F.col("stage") >= stage))


def stage_zero(buffer: DataFrame, lo: bytes | None = None, hi: bytes | None = None, *, reverse: bool = False) -> DataFrame:
    """What was there before any stage, in order."""
    rows = newest(buffer.where((F.col("stage") == 0) & in_range(F.col("key"), lo, hi))).where("has_value")
    return rows.select("key", "value").orderBy(F.desc("key") if reverse else F.col("key"))


def value_history(buffer: DataFrame, predicate) -> DataFrame:
    """(key, value): the newest value of each key for which ``predicate`` (a Column function) holds."""
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("op_seq")))
    return buffer.where(F.col("value").isNotNull() & predicate(F.col("value"))).withColumn("r", rank).where("r = 1").select("key", "value")


def sizes(buffer: DataFrame) -> DataFrame:
    """One row: entries, bytes and the largest entry and key, for the limits above."""
    rows = newest(buffer)
    size = F.octet_length("key") + F.coalesce(F.octet_length("value"), F.lit(0))
    return rows.agg(F.count("*").alias("entries"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"), F.max(size).alias("largest_entry"), F.max(F.octet_length("key")).alias("largest_key"))


def check_limits(buffer: DataFrame, *, entry: int = MOST_ENTRY, total: int = MOST_TOTAL) -> None:
    found = sizes(buffer).first()
    if (found["largest_key"] or 0) > MOST_KEY:
        raise ValueError("key too large")
    if (found["largest_entry"] or 0) > entry:
        raise ValueError("entry too large")
    if found["bytes"] > total:
        raise ValueError("transaction too large")


def presumes_not_exists(buffer: DataFrame) -> DataFrame:
    return newest(buffer).where(fl.has(F.col("flags"), "presume_not_exists")).select("key")


def remove(buffer: DataFrame, keys: DataFrame) -> DataFrame:
    """Without any write of these keys, as if they had never been buffered."""
    return buffer.join(keys.select("key").distinct(), "key", "left_anti")


def dirty(buffer: DataFrame) -> bool:
    """Has anything been written?"""
    return not buffer.isEmpty()


def should_flush(keys: int, bytes_: int) -> bool:
    return keys >= FLUSH_KEYS and bytes_ >= FLUSH_BYTES or bytes_ >= FORCE_BYTES
