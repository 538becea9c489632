"""Garbage collection, range deletion, safe points and range tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.mvcc import in_range


def collect_garbage(versions: DataFrame, safe_point: int) -> DataFrame:
    """Records that must stay for reads at or after the safe point.

    Of the records up to it only the newest data record of a key stays, and only if it is a put;
    everything after it stays.  One aggregate finds the survivor, so no window sorts a key's history.
    """
    old = versions.where((F.col("commit_ts") <= safe_point) & F.col("op").isin("put", "del"))
    newest = old.groupBy("key").agg(F.max_by(F.struct(*versions.columns), F.struct("commit_ts", "start_ts")).alias("v"))
    kept = newest.where("v.op = 'put'").select("v.*").select(*versions.columns)
    return versions.where(F.col("commit_ts") > safe_point).unionByName(kept)


def check_no_old_locks(locks: DataFrame, safe_point: int) -> None:
    """Locks up to the safe point must be resolved first."""
    if not locks.where(F.col("start_ts") <= safe_point).isEmpty():
        raise ValueError(f"locks up to {safe_point} are not resolved")


def garbage_counts(versions: DataFrame, safe_point: int) -> DataFrame:
    """(op, kept, removed)."""
    kept = collect_garbage(versions, safe_point).groupBy("op").agg(F.count("*").alias("kept"))
    every = versions.groupBy("op").agg(F.count("*").alias("n"))
    return every.join(kept, "op", "left").select("op", F.coalesce("kept", F.lit(0)).alias("kept"), (F.col("n") - F.coalesce("kept", F.lit(0))).alias("removed"))


def delete_range(table: DataFrame, lo: bytes | None = None, hi: bytes | None = None) -> DataFrame:
    """Without all rows of ``[lo, hi)``; works on versions, locks and raw tables."""
    if lo and hi and lo >= hi:
        return table
    return table.where(~in_range(F.col("key"), lo, hi))


def range_tasks(regions: DataFrame, ranges: DataFrame) -> DataFrame:
    """(lo, hi): each asked range cut at region borders; empty hi is open."""
    from strata.operators.regions import OPEN, end, overlapping

    met = overlapping(ranges, regions)
    cut = met.select(F.greatest("a", "lo").alias("lo"), F.least(end(F.col("b")), end(F.col("hi"))).alias("hi")).where("lo < hi")
    return cut.select("lo", F.when(F.col("hi") == F.lit(OPEN), F.lit(b"")).otherwise(F.col("hi")).alias("hi"))


def run_on_ranges(table: DataFrame, handler, schema, partitions: int) -> DataFrame:
    """Run ``handler`` (an Arrow batch iterator function) once per contiguous key range of ``table``."""
    return table.repartitionByRange(partitions, "key").sortWithinPartitions("key").mapInArrow(handler, schema)


def min_safe_ts(stores: DataFrame) -> DataFrame:
    """(scope, safe_ts): smallest of the stores' safe timestamps.

    ``stores``: store_id, scope, safe_ts.  A store that has reported 0 does not count; one that is missing (null) makes
    the result 0, as do only zeros.
    """
    least = F.min(F.when(F.col("safe_ts") != 0, F.col("safe_ts")))
    return stores.groupBy("scope").agg(F.when(F.bool_or(F.col("safe_ts").isNull()), 0).otherwise(F.coalesce(least, F.lit(0))).cast("long").alias("safe_ts"))


def advance_safe_ts(before: DataFrame, now: DataFrame) -> DataFrame:
    """Per store the larger of both: a safe timestamp never goes back."""
    return before.unionByName(now).groupBy("store_id", "scope").agg(F.max("safe_ts").alias("safe_ts"))


def resolved_before_gc(versions: DataFrame, locks: DataFrame, status: DataFrame, safe_point: int) -> tuple[DataFrame, DataFrame]:
    """Resolve every lock up to the safe point by its transaction's outcome, then collect garbage."""
    from strata.operators.transactions import resolve_locks

    old = locks.where(F.col("start_ts") <= safe_point).select("start_ts").distinct()
    versions, locks = resolve_locks(versions, locks, status.join(old, "start_ts", "left_semi"))
    check_no_old_locks(locks, safe_point)
    return collect_garbage(versions, safe_point), locks


def load_safe_point(meta: DataFrame, name: str = "gc_safe_point") -> int:
    row = meta.where(F.col("name") == name).agg(F.max("ts").alias("ts")).first()
    return row["ts"] or 0


def save_safe_point(meta: DataFrame, ts: int, name: str = "gc_safe_point") -> DataFrame:
    """``meta`` (name, ts) with the safe point; it never goes back."""
    new = meta.sparkSession.createDataFrame([(name, ts)], "name string, ts long")
    return meta.unionByName(new).groupBy("name").agg(F.max("ts").alias("ts"))


def region_properties(versions: DataFrame, regions: DataFrame) -> DataFrame:
    """(region_id, records, puts, deletes, keys, bytes, newest) of every region with records; keys are counted by their newest record."""
    from strata.operators.regions import locate_keys

    size = F.octet_length("key") + F.coalesce(F.octet_length("value"), F.lit(0))
    per_key = versions.groupBy("key").agg(
        F.count("*").alias("records"), F.count_if(F.col("op") == "put").alias("puts"), F.count_if(F.col("op") == "del").alias("deletes"), F.sum(size).alias("bytes"), F.max("commit_ts").alias("newest"),
    )
    found = locate_keys(per_key, regions).where("region_id IS NOT NULL")
    return found.groupBy("region_id").agg(*[F.sum(c).alias(c) for c in ("records", "puts", "deletes", "bytes")], F.count("*").alias("keys"), F.max("newest").alias("newest"))


def touched_regions(regions: DataFrame, lo: bytes, hi: bytes) -> int:
    """How many regions a range task over ``[lo, hi)`` visits."""
    ranges = regions.sparkSession.createDataFrame([(bytearray(lo), bytearray(hi))], "lo binary, hi binary")
    return range_tasks(regions, ranges).count()


def least_of_groups(groups: DataFrame) -> DataFrame:
    """(ts): smallest timestamp over all keyspace groups that have one."""
    return groups.agg(F.min("ts").alias("ts"))
