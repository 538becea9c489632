"""Snapshot reads over a log of versions and a table of locks.

``versions``: key, start_ts, commit_ts, op (put, del, rollback, lock), value.
``locks``: key, primary, start_ts, op (put, del, lock, pessimistic, shared), ttl_ms, for_update_ts, min_commit_ts, ...
A read returns key, value, commit_ts and, where locks are looked at, error.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.tso import LATEST
from strata.operators.lineage import cut

#: Isolation levels: locks block reads; locks are ignored; locks are ignored but newer versions are an error.
SI, RC, RC_CHECK_TS = "SI", "RC", "RCCheckTS"
DATA = ("put", "del")


def in_range(key: Column, lo: bytes | None = None, hi: bytes | None = None) -> Column:
    """``lo <= key < hi``; an empty or missing bound is open."""
    found = F.lit(True)
    if lo:
        found &= key >= F.lit(lo)
    if hi:
        found &= key < F.lit(hi)
    return found


def visible(versions: DataFrame, ts: int | None = None, *, key_only: bool = False) -> DataFrame:
    """Newest put or delete of each key at ``ts``; keys whose newest one is a delete are absent.

    Rollback and lock records are never seen.  The aggregate combines on the map side, so a key with
    very many versions costs one row a task in the shuffle.
    """
    ts = LATEST if ts is None else ts
    rows = versions.where((F.col("commit_ts") <= ts) & F.col("op").isin(*DATA))
    fields = ["op", "commit_ts"] + ["value"] * (not key_only)
    newest = rows.groupBy("key").agg(F.max_by(F.struct(*fields), F.struct("commit_ts", "start_ts") if "start_ts" in versions.columns else F.col("commit_ts")).alias("v"))
    out = newest.where("v.op = 'put'")
    return out.select("key", "v.commit_ts") if key_only else out.select("key", "v.value", "v.commit_ts")


def blocking_locks(locks: DataFrame, ts: int, resolved: Iterable[int] | DataFrame = (), *, own_primary: bool = True) -> DataFrame:
    """Locks that block a read at ``ts``: started by then, of an op that writes, not of a resolved transaction (ids, or a table of start_ts).

    A read of the newest state passes its own primary's lock (``own_primary``), which is then read before it.
    """
    held = locks.where((F.col("start_ts") <= ts) & ~F.col("op").isin("lock", "pessimistic", "shared"))
    if isinstance(resolved, DataFrame):
        held = held.join(resolved.select("start_ts").distinct(), "start_ts", "left_anti").select(*locks.columns)
    elif resolved := list(resolved):
        held = held.where(~F.col("start_ts").isin(resolved))
    if ts == LATEST and own_primary:
        held = held.where(F.col("key") != F.col("primary"))
    return held


class Snapshot:
    """A lazy view of the newest versions at one timestamp."""

    def __init__(self, versions: DataFrame, ts: int | None = None, *, locks: DataFrame | None = None, isolation: str = SI, resolved: Iterable[int] | DataFrame = (), gc_safe_point: int = 0):
        self.versions, self.locks, self.isolation, self.resolved = versions, locks, isolation, resolved if isinstance(resolved, DataFrame) else list(resolved)
        self.ts = LATEST if ts is None else ts
        if self.ts < gc_safe_point:
            raise ValueError(f"read at {self.ts} lies before the collected history at {gc_safe_point}")

    def at(self, ts: int | None) -> Snapshot:
        return Snapshot(self.versions, ts, locks=self.locks, isolation=self.isolation, resolved=self.resolved)

    def ignoring(self, *start_ts: int) -> Snapshot:
        """As if these transactions' locks were resolved; also how a pipelined transaction skips its own."""
        if isinstance(self.resolved, DataFrame):
            own = self.versions.sparkSession.createDataFrame([(t,) for t in start_ts], "start_ts long")
            resolved = self.resolved.select("start_ts").unionByName(own)
        else:
            resolved = [*self.resolved, *start_ts]
        return Snapshot(self.versions, self.ts, locks=self.locks, isolation=self.isolation, resolved=resolved)

    def _read(self, keep, key_only: bool = False) -> DataFrame:
        """Visible rows of the keys that ``keep`` leaves, then rows with an error for blocked keys."""
        found = visible(keep(self.versions), self.ts, key_only=key_only)
        if self.isolation == RC_CHECK_TS:
            newer = keep(self.versions).where(F.col("commit_ts") > self.ts).select("key").distinct()
            wrong = newer.select("key", F.lit("newer version").alias("error"))
        elif self.isolation == SI and self.locks is not None:
            held = blocking_locks(keep(self.locks), self.ts, self.resolved)
            wrong = held.select("key", F.concat(F.lit("locked by "), F.col("start_ts").cast("string")).alias("error"))
            if self.ts == LATEST:
                found = self._before_own_primary(found, keep, key_only)
        else:
            return found.withColumn("error", F.lit(None).cast("string"))
        right = found.join(wrong.select("key"), "key", "left_anti").withColumn("error", F.lit(None).cast("string"))
        return right.unionByName(wrong, allowMissingColumns=True)

    def _before_own_primary(self, found: DataFrame, keep, key_only: bool) -> DataFrame:
        """Keys locked as their transaction's primary are read just before it started."""
        own = keep(self.locks).where((F.col("key") == F.col("primary")) & F.col("op").isin(*DATA)).select("key", F.col("start_ts").alias("until"))
        past = keep(self.versions).join(own, "key").where(F.col("commit_ts") < F.col("until")).drop("until")
        return found.join(own.select("key"), "key", "left_anti").unionByName(visible(past, self.ts, key_only=key_only))

    def get(self, key: bytes) -> DataFrame:
        return self._read(lambda df: df.where(F.col("key") == F.lit(key)))

    def batch_get(self, keys: DataFrame) -> DataFrame:
        """Rows of the keys that exist; absent keys have none."""
        wanted = keys.select("key").distinct()
        return self._read(lambda df: df.join(wanted, "key", "left_semi"))

    def scan(self, lo: bytes | None = None, hi: bytes | None = None, *, limit: int | None = None, key_only: bool = False, reverse: bool = False) -> DataFrame:
        """Ordered rows of ``[lo, hi)``; blocked keys take a place in the limit."""
        rows = self._read(lambda df: df.where(in_range(F.col("key"), lo, hi)), key_only).orderBy(F.col("key").desc() if reverse else F.col("key"))
        return rows if limit is None else rows.limit(limit)

    def sample(self, step: int, lo: bytes | None = None, hi: bytes | None = None) -> DataFrame:
        """Every ``step``-th key in order, from the first.  Numbers come from counts per range partition, not one global window."""
        rows = self._read(lambda df: df.where(in_range(F.col("key"), lo, hi)))
        return every_nth(rows, step)

    def cache(self) -> Snapshot:
        """Keep this timestamp's rows; never for the newest state, which moves on."""
        if self.ts != LATEST:
            self.versions = self.versions.cache()
        return self

    def clean(self) -> Snapshot:
        """Release what ``cache`` keeps."""
        self.versions = self.versions.unpersist()
        return self


def range_parts(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` dealt into contiguous ranges of a column, with the range's number in ``__part``.

    Written once: bounds that are sampled again, after a lost executor, need not be the same.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(rows.repartitionByRange(parts, column).withColumn("__part", F.spark_partition_id()))


def numbered(rows: DataFrame, name: str = "n") -> DataFrame:
    """``rows`` with their number from 0 in the order of key: range partitions count themselves, then add those before."""
    dealt = range_parts(rows, "key")
    before = dealt.groupBy("__part").agg(F.count("*").alias("__c")).withColumn("__before", F.sum("__c").over(Window.orderBy("__part")) - F.col("__c")).drop("__c")
    within = F.row_number().over(Window.partitionBy("__part").orderBy("key")) - 1
    # A row a partition.
    return dealt.join(F.broadcast(before), "__part").withColumn(name, within + F.col("__before")).drop("__part", "__before")


def every_nth(rows: DataFrame, step: int) -> DataFrame:
    return numbered(rows, "__n").where(F.col("__n") % step == 0).drop("__n")


#: ``read_at_each`` takes a stated list of moments, at most so many.
MOST_MOMENTS = 10_000


def read_at_each(versions: DataFrame, moments: DataFrame) -> DataFrame:
    """(ts, key, value, commit_ts): the state at each of a stated list of moments, in one pass over the log.

    A version belongs to the stretch between two moments in which it was committed; of each key and stretch the newest
    is kept, and it is the state at every moment up to the key's next stretch.
    """
    times = sorted(r["ts"] for r in moments.select("ts").distinct().limit(MOST_MOMENTS + 1).collect())
    if len(times) > MOST_MOMENTS:
        raise ValueError(f"at most {MOST_MOMENTS} moments")
    if not times:
        return versions.select(F.lit(0).cast("long").alias("ts"), "key", "value", "commit_ts").limit(0)
    points = F.array(*[F.lit(t).cast("long") for t in times])
    rows = versions.where((F.col("commit_ts") <= times[-1]) & F.col("op").isin(*DATA))
    rows = rows.withColumn("stretch", F.size(F.filter(points, lambda t: t < F.col("commit_ts"))))
    newest = rows.groupBy("key", "stretch").agg(F.max_by(F.struct("op", "value", "commit_ts"), "commit_ts").alias("v"))
    until = F.coalesce(F.lead("stretch").over(Window.partitionBy("key").orderBy("stretch")), F.lit(len(times)))
    seen = newest.withColumn("until", until).where("v.op = 'put'")
    return seen.select(F.explode(F.slice(points, F.col("stretch") + 1, F.col("until") - F.col("stretch"))).alias("ts"), "key", "v.value", "v.commit_ts")


def history(versions: DataFrame, locks: DataFrame | None = None, key: bytes | None = None) -> DataFrame:
    """Per key its records, newest first, and its lock."""
    rows = versions if key is None else versions.where(F.col("key") == F.lit(key))
    record = F.struct("commit_ts", "start_ts", "op", "value")
    out = rows.groupBy("key").agg(F.sort_array(F.collect_list(record), asc=False).alias("records"))
    if locks is None:
        return out
    held = locks if key is None else locks.where(F.col("key") == F.lit(key))
    return out.join(held.select("key", F.struct("start_ts", "primary", "op").alias("lock")), "key", "full")


def history_by_start_ts(versions: DataFrame, start_ts: int) -> DataFrame:
    """History of the first key that has a record of this transaction."""
    first = versions.where(F.col("start_ts") == start_ts).agg(F.min("key").alias("key")).where("key IS NOT NULL")
    return history(versions.join(F.broadcast(first), "key", "left_semi"))  # one key


def split_errors(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(values, errors) of a read."""
    return rows.where("error IS NULL").drop("error"), rows.where("error IS NOT NULL").select("key", "error")
