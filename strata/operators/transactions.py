"""The write protocol as steps over tables: mutations are derived, prewritten, committed or rolled back.

A step takes the current ``versions`` and ``locks`` and returns a ``Step``: new tables and a row per
key with a nullable error.  Steps are all-or-nothing where the protocol is: one error keeps the old
tables.  Nothing is collected but the count of errors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import flags as fl
from strata.functions.tso import is_expired_strictly

LOCK_COLUMNS = {
    "key": "binary", "primary": "binary", "start_ts": "long", "op": "string", "value": "binary", "ttl_ms": "long", "for_update_ts": "long",
    "txn_size": "long", "min_commit_ts": "long", "use_async_commit": "boolean", "secondaries": "array<binary>", "generation": "long",
}
VERSION_COLUMNS = {"key": "binary", "start_ts": "long", "commit_ts": "long", "op": "string", "value": "binary"}
#: Limits for commits that need no second phase.
ASYNC_KEYS, ASYNC_BYTES = 256, 4096


@dataclass
class Step:
    versions: DataFrame
    locks: DataFrame
    results: DataFrame

    def failed(self) -> bool:
        return not self.results.where("error IS NOT NULL").isEmpty()


def conform(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The columns of a table, missing ones as null."""
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()])


def derive_mutations(buffer: DataFrame, *, pessimistic: bool = False, unnecessary: Column | None = None) -> DataFrame:
    """(key, op, value, ...) from buffered (key, value, flags): what each key asks of the protocol.

    A null value is flags only; an empty one a delete.  ``unnecessary`` (by default the flag ``ignored_in_2pc``) is a
    condition for values that need no commit: they only keep their key's lock, if it has one, and deletes among them
    are left out.  Only an optimistic transaction checks that a key which it inserted and deleted again does not exist.
    """
    has = lambda name: fl.has(F.col("flags"), name)
    written, empty = F.col("value").isNotNull(), F.octet_length("value") == 0
    lock = F.when(has("locked_in_share_mode"), F.lit("shared_lock")).otherwise(F.lit("lock"))
    skip = F.coalesce(has("ignored_in_2pc") if unnecessary is None else unnecessary, F.lit(False))
    op = (
        F.when(~written | (skip & ~empty), F.when(has("key_locked"), lock))
        .when(~empty, F.when(has("presume_not_exists"), F.lit("insert")).otherwise(F.lit("put")))
        .when(skip, F.lit(None))
        .when(F.lit(not pessimistic) & has("presume_not_exists"), F.lit("check_not_exists"))
        .when(has("newly_inserted"), F.when(has("key_locked"), lock))
        .otherwise(F.lit("del"))
    )
    must_exist = F.when(has("assert_exist") & has("assert_not_exist"), "unknown").when(has("assert_exist"), "exist").when(has("assert_not_exist"), "not_exist").otherwise("none")
    return buffer.select(
        "key", op.alias("op"), "value", has("key_locked").alias("pessimistic"), must_exist.alias("assertion"), has("need_constraint_check").alias("constraint_check"),
    ).where("op IS NOT NULL")


def primary_key(mutations: DataFrame) -> DataFrame:
    """Smallest key that is more than a check."""
    return mutations.where(~F.col("op").isin("check_not_exists", "shared_lock")).agg(F.min("key").alias("primary"))


def _modes(async_keys: int, async_bytes: int, one_phase: bool, batches: int) -> list[Column]:
    small = (F.count("*") <= async_keys) & (F.sum(F.octet_length("key")) <= async_bytes) & ~F.coalesce(F.bool_or(F.col("op") == "shared_lock"), F.lit(False))
    size = F.sum(F.octet_length("key") + F.coalesce(F.octet_length("value"), F.lit(0)))
    return [small.alias("async_commit"), (small & F.lit(one_phase and batches == 1)).alias("one_phase"), F.count("*").alias("keys"), size.alias("bytes")]


def commit_mode(mutations: DataFrame, *, async_keys: int = ASYNC_KEYS, async_bytes: int = ASYNC_BYTES, one_phase: bool = True, batches: int = 1) -> DataFrame:
    """One row: may this transaction commit in one phase, or asynchronously, by its number and size of keys?"""
    return mutations.agg(*_modes(async_keys, async_bytes, one_phase, batches))


def commit_modes(mutations: DataFrame, by: str, *, async_keys: int = ASYNC_KEYS, async_bytes: int = ASYNC_BYTES, one_phase: bool = True, batches: int = 1) -> DataFrame:
    """``commit_mode`` of many transactions at once, a row for each value of the column ``by``."""
    return mutations.groupBy(by).agg(*_modes(async_keys, async_bytes, one_phase, batches))


def secondaries(mutations: DataFrame, primary: bytes) -> DataFrame:
    """Keys that an asynchronous commit's primary lock names."""
    return mutations.where((F.col("key") != F.lit(primary)) & (F.col("op") != "check_not_exists")).agg(F.array_sort(F.collect_list("key")).alias("secondaries"))


def committed_part(mutations: DataFrame) -> DataFrame:
    """Mutations that a commit touches: checks end with the prewrite."""
    return mutations.where("op <> 'check_not_exists'")


def _facts(keys: DataFrame, versions: DataFrame, start_ts: int, at: int) -> DataFrame:
    """Per key: newest record of any kind, whether this transaction was rolled back or committed, and the visible value."""
    near = versions.join(keys.select("key").distinct(), "key", "left_semi")
    own = F.col("start_ts") == start_ts
    return near.groupBy("key").agg(
        F.max("commit_ts").alias("newest"),
        F.bool_or(own & (F.col("op") == "rollback")).alias("rolled_back"),
        F.max(F.when(own & (F.col("op") != "rollback"), F.col("commit_ts"))).alias("committed_at"),
        F.max_by(F.when((F.col("commit_ts") <= at) & F.col("op").isin("put", "del"), F.col("op")), F.when((F.col("commit_ts") <= at) & F.col("op").isin("put", "del"), F.col("commit_ts"))).alias("seen"),
    )


def prewrite_errors(mutations: DataFrame, versions: DataFrame, locks: DataFrame, start_ts: int, *, for_update_ts: int = 0) -> DataFrame:
    """``mutations`` with error: key locked, write conflict, already exists, rolled back, or a failed assertion."""
    at = for_update_ts or start_ts
    optimistic = for_update_ts == 0
    held = locks.select("key", F.col("start_ts").alias("lock_ts"), F.col("op").alias("lock_op"))
    joined = mutations.join(_facts(mutations, versions, start_ts, at), "key", "left").join(held, "key", "left")
    exists = F.coalesce(F.col("seen") == "put", F.lit(False))
    pessimistic = F.coalesce(F.col("pessimistic"), F.lit(False)) if "pessimistic" in mutations.columns else F.lit(False)
    assertion = F.col("assertion") if "assertion" in mutations.columns else F.lit("none")
    error = (
        F.when(F.col("lock_ts") != start_ts, F.concat(F.lit("locked by "), F.col("lock_ts").cast("string")))
        .when(pessimistic & F.col("lock_ts").isNull(), "pessimistic lock not found")
        .when(F.coalesce("rolled_back", F.lit(False)), "rolled back")
        .when(~pessimistic & F.col("lock_ts").isNull() & (F.col("newest") > at), F.concat(F.lit("write conflict with "), F.col("newest").cast("string")))
        .when(F.lit(optimistic) & F.col("op").isin("insert", "check_not_exists") & exists, "already exists")
        .when((assertion == "exist") & ~exists, "assertion failed: exist")
        .when((assertion == "not_exist") & exists, "assertion failed: not_exist")
    )
    return joined.withColumn("error", error).select(*mutations.columns, "error", "lock_ts", "lock_op")


def prewrite(
    mutations: DataFrame, versions: DataFrame, locks: DataFrame, start_ts: int, *, primary: bytes, ttl_ms: int, for_update_ts: int = 0, min_commit_ts: int = 0,
    txn_size: int = 0, use_async_commit: bool = False, generation: int = 0,
) -> Step:
    """Lock every mutation's key, or none if any has an error."""
    checked = prewrite_errors(mutations, versions, locks, start_ts, for_update_ts=for_update_ts)
    results = checked.select("key", "error")
    if not results.where("error IS NOT NULL").isEmpty():
        return Step(versions, locks, results)
    rows = checked.where("op <> 'check_not_exists'").join(
        locks.where(F.col("start_ts") == start_ts).select("key", F.col("ttl_ms").alias("old_ttl"), F.col("min_commit_ts").alias("old_min")), "key", "left"
    )
    first = F.col("key") == F.lit(primary)
    new = rows.select(
        "key", F.lit(primary).alias("primary"), F.lit(start_ts).alias("start_ts"), F.when(F.col("op") == "insert", "put").when(F.col("op") == "shared_lock", "shared").otherwise(F.col("op")).alias("op"), "value",
        F.greatest(F.lit(ttl_ms), F.coalesce("old_ttl", F.lit(0))).alias("ttl_ms"), F.lit(for_update_ts).alias("for_update_ts"), F.lit(txn_size).alias("txn_size"),
        F.when(first, F.greatest(F.lit(min_commit_ts), F.coalesce("old_min", F.lit(0)))).otherwise(0).alias("min_commit_ts"), F.lit(use_async_commit).alias("use_async_commit"), F.lit(generation).alias("generation"),
    )
    return Step(versions, conform(locks, LOCK_COLUMNS).join(new.select("key"), "key", "left_anti").unionByName(conform(new, LOCK_COLUMNS)), results)


def commit_errors(keys: DataFrame, versions: DataFrame, locks: DataFrame, start_ts: int, commit_ts: int) -> DataFrame:
    """(key, error): a missing lock is fine only if the transaction has committed that key."""
    held = locks.where(F.col("start_ts") == start_ts).select("key", F.col("start_ts").alias("lock_ts"), "min_commit_ts")
    own = versions.where(F.col("start_ts") == start_ts).groupBy("key").agg(F.bool_or(F.col("op") != "rollback").alias("committed"), F.bool_or(F.col("op") == "rollback").alias("rolled_back"))
    joined = keys.select("key").distinct().join(held, "key", "left").join(own, "key", "left")
    error = (
        F.when(F.col("lock_ts").isNotNull() & (F.coalesce("min_commit_ts", F.lit(0)) > commit_ts), F.concat(F.lit("commit ts expired, at least "), F.col("min_commit_ts").cast("string")))
        .when(F.col("lock_ts").isNull() & F.coalesce("rolled_back", F.lit(False)), "rolled back")
        .when(F.col("lock_ts").isNull() & ~F.coalesce("committed", F.lit(False)), "transaction not found")
    )
    return joined.select("key", error.alias("error"))


def version_op(lock_op: Column) -> Column:
    """What a lock leaves in the log when it commits."""
    return F.when(lock_op == "put", "put").when(lock_op.isin("lock", "shared"), "lock").otherwise("del")


def _apply_commit(versions: DataFrame, locks: DataFrame, gone: DataFrame, commit_ts: Column) -> tuple[DataFrame, DataFrame]:
    new = gone.select("key", "start_ts", commit_ts.alias("commit_ts"), version_op(F.col("op")).alias("op"), "value")
    left = locks.join(gone.select("key", "start_ts"), ["key", "start_ts"], "left_anti")
    return conform(versions, VERSION_COLUMNS).unionByName(conform(new, VERSION_COLUMNS)), left


def commit(keys: DataFrame, versions: DataFrame, locks: DataFrame, start_ts: int, commit_ts: int) -> Step:
    """Turn the transaction's locks on these keys into versions at ``commit_ts``; repeating it changes nothing."""
    results = commit_errors(keys, versions, locks, start_ts, commit_ts)
    if not results.where("error IS NOT NULL").isEmpty():
        return Step(versions, locks, results)
    gone = locks.where(F.col("start_ts") == start_ts).join(keys.select("key").distinct(), "key", "left_semi")
    return Step(*_apply_commit(versions, locks, gone, F.lit(commit_ts)), results)


def rollback(keys: DataFrame, versions: DataFrame, locks: DataFrame, start_ts: int) -> Step:
    """Drop the transaction's locks on these keys and leave a rollback record on each; an error if one has committed."""
    wanted = keys.select("key").distinct()
    own = versions.where(F.col("start_ts") == start_ts).groupBy("key").agg(F.max(F.when(F.col("op") != "rollback", F.col("commit_ts"))).alias("at"), F.bool_or(F.col("op") == "rollback").alias("done"))
    results = wanted.join(own, "key", "left").select("key", F.when(F.col("at").isNotNull(), F.concat(F.lit("already committed at "), F.col("at").cast("string"))).alias("error"), F.coalesce("done", F.lit(False)).alias("done"))
    if not results.where("error IS NOT NULL").isEmpty():
        return Step(versions, locks, results.drop("done"))
    new = results.where("NOT done").select("key", F.lit(start_ts).alias("start_ts"), F.lit(start_ts).alias("commit_ts"), F.lit("rollback").alias("op"))
    left = locks.join(wanted.withColumn("start_ts", F.lit(start_ts)), ["key", "start_ts"], "left_anti")
    return Step(conform(versions, VERSION_COLUMNS).unionByName(conform(new, VERSION_COLUMNS)), left, results.drop("done"))


def pessimistic_lock(
    keys: DataFrame, versions: DataFrame, locks: DataFrame, start_ts: int, for_update_ts: int, *, primary: bytes, ttl_ms: int, only_if_exists: bool = False, force: bool = False, shared: bool = False,
) -> Step:
    """Lock keys ahead of writing; results also tell the value's existence.  ``force`` locks in spite of newer versions and says so."""
    wanted = keys.select("key").distinct()
    held = locks.select("key", F.col("start_ts").alias("lock_ts"), F.col("op").alias("lock_op"))
    joined = wanted.join(_facts(wanted, versions, start_ts, for_update_ts), "key", "left").join(held, "key", "left")
    exists = F.coalesce(F.col("seen") == "put", F.lit(False))
    other = (F.col("lock_ts") != start_ts) & ~(F.lit(shared) & (F.col("lock_op") == "shared"))
    conflict = F.col("newest") > for_update_ts
    error = F.when(other, F.concat(F.lit("locked by "), F.col("lock_ts").cast("string"))).when(F.coalesce("rolled_back", F.lit(False)), "rolled back").when(conflict & F.lit(not force), F.concat(F.lit("write conflict with "), F.col("newest").cast("string")))
    results = joined.select("key", error.alias("error"), exists.alias("exists"), F.coalesce(conflict, F.lit(False)).alias("locked_with_conflict"), (F.col("lock_ts") == start_ts).alias("already_locked"))
    if not results.where("error IS NOT NULL").isEmpty():
        return Step(versions, locks, results)
    new = results.where(~F.coalesce("already_locked", F.lit(False)) & (F.col("exists") | F.lit(not only_if_exists))).select(
        "key", F.lit(primary).alias("primary"), F.lit(start_ts).alias("start_ts"), F.lit("shared" if shared else "pessimistic").alias("op"), F.lit(ttl_ms).alias("ttl_ms"), F.lit(for_update_ts).alias("for_update_ts"), F.lit(0).alias("min_commit_ts"),
    )
    return Step(versions, conform(locks, LOCK_COLUMNS).unionByName(conform(new, LOCK_COLUMNS)), results)


def pessimistic_rollback(locks: DataFrame, start_ts: int, for_update_ts: int, keys: DataFrame | None = None) -> DataFrame:
    """Locks without this transaction's pessimistic ones up to ``for_update_ts``, on these keys or all."""
    gone = locks.where((F.col("start_ts") == start_ts) & F.col("op").isin("pessimistic", "shared") & (F.col("for_update_ts") <= for_update_ts))
    if keys is not None:
        gone = gone.join(keys.select("key").distinct(), "key", "left_semi")
    return locks.join(gone.select("key", "start_ts"), ["key", "start_ts"], "left_anti")


def heart_beat(locks: DataFrame, primary: bytes, start_ts: int, ttl_ms: int) -> DataFrame:
    """Raise the primary lock's time to live."""
    mine = (F.col("key") == F.lit(primary)) & (F.col("start_ts") == start_ts)
    return locks.withColumn("ttl_ms", F.when(mine, F.greatest("ttl_ms", F.lit(ttl_ms))).otherwise(F.col("ttl_ms")))


def txn_status(asked: DataFrame, versions: DataFrame, locks: DataFrame, *, now_ts: int, caller_start_ts: int = 0, rollback_if_missing: bool = False) -> DataFrame:
    """(primary, start_ts) to ttl_ms, commit_ts, min_commit_ts, action: what became of each transaction, by its primary."""
    held = locks.select(F.col("key").alias("primary"), "start_ts", "ttl_ms", "min_commit_ts", "use_async_commit" if "use_async_commit" in locks.columns else F.lit(False).alias("use_async_commit"), F.lit(True).alias("held"))
    own = versions.groupBy(F.col("key").alias("primary"), "start_ts").agg(F.max(F.when(F.col("op") != "rollback", F.col("commit_ts"))).alias("commit_ts"), F.bool_or(F.col("op") == "rollback").alias("rolled_back"))
    joined = asked.select("primary", "start_ts").join(held, ["primary", "start_ts"], "left").join(own, ["primary", "start_ts"], "left")
    live = F.coalesce("held", F.lit(False))
    expired = live & ~F.coalesce("use_async_commit", F.lit(False)) & is_expired_strictly(F.col("start_ts"), F.col("ttl_ms"), F.lit(now_ts))
    pushed = F.greatest(F.coalesce("min_commit_ts", F.lit(0)), F.lit(caller_start_ts + 1), F.lit(now_ts))
    push = live & ~expired & (F.lit(caller_start_ts) >= F.coalesce("min_commit_ts", F.lit(0))) & F.lit(caller_start_ts > 0)
    action = (
        F.when(expired, "ttl_expire_rollback").when(push, "min_commit_ts_pushed").when(live, "no_action").when(F.col("commit_ts").isNotNull(), "no_action")
        .when(F.coalesce("rolled_back", F.lit(False)), "no_action").when(F.lit(rollback_if_missing), "lock_not_exist_rollback").otherwise("not_found")
    )
    return joined.select(
        "primary", "start_ts", F.when(live & ~expired, F.col("ttl_ms")).otherwise(0).alias("ttl_ms"), F.when(live, 0).otherwise(F.coalesce("commit_ts", F.lit(0))).alias("commit_ts"),
        F.when(push, pushed).otherwise(F.coalesce("min_commit_ts", F.lit(0))).alias("min_commit_ts"), action.alias("action"),
    )


def is_committed(commit_ts: Column) -> Column:
    return commit_ts > 0


def is_rolled_back(ttl_ms: Column, commit_ts: Column, action: Column) -> Column:
    return (ttl_ms == 0) & (commit_ts == 0) & action.isin("no_action", "lock_not_exist_rollback", "ttl_expire_rollback")


def scan_locks(locks: DataFrame, max_ts: int, lo: bytes | None = None, hi: bytes | None = None, limit: int | None = None) -> DataFrame:
    from strata.operators.mvcc import in_range

    rows = locks.where(in_range(F.col("key"), lo, hi) & (F.col("start_ts") <= max_ts)).orderBy("key")
    return rows if limit is None else rows.limit(limit)


def resolve_locks(versions: DataFrame, locks: DataFrame, outcomes: DataFrame, lo: bytes | None = None, hi: bytes | None = None) -> tuple[DataFrame, DataFrame]:
    """Commit or roll back every lock in the range whose transaction ``outcomes`` (start_ts, commit_ts; 0: rolled back) lists."""
    from strata.operators.mvcc import in_range

    decided = locks.where(in_range(F.col("key"), lo, hi)).join(outcomes.select("start_ts", F.col("commit_ts").alias("__c")), "start_ts")
    # A pessimistic lock has no value to commit: it only goes.
    versions, left = _apply_commit(versions, locks, decided.where("__c > 0 AND op NOT IN ('pessimistic')"), F.col("__c"))
    gone = decided.where("__c = 0 OR op IN ('pessimistic')")
    undone = gone.where("op NOT IN ('pessimistic', 'shared')").select("key", "start_ts", F.col("start_ts").alias("commit_ts"), F.lit("rollback").alias("op"))
    return versions.unionByName(conform(undone, VERSION_COLUMNS)), left.join(gone.select("key", "start_ts"), ["key", "start_ts"], "left_anti")


def async_commit_outcome(primaries: DataFrame, locks: DataFrame, versions: DataFrame) -> DataFrame:
    """(start_ts, commit_ts) of transactions whose primary lists its secondaries: all locked commits at the largest
    min_commit_ts; a key already committed decides that time; a key neither locked nor committed rolls all back."""
    keys = primaries.select("start_ts", "primary", F.explode(F.array_union(F.array("primary"), F.coalesce("secondaries", F.array().cast("array<binary>")))).alias("key"))
    held = locks.select("key", "start_ts", "min_commit_ts")
    done = versions.where("op <> 'rollback'").select("key", "start_ts", F.col("commit_ts").alias("done_at"))
    joined = keys.join(held, ["key", "start_ts"], "left").join(done, ["key", "start_ts"], "left")
    missing = F.col("min_commit_ts").isNull() & F.col("done_at").isNull()
    agg = joined.groupBy("start_ts").agg(F.max("done_at").alias("done_at"), F.bool_or(missing).alias("missing"), F.max("min_commit_ts").alias("least"), F.countDistinct("done_at").alias("times"))
    return agg.select("start_ts", F.when(F.col("times") > 1, F.raise_error(F.lit("keys of one transaction committed at different times"))).when(F.col("done_at").isNotNull(), F.col("done_at")).when(F.col("missing"), 0).otherwise(F.col("least")).cast("long").alias("commit_ts"))


def classify_for_read(locks: DataFrame, status: DataFrame, read_ts: int) -> DataFrame:
    """Locks met by a read: ``ignore`` (rolled back, or commits after the read), ``access`` (committed by then) or ``wait``."""
    joined = locks.join(status.select("start_ts", "ttl_ms", F.col("commit_ts").alias("at"), F.col("min_commit_ts").alias("least"), "action").withColumnRenamed("ttl_ms", "left_ms"), "start_ts", "left")
    fate = (
        F.when((F.col("at") > 0) & (F.col("at") <= read_ts), "access").when(F.col("at") > read_ts, "ignore").when(is_rolled_back(F.col("left_ms"), F.col("at"), F.col("action")), "ignore")
        .when(F.col("least") > read_ts, "ignore").otherwise("wait")
    )
    return joined.select("key", "start_ts", fate.alias("fate"), F.when(fate == "wait", F.coalesce("left_ms", F.lit(0))).otherwise(0).alias("wait_ms"))


def stale_starts(keys: DataFrame, versions: DataFrame) -> DataFrame:
    """(key, start_ts) pairs whose key was committed after the start: a latch would refuse them."""
    newest = versions.where("op <> 'rollback'").groupBy("key").agg(F.max("commit_ts").alias("newest"))
    return keys.join(newest, "key", "left").select(*keys.columns, F.coalesce(F.col("newest") > F.col("start_ts"), F.lit(False)).alias("stale"))


def clean_up(keys: DataFrame, versions: DataFrame, locks: DataFrame, start_ts: int, now_ts: int) -> Step:
    """Roll back a transaction whose lock time is over; a live lock is an error, as is a commit.  ``now_ts`` 0: do not ask the time."""
    wanted = keys.select("key").distinct()
    live = locks.where((F.col("start_ts") == start_ts) & ~is_expired_strictly(F.col("start_ts"), F.col("ttl_ms"), F.lit(now_ts))).select("key", F.lit(True).alias("live")) if now_ts else locks.limit(0).select("key", F.lit(True).alias("live"))
    step = rollback(wanted.join(live, "key", "left_anti"), versions, locks, start_ts)
    held = wanted.join(live, "key").select("key", F.lit(f"locked by {start_ts}").alias("error"))
    results = step.results.unionByName(held)
    if not held.isEmpty():
        return Step(versions, locks, results)
    return Step(step.versions, step.locks, results)


def same_outcome(a: DataFrame, b: DataFrame) -> DataFrame:
    """(primary, start_ts, same): do two status tables agree on a final outcome, the same commit time or both rolled back?"""
    final = lambda t: t.select("primary", "start_ts", "commit_ts", is_rolled_back(F.col("ttl_ms"), F.col("commit_ts"), F.col("action")).alias("back"))
    left, right = final(a).alias("a"), final(b).alias("b")
    joined = left.join(right, ["primary", "start_ts"])
    same = (is_committed(F.col("a.commit_ts")) & (F.col("a.commit_ts") == F.col("b.commit_ts"))) | (F.col("a.back") & F.col("b.back"))
    return joined.select("primary", "start_ts", same.alias("same"))


def fair_retry(previous: DataFrame, current: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(to release, previous) at the start of another attempt of a statement, from the keys that the last two locked.

    Keys of the attempt before that were not wanted again are released; those of the ended attempt may be taken over.
    """
    return previous.join(current.select("key"), "key", "left_anti"), current


def fair_done(previous: DataFrame, current: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(to release, to keep) when the statement has succeeded."""
    return previous.join(current.select("key"), "key", "left_anti"), current


def fair_cancel(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Keys to release when the statement is given up: all that its attempts locked."""
    return previous.select("key").unionByName(current.select("key")).distinct()


def unfold_shared(locks: DataFrame, holders: str = "holders") -> DataFrame:
    """A row per holder: a shared lock lists its holders as structs (start_ts, ttl_ms, ...) that take the place of its own columns."""
    inner = [f.name for f in locks.schema[holders].dataType.elementType.fields]
    rest = [c for c in locks.columns if c not in (holders, *inner)]
    single = locks.where((F.col("op") != "shared") | F.col(holders).isNull()).select(*rest, *inner)
    many = locks.where(F.col("op") == "shared").select(*rest, F.explode(holders).alias("__h")).select(*rest, *[F.col(f"__h.{c}").alias(c) for c in inner])
    return single.unionByName(many).select(*[c for c in locks.columns if c != holders])


def flashback(versions: DataFrame, ts: int, start_ts: int, commit_ts: int, lo: bytes | None = None, hi: bytes | None = None) -> DataFrame:
    """New versions that bring the keys of ``[lo, hi)`` back to their state at ``ts``: old values again, and deletes.

    A key whose newest write is not after ``ts`` needs none.
    """
    from strata.operators.mvcc import in_range

    rows = versions.where(in_range(F.col("key"), lo, hi) & F.col("op").isin("put", "del"))
    past = F.col("commit_ts") <= ts
    order = F.struct("commit_ts", "start_ts")
    per_key = rows.groupBy("key").agg(
        F.max("commit_ts").alias("newest"), F.max_by(F.struct("op", "value"), F.when(past, order)).alias("then"), F.max_by("op", order).alias("now"),
    ).where(F.col("newest") > ts)
    was_there = F.coalesce(F.col("then.op") == "put", F.lit(False))
    back = per_key.where(was_there | (F.col("now") == "put"))
    return back.select("key", F.lit(start_ts).alias("start_ts"), F.lit(commit_ts).alias("commit_ts"), F.when(was_there, "put").otherwise("del").alias("op"), F.when(was_there, F.col("then.value")).alias("value"))


def latest_commit_ts(start: Column, now_ms: Column, longest_ms: int) -> Column:
    """The last commit timestamp that a transaction may take: now plus the longest safe window, from its start on."""
    return F.greatest(start, F.shiftleft(now_ms + longest_ms, 18))
