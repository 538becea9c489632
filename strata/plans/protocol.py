"""Registered queries over transactions in every state: commits, rollbacks, locks, their outcomes, buffers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import codecs, flags, tso
from strata.operators import buffer as buf
from strata.operators import maintenance, transactions
from strata.plans.catalog import _bytes, _key, _show, _ts, query
from strata.sources import tables as src

#: Start and commit of the transaction that ``transaction_from_customers`` describes, and a time for locking ahead.
S, C = _ts(20), _ts(20) + 100
FOR_UPDATE = S + 200

ONE = f"""p AS (SELECT c_custkey AS c, printf('%016X', c_custkey) AS key, c_custkey % 7 AS st FROM customer),
    versions AS (SELECT key, {S - 1001} AS start_ts, {S - 1000} AS commit_ts, 'put' AS op, 'old' AS value FROM p WHERE c % 2 = 0 UNION ALL SELECT key, {S}, {S + 50}, 'put', 'own' FROM p WHERE st = 2
        UNION ALL SELECT key, {S}, {S}, 'rollback', NULL FROM p WHERE st = 3 UNION ALL SELECT key, {S + 499}, {S + 500}, 'put', 'new' FROM p WHERE c % 14 = 4),
    locks AS (SELECT key, c, st, CASE st WHEN 1 THEN {S + 7} ELSE {S} END AS start_ts, CASE st WHEN 6 THEN 'pessimistic' ELSE 'put' END AS op, c * 10 AS ttl_ms, CASE st WHEN 6 THEN {S + 3} ELSE 0 END AS for_update_ts FROM p WHERE st IN (0, 1, 5, 6))"""


def _one(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(keys with their state, versions, locks)."""
    customer = src.table(spark, sf_dir, "customer")
    keys = customer.select(codecs.encode_uint(F.col("c_custkey")).alias("key"), (F.col("c_custkey") % 7).alias("st"))
    return keys, *src.transaction_from_customers(customer, S, C)


@query("commit_errors_by_state", f"""WITH {ONE} SELECT key, CASE st WHEN 1 THEN 'transaction not found' WHEN 3 THEN 'rolled back' WHEN 4 THEN 'transaction not found' WHEN 5 THEN 'commit ts expired, at least {C + 1}' END AS error FROM p WHERE st <> 6""")
def commit_errors_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys, versions, locks = _one(spark, sf_dir)
    return _show(transactions.commit_errors(keys.where("st <> 6"), versions, locks, S, C))


@query("commit_by_state", f"""WITH {ONE} SELECT key, {C} AS commit_ts, 'put' AS op FROM p WHERE st = 0 UNION ALL SELECT key, commit_ts, op FROM versions WHERE start_ts = {S}""")
def commit_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that are locked or already committed: a commit may be repeated."""
    keys, versions, locks = _one(spark, sf_dir)
    step = transactions.commit(keys.where("st IN (0, 2)"), versions, locks, S, C)
    return _show(step.versions.where(F.col("start_ts") == S).select("key", "commit_ts", "op"))


@query("commit_refused", f"""WITH {ONE} SELECT (SELECT count(*) FROM versions) AS versions, (SELECT count(*) FROM locks) AS locks""")
def commit_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key in error keeps every table as it was."""
    keys, versions, locks = _one(spark, sf_dir)
    step = transactions.commit(keys.where("st IN (0, 5)"), versions, locks, S, C)
    return step.versions.agg(F.count("*").alias("versions")).join(step.locks.agg(F.count("*").alias("locks")))


@query("rollback_errors", f"""WITH {ONE} SELECT key, CASE st WHEN 2 THEN 'already committed at {S + 50}' END AS error FROM p""")
def rollback_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys, versions, locks = _one(spark, sf_dir)
    return _show(transactions.rollback(keys, versions, locks, S).results.select("key", "error"))


@query("rollback_by_state", f"""WITH {ONE} SELECT key, 'gone' AS state FROM p WHERE st <> 2 UNION ALL SELECT key, 'held' FROM p WHERE st = 1""")
def rollback_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollback records after the rollback of all keys that are not committed, one each, and the locks that stay."""
    keys, versions, locks = _one(spark, sf_dir)
    step = transactions.rollback(keys.where("st <> 2"), versions, locks, S)
    gone = step.versions.where((F.col("start_ts") == S) & (F.col("op") == "rollback")).select("key", F.lit("gone").alias("state"))
    return _show(gone.unionByName(step.locks.select("key", F.lit("held").alias("state"))))


@query("clean_up_errors", f"""WITH {ONE} SELECT key, CASE WHEN st = 2 THEN 'already committed at {S + 50}' WHEN st IN (0, 5, 6) AND NOT ({S} >> 18) + c * 10 < ({_ts(20)} >> 18) + 700 THEN 'locked by {S}' END AS error FROM p""")
def clean_up_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys, versions, locks = _one(spark, sf_dir)
    return _show(transactions.clean_up(keys, versions, locks, S, S + (700 << tso.LOGICAL_BITS)).results.select("key", "error"))


MANY_AT = _ts(25)
MANY = f"""t AS (SELECT c_custkey AS c, printf('%016X', c_custkey) AS "primary", {MANY_AT} + c_custkey * 262144 AS start_ts, c_custkey % 7 AS st FROM customer),
    l AS (SELECT *, CASE st WHEN 0 THEN 3000 WHEN 1 THEN c WHEN 5 THEN 1 ELSE 100000 END AS ttl, CASE st WHEN 6 THEN start_ts + 1 ELSE start_ts + 900 * 262144 END AS least FROM t WHERE st IN (0, 1, 5, 6))"""


def _many(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every customer is the primary of its own transaction: (asked, versions, locks)."""
    c = F.col("c_custkey")
    t = src.table(spark, sf_dir, "customer").select(codecs.encode_uint(c).alias("primary"), (F.lit(MANY_AT) + c * (1 << tso.LOGICAL_BITS)).alias("start_ts"), (c % 7).alias("st"), c.alias("c"))
    done = t.where("st IN (2, 3)").select(F.col("primary").alias("key"), "start_ts", F.when(F.col("st") == 2, F.col("start_ts") + 5).otherwise(F.col("start_ts")).alias("commit_ts"), F.when(F.col("st") == 2, "put").otherwise("rollback").alias("op"), F.lit(b"v").alias("value"))
    ttl = F.when(F.col("st") == 0, 3000).when(F.col("st") == 1, F.col("c")).when(F.col("st") == 5, 1).otherwise(100_000).cast("long")
    least = F.when(F.col("st") == 6, F.col("start_ts") + 1).otherwise(F.col("start_ts") + (900 << tso.LOGICAL_BITS))
    held = t.where("st IN (0, 1, 5, 6)").select(F.col("primary").alias("key"), "primary", "start_ts", F.lit("put").alias("op"), ttl.alias("ttl_ms"), least.alias("min_commit_ts"), (F.col("st") == 5).alias("use_async_commit"))
    return t.select("primary", "start_ts"), done, transactions.conform(held, transactions.LOCK_COLUMNS)


NOW = MANY_AT + (2000 << tso.LOGICAL_BITS)


def _status_sql(caller: int, missing: str) -> str:
    return f"""WITH {MANY}, j AS (SELECT t."primary", t.start_ts, t.st, l.ttl, l.least, l.c IS NOT NULL AS live, l.c IS NOT NULL AND t.st <> 5 AND (t.start_ts >> 18) + l.ttl < ({NOW} >> 18) AS late FROM t LEFT JOIN l USING (c)),
        k AS (SELECT *, live AND NOT late AND {caller} > 0 AND {caller} >= least AS push FROM j)
        SELECT "primary", start_ts, CASE WHEN live AND NOT late THEN ttl ELSE 0 END AS ttl_ms, CASE st WHEN 2 THEN start_ts + 5 ELSE 0 END AS commit_ts,
        CASE WHEN push THEN greatest(least, {caller + 1}, {NOW}) ELSE coalesce(least, 0) END AS min_commit_ts,
        CASE WHEN late THEN 'ttl_expire_rollback' WHEN push THEN 'min_commit_ts_pushed' WHEN live OR st IN (2, 3) THEN 'no_action' ELSE '{missing}' END AS action FROM k"""


@query("txn_status_by_state", _status_sql(0, "not_found"))
def txn_status_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(transactions.txn_status(*_many(spark, sf_dir), now_ts=NOW))


@query("txn_status_pushed", _status_sql(MANY_AT + 700 * 262144, "lock_not_exist_rollback"))
def txn_status_pushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader pushes commits behind itself, and transactions without any trace are rolled back."""
    return _show(transactions.txn_status(*_many(spark, sf_dir), now_ts=NOW, caller_start_ts=MANY_AT + (700 << tso.LOGICAL_BITS), rollback_if_missing=True))


@query("txn_outcomes", f"""WITH {MANY}, a AS (SELECT t.c, st, l.c IS NOT NULL AND st <> 5 AND (t.start_ts >> 18) + l.ttl < ({NOW} >> 18) AS late FROM t LEFT JOIN l USING (c, st))
    SELECT count(*) FILTER (st = 2) AS committed, count(*) FILTER (late OR st = 3) AS rolled_back, count(*) FILTER (st IN (2, 3) OR late) AS same FROM a""")
def txn_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many transactions are decided, and on how many two looks, a while apart, agree."""
    many = _many(spark, sf_dir)
    first, later = (transactions.txn_status(*many, now_ts=n) for n in (NOW, NOW + 1))
    back = transactions.is_rolled_back(F.col("ttl_ms"), F.col("commit_ts"), F.col("action"))
    counts = first.agg(F.count_if(transactions.is_committed(F.col("commit_ts"))).alias("committed"), F.count_if(back).alias("rolled_back"))
    return counts.join(transactions.same_outcome(first, later).agg(F.count_if("same").alias("same")))


@query("classify_for_read", f"""WITH {ONE}, s AS (SELECT key, c, start_ts, c % 6 AS k FROM locks)
    SELECT key, start_ts, CASE k WHEN 0 THEN 'access' WHEN 1 THEN 'ignore' WHEN 2 THEN 'ignore' WHEN 3 THEN 'ignore' ELSE 'wait' END AS fate, CASE k WHEN 4 THEN 70 ELSE 0 END AS wait_ms FROM s""")
def classify_for_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each lock's transaction is committed before the read, after it, rolled back, to be committed after it, alive, or unknown."""
    _, _, locks = _one(spark, sf_dir)
    own = locks.withColumn("start_ts", F.col("start_ts") + codecs.decode_uint(F.col("key")) * 1000)
    k = codecs.decode_uint(F.col("key")) % 6
    read_at = F.col("start_ts") * 0 + (1 << 61)
    status = own.where(k < 5).select(
        "start_ts", F.when(k == 4, 70).otherwise(0).alias("ttl_ms"), F.when(k == 0, read_at - 1).when(k == 1, read_at + 1).otherwise(0).alias("commit_ts"),
        F.when(k == 3, read_at + 1).otherwise(0).alias("min_commit_ts"), F.when(k == 2, "ttl_expire_rollback").when(k == 3, "min_commit_ts_pushed").otherwise("no_action").alias("action"),
    )
    found = transactions.classify_for_read(own, status, 1 << 61)
    return _show(found.withColumns({"start_ts": F.col("start_ts") - codecs.decode_uint(F.col("key")) * 1000, "wait_ms": F.col("wait_ms").cast("long")}))


LOCK_RESULTS = f"""r AS (SELECT key, CASE WHEN st = 1 THEN 'locked by {S + 7}' WHEN st = 3 THEN 'rolled back' WHEN c % 14 = 4 AND NOT forced THEN 'write conflict with {S + 500}' END AS error,
    c % 2 = 0 OR st = 2 AS "exists", c % 14 = 4 AS locked_with_conflict, forced FROM p, (VALUES (TRUE), (FALSE)) f(forced))"""


@query("pessimistic_lock_results", f"""WITH {ONE}, {LOCK_RESULTS} SELECT * FROM r""")
def pessimistic_lock_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys, versions, locks = _one(spark, sf_dir)
    both = [transactions.pessimistic_lock(keys, versions, locks, S, FOR_UPDATE, primary=_bytes(4), ttl_ms=3000, force=force).results.drop("already_locked").withColumn("forced", F.lit(force)) for force in (True, False)]
    return _show(both[0].unionByName(both[1]))


@query("pessimistic_lock_apply", f"""WITH {ONE} SELECT key, start_ts, op, ttl_ms, for_update_ts FROM locks UNION ALL SELECT key, {S}, 'pessimistic', 3000, {FOR_UPDATE} FROM p WHERE st = 4 AND c % 2 = 0""")
def pessimistic_lock_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only keys that have a value are locked; keys given twice are locked once."""
    keys, versions, locks = _one(spark, sf_dir)
    twice = keys.where("st IN (0, 4)").unionByName(keys.where("st = 4"))
    step = transactions.pessimistic_lock(twice, versions, locks, S, FOR_UPDATE, primary=_bytes(4), ttl_ms=3000, force=True, only_if_exists=True)
    return _show(step.locks.select("key", "start_ts", "op", "ttl_ms", "for_update_ts"))


@query("pessimistic_rollback", f"""WITH {ONE} SELECT key, op FROM locks WHERE st <> 6""")
def pessimistic_rollback(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, locks = _one(spark, sf_dir)
    return _show(transactions.pessimistic_rollback(locks, S, S + 3).select("key", "op"))


@query("pessimistic_rollback_keys", f"""WITH {ONE} SELECT key, op FROM locks WHERE st <> 6 OR c % 4 <> 0""")
def pessimistic_rollback_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys, _, locks = _one(spark, sf_dir)
    return _show(transactions.pessimistic_rollback(locks, S, FOR_UPDATE, keys.where(codecs.decode_uint(F.col("key")) % 4 == 0)).select("key", "op"))


@query("heart_beat", f"""WITH {ONE} SELECT key, CASE WHEN c = 14 THEN greatest(ttl_ms, 5000) ELSE ttl_ms END AS ttl_ms FROM locks""")
def heart_beat(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, locks = _one(spark, sf_dir)
    return _show(transactions.heart_beat(locks, _bytes(14), S, 5000).select("key", "ttl_ms"))


@query("resolve_range", f"""WITH {ONE}, i AS (SELECT *, c >= 10 AND c < 120 AS inside FROM locks)
    SELECT key, 'lock ' || op AS what, start_ts AS at FROM i WHERE NOT inside UNION ALL SELECT key, 'put', {C} FROM i WHERE inside AND st IN (0, 5) UNION ALL SELECT key, 'rollback', start_ts FROM i WHERE inside AND st = 1""")
def resolve_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locks of a range by their transactions' outcomes: what is written, and what stays locked outside of it."""
    _, versions, locks = _one(spark, sf_dir)
    outcomes = spark.createDataFrame([(S, C), (S + 7, 0)], "start_ts long, commit_ts long")
    after, left = transactions.resolve_locks(versions, locks, outcomes, _bytes(10), _bytes(120))
    new = after.where(((F.col("start_ts") == S) & (F.col("commit_ts") == C)) | ((F.col("start_ts") == S + 7) & (F.col("op") == "rollback")))
    held = left.select("key", F.concat(F.lit("lock "), F.col("op")).alias("what"), F.col("start_ts").alias("at"))
    return _show(held.unionByName(new.select("key", F.col("op").alias("what"), F.col("commit_ts").alias("at"))))


@query("gc_with_resolve", f"""WITH {ONE}, v AS (SELECT key, commit_ts, op FROM versions UNION ALL SELECT key, {C}, 'put' FROM locks WHERE st IN (0, 5) UNION ALL SELECT key, {S + 7}, 'rollback' FROM locks WHERE st = 1),
    n AS (SELECT *, row_number() OVER (PARTITION BY key, commit_ts <= {S + 300} AND op = 'put' ORDER BY commit_ts DESC) AS r FROM v) SELECT key, commit_ts, op FROM n WHERE commit_ts > {S + 300} OR (op = 'put' AND r = 1)""")
def gc_with_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, versions, locks = _one(spark, sf_dir)
    outcomes = spark.createDataFrame([(S, C), (S + 7, 0)], "start_ts long, commit_ts long")
    return _show(maintenance.resolved_before_gc(versions, locks, outcomes, S + 300)[0].select("key", "commit_ts", "op"))


@query("async_commit_by_state", """WITH g AS (SELECT c_custkey // 10 AS g, c_custkey AS c, c_custkey % 10 = 3 AND c_custkey // 10 % 4 = 1 AS done, c_custkey % 10 = 5 AND c_custkey // 10 % 4 IN (1, 2) AS missing FROM customer)
    SELECT g + 1 AS start_ts, CAST(CASE WHEN bool_or(done) THEN max(CASE WHEN done THEN 5000 + g END) WHEN bool_or(missing) THEN 0 ELSE max(1000 + c) END AS BIGINT) AS commit_ts FROM g GROUP BY g""")
def async_commit_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten customers a transaction: all locked, one already committed, or one neither locked nor committed."""
    c = F.col("c_custkey")
    g, key = F.floor(c / 10), codecs.encode_uint(c).alias("key")
    t = src.table(spark, sf_dir, "customer").select((g + 1).alias("start_ts"), key, c, ((c % 10 == 3) & (g % 4 == 1)).alias("done"), ((c % 10 == 5) & (g % 4).isin(1, 2)).alias("missing"))
    primaries = t.groupBy("start_ts").agg(F.min("key").alias("primary"), F.collect_list("key").alias("secondaries"))
    locks = t.where("NOT done AND NOT missing").select("key", "start_ts", (c + 1000).alias("min_commit_ts"))
    versions = t.where("done").select("key", "start_ts", (F.col("start_ts") - 1 + 5000).alias("commit_ts"), F.lit("put").alias("op"), F.lit(b"v").alias("value"))
    return transactions.async_commit_outcome(primaries, locks, versions)


@query("mutation_parts", """WITH m AS (SELECT printf('%016X', c_custkey) AS key, CASE c_custkey % 4 WHEN 0 THEN 'put' WHEN 1 THEN 'check_not_exists' WHEN 2 THEN 'del' ELSE 'lock' END AS op FROM customer)
    SELECT min(key) FILTER (op <> 'check_not_exists') AS "primary", count(*) FILTER (op <> 'check_not_exists' AND key <> printf('%016X', 2)) AS secondaries, count(*) FILTER (op <> 'check_not_exists') AS committed FROM m""")
def mutation_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    op = F.element_at(F.array(*map(F.lit, ("put", "check_not_exists", "del", "lock"))), (c % 4 + 1).cast("int"))
    m = src.table(spark, sf_dir, "customer").select(codecs.encode_uint(c).alias("key"), op.alias("op"), F.lit(b"v").alias("value"))
    first = transactions.primary_key(m).select(_key("primary"))
    second = transactions.secondaries(m, _bytes(2)).select(F.size("secondaries").cast("long").alias("secondaries"))
    return first.join(second).join(transactions.committed_part(m).agg(F.count("*").alias("committed")))


@query("flashback", f"""WITH {ONE}, w AS (SELECT key, max(commit_ts) AS newest, arg_max(value, commit_ts) FILTER (commit_ts <= {S}) AS old FROM versions WHERE op = 'put' AND key < '{500:016X}' GROUP BY key)
    SELECT key, CASE WHEN old IS NULL THEN 'del' ELSE 'put' END AS op, old AS value FROM w WHERE newest > {S}""")
def flashback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys committed since are written back or deleted."""
    _, versions, _ = _one(spark, sf_dir)
    return _show(transactions.flashback(versions, S, S + 1000, S + 1001, None, _bytes(500)).select("key", "op", "value"))


@query("fair_locking", """WITH a AS (SELECT c_custkey AS c, c_custkey % 2 = 0 AS was, c_custkey % 3 = 0 AS now FROM customer)
    SELECT count(*) FILTER (was AND NOT now) AS released, count(*) FILTER (now) AS kept, count(*) FILTER (was OR now) AS cancelled FROM a""")
def fair_locking(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = src.table(spark, sf_dir, "customer").select(codecs.encode_uint(F.col("c_custkey")).alias("key"), "c_custkey")
    was, now = keys.where("c_custkey % 2 = 0"), keys.where("c_custkey % 3 = 0")
    release, keep = transactions.fair_done(was, now)
    counts = [df.agg(F.count("*").alias(name)) for df, name in ((release, "released"), (keep, "kept"), (transactions.fair_cancel(was, now), "cancelled"))]
    return counts[0].join(counts[1]).join(counts[2])


@query("shared_locks_unfolded", f"""WITH {ONE} SELECT key, start_ts, op FROM locks WHERE c % 5 <> 0 UNION ALL SELECT key, start_ts + h, 'shared' FROM locks, (VALUES (1), (2), (3)) s(h) WHERE c % 5 = 0""")
def shared_locks_unfolded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth lock is shared by three transactions."""
    _, _, locks = _one(spark, sf_dir)
    shared = codecs.decode_uint(F.col("key")) % 5 == 0
    holders = F.array(*[F.struct((F.col("start_ts") + h).alias("start_ts"), F.col("ttl_ms").alias("ttl_ms")) for h in (1, 2, 3)])
    folded = locks.withColumns({"op": F.when(shared, "shared").otherwise(F.col("op")), "holders": F.when(shared, holders)})
    return _show(transactions.unfold_shared(folded).select("key", "start_ts", "op"))


WRITES = """w AS (SELECT printf('%016X', o_custkey) AS key, CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN '' ELSE 'v' || o_orderkey END AS value, o_orderkey % 16384 AS flags, o_orderkey % 3 AS stage, o_orderkey AS seq FROM orders)"""


def _newest_sql(where: str = "TRUE") -> str:
    return f"""n AS (SELECT key, arg_max(value, seq) FILTER (value IS NOT NULL) AS value, arg_max(flags, seq) AS flags, bool_or(value IS NOT NULL) AS has_value FROM w WHERE {where} GROUP BY key)"""


def _writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.writes_from_orders(src.table(spark, sf_dir, "orders"))


def _entries(rows: DataFrame) -> DataFrame:
    return _show(rows.withColumn("flags", F.col("flags").cast("long")))


@query("buffer_newest", f"WITH {WRITES}, {_newest_sql()} SELECT * FROM n")
def buffer_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entries(buf.newest(_writes(spark, sf_dir)))


@query("buffer_revert", f"WITH {WRITES}, {_newest_sql('seq <= 700')} SELECT * FROM n")
def buffer_revert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entries(buf.newest(buf.revert_to(_writes(spark, sf_dir), 700)))


@query("buffer_inspect_stage", f"WITH {WRITES}, {_newest_sql('stage >= 2')} SELECT * FROM n")
def buffer_inspect_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entries(buf.inspect_stage(_writes(spark, sf_dir), 2))


@query("buffer_stage_zero", f"WITH {WRITES}, {_newest_sql('stage = 0')} SELECT key, value FROM n WHERE has_value AND key >= '{5:016X}' AND key < '{90:016X}'")
def buffer_stage_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(buf.stage_zero(_writes(spark, sf_dir), _bytes(5), _bytes(90)))


@query("buffer_value_history", f"WITH {WRITES} SELECT key, arg_max(value, seq) AS value FROM w WHERE value LIKE '%2' GROUP BY key")
def buffer_value_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest value of each key that ends with a 2, whatever was written after it."""
    return _show(buf.value_history(_writes(spark, sf_dir), lambda v: F.decode(v, "UTF-8").endswith("2")))


@query("buffer_tiered_get", f"WITH {WRITES}, {_newest_sql()} SELECT key, value FROM n WHERE has_value AND key IN (SELECT printf('%016X', c_custkey) FROM customer WHERE c_custkey % 3 = 1)")
def buffer_tiered_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = src.table(spark, sf_dir, "customer").where("c_custkey % 3 = 1").select(codecs.encode_uint(F.col("c_custkey")).alias("key"))
    return _show(buf.tiered_get(_writes(spark, sf_dir), keys))


@query("buffer_presumed", f"WITH {WRITES}, {_newest_sql()} SELECT key FROM n WHERE flags & 1 <> 0")
def buffer_presumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(buf.presumes_not_exists(_writes(spark, sf_dir)))


@query("buffer_remove", f"WITH {WRITES}, {_newest_sql()} SELECT count(*) AS keys FROM n WHERE key NOT IN (SELECT printf('%016X', c_custkey) FROM customer WHERE c_custkey % 2 = 1)")
def buffer_remove(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = src.table(spark, sf_dir, "customer").where("c_custkey % 2 = 1").select(codecs.encode_uint(F.col("c_custkey")).alias("key"))
    return buf.newest(buf.remove(_writes(spark, sf_dir), keys)).agg(F.count("*").alias("keys"))


@query("buffer_generations", f"WITH {WRITES}, g AS (SELECT *, 9 - seq % 10 AS generation FROM w), o AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY generation DESC, seq DESC) AS r FROM g WHERE value IS NOT NULL) SELECT key, value FROM o WHERE r = 1")
def buffer_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flushed generations: a later one wins over a later write of an earlier one."""
    rows = _writes(spark, sf_dir).withColumn("generation", 9 - F.col("op_seq") % 10)
    return _show(buf.newest(rows).where("has_value").select("key", "value"))


@query("union_forward_scan", f"""WITH {WRITES}, {_newest_sql()}, s AS (SELECT printf('%016X', c_custkey) AS key, c_name AS value, c_custkey AS commit_ts FROM customer),
    u AS (SELECT key, value, commit_ts FROM s WHERE key NOT IN (SELECT key FROM n WHERE has_value) UNION ALL SELECT key, value, 0 FROM n WHERE has_value AND value <> '') SELECT * FROM u WHERE key >= '{20:016X}' AND key < '{900:016X}' ORDER BY key LIMIT 50""")
def union_forward_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    below = src.table(spark, sf_dir, "customer").select(codecs.encode_uint(c).alias("key"), F.encode("c_name", "UTF-8").alias("value"), c.alias("commit_ts"))
    return _show(buf.union_scan(_writes(spark, sf_dir), below, _bytes(20), _bytes(900), limit=50))


#: Bits that each operation sets and clears, written out for the SQL.
FLAG_MASKS = {
    "set_presume_not_exists": (17, 0), "del_presume_not_exists": (0, 17), "set_key_locked": (2, 0), "del_key_locked": (0, 2), "set_need_locked": (4, 0), "del_need_locked": (0, 4),
    "set_locked_value_exists": (8, 2048), "set_locked_value_not_exists": (0, 2056), "del_need_check_exists": (0, 16), "set_prewrite_only": (32, 0), "set_ignored_in_2pc": (64, 0), "set_readable": (128, 0),
    "set_newly_inserted": (256, 0), "set_assert_exist": (512, 1024), "set_assert_not_exist": (1024, 512), "set_assert_unknown": (1536, 0), "set_assert_none": (0, 1536), "set_need_constraint_check": (2048, 0),
    "del_need_constraint_check": (0, 2048), "set_previous_presume": (4096, 0), "set_locked_in_share_mode": (8192, 0), "set_locked_in_exclusive_mode": (0, 8192),
}
MASK_ROWS = ", ".join(f"('{name}', {on}, {off})" for name, (on, off) in FLAG_MASKS.items())


@query("flag_operations_all", f"""WITH m(operation, up, down) AS (VALUES {MASK_ROWS}) SELECT operation, sum(CAST((f & ~down) | up AS BIGINT) * (f % 1009 + 1))::BIGINT AS digest, count(*) AS n FROM (SELECT CAST(o_orderkey % 16384 AS INT) AS f FROM orders) t, m GROUP BY operation""")
def flag_operations_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every operation over the flags of all orders, as a weighted sum."""
    f = src.table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 16384).cast("int").alias("f"))
    sums = [F.sum(flags.apply(F.col("f"), name).cast("long") * (F.col("f") % 1009 + 1)).alias(name) for name in flags.OPERATIONS]
    one = f.agg(*sums, F.count("*").alias("n"))
    return one.select(F.explode(F.array(*[F.struct(F.lit(name).alias("operation"), F.col(name).alias("digest"), "n") for name in flags.OPERATIONS])).alias("x")).select("x.*")
