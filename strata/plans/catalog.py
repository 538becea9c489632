"""Registered queries of the versioned key-value engine and the SQL that must agree with them.

Keys and values are returned as text, so that both engines compare the same values.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import codecs, flags, tso
from strata.operators import buffer as buf
from strata.operators import deadlock, maintenance, mvcc, raw, regions, transactions
from strata.sources import tables as src

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


def _ts(day: int, hour: int = 0) -> int:
    return int(datetime(2024, 1, day, hour, tzinfo=timezone.utc).timestamp() * 1000) << tso.LOGICAL_BITS


def _text(c: str) -> Column:
    return F.decode(F.col(c), "UTF-8").alias(c)


def _key(c: str = "key") -> Column:
    return F.hex(c).alias(c)


READ_AT, SAFE_POINT = _ts(15, 12), _ts(10)
USERS = "SELECT printf('%016X', user_id) AS key"
TSO = "((epoch_us(ts) // 1000) * 262144 + event_id % 262144)"
VERSIONS = f"versions AS (SELECT printf('%016X', user_id) AS key, user_id, {TSO} AS commit_ts, {TSO} - 1 AS start_ts, CASE WHEN event_type = 'error' THEN 'del' ELSE 'put' END AS op, CAST(event_id AS VARCHAR) AS value FROM events)"
NOISY = f"versions AS (SELECT printf('%016X', user_id) AS key, user_id, {TSO} AS commit_ts, {TSO} - 1 AS start_ts, CASE WHEN event_id % 17 = 0 THEN 'rollback' WHEN event_id % 19 = 0 THEN 'lock' WHEN event_type = 'error' THEN 'del' ELSE 'put' END AS op, CAST(event_id AS VARCHAR) AS value FROM events)"
LOCKS = f"""locks AS (SELECT printf('%016X', user_id) AS key, printf('%016X', user_id - user_id % 21) AS "primary", max({TSO}) - 1 AS start_ts,
    CASE user_id % 3 WHEN 0 THEN 'put' WHEN 1 THEN 'del' ELSE 'lock' END AS op, user_id % 5 * 1000 AS ttl_ms, max({TSO}) - 1 + user_id AS min_commit_ts,
    arg_max(CAST(event_id AS VARCHAR), {TSO}) AS value FROM events WHERE user_id % 7 = 0 GROUP BY user_id)"""


def _seen(at: int, where: str = "TRUE") -> str:
    """SQL of the visible rows, by another route than the engine's aggregate."""
    return f"""seen AS (SELECT key, value, commit_ts FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY commit_ts DESC) AS r FROM versions
        WHERE commit_ts <= {at} AND op IN ('put', 'del') AND {where}) WHERE r = 1 AND op = 'put')"""


def _versions(spark: SparkSession, sf_dir: str, noise: bool = True) -> DataFrame:
    return src.versions_from_events(src.table(spark, sf_dir, "events"), noise=noise)


def _locks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.locks_from_events(src.table(spark, sf_dir, "events"))


def _history(spark: SparkSession, sf_dir: str, locks: DataFrame) -> DataFrame:
    """All versions but the events that are locks: these transactions are still open."""
    return _versions(spark, sf_dir).join(locks.select("key", "start_ts"), ["key", "start_ts"], "left_anti")


def _bytes(n: int) -> bytes:
    return n.to_bytes(8, "big")


def _show(rows: DataFrame) -> DataFrame:
    return rows.select(*[_key(c) if c in ("key", "primary") else _text(c) if c == "value" else F.col(c) for c in rows.columns])



@query("snapshot_scan", f"WITH {NOISY}, {_seen(READ_AT)} SELECT key, value, commit_ts FROM seen")
def snapshot_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(mvcc.visible(_versions(spark, sf_dir), READ_AT))


@query("snapshot_scan_range", f"WITH {NOISY}, {_seen(READ_AT)} SELECT key, value, commit_ts FROM seen WHERE key >= '{30:016X}' AND key < '{90:016X}'")
def snapshot_scan_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mvcc.Snapshot(_versions(spark, sf_dir), READ_AT).scan(_bytes(30), _bytes(90))
    return _show(rows.drop("error"))


@query("snapshot_scan_limit", f"WITH {NOISY}, {_seen(READ_AT)} SELECT key, value, commit_ts FROM seen WHERE key >= '{10:016X}' ORDER BY key LIMIT 25")
def snapshot_scan_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mvcc.Snapshot(_versions(spark, sf_dir), READ_AT).scan(_bytes(10), limit=25)
    return _show(rows.drop("error"))


@query("snapshot_reverse_scan", f"WITH {NOISY}, {_seen(READ_AT)} SELECT key, value, commit_ts FROM seen WHERE key < '{100:016X}' ORDER BY key DESC LIMIT 25")
def snapshot_reverse_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mvcc.Snapshot(_versions(spark, sf_dir), READ_AT).scan(None, _bytes(100), limit=25, reverse=True)
    return _show(rows.drop("error"))


@query("snapshot_key_only", f"WITH {NOISY}, {_seen(READ_AT)} SELECT key, commit_ts FROM seen")
def snapshot_key_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(mvcc.Snapshot(_versions(spark, sf_dir), READ_AT).scan(key_only=True).drop("error"))


@query("snapshot_point_get", f"WITH {NOISY}, {_seen(READ_AT)} SELECT key, value, commit_ts FROM seen WHERE key = '{7:016X}'")
def snapshot_point_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(mvcc.Snapshot(_versions(spark, sf_dir), READ_AT).get(_bytes(7)).drop("error"))


@query("snapshot_batch_get", f"WITH {NOISY}, {_seen(READ_AT)} SELECT key, value, commit_ts FROM seen WHERE key IN (SELECT printf('%016X', c_custkey) FROM customer WHERE c_custkey % 3 = 0)")
def snapshot_batch_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = src.table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(codecs.encode_uint(F.col("c_custkey")).alias("key"))
    return _show(mvcc.Snapshot(_versions(spark, sf_dir), READ_AT).batch_get(keys).drop("error"))


@query("snapshot_latest", f"WITH {NOISY}, {_seen(tso.LATEST)} SELECT key, value, commit_ts FROM seen")
def snapshot_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(mvcc.visible(_versions(spark, sf_dir)))


@query("snapshot_time_series", f"WITH {NOISY}, m(ts) AS (VALUES ({_ts(5)}), ({_ts(12)}), ({_ts(20)}), ({_ts(29)})), s AS (SELECT m.ts, v.*, row_number() OVER (PARTITION BY m.ts, key ORDER BY commit_ts DESC) AS r FROM versions v JOIN m ON commit_ts <= m.ts WHERE op IN ('put', 'del')) SELECT ts, key, value, commit_ts FROM s WHERE r = 1 AND op = 'put'")
def snapshot_time_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    moments = spark.createDataFrame([(_ts(d),) for d in (5, 12, 20, 29)], "ts long")
    return _show(mvcc.read_at_each(_versions(spark, sf_dir), moments))


@query("snapshot_sample_step", f"WITH {NOISY}, {_seen(READ_AT)} SELECT key, value, commit_ts FROM (SELECT *, row_number() OVER (ORDER BY key) AS n FROM seen) WHERE (n - 1) % 7 = 0")
def snapshot_sample_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(mvcc.Snapshot(_versions(spark, sf_dir), READ_AT).sample(7).drop("error"))


@query("si_scan_lock_errors", f"""WITH {NOISY}, {LOCKS}, {_seen(_ts(30))}, held AS (SELECT key, start_ts FROM locks WHERE start_ts <= {_ts(30)} AND op <> 'lock')
    SELECT key, value, commit_ts, NULL AS error FROM seen WHERE key NOT IN (SELECT key FROM held) UNION ALL SELECT key, NULL, NULL, 'locked by ' || start_ts FROM held""")
def si_scan_lock_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(mvcc.Snapshot(_versions(spark, sf_dir), _ts(30), locks=_locks(spark, sf_dir)).scan())


@query("si_scan_resolved", f"""WITH {NOISY}, {_seen(tso.LATEST)}, {LOCKS}, own AS (SELECT key, start_ts FROM locks WHERE key = \"primary\" AND op <> 'lock'),
    held AS (SELECT key, start_ts FROM locks WHERE key <> \"primary\" AND op <> 'lock' AND start_ts % 2 <> 0),
    past AS (SELECT v.key, v.value, v.commit_ts, v.op, row_number() OVER (PARTITION BY v.key ORDER BY v.commit_ts DESC) AS r FROM versions v JOIN own ON v.key = own.key AND v.commit_ts < own.start_ts WHERE v.op IN ('put', 'del'))
    SELECT key, value, commit_ts, NULL AS error FROM seen WHERE key NOT IN (SELECT key FROM own) AND key NOT IN (SELECT key FROM held)
    UNION ALL SELECT key, value, commit_ts, NULL FROM past WHERE r = 1 AND op = 'put' UNION ALL SELECT key, NULL, NULL, 'locked by ' || start_ts FROM held""")
def si_scan_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest state: own primaries are read before their lock, secondaries of transactions that are not resolved block."""
    locks = _locks(spark, sf_dir)
    return _show(mvcc.Snapshot(_versions(spark, sf_dir), None, locks=locks, resolved=locks.where("start_ts % 2 = 0")).scan())


@query("rc_scan", f"WITH {NOISY}, {_seen(READ_AT)} SELECT key, value, commit_ts, CAST(NULL AS VARCHAR) AS error FROM seen")
def rc_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(mvcc.Snapshot(_versions(spark, sf_dir), READ_AT, locks=_locks(spark, sf_dir), isolation=mvcc.RC).scan())


@query("rc_check_ts_scan", f"WITH {NOISY}, {_seen(_ts(29))} SELECT key, value, commit_ts, NULL AS error FROM seen WHERE key NOT IN (SELECT key FROM versions WHERE commit_ts > {_ts(29)}) UNION ALL SELECT DISTINCT key, NULL, NULL, 'newer version' FROM versions WHERE commit_ts > {_ts(29)}")
def rc_check_ts_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(mvcc.Snapshot(_versions(spark, sf_dir), _ts(29), isolation=mvcc.RC_CHECK_TS).scan())


@query("mvcc_history", f"WITH {NOISY} SELECT key, count(*) AS records, max(commit_ts) AS newest, string_agg(value, ',' ORDER BY commit_ts DESC) AS vals FROM versions GROUP BY key")
def mvcc_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = mvcc.history(_versions(spark, sf_dir))
    return h.select(_key(), F.size("records").cast("long").alias("records"), F.element_at("records", 1)["commit_ts"].alias("newest"), F.array_join(F.transform("records", lambda r: F.decode(r["value"], "UTF-8")), ",").alias("vals"))


@query("mvcc_by_start_ts", f"WITH {NOISY}, t AS (SELECT start_ts FROM versions WHERE value = '77'), k AS (SELECT min(key) AS key FROM versions WHERE start_ts = (SELECT start_ts FROM t)) SELECT key, count(*) AS records FROM versions WHERE key = (SELECT key FROM k) GROUP BY key")
def mvcc_by_start_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _versions(spark, sf_dir)
    start = v.where(F.decode("value", "UTF-8") == "77").first()["start_ts"]
    return mvcc.history_by_start_ts(v, start).select(_key(), F.size("records").cast("long").alias("records"))


@query("gc_survivors", f"WITH {NOISY}, gc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key, commit_ts <= {SAFE_POINT} AND op IN ('put', 'del') ORDER BY commit_ts DESC) AS r FROM versions) WHERE commit_ts > {SAFE_POINT} OR (op = 'put' AND r = 1)) SELECT key, commit_ts, op, value FROM gc")
def gc_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(maintenance.collect_garbage(_versions(spark, sf_dir), SAFE_POINT).select("key", "commit_ts", "op", "value"))


@query("gc_removed_counts", f"WITH {NOISY}, gc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key, commit_ts <= {SAFE_POINT} AND op IN ('put', 'del') ORDER BY commit_ts DESC) AS r FROM versions) WHERE commit_ts > {SAFE_POINT} OR (op = 'put' AND r = 1)) SELECT v.op, coalesce(g.kept, 0) AS kept, v.n - coalesce(g.kept, 0) AS removed FROM (SELECT op, count(*) AS n FROM versions GROUP BY op) v LEFT JOIN (SELECT op, count(*) AS kept FROM gc GROUP BY op) g USING (op)")
def gc_removed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.garbage_counts(_versions(spark, sf_dir), SAFE_POINT)


@query("delete_range", f"WITH {NOISY} SELECT op, count(*) AS n FROM versions WHERE NOT (key >= '{20:016X}' AND key < '{60:016X}') GROUP BY op")
def delete_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = maintenance.delete_range(_versions(spark, sf_dir), _bytes(20), _bytes(60))
    return left.groupBy("op").agg(F.count("*").alias("n"))


@query("scan_lock", f"WITH {LOCKS} SELECT key, start_ts, op, \"primary\" FROM locks WHERE start_ts <= {_ts(30)} AND key < '{100:016X}'")
def scan_lock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(transactions.scan_locks(_locks(spark, sf_dir), _ts(30), None, _bytes(100)).select("key", "start_ts", "op", "primary"))


@query("prewrite_conflicts", f"""WITH {NOISY}, {LOCKS}, m AS (SELECT printf('%016X', o_custkey % 200) AS key, CASE WHEN min(o_orderkey) % 3 = 0 THEN 'insert' ELSE 'put' END AS op FROM orders GROUP BY o_custkey % 200), {_seen(_ts(30, 20))},
    n AS (SELECT key, max(commit_ts) AS newest FROM versions GROUP BY key)
    SELECT m.key, CASE WHEN l.start_ts IS NOT NULL THEN 'locked by ' || l.start_ts WHEN newest > {_ts(30, 20)} THEN 'write conflict with ' || newest WHEN m.op = 'insert' AND s.key IS NOT NULL THEN 'already exists' END AS error
    FROM m LEFT JOIN locks l ON m.key = l.key LEFT JOIN n ON m.key = n.key LEFT JOIN seen s ON m.key = s.key""")
def prewrite_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = src.table(spark, sf_dir, "orders")
    m = orders.groupBy((F.col("o_custkey") % 200).alias("k")).agg(F.when(F.min("o_orderkey") % 3 == 0, "insert").otherwise("put").alias("op"))
    m = m.select(codecs.encode_uint(F.col("k")).alias("key"), "op", F.lit(b"x").alias("value"))
    return _show(transactions.prewrite_errors(m, _versions(spark, sf_dir), _locks(spark, sf_dir), _ts(30, 20)).select("key", "error"))


@query("prewrite_apply", f"""WITH {LOCKS}, m AS (SELECT DISTINCT printf('%016X', 1000000 + o_custkey) AS key FROM orders)
    SELECT key, start_ts, op FROM locks UNION ALL SELECT key, {_ts(31)}, 'put' FROM m""")
def prewrite_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = src.table(spark, sf_dir, "orders").select(codecs.encode_uint(F.col("o_custkey") + 1_000_000).alias("key")).distinct().withColumns({"op": F.lit("put"), "value": F.lit(b"x")})
    step = transactions.prewrite(m, _versions(spark, sf_dir), _locks(spark, sf_dir), _ts(31), primary=_bytes(1_000_001), ttl_ms=3000)
    return _show(step.locks.select("key", "start_ts", "op"))


@query("commit_errors", f"""WITH {LOCKS}, one AS (SELECT max(start_ts) AS s FROM locks) SELECT key, CASE WHEN start_ts = s THEN CASE WHEN min_commit_ts > {_ts(31)} THEN 'x' END ELSE 'transaction not found' END AS error FROM locks, one""")
def commit_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    locks = _locks(spark, sf_dir)
    start = locks.agg(F.max("start_ts")).first()[0]
    return _show(transactions.commit_errors(locks.select("key"), _history(spark, sf_dir, locks), locks, start, _ts(31)))


@query("commit_apply", f"""WITH {NOISY}, {LOCKS}, one AS (SELECT max(start_ts) AS s FROM locks) SELECT op, count(*) AS n FROM (SELECT op FROM versions UNION ALL SELECT op FROM locks, one WHERE start_ts = s) GROUP BY op""")
def commit_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, locks = _versions(spark, sf_dir), _locks(spark, sf_dir)
    start = locks.agg(F.max("start_ts")).first()[0]
    step = transactions.commit(locks.where(F.col("start_ts") == start), v, locks, start, _ts(31))
    return step.versions.groupBy("op").agg(F.count("*").alias("n"))


@query("rollback_apply", f"""WITH {LOCKS}, one AS (SELECT min(start_ts) AS s FROM locks) SELECT key, CASE WHEN start_ts = s THEN 'gone' ELSE 'held' END AS state FROM locks, one""")
def rollback_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    locks = _locks(spark, sf_dir)
    start = locks.agg(F.min("start_ts")).first()[0]
    step = transactions.rollback(locks.where(F.col("start_ts") == start), _history(spark, sf_dir, locks), locks, start)
    back = step.versions.where((F.col("op") == "rollback") & (F.col("start_ts") == start)).select("key", F.lit("gone").alias("state"))
    return _show(step.locks.select("key", F.lit("held").alias("state")).unionByName(back))


@query("txn_status", f"""WITH {LOCKS}, p AS (SELECT DISTINCT \"primary\", start_ts FROM locks),
    h AS (SELECT p.*, l.ttl_ms, l.key IS NOT NULL AS held, l.key IS NOT NULL AND (p.start_ts >> 18) + l.ttl_ms < ({_ts(30, 23)} >> 18) AS expired FROM p LEFT JOIN locks l ON p.\"primary\" = l.key AND p.start_ts = l.start_ts)
    SELECT \"primary\", start_ts, CASE WHEN held AND NOT expired THEN ttl_ms ELSE 0 END AS ttl_ms, CASE WHEN expired THEN 'ttl_expire_rollback' WHEN held THEN 'no_action' ELSE 'not_found' END AS action FROM h""")
def txn_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    locks = _locks(spark, sf_dir)
    asked = locks.select("primary", "start_ts").distinct()
    status = transactions.txn_status(asked, _history(spark, sf_dir, locks), locks, now_ts=_ts(30, 23))
    return _show(status.select("primary", "start_ts", F.col("ttl_ms").cast("long").alias("ttl_ms"), "action"))


@query("batch_resolve_lock", f"""WITH {LOCKS}, o AS (SELECT DISTINCT start_ts, CASE WHEN start_ts % 2 = 0 THEN 0 ELSE start_ts + 5 END AS c FROM locks WHERE start_ts % 3 <> 0)
    SELECT key, CASE WHEN c > 0 THEN c ELSE l.start_ts END AS commit_ts, CASE WHEN c = 0 THEN 'rollback' ELSE op END AS op FROM locks l JOIN o USING (start_ts)""")
def batch_resolve_lock(spark: SparkSession, sf_dir: str) -> DataFrame:
    locks = _locks(spark, sf_dir)
    c = F.when(F.col("start_ts") % 2 == 0, 0).otherwise(F.col("start_ts") + 5).alias("commit_ts")
    outcomes = locks.where("start_ts % 3 <> 0").select("start_ts", c).distinct()
    versions, _ = transactions.resolve_locks(_history(spark, sf_dir, locks), locks, outcomes)
    # What was written now: versions of the transactions that were locks.
    return _show(versions.join(locks.select("key", "start_ts"), ["key", "start_ts"], "left_semi").select("key", "commit_ts", "op"))


@query("async_commit_recover", """
    WITH g AS (SELECT o_custkey AS start_ts, min(o_orderkey) AS p, max(o_orderkey % 1000) AS least, bool_or(o_orderkey % 13 = 0) AS missing FROM orders GROUP BY o_custkey)
    SELECT start_ts, CASE WHEN missing THEN 0 ELSE (SELECT max(o_orderkey % 1000) FROM orders o WHERE o.o_custkey = g.start_ts) END AS commit_ts FROM g""")
def async_commit_recover(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = src.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("start_ts"), codecs.encode_uint(F.col("o_orderkey")).alias("key"), F.col("o_orderkey"))
    primaries = orders.groupBy("start_ts").agg(F.min("key").alias("primary"), F.collect_list("key").alias("secondaries"))
    locks = orders.where("o_orderkey % 13 <> 0").select("key", "start_ts", (F.col("o_orderkey") % 1000).alias("min_commit_ts"))
    return transactions.async_commit_outcome(primaries, locks, _versions(spark, sf_dir))


@query("mutation_derive", """
    SELECT pessimistic, op, count(*) AS n FROM (SELECT o_orderkey % 16384 AS f, CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN '' ELSE 'v' END AS v FROM orders) t,
    (VALUES (TRUE), (FALSE)) m(pessimistic),
    LATERAL (SELECT f & 2 <> 0 AS locked, f & 64 <> 0 AS unnecessary, CASE WHEN f & 8192 <> 0 THEN 'shared_lock' ELSE 'lock' END AS lock_op) k,
    LATERAL (SELECT CASE
        WHEN v IS NULL AND NOT locked THEN NULL
        WHEN v IS NULL THEN lock_op
        WHEN v <> '' AND unnecessary AND NOT locked THEN NULL
        WHEN v <> '' AND unnecessary THEN lock_op
        WHEN v <> '' AND f & 1 <> 0 THEN 'insert'
        WHEN v <> '' THEN 'put'
        WHEN unnecessary THEN NULL
        WHEN NOT pessimistic AND f & 1 <> 0 THEN 'check_not_exists'
        WHEN f & 256 <> 0 AND NOT locked THEN NULL
        WHEN f & 256 <> 0 THEN lock_op
        ELSE 'del' END AS op) o WHERE op IS NOT NULL GROUP BY ALL""")
def mutation_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both modes of transactions, over values that are missing, empty or there and over all flags."""
    k = F.col("o_orderkey")
    value = F.when(k % 4 == 0, F.lit(None).cast("binary")).when(k % 4 == 1, F.lit(b"")).otherwise(F.lit(b"v"))
    b = src.table(spark, sf_dir, "orders").select(codecs.encode_uint(k).alias("key"), value.alias("value"), (k % 16384).cast("int").alias("flags"))
    both = [transactions.derive_mutations(b, pessimistic=p).groupBy("op").agg(F.count("*").alias("n")).withColumn("pessimistic", F.lit(p)) for p in (True, False)]
    return both[0].unionByName(both[1])


@query("flag_operations", """
    SELECT f, ((f & ~0) | 17) AS presumed, ((f & ~2048) | 8) AS value_exists, (f & 10250) AS persistent FROM (SELECT DISTINCT CAST(o_orderkey % 16384 AS INT) AS f FROM orders)""")
def flag_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = src.table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 16384).cast("int").alias("f")).distinct()
    return f.select("f", flags.apply(F.col("f"), "set_presume_not_exists").alias("presumed"), flags.apply(F.col("f"), "set_locked_value_exists").alias("value_exists"), flags.persistent(F.col("f")).alias("persistent"))


@query("lock_ttl", """
    SELECT o_orderkey, CASE WHEN b >= 16384 THEN CAST(least(greatest(CAST(floor(6000.0 * sqrt(b / 1048576.0)) AS BIGINT), 3000), 20000) AS BIGINT) ELSE 3000 END + o_orderkey % 7 AS ttl
    FROM (SELECT o_orderkey, CAST(floor(o_totalprice * 100) AS BIGINT) AS b FROM orders)""")
def lock_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = src.table(spark, sf_dir, "orders").select("o_orderkey", F.floor(F.col("o_totalprice") * 100).cast("long").alias("b"))
    return o.select("o_orderkey", tso.lock_ttl(F.col("b"), F.col("o_orderkey") % 7).alias("ttl"))


@query("commit_mode", """
    SELECT o_custkey, count(*) <= 4 AND 8 * count(*) <= 4096 AND NOT bool_or(o_orderkey % 41 = 0) AS async_commit, count(*) <= 4 AND 8 * count(*) <= 4096 AND NOT bool_or(o_orderkey % 41 = 0) AS one_phase,
    count(*) AS keys, CAST(sum(8 + octet_length(encode(o_orderstatus))) AS BIGINT) AS bytes FROM orders GROUP BY o_custkey""")
def commit_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer's orders are one transaction."""
    k = F.col("o_orderkey")
    m = src.table(spark, sf_dir, "orders").select("o_custkey", codecs.encode_uint(k).alias("key"), F.encode("o_orderstatus", "UTF-8").alias("value"), F.when(k % 41 == 0, "shared_lock").otherwise("put").alias("op"))
    return transactions.commit_modes(m, "o_custkey", async_keys=4)


@query("deadlock_cycles", """WITH RECURSIVE e AS (SELECT DISTINCT c_custkey AS waiter, c_custkey - c_custkey % 6 + (c_custkey * 5 + c_custkey // 6) % 7 AS holder FROM customer),
    r(waiter, holder) AS (SELECT waiter, holder FROM e UNION SELECT r.waiter, e.holder FROM r JOIN e ON r.holder = e.waiter) SELECT waiter FROM r WHERE waiter = holder""")
def deadlock_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers wait for one another within their six, or for the first of the next."""
    k = F.col("c_custkey")
    edges = src.table(spark, sf_dir, "customer").select(k.alias("waiter"), (k - k % 6 + (k * 5 + F.floor(k / 6)) % 7).cast("long").alias("holder"))
    return deadlock.cycles(edges)


BUFFER = """b AS (SELECT printf('%016X', CASE WHEN o_orderkey % 15 = 0 THEN o_orderkey + 10000000 ELSE o_orderkey END) AS key, CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE 'new ' || o_orderstatus END AS value, o_orderkey % 16384 AS flags, o_orderkey % 3 AS stage FROM orders WHERE o_orderkey % 5 = 0), s AS (SELECT printf('%016X', o_orderkey) AS key, o_orderstatus AS value, o_orderkey AS commit_ts FROM orders)"""


def _buffer(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = src.table(spark, sf_dir, "orders")
    return src.buffer_from_orders(orders), src.snapshot_from_orders(orders)


@query("union_read", f"WITH {BUFFER}, u AS (SELECT key, value, commit_ts FROM s WHERE key NOT IN (SELECT key FROM b) UNION ALL SELECT key, value, 0 FROM b WHERE value <> '') SELECT key, value, commit_ts FROM u")
def union_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(buf.union_read(*_buffer(spark, sf_dir)))


@query("union_reverse_scan", f"WITH {BUFFER}, u AS (SELECT key, value, commit_ts FROM s WHERE key NOT IN (SELECT key FROM b) UNION ALL SELECT key, value, 0 FROM b WHERE value <> '') SELECT key, value, commit_ts FROM u WHERE key < '{5000:016X}' ORDER BY key DESC LIMIT 100")
def union_reverse_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(buf.union_scan(*_buffer(spark, sf_dir), None, _bytes(5000), reverse=True, limit=100))


@query("union_batch_get", f"WITH {BUFFER}, u AS (SELECT key, value, commit_ts FROM s WHERE key NOT IN (SELECT key FROM b) UNION ALL SELECT key, value, 0 FROM b WHERE value <> '') SELECT key, value, commit_ts FROM u WHERE key IN (SELECT printf('%016X', o_orderkey) FROM orders WHERE o_orderkey % 4 = 0)")
def union_batch_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = src.table(spark, sf_dir, "orders").where("o_orderkey % 4 = 0").select(codecs.encode_uint(F.col("o_orderkey")).alias("key"))
    return _show(buf.union_batch_get(*_buffer(spark, sf_dir), keys))


@query("staging_release", f"WITH {BUFFER} SELECT CASE WHEN stage >= 2 THEN 1 ELSE stage END AS stage, count(*) AS n FROM b GROUP BY 1")
def staging_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    return buf.release(_buffer(spark, sf_dir)[0], 2).groupBy("stage").agg(F.count("*").alias("n"))


@query("staging_cleanup", f"WITH {BUFFER} SELECT key, value, flags FROM b WHERE stage < 2 UNION ALL SELECT key, NULL, flags & 10250 FROM b WHERE stage >= 2 AND flags & 10250 <> 0")
def staging_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(buf.discard(_buffer(spark, sf_dir)[0], 2).select("key", "value", F.col("flags").cast("long").alias("flags")))


@query("buffer_sizes", f"WITH {BUFFER} SELECT count(*) AS entries, CAST(sum(8 + length(value)) AS BIGINT) AS bytes FROM b")
def buffer_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return buf.sizes(_buffer(spark, sf_dir)[0]).select("entries", "bytes")


RAW = """r AS (SELECT c_mktsegment AS cf, printf('%016X', c_custkey) AS key, c_custkey, c_name AS value, CASE WHEN c_custkey % 5 = 0 THEN c_custkey + 100 END AS expire_at FROM customer WHERE c_custkey % 11 <> 0)"""
CF = "BUILDING"


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.raw_from_customer(src.table(spark, sf_dir, "customer"))


@query("raw_scan", f"WITH {RAW} SELECT key, value FROM r WHERE cf = '{CF}' AND key >= '{50:016X}' ORDER BY key LIMIT 100")
def raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(raw.scan(_raw(spark, sf_dir), _bytes(50), b"", 100, cf=CF))


@query("raw_reverse_scan", f"WITH {RAW} SELECT key, value FROM r WHERE cf = '{CF}' AND key < '{900:016X}' AND key >= '{20:016X}' ORDER BY key DESC LIMIT 100")
def raw_reverse_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(raw.reverse_scan(_raw(spark, sf_dir), _bytes(900), _bytes(20), 100, cf=CF))


@query("raw_batch_get_aligned", f"WITH {RAW}, k AS (SELECT o_orderkey AS pos, printf('%016X', o_custkey) AS key FROM orders) SELECT pos, key, value FROM k LEFT JOIN (SELECT key, value FROM r WHERE cf = '{CF}') USING (key)")
def raw_batch_get_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = src.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pos"), codecs.encode_uint(F.col("o_custkey")).alias("key"))
    return _show(raw.batch_get(_raw(spark, sf_dir), keys, cf=CF))


@query("raw_ttl", f"WITH {RAW}, k AS (SELECT DISTINCT printf('%016X', c_custkey) AS key FROM customer) SELECT key, CASE WHEN r.value IS NOT NULL THEN coalesce(expire_at - 300, 0) END AS ttl FROM k LEFT JOIN (SELECT * FROM r WHERE cf = '{CF}' AND (expire_at IS NULL OR expire_at > 300)) r USING (key)")
def raw_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = src.table(spark, sf_dir, "customer").select(codecs.encode_uint(F.col("c_custkey")).alias("key"))
    return _show(raw.key_ttl(_raw(spark, sf_dir), keys, 300, cf=CF))


@query("raw_delete_range", f"WITH {RAW} SELECT key, value FROM r WHERE cf = '{CF}' AND NOT (key >= '{100:016X}' AND key < '{700:016X}')")
def raw_delete_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = raw.delete_range(_raw(spark, sf_dir), _bytes(100), _bytes(700), cf=CF)
    return _show(raw.current(left, cf=CF).select("key", "value"))


@query("raw_cas", f"WITH {RAW}, q AS (SELECT printf('%016X', c_custkey) AS key, CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN c_name ELSE 'other' END AS expected FROM customer) SELECT key, expected, value AS old, value IS NOT DISTINCT FROM expected AS swapped FROM q LEFT JOIN (SELECT key, value FROM r WHERE cf = '{CF}') USING (key)")
def raw_cas(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    want = F.when(k % 3 == 0, F.lit(None)).when(k % 3 == 1, F.col("c_name")).otherwise("other")
    asked = src.table(spark, sf_dir, "customer").select(codecs.encode_uint(k).alias("key"), F.encode(want, "UTF-8").alias("expected"), F.lit(b"new").alias("new"))
    results = raw.compare_and_swap(_raw(spark, sf_dir), asked, cf=CF)[1]
    return results.select(_key(), _text("expected"), _text("old"), "swapped")


@query("raw_put_delete", f"WITH {RAW} SELECT printf('%016X', c_custkey) AS key, CASE WHEN c_custkey % 2 = 0 THEN 'even' ELSE value END AS value FROM (SELECT c_custkey, c_mktsegment, c_name AS value FROM customer) WHERE c_custkey % 7 <> 0 AND (c_custkey % 2 = 0 OR (c_custkey % 11 <> 0 AND c_mktsegment = '{CF}'))")
def raw_put_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, log = src.table(spark, sf_dir, "customer"), _raw(spark, sf_dir)
    key = codecs.encode_uint(F.col("c_custkey")).alias("key")
    log = raw.put(log, c.where("c_custkey % 2 = 0").select(key, F.lit(b"even").alias("value")), cf=CF)
    log = raw.delete(log, c.where("c_custkey % 7 = 0").select(key), cf=CF)
    return _show(raw.current(log, cf=CF).select("key", "value"))


@query("raw_checksum_counts", f"WITH {RAW} SELECT count(*) AS total_kvs, CAST(sum(8 + octet_length(encode(value))) AS BIGINT) AS total_bytes FROM r WHERE cf = '{CF}'")
def raw_checksum_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.checksum(_raw(spark, sf_dir), cf=CF, digest=False)


@query("raw_checksum_crc64", f"""WITH {RAW},
    step AS (SELECT list_transform(range(0, 256), lambda k: list_reduce(list_prepend(CAST(k AS UBIGINT), list_transform(range(0, 8), lambda i: CAST(0 AS UBIGINT))), lambda a, i: xor(a >> 1, (a & 1) * CAST({raw.POLYNOMIAL} AS UBIGINT)))) AS t),
    b AS (SELECT unhex(key) || encode(value) AS b, hex(unhex(key) || encode(value)) AS h FROM r WHERE cf = '{CF}'),
    c AS (SELECT octet_length(b) AS n, xor(CAST(18446744073709551615 AS UBIGINT), list_reduce(list_prepend(CAST(18446744073709551615 AS UBIGINT),
        list_transform(range(0, octet_length(b)), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS UBIGINT))), lambda a, x: xor(a >> 8, t[CAST(xor(a, x) & 255 AS BIGINT) + 1]))) AS crc FROM b, step),
    s AS (SELECT bit_xor(crc) AS x, count(*) AS total_kvs, CAST(sum(n) AS BIGINT) AS total_bytes FROM c)
    SELECT CASE WHEN x >= 9223372036854775808 THEN CAST(CAST(x AS HUGEINT) - 18446744073709551616 AS BIGINT) ELSE CAST(x AS BIGINT) END AS crc64_xor, total_kvs, total_bytes FROM s""")
def raw_checksum_crc64(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.checksum(_raw(spark, sf_dir), cf=CF)


REGIONS = """reg AS (SELECT r + 1 AS region_id, CASE WHEN r = 0 THEN '' ELSE printf('%016X', r * 1000) END AS lo, CASE WHEN r = most THEN '' ELSE printf('%016X', (r + 1) * 1000) END AS hi FROM (SELECT unnest(range(0, most + 1)) AS r, most FROM (SELECT max(o_orderkey // 1000) AS most FROM orders)))"""
HOLDS = "key >= lo AND (hi = '' OR key < hi)"


def _regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.regions_from_orders(src.table(spark, sf_dir, "orders"))


ASKED = """k AS (SELECT DISTINCT printf('%016X', o_orderkey * 3 // 2) AS key FROM orders)"""


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.table(spark, sf_dir, "orders").select(codecs.encode_uint(F.floor(F.col("o_orderkey") * 3 / 2).cast("long")).alias("key")).distinct()


@query("locate_key", f"WITH {REGIONS}, {ASKED} SELECT key, region_id FROM k LEFT JOIN reg ON {HOLDS}")
def locate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(regions.locate_keys(_asked(spark, sf_dir), _regions(spark, sf_dir)).select("key", "region_id"))


@query("locate_end_key", f"WITH {REGIONS}, {ASKED} SELECT key, region_id FROM k LEFT JOIN reg ON key > lo AND (hi = '' OR key <= hi)")
def locate_end_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(regions.locate_keys(_asked(spark, sf_dir), _regions(spark, sf_dir), by_end=True).select("key", "region_id"))


@query("group_keys_by_region", f"WITH {REGIONS}, {ASKED} SELECT region_id, count(*) AS keys, min(key) AS first FROM k JOIN reg ON {HOLDS} GROUP BY region_id")
def group_keys_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = regions.group_keys(_asked(spark, sf_dir), _regions(spark, sf_dir))
    return g.select("region_id", "keys", _key("first"))


@query("locate_range", f"WITH {REGIONS} SELECT region_id FROM reg WHERE (hi = '' OR hi > '{2500:016X}') AND lo < '{4000:016X}' OR (hi = '' OR hi > '{7000:016X}') AND lo < '{7001:016X}'")
def locate_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = spark.createDataFrame([(bytearray(_bytes(2500)), bytearray(_bytes(4000))), (bytearray(_bytes(7000)), bytearray(_bytes(7001)))], "lo binary, hi binary")
    return regions.locate_ranges(ranges, _regions(spark, sf_dir)).select("region_id")


@query("region_gaps", f"WITH {REGIONS}, h AS (SELECT * FROM reg WHERE region_id % 3 <> 0), o AS (SELECT lo, lag(hi) OVER (ORDER BY lo) AS before, row_number() OVER (ORDER BY lo) AS n, lead(lo) OVER (ORDER BY lo) AS nxt, hi FROM h) SELECT CASE WHEN n = 1 THEN '' ELSE before END AS lo, lo AS hi FROM o WHERE (n = 1 AND lo <> '') OR before <> lo UNION ALL SELECT hi, '' FROM o WHERE nxt IS NULL AND hi <> ''")
def region_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    holed = _regions(spark, sf_dir).where("region_id % 3 <> 0")
    return regions.gaps(holed).select(_key("lo"), _key("hi"))


@query("split_regions", f"WITH {REGIONS}, b AS (SELECT lo FROM reg UNION SELECT printf('%016X', o_orderkey) FROM orders WHERE o_orderkey % 250 = 0) SELECT lo, coalesce(lead(lo) OVER (ORDER BY lo), '') AS hi FROM b")
def split_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = src.table(spark, sf_dir, "orders").where("o_orderkey % 250 = 0").select(codecs.encode_uint(F.col("o_orderkey")).alias("key"))
    return regions.split(_regions(spark, sf_dir), keys).select(_key("lo"), _key("hi"))


@query("split_points", "WITH k AS (SELECT DISTINCT printf('%016X', o_orderkey) AS key FROM orders), n AS (SELECT key, (row_number() OVER (ORDER BY key) - 1) * 8 // (SELECT count(*) FROM k) AS tile FROM k) SELECT CAST(tile AS INT) AS tile, min(key) AS lo FROM n GROUP BY tile")
def split_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = src.table(spark, sf_dir, "orders").select(codecs.encode_uint(F.col("o_orderkey")).alias("key"))
    return regions.split_points(keys, 8).select("tile", _key("lo"))


@query("range_task_splits", f"WITH {REGIONS} SELECT greatest(lo, '{1500:016X}') AS lo, CASE WHEN hi = '' OR hi > '{5200:016X}' THEN '{5200:016X}' ELSE hi END AS hi FROM reg WHERE lo < '{5200:016X}' AND (hi = '' OR hi > '{1500:016X}')")
def range_task_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = spark.createDataFrame([(bytearray(_bytes(1500)), bytearray(_bytes(5200)))], "lo binary, hi binary")
    return maintenance.range_tasks(_regions(spark, sf_dir), ranges).select(_key("lo"), _key("hi"))


@query("min_safe_ts", """
    WITH s AS (SELECT CAST(s_nationkey % 9 AS VARCHAR) AS scope, CASE WHEN s_suppkey % 97 = 3 THEN NULL WHEN s_suppkey % 3 = 0 THEN 0 ELSE s_suppkey * 10 END AS ts FROM supplier)
    SELECT scope, CAST(CASE WHEN count(*) > count(ts) THEN 0 WHEN max(ts) = 0 THEN 0 ELSE min(ts) FILTER (ts <> 0) END AS BIGINT) AS safe_ts FROM s GROUP BY scope""")
def min_safe_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores with a time, with zero and without any."""
    k = F.col("s_suppkey")
    stores = src.table(spark, sf_dir, "supplier").select(k.alias("store_id"), (F.col("s_nationkey") % 9).cast("string").alias("scope"), F.when(k % 97 == 3, None).when(k % 3 == 0, 0).otherwise(k * 10).alias("safe_ts"))
    return maintenance.min_safe_ts(stores)


@query("tso_arithmetic", "SELECT event_id, (epoch_us(ts) // 1000) * 262144 + event_id % 262144 AS tso, epoch_us(ts) // 1000 AS physical, event_id % 262144 AS logical, (epoch_us(ts) // 1000 - 5000) * 262144 AS lower FROM events")
def tso_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = src.table(spark, sf_dir, "events")
    t = tso.compose(F.unix_millis(F.col("ts").cast("timestamp")), F.col("event_id") % 262144)
    return e.select("event_id", t.alias("tso"), tso.physical(t).alias("physical"), tso.logical(t).alias("logical"), tso.lower_limit(F.col("ts"), 5000).alias("lower"))


@query("keyspace_codec", "SELECT p_partkey, '78' || printf('%06X', 4242) || printf('%016X', p_partkey) AS encoded, printf('%016X', p_partkey) AS decoded, 4242 AS keyspace FROM part")
def keyspace_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = codecs.encode_uint(F.col("p_partkey"))
    e = codecs.encode_key(key, 4242)
    return src.table(spark, sf_dir, "part").select("p_partkey", F.hex(e).alias("encoded"), F.hex(codecs.decode_key(e, 4242)).alias("decoded"), codecs.keyspace_id(e).alias("keyspace"))


@query("int_key_codec", "SELECT p_partkey, hex(from_hex(printf('%08X', CASE WHEN v >= 0 THEN 2147483648 ELSE 2147483647 END))) || printf('%08X', CASE WHEN v >= 0 THEN v ELSE 4294967296 + v END) AS encoded, v AS decoded FROM (SELECT p_partkey, p_partkey - 500 AS v FROM part)")
def int_key_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("p_partkey") - 500
    return src.table(spark, sf_dir, "part").select("p_partkey", F.hex(codecs.encode_int(v)).alias("encoded"), codecs.decode_int(codecs.encode_int(v)).alias("decoded"))


@query("memcomparable_codec", """
    WITH p AS (SELECT p_partkey, encode(p_name) AS b FROM part), h AS (SELECT p_partkey, hex(b) AS h, octet_length(b) AS n FROM p),
    g AS (SELECT p_partkey, h, n, list_transform(range(0, n // 8 + 1), lambda k: rpad(substr(h, k * 16 + 1, 16), 16, '0') || printf('%02X', 255 - (8 - least(8, greatest(0, n - k * 8))))) AS l FROM h)
    SELECT p_partkey, array_to_string(l, '') AS encoded, h AS decoded FROM g""")
def memcomparable_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = F.encode("p_name", "UTF-8")
    return src.table(spark, sf_dir, "part").select("p_partkey", F.hex(codecs.encode_bytes(b)).alias("encoded"), F.hex(codecs.decode_bytes(codecs.encode_bytes(b))).alias("decoded"))


@query("prefix_scan", "SELECT p_partkey FROM part WHERE substr(printf('%016X', p_partkey), 1, 14) = '00000000000001'")
def prefix_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = codecs.encode_uint(F.col("p_partkey"))
    low = F.lit(bytes(6) + b"\x01")
    return src.table(spark, sf_dir, "part").where((key >= low) & (key < codecs.prefix_next_key(low))).select("p_partkey")


@query("varint_codec", "SELECT p_partkey, v AS plain, v AS comparable FROM (SELECT p_partkey, (p_partkey - 700) * 1234567 AS v FROM part)")
def varint_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = (F.col("p_partkey") - 700) * 1234567
    return src.table(spark, sf_dir, "part").select("p_partkey", codecs.decode_varint(codecs.encode_varint(v)).alias("plain"), codecs.decode_comparable_varint(codecs.encode_comparable_varint(v)).alias("comparable"))


@query("stale_starts", f"WITH {NOISY}, n AS (SELECT key, max(commit_ts) AS newest FROM versions WHERE op <> 'rollback' GROUP BY key) SELECT k.key, coalesce(newest > {READ_AT}, FALSE) AS stale FROM (SELECT DISTINCT printf('%016X', c_custkey) AS key FROM customer) k LEFT JOIN n USING (key)")
def stale_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = src.table(spark, sf_dir, "customer").select(codecs.encode_uint(F.col("c_custkey")).alias("key"), F.lit(READ_AT).alias("start_ts"))
    return _show(transactions.stale_starts(keys, _versions(spark, sf_dir)).drop("start_ts"))


# Further queries register themselves in the same tables.
from strata.plans import protocol, stores  # noqa: E402, F401
