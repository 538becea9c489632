"""Registered queries over keys and stores: codecs, timestamps, raw mode, regions, safe points, stored tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import codecs, tso
from strata.operators import maintenance, mvcc, raw, regions
from strata.plans.catalog import CF, NOISY, RAW, READ_AT, REGIONS, _bytes, _key, _raw, _regions, _seen, _show, _ts, _versions, query
from strata.sources import tables as src


def _numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of all sizes and signs from the parts: (p_partkey, v)."""
    k = F.col("p_partkey")
    power = F.call_function("shiftleft", F.lit(1).cast("long"), (k % 62).cast("int"))
    return src.table(spark, sf_dir, "part").select("p_partkey", ((power + k) * F.when(k % 3 == 0, -1).otherwise(1)).alias("v"))


NUMBERS = "x AS (SELECT p_partkey, CAST((CAST(1 AS HUGEINT) << CAST(p_partkey % 62 AS INT)) + p_partkey AS BIGINT) * CASE WHEN p_partkey % 3 = 0 THEN -1 ELSE 1 END AS v FROM part)"
#: Two's complement of a signed number, as an unsigned one.
UNSIGNED = "CASE WHEN v < 0 THEN CAST(v AS HUGEINT) + 18446744073709551616 ELSE CAST(v AS HUGEINT) END"


@query("varint_bytes", f"""WITH {NUMBERS}, z AS (SELECT p_partkey, CASE WHEN v >= 0 THEN CAST(v AS HUGEINT) * 2 ELSE CAST(v AS HUGEINT) * -2 - 1 END AS zz, {UNSIGNED} AS u FROM x),
    b AS (SELECT p_partkey, list_transform(range(0, 10), lambda i: (zz // power128(i)) % 128) AS zd, list_transform(range(0, 10), lambda i: (u // power128(i)) % 128) AS ud FROM z),
    n AS (SELECT *, greatest(1, list_max(list_transform(range(1, 11), lambda i: CASE WHEN zd[i] <> 0 THEN i ELSE 1 END))) AS zn, greatest(1, list_max(list_transform(range(1, 11), lambda i: CASE WHEN ud[i] <> 0 THEN i ELSE 1 END))) AS un FROM b)
    SELECT p_partkey, array_to_string(list_transform(range(1, zn + 1), lambda i: printf('%02X', CAST(zd[i] + CASE WHEN i < zn THEN 128 ELSE 0 END AS INT))), '') AS signed,
        array_to_string(list_transform(range(1, un + 1), lambda i: printf('%02X', CAST(ud[i] + CASE WHEN i < un THEN 128 ELSE 0 END AS INT))), '') AS unsigned FROM n""".replace("power128(i)", "(CAST(1 AS HUGEINT) << CAST(7 * i AS INT))"))
def varint_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbers(spark, sf_dir).select("p_partkey", F.hex(codecs.encode_varint(F.col("v"))).alias("signed"), F.hex(codecs.encode_uvarint(F.col("v"))).alias("unsigned"))


@query("varint_round_trip", f"WITH {NUMBERS} SELECT p_partkey, v AS signed, v AS unsigned, v AS comparable, v AS comparable_unsigned FROM x")
def varint_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("v")
    return _numbers(spark, sf_dir).select(
        "p_partkey", codecs.decode_varint(codecs.encode_varint(v)).alias("signed"), codecs.decode_uvarint(codecs.encode_uvarint(v)).alias("unsigned"),
        codecs.decode_comparable_varint(codecs.encode_comparable_varint(v)).alias("comparable"), codecs.decode_comparable_uvarint(codecs.encode_comparable_uvarint(v)).alias("comparable_unsigned"),
    )


@query("comparable_varint_bytes", f"""WITH {NUMBERS}, h AS (SELECT p_partkey, v, printf('%016X', u >> 32) AS hi, u FROM (SELECT p_partkey, v, {UNSIGNED} AS u FROM x)),
    d AS (SELECT p_partkey, v, array_to_string(list_transform(range(7, -1, -1), lambda i: printf('%02X', CAST((u >> CAST(8 * i AS INT)) % 256 AS INT))), '') AS d FROM h),
    l AS (SELECT *, 8 - length(regexp_extract(d, '^((00)*)', 1)) // 2 AS pn, 8 - length(regexp_extract(d, '^((FF)*)', 1)) // 2 AS nn FROM d)
    SELECT p_partkey, CASE WHEN v BETWEEN 0 AND 239 THEN printf('%02X', CAST(v + 8 AS INT)) WHEN v > 0 THEN printf('%02X', CAST(247 + pn AS INT)) || right(d, pn * 2) ELSE printf('%02X', CAST(8 - greatest(nn, 1) AS INT)) || right(d, greatest(nn, 1) * 2) END AS signed,
        CASE WHEN v BETWEEN 0 AND 239 THEN printf('%02X', CAST(v + 8 AS INT)) ELSE printf('%02X', CAST(247 + pn AS INT)) || right(d, pn * 2) END AS unsigned FROM l""")
def comparable_varint_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbers(spark, sf_dir).select("p_partkey", F.hex(codecs.encode_comparable_varint(F.col("v"))).alias("signed"), F.hex(codecs.encode_comparable_uvarint(F.col("v"))).alias("unsigned"))


@query("varint_order", f"WITH {NUMBERS} SELECT p_partkey, row_number() OVER (ORDER BY v, p_partkey) AS place FROM x")
def varint_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comparable forms sort like the numbers."""
    rows = _numbers(spark, sf_dir).select("p_partkey", F.concat(codecs.encode_comparable_varint(F.col("v")), codecs.encode_uint(F.col("p_partkey"))).alias("key"))
    return mvcc.numbered(rows, "n").select("p_partkey", (F.col("n") + 1).alias("place"))


@query("falling_codecs", f"""WITH {NUMBERS}, u AS (SELECT p_partkey, v, {UNSIGNED} AS u FROM x), d AS (SELECT p_partkey, v, 18446744073709551615 - u AS fall, (18446744073709551615 - u + 9223372036854775808) % 18446744073709551616 AS fall_signed FROM u)
    SELECT p_partkey, array_to_string(list_transform(range(7, -1, -1), lambda i: printf('%02X', CAST((fall >> CAST(8 * i AS INT)) % 256 AS INT))), '') AS uint_desc, array_to_string(list_transform(range(7, -1, -1), lambda i: printf('%02X', CAST((fall_signed >> CAST(8 * i AS INT)) % 256 AS INT))), '') AS int_desc, v AS uint_back, v AS int_back FROM d""")
def falling_codecs(spark: SparkSession, sf_dir: str) -> DataFrame:
    u, i = codecs.encode_uint_desc(F.col("v")), codecs.encode_int_desc(F.col("v"))
    return _numbers(spark, sf_dir).select("p_partkey", F.hex(u).alias("uint_desc"), F.hex(i).alias("int_desc"), codecs.decode_uint_desc(u).alias("uint_back"), codecs.decode_int_desc(i).alias("int_back"))


@query("key_successors", """WITH k AS (SELECT p_partkey, encode(substr(p_name, 1, 3)) AS b, hex(encode(substr(p_name, 1, 3))) || repeat('FF', CAST(p_partkey % 3 AS INT)) AS h FROM part)
    SELECT p_partkey, h || '00' AS next, substr(hex(b), 1, length(hex(b)) - 2) || printf('%02X', CAST('0x' || right(hex(b), 2) AS INT) + 1) AS prefix_next, CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE -1 END AS compared FROM k""")
def key_successors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Successors of keys that end with none, one or two bytes FF, and their comparison with the key before those."""
    k = F.col("p_partkey")
    head = F.encode(F.substring("p_name", 1, 3), "UTF-8")
    key = F.concat(head, F.unhex(F.expr("repeat('FF', cast(p_partkey % 3 as int))")))
    return src.table(spark, sf_dir, "part").select(k, F.hex(codecs.next_key(key)).alias("next"), F.hex(codecs.prefix_next_key(key)).alias("prefix_next"), codecs.compare_keys(head, key).alias("compared"))


@query("broken_codes", "SELECT p_partkey, CAST(NULL AS VARCHAR) AS short, CAST(NULL AS VARCHAR) AS marker, CAST(NULL AS VARCHAR) AS padding, CAST(NULL AS VARCHAR) AS elsewhere FROM part")
def broken_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes that are cut off, have a wrong marker or padding, or lie in another keyspace decode to null."""
    e = codecs.encode_bytes(F.encode("p_name", "UTF-8"))
    broken = {
        "short": e.substr(F.lit(1), F.octet_length(e) - 1), "marker": F.concat(e.substr(F.lit(1), F.octet_length(e) - 1), F.lit(b"\x10")),
        "padding": F.concat(e.substr(F.lit(1), F.octet_length(e) - 9), F.unhex(F.lit("0102030405060708F7"))),
    }
    other = codecs.decode_key(codecs.encode_key(F.encode("p_name", "UTF-8"), 7), 8)
    return src.table(spark, sf_dir, "part").select("p_partkey", *[F.hex(codecs.decode_bytes(b)).alias(c) for c, b in broken.items()], F.hex(other).alias("elsewhere"))


@query("region_key_codec", """WITH k AS (SELECT p_partkey, '78000007' || printf('%016X', p_partkey) AS h FROM part)
    SELECT p_partkey, substr(h, 1, 16) || 'FF' || rpad(substr(h, 17), 16, '0') || 'FB' AS encoded, substr(h, 9) AS decoded, '78000007' AS prefix, substr(h, 9) AS rest FROM k""")
def region_key_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = codecs.encode_uint(F.col("p_partkey"))
    e = codecs.encode_region_key(key, 7)
    parts = codecs.split_key(codecs.encode_key(key, 7), True)
    return src.table(spark, sf_dir, "part").select("p_partkey", F.hex(e).alias("encoded"), F.hex(codecs.decode_region_key(e, 7)).alias("decoded"), F.hex(parts["prefix"]).alias("prefix"), F.hex(parts["key"]).alias("rest"))


@query("keyspace_ranges", """WITH k AS (SELECT p_partkey AS k, p_partkey % 5 AS st FROM part)
    SELECT k, CASE st WHEN 0 THEN printf('%016X', k) WHEN 1 THEN '' WHEN 2 THEN printf('%016X', k) WHEN 3 THEN '' END AS lo, CASE st WHEN 0 THEN printf('%016X', k + 1) WHEN 1 THEN printf('%016X', k) WHEN 2 THEN '' WHEN 3 THEN '' END AS hi FROM k""")
def keyspace_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of stored keys, clipped to a keyspace: inside, from before it, to beyond it, around it, and outside."""
    k = F.col("p_partkey")
    inside = lambda x: codecs.encode_key(codecs.encode_uint(x), 7)
    before, after, beyond = (F.lit(codecs.keyspace_prefix(n)) for n in (6, 8, 9))
    st = k % 5
    lo = F.when(st.isin(0, 2), inside(k)).when(st.isin(1, 3), before).otherwise(after)
    hi = F.when(st == 0, inside(k + 1)).when(st == 1, inside(k)).when(st == 2, beyond).when(st == 3, F.lit(b"")).otherwise(beyond)
    a, b = codecs.decode_range(lo, hi, 7)
    return src.table(spark, sf_dir, "part").select(k.alias("k"), F.hex(a).alias("lo"), F.hex(b).alias("hi"))


@query("bucket_borders", """WITH k AS (SELECT p_partkey AS k FROM part) SELECT k, CASE k % 3 WHEN 0 THEN ',' || printf('%016X', k) || ',' WHEN 1 THEN ',' || printf('%016X', k) || ',' ELSE printf('%016X', k) || ',' || printf('%016X', k + 1) END AS borders FROM k""")
def bucket_borders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Borders of buckets that begin before the keyspace, with its very start among them, or lie within."""
    k = F.col("p_partkey")
    inside = lambda x: codecs.encode_region_key(codecs.encode_uint(x), 7)
    start, before, after = (codecs.encode_bytes(F.lit(codecs.keyspace_prefix(n))) for n in (7, 6, 8))
    borders = F.when(k % 3 == 0, F.array(before, inside(k), after)).when(k % 3 == 1, F.array(before, start, inside(k), F.lit(b""))).otherwise(F.array(inside(k), inside(k + 1)))
    return src.table(spark, sf_dir, "part").select(k.alias("k"), F.array_join(F.transform(codecs.decode_bucket_keys(borders, 7), F.hex), ",").alias("borders"))


@query("formats", """WITH n AS (SELECT o_orderkey AS k, CASE o_orderkey % 6 WHEN 0 THEN o_orderkey WHEN 1 THEN o_orderkey * 1024 WHEN 2 THEN o_orderkey * 1000003 WHEN 3 THEN CAST(1073741824 AS BIGINT) * (o_orderkey % 90 + 1) WHEN 4 THEN CAST(1048576 AS BIGINT) * (o_orderkey % 9) + 512 * 1024 ELSE 1024 * (o_orderkey % 20) END AS n FROM orders),
    u AS (SELECT k, n, CAST(CASE WHEN n > 1073741824 THEN 1073741824 WHEN n > 1048576 THEN 1048576 WHEN n > 1024 THEN 1024 ELSE 1 END AS BIGINT) AS u FROM n)
    SELECT k, CASE WHEN n % u = 0 THEN CAST(n // u AS VARCHAR) WHEN n < 10 * u THEN printf('%.2f', n / u) ELSE printf('%.1f', n / u) END || CASE u WHEN 1073741824 THEN ' GB' WHEN 1048576 THEN ' MB' WHEN 1024 THEN ' KB' ELSE ' Bytes' END AS bytes FROM u""")
def formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    n = F.when(k % 6 == 0, k).when(k % 6 == 1, k * 1024).when(k % 6 == 2, k * 1_000_003).when(k % 6 == 3, F.lit(1 << 30) * (k % 90 + 1)).when(k % 6 == 4, F.lit(1 << 20) * (k % 9) + 512 * 1024).otherwise(F.lit(1024) * (k % 20))
    return src.table(spark, sf_dir, "orders").select(k.alias("k"), codecs.format_bytes(n.cast("long")).alias("bytes"))


@query("tso_of_times", "SELECT event_id, (epoch_us(ts) // 1000) * 262144 AS tso, (epoch_us(ts) // 1000) AS back_ms, event_id % 7 <= 3 AS expired, CAST(3 - event_id % 7 AS BIGINT) * -1 AS until FROM events")
def tso_of_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times to timestamps and back; a lock of 3 ms to 9 ms, 6 ms ago, by the client's rule."""
    t = tso.from_time(F.col("ts"))
    ttl = (F.col("event_id") % 7 + 3).cast("long")
    now = t + (6 << tso.LOGICAL_BITS)
    return src.table(spark, sf_dir, "events").select("event_id", t.alias("tso"), F.unix_millis(tso.to_time(t)).alias("back_ms"), tso.is_expired(t, ttl, now).alias("expired"), tso.until_expired(t, ttl, now).alias("until"))


@query("gc_times", "SELECT event_id, epoch_us(date_trunc('second', ts)) // 1000 AS zoned, epoch_us(date_trunc('second', ts)) // 1000 AS named FROM events")
def gc_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both text forms of a collection time."""
    text = F.date_format("ts", "yyyyMMdd-HH:mm:ss")
    both = [F.unix_millis(tso.parse_gc_time(F.concat(text, F.lit(end)))).alias(name) for name, end in (("zoned", " +0000"), ("named", " +0000 UTC"))]
    return src.table(spark, sf_dir, "events").select("event_id", *both)


@query("raw_point_get", f"WITH {RAW} SELECT value FROM r WHERE cf = '{CF}' AND c_custkey = (SELECT min(c_custkey) FROM r WHERE cf = '{CF}')")
def raw_point_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _raw(spark, sf_dir)
    key = raw.scan(log, limit=1, cf=CF).first()["key"]
    return raw.get(log, bytes(key), cf=CF).select(F.decode("value", "UTF-8").alias("value"))


@query("raw_scan_keys", f"WITH {RAW} SELECT key FROM r WHERE cf = '{CF}' AND key >= '{10:016X}' AND (expire_at IS NULL OR expire_at > 300) ORDER BY key LIMIT 200")
def raw_scan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(raw.scan(_raw(spark, sf_dir), _bytes(10), b"", 200, cf=CF, key_only=True, now=300))


@query("raw_put_ttl", f"""WITH {RAW}, q AS (SELECT printf('%016X', o_custkey) AS key, arg_max(o_orderkey, o_orderkey) AS last FROM orders GROUP BY o_custkey),
    a AS (SELECT key, 'w' || last AS value, CASE WHEN last % 3 = 0 THEN NULL ELSE 50 + last % 3 * 10 END AS expire_at FROM q UNION ALL SELECT key, value, expire_at FROM r WHERE cf = '{CF}' AND key NOT IN (SELECT key FROM q))
    SELECT key, value, expire_at FROM a WHERE expire_at IS NULL OR expire_at > 65""")
def raw_put_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that writes keys again and again, with and without a time to live: the last write of a key counts."""
    k = F.col("o_orderkey")
    rows = src.table(spark, sf_dir, "orders").select(codecs.encode_uint(F.col("o_custkey")).alias("key"), F.encode(F.concat(F.lit("w"), k.cast("string")), "UTF-8").alias("value"), (k % 3 * 10).alias("ttl"), k.alias("pos"))
    return _show(raw.current(raw.put(_raw(spark, sf_dir), rows, cf=CF, now=50), cf=CF, now=65))


@query("raw_cas_log", f"WITH {RAW}, o AS (SELECT c_custkey, printf('%016X', c_custkey) AS key, c_name, (SELECT value FROM r WHERE r.cf = '{CF}' AND r.c_custkey = customer.c_custkey) AS old FROM customer) SELECT key, CASE WHEN old IS NOT DISTINCT FROM CASE WHEN c_custkey % 2 = 0 THEN c_name END THEN 'new' ELSE old END AS value FROM o WHERE old IS NOT NULL OR c_custkey % 2 = 1")
def raw_cas_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the log holds after the swaps: even keys expect their value, odd ones to be missing."""
    k = F.col("c_custkey")
    asked = src.table(spark, sf_dir, "customer").select(codecs.encode_uint(k).alias("key"), F.encode(F.when(k % 2 == 0, F.col("c_name")), "UTF-8").alias("expected"), F.lit(b"new").alias("new"))
    log, _ = raw.compare_and_swap(_raw(spark, sf_dir), asked, cf=CF)
    return _show(raw.current(log, cf=CF).select("key", "value"))


@query("next_regions", f"WITH {REGIONS} SELECT region_id, lo, hi FROM reg WHERE hi = '' OR hi > '{2500:016X}' ORDER BY lo LIMIT 3")
def next_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.next_regions(_regions(spark, sf_dir), _bytes(2500), 3).select("region_id", _key("lo"), _key("hi"))


@query("contiguous_regions", f"WITH {REGIONS}, k AS (SELECT * FROM reg WHERE region_id % 5 <> 0 AND (hi = '' OR hi > '{500:016X}')) SELECT region_id FROM k WHERE region_id < coalesce((SELECT min(region_id) FROM reg WHERE region_id % 5 = 0), 1000000)")
def contiguous_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the region of a key up to the first that is missing."""
    return regions.contiguous_from(_regions(spark, sf_dir).where("region_id % 5 <> 0"), _bytes(500)).select("region_id")


@query("merge_regions", f"WITH {REGIONS} SELECT region_id, lo, CASE WHEN region_id = 1 THEN (SELECT hi FROM reg WHERE region_id = 2) ELSE hi END AS hi FROM reg WHERE region_id <> 2")
def merge_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.merge(_regions(spark, sf_dir), 1, 2).select("region_id", _key("lo"), _key("hi"))


@query("locate_buckets", f"""WITH {REGIONS}, k AS (SELECT DISTINCT printf('%016X', o_orderkey) AS key FROM orders), b AS (SELECT region_id, lo AS blo, printf('%016X', (region_id - 1) * 1000 + 500) AS bhi FROM reg UNION ALL SELECT region_id, printf('%016X', (region_id - 1) * 1000 + 500), hi FROM reg)
    SELECT key, b.region_id, blo AS bucket FROM k JOIN b ON key >= blo AND (bhi = '' OR key < bhi)""")
def locate_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two buckets a region."""
    reg = _regions(spark, sf_dir)
    middle = codecs.encode_uint((F.col("region_id") - 1) * 1000 + 500)
    buckets = reg.select("region_id", "lo", middle.alias("hi")).unionByName(reg.select("region_id", middle.alias("lo"), "hi"))
    keys = src.table(spark, sf_dir, "orders").select(codecs.encode_uint(F.col("o_orderkey")).alias("key")).distinct()
    found = regions.locate_buckets(regions.locate_keys(keys, reg).select("key", "region_id"), buckets)
    return found.select(_key(), "region_id", _key("bucket_lo").alias("bucket"))


@query("region_properties", f"""WITH {NOISY}, t AS (SELECT CAST(user_id // 20 + 1 AS BIGINT) AS region_id, * FROM versions)
    SELECT region_id, count(*) AS records, count(*) FILTER (op = 'put') AS puts, count(*) FILTER (op = 'del') AS deletes, CAST(sum(8 + length(value)) AS BIGINT) AS bytes, count(DISTINCT key) AS keys, max(commit_ts) AS newest FROM t GROUP BY region_id""")
def region_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions of twenty users."""
    v = _versions(spark, sf_dir)
    starts = v.select(F.floor(codecs.decode_uint(F.col("key")) / 20).cast("long").alias("r")).distinct()
    reg = starts.select((F.col("r") + 1).alias("region_id"), codecs.encode_uint(F.col("r") * 20).alias("lo"), codecs.encode_uint(F.col("r") * 20 + 20).alias("hi"))
    return maintenance.region_properties(v, reg)


@query("touched_regions", f"WITH {REGIONS} SELECT count(*) AS regions FROM reg WHERE lo < '{5200:016X}' AND (hi = '' OR hi > '{1500:016X}')")
def touched_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = maintenance.touched_regions(_regions(spark, sf_dir), _bytes(1500), _bytes(5200))
    return spark.range(1).select(F.lit(n).cast("long").alias("regions"))


@query("advance_safe_ts", "SELECT s_suppkey AS store_id, CAST(s_nationkey AS VARCHAR) AS scope, greatest(s_suppkey * 10, 5000 - s_suppkey) AS safe_ts FROM supplier")
def advance_safe_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    at = lambda ts: src.table(spark, sf_dir, "supplier").select(k.alias("store_id"), F.col("s_nationkey").cast("string").alias("scope"), ts.alias("safe_ts"))
    return maintenance.advance_safe_ts(at(k * 10), at(5000 - k))


@query("safe_points", "SELECT 'gc_safe_point' AS name, CAST(900 AS BIGINT) AS ts, CAST(900 AS BIGINT) AS loaded UNION ALL SELECT 'other', 7, 900")
def safe_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Safe points never go back."""
    meta = spark.createDataFrame([("other", 7)], "name string, ts long")
    for ts in (500, 900, 300):
        meta = maintenance.save_safe_point(meta, ts)
    return meta.withColumn("loaded", F.lit(maintenance.load_safe_point(meta)))


@query("least_of_groups", "SELECT min(ts) AS ts FROM (SELECT CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_suppkey + 41 END AS ts FROM supplier)")
def least_of_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return maintenance.least_of_groups(src.table(spark, sf_dir, "supplier").select(F.when(k % 3 != 0, k + 41).cast("long").alias("ts")))


@query("range_handler", f"WITH {NOISY} SELECT count(*) AS records, CAST(sum(length(value)) AS BIGINT) AS bytes FROM versions")
def range_handler(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A handler that runs once for each range of keys and counts what it is given."""

    def count(batches):
        import pyarrow as pa

        for batch in batches:
            sizes = [len(v.as_py()) for v in batch.column("value")]
            yield pa.RecordBatch.from_arrays([pa.array([len(sizes)], pa.int64()), pa.array([sum(sizes)], pa.int64())], ["records", "bytes"])

    found = maintenance.run_on_ranges(_versions(spark, sf_dir), count, "records long, bytes long", 4)
    return found.agg(F.sum("records").alias("records"), F.sum("bytes").alias("bytes"))


def _root(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="strata-")
    return f"{folder.rstrip('/')}/published-{uuid.uuid4().hex}"


@query("stored_range_scan", f"WITH {NOISY}, {_seen(READ_AT)} SELECT key, value, commit_ts FROM seen WHERE key >= '{30:016X}' AND key < '{90:016X}'")
def stored_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same scan over a stored, sorted log: the range reaches the scan and prunes row groups."""
    root = _root(spark)
    src.publish(spark, root, {"versions": _versions(spark, sf_dir)})
    return _show(mvcc.Snapshot(src.published(spark, root)["versions"], READ_AT).scan(_bytes(30), _bytes(90)).drop("error"))


@query("published_states", f"WITH {NOISY} SELECT (SELECT count(*) FROM versions) AS first, (SELECT count(*) FROM versions WHERE NOT (key >= '{20:016X}' AND key < '{60:016X}')) AS later")
def published_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader of the first state keeps it while a range is destroyed."""
    root = _root(spark)
    src.publish(spark, root, {"versions": _versions(spark, sf_dir)})
    first = src.published(spark, root)["versions"]
    src.destroy_range(spark, root, _bytes(20), _bytes(60))
    later = src.published(spark, root)["versions"]
    return first.agg(F.count("*").alias("first")).join(later.agg(F.count("*").alias("later")))


@query("check_visibility", f"SELECT {_ts(3)} < {_ts(10)} AS refused, TRUE AS read")
def check_visibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot before the collected history is refused, one after it is not."""

    def open_at(ts: int) -> bool:
        try:
            mvcc.Snapshot(_versions(spark, sf_dir), ts, gc_safe_point=_ts(10))
        except ValueError:
            return False
        return True

    return spark.range(1).select(F.lit(not open_at(_ts(3))).alias("refused"), F.lit(open_at(_ts(12))).alias("read"))


@query("split_errors", f"""WITH {NOISY}, {_seen(_ts(29))} SELECT (SELECT count(*) FROM seen WHERE key NOT IN (SELECT key FROM versions WHERE commit_ts > {_ts(29)})) AS found, (SELECT count(DISTINCT key) FROM versions WHERE commit_ts > {_ts(29)}) AS errors""")
def split_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mvcc.Snapshot(_versions(spark, sf_dir), _ts(15), isolation=mvcc.RC_CHECK_TS).at(_ts(29))
    rows.isolation = mvcc.RC_CHECK_TS
    good, bad = mvcc.split_errors(rows.scan())
    return good.agg(F.count("*").alias("found")).join(bad.agg(F.count("*").alias("errors")))
