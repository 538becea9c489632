"""Histories with known answers, and brute-force versions of what SQL cannot express."""

from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions import codecs
from strata.operators import deadlock, maintenance, mvcc, raw, transactions
from strata.sources.tables import SCHEMAS


def log(spark, rows):
    """Version rows from (op, key, value, start, commit)."""
    return spark.createDataFrame([(k.encode(), s, c, op, v.encode() if v is not None else None) for op, k, v, s, c in rows], SCHEMAS["versions"])


def put(k, v, s, c):
    return ("put", k, v, s, c)


def delete(k, s, c):
    return ("del", k, None, s, c)


SCAN = [
    put("A", "A10", 5, 10), put("C", "C10", 5, 10), put("E", "E10", 5, 10), put("B", "B20", 15, 20), put("D", "D20", 15, 20),
    delete("A", 25, 30), delete("D", 25, 30), delete("B", 35, 40), put("C", "C40", 35, 40), put("D", "D40", 35, 40),
]


@pytest.mark.parametrize(
    ("at", "lo", "hi", "limit", "reverse", "values"),
    [
        (10, b"", b"", 3, False, "A10 C10 E10"), (10, b"", b"", 0, False, ""), (10, b"A\0", b"", 3, False, "C10 E10"), (10, b"", b"C\0", 5, False, "A10 C10"), (10, b"A\0", b"C", 5, False, ""),
        (20, b"", b"", 5, False, "A10 B20 C10 D20 E10"), (20, b"B", b"D", 5, False, "B20 C10"), (30, b"", b"", 5, False, "B20 C10 E10"), (40, b"", b"", 5, False, "C40 D40 E10"),
        (100, b"", b"", 5, False, "C40 D40 E10"), (30, b"", b"Z", 5, True, "E10 C10 B20"), (30, b"", b"C", 1, True, "B20"), (30, b"", b"C\0", 5, True, "C10 B20"),
    ],
)
def test_scan(spark, at, lo, hi, limit, reverse, values):
    rows = mvcc.Snapshot(log(spark, SCAN), at).scan(lo, hi, limit=limit, reverse=reverse).collect()
    assert " ".join(bytes(r["value"]).decode() for r in rows) == values


def test_batch_get(spark):
    v = log(spark, [put("k1", "v1", 1, 2), put("k2", "v2", 1, 2), put("k2", "v2", 3, 4), put("k3", "v3", 1, 2)])
    keys = spark.createDataFrame([(b"k1",), (b"k2",), (b"k3",), (b"no",)], "key binary")
    assert {bytes(r["value"]) for r in mvcc.Snapshot(v, 5).batch_get(keys).collect()} == {b"v1", b"v2", b"v3"}


def test_garbage_collection(spark):
    v = log(spark, [
        put("k1", "v1", 1, 2), put("k1", "v2", 11, 12), put("k2", "v1", 1, 2), put("k2", "v2", 11, 12), put("k2", "v3", 101, 102),
        put("k3", "v1", 1, 2), put("k3", "v2", 11, 12), delete("k3", 101, 102), put("k4", "v1", 1, 2), delete("k4", 11, 12),
    ])
    left = {(bytes(r["key"]).decode(), r["commit_ts"]) for r in maintenance.collect_garbage(v, 100).collect()}
    assert left == {("k1", 12), ("k2", 12), ("k2", 102), ("k3", 12), ("k3", 102)}


@pytest.mark.parametrize(("lo", "hi", "left"), [(b"2", b"4", "145"), (b"5", b"5", "12345"), (b"41", b"42", "12345"), (b"4\0", b"5\0", "1234"), (b"0", b"9", "")])
def test_delete_range(spark, lo, hi, left):
    v = log(spark, [put(k, k, 1, 2) for k in "12345"])
    assert "".join(sorted(bytes(r["key"]).decode() for r in maintenance.delete_range(v, lo, hi).collect())) == left


def locks(spark, rows):
    """Lock rows from (key, primary, start)."""
    columns = [c.split()[0] for c in SCHEMAS["locks"].split(", ")]
    made = [dict.fromkeys(columns) | {"key": k.encode(), "primary": p.encode(), "start_ts": s, "op": "put", "value": b"v", "ttl_ms": 1000, "min_commit_ts": s + 1} for k, p, s in rows]
    return spark.createDataFrame([tuple(r[c] for c in columns) for r in made], SCHEMAS["locks"])


def test_scan_locks(spark):
    held = locks(spark, [("p1", "p1", 5), ("s1", "p1", 5), ("p2", "p2", 10), ("s2", "p2", 10), ("p3", "p3", 20), ("s3", "p3", 20)])
    keys = lambda df: sorted((bytes(r["key"]).decode(), r["start_ts"]) for r in df.collect())
    assert keys(transactions.scan_locks(held, 12, b"a", b"r")) == [("p1", 5), ("p2", 10)]
    assert keys(transactions.scan_locks(held, 10)) == [("p1", 5), ("p2", 10), ("s1", 5), ("s2", 10)]


def test_resolve_locks(spark):
    held = locks(spark, [("p1", "p1", 5), ("s1", "p1", 5), ("p2", "p2", 10), ("s2", "p2", 10)])
    outcomes = spark.createDataFrame([(5, 0), (10, 20)], "start_ts long, commit_ts long")
    versions, left = transactions.resolve_locks(log(spark, []), held, outcomes)
    assert left.isEmpty()
    assert {bytes(r["key"]).decode() for r in mvcc.Snapshot(versions, 30).scan().collect()} == {"p2", "s2"}
    assert mvcc.Snapshot(versions, 19).scan().isEmpty()


def test_commit_twice(spark):
    held = locks(spark, [("x", "x", 5)])
    keys = spark.createDataFrame([(b"x",)], "key binary")
    once = transactions.commit(keys, log(spark, []), held, 5, 10)
    again = transactions.commit_errors(keys, once.versions, once.locks, 5, 10)
    assert [r["error"] for r in again.collect()] == [None]
    late = transactions.commit_errors(keys, once.versions, once.locks, 7, 10)
    assert [r["error"] for r in late.collect()] == ["transaction not found"]


def test_deadlock(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 1)], "waiter long, holder long")
    assert sorted(r["waiter"] for r in deadlock.cycles(edges).collect()) == [1, 2, 3]


def _crc64(data: bytes) -> int:
    """Bit by bit, reflected, polynomial of ECMA-182."""
    c = (1 << 64) - 1
    for b in data:
        c ^= b
        for _ in range(8):
            c = (c >> 1) ^ (0xC96C5795D7870F42 if c & 1 else 0)
    return c ^ ((1 << 64) - 1)


def test_checksum(spark):
    rows = [(b"k%d" % k, b"value %d" % (k * k)) for k in range(20)] + [(b"", b""), (b"\xff\0", b"\x80")]
    kv = spark.createDataFrame(rows, "key binary, value binary")
    found = kv.select("key", "value", raw.crc64(F.col("key"), F.col("value")).alias("c")).collect()
    assert all(r["c"] & ((1 << 64) - 1) == _crc64(bytes(r["key"]) + bytes(r["value"])) for r in found)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(st.lists(st.tuples(st.binary(max_size=40), st.integers(-(1 << 63), (1 << 63) - 1)), min_size=1, max_size=40))
def test_codecs_keep_order_and_values(spark, pairs):
    df = spark.createDataFrame(pairs, "b binary, v long")
    e, i = codecs.encode_bytes(F.col("b")), codecs.encode_int(F.col("v"))
    rows = df.select("b", "v", e.alias("e"), codecs.decode_bytes(e).alias("back"), i.alias("i"), codecs.decode_int(i).alias("v2")).collect()
    assert all(bytes(r["b"]) == bytes(r["back"]) and r["v"] == r["v2"] for r in rows)
    for a in rows:
        for b in rows:
            assert (bytes(a["b"]) < bytes(b["b"])) == (bytes(a["e"]) < bytes(b["e"]))
            assert (a["v"] < b["v"]) == (bytes(a["i"]) < bytes(b["i"]))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(st.lists(st.tuples(st.sampled_from("abcd"), st.integers(1, 30), st.sampled_from(["put", "del", "rollback", "lock"])), max_size=40, unique_by=lambda x: x[:2]), st.integers(0, 32))
def test_visible_is_the_newest_write(spark, rows, at):
    v = log(spark, [(op, k, f"{k}{c}", c - 1, c) for k, c, op in rows])
    best = defaultdict(tuple)
    for k, c, op in rows:
        if c <= at and op in ("put", "del"):
            best[k] = max(best[k], (c, op))
    wanted = {k: f"{k}{c}" for k, (c, op) in best.items() if op == "put"}
    assert {bytes(r["key"]).decode(): bytes(r["value"]).decode() for r in mvcc.visible(v, at).collect()} == wanted


def test_empty_log(spark):
    v = log(spark, [])
    assert mvcc.Snapshot(v, 5).scan().isEmpty()
    assert maintenance.collect_garbage(v, 5).isEmpty()
    assert [r[0] for r in raw.checksum(spark.createDataFrame([], SCHEMAS["raw"]), digest=False).select("total_kvs").collect()] == [0]
