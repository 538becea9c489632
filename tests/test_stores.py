"""Display forms, published states, components of waits, and checksums of long values, against known answers or brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strata.functions import codecs
from strata.operators import deadlock, maintenance, mvcc, raw, regions
from strata.sources import tables as src

#: Durations in nanoseconds and how they are shown.
DURATIONS = {
    0: "0s", 999: "999ns", 1000: "1µs", 100_450: "100.5µs", 9_412_345: "9.41ms", 10_412_345: "10.4ms", 999_999_999: "1s", 5_999_000_000: "6s", 1_500_000_000: "1.5s",
    90_000_000_000: "1m30s", 65_250_000_000: "1m5.3s", 7_200_000_000_000: "2h0m0s", 3_661_000_000_000: "1h1m1s",
}
#: Numbers of bytes and how they are shown.
SIZES = {0: "0 Bytes", 1024: "1024 Bytes", 2048: "2 KB", 1536: "1.50 KB", 20_000: "19.5 KB", 1 << 20: "1024 KB", 5 << 30: "5 GB", 3 << 40: "3072 GB"}


def test_display_forms(spark):
    rows = spark.createDataFrame([(k,) for k in DURATIONS], "n long").select("n", codecs.format_duration(F.col("n")).alias("s")).collect()
    assert {r["n"]: r["s"] for r in rows} == DURATIONS
    rows = spark.createDataFrame([(k,) for k in SIZES], "n long").select("n", codecs.format_bytes(F.col("n")).alias("s")).collect()
    assert {r["n"]: r["s"] for r in rows} == SIZES


@pytest.mark.parametrize("stores", [[(0, "a"), (50, "a"), (70, "a")], [(None, "a"), (50, "a")], [(0, "a"), (0, "a")], [(5, "a"), (3, "a")]])
def test_min_safe_ts(spark, stores):
    rows = spark.createDataFrame([(k, scope, ts) for k, (ts, scope) in enumerate(stores)], "store_id long, scope string, safe_ts long")
    wanted = 0 if any(t is None for t, _ in stores) else min((t for t, _ in stores if t), default=0)
    assert [r["safe_ts"] for r in maintenance.min_safe_ts(rows).collect()] == [wanted]


def test_published_state_is_replaced_at_once(spark, tmp_path):
    root = str(tmp_path / "set")
    rows = spark.createDataFrame([(b"a", 1, 2, "put", b"1"), (b"b", 1, 2, "put", b"2"), (b"c", 1, 2, "put", b"3")], src.SCHEMAS["versions"])
    src.publish(spark, root, {"versions": rows})
    old = src.published(spark, root)["versions"]
    src.destroy_range(spark, root, b"b", b"c")
    assert old.count() == 3
    assert sorted(bytes(r["key"]) for r in src.published(spark, root)["versions"].collect()) == [b"a", b"c"]


@pytest.mark.parametrize("seed", range(2))
def test_cycles_against_brute_force(spark, seed):
    rng = random.Random(seed)
    edges = {(rng.randrange(30), rng.randrange(30)) for _ in range(40)} | {(100 + k, 100 + (k + 1) % 7) for k in range(7)} | {(106, 200), (200, 201), (50, 50)}
    reach = set(edges)
    while more := {(a, d) for a, b in reach for c, d in edges if b == c} - reach:
        reach |= more
    found = deadlock.cycles(spark.createDataFrame(sorted(edges), "waiter long, holder long"))
    assert sorted(r["waiter"] for r in found.collect()) == sorted(a for a, b in reach if a == b)


def test_checksum_of_unequal_lengths(spark):
    table = []
    for k in range(256):
        for _ in range(8):
            k = (k >> 1) ^ (raw.POLYNOMIAL if k & 1 else 0)
        table.append(k)

    def plain(data):
        c = (1 << 64) - 1
        for b in data:
            c = table[(c ^ b) & 255] ^ (c >> 8)
        return c ^ ((1 << 64) - 1)

    rng = random.Random(3)
    values = [rng.randbytes(n) for n in [0, 1, 2, 50_000, *[rng.randrange(90) for _ in range(200)]]]
    rows = spark.createDataFrame([(b"k", v) for v in values] + [(b"k", None)], "key binary, value binary").select("value", raw.crc64(F.col("key"), F.col("value")).alias("c")).collect()
    for r in rows:
        assert r["c"] is None if r["value"] is None else r["c"] & ((1 << 64) - 1) == plain(b"k" + bytes(r["value"]))


def test_overlaps_with_holes_and_open_ends(spark):
    reg = [(1, b"b", b"d"), (2, b"d", b"f"), (3, b"h", b"k"), (4, b"m", b"")]
    asked = [(b"", b""), (b"", b"a"), (b"a", b"b"), (b"c", b"e"), (b"f", b"h"), (b"g", b"i"), (b"z", b""), (b"d", b"d\x00"), (b"l", b"m")]
    end = lambda h: h or b"\xff" * 64
    want = sorted((a, b, k) for a, b in asked for k, lo, hi in reg if lo < end(b) and a < end(hi))
    rows = regions.overlapping(spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in asked], "lo binary, hi binary"), spark.createDataFrame([(k, bytearray(a), bytearray(b)) for k, a, b in reg], src.SCHEMAS["regions"]))
    assert sorted((bytes(r["a"]), bytes(r["b"]), r["region_id"]) for r in rows.collect()) == want


def test_moments(spark):
    v = spark.createDataFrame([(b"a", 1, 5, "put", b"1"), (b"a", 6, 9, "del", None), (b"a", 10, 12, "put", b"2"), (b"b", 6, 7, "put", b"3"), (b"b", 20, 30, "put", b"4")], src.SCHEMAS["versions"])
    moments = spark.createDataFrame([(t,) for t in (1, 5, 8, 9, 11, 12, 29, 12)], "ts long")
    got = sorted((r["ts"], bytes(r["key"]), bytes(r["value"])) for r in mvcc.read_at_each(v, moments).collect())
    want = sorted((t, bytes(r["key"]), bytes(r["value"])) for t in {1, 5, 8, 9, 11, 12, 29} for r in mvcc.visible(v, t).collect())
    assert got == want
