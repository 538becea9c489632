"""Raw mode: one value per key and column family, from a log of puts and deletes.

``raw``: cf, key, value, op (put, del), seq, expire_at (seconds; null: never).  The newest ``seq`` of
a key counts.  A null value in a result means missing; an empty value is a value.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.mvcc import in_range

DEFAULT_CF = "default"
MOST_SCANNED = 10_240


def current(raw: DataFrame, *, cf: str = DEFAULT_CF, now: int | None = None, lo: bytes | None = None, hi: bytes | None = None) -> DataFrame:
    """(key, value, expire_at) of the live keys of a column family, in a range."""
    rows = raw.where((F.col("cf") == cf) & in_range(F.col("key"), lo, hi))
    newest = rows.groupBy("key").agg(F.max_by(F.struct("op", "value", "expire_at"), "seq").alias("v")).where("v.op = 'put'")
    live = newest.select("key", F.coalesce("v.value", F.lit(b"")).alias("value"), "v.expire_at")
    return live if now is None else live.where(F.col("expire_at").isNull() | (F.col("expire_at") > now))


def _one(key: bytes) -> tuple[bytes, bytes]:
    return key, key + b"\x00"


def get(raw: DataFrame, key: bytes, *, cf: str = DEFAULT_CF, now: int | None = None) -> DataFrame:
    lo, hi = _one(key)
    return current(raw, cf=cf, now=now, lo=lo, hi=hi).select("value")


def batch_get(raw: DataFrame, keys: DataFrame, *, cf: str = DEFAULT_CF, now: int | None = None) -> DataFrame:
    """(pos, key, value) for every asked (pos, key), repeats included; null where missing."""
    wanted = keys.select("key").distinct()
    found = current(raw.join(wanted, "key", "left_semi"), cf=cf, now=now).select("key", "value")
    return keys.join(found, "key", "left").select("pos", "key", "value")


def key_ttl(raw: DataFrame, keys: DataFrame, now: int, *, cf: str = DEFAULT_CF) -> DataFrame:
    """(key, ttl): seconds left; 0 without expiry; null where missing or expired."""
    found = current(raw.join(keys.select("key").distinct(), "key", "left_semi"), cf=cf, now=now)
    return keys.select("key").join(found, "key", "left").select("key", F.when(F.col("value").isNotNull(), F.coalesce(F.greatest(F.col("expire_at") - now, F.lit(0)), F.lit(0))).alias("ttl"))


def scan(raw: DataFrame, lo: bytes = b"", hi: bytes = b"", limit: int = MOST_SCANNED, *, cf: str = DEFAULT_CF, key_only: bool = False, now: int | None = None) -> DataFrame:
    """First keys of ``[lo, hi)`` in order."""
    _check(limit)
    rows = current(raw, cf=cf, now=now, lo=lo, hi=hi)
    return rows.select("key", *["value"] * (not key_only)).orderBy("key").limit(limit)


def reverse_scan(raw: DataFrame, start: bytes, end: bytes = b"", limit: int = MOST_SCANNED, *, cf: str = DEFAULT_CF, key_only: bool = False, now: int | None = None) -> DataFrame:
    """Last keys of ``[end, start)`` in falling order; an empty start holds nothing."""
    _check(limit)
    rows = current(raw, cf=cf, now=now, lo=end, hi=start)
    if not start:
        rows = rows.where(F.lit(False))
    return rows.select("key", *["value"] * (not key_only)).orderBy(F.desc("key")).limit(limit)


def _check(limit: int) -> None:
    if limit > MOST_SCANNED:
        raise ValueError(f"a scan returns at most {MOST_SCANNED} keys")


def put(raw: DataFrame, rows: DataFrame, *, cf: str = DEFAULT_CF, now: int = 0) -> DataFrame:
    """Append (key, value[, ttl][, pos]) as puts; of a repeated key the last ``pos`` wins; ttl 0 never expires."""
    ttl = F.col("ttl") if "ttl" in rows.columns else F.lit(0)
    pos = F.col("pos") if "pos" in rows.columns else F.lit(0)
    last = rows.groupBy("key").agg(F.max_by(F.struct(F.col("value").alias("value"), ttl.alias("ttl")), pos).alias("v"))
    new = last.select(F.lit(cf).alias("cf"), "key", F.coalesce("v.value", F.lit(b"")).alias("value"), F.lit("put").alias("op"), F.when(F.col("v.ttl") > 0, F.col("v.ttl") + now).cast("long").alias("expire_at"))
    return append(raw, new)


def delete(raw: DataFrame, keys: DataFrame, *, cf: str = DEFAULT_CF) -> DataFrame:
    return append(raw, keys.select("key").distinct().select(F.lit(cf).alias("cf"), "key", F.lit(None).cast("binary").alias("value"), F.lit("del").alias("op"), F.lit(None).cast("long").alias("expire_at")))


def append(raw: DataFrame, new: DataFrame) -> DataFrame:
    """The log with new rows after all others."""
    after = raw.agg(F.coalesce(F.max("seq"), F.lit(0)).alias("__s"))
    return raw.unionByName(new.join(F.broadcast(after)).withColumn("seq", F.col("__s") + 1).drop("__s").select(*raw.columns))


def delete_range(raw: DataFrame, lo: bytes = b"", hi: bytes = b"", *, cf: str = DEFAULT_CF) -> DataFrame:
    """Without the rows of ``[lo, hi)`` of one column family."""
    if hi and lo >= hi:
        return raw
    return raw.where(~((F.col("cf") == cf) & in_range(F.col("key"), lo, hi)))


def compare_and_swap(raw: DataFrame, requests: DataFrame, *, cf: str = DEFAULT_CF, now: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(new log, results): requests (key, expected, new) swap where the current value equals ``expected``; null: must be missing.

    One request a key; results tell the old value and whether it was swapped.
    """
    old = current(raw.join(requests.select("key"), "key", "left_semi"), cf=cf, now=now).select("key", F.col("value").alias("old"))
    results = requests.join(old, "key", "left").select("key", "expected", "old", F.col("old").eqNullSafe(F.col("expected")).alias("swapped"), "new")
    return put(raw, results.where("swapped").select("key", F.col("new").alias("value")), cf=cf), results.drop("new")


#: Fixed value: the reversed polynomial of CRC-64/ECMA.
POLYNOMIAL = 0xC96C5795D7870F42


#: Rows whose byte at one place is worked out together; fewer are finished one by one.
TOGETHER = 32


def crc64(key: Column, value: Column) -> Column:
    """CRC-64/ECMA of key followed by value; its bits as a long; null if one of them is.

    Rows are sorted by length and stepped through together, a byte at a time over all rows that have it.
    """
    table = np.arange(256, dtype=np.uint64)
    for _ in range(8):
        table = (table >> np.uint64(1)) ^ ((table & np.uint64(1)) * np.uint64(POLYNOMIAL))

    def digests(blobs: pd.Series) -> pd.Series:
        there = blobs.notna().to_numpy()
        own = [bytes(b) for b in blobs[there]]
        sizes = np.array([len(b) for b in own], dtype=np.int64)
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        data = np.frombuffer(b"".join(own[k] for k in order), dtype=np.uint8)
        begins = np.cumsum(sizes) - sizes
        crc = np.full(len(own), (1 << 64) - 1, dtype=np.uint64)
        at = 0
        while (active := int(np.searchsorted(-sizes, -at, side="left"))) > TOGETHER:
            now = crc[:active]
            crc[:active] = table[(now ^ data[begins[:active] + at]) & np.uint64(255)] ^ (now >> np.uint64(8))
            at += 1
        numbers = table.tolist()
        for k in range(active):
            c = int(crc[k])
            for byte in own[order[k]][at:]:
                c = numbers[(c ^ byte) & 255] ^ c >> 8
            crc[k] = c
        out = np.zeros(len(own), dtype=np.int64)
        out[order] = (~crc).view(np.int64)
        found = pd.array(np.zeros(len(blobs), dtype=np.int64), dtype="Int64")
        found[there] = out
        found[~there] = pd.NA
        return pd.Series(found)

    return F.pandas_udf(digests, "long")(F.concat(key, value))


def checksum(raw: DataFrame, lo: bytes = b"", hi: bytes = b"", *, cf: str = DEFAULT_CF, now: int | None = None, prefix_bytes: int = 0, digest: bool = True) -> DataFrame:
    """One row: crc64_xor, total_kvs, total_bytes over a range; ``prefix_bytes`` counts a keyspace prefix per key."""
    rows = current(raw, cf=cf, now=now, lo=lo, hi=hi)
    size = F.sum(F.octet_length("key") + F.octet_length("value") + F.lit(prefix_bytes))
    sums = [F.count("*").alias("total_kvs"), F.coalesce(size, F.lit(0)).cast("long").alias("total_bytes")]
    if digest:
        sums.insert(0, F.coalesce(F.bit_xor(crc64(F.col("key"), F.col("value"))), F.lit(0)).alias("crc64_xor"))
    return rows.agg(*sums)
