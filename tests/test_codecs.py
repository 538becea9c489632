"""Codecs on odd values, and how often they work out their input."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata.functions import codecs

NUMBERS = [s * ((1 << k) + d) for k in range(63) for s in (1, -1) for d in (-1, 0, 1)] + [239, 240, -(1 << 63)]


def named(df, column) -> int:
    """How often the plan of a column names the input ``x``."""
    return df.select(column.alias("y"))._jdf.queryExecution().analyzed().toString().split("\n")[0].count("x#")


@pytest.mark.parametrize("kind", ["varint", "uvarint", "comparable_varint", "comparable_uvarint"])
def test_varints_work_out_their_input_once(spark, kind):
    df = spark.createDataFrame([(v,) for v in [*NUMBERS, None]], "x long")
    code, back = getattr(codecs, f"encode_{kind}"), getattr(codecs, f"decode_{kind}")
    # Zig-zag names it twice.
    assert named(df, back(code(F.col("x")))) <= 2
    assert all(r["x"] == r["y"] for r in df.select("x", back(code(F.col("x"))).alias("y")).collect())


def test_broken_varints(spark):
    broken = [b"", b"\x80", b"\xff" * 10, b"\x80" * 10 + b"\x01"]
    df = spark.createDataFrame([(bytearray(b),) for b in broken], "x binary")
    assert all(r["y"] is None for r in df.select(codecs.decode_uvarint(F.col("x")).alias("y")).collect())
    df = spark.createDataFrame([(bytearray(b"\x80" * 9 + b"\x01"),), (bytearray(b"\x07rest"),)], "x binary")
    assert [r["y"] for r in df.select(codecs.decode_uvarint(F.col("x")).alias("y")).collect()] == [-(1 << 63), 7]


def test_keys_work_out_their_input_once(spark):
    keys = [b"", b"\0", b"\xff" * 8, b"\xff" * 16 + b"\0", bytes(7), bytes(8), bytes(range(256)) * 400]
    df = spark.createDataFrame([(bytearray(k),) for k in keys], "x binary")
    coded = codecs.encode_region_key(F.col("x"), 7)
    assert named(df, codecs.decode_region_key(coded, 7)) == 1
    assert all(r["x"] == r["y"] for r in df.select("x", codecs.decode_region_key(coded, 7).alias("y")).collect())


def test_bucket_borders_work_out_their_input_once(spark):
    key = lambda n, k=b"": codecs.encode_bytes(F.lit(codecs.keyspace_prefix(n) + k))
    df = spark.createDataFrame([(0,)], "x int")
    one = codecs.encode_region_key(codecs.encode_uint(F.col("x")), 7)
    assert named(df, codecs.decode_bucket_keys(F.array(one), 7)) == 1
    cases = {
        "open": (F.array(key(6), key(7), key(6, b"a"), key(7, b"a"), key(9)), [b"", b"a", b""]), "within": (F.array(key(7), key(7, b"b")), [b"", b"b"]),
        "ends": (F.array(key(7, b"a"), F.lit(b"")), [b"a", b""]), "broken": (F.array(key(7), F.lit(b"x")), None), "none": (F.array().cast("array<binary>"), []),
    }
    found = df.select(*[codecs.decode_bucket_keys(b, 7).alias(c) for c, (b, _) in cases.items()]).first()
    assert {c: found[c] if found[c] is None else [bytes(k) for k in found[c]] for c in cases} == {c: want for c, (_, want) in cases.items()}
