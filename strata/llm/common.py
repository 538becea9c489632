"""Shared helpers: written intermediate tables, ASCII folding, Bloom filters."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words, as a regular-expression class body.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def ascii_lower(text: Column | str) -> Column:
    """Lower-case A-Z only; null counts as empty.

    Pure ASCII texts take the cheaper built-in ``lower``, which agrees there.
    """
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_count(text: Column | str) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; null counts as empty."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def fold(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as the empty text."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it as long as ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


class Scratch:
    """Tables written once into the cluster's shared folder and read back.

    Writing cuts lineage: a lost executor costs only the tasks of the running job.
    The folder is ``spark.checkpoint.dir`` of the session; only where that is unset, in local
    mode, a temporary folder is made and set.  Files stay until ``clear()`` or ``drop()``,
    because returned DataFrames read them lazily; ``release`` clears all that a program made.
    """

    made: list[Scratch] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            context = spark.sparkContext
            if not context.getCheckpointDir():
                if not context.master.startswith("local"):
                    raise ValueError("spark.checkpoint.dir names no folder that all executors share")
                context.setCheckpointDir(tempfile.mkdtemp(prefix="strata-"))
            root = context.getCheckpointDir()
        self.path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
        Scratch.made.append(self)

    def save(self, df: DataFrame, name: str, *, partition_by: str | None = None, options: dict | None = None) -> DataFrame:
        writer = df.write.option("compression", "zstd").options(**(options or {}))
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(f"{self.path}/{name}")
        return self.load(name, df.schema)

    def load(self, name: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def drop(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def clear(self) -> None:
        self.drop("")


def release() -> None:
    """Delete the intermediate tables of all operators that this program has called; their results must have been stored by then."""
    while Scratch.made:
        Scratch.made.pop().clear()


def bloom_words(keys: DataFrame, key: Column, words: int = 1 << 16) -> DataFrame:
    """A Bloom filter as one row with one array of ``words`` longs (512 KiB at the default).

    The size is a constant, so the one row may be shipped to every task.  More keys only
    raise the rate of false positives; no key is ever missed.
    """
    h = F.xxhash64(key)
    bits = keys.select(
        F.pmod(h, F.lit(words)).cast("int").alias("w"),
        _mask(h).alias("m"),
    ).groupBy("w").agg(F.bit_or("m").alias("m"))
    every = keys.sparkSession.range(words).select(F.col("id").cast("int").alias("w"))
    dense = every.join(bits, "w", "left").select("w", F.coalesce("m", F.lit(0).cast("long")).alias("m"))
    return dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "m"))), lambda x: x["m"]).alias("words"))


def _mask(h: Column) -> Column:
    one = F.lit(1).cast("long")
    bit = lambda by: F.pmod(F.shiftright(h, by), F.lit(64)).cast("int")
    return F.call_function("shiftleft", one, bit(20)).bitwiseOR(F.call_function("shiftleft", one, bit(34)))


def might_contain(filter_row: DataFrame, key: Column, words: int = 1 << 16) -> Column:
    """Test against ``bloom_words``; the one-row table is read as a scalar subquery."""
    h = F.xxhash64(key)
    mask = _mask(h)
    return F.get(filter_row.scalar(), F.pmod(h, F.lit(words)).cast("int")).bitwiseAND(mask) == mask


def pieces(total: int, each: int, most: int | None = None) -> int:
    """How many parts of about ``each`` items hold ``total`` items; at least one."""
    n = max(1, math.ceil(total / each))
    return n if most is None else min(n, most)
