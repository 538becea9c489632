"""Engine tables: their schemas, storage as sorted Parquet, and how the supplied tables become them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import codecs, tso

SCHEMAS = {
    "versions": "key binary, start_ts long, commit_ts long, op string, value binary",
    "locks": "key binary, primary binary, start_ts long, op string, value binary, ttl_ms long, for_update_ts long, txn_size long, min_commit_ts long, use_async_commit boolean, secondaries array<binary>, generation long",
    "raw": "cf string, key binary, value binary, op string, seq long, expire_at long",
    "mutations": "key binary, value binary, flags int, stage int, op_seq long",
    "regions": "region_id long, lo binary, hi binary",
    "txn_status": "start_ts long, commit_ts long, action string, ttl_ms long",
    "meta": "name string, ts long",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """An engine table with its fixed schema; nothing is inferred."""
    return spark.read.schema(SCHEMAS[kind]).parquet(path)


def write(df: DataFrame, path: str, kind: str, *, mode: str = "overwrite") -> None:
    """Store a table in key order: row-group bounds then prune range reads.  ``raw`` is parted by column family."""
    columns = [c.split()[0] for c in SCHEMAS[kind].split(", ")]
    ordered = df.select(*columns)
    if "key" in columns:
        ordered = ordered.repartitionByRange("key").sortWithinPartitions("key", *[F.desc("commit_ts")] * ("commit_ts" in columns))
    writer = ordered.write.mode(mode)
    if kind == "raw":
        writer = writer.partitionBy("cf")
    writer.parquet(path)


def versions_from_events(events: DataFrame, *, noise: bool = False) -> DataFrame:
    """Users are keys, events their versions; errors delete.  ``noise``: some rollback and lock records."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    commit = tso.compose(ms, F.col("event_id") % (tso.LOGICAL_MASK + 1))
    op = F.when(F.col("event_type") == "error", "del").otherwise("put")
    if noise:
        op = F.when(F.col("event_id") % 17 == 0, "rollback").when(F.col("event_id") % 19 == 0, "lock").otherwise(op)
    return events.select(
        codecs.encode_uint(F.col("user_id")).alias("key"), (commit - 1).alias("start_ts"), commit.alias("commit_ts"), op.alias("op"), F.encode(F.col("event_id").cast("string"), "UTF-8").alias("value"),
    )


def locks_from_events(events: DataFrame) -> DataFrame:
    """The newest event of every seventh user is a lock; the user modulo 3 gives its op, every 21st its own primary."""
    v = versions_from_events(events).withColumn("user", codecs.decode_uint(F.col("key"))).where("user % 7 = 0")
    last = v.groupBy("key", "user").agg(F.max_by(F.struct("start_ts", "value"), "commit_ts").alias("v"))
    op = F.element_at(F.array(F.lit("put"), F.lit("del"), F.lit("lock")), (F.col("user") % 3 + 1).cast("int"))
    return last.select(
        "key", codecs.encode_uint(F.col("user") - F.col("user") % 21).alias("primary"), "v.start_ts", op.alias("op"), "v.value", (F.col("user") % 5 * 1000).alias("ttl_ms"), F.lit(0).cast("long").alias("for_update_ts"),
        F.lit(1).cast("long").alias("txn_size"), (F.col("v.start_ts") + F.col("user")).alias("min_commit_ts"), F.lit(False).alias("use_async_commit"), F.lit(None).cast("array<binary>").alias("secondaries"), F.lit(0).cast("long").alias("generation"),
    )


def raw_from_customer(customer: DataFrame) -> DataFrame:
    """Market segments are column families; every fifth customer expires at 100 + its key, every eleventh is deleted."""
    key = F.col("c_custkey")
    return customer.select(
        F.col("c_mktsegment").alias("cf"), codecs.encode_uint(key).alias("key"), F.encode("c_name", "UTF-8").alias("value"), F.when(key % 11 == 0, "del").otherwise("put").alias("op"),
        key.alias("seq"), F.when(key % 5 == 0, key + 100).alias("expire_at"),
    )


def snapshot_from_orders(orders: DataFrame) -> DataFrame:
    return orders.select(codecs.encode_uint(F.col("o_orderkey")).alias("key"), F.encode("o_orderstatus", "UTF-8").alias("value"), F.col("o_orderkey").alias("commit_ts"))


def buffer_from_orders(orders: DataFrame) -> DataFrame:
    """Every fifth order is overwritten in the buffer, every tenth deleted, and some keys are new."""
    k = F.col("o_orderkey")
    value = F.when(k % 10 == 0, F.lit(b"")).otherwise(F.encode(F.concat(F.lit("new "), F.col("o_orderstatus")), "UTF-8"))
    return orders.where(k % 5 == 0).select(
        codecs.encode_uint(F.when(k % 15 == 0, k + 10_000_000).otherwise(k)).alias("key"), value.alias("value"), (k % 16384).cast("int").alias("flags"), (k % 3).cast("int").alias("stage"), k.alias("op_seq"),
    )


def regions_from_orders(orders: DataFrame, width: int = 1000) -> DataFrame:
    """A region every ``width`` order keys; the first and the last are open."""
    k = F.floor(F.col("o_orderkey") / width).cast("long")
    bounds = orders.agg(F.max(k).alias("most")).select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("most"))).alias("r"), "most")
    return bounds.select(
        (F.col("r") + 1).alias("region_id"), F.when(F.col("r") == 0, F.lit(b"")).otherwise(codecs.encode_uint(F.col("r") * width)).alias("lo"),
        F.when(F.col("r") == F.col("most"), F.lit(b"")).otherwise(codecs.encode_uint((F.col("r") + 1) * width)).alias("hi"),
    )


def transaction_from_customers(customer: DataFrame, start_ts: int, commit_ts: int) -> tuple[DataFrame, DataFrame]:
    """(versions, locks) around one transaction whose keys are customers in every state, by the key modulo 7.

    0: locked; 1: locked by another transaction; 2: committed; 3: rolled back; 4: untouched; 5: locked, and to be committed
    after ``commit_ts`` only; 6: locked ahead of writing.  Even keys have an older version, some a newer one.
    """
    c = F.col("c_custkey")
    state, key = c % 7, codecs.encode_uint(c).alias("key")
    version = lambda where, start, commit, op, value: customer.where(where).select(key, F.lit(start).alias("start_ts"), F.lit(commit).alias("commit_ts"), F.lit(op).alias("op"), F.lit(value).cast("binary").alias("value"))
    versions = (
        version(c % 2 == 0, start_ts - 1001, start_ts - 1000, "put", b"old")
        .unionByName(version(state == 2, start_ts, start_ts + 50, "put", b"own"))
        .unionByName(version(state == 3, start_ts, start_ts, "rollback", None))
        .unionByName(version(c % 14 == 4, start_ts + 499, start_ts + 500, "put", b"new"))
    )
    locks = customer.where(state.isin(0, 1, 5, 6)).select(
        key, key.alias("primary"), F.when(state == 1, start_ts + 7).otherwise(start_ts).alias("start_ts"), F.when(state == 6, "pessimistic").otherwise("put").alias("op"),
        F.lit(b"own").alias("value"), (c * 10).alias("ttl_ms"), F.when(state == 6, start_ts + 3).otherwise(0).alias("for_update_ts"), F.lit(1).cast("long").alias("txn_size"),
        F.when(state == 5, commit_ts + 1).when(state == 6, 0).otherwise(start_ts + 8).alias("min_commit_ts"), F.lit(False).alias("use_async_commit"),
        F.lit(None).cast("array<binary>").alias("secondaries"), F.lit(0).cast("long").alias("generation"),
    )
    return versions, locks


def writes_from_orders(orders: DataFrame) -> DataFrame:
    """A buffer in which customers are written once an order: every fourth write is flags only, the next one a delete."""
    k = F.col("o_orderkey")
    value = F.when(k % 4 == 0, F.lit(None).cast("binary")).when(k % 4 == 1, F.lit(b"")).otherwise(F.encode(F.concat(F.lit("v"), k.cast("string")), "UTF-8"))
    return orders.select(codecs.encode_uint(F.col("o_custkey")).alias("key"), value.alias("value"), (k % 16384).cast("int").alias("flags"), (k % 3).cast("int").alias("stage"), k.alias("op_seq"))


#: Names of the file that names the current tables of a published set, and of the folders of its states.
CURRENT, STATE = "CURRENT", "state-"


def _fs(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path itself: any store that Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame]) -> str:
    """Store the tables of one step as a new state of the set at ``root``; readers see all of them or none.

    The state lies in a folder of its own, and one small file, which is replaced last, names it.
    """
    folder = f"{STATE}{uuid.uuid4().hex}"
    for kind, df in tables.items():
        write(df, f"{root}/{folder}/{kind}", kind)
    files, current = _fs(spark, f"{root}/{CURRENT}")
    _, fresh = _fs(spark, f"{root}/{folder}.{CURRENT}")
    out = files.create(fresh, True)
    out.write(bytearray(folder.encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(current.toUri(), spark._jsc.hadoopConfiguration())
    overwrite = spark._jvm.java.lang.reflect.Array.newInstance(spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
    overwrite[0] = getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
    context.rename(fresh, current, overwrite)
    return folder


def published(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the current state at ``root``."""
    folder = spark.read.text(f"{root}/{CURRENT}").first()["value"]
    files, where = _fs(spark, f"{root}/{folder}")
    kinds = [s.getPath().getName() for s in files.listStatus(where)]
    return {kind: read(spark, f"{root}/{folder}/{kind}", kind) for kind in kinds}


def destroy_range(spark: SparkSession, root: str, lo: bytes, hi: bytes) -> str:
    """A new state of the set at ``root`` without any row of ``[lo, hi)``: versions, locks and raw rows alike, at once."""
    from strata.operators.maintenance import delete_range

    return publish(spark, root, {kind: delete_range(df, lo, hi) if "key" in df.columns else df for kind, df in published(spark, root).items()})
