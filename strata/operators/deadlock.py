"""Wait-for edges and the cycles among them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.lineage import cut


def _core(edges: DataFrame) -> DataFrame:
    """Without edges whose waiter nobody waits for, or whose holder waits for nobody, round by round: these lie on no cycle."""
    n = None
    while True:
        waits = edges.select(F.col("waiter").alias("holder")).distinct()
        held = edges.select(F.col("holder").alias("waiter")).distinct()
        edges = cut(edges.join(waits, "holder", "left_semi").join(held, "waiter", "left_semi").select("waiter", "holder"))
        now = edges.count()
        if now == n or now == 0:
            return edges
        n = now


def cycles(edges: DataFrame) -> DataFrame:
    """(waiter): transactions that wait, directly or not, for themselves.

    What trimming leaves is parted into strongly connected components by labels: every transaction takes the largest
    that reaches it; from each that keeps its own label, the edges among equal labels are followed back, which gives its
    component.  Components are taken away and the rest is trimmed and labelled again.  A round has a row a transaction,
    never pairs; there are as many rounds as the longest wait has steps.
    """
    loops = edges.where("waiter = holder").select("waiter").distinct()
    core = _core(edges.where("waiter <> holder").select("waiter", "holder").distinct())
    found = loops
    while not core.isEmpty():
        labels = core.select(F.col("waiter").alias("txn"), F.col("waiter").alias("label")).distinct()
        total = None
        while True:
            passed = core.join(labels, core["waiter"] == labels["txn"]).select(F.col("holder").alias("txn"), "label")
            labels = cut(labels.unionByName(passed).groupBy("txn").agg(F.max("label").alias("label")))
            now = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
            if now == total:
                break
            total = now
        a = labels.select(F.col("txn").alias("waiter"), F.col("label").alias("a"))
        b = labels.select(F.col("txn").alias("holder"), F.col("label").alias("b"))
        same = cut(core.join(a, "waiter").join(b, "holder").where("a = b").select("waiter", "holder"))
        inside = labels.where("txn = label").select("txn")
        frontier = inside
        while True:
            frontier = cut(same.join(frontier, same["holder"] == frontier["txn"], "left_semi").select(F.col("waiter").alias("txn")).distinct().join(inside, "txn", "left_anti"))
            if frontier.isEmpty():
                break
            inside = cut(inside.unionByName(frontier))
        sizes = inside.join(labels, "txn").groupBy("label").agg(F.count("*").alias("n")).where("n > 1")
        found = cut(found.unionByName(inside.join(labels, "txn").join(sizes, "label", "left_semi").select(F.col("txn").alias("waiter"))).distinct())
        gone = inside.select(F.col("txn").alias("waiter"))
        core = _core(core.join(gone, "waiter", "left_anti").join(gone.withColumnRenamed("waiter", "holder"), "holder", "left_anti").select("waiter", "holder"))
    return found


def would_deadlock(edges: DataFrame, waiter: int, holder: int) -> DataFrame:
    """The edge by which ``waiter`` waiting for ``holder`` would close a cycle: (waiter, holder, key_hash) that leads back."""
    spark = edges.sparkSession
    frontier = seen = spark.createDataFrame([(holder,)], "txn long")
    while True:
        step = cut(edges.join(frontier, edges["waiter"] == frontier["txn"], "left_semi"))
        back = step.where(F.col("holder") == waiter)
        if not back.isEmpty():
            return back.limit(1)
        frontier = cut(step.select(F.col("holder").alias("txn")).where("txn IS NOT NULL").distinct().join(seen, "txn", "left_anti"))
        if frontier.isEmpty():
            break
        seen = cut(seen.unionByName(frontier))
    return edges.limit(0)


def clean_up(edges: DataFrame, txn: int) -> DataFrame:
    return edges.where(F.col("waiter") != txn)


def clean_up_edge(edges: DataFrame, waiter: int, holder: int, key_hash: int) -> DataFrame:
    return edges.where(~((F.col("waiter") == waiter) & (F.col("holder") == holder) & (F.col("key_hash") == key_hash)))


def expire(edges: DataFrame, before_ts: int) -> DataFrame:
    return edges.where(F.col("seen_ts") >= before_ts)
