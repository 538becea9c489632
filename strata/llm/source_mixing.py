"""Mixing sources to target weights by entropy balancing.

Every source gets a share of all words; the document rates that meet those shares while staying
closest (in relative entropy) to taking each document once are ``min(cap, exp(t * size / mean))``, an
exponential tilt with one dual variable ``t`` a source.  The dual is convex; safeguarded Newton steps
solve it for all sources at once over the table of (source, size, count), one Spark job a step.
Rates become whole copies from the largest size to the smallest, each size absorbing the rounding
of those above it, so a source ends within half of its smallest sizes of its target where it can.

Targets: sources in order of code point, null last, weigh ``weights`` in turn; a target stops at
``cap`` times its source's size, and what that frees is shared again by weight until none is above.

Defined cases: a null text has size 0, and documents of size 0 are taken once, without effect on any
sum; null sources form the last source; null ids and repeated rows are rows like any
other; sources without words have target 0; an empty table gives an empty result; extra columns are
ignored, or kept with ``carry``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import Scratch, word_count

WEIGHTS = (5, 2, 1)
CAP = 3
#: Newton steps at most, and the relative miss of a target at which a source is settled.
STEPS = 40
CLOSE = 1e-4
#: Documents of one (source, size) that are ranked together, about.
RANKED = 4096
#: A plan of at most so many bytes is sent to every task; a larger one is joined by shuffle.
PLAN_BYTES = 16 << 20


def source_targets(sizes: DataFrame, scratch: Scratch, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size) to (source, source_size, target): water-filling by rounds until none is above its cap.

    Ordering and sharing need running sums over the sources alone: one row a source.
    """
    from pyspark.sql import Window

    order = Window.orderBy(F.encode("source", "UTF-8").asc_nulls_last())
    every = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")).cast("double"))
    # Sources fill up in order of cap * size / weight: those before the first that is not full are capped.
    fill = every.withColumn("most", cap * F.col("source_size").cast("double")).withColumn("ratio", F.col("most") / F.col("weight"))
    up = Window.orderBy("ratio", F.encode("source", "UTF-8").asc_nulls_last())
    before, after = up.rowsBetween(Window.unboundedPreceding, -1), up.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()).cast("double")
    level = fill.withColumn("level", (total - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    full = level.withColumn("open", F.col("ratio") >= F.col("level"))
    water = full.withColumn("water", F.min(F.when(F.col("open"), F.struct("ratio", "level"))).over(Window.partitionBy())["level"])
    return scratch.save(water.select("source", "source_size", F.when(F.col("open"), F.col("weight") * F.col("water")).otherwise(F.col("most")).alias("target")), "targets")


def _solve(cells: DataFrame, targets: DataFrame, scratch: Scratch, cap: int) -> DataFrame:
    """(source, t, mean): the dual variable of every source that has words, by Newton steps with a bracket."""
    mean = cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("s"), F.sum("n").alias("n")).select("source", (F.col("s") / F.col("n")).alias("mean")).where("mean > 0")
    state = targets.join(mean, targets["source"].eqNullSafe(mean["source"])).select(
        targets["source"], "target", "source_size", "mean", F.lit(0.0).alias("t"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"),
        (F.col("target") >= cap * F.col("source_size")).alias("done"),
    )
    state = scratch.save(state, "dual-0")
    for k in range(STEPS):
        if state.where("NOT done").isEmpty():
            break
        there = cells.where("size > 0").join(state.where("NOT done").select(F.col("source").alias("s"), "t", "mean"), F.col("source").eqNullSafe(F.col("s")))
        x = F.col("size") / F.col("mean")
        free = F.least(F.exp(F.least(F.col("t") * x, F.lit(50.0))), F.lit(float(cap)))
        tokens = F.col("n") * F.col("size") * free
        sums = scratch.save(there.groupBy("s").agg(F.sum(tokens).alias("got"), F.sum(F.when(free < cap, tokens * x).otherwise(0.0)).alias("slope")), f"sums-{k}")
        joined = state.join(sums, state["source"].eqNullSafe(sums["s"]), "left")
        miss = F.col("got") - F.col("target")
        low = F.when(miss < 0, F.col("t")).otherwise(F.col("lo"))
        high = F.when(miss > 0, F.col("t")).otherwise(F.col("hi"))
        newton = F.col("t") - miss / F.when(F.col("slope") > 0, F.col("slope"))
        # Outside the bracket, or without a slope: halve it, or reach out further where it is open.
        safe = F.when((low.isNotNull()) & (high.isNotNull()), (low + high) / 2).when(low.isNotNull(), F.greatest(low * 2, F.lit(1.0))).otherwise(F.least(high * 2, F.lit(-1.0)))
        reach = F.greatest(F.abs(F.col("t")) * 4, F.lit(4.0))
        good = newton.isNotNull() & (low.isNull() | (newton > low)) & (high.isNull() | (newton < high)) & (F.abs(newton - F.col("t")) <= reach)
        settled = F.col("done") | (F.abs(miss) <= CLOSE * F.col("target")) | (F.coalesce(high - low, F.lit(1.0)) < 1e-12)
        state = scratch.save(
            joined.select(
                "source", "target", "source_size", "mean", F.when(settled, F.col("t")).when(good, newton).otherwise(safe).alias("t"),
                F.when(F.col("done"), F.col("lo")).otherwise(low).alias("lo"), F.when(F.col("done"), F.col("hi")).otherwise(high).alias("hi"), settled.alias("done"),
            ),
            f"dual-{k + 1}",
        )
    return state.select("source", "t", "mean", (F.col("target") >= cap * F.col("source_size")).alias("full"))


def _copies(cells: DataFrame, dual: DataFrame, targets: DataFrame, cap: int) -> DataFrame:
    """(source, size, n, copies): whole copies for each (source, size), largest sizes first.

    One group a source; its rows are its distinct sizes, not its documents.
    """
    rated = cells.join(dual.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    rated = rated.join(targets.select(F.col("source").alias("s"), "target"), F.col("source").eqNullSafe(F.col("s"))).drop("s")

    def spread(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values("size", ascending=False, kind="stable")
        size, n = cells["size"].to_numpy(), cells["n"].to_numpy()
        mean, t = cells["mean"].fillna(1.0).to_numpy(), cells["t"].fillna(0.0).to_numpy()
        rate = np.where(cells["full"].fillna(False).to_numpy(dtype=bool), cap, np.minimum(cap, np.exp(np.minimum(t * size / mean, 50))))
        wanted = n * size * rate
        # The solved rates miss by a little: the last word is the target.
        wanted *= cells["target"].iloc[0] / max(wanted.sum(), 1e-300)
        out = np.zeros(len(cells), dtype=np.int64)
        due = 0.0
        for k in range(len(cells)):
            due += wanted[k]
            if size[k]:
                out[k] = min(max(int(np.floor(due / size[k] + 0.5)), 0), cap * n[k])
                due -= out[k] * size[k]
            else:
                out[k] = n[k]
        return pd.DataFrame({"source": cells["source"], "size": size, "n": n, "copies": out})

    kind = rated.schema["source"].dataType.simpleString()
    return rated.groupBy("source").applyInPandas(lambda x: spread(x), f"source {kind}, size long, n long, copies long")


def _plan(sized: DataFrame, planned: DataFrame, scratch: Scratch) -> DataFrame:
    """(source, size, each, last_hash, last_id): documents up to (last_hash, last_id) get one copy more than ``each``.

    Large groups are ranked in parts of about ``RANKED`` rows whose counts are summed first.
    """
    from pyspark.sql import Window

    uneven = planned.where("copies % n <> 0").select(F.col("source").alias("s"), F.col("size").alias("z"), (F.col("copies") % F.col("n")).alias("more"), F.ceil(F.col("n") / RANKED).alias("parts"))
    h = F.xxhash64("doc_id")
    dealt = sized.join(uneven, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))).select("s", "z", "more", "doc_id", h.alias("h"), F.floor((F.shiftrightunsigned(h, 32) * F.col("parts")) / F.lit(float(1 << 32))).cast("long").alias("part"))
    dealt = scratch.save(dealt, "dealt")
    counts = dealt.groupBy("s", "z", "part").agg(F.count("*").alias("c"), F.first("more").alias("more"))
    starts = counts.withColumn("start", F.sum("c").over(Window.partitionBy("s", "z").orderBy("part")) - F.col("c"))
    # Only the part in which the last document with an extra copy lies is ranked.
    starts = scratch.save(starts.where("start < more AND more <= start + c").select(F.col("s").alias("s2"), F.col("z").alias("z2"), F.col("part").alias("p2"), (F.col("more") - F.col("start")).alias("nth")), "starts")
    inside = dealt.join(starts, F.col("s").eqNullSafe(F.col("s2")) & (F.col("z") == F.col("z2")) & (F.col("part") == F.col("p2")))
    unsigned = F.shiftrightunsigned("h", 32)
    rank = F.row_number().over(Window.partitionBy("s", "z", "part").orderBy(unsigned, "h", "doc_id"))
    last = inside.withColumn("rank", rank).where("rank = nth").select("s", "z", F.col("h").alias("last_hash"), F.col("doc_id").alias("last_id"))
    planned = planned.select("source", "size", F.floor(F.col("copies") / F.col("n")).cast("long").alias("each"))
    found = planned.join(last, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")), "left")
    return scratch.save(found.select("source", "size", "each", F.col("z").isNotNull().alias("uneven"), "last_hash", "last_id"), "plan")


def _with_copies(rows: DataFrame, plan: DataFrame, id_col: str) -> DataFrame:
    """``rows`` (with __source, __size) and their __copies.  The plan travels whole only if it is small, by its measured bytes."""
    bytes_ = plan.agg(F.sum(F.lit(48) + F.coalesce(F.octet_length("source"), F.lit(0)))).first()[0] or 0
    p = plan.select(F.col("source").alias("__s"), F.col("size").alias("__z"), "each", "uneven", "last_hash", "last_id")
    joined = rows.join(F.broadcast(p) if bytes_ <= PLAN_BYTES else p, F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__size") == F.col("__z")))
    h = F.xxhash64(F.col(id_col))
    key = F.struct(F.shiftrightunsigned(h, 32).alias("a"), h.alias("b"), F.col(id_col).alias("c"))
    last = F.struct(F.shiftrightunsigned("last_hash", 32).alias("a"), F.col("last_hash").alias("b"), F.col("last_id").alias("c"))
    return joined.withColumn("__copies", F.col("each") + F.when(F.col("uneven") & (key <= last), 1).otherwise(0))


def mix_sources(
    spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights=WEIGHTS, cap: int = CAP, carry: str | None = None,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies), or ``docs`` with the copies in a further column named ``carry``."""
    scratch = Scratch(spark, "mixing")
    sized = scratch.save(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text_col).alias("size")), "sized")
    cells = scratch.save(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "cells")
    targets = source_targets(cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).cast("long").alias("source_size")), scratch, weights, cap)
    planned = scratch.save(_copies(cells, _solve(cells, targets, scratch, cap), targets, cap), "planned")
    plan = _plan(sized, planned, scratch)
    if carry:
        # The document travels as one column, so that no name of its own can clash.
        rows = docs.select(F.struct("*").alias("document"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("__source"), word_count(text_col).alias("__size"))
        return _with_copies(rows, plan, "doc_id").select("document.*", F.col("__copies").alias(carry))
    rows = sized.select("doc_id", F.col("source").alias("__source"), F.col("size").alias("__size"))
    found = _with_copies(rows, plan, "doc_id")
    t = targets.select(F.col("source").alias("t"), "source_size", "target")
    return found.join(t, F.col("__source").eqNullSafe(F.col("t"))).select(
        "doc_id", F.col("__source").alias("source"), F.col("__size").alias("size"), "source_size", "target", F.col("__copies").alias("copies"),
    )
