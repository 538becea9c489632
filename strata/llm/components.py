"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch

#: Each pair of rounds at least halves the height of the stars' trees; this only bounds a programming error.
MOST_ROUNDS = 60


def _smallest(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Per node the smallest of its neighbours and itself.  Written, so that the join that follows may split hot nodes."""
    return scratch.save(edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), name)


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(u, v) links of long ids to (node, root): root is the smallest id reachable.  Nodes without links do not occur.

    Null ends and loops are ignored; repeated links change nothing; no links give no rows.
    """
    links = scratch.save(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-0"
    )
    before = None
    for k in range(MOST_ROUNDS):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _smallest(both, scratch, f"cc-large-{k}")
        # Large star: every larger neighbour of u moves to the smallest of u's neighbourhood.
        large = scratch.save(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), f"cc-l-{k}")
        # Small star: u and its smaller neighbours move to the smallest of them.
        least = _smallest(large, scratch, f"cc-small-{k}")
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = scratch.save(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), f"cc-{k + 1}")
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        scratch.drop(f"cc-{k}")
        scratch.drop(f"cc-l-{k}")
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
