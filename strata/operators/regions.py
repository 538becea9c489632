"""Regions: contiguous key ranges ``[lo, hi)``; an empty ``hi`` is open.

Finding the region of many keys is an as-of lookup, not a range join: keys and region starts are
ordered together and each key takes the last start before it, so the plan is a shuffle and a sort
at any number of regions.

``gaps``, ``contiguous_from`` and ``split`` put the regions themselves in one order: region metadata, a row for some
ten megabytes of data or more, not a row a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.lineage import cut
from strata.operators.mvcc import numbered, range_parts

OPEN = bytes([0xFF] * 64)


def contains(key: Column, lo: Column, hi: Column) -> Column:
    return (key >= lo) & ((F.octet_length(hi) == 0) | (key < hi))


def contains_by_end(key: Column, lo: Column, hi: Column) -> Column:
    """``(lo, hi]``: for scans that go down from a key."""
    return (key > lo) & ((F.octet_length(hi) == 0) | (key <= hi))


def end(hi: Column) -> Column:
    return F.when(F.octet_length(hi) == 0, F.lit(OPEN)).otherwise(hi)


def as_of(points: DataFrame, starts: DataFrame, *, before: bool = False) -> DataFrame:
    """``points`` (key, ...) with ``near``: the columns of the start with the largest key not after theirs (``before``: before it).

    Points and starts are sorted together in range partitions, written once, so that a task that is run again finds the
    same partitions; each partition begins with the last start of those before it.
    """
    cols = points.columns
    near, point = F.struct(*starts.columns), F.struct(*cols)
    kinds = starts.select(near.alias("x")).schema["x"].dataType, points.select(point.alias("x")).schema["x"].dataType
    rows = points.select("key", F.lit(None).cast(kinds[0]).alias("start"), point.alias("point")).unionByName(starts.select("key", near.alias("start"), F.lit(None).cast(kinds[1]).alias("point")))
    dealt = range_parts(rows, "key")
    last = dealt.where("start IS NOT NULL").groupBy("__part").agg(F.max_by("start", "key").alias("start"))
    # A row a partition.
    carried = F.last("start", ignorenulls=True).over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    earlier = dealt.select("__part").distinct().join(last, "__part", "left").select("__part", carried.alias("carried"))
    tie = F.col("start").isNotNull() if before else F.col("start").isNull()
    found = F.last("start", ignorenulls=True).over(Window.partitionBy("__part").orderBy("key", tie).rowsBetween(Window.unboundedPreceding, 0))
    rows = dealt.withColumn("near", found).where("point IS NOT NULL").join(F.broadcast(earlier), "__part")
    return rows.select("point.*", F.coalesce("near", "carried").alias("near"))


def locate_keys(keys: DataFrame, regions: DataFrame, *, by_end: bool = False) -> DataFrame:
    """``keys`` with region_id, lo, hi of their region; null where none holds the key."""
    inside = contains_by_end if by_end else contains
    found = as_of(keys, regions.select(F.col("lo").alias("key"), "region_id", "lo", "hi"), before=by_end)
    good = inside(F.col("key"), F.col("near.lo"), F.col("near.hi"))
    return found.select(*keys.columns, *[F.when(good, F.col(f"near.{c}")).alias(c) for c in ("region_id", "lo", "hi")])


def overlapping(ranges: DataFrame, regions: DataFrame) -> DataFrame:
    """(a, b, region_id, lo, hi): the regions that overlap each range ``[a, b)``, found by the numbers of the first and the last."""
    own = numbered(regions.select(F.col("lo").alias("key"), "region_id", "lo", "hi"), "number").drop("key")
    starts = own.select(F.col("lo").alias("key"), "number")
    asked = ranges.select(F.monotonically_increasing_id().alias("id"), F.col("lo").alias("a"), F.col("hi").alias("b"))
    asked = cut(asked)
    first = as_of(asked.withColumn("key", F.col("a")), starts).select("id", "a", "b", F.coalesce("near.number", F.lit(0)).cast("long").alias("from"))
    last = as_of(asked.select("id", end(F.col("b")).alias("key")), starts, before=True).select("id", F.col("near.number").alias("to"))
    spans = first.join(last, "id").where("from <= to").select("a", "b", F.explode(F.sequence("from", "to")).alias("number"))
    return spans.join(own, "number").where((F.col("lo") < end(F.col("b"))) & (F.col("a") < end(F.col("hi")))).drop("number")


def group_keys(keys: DataFrame, regions: DataFrame) -> DataFrame:
    """(region_id, keys, first): how many asked keys fall into each region, and the smallest."""
    return locate_keys(keys, regions).where("region_id IS NOT NULL").groupBy("region_id").agg(F.count("*").alias("keys"), F.min("key").alias("first"))


def locate_ranges(ranges: DataFrame, regions: DataFrame) -> DataFrame:
    """Regions that overlap any of the ranges, once each, in order."""
    return overlapping(ranges, regions).select("region_id", "lo", "hi").distinct().orderBy("lo")


def next_regions(regions: DataFrame, start: bytes, n: int) -> DataFrame:
    """The region of ``start`` and those after it, ``n`` at most."""
    return regions.where(end(F.col("hi")) > F.lit(start)).orderBy("lo").limit(n)


def gaps(regions: DataFrame, lo: bytes = b"", hi: bytes = b"") -> DataFrame:
    """(lo, hi): parts of the range that no region covers.  A running maximum over the regions of the range."""
    stop = hi or OPEN
    near = regions.where((F.col("lo") < F.lit(stop)) & (end(F.col("hi")) > F.lit(lo))).select(F.greatest("lo", F.lit(lo)).alias("lo"), F.least(end(F.col("hi")), F.lit(stop)).alias("hi"))
    edge = near.sparkSession.createDataFrame([(bytearray(stop), bytearray(stop))], "lo binary, hi binary")
    covered = F.max("hi").over(Window.orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1))
    holes = near.unionByName(edge).withColumn("from", F.coalesce(covered, F.lit(lo))).where(F.col("from") < F.col("lo"))
    return holes.select(F.col("from").alias("lo"), F.when(F.col("lo") == F.lit(OPEN), F.lit(b"")).otherwise(F.col("lo")).alias("hi"))


def contiguous_from(regions: DataFrame, start: bytes, limit: int | None = None) -> DataFrame:
    """Regions in order from the one that holds ``start`` up to the first hole."""
    w = Window.orderBy("lo")
    rows = regions.where(end(F.col("hi")) > F.lit(start)).withColumn("before", F.lag("hi").over(w))
    broken = F.when(F.col("before").isNull(), F.col("lo") > F.lit(start)).otherwise(F.col("before") != F.col("lo"))
    kept = rows.withColumn("bad", F.max(broken.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).where("bad = 0").drop("before", "bad").orderBy("lo")
    return kept if limit is None else kept.limit(limit)


def split(regions: DataFrame, keys: DataFrame) -> DataFrame:
    """Regions after splitting at the keys; keys equal to a start change nothing; new regions get new ids."""
    starts = regions.select("lo", "region_id").unionByName(keys.select(F.col("key").alias("lo"), F.lit(None).cast("long").alias("region_id"))).groupBy("lo").agg(F.max("region_id").alias("region_id"))
    w = Window.orderBy("lo")
    top = F.max("region_id").over(Window.partitionBy())
    new = F.sum(F.col("region_id").isNull().cast("int")).over(w)
    return starts.select(F.coalesce("region_id", top + new).alias("region_id"), "lo", F.coalesce(F.lead("lo").over(w), F.lit(b"")).alias("hi"))


def merge(regions: DataFrame, left_id: int, right_id: int) -> DataFrame:
    """One region from two neighbours; it keeps the left id."""
    right = regions.where(F.col("region_id") == right_id).select(F.col("lo").alias("at"), F.col("hi").alias("to"))
    kept = regions.where(F.col("region_id") != right_id).join(F.broadcast(right), (F.col("region_id") == left_id) & (F.col("hi") == F.col("at")), "left")
    return kept.withColumn("hi", F.coalesce("to", "hi")).drop("at", "to")


def split_points(rows: DataFrame, n: int) -> DataFrame:
    """(tile, lo): first keys of ``n`` stretches of nearly equal counts."""
    keys = rows.select("key").distinct()
    total = keys.count()
    tile = F.floor(F.col("n") * n / max(total, 1)).cast("int")
    return numbered(keys).withColumn("tile", tile).groupBy("tile").agg(F.min("key").alias("lo"))


def locate_buckets(keys: DataFrame, buckets: DataFrame) -> DataFrame:
    """``keys`` (with region_id) and the bucket of their region that holds them."""
    b = buckets.select("region_id", F.col("lo").alias("bucket_lo"), F.col("hi").alias("bucket_hi"))
    return keys.join(b, "region_id").where(contains(F.col("key"), F.col("bucket_lo"), F.col("bucket_hi")))
