"""A search whose waits fan out widely visits every holder."""

from pyspark.sql import functions as F

from strata.operators.deadlock import would_deadlock


def test_wide_fan_out_leads_back(spark):
    fan = spark.range(1, 300_001).select(F.lit(0).cast("long").alias("waiter"), F.col("id").alias("holder"), F.lit(1).cast("long").alias("key_hash"))
    back = spark.createDataFrame([(222_222, 400_000, 2), (400_000, -1, 3), (5, 0, 4), (5, 5, 5)], "waiter long, holder long, key_hash long")
    edges = fan.unionByName(back)
    assert [tuple(r) for r in would_deadlock(edges, -1, 0).collect()] == [(400_000, -1, 3)]
    assert would_deadlock(edges, -2, 0).count() == 0
