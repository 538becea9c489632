"""Commits that arrive as a stream."""

from pyspark.sql import functions as F

from strata.operators import mvcc
from strata.sources.tables import SCHEMAS
from strata.streaming import ingest


def _source(spark, tmp_path):
    ts = lambda hour: (1_704_067_200_000 + hour * 3_600_000) << 18
    rows = [(b"a", ts(0) - 1, ts(0), "put", b"1"), (b"b", ts(0), ts(0) + 1, "put", b"2"), (b"a", ts(2) - 1, ts(2), "del", None)]
    spark.createDataFrame(rows, SCHEMAS["versions"]).write.parquet(str(tmp_path / "in"))
    return spark.readStream.schema(SCHEMAS["versions"]).parquet(str(tmp_path / "in"))


def test_append(spark, tmp_path):
    stream = _source(spark, tmp_path)
    ingest.append_versions(stream, str(tmp_path / "log"), str(tmp_path / "check"), once=True).awaitTermination(120)
    got = mvcc.visible(spark.read.schema(SCHEMAS["versions"]).parquet(str(tmp_path / "log"))).collect()
    assert [bytes(r["value"]) for r in got] == [b"2"]


def test_windows(spark, tmp_path):
    counts = ingest.commits_per_window(_source(spark, tmp_path))
    q = counts.writeStream.format("memory").queryName("per_window").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    rows = spark.table("per_window").orderBy(F.col("window.start")).collect()
    assert [(r["puts"], r["deletes"]) for r in rows] == [(2, 0), (0, 1)]
