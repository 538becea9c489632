"""The digest index over several flushes and levels, and texts that share a digest."""

from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import exact_dedup
from strata.llm.common import Scratch


def test_levels_and_runs(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MEMTABLE_ROWS", 10)
    index = exact_dedup.DigestIndex(Scratch(spark, "test"))
    want = defaultdict(list)
    for batch in range(4):
        rows = [(100 * batch + k, bytes([(k * (batch + 3)) % 40])) for k in range(35)]
        for i, d in rows:
            want[d].append(i)
        index.flush(spark.createDataFrame(rows, "doc_id long, digest binary"), len(rows))
        sizes = index.runs().groupBy("batch", "run").agg(F.sum("n").alias("n")).collect()
        assert len(sizes) >= 3 and sum(r["n"] for r in sizes) == 35 * index.batches
        if batch % 2:
            level = {bytes(r["digest"]): (r["smallest"], r["largest"], r["n"]) for r in index.compact().collect()}
            assert level == {d: (min(i), max(i), len(i)) for d, i in want.items()}
    found = index.lookup([b"\x00", b"\x03", b"\xff"]).groupBy("digest").agg(F.sum("n").alias("n")).collect()
    assert {bytes(r["digest"]): r["n"] for r in found} == {d: len(want[d]) for d in (b"\x00", b"\x03")}


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_digest_collisions_merge_no_texts(spark, keep):
    """A digest of one byte: hundreds of texts collide, and still only equal ones are copies."""
    texts = [None, "", "Same", "same", "SAME", "é", "É", *[f"text {k % 150}" for k in range(400)]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    short = lambda text: F.substring(exact_dedup.sha256(text), 1, 1)
    found = exact_dedup.exact_dedup(spark, docs, keep=keep, digest=short)
    groups = defaultdict(list)
    for k, t in enumerate(texts):
        groups["".join(c.lower() if c.isascii() else c for c in t or "")].append(k)
    best = min if keep == "smallest" else max
    want = {k: (best(g), len(g), best(g) == k) for g in groups.values() for k in g}
    assert {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in found.assignments.collect()} == want
    assert sorted(r["doc_id"] for r in found.keep(docs).collect()) == sorted(best(g) for g in groups.values())


def test_a_saturated_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FEWEST_WORDS", 1)
    monkeypatch.setattr(exact_dedup, "MOST_WORDS", 1)
    docs = spark.createDataFrame([(k, f"t {k // 2 if k < 300 else k}") for k in range(500)], "doc_id long, text string")
    kept = exact_dedup.exact_dedup(spark, docs).keep(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(0, 300, 2), *range(300, 500)]
