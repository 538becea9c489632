"""Nearest neighbours beyond the query: recall of full shards, cells, extreme components, repeated ids, few candidates."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest

from strata.llm import nearest
from strata.llm.common import Scratch


def table(spark, ids, vectors):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors, strict=True)], "vec_id long, embedding array<double>")


def exact(ids, vectors, own, k):
    score = (vectors * vectors[own]).sum(axis=1)
    score[own] = -np.inf
    return [int(ids[j]) for j in np.lexsort((ids, -score))[:k]]


def test_recall_of_a_full_shard():
    """Vectors without structure, in a shard of full size and a second one that is searched at the radius of the first."""
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((2 * nearest.SHARD, 64))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    ids = np.arange(len(vectors))
    shards = [nearest.Shard(p, ids[p], vectors[p], vectors[p]) for p in np.split(ids, 2)]
    hits = verified = 0
    queries = range(0, 8000, 160)
    for q in queries:
        best, score = shards[0].best(shards[0].widening(vectors[q], 21), vectors[q], 21)
        radius = nearest.distance(shards[0].unit[best[best != q]], vectors[q]).max()
        low, high = shards[1].edges((vectors[q] @ shards[1].directions)[None], np.array([radius]))
        found = shards[1].within(low[0], high[0])
        verified += len(found)
        more, more_score = shards[1].best(found, vectors[q], 21)
        merged = sorted([*zip(-score, ids[best]), *zip(-more_score, shards[1].ids[more])])
        got = [i for _, i in merged if i != q][:20]
        hits += len(set(got) & set(exact(ids, vectors, q, 20)))
    assert hits / (20 * len(queries)) >= 0.9
    assert verified / len(queries) < 0.25 * nearest.SHARD


def test_counts_inside_and_outside_agree():
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((300, 8))
    unit = vectors / np.linalg.norm(vectors, axis=1).max()
    shard = nearest.Shard(np.arange(300), np.arange(300), vectors, unit)
    query = unit[7] / np.linalg.norm(unit[7])
    for radius in (0.05, 0.4, 0.9, 1.5, 2.0):
        low, high = shard.edges((query @ shard.directions)[None], np.array([radius]))
        counts = np.zeros(300, dtype=int)
        for o, a, b in zip(shard.order, low[0], high[0], strict=True):
            counts[o[a:b]] += 1
        assert shard.within(low[0], high[0]).tolist() == np.nonzero(counts >= shard.least)[0].tolist()


def test_cells_leave_out_what_cannot_be_reached(spark, monkeypatch):
    """Far apart clusters: each query is answered within its own, and is not sent to the others' shards."""
    monkeypatch.setattr(nearest, "LEAST_CELL", 1)
    rng = np.random.default_rng(8)
    centres = np.linalg.qr(rng.standard_normal((16, 16)))[0][:6]
    vectors = np.repeat(centres, 60, axis=0) + 0.01 * rng.standard_normal((360, 16))
    # A hot vector: a third of all rows.
    vectors = np.vstack([vectors, np.repeat(vectors[:1], 180, axis=0)])
    ids = np.arange(len(vectors))
    saved = {}
    real = Scratch.save

    def save(self, df, name, **options):
        saved[name] = real(self, df, name, **options)
        return saved[name]

    monkeypatch.setattr(Scratch, "save", save)
    rows = nearest.nearest(spark, table(spark, ids, vectors), "id % 20 = 0", neighbours=5, shard=40).collect()
    found = defaultdict(dict)
    for r in rows:
        found[r["query_id"]][r["rank"]] = r["vec_id"]
    hits = sum(len({*found[q].values()} & {*exact(ids, vectors, q, 5)}) for q in range(0, len(ids), 20))
    assert set(found) == set(range(0, len(ids), 20)) and all(sorted(f) == [1, 2, 3, 4, 5] for f in found.values())
    assert hits >= 0.9 * 5 * len(found)
    shards = saved["sizes"].agg({"parts": "sum"}).first()[0]
    assert saved["asks"].count() < 0.7 * len(found) * shards


@pytest.mark.parametrize("size", [1e-200, 1.0, 1e150])
def test_extreme_components(spark, size):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((50, 4))
    ids = np.arange(50)
    rows = nearest.nearest(spark, table(spark, ids, vectors * size), "id = 20", neighbours=5).collect()
    assert [r["rank"] for r in sorted(rows, key=lambda r: r["rank"])] == [1, 2, 3, 4, 5]
    if size == 1.0:
        assert [r["vec_id"] for r in sorted(rows, key=lambda r: r["rank"])] == exact(ids, vectors, 20, 5)


def test_rows_of_one_id_find_each_other(spark):
    vectors = np.array([[1.0, 0.0], [0.9, 0.1], [0.0, 1.0], [-1.0, 0.0]])
    rows = nearest.nearest(spark, table(spark, [20, 20, 7, 3], vectors), "id = 20", neighbours=20).collect()
    got = sorted((r["rank"], r["vec_id"], round(r["score"], 9)) for r in rows)
    # Each row of id 20 is a query; it has three candidates, the other row of its id first.
    assert [g[0] for g in got] == [1, 1, 2, 2, 3, 3]
    assert [g[1:] for g in got[:2]] == [(20, 0.9), (20, 0.9)]
    assert sorted(g[1] for g in got[2:]) == [3, 3, 7, 7]
