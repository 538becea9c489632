"""Nearest neighbours by inner product with collision-counting hashing.

Vectors are scaled by the largest norm M and given one more coordinate, ``sqrt(1 - |v|^2 / M^2)``; queries are scaled to
norm 1 and get a zero.  All then lie on one sphere, where the largest inner products are the smallest distances.

A shard projects its vectors on ``PROJECTIONS`` random directions and keeps, for each direction, one array of the vectors
sorted by projection.  At radius R a query's window in an array reaches ``WINDOW * R`` to both sides of its own
projection; wider radii are virtual rehashing, they only widen the windows of the same arrays.  A vector that lies in
enough windows is a candidate: the threshold is the count that a vector at distance R misses with probability ``MISS``.
Candidates are verified by their exact inner product on the original vectors.

First each query searches one shard near it, widening R by ``WIDEN`` until as many candidates as asked are verified
within R.  The distance of the last of them bounds the answer.  Then the query goes at that radius, without widening, to
the other shards that it can reach: vectors are dealt into cells, each around a pivot, and a cell whose ball lies
beyond the radius is not visited; within a shard, a query whose windows meet too few arrays stops at once.  So no share
of the index is fixed; how much is verified follows from the radius.  Vectors without any structure, in many dimensions,
have no unreachable cells, and a query then still costs a (cheaper) step in every shard.

The index holds every row.  Queries meet shards in blocks of about ``BLOCK``; a shard is copied once a block that asks it.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part,
nor do rows of null id; only vectors of equal length meet; a query never finds its own row, but other rows of its id;
each row that asks is a query of its own, also where an id is repeated; repeated
rows are candidates each; equal products rank by the smaller id; products that are no number come last; fewer candidates
than asked give all of them; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import Scratch

SHARD, BLOCK = 8192, 4096
PROJECTIONS, WINDOW = 96, 1.5
#: A vector at distance R is no candidate at radius R with about this probability; nearer ones are missed less often.
MISS = 0.15
#: The first radius of the search in one shard, and the factor between radii; no two points are further apart than 2.
FIRST, WIDEN, WIDEST = 0.35, 1.1, 2.0
#: Pivots of one vector length at most, the least vectors of a cell, and how many vector lengths have cells.
PIVOTS, LEAST_CELL, LENGTHS = 256, 1024, 16
SEED = 11
#: Distances below this are rounding.
CLOSE = 1e-6


def threshold(projections: int, window: float, miss: float) -> int:
    """The largest count that a vector at the radius reaches with probability ``1 - miss`` or more."""
    inside = math.erf(window / math.sqrt(2))
    below = 0.0
    for k in range(projections + 1):
        below += math.comb(projections, k) * inside**k * (1 - inside) ** (projections - k)
        if below > miss:
            return k
    return projections


class Shard:
    """Sorted projections of the vectors of one shard.  ``unit``: vectors over the largest norm."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, unit: np.ndarray):
        self.rows, self.ids, self.vectors, self.unit = rows, ids, vectors, unit
        tail = np.sqrt(np.maximum(0, 1 - (unit * unit).sum(axis=1)))
        directions = np.random.default_rng(SEED).standard_normal((vectors.shape[1] + 1, PROJECTIONS))
        self.directions = directions[:-1]
        projected = (unit @ self.directions + tail[:, None] * directions[-1]).T
        self.order = np.argsort(projected, axis=1, kind="stable")
        self.sorted = np.take_along_axis(projected, self.order, axis=1)
        self.least = threshold(PROJECTIONS, WINDOW, MISS)

    def edges(self, at: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows (from, to) in every array, a row for each row of projections ``at``; radii per row."""
        reach = WINDOW * radius + CLOSE
        low, high = np.empty((2, len(at), PROJECTIONS), dtype=np.int64)
        for j, array in enumerate(self.sorted):
            low[:, j] = array.searchsorted(at[:, j] - reach, side="left")
            high[:, j] = array.searchsorted(at[:, j] + reach, side="right")
        return low, high

    def within(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Vectors that lie in enough of one query's windows: those outside are counted, as they are fewer or none need be."""
        n = len(self.ids)
        if (high > low).sum() < self.least:
            return np.zeros(0, dtype=np.int64)
        if (high - low).sum() * 2 < n * PROJECTIONS:
            inside = np.concatenate([o[a:b] for o, a, b in zip(self.order, low, high, strict=True)])
            return np.nonzero(np.bincount(inside, minlength=n) >= self.least)[0]
        outside = np.concatenate([part for o, a, b in zip(self.order, low, high, strict=True) for part in (o[:a], o[b:])])
        return np.nonzero(np.bincount(outside, minlength=n) <= PROJECTIONS - self.least)[0]

    def widening(self, query: np.ndarray, wanted: int) -> np.ndarray:
        """Candidates at the first radius with ``wanted`` vectors verified within it; all if the widest has fewer."""
        steps = math.ceil(math.log(WIDEST / FIRST) / math.log(WIDEN)) + 1
        radii = FIRST * WIDEN ** np.arange(steps)
        at = np.broadcast_to(query @ self.directions, (steps, PROJECTIONS))
        low, high = self.edges(at, radii)
        n = len(self.ids)
        counts = np.zeros(n, dtype=np.int64)
        checked = np.zeros(n, dtype=bool)
        far = np.full(n, np.inf)
        for k, radius in enumerate(radii):
            a, b = (low[k - 1], high[k - 1]) if k else (high[0], high[0])
            # Only what the wider windows add.
            ring = np.concatenate([part for o, p, q, r, s in zip(self.order, low[k], a, b, high[k], strict=True) for part in (o[p:q], o[r:s])])
            counts += np.bincount(ring, minlength=n)
            new = np.nonzero((counts >= self.least) & ~checked)[0]
            checked[new] = True
            far[new] = distance(self.unit[new], query)
            if np.count_nonzero(far <= radius) >= wanted:
                return np.nonzero(checked)[0]
        return np.arange(n)

    def best(self, found: np.ndarray, vector: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` of the found vectors with the largest products, ties to the smaller id."""
        with np.errstate(over="ignore", invalid="ignore", under="ignore"):
            # Summed row by row: equal vectors get equal products.
            score = (self.vectors[found] * vector).sum(axis=1)
        key = np.where(np.isnan(score), -np.inf, score)
        if len(key) > k:
            close = key >= np.partition(key, len(key) - k)[len(key) - k]
            found, score, key = found[close], score[close], key[close]
        order = np.lexsort((self.ids[found], -key, np.isnan(score)))[:k]
        return found[order], score[order]


def distance(unit: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Distances on the sphere, from vectors over the largest norm and a query of norm 1."""
    return np.sqrt(np.maximum(0, 2 - 2 * (unit @ query)))


def _normed(matrix: np.ndarray) -> np.ndarray:
    """Rows of norm 1, whatever their size."""
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    x = F.col("v")
    finite = F.forall(x, lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.where(F.col("id").isNotNull() & x.isNotNull() & finite & F.exists(x, lambda y: y != 0)).select("id", "v", F.size("v").alias("dim"), F.monotonically_increasing_id().alias("row"))


def _scales(valid: DataFrame) -> DataFrame:
    """(dim, top, largest, n): the largest component, the largest norm over it, and how many vectors there are."""
    tops = valid.groupBy("dim").agg(F.max(F.array_max(F.transform("v", F.abs))).alias("top"), F.count("*").alias("n"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, y: a + (y / F.col("top")) * (y / F.col("top"))))
    return valid.join(tops, "dim").select("dim", "top", "n", norm.alias("norm")).groupBy("dim", "top", "n").agg(F.max("norm").alias("largest"))


def _lifted(matrix: np.ndarray, top: float, largest: float) -> np.ndarray:
    """Points on the sphere for vectors."""
    unit = matrix / top / largest
    return np.hstack([unit, np.sqrt(np.maximum(0, 1 - (unit * unit).sum(axis=1)))[:, None]])


def _pivots(valid: DataFrame, scales: DataFrame, shard: int) -> dict[int, tuple[np.ndarray, float, float]]:
    """Pivots (points on the sphere) and scales of the most frequent vector lengths that fill two shards."""
    large = scales.where(F.col("n") >= 2 * shard).orderBy(F.desc("n"), "dim").limit(LENGTHS).collect()
    out = {}
    for r in large:
        some = valid.where(F.col("dim") == r["dim"]).orderBy(F.xxhash64("row")).limit(min(PIVOTS, -(-r["n"] // shard))).select("v").collect()
        out[r["dim"]] = (_lifted(np.array([x["v"] for x in some]), r["top"], r["largest"]), r["top"], r["largest"])
    return out


def _in_cells(rows: DataFrame, pivots: dict, asks: bool) -> DataFrame:
    """``rows`` with their cell (that of the nearest pivot) and the distance to the pivot."""
    fields = rows.columns

    def run(batches):
        for batch in batches:
            dims = batch.column(fields.index("dim")).to_numpy()
            vectors = batch.column(fields.index("v"))
            cell, far = np.zeros(batch.num_rows, dtype=np.int32), np.full(batch.num_rows, WIDEST)
            for dim, (points, top, largest) in pivots.items():
                own = np.nonzero(dims == dim)[0]
                if len(own):
                    matrix = _matrix(vectors.take(pa.array(own)), dim)
                    at = np.hstack([_normed(matrix), np.zeros((len(own), 1))]) if asks else _lifted(matrix, top, largest)
                    near = at @ points.T
                    cell[own] = near.argmax(axis=1)
                    far[own] = np.sqrt(np.maximum(0, 2 - 2 * near.max(axis=1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], [*fields, "cell", "far"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{schema}, cell int, far double")


KEYS = ["dim", "cell", "part"]
FOUND = "query_row long, query_id long, vec_id long, score double, far double"


def _search(base: DataFrame, asks: DataFrame, neighbours: int) -> DataFrame:
    """(query_row, query_id, vec_id, score, far): the nearest of every shard that a query asks; a null radius widens."""
    # An ask table has a row a query and shard; blocks part the asks of one shard.
    blocks = asks.groupBy(*KEYS).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    b, a = base.alias("b"), asks.alias("a")
    here = b.join(blocks, KEYS).select(*KEYS, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(False).alias("asks"), "row", "id", "v", "top", "largest", F.lit(None).cast("double").alias("radius"))
    there = a.join(blocks, KEYS).select(*KEYS, F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int").alias("block"), F.lit(True).alias("asks"), "row", "id", "v", F.lit(None).cast("double").alias("top"), F.lit(None).cast("double").alias("largest"), "radius")

    def search(key, table):
        dim = key[0].as_py()
        asking = table.column("asks").to_numpy()
        row, ids = (table.column(c).to_numpy() for c in ("row", "id"))
        matrix = _matrix(table.column("v"), dim)
        out: list[tuple] = []
        if asking.any() and not asking.all():
            held = np.nonzero(~asking)[0]
            first = int(held[0])
            scale = table.column("top")[first].as_py(), table.column("largest")[first].as_py()
            shard = Shard(row[held], ids[held], matrix[held], matrix[held] / scale[0] / scale[1])
            at = np.nonzero(asking)[0]
            radius = table.column("radius").to_numpy(zero_copy_only=False)[at].astype(float)
            units = _normed(matrix[at])
            known = ~np.isnan(radius)
            low, high = shard.edges(units @ shard.directions, np.where(known, radius, 0.0))
            seen: dict[bytes, tuple] = {}
            for k, q in enumerate(at.tolist()):
                same = matrix[q].tobytes()
                if same not in seen:
                    found = shard.within(low[k], high[k]) if known[k] else shard.widening(units[k], neighbours + 1)
                    best, score = shard.best(found, matrix[q], neighbours + 1)
                    seen[same] = best, score, distance(shard.unit[best], units[k])
                best, score, far = seen[same]
                keep = shard.rows[best] != row[q]
                if known[k]:
                    keep &= far <= radius[k] + CLOSE
                keep = np.nonzero(keep)[0][:neighbours]
                out.append((np.full(len(keep), row[q]), np.full(len(keep), ids[q]), shard.ids[best[keep]], score[keep], far[keep]))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0)] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.table([pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in FOUND.split(", ")])

    return here.unionByName(there).groupBy(*KEYS, "block").applyInArrow(search, FOUND)


def _reachable(asks: DataFrame, pivots: dict, radii: dict[tuple[int, int], float]) -> DataFrame:
    """``asks`` (with their radius) once for each cell whose ball they reach."""
    fields = [f for f in asks.columns if f != "cell"]
    cells = {d: np.array([radii.get((d, k), -np.inf) for k in range(len(points))]) for d, (points, _, _) in pivots.items()}

    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            radius = batch.column("radius").to_numpy()
            at, to = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
            for dim in np.unique(dims).tolist():
                own = np.nonzero(dims == dim)[0]
                if dim not in pivots:
                    at.append(own)
                    to.append(np.zeros(len(own), dtype=np.int64))
                    continue
                unit = _normed(_matrix(batch.column("v").take(pa.array(own)), dim))
                far = np.sqrt(np.maximum(0, 2 - 2 * (unit @ pivots[dim][0][:, :-1].T)))
                i, j = np.nonzero(far - cells[dim] <= radius[own][:, None] + CLOSE)
                at.append(own[i])
                to.append(j)
            some = batch.select(fields).take(pa.array(np.concatenate(at)))
            yield pa.RecordBatch.from_arrays([*some.columns, pa.array(np.concatenate(to).astype(np.int32))], [*fields, "cell"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asks.schema.fields if f.name != "cell")
    return asks.mapInArrow(run, f"{schema}, cell int")


def nearest(spark: SparkSession, vectors: DataFrame, queries_where: str, *, id_col: str = "vec_id", vector_col: str = "embedding", neighbours: int = 20, shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows for which ``queries_where`` (an expression on ``id``) holds."""
    scratch = Scratch(spark, "nearest")
    valid = scratch.save(_valid(vectors, id_col, vector_col), "valid")
    scales = scratch.save(_scales(valid), "scales")
    pivots = _pivots(valid, scales, shard)
    if pivots:
        # Pivots with small cells are left out; their vectors go to the next pivot.
        counts = {(r["dim"], r["cell"]): r["n"] for r in _in_cells(valid, pivots, False).groupBy("dim", "cell").agg(F.count("*").alias("n")).where(F.col("dim").isin(list(pivots))).collect()}
        for dim, (points, *scale) in list(pivots.items()):
            n = np.array([counts.get((dim, k), 0) for k in range(len(points))])
            pivots[dim] = (points[(n >= LEAST_CELL) | (n == n.max())], *scale)
    cells = scratch.save(_in_cells(valid, pivots, False), "cells")
    sizes = scratch.save(cells.groupBy("dim", "cell").agg(F.ceil(F.count("*") / shard).cast("int").alias("parts"), F.max("far").alias("far")), "sizes")
    # A repeated or common vector is spread over the parts of its cell by its row.
    base = cells.drop("far").join(sizes.drop("far"), ["dim", "cell"]).join(scales.drop("n"), "dim").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
    asking = scratch.save(_in_cells(valid.where(queries_where), pivots, True).drop("far"), "asking")
    # A cell without vectors has no shard: such a query starts in its own vector's cell.
    own = cells.select("row", F.col("cell").alias("own"))
    home = asking.join(sizes.drop("far"), ["dim", "cell"], "left").join(own, "row").withColumn("cell", F.when(F.col("parts").isNull(), F.col("own")).otherwise(F.col("cell"))).drop("parts", "own")
    home = home.join(sizes.drop("far"), ["dim", "cell"]).select("row", "id", "v", *KEYS[:2], F.pmod(F.xxhash64("row", "id"), F.col("parts")).cast("int").alias("part"), F.lit(None).cast("double").alias("radius"))
    home = scratch.save(home, "home")
    first = scratch.save(_search(base, home, neighbours), "first")

    bounds = first.groupBy("query_row").agg(F.when(F.count("*") >= neighbours, F.max("far")).otherwise(F.lit(WIDEST)).alias("bound"))
    asks = home.withColumnRenamed("part", "home_part").withColumn("home_cell", F.col("cell")).join(bounds, F.col("row") == F.col("query_row"), "left").withColumn("radius", F.coalesce("bound", F.lit(WIDEST)) + CLOSE).drop("query_row", "bound")
    radii = {(r["dim"], r["cell"]): r["far"] for r in sizes.where(F.col("dim").isin(list(pivots))).collect()} if pivots else {}  # at most PIVOTS * LENGTHS rows
    reach = _reachable(asks, pivots, radii).join(sizes.drop("far"), ["dim", "cell"])
    reach = reach.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("cell <> home_cell OR part <> home_part")
    reach = scratch.save(reach.select("row", "id", "v", *KEYS, "radius"), "asks")
    found = scratch.save(_search(base, reach, neighbours), "found").unionByName(first)
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.isnan("score"), F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= neighbours).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def recall(found: list[int], exact: list[int]) -> float:
    return len(set(found) & set(exact)) / max(len(exact), 1)
