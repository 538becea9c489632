"""SimHash near-duplicates: fingerprints, exact tiled comparison, components.

Equal fingerprints are collapsed and dealt into tiles; a tile pair is compared with numpy's
exclusive-or and bit counts.  Pairs of tiles whose population counts differ by more than the
radius never meet, and within a pair a block of rows meets only those of population counts within the radius.  For a radius of at most 3 the tiles are first parted by bands: the 64 bits form
``radius + 2`` bands, two linked fingerprints agree in at least two of them, so only tiles that
share two bands are compared and no link is lost.  For a larger radius every tile pair within the
radius of population counts is compared: exact, but the square of the distinct fingerprints, which
``ratio`` lessens: texts whose numbers of distinct shingles are further apart than this ratio cannot be
as similar as that, and meet only if they lie in one of the overlapping ranges of sizes.  A tile pair reports a spanning forest of its links, never all pairs, so large groups cost no square in rows.

``words`` > 1 makes wider fingerprints: the first 64 bits are compared as above, and a link must
also hold ``wide_radius`` over all ``64 * words`` bits, which sharpens the threshold.

Defined cases: null and blank texts have fingerprint zero and are linked like any other; null ids
get a null component and do not link; repeated rows share fingerprint and component; extra columns
are ignored by the result and kept by ``keep``; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import Scratch, bloom_words, might_contain
from strata.llm.components import connected_components

SEED = 42
#: Fingerprints in a tile, about.
TILE = 4096
#: Shingles whose bits are counted at once.
CHUNK = 1 << 15


def shingles(text: str | None, width: int) -> list[bytes]:
    """Word shingles of the text with A-Z lower-cased, repeats included; fewer words give one shingle of all."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    line = b" ".join(words)
    if len(words) <= width:
        return [line] if words else []
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: len(words) - width]]
    return [line[a : b - 1] for a, b in zip(starts, ends[width - 1 :], strict=True)]


def _spread(h: np.ndarray, words: int) -> np.ndarray:
    """``words`` 64-bit hashes from each hash; the first is the hash itself."""
    out = np.empty((len(h), words), dtype="<u8")
    out[:, 0] = h
    for k in range(1, words):
        z = h + np.uint64(k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out[:, k] = z ^ (z >> np.uint64(31))
    return out


def signatures(texts: list[str | None], width: int, words: int = 1, sizes: list[int] | None = None) -> np.ndarray:
    """A row of ``words`` 64-bit numbers a text: bit b is set if it is set in over half of the shingles' hashes.

    ``sizes`` gets the number of distinct shingles of each text.
    """
    digest = xxhash.xxh64_intdigest
    counts = np.zeros((len(texts), 64 * words), dtype=np.int64)
    totals = np.zeros(len(texts), dtype=np.int64)
    held: list[int] = []
    owners: list[int] = []
    starts: list[int] = []

    def flush() -> None:
        if held:
            bits = np.unpackbits(_spread(np.array(held, dtype="<u8"), words).view(np.uint8), axis=1, bitorder="little")
            np.add.at(counts, owners, np.add.reduceat(bits, starts, axis=0, dtype=np.int32))
            held.clear(), owners.clear(), starts.clear()

    for row, text in enumerate(texts):
        parts = shingles(text, width)
        totals[row] = len(parts)
        if sizes is not None:
            sizes.append(len(set(parts)))
        for k in range(0, len(parts), CHUNK):
            owners.append(row)
            starts.append(len(held))
            held.extend(digest(x, SEED) for x in parts[k : k + CHUNK])
            if len(held) >= CHUNK:
                flush()
    flush()
    return np.packbits(2 * counts > totals[:, None], axis=1, bitorder="little").view("<u8").reshape(len(texts), words)


def fingerprints(docs: DataFrame, *, id_col: str, text_col: str, width: int, words: int = 1, sized: bool = False) -> DataFrame:
    """(doc_id, fp, wide, size) for every row; ``wide`` holds the words after the first; size is 0 unless ``sized``."""

    def run(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                batch = whole.slice(lo, 256)
                sizes: list[int] = []
                found = signatures(batch.column(1).to_pylist(), width, words, sizes if sized else None)
                size = pa.array(sizes if sized else [0] * batch.num_rows, pa.int64())
                wide = pa.array([row.tobytes() for row in found[:, 1:]], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found[:, 0].view(np.int64)), wide, size], ["doc_id", "fp", "wide", "size"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long, wide binary, size long")


#: Rows of a tile that are compared at once with those of like population counts.
ROWS = 128


def _join(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Make the labels of linked rows equal, each the smallest row of its component."""
    while True:
        a, b = labels[i], labels[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        low = np.minimum(a, b)
        np.minimum.at(labels, np.maximum(a, b), low)
        while (jumped := labels[labels]).tobytes() != labels.tobytes():
            labels[:] = jumped


def _forest(a: np.ndarray, b: np.ndarray, radius: int, wide_radius: int, within: bool) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links between two tiles (rows of 64-bit words), or within one: rows of ``a`` and ``b`` joined as one list.

    Rows are put in order of population counts.  A block of rows meets only the stretch of the other side whose
    counts differ by at most the radius; the rest is skipped.
    """
    counts_a, counts_b = (np.bitwise_count(x[:, 0]).astype(np.int64) for x in (a, b))
    order_a, order_b = np.argsort(counts_a, kind="stable"), np.argsort(counts_b, kind="stable")
    first_a, first_b = a[order_a, 0], b[order_b, 0]
    counts_a, counts_b = counts_a[order_a], counts_b[order_b]
    shift = 0 if within else len(a)
    labels = np.arange(shift + len(b))
    for lo in range(0, len(a), ROWS):
        hi = min(lo + ROWS, len(a))
        start = int(np.searchsorted(counts_b, counts_a[lo] - radius, side="left"))
        if within:
            start = max(start, lo)
        end = int(np.searchsorted(counts_b, counts_a[hi - 1] + radius, side="right"))
        for at in range(start, end, TILE):
            i, j = np.nonzero(np.bitwise_count(first_a[lo:hi, None] ^ first_b[None, at : min(at + TILE, end)]) <= radius)
            i, j = order_a[i + lo], order_b[j + at]
            if a.shape[1] > 1 and len(i):
                near = np.bitwise_count(a[i] ^ b[j]).sum(axis=1, dtype=np.int64) <= wide_radius
                i, j = i[near], j[near]
            _join(labels, i, j + shift)
    joined = np.nonzero(labels != np.arange(len(labels)))[0]
    return joined, labels[joined]


def _bands(radius: int) -> list[int]:
    """Masks of two bands each such that fingerprints within the radius agree under at least one; all bits of none if too wide."""
    if radius > 3:
        return [0]
    n = radius + 2
    edges = [64 * k // n for k in range(n + 1)]
    band = [sum(1 << b for b in range(edges[k], edges[k + 1])) for k in range(n)]
    return [band[i] | band[j] for i, j in itertools.combinations(range(n), 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, scratch: Scratch, *, radius: int, wide_radius: int = 0, tile: int = TILE, ratio: float | None = None) -> DataFrame:
    """(u, v) links between the ``rep`` ids of distinct (rep, fp, wide, size) rows: spanning forests, tile pair by tile pair."""
    keys = F.array(*[F.struct(F.lit(k).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("value")) for k, m in enumerate(_bands(radius))])
    if ratio:
        # Two neighbouring ranges of sizes make one value, so sizes within the ratio share one at least.
        near = F.floor(F.log(F.greatest("size", F.lit(1))) / float(-np.log(ratio)))
        keys = F.array(*[F.struct(F.lit(0).alias("mask"), (near + k).alias("value")) for k in (0, 1)])
    rows = fps.select(F.struct("rep", "fp", "wide").alias("x"), F.bit_count("fp").alias("pop"), F.explode(keys).alias("k")).select("x", "pop", "k.mask", "k.value")
    # How many tiles each population count of each band value needs; at most 65 entries a value.
    sizes = (
        rows.groupBy("mask", "value", "pop").agg(F.count("*").alias("n"))
        .groupBy("mask", "value").agg(F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("pop", F.ceil(F.col("n") / tile).cast("int")))).alias("tiles"))
        .where("n > 1")
    )
    sizes = scratch.save(sizes, "tile-sizes")
    one = F.col("n") <= tile
    dealt = rows.join(sizes, ["mask", "value"]).select(
        "mask", "value", F.when(one, F.lit(-1)).otherwise(F.col("pop")).alias("pop"),
        F.when(one, F.lit(0)).otherwise(F.pmod(F.xxhash64("x.fp", "x.wide"), F.element_at("tiles", F.col("pop"))).cast("int")).alias("part"), "x",
    )
    tiles = scratch.save(dealt.groupBy("mask", "value", "pop", "part").agg(F.collect_list("x").alias("xs")), "tiles")
    kind = tiles.schema["xs"].dataType
    small = tiles.where("pop < 0").select(F.col("xs").alias("a"), F.lit(None).cast(kind).alias("b"))
    big = tiles.where("pop >= 0").join(sizes.select("mask", "value", "tiles"), ["mask", "value"])
    # A tile meets the tiles of population counts within the radius; a pair is named by its lower and upper (pop, part).
    me = F.struct("pop", "part")
    near = F.filter(F.sequence(F.col("pop") - radius, F.col("pop") + radius), lambda q: F.map_contains_key("tiles", q))
    others = F.flatten(F.transform(near, lambda q: F.transform(F.sequence(F.lit(0), F.element_at("tiles", q) - 1), lambda j: F.struct(q.alias("pop"), j.alias("part")))))
    met = big.select("mask", "value", "xs", me.alias("me"), F.explode(others).alias("you")).select(
        "mask", "value", "xs", F.least("me", "you").alias("lo"), F.greatest("me", "you").alias("hi"), (F.col("me") > F.col("you")).alias("upper"),
    )
    pairs = met.groupBy("mask", "value", "lo", "hi").agg(
        F.flatten(F.collect_list(F.when(~F.col("upper"), F.col("xs")))).alias("a"),
        F.flatten(F.collect_list(F.when(F.col("upper"), F.col("xs")))).alias("b"),
    ).where("size(a) > 0").select("a", F.when(F.col("lo") != F.col("hi"), F.col("b")).alias("b"))

    def tile_of(xs) -> tuple[np.ndarray, np.ndarray]:
        rep, fp, wide = xs.values.flatten()
        wide = b"".join(wide.to_pylist())
        rest = np.frombuffer(wide, dtype="<u8").reshape(len(rep), -1)
        return rep.to_numpy(), np.hstack([fp.to_numpy().view("<u8")[:, None], rest])

    def run(batches):
        for batch in batches:
            us, vs = [], []
            for x, y in zip(batch.column(0), batch.column(1), strict=True):
                ids_a, a = tile_of(x)
                ids_b, b = tile_of(y) if y.is_valid else (ids_a, a)
                i, j = _forest(a, b, radius, wide_radius, not y.is_valid)
                ids = np.concatenate([ids_a, ids_b]) if y.is_valid else ids_a
                us.append(ids[i])
                vs.append(ids[j])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(z).astype(np.int64)) for z in (us, vs)], ["u", "v"])

    return small.where("size(a) > 1").unionByName(pairs).mapInArrow(run, "u long, v long")


@dataclass
class NearDuplicates:
    """``assignments``: a row per document (doc_id, fp, component_id)."""

    assignments: DataFrame
    id_col: str

    def keep(self, docs: DataFrame) -> DataFrame:
        """One document of each group: drops those whose component is another document, and repeats of one id.

        Rows of null id have no component and stay.
        """
        # The dropped ids are few beside the corpus: whole texts are shuffled for the join only where a filter finds their id.
        scratch = Scratch(docs.sparkSession, "gone")
        gone = scratch.save(self.assignments.where("component_id <> doc_id").select("doc_id").distinct(), "ids")
        maybe = might_contain(scratch.save(bloom_words(gone, F.col("doc_id")), "filter"), docs[self.id_col].cast("long"))
        hit = docs.where(maybe)
        left = docs.where(~maybe).unionByName(hit.join(gone, hit[self.id_col] == gone["doc_id"], "left_anti"))
        again = self.assignments.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 AND doc_id IS NOT NULL")
        if again.isEmpty():
            return left
        once = left.join(again.select("doc_id"), left[self.id_col] == again["doc_id"], "left_anti")
        twice = left.join(again.select("doc_id"), left[self.id_col] == again["doc_id"], "left_semi").dropDuplicates([self.id_col])
        return once.unionByName(twice)


def near_duplicates(
    spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    width: int = 3, radius: int = 2, words: int = 1, wide_radius: int = 0, tile: int = TILE, ratio: float | None = None,
) -> NearDuplicates:
    """Fingerprint every whole text, link within ``radius`` bits, label components by their smallest id.

    ``ratio`` needs a radius above 3, where no bands part the fingerprints.
    """
    if ratio and radius <= 3:
        raise ValueError("ratio is for a radius above 3")
    scratch = Scratch(spark, "simhash")
    fps = scratch.save(fingerprints(docs, id_col=id_col, text_col=text_col, width=width, words=words, sized=bool(ratio)), "fps")
    reps = scratch.save(fps.groupBy("fp", "wide", "size").agg(F.min("doc_id").alias("rep")).where("rep IS NOT NULL"), "reps")
    edges = scratch.save(links(reps, scratch, radius=radius, wide_radius=wide_radius, tile=tile, ratio=ratio).distinct(), "links")
    roots = connected_components(edges, scratch)
    labelled = scratch.save(reps.join(roots, reps["rep"] == roots["node"], "left").select("fp", "wide", "size", F.coalesce("root", "rep").alias("component_id")), "labelled")
    result = fps.join(labelled, ["fp", "wide", "size"], "left").select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
    return NearDuplicates(scratch.save(result, "assignments"), id_col)
