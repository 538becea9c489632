"""Toxicity by a character n-gram linear model with naive Bayes log-count ratios.

Features are hashed character n-grams inside words (their ends included), present or absent in a
text.  Training counts, over all partitions, how many toxic and clean labelled texts hold each
feature, turns them into log-count ratios, keeps the most telling features, and fits a logistic
regression on features scaled by those ratios.  It uses at most ``fit_rows`` labelled rows, those of
the smallest hashes of their ids, so their texts are found without a shuffle of the corpus.

Only text is an input of a score.  Rows whose crc32(id as text) mod 3 is 1 never lend a label.

Defined cases: a null or blank text has no features and gets the score of the bias; null ids are
scored and count as the empty text for the split; rows with a null label are ignored; repeated
labelled rows count again; no labelled rows of one kind give the constant share of the other; extra
columns are kept, but one with the score's name is replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import Scratch, fold

#: Documents scoring this or more are rejected.
REJECT_AT = 0.7
BITS = 20
SIZES = (3, 4, 5, 6)
#: Features kept for the fit, and labelled rows that training uses at most.
KEPT = 1 << 11
FIT_ROWS = 20_000
#: A kept feature occurs in at least so many labelled training texts.
LEAST_TEXTS = 6
BLOCK = 1 << 12
#: Gradient steps of the fit, and the weight of its ridge.
STEPS, RIDGE = 600, 3e-5
#: Characters hashed at once.
CHUNK = 1 << 20


def _grams(texts: list[str | None]):
    """(rows, features) of every n-gram, repeats included, a chunk of the texts at a time."""
    start = 0
    while start < len(texts):
        held, total, end = [], 0, start
        while end < len(texts) and (total < CHUNK or end == start):
            held.append((texts[end] or "").lower())
            total += len(held[-1])
            end += 1
        lengths = np.array([len(t) + 2 for t in held])
        codes = np.frombuffer((" " + "  ".join(held) + " ").encode("utf-32-le", "surrogatepass"), dtype="<u4")
        rows = np.repeat(np.arange(start, end), lengths)
        yield from _hashed(codes, rows)
        start = end


def _hashed(codes: np.ndarray, rows: np.ndarray):
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    codes = np.where(space, np.uint32(32), codes)
    inner = np.concatenate([[0], np.cumsum(space)])
    h = codes * np.uint32(0x9E3779B1)
    for n in range(2, max(SIZES) + 1):
        if len(codes) < n:
            return
        h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + codes[n - 1 :] * np.uint32(0xC2B2AE3D)
        if n in SIZES:
            whole = inner[n - 1 : len(codes)] == inner[1 : len(codes) - n + 2]
            found = (h ^ (h >> np.uint32(13))) * np.uint32(0x27D4EB2F) >> np.uint32(32 - BITS)
            yield rows[: len(found)][whole], found[whole]


def features(texts: list[str | None], position: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs in order; with ``position`` only features with one, renumbered by it."""
    keys = [np.zeros(0, dtype=np.int64)]
    size = 1 << BITS
    for rows, found in _grams(texts):
        if position is not None:
            at = position[found]
            there = at >= 0
            rows, found = rows[there], at[there]
        keys.append(np.unique(rows.astype(np.int64) * size + found))
    keys = np.unique(np.concatenate(keys))
    return keys // size, (keys % size).astype(np.int64)


@dataclass
class ToxicityModel:
    """``position``: place of a hashed feature among the kept ones, or -1.  Weights already hold the ratios."""

    position: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        rows, at = features(texts, self.position)
        total = np.bincount(rows, weights=self.weights[at], minlength=len(texts))
        size = np.sqrt(np.bincount(rows, minlength=len(texts)))
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(size, 1) + self.bias, -60, 60)))


def _counts(train: DataFrame) -> DataFrame:
    """Per block of features: how many toxic and clean texts hold each, summed over partitions."""

    def local(batches):
        held = np.zeros((2, 1 << BITS), dtype=np.int64)
        seen = np.zeros(2, dtype=np.int64)
        for batch in batches:
            toxic = batch.column(1).to_numpy()
            texts = batch.column(0).to_pylist()
            for y in (0, 1):
                own = [t for t, z in zip(texts, toxic, strict=True) if z == y]
                seen[y] += len(own)
                for lo in range(0, len(own), 128):
                    held[y] += np.bincount(features(own[lo : lo + 128])[1], minlength=1 << BITS)
        parts = held.reshape(2, -1, BLOCK)
        used = [k for k in range(parts.shape[1]) if parts[:, k].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([*used, -1], pa.int32()), pa.array([*(parts[:, k].tobytes() for k in used), seen.tobytes()], pa.binary())], ["block", "held"]
        )

    def add(key, table):
        held = sum(np.frombuffer(x.as_py(), dtype=np.int64) for x in table.column("held"))
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "held": pa.array([held.tobytes()], pa.binary())})

    local_sums = train.mapInArrow(local, "block int, held binary")
    return local_sums.groupBy("block").applyInArrow(add, "block int, held binary")


def _fit(rows: np.ndarray, at: np.ndarray, y: np.ndarray, ratio: np.ndarray, rounds: int = STEPS, ridge: float = RIDGE) -> tuple[np.ndarray, float]:
    """Logistic regression on ratio-scaled, length-normalised features by accelerated gradient steps."""
    n, k = len(y), len(ratio)
    x = ratio[at] / np.sqrt(np.maximum(np.bincount(rows, minlength=n), 1))[rows]
    norm = np.bincount(rows, weights=x * x, minlength=n).mean() + 1
    rate = 2 / norm
    w, b = np.zeros(k), 0.0
    ahead_w, ahead_b = w, b
    for step in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(rows, weights=x * ahead_w[at], minlength=n) + ahead_b, -60, 60)))
        g = (p - y) / n
        new_w = ahead_w - rate * (np.bincount(at, weights=x * g[rows], minlength=k) + ridge * ahead_w)
        new_b = ahead_b - rate * norm / 4 * g.sum()
        pull = step / (step + 3)
        ahead_w, ahead_b = new_w + pull * (new_w - w), new_b + pull * (new_b - b)
        w, b = new_w, new_b
    return w * ratio, float(b)


def train_toxicity(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", fit_rows: int = FIT_ROWS,
) -> ToxicityModel:
    """Train on the labelled rows of ``docs`` outside the held-out fold."""
    scratch = Scratch(spark, "toxicity")
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).where("toxic IN (0, 1)").where(fold("id", 3) != 1)
    known = scratch.save(known.orderBy(F.xxhash64("id"), "id", "toxic").limit(fit_rows), "sample")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(fold("id", 3) != 1)
    # The sample is at most fit_rows ids and labels: small enough for every task.
    train = scratch.save(texts.join(F.broadcast(known), "id").select("text", "toxic"), "labelled")
    blocks = {r["block"]: np.frombuffer(r["held"], dtype=np.int64) for r in _counts(train).collect()}  # 2 x 2**20 counts at most
    seen = blocks.pop(-1, np.zeros(2, dtype=np.int64))
    if not seen.all():
        share = (seen[1] + 0.5) / (seen.sum() + 1) if seen.sum() else 0.5
        return ToxicityModel(np.full(1 << BITS, -1, dtype=np.int32), np.zeros(1), float(np.log(share / (1 - share))))
    held = np.zeros((2, (1 << BITS) // BLOCK, BLOCK))
    for k, v in blocks.items():
        held[:, k] = v.reshape(2, BLOCK)
    clean, toxic = held.reshape(2, -1) + 1
    ratio = np.log(toxic / (seen[1] + 2)) - np.log(clean / (seen[0] + 2))
    telling = np.abs(ratio) / np.sqrt(1 / toxic + 1 / clean)
    telling[(toxic + clean) < LEAST_TEXTS + 2] = 0
    best = np.sort(np.argsort(-telling, kind="stable")[:KEPT])
    position = np.full(1 << BITS, -1, dtype=np.int32)
    position[best] = np.arange(len(best))
    ratio = ratio[best]

    def reduce(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows, at = features(part.column(0).to_pylist(), position)
                ends = np.searchsorted(rows, np.arange(part.num_rows + 1))
                cells = [at[ends[k] : ends[k + 1]].astype("<u2").tobytes() for k in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([pa.array(cells, pa.binary()), part.column(1)], ["cells", "toxic"])

    reduced = train.mapInArrow(reduce, "cells binary, toxic int")

    def fit(batches):
        cells, ys = [], []
        for batch in batches:
            cells += [np.frombuffer(c, dtype="<u2").astype(np.int64) for c in batch.column(0).to_pylist()]
            ys.append(batch.column(1).to_numpy())
        rows = np.repeat(np.arange(len(cells)), [len(c) for c in cells])
        weights, bias = _fit(rows, np.concatenate(cells), np.concatenate(ys).astype(float), ratio)
        yield pa.RecordBatch.from_arrays([pa.array([np.append(weights, bias).astype("<f8").tobytes()], pa.binary())], ["model"])

    # At most fit_rows reduced rows (a few hundred numbers each) meet in the one task that fits.
    found = np.frombuffer(scratch.save(reduced, "reduced").coalesce(1).mapInArrow(fit, "model binary").first()["model"], dtype="<f8")
    return ToxicityModel(position, found[:-1], float(found[-1]))


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text; the model (6 MB at most) travels with the tasks."""

    docs = docs.drop(score_col)
    shared = docs.sparkSession.sparkContext.broadcast((model.position, model.weights, model.bias))

    def scored(batches):
        own = ToxicityModel(*shared.value)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            found = [own.score(texts.slice(k, 128).to_pylist()) for k in range(0, batch.num_rows, 128)]
            score = pa.array(np.concatenate([np.zeros(0), *found]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], score], [*batch.schema.names[:-1], score_col])

    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])
    return docs.select("*", F.col(text_col).alias("__text")).mapInArrow(scored, schema)
