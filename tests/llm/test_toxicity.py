"""The toxicity model against plain loops, and its verdicts on held-out texts."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import toxicity
from strata.llm.common import fold

M32 = (1 << 32) - 1


def grams(text):
    """Hashed n-grams of a text: stretches of 3 to 6 characters with no white space but at their ends."""
    chars = [32 if c in " \t\n\x0b\x0c\r" else ord(c) for c in f" {(text or '').lower()} "]
    found = set()
    for at in range(len(chars)):
        h = chars[at] * 0x9E3779B1 & M32
        for n in range(2, max(toxicity.SIZES) + 1):
            if at + n > len(chars):
                break
            h = ((h ^ h >> 15) * 0x85EBCA77 + chars[at + n - 1] * 0xC2B2AE3D) & M32
            if n in toxicity.SIZES and 32 not in chars[at + 1 : at + n - 1]:
                found.add(((h ^ h >> 13) * 0x27D4EB2F & M32) >> (32 - toxicity.BITS))
    return found


def test_scores_against_plain_loops(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "KEPT", 64)
    rng = np.random.default_rng(7)
    plain, bad = ["apple", "pear", "Tree", "blue", "été", "sun"], ["vile", "scum", "Hate"]
    texts, labels = [], []
    for k in range(150):
        toxic = k % 4 == 0
        words = [*rng.choice(plain, size=rng.integers(3, 9)), *(rng.choice(bad, size=2) if toxic else [])]
        texts.append(" ".join(rng.permutation(words)))
        labels.append(int(toxic) if k % 13 else None)
    texts += [None, "", " \n ", "ab", "scum" * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    known = spark.createDataFrame([(k, y) for k, y in enumerate(labels)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, toxicity.train_toxicity(spark, docs, known)).collect()}

    train = [k for k, y in enumerate(labels) if y is not None and zlib.crc32(str(k).encode()) % 3 != 1]
    own = [grams(t) for t in texts]
    seen = [sum(labels[k] == y for k in train) for y in (0, 1)]
    held = np.zeros((2, 1 << toxicity.BITS))
    for k in train:
        held[labels[k], list(own[k])] += 1
    clean, toxic = held[0] + 1, held[1] + 1
    ratio = np.log(toxic / (seen[1] + 2)) - np.log(clean / (seen[0] + 2))
    telling = np.abs(ratio) / np.sqrt(1 / toxic + 1 / clean)
    telling[toxic + clean < toxicity.LEAST_TEXTS + 2] = 0
    best = np.sort(np.argsort(-telling, kind="stable")[: toxicity.KEPT])
    place = {int(f): j for j, f in enumerate(best)}
    x = np.zeros((len(texts), len(best)))
    for k, found in enumerate(own):
        at = [place[f] for f in found if f in place]
        x[k, at] = ratio[best][at] / np.sqrt(max(len(at), 1))
    a, y = x[train], np.array([labels[k] for k in train])
    norm = (a * a).sum() / len(train) + 1
    w = ahead_w = np.zeros(len(best))
    b = ahead_b = 0.0
    for step in range(toxicity.STEPS):
        g = (1 / (1 + np.exp(-(a @ ahead_w + ahead_b))) - y) / len(train)
        new_w, new_b = ahead_w - 2 / norm * (a.T @ g + toxicity.RIDGE * ahead_w), ahead_b - 2 / 4 * g.sum()
        pull = step / (step + 3)
        ahead_w, ahead_b, w, b = new_w + pull * (new_w - w), new_b + pull * (new_b - b), new_w, new_b
    want = 1 / (1 + np.exp(-(x @ w + b)))
    for k in range(len(texts)):
        assert got[k] == pytest.approx(want[k], abs=1e-6)


def test_verdicts_on_held_out_texts(spark):
    """At the threshold of rejection, well above the share of the more frequent label."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score_toxicity(docs, toxicity.train_toxicity(spark, docs, labels)).join(labels, "doc_id").where((fold("doc_id", 3) == 1) & F.col("toxic").isNotNull())
    rows = scored.select("toxic", (F.col("score") >= toxicity.REJECT_AT).alias("rejected")).collect()
    majority = max(sum(r["toxic"] == y for r in rows) for y in (0, 1)) / len(rows)
    right = sum(r["rejected"] == bool(r["toxic"]) for r in rows) / len(rows)
    caught = sum(r["rejected"] for r in rows if r["toxic"]) / sum(r["toxic"] for r in rows)
    left_alone = sum(not r["rejected"] for r in rows if not r["toxic"]) / sum(not r["toxic"] for r in rows)
    assert right > majority + 0.5 * (1 - majority)
    assert caught >= 0.75 and left_alone >= 0.99
