"""Training on whole texts and the model's score against plain loops over one text at a time."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from strata.llm import hmm


def forward_backward(seq, start, move, emit):
    """Expected counts of one sequence, step by step."""
    k = len(start)
    alpha, scale = np.zeros((len(seq), k)), np.zeros(len(seq))
    for t, x in enumerate(seq):
        now = (start if t == 0 else alpha[t - 1] @ move) * emit[x]
        scale[t] = now.sum()
        alpha[t] = now / scale[t]
    beta = np.ones(k)
    starts, moves, emits = np.zeros(k), np.zeros((k, k)), np.zeros_like(emit)
    for t in range(len(seq) - 1, -1, -1):
        emits[seq[t]] += alpha[t] * beta
        if t == 0:
            starts += alpha[0] * beta
        else:
            ahead = emit[seq[t]] * beta / scale[t]
            moves += np.outer(alpha[t - 1], ahead) * move
            beta = move @ ahead
    return starts, moves, emits, np.log(scale).sum()


@pytest.mark.parametrize(("stretch", "together"), [(1, 7), (3, 1 << 18), (5, 20), (1 << 20, 1 << 18)])
def test_expected_counts_are_those_of_whole_texts(monkeypatch, stretch, together):
    monkeypatch.setattr(hmm, "STRETCH", stretch)
    monkeypatch.setattr(hmm, "TOGETHER", together)
    rng = np.random.default_rng(6)
    start, move, emit = rng.random(3), rng.random((3, 3)) ** 3, rng.random((5, 3)) ** 2
    p = hmm.Parameters(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    texts = [rng.integers(0, 5, n) for n in (1, 2, 3, 4, 6, 7, 17, 40, 1, 15)]
    got = hmm._expected(texts, p)
    want = [sum(x) for x in zip(*(forward_backward(s, p.start, p.move, p.emit) for s in texts), strict=True)]
    for a, b in zip(got, want, strict=True):
        np.testing.assert_allclose(a, b, rtol=1e-9, atol=1e-12)


def test_score_of_the_trained_model(spark, monkeypatch):
    """The whole operator, training included, repeated with plain loops."""
    monkeypatch.setattr(hmm, "STRETCH", 4)
    monkeypatch.setattr(hmm, "ROUNDS", 3)
    rng = np.random.default_rng(1)
    words = ["ab", "Cd", "é", "x" * 40, "1", "one", "Two"]
    texts = [" ".join(rng.choice(words, size=n)) for n in (0, 1, 2, 3, 5, 9, 30, 12, 7, 7, 4, 8)] + [None, "never seen"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in hmm.score_texts(spark, docs, states=3, rounds=3).collect()}

    tokens = [[*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), " "] for t in texts]
    held = [zlib.crc32(str(k).encode()) % 5 == 1 for k in range(len(texts))]
    assert any(held) and not all(held)
    kind = lambda w: xxhash.xxh64_intdigest(w.encode()) % hmm.CLASSES
    count = Counter(w for ts, h in zip(tokens, held, strict=True) if not h for w in ts)
    size, distinct = np.zeros(hmm.CLASSES), np.zeros(hmm.CLASSES)
    for w, n in count.items():
        size[kind(w)] += n
        distinct[kind(w)] += 1
    first = hmm._begin(size, 3)
    start, move, emit = first.start, first.move, first.emit
    prior = (size + 0.5) / (size + 0.5).sum()
    for _ in range(3):
        sums = [sum(x) for x in zip(*(forward_backward([kind(w) for w in ts], start, move, emit) for ts, h in zip(tokens, held, strict=True) if not h), strict=True)]
        start, move, emit = sums[0] + 0.5, sums[1] + 0.5, sums[2] + 50 * prior[:, None]
        start, move, emit = start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0)
    for k, ts in enumerate(tokens):
        latent = forward_backward([kind(w) for w in ts], start, move, emit)[3] / math.log(10)
        within = sum(math.log10((count[w] + 0.5) / (size[kind(w)] + 0.5 * (distinct[kind(w)] + 1))) for w in ts)
        assert rows[k]["score"] == pytest.approx(latent + within, rel=1e-9)
        assert rows[k]["held_out"] == held[k] and rows[k]["n_tokens"] == len(ts)


def test_chunks_travel_in_small_batches(monkeypatch):
    """A chunk's texts and words leave in bounded batches, and are the same however few texts are looked at together."""
    texts = [" ".join(f"W{(397 * k + j) % 50_000}" for j in range(400)) for k in range(1500)] + [None, "", " \t", "é É x X"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array([False] * len(texts)), pa.array(texts)], ["doc_id", "held_out", "text"])

    def rows():
        out = list(hmm._chunks(iter([batch]), 0))
        return out, [r for b in out for r in b.to_pylist()]

    sent, want = rows()
    assert max(b.num_rows for b in sent) <= hmm.SENT and max(b.nbytes for b in sent) <= 4 * hmm.LOOKED and len(sent) > 2
    words = [r["word"].decode() for r in want if r["kind"] == "word"]
    for r, text in zip((r for r in want if r["kind"] == "text"), texts, strict=True):
        plain = "".join(c.lower() if c.isascii() else c for c in text or "").split()
        assert [words[k] for k in np.frombuffer(r["tokens"], "<i4")] == [*plain, " "]
    monkeypatch.setattr(hmm, "LOOKED", 1)
    # One text at a time: the rows are the same.
    monkeypatch.setattr(hmm, "_sliced", lambda b: [b])
    assert rows()[1] == want
