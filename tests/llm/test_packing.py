"""Packing against sequential best fit, and token ids against the tokenizer itself."""

from __future__ import annotations

import bisect
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import best_fit_packing, token_ids
from strata.llm.common import Scratch

#: Sequences beyond those of sequential best fit that the rounds may need.
MARGIN = 1


def sequential(lengths, size):
    gaps, opened = [], 0
    for n in sorted(lengths, reverse=True):
        k = bisect.bisect_left(gaps, n)
        if k == len(gaps):
            opened += 1
            bisect.insort(gaps, size - n)
        else:
            bisect.insort(gaps, gaps.pop(k) - n)
    return opened


CASES = {
    "even": (64, lambda rng: rng.integers(1, 65, 1500)),
    "halves": (64, lambda rng: rng.integers(15, 33, 900)),
    "one token": (5, lambda rng: np.ones(12, dtype=int)),
    "hot": (32, lambda rng: np.append(np.full(4000, 9), rng.integers(1, 33, 300))),
}


@pytest.mark.parametrize("case", CASES)
def test_rounds_match_sequential_best_fit(spark, case):
    size, make = CASES[case]
    lengths = [int(n) for n in make(np.random.default_rng(5))]
    scratch = Scratch(spark, "test-packing")
    rows = spark.createDataFrame([(k, 0, 0, n, k) for k, n in enumerate(lengths)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    pieces = scratch.save(rows, "pieces")
    counts = best_fit_packing._counts(pieces, "length", size)
    own = best_fit_packing.rank_pieces(pieces, scratch, counts)
    placed = own.join(best_fit_packing.place_pieces(own, scratch, counts, size), ["length", "rank"]).collect()
    assert sorted(r["doc_id"] for r in placed) == list(range(len(lengths)))
    assert Counter(r["length"] for r in placed) == Counter(lengths)
    spans = defaultdict(list)
    for r in placed:
        spans[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in spans.values():
        at = 0
        for begin, n in sorted(own):
            assert begin == at
            at += n
        assert at <= size
    assert len(spans) <= sequential(lengths, size) + MARGIN


def test_sweep_takes_the_smallest_gap_that_fits():
    gaps, pieces = np.zeros(11, dtype=int), np.zeros(11, dtype=int)
    gaps[[9, 7, 4]], pieces[[8, 6, 5, 4]] = [1, 2, 1], 1
    sweep = best_fit_packing.Sweep(gaps, pieces, 8, 1)
    assert sweep.placed.tolist() == pieces.tolist()
    assert sweep.taken.tolist() == gaps.tolist()
    sweep = best_fit_packing.Sweep(gaps * 0, pieces, 8, 1)
    assert not sweep.placed.any() and sweep.missed.tolist() == pieces.tolist()


ALPHABET = [
    " ", "  ", "\n", "\t", "'", "'s", "'re", "a", "B", "1", ".", ",", "\r\n", "it's", "'ll", " '", "\x0b", "<", "|", "é", "ß", "д", "×", "÷",
    "²", "٣", "—", "\u201c", "\u00a0", "\u3000", "\u2003", "\x1c", "\x1f", "\x85", "<|endoftext|>", "<|", "日本", "İ", "\u200b", "\u0301", "🙂", "ʼ", "\u180e", "\x00", "x",
]


@pytest.mark.parametrize("block", [9, 200, token_ids.BLOCK])
def test_ids_equal_the_tokenizer(monkeypatch, block):
    import public_tokenizers
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_ids, "BLOCK", block)
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, encoder = Tokenizer.from_file(path), token_ids.Encoder(path, 0)
    rng = random.Random(block)
    for letters in (ALPHABET, ALPHABET[:19], ALPHABET[:16]):
        texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(1500)]
        found = list(encoder.texts(pa.array([*texts, None, ""])))
        assert [x.tolist() for x in found] == [[*plain.encode(t, add_special_tokens=False).ids, 0] for t in [*texts, "", ""]]


def test_forgetting_changes_nothing(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(token_ids, "REMEMBERED", 3)
    encoder = token_ids.Encoder(public_tokenizers.path("byte_bpe_50k.json"), 7)
    first, again = (list(map(list, encoder.texts(pa.array(["one two three four", "five six"])))) for _ in range(2))
    assert first == again and first[0][-1] == 7


def test_a_worker_goes_on_with_what_it_has_encoded():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = pa.array(["Some words, some more words.", None, "", "others"])
    first = [x.tolist() for x in token_ids.encoder(path, 0).texts(texts)]
    known = len(token_ids.encoder(path, 0).place)
    assert [x.tolist() for x in token_ids.encoder(path, 0).texts(texts)] == first == [x.tolist() for x in token_ids.Encoder(path, 0).texts(texts)]
    assert len(token_ids.encoder(path, 0).place) == known > 1
