"""Hidden Markov language model over whole texts, beside a smoothed unigram base.

Tokens are the lower-cased words of a text and one end.  A token belongs to one of ``classes``
classes by a hash; hidden states emit classes, and a class emits its tokens by their smoothed share
of the class's training tokens.  Both factors are probabilities of the text, so the scaled forward
recursion over the classes plus the sum of the tokens' shares is the model's exact likelihood.

Baum-Welch: every round runs forward and backward over all whole training texts in every partition;
expected counts are added across partitions and only the sums (classes x states numbers) reach the driver.  Longer texts
are held as stretches of ``STRETCH`` tokens with exact messages at their borders, so a text of any length takes bounded
memory and loses no transition.  Token counts cover all training texts: the distinct
tokens of each chunk of texts meet once by token, where their counts are summed, and go back to their
chunk as numbers, never as a whole vocabulary.  A token has at most one row a chunk, however frequent.

Rows of which crc32(id as text) mod 5 is 1 are held out of all counts.

Defined cases: a null text is empty and has the end as its only token; null ids count as the empty
text for the split and are scored; repeated rows count and are scored again; a text of any length is
scored whole; without training rows every count is 0 and every token unknown; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import Scratch, fold

STATES = 8
CLASSES = 1 << 14
#: Rounds of training at most, and the gain in log likelihood a token below which it ends.
ROUNDS, SETTLED = 6, 1e-4
#: Tokens of a stretch, and tokens (with padding) that are worked out together.
STRETCH, TOGETHER = 2048, 1 << 19
#: Classes whose sums travel in one row, and partitions whose rows are added first.
BLOCK, FAN = 256, 512
#: Bytes of text in a chunk, about, how many texts it has at most, and the token that ends a text (no word holds a space).
CHUNK, MOST_TEXTS = 16 << 20, 32_768
#: Bytes of text whose words are looked for together, and rows that travel together.
LOOKED, SENT = 1 << 20, 1 << 15
END = b" "


#: Bytes that separate words, and bytes with A-Z lower-cased.
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
LOWERED = np.array([k + 32 if 0x41 <= k <= 0x5A else k for k in range(256)], dtype=np.uint8)


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Number of every token in order, the distinct tokens by number, and where each text's tokens end.

    Words are looked for in a few texts at a time; their tokens are dictionary-encoded together.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    reached = np.cumsum(pc.binary_length(texts).to_numpy())
    columns, ends, lo = [], [], 0
    while lo < len(texts):
        done = reached[lo - 1] if lo else 0
        hi = min(int(np.searchsorted(reached, done + LOOKED)) + 1, len(texts))
        column, last = _split(texts.slice(lo, hi - lo))
        columns.append(column)
        ends.append(last + (ends[-1][-1] if ends else 0))
        lo = hi
    coded = pa.chunked_array(columns, pa.large_binary()).dictionary_encode().unify_dictionaries()
    distinct = coded.chunk(0).dictionary
    distinct = pc.if_else(pc.equal(pc.binary_length(distinct), 0), pa.scalar(END, pa.large_binary()), distinct).cast(pa.binary())
    return np.concatenate([c.indices.to_numpy() for c in coded.chunks]), distinct, np.concatenate(ends)


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The tokens of the texts as one column, the empty word for an end, and where each text's tokens end.

    The bytes of words are moved together, so that they form one Arrow column.
    """
    _, offsets, buffer = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = (np.frombuffer(buffer, dtype=np.uint8) if buffer is not None and buffer.size else np.zeros(0, dtype=np.uint8))[at[0] : at[-1]]
    begins, ends = at[:-1] - at[0], at[1:] - at[0]
    inside = ~SPACES[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    first = begins[begins < len(data)]
    starts[first] = inside[first]
    reached = np.zeros(len(starts) + 1, dtype=np.int32)
    np.cumsum(starts, dtype=np.int32, out=reached[1:])
    packed = LOWERED[data[inside]]
    edges = np.append(np.flatnonzero(starts[inside]), len(packed))
    last = reached[ends].astype(np.int64)
    edges = np.insert(edges[:-1], last, edges[last])
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges), [None, pa.py_buffer(np.append(edges, len(packed))), pa.py_buffer(packed)])
    return column, last + np.arange(1, len(texts) + 1)


def _slices(numbers: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A row of bytes for each stretch of numbers."""
    offsets = np.append(0, ends).astype(np.int64) * numbers.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(numbers)]).cast(pa.binary())


def _sliced(batch: pa.RecordBatch):
    """The rows in batches of ``SENT`` rows, and of about ``LOOKED`` bytes on average."""
    rows = max(1, min(SENT, batch.num_rows * LOOKED // max(batch.nbytes, 1)))
    for lo in range(0, batch.num_rows, rows):
        yield batch.slice(lo, rows)


def _chunks(batches, start: int):
    """Encode batches of (doc_id, held_out, text) into rows of texts and of the chunk's vocabulary."""
    parts: list[pa.RecordBatch] = []
    size = rows = 0
    number = start

    def flush():
        table = pa.Table.from_batches(parts).combine_chunks()
        ids, held, texts = (table.column(k).chunk(0) for k in range(3))
        tokens, words, ends = _words(texts)
        classes = np.fromiter((xxhash.xxh64_intdigest(w.as_buffer()) % CLASSES for w in words), dtype="<u2", count=len(words))
        train = np.repeat(~held.to_numpy(zero_copy_only=False).astype(bool), np.diff(ends, prepend=0))
        n, v = len(ids), len(words)
        yield from _sliced(pa.RecordBatch.from_arrays(
            [
                pa.array(["text"] * n, pa.string()), pa.array(np.full(n, number)), ids, held, _slices(tokens.astype("<i4"), ends), _slices(classes[tokens], ends),
                pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()),
            ],
            names=NAMES,
        ))
        yield from _sliced(pa.RecordBatch.from_arrays(
            [
                pa.array(["word"] * v, pa.string()), pa.array(np.full(v, number)), pa.array(np.arange(v)), pa.nulls(v, pa.bool_()), pa.nulls(v, pa.binary()),
                pa.nulls(v, pa.binary()), words, pa.array(np.bincount(tokens[train], minlength=v)), pa.array(classes.astype(np.int32)),
            ],
            names=NAMES,
        ))

    for batch in batches:
        lo = 0
        lengths = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy()
        reached = np.cumsum(lengths)
        while lo < batch.num_rows:
            done = reached[lo - 1] if lo else 0
            hi = min(lo + MOST_TEXTS - rows, int(np.searchsorted(reached, done + CHUNK - size)) + 1, batch.num_rows)
            parts.append(batch.slice(lo, hi - lo))
            size, rows = size + int(reached[hi - 1] - done), rows + hi - lo
            lo = hi
            if size >= CHUNK or rows >= MOST_TEXTS:
                yield from flush()
                parts.clear()
                size, rows, number = 0, 0, number + 1
    if parts:
        yield from flush()


NAMES = ["kind", "chunk", "id", "held_out", "tokens", "classes", "word", "n", "class"]
SCHEMA = "kind string, chunk long, id long, held_out boolean, tokens binary, classes binary, word binary, n long, class int"


def encode(docs: DataFrame, scratch: Scratch, *, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Texts as token numbers within their chunk and as classes; the vocabulary of every chunk with training counts."""

    def run(batches):
        from pyspark import TaskContext

        yield from _chunks(batches, TaskContext.get().partitionId() << 33)
        # The worker lives on, beside tasks that need no Python.
        pa.default_memory_pool().release_unused()

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), (fold(F.col(id_col), 5) == 1).alias("held_out"), F.col(text_col).alias("text"))
    coded = scratch.save(docs.mapInArrow(run, SCHEMA), "coded", partition_by="kind")
    texts = coded.where("kind = 'text'").select("chunk", F.col("id").alias("doc_id"), "held_out", "tokens", "classes")
    return texts, scratch.load("coded", coded.schema).where("kind = 'word'").select("chunk", F.col("id").alias("number"), "word", "n", "class")


class Parameters:
    """Start, transition and emission probabilities; log10 score of a sequence by the scaled forward recursion."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit  # (k,), (k, k), (classes, k)

    def score(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Exact log10 likelihoods, longest sequences first so that ended ones drop off the end."""
        order = np.argsort([-len(s) for s in sequences], kind="stable")
        lengths = np.array([len(sequences[k]) for k in order])
        if not len(lengths):
            return np.zeros(0)
        flat = np.concatenate([sequences[k] for k in order])
        begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        total = np.zeros(len(lengths))
        alpha = np.broadcast_to(self.start, (len(lengths), len(self.start)))
        live = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
        for t in range(lengths[0]):
            n = live[t]
            alpha = (alpha[:n] if t == 0 else alpha[:n] @ self.move) * self.emit[flat[begins[:n] + t]]
            scale = alpha.sum(axis=1)
            alpha = alpha / scale[:, None]
            total[:n] += np.log10(scale)
        out = np.empty(len(lengths))
        out[order] = total
        return out


def _padded(part: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sequences, longest first, as columns, and how many are still going on at each step."""
    lengths = np.array([len(s) for s in part])
    x = np.zeros((lengths[0], len(part)), dtype=np.int64)
    for row, s in enumerate(part):
        x[: len(s), row] = s
    return x, np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")


def _groups(order: list[int], lengths: list[int]):
    """Runs of pieces, longest first, of about ``TOGETHER`` tokens with padding."""
    lo = 0
    while lo < len(order):
        hi = min(len(order), lo + max(1, TOGETHER // lengths[order[lo]]))
        yield order[lo:hi]
        lo = hi


def _borders(texts: list[np.ndarray], p: Parameters) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The texts cut into stretches, with the forward message into each and the backward message out of it.

    A stretch acts on messages as a matrix, the product of its steps.  The matrices of all stretches of longer texts are
    worked out together, and a pass over them per text gives the messages at the borders: so the expected counts are
    those of whole texts, while no text is held by steps.  A text's first stretch has no message into it (zeros).
    """
    k = len(p.start)
    pieces = [s[a : a + STRETCH] for s in texts for a in range(0, len(s), STRETCH)]
    into, out = np.zeros((len(pieces), k)), np.ones((len(pieces), k))
    spans, at = [], 0
    for s in texts:
        n = -(-len(s) // STRETCH)
        if n > 1:
            spans.append((at, at + n))
        at += n
    which = [j for a, b in spans for j in range(a, b)]
    first = {a for a, _ in spans}
    matrices = {}
    lengths = [len(s) for s in pieces]
    for own in _groups(sorted(which, key=lambda j: -lengths[j]), lengths):
        x, live = _padded([pieces[j] for j in own])
        e = p.emit[x]
        now = np.where(np.array([j in first for j in own])[:, None, None], np.eye(k), p.move) * e[0][:, None, :]
        now /= now.sum(axis=(1, 2), keepdims=True)
        for t in range(1, len(x)):
            m = live[t]
            step = (now[:m].reshape(-1, k) @ p.move).reshape(m, k, k) * e[t, :m, None, :]
            now[:m] = step / step.sum(axis=(1, 2), keepdims=True)
        matrices.update(zip(own, now, strict=True))
    for a, b in spans:
        message = p.start
        for j in range(a, b - 1):
            message = message @ matrices[j]
            message = into[j + 1] = message / message.sum()
        message = np.ones(k)
        for j in range(b - 1, a, -1):
            message = matrices[j] @ message
            message = out[j - 1] = message / message.sum()
    return pieces, into, out


def _rooms(states: int) -> np.ndarray:
    """Memory for the messages of one group of pieces."""
    return np.empty((3, max(TOGETHER, STRETCH) * states))


def _expected(texts: list[np.ndarray], p: Parameters, rooms: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, moves and emissions of whole texts, and their log likelihood.  ``rooms``: memory to use again, see ``_rooms``."""
    k = len(p.start)
    rooms = _rooms(k) if rooms is None else rooms
    starts, moves, emits, total = np.zeros(k), np.zeros((k, k)), np.zeros_like(p.emit), 0.0
    ones, back = np.ones(k), np.ascontiguousarray(p.move.T)
    pieces, into, out = _borders(texts, p)
    lengths = [len(s) for s in pieces]
    for own in _groups(sorted(range(len(pieces)), key=lambda j: -lengths[j]), lengths):
        x, live = _padded([pieces[j] for j in own])
        steps, n = x.shape
        ends = np.array([lengths[j] for j in own]) - 1
        before, after = into[own], out[own]
        opens = ~before.any(axis=1)
        alpha, beta, e = (room[: x.size * k].reshape(steps, n, k) for room in rooms)
        p.emit.take(x.ravel(), axis=0, out=e.reshape(-1, k), mode="clip")
        scale = np.ones((steps, n))
        for t in range(steps):
            m = live[t]
            now = alpha[t, :m]
            if t:
                np.matmul(alpha[t - 1, :m], p.move, out=now)
            else:
                now[:] = np.where(opens[:, None], p.start, before @ p.move)
            now *= e[t, :m]
            scale[t, :m] = now @ ones
            now /= scale[t, :m, None]
            # Nothing is left of texts that are over.
            alpha[t, m:] = beta[t, m:] = e[t, m:] = 0
        total += np.log(scale).sum()
        beta[ends, np.arange(n)] = after / (alpha[ends, np.arange(n)] * after).sum(axis=1, keepdims=True)
        # From here on ``e`` holds what the backward message carries over a step: zero where the text is over.
        e /= scale[:, :, None]
        e[steps - 1] *= beta[steps - 1]
        for t in range(steps - 2, -1, -1):
            m = live[t + 1]
            np.matmul(e[t + 1, :m], back, out=beta[t, :m])
            e[t] *= beta[t]
        starts += (alpha[0] * beta[0])[opens].sum(axis=0)
        moves += (before.T @ e[0] + alpha[:-1].reshape(-1, k).T @ e[1:].reshape(-1, k)) * p.move
        alpha *= beta
        for j in range(k):
            emits[:, j] += np.bincount(x.ravel(), weights=alpha[:, :, j].ravel(), minlength=len(emits))
    return starts, moves, emits, float(total)


def _begin(classes: np.ndarray, states: int) -> Parameters:
    """Sticky moves, and emissions near the classes' shares with a fixed pseudo-random tilt."""
    rng = np.random.default_rng(7)
    share = (classes + 0.5) / (classes + 0.5).sum()
    emit = share[:, None] * rng.uniform(0.5, 1.5, (len(classes), states))
    move = np.full((states, states), 0.1 / max(states - 1, 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    return Parameters(np.full(states, 1 / states), move, emit / emit.sum(axis=0))


def _sums(train: DataFrame, p: Parameters) -> dict[int, np.ndarray]:
    """Expected counts of all training texts: per block of classes, and under -1 starts, moves and the log likelihood.

    A partition adds up its own texts and sends one row a block.  Rows are added in two steps, ``FAN`` partitions first,
    so that no task holds a block's rows of all partitions.
    """
    shared = train.sparkSession.sparkContext.broadcast((p.start, p.move, p.emit))

    def local(batches):
        from pyspark import TaskContext

        own = Parameters(*shared.value)
        k = len(own.start)
        edge, emits, rooms = np.zeros(k + k * k + 1), np.zeros_like(own.emit), _rooms(k)
        for batch in batches:
            # Many texts at once: pieces of like length then step together.
            starts, moves, emitted, total = _expected([np.frombuffer(b, "<u2") for b in batch.column(0).to_pylist()], own, rooms)
            edge += np.concatenate([starts, moves.ravel(), [total]])
            emits += emitted
        parts = emits.reshape(-1, BLOCK * k)
        n = len(parts) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([*range(n - 1), -1], pa.int32()), pa.array([TaskContext.get().partitionId() // FAN] * n, pa.int32()), pa.array([*(r.tobytes() for r in parts), edge.tobytes()], pa.binary())], ["block", "fan", "sums"]
        )

    def add(key, table):
        total = np.zeros(0)
        for chunk in table.column("sums").chunks:
            for x in chunk:
                row = np.frombuffer(x.as_py())
                total = total + row if total.size else row
        return pa.table({**{c: pa.array([v.as_py()], pa.int32()) for c, v in zip(("block", "fan"), key)}, "sums": pa.array([total.tobytes()], pa.binary())})

    few = train.mapInArrow(local, "block int, fan int, sums binary").groupBy("block", "fan").applyInArrow(add, "block int, fan int, sums binary")
    out = {r["block"]: np.frombuffer(r["sums"]) for r in few.groupBy("block").applyInArrow(add, "block int, sums binary").collect()}  # CLASSES / BLOCK rows
    shared.unpersist()
    return out


def baum_welch(spark: SparkSession, texts: DataFrame, class_counts: np.ndarray, *, states: int = STATES, rounds: int = ROUNDS, settled: float = SETTLED) -> Parameters:
    """Rounds of expected counts over all training texts; add-half smoothing by the classes' shares keeps all positive.

    Ends after ``rounds``, or when a round raises the log likelihood a token by less than ``settled``.
    """
    p = _begin(class_counts, states)
    prior = (class_counts + 0.5) / (class_counts + 0.5).sum()
    train = texts.where("NOT held_out").select("classes")
    before = -np.inf
    for _ in range(rounds):
        sums = _sums(train, p)
        if not sums:
            break
        edge = sums.pop(-1)
        starts, moves = edge[:states] + 0.5, edge[states:-1].reshape(states, states) + 0.5
        emits = np.concatenate([sums[k].reshape(BLOCK, states) for k in sorted(sums)]) + 50 * prior[:, None]
        p = Parameters(starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0))
        now = edge[-1] / max(class_counts.sum(), 1)
        if now - before < settled:
            break
        before = now
    return p


def score_texts(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: log10 probabilities of whole texts."""
    scratch = Scratch(spark, "hmm")
    texts, words = encode(docs, scratch, id_col=id_col, text_col=text_col)
    from pyspark.sql import Window

    # One shuffle by token gives every chunk's token its count over all chunks; ``first`` marks one row a token.
    same = Window.partitionBy("word")
    counted = words.select("chunk", F.col("number").cast("int").alias("number"), "class", "n", F.sum("n").over(same).alias("c"), (F.row_number().over(same.orderBy("chunk")) == 1).alias("first"))
    counted = scratch.save(counted, "counted")
    per_class = counted.groupBy("class").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("first") & (F.col("c") > 0), 1).otherwise(0)).alias("v")).collect()  # at most CLASSES rows
    table = np.zeros((2, CLASSES), dtype=np.int64)
    for r in per_class:
        table[:, r["class"]] = r["n"], r["v"]
    total, distinct = int(table[0].sum()), int(table[1].sum())
    model = baum_welch(spark, texts, table[0].astype(float), states=states, rounds=rounds)
    shared = spark.sparkContext.broadcast((model.start, model.move, model.emit, table[0] + 0.5 * (table[1] + 1)))
    known = counted.select("chunk", "number", "class", "c")

    def score(texts, words):
        start, move, emit, size = shared.value
        own = Parameters(start, move, emit)
        c, cls = np.zeros((2, words.num_rows), dtype=np.int64)
        number = words.column("number").to_numpy()
        c[number], cls[number] = words.column("c").to_numpy(), words.column("class").to_numpy()
        base = np.log10((c + 0.5) / (total + 0.5 * (distinct + 1)))
        within = np.log10((c + 0.5) / size[cls])
        tokens = [np.frombuffer(b, "<i4") for b in texts.column("tokens").to_pylist()]
        latent = own.score([cls[t] for t in tokens])
        n = len(tokens)
        return pa.table(
            {
                "doc_id": texts.column("doc_id"), "held_out": texts.column("held_out"), "n_tokens": pa.array([len(t) for t in tokens], pa.int64()),
                "n_known": pa.array([int((c[t] > 0).sum()) for t in tokens], pa.int64()), "train_tokens": pa.array([total] * n, pa.int64()),
                "base_score": pa.array([float(base[t].sum()) for t in tokens], pa.float64()), "score": pa.array(np.array([float(within[t].sum()) for t in tokens]) + latent, pa.float64()),
            }
        )

    return texts.drop("classes").groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
