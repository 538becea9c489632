r"""Chat formatting by columnar byte assembly.

A turn becomes mark, role name (for roles without marks of their own), mark, text, mark.  Per Arrow
batch the lengths of all these segments give cumulative offsets; every segment's bytes are scattered
by index into one preallocated buffer, which becomes the Arrow string column without another copy.

A conversation is one row (part 0); one that exceeds ``PART_BYTES`` continues in further parts, so no
conversation has to fit into memory.  ``loss`` holds byte spans of the assistant texts in the part.
Control strings inside texts and role names get a backslash after their first character, one more
if they have some already; reading takes one away, so any text is restored exactly.

Defined cases: a null text or role is empty; null conversation ids form one conversation; null turns
come first; rows of one turn are ordered by role, then text; repeated rows stay; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Marks before the role name, between it and the text, and after the text.
MARKS = {
    "system": ("[SYS]", "", "[/SYS]"),
    "user": ("[INST]", "", "[/INST]"),
    "assistant": ("<s>", "", "</s>"),
    None: ("[ROLE]", "[/ROLE]", "</s>"),
}
CONTROL = r"(/?(?:SYS|INST|ROLE|s)[\]>])"
ESCAPE = r"([\[<])(\\*)" + CONTROL
UNESCAPE = re.compile(r"([\[<])\\(\\*)" + CONTROL)
TURN = re.compile(r"\[SYS\](?P<system>.*?)\[/SYS\]|\[INST\](?P<user>.*?)\[/INST\]|<s>(?P<assistant>.*?)</s>|\[ROLE\](?P<name>.*?)\[/ROLE\](?P<text>.*?)</s>", re.DOTALL)
#: A conversation goes on in another part beyond the first; so many bytes of turns are assembled at once (or one turn).
PART_BYTES, SLICE_BYTES = 4 << 20, 8 << 20
FORMATTED = "conv_id long, part int, formatted string, loss array<struct<start:int,length:int>>"


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Data bytes and offsets of a string column without nulls."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)), at


def _scatter(out: np.ndarray, to: np.ndarray, source: np.ndarray, begin: np.ndarray, length: np.ndarray) -> None:
    """Copy source[begin:begin+length] to out[to:] for all segments at once."""
    total = int(length.sum())
    within = np.arange(total) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(to, length) + within] = source[np.repeat(begin, length) + within]


def assemble(role: pa.Array, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all turns, their offsets, and where each text begins and how long it is."""
    kinds = list(MARKS)
    n = len(text)
    kind = np.full(n, len(kinds) - 1)
    for k, name in enumerate(kinds[:-1]):
        kind[np.asarray(pc.equal(role, name).to_numpy(zero_copy_only=False), dtype=bool)] = k
    marks = np.frombuffer("".join(m for k in kinds for m in MARKS[k]).encode(), dtype=np.uint8)
    mark_length = np.array([[len(m) for m in MARKS[k]] for k in kinds])
    mark_begin = (np.cumsum(mark_length) - mark_length.ravel()).reshape(mark_length.shape)
    role_data, role_at = _bytes_of(role)
    text_data, text_at = _bytes_of(text)
    lengths = np.empty((n, 5), dtype=np.int64)
    lengths[:, [0, 2, 4]] = mark_length[kind]
    lengths[:, 1] = np.where(kind == len(kinds) - 1, np.diff(role_at), 0)
    lengths[:, 3] = np.diff(text_at)
    ends = np.cumsum(lengths)
    begins = (ends - lengths.ravel()).reshape(n, 5)
    out = np.empty(int(ends[-1]) if n else 0, dtype=np.uint8)
    for column, which in ((0, 0), (2, 1), (4, 2)):
        _scatter(out, begins[:, column], marks, mark_begin[kind, which], lengths[:, column])
    _scatter(out, begins[:, 1], role_data, role_at[:-1], lengths[:, 1])
    _scatter(out, begins[:, 3], text_data, text_at[:-1], lengths[:, 3])
    offsets = np.concatenate([begins[:, 0], [len(out)]])
    return out, offsets, begins[:, 3], np.where(kind == kinds.index("assistant"), lengths[:, 3], -1)


def _parts(held: pa.Table, part: int) -> tuple[pa.RecordBatch, pa.Scalar, int]:
    """Rows of whole turns, sorted, as formatted parts; the first conversation starts at ``part``."""
    held = held.combine_chunks()
    conv = held.column("conv_id").combine_chunks()
    out, at, text_begin, loss = assemble(held.column("role").combine_chunks(), held.column("text").combine_chunks())
    known, value = np.asarray(conv.is_valid()), conv.fill_null(0).to_numpy(zero_copy_only=False)
    first = np.ones(len(conv), dtype=bool)
    first[1:] = (value[1:] != value[:-1]) | (known[1:] != known[:-1])
    number = np.cumsum(first) - 1
    within = at[:-1] - at[np.nonzero(first)[0]][number]
    piece = within // PART_BYTES + np.where(number == 0, part, 0)
    cut = first.copy()
    cut[1:] |= piece[1:] != piece[:-1]
    rows = np.nonzero(cut)[0]
    # Parts of one conversation count on without holes.
    order = np.arange(len(rows)) - np.maximum.accumulate(np.where(first[rows], np.arange(len(rows)), 0)) + np.where(number[rows] == 0, part, 0)
    edges = np.append(at[rows], at[-1]).astype(np.int32)
    formatted = pa.StringArray.from_buffers(len(rows), pa.py_buffer(edges), pa.py_buffer(out))
    masked = np.nonzero(loss >= 0)[0]
    owner = np.searchsorted(rows, masked, side="right") - 1
    spans = pa.StructArray.from_arrays([pa.array((text_begin[masked] - edges[owner]).astype(np.int32)), pa.array(loss[masked].astype(np.int32))], ["start", "length"])
    counts = np.append(0, np.cumsum(np.bincount(owner, minlength=len(rows)))).astype(np.int32)
    batch = pa.RecordBatch.from_arrays([conv.take(pa.array(rows)), pa.array(order.astype(np.int32)), formatted, pa.ListArray.from_arrays(pa.array(counts), spans)], ["conv_id", "part", "formatted", "loss"])
    return batch, conv[-1], int(order[-1]) + 1


def _sizes(table: pa.Table) -> np.ndarray:
    """Bytes of every row's role and text."""
    lengths = [pc.binary_length(table.column(c)).to_numpy() for c in ("role", "text")]
    return lengths[0].astype(np.int64) + lengths[1]


def _format(batches):
    held, last, part = None, None, 0
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        conv = held.column("conv_id").combine_chunks()
        # The last conversation may go on in the next batch: it waits unless it is large.
        other = pc.or_kleene(pc.not_equal(conv, conv[-1]), pc.xor(conv.is_null(), pa.scalar(not conv[-1].is_valid))).fill_null(False)
        ready = int(pc.sum(other).as_py() or 0)
        if held.slice(ready).nbytes > PART_BYTES:
            ready = held.num_rows
        while ready:
            sizes = np.cumsum(_sizes(held.slice(0, ready)))
            n = max(1, int(np.searchsorted(sizes, SLICE_BYTES, side="right")))
            same = last is not None and conv[0].equals(last)
            out, last, part = _parts(held.slice(0, n), part if same else 0)
            yield out
            held, ready = held.slice(n), ready - n
            conv = held.column("conv_id").combine_chunks()
        if held is not None and not held.num_rows:
            held = None
    if held is not None:
        yield _parts(held, part if last is not None and held.column("conv_id")[0].equals(last) else 0)[0]


def format_conversations(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, part, formatted, loss) from a row per turn."""
    clean = lambda c: F.regexp_replace(c, ESCAPE, r"$1\\$2$3")
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("raw_role"), F.coalesce(F.col(text_col), F.lit("")).alias("raw_text"))
    # Ties are ordered by the texts themselves, not by their escaped form.
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "raw_role", "raw_text")
    return ordered.select("conv_id", clean("raw_role").alias("role"), clean("raw_text").alias("text")).mapInArrow(_format, FORMATTED)


def unescape(text: str) -> str:
    return UNESCAPE.sub(r"\1\2\3", text)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted part, restored."""
    found, at = [], 0
    for m in TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"no turn at {at}")
        at = m.end()
        kind = m.lastgroup
        found.append((unescape(m["name"]), unescape(m["text"])) if kind == "text" else (kind, unescape(m[kind])))
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")
    return found


def digest_conversations(formatted: DataFrame, *, dealt: bool = False) -> DataFrame:
    """A row per conversation read back from its parts, in constant memory per conversation.

    ``dealt``: the rows come as ``format_conversations`` leaves them, parts of a conversation together and in order, and
    need not be shuffled again.
    """

    def run(batches):
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        now, rows = None, []

        def end():
            if now is not None:
                rows.append((now["id"], now["turns"], now["all"].hexdigest(), now["loss_chars"], now["loss"].hexdigest(), now["chars"]))

        def out():
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for conv, text, loss in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
                if now is None or now["id"] != conv:
                    end()
                    now = {"id": conv, "turns": 0, "chars": 0, "loss_chars": 0, "all": hashlib.sha256(), "loss": hashlib.sha256()}
                raw = text.encode("utf-8", "surrogatepass")
                for role, said in read_turns(text):
                    now["turns"] += 1
                    now["all"].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for span in loss:
                    own = unescape(raw[span["start"] : span["start"] + span["length"]].decode("utf-8", "surrogatepass"))
                    now["loss_chars"] += len(own)
                    now["loss"].update(own.encode("utf-8", "surrogatepass"))
                now["chars"] += len(text)
            yield out()
            rows.clear()
        end()
        yield out()

    ordered = formatted if dealt else formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
