"""Token ids of whole texts by a tokenizer file, with each distinct stretch of text encoded once a worker.

A byte-level tokenizer first parts a text into letters, digits, other signs and white space, and encodes every part for
itself.  Where two parts meet can be seen from the two or three bytes around the place, so numpy finds such places in a
whole block of texts, Arrow's dictionary encoding finds the distinct stretches between them, the tokenizer encodes
those that are new to the worker process, whichever of its tasks met them, and one gather writes the ids.  Places that might depend on more than these bytes are no places to
cut: next to an apostrophe (contractions), next to bytes of characters that are not known to be letters, and, in texts
with unusual white space or control characters or with ``<|`` (special tokens), everywhere but at a single space
between two visible ASCII characters.
"""

from __future__ import annotations

import functools
from array import array
from itertools import accumulate, chain, count

import numpy as np
import pyarrow as pa

#: Bytes of text that are encoded together, and encoded stretches that a worker remembers at most.
BLOCK = 4 << 20
REMEMBERED = 500_000

# Classes of bytes.
OTHER, LETTER, DIGIT, SIGN, QUOTE, BLANK, WHITE, ODD = range(8)


def _byte_classes() -> np.ndarray:
    table = np.full(256, OTHER, dtype=np.uint8)
    for k in range(0x21, 0x7F):
        table[k] = LETTER if chr(k).isalpha() else DIGIT if chr(k).isdigit() else SIGN
    table[ord("'")] = QUOTE
    table[0x20] = BLANK
    table[0x09:0x0E] = WHITE
    table[0x1C:0x20] = ODD
    return table


CLASSES = _byte_classes()
#: UTF-8 lead bytes of two-byte letters (Latin with marks, Cyrillic), and the two signs among them.
LETTER_LEADS = (0xC3, 0xC4, 0xC5, 0xD0, 0xD1)
NO_LETTERS = ((0xC3, 0x97), (0xC3, 0xB7))
#: UTF-8 of white space beyond ASCII, and of two characters that some engines count as such.
UNUSUAL = tuple(chr(c).encode() for c in (0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))


def _unusual(data: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Places of control characters, special tokens and white space beyond ASCII."""
    found = [np.nonzero(kinds == ODD)[0]]
    at = np.nonzero(data[:-1] == ord("<"))[0]
    found.append(at[data[at + 1] == ord("|")])
    for lead in sorted({u[0] for u in UNUSUAL}):
        at = np.nonzero(data == lead)[0]
        if len(at):
            for u in (u for u in UNUSUAL if u[0] == lead):
                own = at[at + len(u) <= len(data)]
                for k, byte in enumerate(u[1:], 1):
                    own = own[data[own + k] == byte]
                found.append(own)
    return np.concatenate(found)


def cuts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Mask of the bytes before which the texts that begin at ``begins`` may be cut; text starts are among them."""
    kinds = CLASSES[data]
    unusual = _unusual(data, kinds)
    at = np.nonzero((data >= LETTER_LEADS[0]) & (data <= LETTER_LEADS[-1]))[0]
    at = at[np.isin(data[at], LETTER_LEADS) & (at + 1 < len(data))]
    for lead, next_ in NO_LETTERS:
        at = at[(data[at] != lead) | (data[at + 1] != next_)]
    kinds[at] = kinds[at + 1] = LETTER
    white = kinds >= BLANK
    white[kinds == ODD] = False
    mask = np.zeros(len(data), dtype=bool)
    if len(data) > 1:
        before, now = kinds[:-1], kinds[1:]
        visible = (before >= LETTER) & (before <= SIGN) & (now >= LETTER) & (now <= QUOTE)
        mask[1:] = visible & (before != now) & ~((before == SIGN) & (now == QUOTE))
        mask[1:] |= white[1:] & ~white[:-1]
        # The last white byte of a run goes with the word if it is a blank, and stands alone otherwise.
        last = np.zeros(len(data), dtype=bool)
        last[:-1] = white[:-1] & ~white[1:]
        last[begins[begins > 0] - 1] = False
        last[-1] = False
        mask |= last
        mask[1:] |= last[:-1] & (kinds[:-1] == WHITE)
    mask[begins[begins < len(data)]] = True
    if len(unusual):
        owner = np.unique(np.searchsorted(begins, unusual, side="right") - 1)
        plain = (data > 0x20) & (data < 0x7F)
        single = np.zeros(len(data), dtype=bool)
        single[1:-1] = plain[:-2] & (data[1:-1] == 0x20) & plain[2:]
        ends = np.append(begins[1:], len(data))
        for k in owner:
            mask[begins[k] + 1 : ends[k]] &= single[begins[k] + 1 : ends[k]]
    return mask


def block_end(data: np.ndarray, begin: int, size: int) -> int:
    """A place at or after ``begin + size`` where any text may be cut, or the end of ``data``."""
    at = begin + size
    while at < len(data) - 1:
        part = data[at - 1 : at + (1 << 16)]
        plain = (part > 0x20) & (part < 0x7F)
        found = np.nonzero(plain[:-2] & (part[1:-1] == 0x20) & plain[2:])[0] if len(part) > 2 else ()
        if len(found):
            return at + int(found[0])
        at += (1 << 16) - 1
    return len(data)


class Encoder:
    """Ids of texts by a tokenizer file; remembers the stretches that it has encoded."""

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer, self.end_id = Tokenizer.from_file(path), end_id
        self._forget()

    def _forget(self) -> None:
        # The empty stretch stands for the end of a text.
        self.place, self.begin, self.count, self.flat = {b"": 0}, array("q", [0]), array("q", [1]), array("I", [self.end_id])

    def _places(self, stretches: list[bytes]) -> np.ndarray:
        if len(self.place) > REMEMBERED:
            self._forget()
        places = np.fromiter((-1 if p is None else p for p in map(self.place.get, stretches)), dtype=np.int64, count=len(stretches))
        missing = np.nonzero(places < 0)[0]
        if len(missing):
            new = [stretches[k] for k in missing]
            found = [e.ids for e in self.tokenizer.encode_batch([s.decode() for s in new], add_special_tokens=False)]
            counts, flat, first = array("q", map(len, found)), array("I", chain.from_iterable(found)), len(self.begin)
            self.begin.extend(accumulate(counts[:-1], initial=len(self.flat)))
            self.count.extend(counts)
            self.flat.extend(flat)
            self.place.update(zip(new, count(first)))
            places[missing] = np.arange(first, first + len(new))
        return places

    def _block(self, data: np.ndarray, edges: np.ndarray, ended: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts between ``edges`` of ``data``, and where each text's ids end; each has its end id if ``ended``."""
        begins, ends = edges[:-1], edges[1:]
        at = np.nonzero(cuts(data, begins))[0]
        if ended:
            places = np.searchsorted(at, ends) + np.arange(len(ends))
            at = np.insert(at, np.searchsorted(at, ends), ends)
        else:
            places = np.array([len(at) - 1])
        offsets = np.append(at, len(data)).astype(np.int32)
        stretches = pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
        coded = stretches.dictionary_encode()
        own = self._places(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        begin, count, flat = (np.frombuffer(x, dtype=k) for x, k in ((self.begin, np.int64), (self.count, np.int64), (self.flat, np.uint32)))
        many = count[own]
        reached = np.cumsum(many)
        total = int(reached[-1]) if len(reached) else 0
        ids = flat[np.arange(total) + np.repeat(begin[own] - (reached - many), many)]
        return ids, reached[places] if len(places) and len(reached) else np.zeros(len(places), dtype=np.int64)

    def _long(self, data: np.ndarray) -> np.ndarray:
        """Ids and end of one text that is larger than a block."""
        parts, begin = [], 0
        while begin < len(data):
            end = block_end(data, begin, BLOCK)
            part = data[begin:end]
            parts.append(self._block(part, np.array([0, len(part)]), False)[0])
            begin = end
        return np.concatenate([*parts, np.array([self.end_id], dtype=np.uint32)])

    def texts(self, column: pa.Array):
        """The ids of every text of a string column, the end id after each; null is empty."""
        column = column.cast(pa.large_string()).fill_null("")
        _, offsets, buffer = column.buffers()
        at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None and buffer.size else np.zeros(0, dtype=np.uint8)
        lo = 0
        while lo < len(column):
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + BLOCK, side="right")) - 1)
            hi = min(hi, len(column))
            if at[hi] - at[lo] > BLOCK:
                yield self._long(data[at[lo] : at[hi]])
            else:
                ids, ends = self._block(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], True)
                yield from np.split(ids, ends[:-1])
            lo = hi


@functools.lru_cache(maxsize=1)
def encoder(path: str, end_id: int) -> Encoder:
    """The encoder of this worker process: a task goes on with what the tasks before it have encoded."""
    return Encoder(path, end_id)
