"""Words of many texts at once, with numpy.

A batch of texts is taken in chunks of bounded size.  Of each chunk the words
are found, hashed and numbered in whole arrays, so that Python does no work
per word.  A hash is 64 bits made of the bytes of a word alone; two of them,
with different seeds, stand for the word wherever equality matters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
ODD = 0x9E3779B97F4A7C15
ALL_BITS = (1 << 64) - 1


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (a finaliser; every input has one output)."""
    x = values.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def is_blank() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[9, 10, 11, 12, 13, 32]] = True
    return table


def lower_case() -> np.ndarray:
    """A-Z to a-z, every other byte to itself."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


BLANK = is_blank()
LOWER = lower_case()


class Hasher:
    """Hashes spans of a byte buffer; equal bytes give equal hashes wherever they lie."""

    def __init__(self, seed: int, lower: bool = False):
        values = mix(np.arange(256, dtype=np.uint64) + np.uint64(1 + 1000 * seed))
        self.values = values[LOWER] if lower else values
        self.base = int(mix(np.array([seed + 77], np.uint64))[0]) | 5
        self.inverse = pow(self.base, -1, 1 << 64)
        self.powers = np.ones(1, np.uint64)
        self.inverses = np.ones(1, np.uint64)

    def tables(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Powers of the base and of its inverse, n at least."""
        while len(self.powers) < n:
            size = len(self.powers)
            step = np.uint64(pow(self.base, size, 1 << 64))
            back = np.uint64(pow(self.inverse, size, 1 << 64))
            self.powers = np.concatenate([self.powers, self.powers * step])
            self.inverses = np.concatenate([self.inverses, self.inverses * back])
        return self.powers, self.inverses

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of ascending spans, taken in segments so that long texts need little memory."""
        out = np.empty(len(starts), np.uint64)
        at = 0
        while at < len(starts):
            low = starts[at]
            to = max(int(np.searchsorted(ends, low + CHUNK_BYTES, "right")), at + 1)
            out[at:to] = self._segment(data[low : ends[at:to].max()], starts[at:to] - low, ends[at:to] - low)
            at = to
        return out

    def _segment(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(data)
        self.tables(n + 1)
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        np.cumsum(self.values[data] * self.powers[:n], out=sums[1:])
        length = (ends - starts).astype(np.uint64) * np.uint64(ODD)
        return mix((sums[ends] - sums[starts]) * self.inverses[starts] + length)


def runs_hash(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of n consecutive word hashes; windows do not mind documents."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for i in range(n):
        out *= np.uint64(ODD)
        out += hashes[i : i + count]
    return mix(out)


@dataclass
class Chunk:
    """Some consecutive texts of a batch and their words."""

    row: int  # index of the first text in its batch
    data: np.ndarray  # their bytes
    offsets: np.ndarray  # where each text begins in data, and the end of the last
    starts: np.ndarray  # of words, in data
    ends: np.ndarray
    first: np.ndarray  # index of the first word of each text, and the number of words

    @property
    def texts(self) -> int:
        return len(self.offsets) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.texts), self.counts)

    def bytes_of(self, start: int, end: int) -> bytes:
        return self.data[start:end].tobytes()


def find_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the index of each text's first one."""
    n = len(data)
    solid = np.zeros(n + 2, bool)
    np.logical_not(BLANK[data], out=solid[1 : n + 1])
    begins = solid[1:] & ~solid[:-1]  # at n nothing begins
    stops = solid[:-1] & ~solid[1:]
    # Words end where a text ends, also if the next begins without a blank.
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    joined = edges[solid[edges] & solid[edges + 1]]
    begins[joined] = True
    stops[joined] = True
    starts = np.flatnonzero(begins[:n])
    return starts, np.flatnonzero(stops), np.searchsorted(starts, offsets)


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """A batch in chunks of some bytes; a longer text is a chunk of its own.  Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    wide = pa.types.is_large_string(texts.type)
    buffers = texts.buffers()
    ends = np.frombuffer(buffers[1], np.int64 if wide else np.int32, n + 1 + texts.offset)[texts.offset :].astype(np.int64)
    body = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.empty(0, np.uint8)
    row = 0
    while row < n:
        to = int(np.searchsorted(ends, ends[row] + limit, "right")) - 1
        to = min(n, max(to, row + 1))
        data = body[ends[row] : ends[to]]
        offsets = ends[row : to + 1] - ends[row]
        yield Chunk(row, data, offsets, *find_words(data, offsets))
        row = to


def per_text(chunk: Chunk, values: np.ndarray) -> np.ndarray:
    """Sums of per-word values for each text."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[chunk.first[1:]] - sums[chunk.first[:-1]]


def per_text_bytes(chunk: Chunk, flags: np.ndarray) -> np.ndarray:
    """Numbers of flagged bytes for each text."""
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[chunk.offsets[1:]] - sums[chunk.offsets[:-1]]


def take_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans of a byte buffer as an array of strings."""
    sizes = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    index = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[index])]
    return pa.Array.from_buffers(pa.string(), len(starts), buffers)
