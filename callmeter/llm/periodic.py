"""Periodic runs of words, by recursive frequency splitting.

Every word of a run of at least r periods occurs r times in it, so a word that
occurs less often in a segment lies in no run of that segment and splits it.
The pieces are counted anew, until none has a rare word; what survives is
scanned lag by lag.

A stretch in which each word equals the one q later, and which is at least
(r - 1) q words long, covers r - 1 multiples of q in a row.  So a lag is tried
at the multiples of q first, which costs a q-th of the segment, and only where
these agree are the ends of the stretch looked for.  All lags together cost
n log n and not n * n, and no lag is left out.

Documents are independent, so this is one pass without a shuffle; inside a
task, chunks of about a megabyte of texts are split and scanned together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmeter.llm.words import CHUNK_BYTES, Chunk, Hasher, chunks


@dataclass(frozen=True)
class RunRule:
    """A run has min_words words at least, and min_repeats times its period."""

    min_words: int = 6
    min_repeats: int = 4

    def __post_init__(self):
        if self.min_repeats < 2 or self.min_words < 2:
            raise ValueError("a run needs two words and two periods at least")

    def shortest(self, period: int) -> int:
        return max(self.min_words, self.min_repeats * period)


HASHERS = (Hasher(131), Hasher(132))


def word_numbers(chunk: Chunk) -> np.ndarray:
    """A number for each word, equal for equal words: that of its hash, checked by a second one."""
    first, second = (hasher.spans(chunk.data, chunk.starts, chunk.ends) for hasher in HASHERS)
    _, where, numbers = np.unique(first, return_index=True, return_inverse=True)
    if len(first) and (second != second[where][numbers]).any():
        pairs = np.stack([first, second], axis=1)
        numbers = np.unique(pairs, axis=0, return_inverse=True)[1].reshape(-1)
    return numbers


def split_segments(numbers: np.ndarray, segment: np.ndarray, rule: RunRule) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words that survive the splitting, and their segments.

    ``segment`` rises along the words.  Only segments that a round has cut are
    counted again in the next.
    """
    at = np.arange(len(numbers))
    kept_at, kept_segment = [], []
    next_segment = 0
    while len(at):
        edge = np.empty(len(at), bool)
        edge[0] = True
        np.not_equal(segment[1:], segment[:-1], out=edge[1:])
        edge[1:] |= at[1:] != at[:-1] + 1
        begins = np.flatnonzero(edge)
        sizes = np.diff(np.append(begins, len(at)))
        long_enough = np.repeat(sizes >= rule.min_words, sizes)
        segment = np.repeat(np.arange(len(begins)), sizes)[long_enough]
        at = at[long_enough]
        if not len(at):
            break
        key = segment * (int(numbers.max()) + 1) + numbers[at]
        _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
        rare = counts[inverse] < rule.min_repeats
        cut = np.zeros(int(segment[-1]) + 1, bool)
        cut[segment[rare]] = True
        stable = ~cut[segment]
        kept_at.append(at[stable])
        kept_segment.append(segment[stable] + next_segment)
        next_segment += len(cut)
        again = ~stable & ~rare
        at, segment = at[again], segment[again]
    if not kept_at:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at, segment = np.concatenate(kept_at), np.concatenate(kept_segment)
    order = np.argsort(at, kind="stable")
    return at[order], segment[order]


def _agreeing(codes: np.ndarray, start: int, lag: int, step: int) -> int:
    """How many words in a row, going by step from start, equal the one a lag later."""
    n, size = 0, 64
    while True:
        low = start + n if step > 0 else max(start - n - size + 1, 0)
        high = min(start + n + size, len(codes) - lag) if step > 0 else start - n + 1
        if high <= low:
            return n
        same = codes[low:high] == codes[low + lag : high + lag]
        if step < 0:
            same = same[::-1]
        if not same.all():
            return n + int(np.argmin(same))
        n += len(same)
        size *= 2


def scan_lags(codes: np.ndarray, lengths: np.ndarray, rule: RunRule) -> list[tuple[int, int, int]]:
    """Start, length and smallest period of all runs.

    ``codes`` are the segments one after the other, longest first, and differ
    between segments, so no stretch leaves its segment.
    """
    ends = np.concatenate([[0], np.cumsum(lengths)])
    runs: list[tuple[int, int, int]] = []
    intervals: set[tuple[int, int]] = set()
    label = np.full(len(codes), -1, np.int64)  # the last run found that covers a word
    lag = 0
    while True:
        lag += 1
        shortest = rule.shortest(lag)
        n = int(ends[np.searchsorted(-lengths, -shortest, "right")])
        if n == 0:
            return runs
        marks = codes[:n:lag]
        same = marks[1:] == marks[:-1]
        in_row = (shortest - lag) // lag
        if len(same) < in_row:
            continue
        hits = same[: len(same) - in_row + 1].copy()
        for i in range(1, in_row):
            hits &= same[i : len(same) - in_row + 1 + i]
        at = np.flatnonzero(hits) * lag
        if not len(at):
            continue
        # Between the first and the last of these marks all words agree: look at some.
        for between in sorted({part * (in_row - 1) * lag // 8 for part in range(1, 8)} - {0}):
            at = at[codes[at + between] == codes[at + between + lag]]
        if len(at) and runs:
            # Inside a run whose period divides the lag, the stretch is that run.
            start, length, period = np.array(runs).T
            run = label[at]
            inside = (run >= 0) & (lag % period[run] == 0)
            inside &= (start[run] <= at) & (start[run] + length[run] > at + in_row * lag)
            at = at[~inside]
        done = -1
        for place in at.tolist():
            if place < done:
                continue
            after = _agreeing(codes[:n], place, lag, 1)
            before = _agreeing(codes[:n], place, lag, -1) - 1 if after else 0
            done = place + max(after, 1)
            run_start, run_length = place - before, before + after + lag
            # A stretch seen before, at a lag that divides this one, has the smaller period.
            if run_length >= shortest and (run_start, run_length) not in intervals:
                intervals.add((run_start, run_length))
                label[run_start : run_start + run_length] = len(runs)
                runs.append((run_start, run_length, lag))


def find_runs(chunk: Chunk, rule: RunRule) -> tuple[np.ndarray, np.ndarray]:
    """Runs of the texts of a chunk as rows (text, start, length, period), in this order, and dropped words."""
    numbers = word_numbers(chunk)
    text = chunk.doc_of_word()
    at, segment = split_segments(numbers, text, rule)
    dropped = np.zeros(len(numbers), bool)
    if not len(at):
        return np.empty((0, 4), np.int64), dropped
    begins = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
    lengths = np.diff(np.append(begins, len(at)))
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    moved = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    take = np.arange(len(at)) + np.repeat(begins[order] - moved, lengths)
    at = at[take]
    key = np.repeat(np.arange(len(order)), lengths) * (int(numbers.max()) + 1) + numbers[at]
    codes = np.unique(key, return_inverse=True)[1]
    rows = []
    for start, length, period in scan_lags(codes, lengths, rule):
        first = int(at[start])
        dropped[first + period : first + length] = True
        rows.append((text[first], first - chunk.first[text[first]], length, period))
    found = np.array(rows, np.int64).reshape(-1, 4)
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))], dropped


def joined_words(chunk: Chunk, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    starts, ends = chunk.starts[kept], chunk.ends[kept]
    counts = np.concatenate([[0], np.cumsum(kept)])[chunk.first]
    sizes = ends - starts + 1
    places = np.concatenate([[0], np.cumsum(sizes)])
    body = np.full(int(places[-1]), 32, np.uint8)
    low = 0
    while low < len(starts):
        high = max(int(np.searchsorted(places, places[low] + CHUNK_BYTES, "right")) - 1, low + 1)
        width = ends[low:high] - starts[low:high]
        moved = np.concatenate([[0], np.cumsum(width)[:-1]])
        step = np.arange(int(width.sum())) - np.repeat(moved, width)
        body[step + np.repeat(places[low:high], width)] = chunk.data[step + np.repeat(starts[low:high], width)]
        low = high
    # The space after the last word of a text is left out.
    filled = np.diff(counts) > 0
    last = places[counts[1:][filled]] - 1
    body = np.delete(body, last)
    offsets = places[counts] - np.concatenate([[0], np.cumsum(filled)])
    return pa.Array.from_buffers(
        pa.large_string(), len(counts) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(body)]
    )


RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _of_chunk(chunk: Chunk, rule: RunRule) -> tuple[pa.Array, pa.Array, pa.Array]:
    runs, dropped = find_runs(chunk, rule)
    offsets = np.searchsorted(runs[:, 0], np.arange(chunk.texts + 1)).astype(np.int32)
    values = pa.StructArray.from_arrays([pa.array(runs[:, i]) for i in (1, 2, 3)], fields=list(RUN_TYPE))
    lists = pa.ListArray.from_arrays(pa.array(offsets), values)
    return pa.array(chunk.counts, pa.int64()), lists, joined_words(chunk, ~dropped).cast(pa.string())


def periodic_runs(docs: DataFrame, rule: RunRule = RunRule()) -> DataFrame:
    """doc_id, n_words, runs and collapsed text of every document.

    ``runs`` holds start, length and smallest period of every maximal run in
    words, by start and then period; ``collapsed`` the words that no run
    contains after its first period, joined by one space.  A null or blank text
    has no words, no runs and an empty collapsed text.  Every row counts on its
    own, whatever its doc_id, null included; columns beyond doc_id and text are
    not read.  An empty table gives no rows.
    """

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                ids = batch.column(0).slice(chunk.row, chunk.texts)
                columns = [ids, *_of_chunk(chunk, rule)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    run = "struct<start:bigint,length:bigint,period:bigint>"
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text")).mapInArrow(
        of_batches, f"doc_id bigint, n_words bigint, runs array<{run}>, collapsed string"
    )
