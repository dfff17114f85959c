"""Removal of passages that occur in an earlier document, by super-k-mers.

A window is 13 consecutive words.  Its minimiser is the least hash among the
runs of 3 words inside it; windows that follow one another and share their
minimiser travel together, as one string, to the bucket of the minimiser.  All
places of one word sequence therefore meet in one bucket, where windows are
sorted and the smallest doc_id of each is found exactly.

A run that would be the minimiser of very many strings, as one of common words
may be, would fill its bucket.  So minimisers are counted first, and the most
frequent ones come last in the order by which the least is chosen: windows over
them go to the bucket of another of their eleven runs.  Any order finds all
windows, as long as it is the same for all texts.

Strings of one bucket that come from one chunk of texts are packed and
compressed, so words are shuffled about twice and not 13 times.  A string that
occurs many times in a chunk is sent once, with the range of its doc_ids; its
places are not gathered in the bucket but meet the answer in a join, whose
large partitions Spark splits.  So a passage that a third of all documents
share brings the bucket one string per chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmeter.llm import words as w
from callmeter.llm.common import bound_batches, in_files, numbered, placed, shuffle_partitions, text_of
from callmeter.sources.stored import stored

WINDOW = 13
GRAM = 3

# Places of one string in one chunk above which they travel apart from it.
OFTEN = 16

# Strings from which a minimiser counts as frequent, how many such runs are told
# apart at most, the most frequent ones, and strings of a task that are counted.
FREQUENT_LEAST = 2000
FREQUENT_RUNS = 1 << 16
COUNTED_LEAST = 4
COUNTED_AT_ONCE = 1 << 21

# Strings and texts overlap and repeat little, but cost more to move than to compress.
LEVEL = 6

# Text of one bucket, and of one chunk of documents.
BUCKET_BYTES = 8 << 20
CHUNK_BYTES = 2 << 20

NO_ID = -(1 << 63)

# kind 0: a text without its words; 1: a packed block; 2: places of a frequent string
SENT = "kind int, bucket bigint, row bigint, file_key bigint, file_row bigint, doc_id bigint, n_words bigint, sha string, at bigint, key1 bigint, key2 bigint, block binary"
# kind 0 and 2 as above; 3: windows to remove of a text; 4: windows of a frequent string with their least doc_id
FOUND = (
    "kind int, row bigint, file_key bigint, file_row bigint, doc_id bigint, n_words bigint, sha string, at bigint, key1 bigint, key2 bigint, "
    "length bigint, least array<bigint>"
)


def _arrow_schema(columns: str) -> pa.Schema:
    kinds = {
        "int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(),
        "array<bigint>": pa.list_(pa.int64()),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (column.split() for column in columns.split(", "))])


SENT_ROWS, FOUND_ROWS = _arrow_schema(SENT), _arrow_schema(FOUND)


def least_of(values: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every n consecutive values, by doubling."""
    out, size = values, 1
    while 2 * size <= n:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = n - size
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def run_order(hashes: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Hashes of all runs of 3 words as they are ordered: those in a sorted list come last."""
    runs = w.runs_hash(hashes, GRAM) >> np.uint64(1)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, runs), len(frequent) - 1)
        runs |= (frequent[at] == runs).astype(np.uint64) << np.uint64(63)
    return runs


def super_kmers(hashes: np.ndarray, docs: np.ndarray, frequent: np.ndarray = np.empty(0, np.uint64)):
    """First window, number of windows and minimiser of every super-k-mer."""
    if len(hashes) < WINDOW:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    least = least_of(run_order(hashes, frequent), WINDOW - GRAM + 1)
    inside = docs[: len(least)] == docs[WINDOW - 1 :]
    starts = np.flatnonzero(inside)
    if not len(starts):
        return starts, starts, np.empty(0, np.uint64)
    new = np.ones(len(starts), bool)
    new[1:] = (np.diff(starts) > 1) | (least[starts[1:]] != least[starts[:-1]])
    new[1:] |= docs[starts[1:]] != docs[starts[:-1]]
    first = np.flatnonzero(new)
    return starts[first], np.diff(np.append(first, len(starts))), least[starts[first]]


def _count_minimisers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many strings of a task have each minimiser, but for the rarest."""
    words, held, size = w.Hasher(10), [], 0

    def summed() -> pa.Table:
        return pa.concat_tables(held).group_by("run").aggregate([("n", "sum")]).rename_columns(["run", "n"])

    def counted() -> Iterator[pa.RecordBatch]:
        table = summed()
        yield from table.filter(pc.greater_equal(table["n"], COUNTED_LEAST)).to_batches()

    for batch in batches:
        for chunk in w.chunks(batch.column("text"), CHUNK_BYTES):
            hashes = words.spans(chunk.data, chunk.starts, chunk.ends)
            runs, counts = np.unique(super_kmers(hashes, chunk.doc_of_word())[2], return_counts=True)
            held.append(pa.table({"run": runs.view(np.int64), "n": counts}))
            size += len(runs)
            if size > COUNTED_AT_ONCE:
                held = [summed()]
                size = held[0].num_rows
                if size > COUNTED_AT_ONCE // 2:
                    yield from counted()
                    held, size = [], 0
    if held:
        yield from counted()


def frequent_runs(docs: DataFrame) -> np.ndarray:
    """Runs of words that are the minimisers of very many strings, sorted; at most FREQUENT_RUNS numbers."""
    counts = docs.select("text").mapInArrow(_count_minimisers, "run bigint, n bigint")
    many = counts.groupBy("run").agg(F.sum("n").alias("n")).filter(F.col("n") >= FREQUENT_LEAST)
    found = many.orderBy(F.desc("n"), "run").limit(FREQUENT_RUNS).collect()
    return np.sort(np.array([row.run for row in found], np.int64).view(np.uint64))


def single_spaced(chunk: w.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of a chunk with one space after each, and their new places."""
    sizes = chunk.ends - chunk.starts
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    out = np.full(int((sizes + 1).sum()), 32, np.uint8)
    solid = ~w.BLANK[chunk.data]
    place = np.ones(len(out), bool)
    place[starts + sizes] = False
    out[place] = chunk.data[solid]
    return out, starts, starts + sizes


def _runs_key(hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, hasher: w.Hasher) -> np.ndarray:
    """A hash of each run of word hashes, wherever it lies."""
    powers, inverses = hasher.tables(len(hashes) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers[: len(hashes)])])
    return w.mix((sums[starts + sizes] - sums[starts]) * inverses[starts] + sizes.astype(np.uint64))


# Columns of a block, in this order, and then the strings.
ENTRY = (
    ("minimiser", np.uint32),
    ("windows", np.int32),
    ("size", np.int32),
    ("at", np.int32),
    ("row", np.int64),  # -1: a frequent string, whose places travel apart
    ("low", np.int64),
    ("range", np.int64),
)


def _pack(entries: dict[str, np.ndarray], text: np.ndarray) -> bytes:
    body = b"".join([*(entries[name].astype(kind).tobytes() for name, kind in ENTRY), text.tobytes()])
    head = np.array([len(entries["row"]), len(body)], np.int64).tobytes()
    return head + pa.Codec("zstd", compression_level=LEVEL).compress(body, asbytes=True)


def _unpack(block: bytes) -> tuple[dict[str, np.ndarray], np.ndarray]:
    n, size = np.frombuffer(block, np.int64, 2)
    body = pa.decompress(block[16:], int(size), codec="zstd", asbytes=True)
    entries, at = {}, 0
    for name, kind in ENTRY:
        entries[name] = np.frombuffer(body, kind, int(n), at)
        at += int(n) * np.dtype(kind).itemsize
    return entries, np.frombuffer(body, np.uint8, offset=at)


def _record(schema: pa.Schema, n: int, **columns) -> pa.RecordBatch:
    """Rows of which the columns that are not given are null."""
    arrays = []
    for field in schema:
        values = columns.get(field.name)
        if values is None:
            arrays.append(pa.nulls(n, field.type))
        elif isinstance(values, int):
            arrays.append(pa.array(np.full(n, values), field.type))
        else:
            arrays.append(values if isinstance(values, pa.Array) else pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _digest(text: bytes) -> tuple[int, int]:
    first, second = np.frombuffer(hashlib.blake2b(text, digest_size=16).digest(), np.int64)
    return int(first), int(second)


def _sha(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()


def _gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of the bytes of some spans, one span after the other."""
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    return np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)


def _send(buckets: int, frequent: np.ndarray):
    """What each chunk of texts has to say: its texts, its blocks, its places of frequent strings."""
    schema = SENT_ROWS

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, runs = w.Hasher(10), w.Hasher(11)
        for batch in batches:
            all_rows = batch.column("row").to_numpy()
            all_ids = batch.column("doc_id").fill_null(NO_ID).to_numpy()
            for chunk in w.chunks(batch.column("text"), CHUNK_BYTES):
                rows = all_rows[chunk.row : chunk.row + chunk.texts]
                ids = all_ids[chunk.row : chunk.row + chunk.texts]
                data, starts, ends = single_spaced(chunk)
                edges = np.append(starts, len(data))
                whole = [
                    _sha(data[edges[a] : max(edges[b] - 1, 0)].tobytes() if b > a else b"")
                    for a, b in zip(chunk.first[:-1], chunk.first[1:])
                ]
                own = {
                    name: batch.column(name).slice(chunk.row, chunk.texts)
                    for name in ("row", "file_key", "file_row", "doc_id")
                }
                yield _record(
                    schema, chunk.texts, kind=0, bucket=rows % buckets, n_words=chunk.counts, sha=whole, **own
                )
                docs = chunk.doc_of_word()
                hashes = words.spans(data, starts, ends)
                first, windows, least = super_kmers(hashes, docs, frequent)
                if not len(first):
                    continue
                key = _runs_key(hashes, first, windows + WINDOW - 1, runs)
                entries = {
                    "minimiser": least,
                    "windows": windows,
                    "size": edges[first + windows + WINDOW - 1] - edges[first],
                    "at": first - chunk.first[docs[first]],
                    "row": rows[docs[first]],
                    "low": ids[docs[first]],
                    "range": np.zeros(len(first), np.int64),
                    "start": edges[first],
                }
                order = np.argsort(key, kind="stable")
                bounds = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
                counts = np.diff(np.append(bounds, len(order)))
                often = counts > OFTEN
                if often.any():
                    sent, hot = _apart(entries, order, bounds, counts, often, data)
                    yield _record(schema, len(hot["row"]), kind=2, bucket=hot["row"] % buckets, **hot)
                else:
                    sent = entries
                where = (sent["minimiser"] >> np.uint64(32)) % np.uint64(buckets)
                order = np.argsort(where, kind="stable")
                sent = {name: values[order] for name, values in sent.items()}
                cuts = np.flatnonzero(np.append(True, where[order][1:] != where[order][:-1]))
                blocks, numbers = [], where[order][cuts].astype(np.int64)
                for a, b in zip(cuts, np.append(cuts[1:], len(order))):
                    part = {name: values[a:b] for name, values in sent.items()}
                    blocks.append(_pack(part, data[_gather(part["start"], part["size"])]))
                yield _record(schema, len(blocks), kind=1, bucket=numbers, block=pa.array(blocks, pa.binary()))

    return send


def _apart(entries, order, bounds, counts, often, data):
    """Replaces the places of frequent strings by one entry each; returns the places by themselves."""
    member = np.zeros(len(order), bool)
    member[order] = np.repeat(often, counts)
    keys, groups = [], []
    for a, n in zip(bounds[often], counts[often]):
        one = order[a]
        start, size = entries["start"][one], entries["size"][one]
        keys.append(_digest(data[start : start + size].tobytes()))
        groups.append(order[a : a + n])
    ones = np.array([group[0] for group in groups])
    low = np.array([entries["low"][group].min() for group in groups])
    high = np.array([entries["low"][group].max() for group in groups])
    heads = {name: values[ones] for name, values in entries.items()}
    heads |= {"row": np.full(len(ones), -1), "low": low, "range": high - low}
    places = np.concatenate(groups)
    repeated = np.repeat(np.array(keys, np.int64), [len(group) for group in groups], axis=0)
    hot = {
        "row": entries["row"][places],
        "doc_id": entries["low"][places],
        "at": entries["at"][places],
        "key1": repeated[:, 0],
        "key2": repeated[:, 1],
    }
    return {name: np.concatenate([values[~member], heads[name]]) for name, values in entries.items()}, hot


def least_ids(first: np.ndarray, second: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For every window, by its two hashes, the least doc_id among the equal ones."""
    order = np.lexsort((second, first))
    change = np.append(True, (first[order][1:] != first[order][:-1]) | (second[order][1:] != second[order][:-1]))
    bounds = np.flatnonzero(change)
    least = np.minimum.reduceat(ids[order], bounds)
    out = np.empty(len(ids), np.int64)
    out[order] = np.repeat(least, np.diff(np.append(bounds, len(order))))
    return out


def _resolve(blocks: list[bytes], hashers: tuple[w.Hasher, w.Hasher]) -> Iterator[pa.RecordBatch]:
    """The windows of one bucket that also start in a document with a smaller doc_id."""
    parts = [_unpack(block) for block in blocks]
    entries = {name: np.concatenate([part[name] for part, _ in parts]) for name, _ in ENTRY}
    text = np.concatenate([text for _, text in parts])
    starts = np.concatenate([[0], np.cumsum(entries["size"], dtype=np.int64)])[:-1]
    high = entries["low"] + entries["range"]

    # Strings whose minimiser comes from one document only have no window elsewhere.
    order = np.argsort(entries["minimiser"], kind="stable")
    ranked = entries["minimiser"][order]
    bounds = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    shared = np.minimum.reduceat(entries["low"][order], bounds) < np.maximum.reduceat(high[order], bounds)
    kept = order[np.repeat(shared, np.diff(np.append(bounds, len(order))))]
    if not len(kept):
        return
    entries = {name: values[kept] for name, values in entries.items()}
    high, starts = high[kept], starts[kept]
    sizes = entries["size"].astype(np.int64)
    text = text[_gather(starts, sizes)]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    begins, ends, first = w.find_words(text, offsets)
    windows = entries["windows"].astype(np.int64)
    place = _gather(first[:-1], windows)
    one, two = (w.runs_hash(hasher.spans(text, begins, ends), WINDOW)[place] for hasher in hashers)
    owner = np.repeat(np.arange(len(windows)), windows)
    least = least_ids(one, two, entries["low"][owner])

    frequent = entries["row"] < 0
    flagged = (least < entries["low"][owner]) & ~frequent[owner]
    at = np.flatnonzero(flagged)
    if len(at):
        fresh = np.append(True, (np.diff(at) > 1) | (owner[at][1:] != owner[at][:-1]))
        begin = np.flatnonzero(fresh)
        which = owner[at[begin]]
        inside = at[begin] - (np.cumsum(windows) - windows)[which]
        yield _record(
            FOUND_ROWS, len(begin), kind=3, row=entries["row"][which], at=entries["at"][which] + inside,
            length=np.diff(np.append(begin, len(at))),
        )
    answers, upto = [], np.concatenate([[0], np.cumsum(windows)])
    for entry in np.flatnonzero(frequent):
        span = slice(int(upto[entry]), int(upto[entry + 1]))
        if least[span].min() < high[entry]:
            answers.append((*_digest(text[offsets[entry] : offsets[entry + 1]].tobytes()), least[span].tolist()))
    if answers:
        # A string that several chunks have sent is answered once.
        key1, key2, lists = zip(*{answer[:2]: answer for answer in answers}.values())
        yield _record(FOUND_ROWS, len(lists), kind=4, key1=np.array(key1), key2=np.array(key2), least=pa.array(lists, pa.list_(pa.int64())))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Resolves the buckets of a partition, which come in order, one at a time."""
    hashers = w.Hasher(12), w.Hasher(13)
    current, blocks = None, []
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        passed = batch.filter(pa.array(kind != 1))
        if len(passed):
            names = [name for name in FOUND_ROWS.names if name in passed.schema.names]
            yield _record(FOUND_ROWS, len(passed), **{name: passed.column(name) for name in names})
        sent = batch.filter(pa.array(kind == 1))
        for bucket, packed in zip(sent.column("bucket").to_pylist(), sent.column("block")):
            if bucket != current and blocks:
                yield from _resolve(blocks, hashers)
                blocks = []
            current = bucket
            blocks.append(packed.as_py())
    if blocks:
        yield from _resolve(blocks, hashers)


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes, for the way to their marks."""
    codec = pa.Codec("zstd", compression_level=LEVEL)
    for batch in batches:
        raw = [text.encode() for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("file_key"),
                batch.column("file_row"),
                pa.array([len(text) for text in raw], pa.int64()),
                pa.array([codec.compress(text, asbytes=True) for text in raw], pa.binary()),
            ],
            names=["file_key", "file_row", "n_bytes", "packed"],
        )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of texts without the words of their marked windows."""
    for batch in batches:
        sizes, packed = batch.column("n_bytes").to_pylist(), batch.column("packed").to_pylist()
        texts = [
            pa.decompress(text, size, codec="zstd", asbytes=True).decode() for text, size in zip(packed, sizes)
        ]
        marks = batch.column("marks")
        counts = np.asarray(marks.value_lengths())
        flat = marks.flatten()
        starts, lengths = (flat.field(name).to_numpy() for name in ("at", "length"))
        first = np.concatenate([[0], np.cumsum(counts)])
        removed, kept = [], []
        for chunk in w.chunks(pa.array(texts, pa.string()), CHUNK_BYTES):
            span = slice(first[chunk.row], first[chunk.row + chunk.texts])
            base = np.repeat(chunk.first[:-1], counts[chunk.row : chunk.row + chunk.texts])
            change = np.zeros(len(chunk.starts) + 1, np.int64)
            np.add.at(change, base + starts[span], 1)
            np.add.at(change, base + starts[span] + lengths[span] + WINDOW - 1, -1)
            gone = np.cumsum(change)[:-1] > 0
            data, begins, _ = single_spaced(chunk)
            stays = np.repeat(~gone, np.diff(np.append(begins, len(data))))
            size = np.concatenate([[0], np.cumsum(stays)])[np.append(begins, len(data))][chunk.first]
            data = data[stays]
            removed.append(w.per_text(chunk, gone))
            kept += [_sha(data[a : max(b - 1, a)].tobytes()) for a, b in zip(size[:-1], size[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(np.concatenate(removed).astype(np.int64)), pa.array(kept)],
            names=["row", "n_removed", "cut_sha"],
        )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed and kept_sha256.

    A word goes if a window over it also starts in a document with a smaller
    doc_id.  Windows are judged on the texts as they come.  A row without
    doc_id counts as smaller than all others; rows that share a doc_id do not
    count against each other.  A null text has no words, and what is left of
    it is empty.  An empty table gives no rows; columns other than doc_id and
    text are not read.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    docs = placed(in_files(docs), "doc_id", text_of().alias("text"))
    size = docs.agg(F.sum(F.octet_length("text")).alias("bytes")).first().bytes or 0
    parts = shuffle_partitions(spark)
    # Windows that overlap are sent in strings of about three times the text.
    buckets = max(parts, -(-3 * size // BUCKET_BYTES))
    sent = numbered(docs, "row").mapInArrow(_send(buckets, frequent_runs(docs)), SENT)
    dealt = sent.repartition(parts, "bucket").sortWithinPartitions("bucket", "kind")
    found = stored(dealt.mapInArrow(_find, FOUND), "windows")

    kind = lambda n: found.filter(F.col("kind") == n)
    answers = kind(4).select("key1", "key2", "least")
    mark = lambda at, length: F.struct(at.alias("at"), length.cast("bigint").alias("length"))
    windows = F.filter(
        F.sequence(F.lit(0), F.size("least") - 1), lambda i: F.get(F.col("least"), i) < F.col("doc_id")
    )
    frequent = (
        kind(2)
        .select("row", "doc_id", "at", "key1", "key2")
        .join(answers, ["key1", "key2"])
        .select("row", F.transform(windows, lambda i: mark(F.col("at") + i, F.lit(1))).alias("marks"))
        .filter(F.size("marks") > 0)
    )
    single = kind(3).select("row", F.array(mark(F.col("at"), F.col("length"))).alias("marks"))
    marks = single.unionByName(frequent).groupBy("row").agg(F.flatten(F.collect_list("marks")).alias("marks"))
    marked = kind(0).select("row", "file_key", "file_row").join(marks, "row")
    packed = docs.select("file_key", "file_row", "text").mapInArrow(
        _squeeze, "file_key bigint, file_row bigint, n_bytes bigint, packed binary"
    )
    marked = packed.join(marked, ["file_key", "file_row"])
    cut = marked.select("row", "n_bytes", "packed", "marks").mapInArrow(_cut, "row bigint, n_removed bigint, cut_sha string")
    return kind(0).select("row", "doc_id", "n_words", "sha").join(cut, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("cut_sha", "sha").alias("kept_sha256"),
    )
