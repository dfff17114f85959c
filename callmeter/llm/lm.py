"""Language-model scores by marginal likelihood over subword lattices.

The pieces of a public subword vocabulary span a lattice over every word: each
path from its beginning to its end is one segmentation.  A piece has a
probability, a path the product of its pieces, and a word the sum over all of
its paths, found by a forward recursion in log space.  A text is its words and
one end, so its probability is exact and not that of one best segmentation.

Probabilities start from the scores of the vocabulary and are re-estimated on
the training documents by their expected counts (forward-backward).  Words do
not share pieces, so everything is computed once per distinct word: counts and
lattices grow with the vocabulary of the corpus, not with its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmeter.llm import words as w
from callmeter.llm.common import bound_batches, numbered, text_of
from callmeter.sources.stored import stored

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"

# Fixed value: the mark that begins a word in the vocabulary.
WORD_MARK = "▁".encode()

# Words looked up in memory by every task; the rest meet their scores in a join.
FREQUENT_WORDS = 1 << 17

FLUSH_WORDS = 300_000
# A longer word is gone through in frames of so many bytes.
FRAME_BYTES = 4096
# Bytes of the words of one batch times the width of the lattice.
BATCH_CELLS = 1 << 20
SMOOTHING = 0.1


@dataclass
class Pieces:
    """Hashes of all beginnings of pieces, sorted, and which piece each of them is, or -1."""

    prefixes: np.ndarray
    piece: np.ndarray
    longest: int
    n: int  # pieces; the ids after them are single bytes and, last, the end


def lattice_hasher() -> w.Hasher:
    return w.Hasher(5)


def read_vocabulary(path: str) -> tuple[Pieces, np.ndarray]:
    """Pieces that lower-cased text can contain, and log probabilities from their scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = []
    for i in range(model.get_piece_size()):
        if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        text = model.id_to_piece(i).encode()
        mark = WORD_MARK in text[1:]
        if not mark and text == text.translate(w.LOWER.tobytes()):
            found.append((text, model.get_score(i)))
    hasher = lattice_hasher()
    known: dict[bytes, int] = {}
    for number, (text, _) in enumerate(found):
        known[text] = number
        for size in range(1, len(text)):
            known.setdefault(text[:size], -1)
    parts = list(known)
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(part) for part in parts])
    hashes = hasher.spans(data, np.concatenate([[0], ends[:-1]]), ends)
    order = np.argsort(hashes)
    numbers = np.fromiter(known.values(), np.int64, len(parts))
    pieces = Pieces(hashes[order], numbers[order], max(len(text) for text, _ in found), len(found))
    # Scores are ranks of merges; a piece of rank r weighs 1 / r, all bytes together little.
    weights = np.concatenate([1 / (1 - np.array([s for _, s in found])), np.full(256, 1e-5), [0.1]])
    return pieces, np.log(weights / weights.sum())


def _lattice(
    pieces: Pieces,
    log_p: np.ndarray,
    hasher: w.Hasher,
    data: np.ndarray,
    starts: np.ndarray,
    sizes: np.ndarray,
    marked: int = len(WORD_MARK),
):
    """Piece and its log probability for each place and length in a buffer of marked words.

    Row i, column l - 1: the piece of l bytes that begins at i, or -1.  The
    marked bytes of a word, its first, stand for no bytes of the text.
    """
    n = len(data)
    left = np.zeros(n, np.int64)  # bytes to the end of the word
    left[:] = np.repeat(starts + sizes, sizes) - np.arange(n)
    which = np.full((n, pieces.longest), -1, np.int32)
    sums = np.zeros(n + 1, np.uint64)
    powers, inverses = hasher.tables(n + 1)
    np.cumsum(hasher.values[data] * powers[:n], out=sums[1:])
    active = np.arange(n)
    for size in range(1, pieces.longest + 1):
        active = active[left[active] >= size]
        if not len(active):
            break
        hashes = w.mix(
            (sums[active + size] - sums[active]) * inverses[active]
            + np.uint64(size * w.ODD & w.ALL_BITS)
        )
        at = np.minimum(np.searchsorted(pieces.prefixes, hashes), len(pieces.prefixes) - 1)
        found = pieces.prefixes[at] == hashes
        active, at = active[found], at[found]
        which[active, size - 1] = pieces.piece[at]
    scores = np.where(which >= 0, log_p[which], -np.inf)
    byte = log_p[pieces.n + data.astype(np.int64)].copy()
    inside = np.arange(n) - np.repeat(starts, sizes)
    byte[inside < marked] = -np.inf
    return which, scores, byte


def _sum_logs(values: np.ndarray) -> np.ndarray:
    """Log of the sum of exponentials over the last axis."""
    top = values.max(axis=-1)
    safe = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(values - safe[..., None]).sum(axis=-1)) + safe


def _ending_at(scores: np.ndarray, starts: np.ndarray, longest: int, j: int, rows: np.ndarray) -> np.ndarray:
    """Scores of the pieces of 1, 2, ... bytes that end at place j of some words."""
    sizes = np.arange(1, min(j, longest) + 1)
    return scores[(starts[rows] + j)[:, None] - sizes[None, :], sizes[None, :] - 1]


def _forward(pieces: Pieces, scores: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Log probability of the first j bytes of every word; words come by descending size."""
    alpha = np.full((len(starts), int(sizes[0]) + 1), -np.inf)
    alpha[:, 0] = 0.0
    for j in range(1, int(sizes[0]) + 1):
        rows = np.arange(np.searchsorted(-sizes, -j, "right"))
        ends = _ending_at(scores, starts, pieces.longest, j, rows)
        alpha[rows, j] = _sum_logs(ends + alpha[rows[:, None], j - 1 - np.arange(ends.shape[1])])
    return alpha


def _expected_uses(pieces, which, scores, byte, both, data, alpha, starts, sizes, counts) -> np.ndarray:
    """Expected uses of pieces and bytes over some words, by the backward recursion."""
    longest, words = pieces.longest, np.arange(len(starts))
    beta = np.full((len(starts), alpha.shape[1] + longest), -np.inf)
    beta[words, sizes] = 0.0
    uses = np.zeros(pieces.n + 257)
    weight = np.log(counts) - alpha[words, sizes]
    for i in range(int(sizes[0]) - 1, -1, -1):
        rows = words[: np.searchsorted(-sizes, -(i + 1), "right")]
        begin = starts[rows] + i
        after = beta[rows, i + 1 : i + 1 + longest]
        beta[rows, i] = _sum_logs(both[begin] + after)
        base = (alpha[rows, i] + weight[rows])[:, None]
        used = which[begin] >= 0
        share = np.exp((scores[begin] + after + base)[used])
        uses += np.bincount(which[begin][used], share, minlength=len(uses))
        single = np.exp(byte[begin] + after[:, 0] + base[:, 0])
        uses += np.bincount(pieces.n + data[begin].astype(np.int64), single, minlength=len(uses))
    return uses


def _frame(pieces: Pieces, log_p: np.ndarray, hasher: w.Hasher, word: np.ndarray, low: int) -> tuple:
    """The lattice of some bytes of a word, made with the bytes behind them that their pieces reach."""
    data = word[low : low + FRAME_BYTES + pieces.longest]
    inside = min(FRAME_BYTES, len(word) - low)
    marked = len(WORD_MARK) if low == 0 else 0
    which, scores, byte = _lattice(pieces, log_p, hasher, data, np.zeros(1, int), np.array([len(data)]), marked)
    both = scores.copy()
    both[:, 0] = np.logaddexp(scores[:, 0], byte)
    return which[:inside], scores[:inside], byte[:inside], both[:inside]


def long_lattice(word: np.ndarray, count: float | None, pieces: Pieces, log_p: np.ndarray, hasher: w.Hasher):
    """Log probability and expected uses of one long word: time and memory grow with its length.

    Only the forward and backward sums of all places are kept, and lattices are
    made anew on the way back.
    """
    n, longest = len(word), pieces.longest
    frames = range(0, n, FRAME_BYTES)
    alpha = np.full(n + longest + 1, -np.inf)
    alpha[0] = 0.0
    for low in frames:
        for i, row in enumerate(_frame(pieces, log_p, hasher, word, low)[3], low + 1):
            ahead = alpha[i : i + longest]
            np.logaddexp(ahead, row + alpha[i - 1], out=ahead)
    uses = np.zeros(pieces.n + 257)
    if count is None:
        return alpha[n], uses
    beta = np.full(n + longest + 1, -np.inf)
    beta[n] = 0.0
    for low in reversed(frames):
        which, scores, byte, both = _frame(pieces, log_p, hasher, word, low)
        for i in range(len(both) - 1, -1, -1):
            beta[low + i] = np.logaddexp.reduce(both[i] + beta[low + i + 1 : low + i + 1 + longest])
        after = np.lib.stride_tricks.sliding_window_view(beta, longest)[low + 1 : low + 1 + len(both)]
        base = alpha[low : low + len(both)] + np.log(count) - alpha[n]
        used = which >= 0
        uses += np.bincount(which[used], np.exp((scores + after + base[:, None])[used]), minlength=len(uses))
        single = np.exp(byte + after[:, 0] + base)
        uses += np.bincount(pieces.n + word[low : low + len(both)].astype(np.int64), single, minlength=len(uses))
    return alpha[n], uses


def word_lattices(words: pa.Array, counts: np.ndarray | None, pieces: Pieces, log_p: np.ndarray, hasher: w.Hasher):
    """Log probability of every word and, given counts, the expected uses of pieces."""
    words = words.fill_null("")
    raw = [WORD_MARK + word for word in words.cast(pa.binary()).to_pylist()]
    sizes = np.array([len(word) for word in raw], np.int64)
    order = np.argsort(-sizes, kind="stable")
    out, uses, at = np.empty(len(raw)), np.zeros(pieces.n + 257), 0
    while at < len(order) and sizes[order[at]] > FRAME_BYTES:
        i = order[at]
        count = None if counts is None else counts[i]
        out[i], used = long_lattice(np.frombuffer(raw[i], np.uint8), count, pieces, log_p, hasher)
        uses += used
        at += 1
    while at < len(order):
        # A batch holds words of like size, longest first.
        room = max(1, BATCH_CELLS // (pieces.longest * int(sizes[order[at]])))
        part = order[at : at + room]
        own = sizes[part]
        starts = np.concatenate([[0], np.cumsum(own)[:-1]])
        data = np.frombuffer(b"".join(raw[i] for i in part), np.uint8)
        which, scores, byte = _lattice(pieces, log_p, hasher, data, starts, own)
        both = scores.copy()
        both[:, 0] = np.logaddexp(scores[:, 0], byte)
        alpha = _forward(pieces, both, starts, own)
        out[part] = alpha[np.arange(len(part)), own]
        if counts is not None:
            uses += _expected_uses(pieces, which, scores, byte, both, data, alpha, starts, own, counts[part])
        at += room
    return out, uses


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of lower-cased words, in training texts and in all, summed per task."""
    hasher, pending, size = w.Hasher(6, lower=True), [], 0

    def summed() -> pa.Table:
        table = pa.concat_tables(pending).group_by("word").aggregate([("learned", "sum"), ("uses", "sum")])
        return table.rename_columns({"learned_sum": "learned", "uses_sum": "uses"}).select(["word", "learned", "uses"])

    for batch in batches:
        learn = np.asarray(batch.column("learn").to_pylist(), bool)
        for chunk in w.chunks(batch.column("text")):
            hashes = hasher.spans(chunk.data, chunk.starts, chunk.ends)
            _, firsts, word = np.unique(hashes, return_index=True, return_inverse=True)
            weight = np.repeat(learn[chunk.row : chunk.row + chunk.texts], chunk.counts)
            pending.append(
                pa.table(
                    {
                        "word": w.take_spans(w.LOWER[chunk.data], chunk.starts[firsts], chunk.ends[firsts]),
                        "learned": np.bincount(word, weight, minlength=len(firsts)).astype(np.int64),
                        "uses": np.bincount(word, minlength=len(firsts)).astype(np.int64),
                    }
                )
            )
            size += len(firsts)
            if size > 4 * FLUSH_WORDS:
                pending = [summed()]
                size = len(pending[0])
                if size > FLUSH_WORDS:
                    yield from pending[0].to_batches()
                    pending, size = [], 0
    if pending:
        yield from summed().to_batches()


def _held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(True))


def word_table(docs: DataFrame) -> DataFrame:
    """Every distinct word with its uses in training texts and in all, stored."""
    rows = docs.select((~_held_out()).alias("learn"), text_of().alias("text"))
    counts = rows.mapInArrow(_word_counts, "word string, learned bigint, uses bigint")
    table = counts.groupBy("word").agg(F.sum("learned").alias("learned"), F.sum("uses").alias("uses"))
    return stored(table, "words")


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Batches of some rows at least: lattices of few words cost as many steps as those of many."""
    pending, size = [], 0
    for batch in batches:
        pending.append(batch)
        size += len(batch)
        if size >= rows:
            yield from pa.Table.from_batches(pending).combine_chunks().to_batches()
            pending, size = [], 0
    if pending:
        yield from pa.Table.from_batches(pending).combine_chunks().to_batches()


def learn_pieces(words: DataFrame, learned_texts: int, vocabulary: str, rounds: int):
    """Pieces and their log probabilities after some rounds of re-estimation.

    What comes to the driver is one number per piece of the vocabulary.
    """
    pieces, log_p = read_vocabulary(vocabulary)
    context = words.sparkSession.sparkContext
    for _ in range(rounds):
        shared = context.broadcast((vars(pieces), log_p))

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own, logs = Pieces(**shared.value[0]), shared.value[1]
            hasher, uses = lattice_hasher(), np.zeros(own.n + 257)
            for batch in _gathered(batches):
                counts = batch.column("learned").to_numpy().astype(float)
                uses += word_lattices(batch.column("word"), counts, own, logs, hasher)[1]
            at = np.flatnonzero(uses)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(uses[at])], names=["piece", "uses"])

        found = words.filter("learned > 0").select("word", "learned").mapInArrow(expect, "piece bigint, uses double")
        uses = np.full(pieces.n + 257, SMOOTHING)
        for row in found.groupBy("piece").agg(F.sum("uses").alias("uses")).collect():
            uses[row.piece] += row.uses
        uses[-1] += learned_texts
        log_p = np.log(uses / uses.sum())
    return pieces, log_p


def scored_words(words: DataFrame, pieces: Pieces, log_p: np.ndarray, base: tuple[int, int]) -> DataFrame:
    """Hash, count, base score and lattice score (both log10) of every word, stored."""
    shared = words.sparkSession.sparkContext.broadcast((vars(pieces), log_p))
    total, distinct = base

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, logs = Pieces(**shared.value[0]), shared.value[1]
        hasher, names = lattice_hasher(), w.Hasher(6, lower=True)
        for batch in _gathered(batches):
            text = batch.column("word")
            lengths = np.diff(np.frombuffer(text.buffers()[1], np.int32, len(text) + 1 + text.offset)[text.offset :])
            ends = np.cumsum(lengths.astype(np.int64))
            data = np.frombuffer(b"".join(text.cast(pa.binary()).to_pylist()), np.uint8)
            hashes = names.spans(data, ends - lengths, ends)
            learned = batch.column("learned").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes.view(np.int64)),
                    batch.column("uses"),
                    pa.array(learned > 0),
                    pa.array(np.log10((learned + SMOOTHING) / (total + SMOOTHING * (distinct + 1)))),
                    pa.array(word_lattices(text, None, own, logs, hasher)[0] / np.log(10)),
                ],
                names=["word_hash", "uses", "known", "base", "lattice"],
            )

    schema = "word_hash bigint, uses bigint, known boolean, base double, lattice double"
    return stored(words.select("word", "learned", "uses").mapInArrow(score, schema), "word-scores")


def frequent_words(scores: DataFrame) -> dict[str, np.ndarray]:
    """Scores of at most FREQUENT_WORDS words, those used most, by hash."""
    grade = F.floor(F.log2("uses") * 16).cast("int")
    left, least = FREQUENT_WORDS, 1 << 30
    for row in sorted(scores.groupBy(grade.alias("grade")).count().collect(), reverse=True):
        left -= row["count"]
        if left < 0:
            break
        least = row.grade
    rows = scores.filter(grade >= least).select("word_hash", "known", "base", "lattice").toPandas()
    rows = rows.sort_values("word_hash")
    return {name: rows[name].to_numpy() for name in rows.columns}


PARTS = (
    "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, lattice double, "
    "rare array<bigint>, rare_uses array<int>"
)


def _score_texts(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, frequent = w.Hasher(6, lower=True), shared.value
        ranked = frequent["word_hash"]
        for batch in batches:
            out = {name: [] for name in ("n_tokens", "known", "base", "lattice", "rare", "rare_uses", "ends")}
            done = 0
            for chunk in w.chunks(batch.column("text")):
                hashes = hasher.spans(chunk.data, chunk.starts, chunk.ends).view(np.int64)
                unique, word = np.unique(hashes, return_inverse=True)
                at = np.minimum(np.searchsorted(ranked, unique), max(len(ranked) - 1, 0))
                found = ranked[at] == unique if len(ranked) else np.zeros(len(unique), bool)
                value = lambda name: np.where(found, frequent[name][at], 0)[word] if len(ranked) else np.zeros(len(word))
                out["n_tokens"].append(chunk.counts)
                for name in ("known", "base", "lattice"):
                    out[name].append(w.per_text(chunk, value(name)))
                rare = np.flatnonzero(~found[word])
                docs = chunk.doc_of_word()[rare]
                # Distinct rare words of each text, in the order of the texts.
                pairs = docs * len(unique) + word[rare]
                pairs, uses = np.unique(pairs, return_counts=True)
                out["rare"].append(unique[pairs % max(len(unique), 1)])
                out["rare_uses"].append(uses)
                out["ends"].append(done + np.searchsorted(pairs, np.arange(1, chunk.texts + 1) * len(unique)))
                done += len(pairs)
            whole = {name: np.concatenate(parts) if parts else np.empty(0) for name, parts in out.items()}
            offsets = pa.array(np.concatenate([[0], whole["ends"]]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(whole["n_tokens"].astype(np.int64) + 1),
                    pa.array(whole["known"].astype(np.int64)),
                    pa.array(whole["base"].astype(float)),
                    pa.array(whole["lattice"].astype(float)),
                    pa.ListArray.from_arrays(offsets, pa.array(whole["rare"].astype(np.int64))),
                    pa.ListArray.from_arrays(offsets, pa.array(whole["rare_uses"].astype(np.int32))),
                ],
                names=["row", "doc_id", "held_out", "n_tokens", "known", "base", "lattice", "rare", "rare_uses"],
            )

    return score


def score_documents(docs: DataFrame, vocabulary: str = VOCABULARY, rounds: int = 2) -> DataFrame:
    """One row per document: held_out, tokens, base_score and score (log10 probabilities).

    Learns from the documents whose crc32 of doc_id is no multiple of 10; one
    without doc_id is held out.  A null text is empty and consists of its end
    only.  Repeated rows count as often as they occur.  Without documents to
    learn from all counts are zero.  An empty table gives no rows; columns
    other than doc_id and text are not read.
    """
    bound_batches(docs.sparkSession)
    words = word_table(docs)
    sums = words.agg(
        F.coalesce(F.sum("learned"), F.lit(0)).alias("uses"),
        F.count(F.when(F.col("learned") > 0, 1)).alias("distinct"),
    ).first()
    learned_texts = docs.filter(~_held_out()).count()
    total, distinct = sums.uses + learned_texts, sums.distinct + (learned_texts > 0)

    pieces, log_p = learn_pieces(words, learned_texts, vocabulary, rounds)
    scores = scored_words(words, pieces, log_p, (total, distinct))
    shared = docs.sparkSession.sparkContext.broadcast(frequent_words(scores))
    rows = numbered(docs.select("doc_id", "text"), "row").select(
        "row", "doc_id", _held_out().alias("held_out"), text_of().alias("text")
    )
    parts = stored(rows.mapInArrow(_score_texts(shared), PARTS), "text-parts")

    pairs = parts.select("row", F.explode(F.arrays_zip("rare", "rare_uses")).alias("pair")).select(
        "row", F.col("pair.rare").alias("word_hash"), F.col("pair.rare_uses").alias("n")
    )
    rest = (
        pairs.join(scores.select("word_hash", "known", "base", "lattice"), "word_hash")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("known"), F.col("n")).otherwise(0)).alias("more_known"),
            F.sum(F.col("n") * F.col("base")).alias("more_base"),
            F.sum(F.col("n") * F.col("lattice")).alias("more_lattice"),
        )
    )
    end = np.log10((learned_texts + SMOOTHING) / (total + SMOOTHING * (distinct + 1)))
    more = lambda name: F.coalesce(F.col(f"more_{name}"), F.lit(0))
    return parts.drop("rare", "rare_uses").join(rest, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + more("known") + int(learned_texts > 0)).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base") + more("base") + F.lit(float(end))).alias("base_score"),
        (F.col("lattice") + more("lattice") + F.lit(float(log_p[-1] / np.log(10)))).alias("score"),
    )
