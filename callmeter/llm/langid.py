"""Language identification with a linear-chain conditional random field.

Every word of a text is labelled with a language, so text that switches
language within a line is taken for what it is.  Features of a word are its
byte n-grams with marks for both ends (those with a mark are its affixes) and,
for words frequent in the training texts, the word itself.  Features and
transitions between languages are learned together by gradient descent on the
likelihood of whole chains, and forward-backward gives the probability of each
language for each word.  The language of a text is the one with the largest
mean probability over all of its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callmeter.llm import words as w
from callmeter.llm.common import BLANK_RUN, KEY_BITS, fresh_name, hash_key

UNDETERMINED = "und"

# Rows of the weight table: hashed n-grams, then hashed words of the lexicon.
GRAM_ROWS = 1 << 17
LEXICON_ROWS = 1 << 16
MAX_GRAM = 4
CHAIN = 64

# Rows drawn of a language at least, and characters of one span of a long text.
LEAST_OF_LANGUAGE = 30
SPAN_CHARS = 500

# Languages for which the weight table has all of its rows; with more it gets fewer, and keeps its size.
FULL_LANGUAGES = 64

# A text is in no language that was learned if its words are labelled with less
# than this share of the certainty that all but a twentieth of the labelled
# texts reach, and if it has so many words; a few words prove nothing.  On a
# scale from guessing (0) to knowing (1), clean and mixed texts of 50 words lie
# above 0.75 (short ones with a line in another language at 0.5), random letters
# at 0.6, hex codes at 0.45 and strings of digits below 0.3.
LEAST_CERTAINTY = 0.4
LEAST_WORDS = 50

PREDICTED = (
    "doc_id bigint, held_out boolean, lang_pred string, score double, certainty double, n_switches bigint, "
    "n_words bigint"
)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # feature rows by languages
    lexicon: np.ndarray  # sorted hashes of the words that have a feature of their own
    transitions: np.ndarray  # from, to
    initial: np.ndarray
    grams: int = GRAM_ROWS  # rows of the weights that are hashed n-grams; the others are words
    floor: float = 0.0  # the certainty that a text in a learned language has at least


def table_rows(languages: int) -> tuple[int, int]:
    """Rows of n-grams and of words in the weight table, which is at most 48 MB whatever the languages."""
    share = max(1, languages) / FULL_LANGUAGES
    return tuple(rows if share <= 1 else max(1, int(rows / share)) for rows in (GRAM_ROWS, LEXICON_ROWS))


def word_hasher() -> w.Hasher:
    return w.Hasher(6, lower=True)


def word_features(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, lexicon: np.ndarray, grams: int, words: int
):
    """Feature rows of some words, and how many each word has."""
    sizes = (ends - starts) + 2
    at = np.concatenate([[0], np.cumsum(sizes)])
    index = np.arange(at[-1]) - np.repeat(at[:-1], sizes) + np.repeat(starts - 1, sizes)
    letters = w.LOWER[data[np.clip(index, 0, max(len(data) - 1, 0))]].astype(np.uint64) + np.uint64(2)
    letters[at[:-1]] = 0
    letters[at[1:] - 1] = 1
    word = np.repeat(np.arange(len(starts)), sizes)
    rows, owners = [], []
    gram = np.zeros(len(letters), np.uint64)
    for n in range(1, MAX_GRAM + 1):
        gram = gram[: len(letters) - n + 1] * np.uint64(260) + letters[n - 1 :]
        inside = word[: len(gram)] == word[n - 1 :]
        if n == 1:
            inside = letters > 1
        kept = gram[inside]
        rows.append((w.mix(kept + np.uint64(n << 40)) % np.uint64(grams)).astype(np.int64))
        owners.append(word[: len(gram)][inside])
    counts = sum(np.bincount(owner, minlength=len(starts)) for owner in owners)
    place = np.searchsorted(lexicon, hashes)
    known = np.zeros(len(hashes), bool)
    if len(lexicon):
        known = lexicon[np.minimum(place, len(lexicon) - 1)] == hashes
    lexical = np.where(known, grams + (hashes % np.uint64(words)).astype(np.int64), -1)
    return np.concatenate(rows), np.concatenate(owners), np.maximum(counts, 1), lexical


def emissions(features, weights: np.ndarray, n: int) -> np.ndarray:
    """Scores of each language for each word."""
    rows, owners, counts, lexical = features
    out = np.empty((n, weights.shape[1]))
    for k in range(weights.shape[1]):
        out[:, k] = np.bincount(owners, weights[rows, k], minlength=n) / np.sqrt(counts)
    known = lexical >= 0
    out[known] += weights[lexical[known]]
    return out


def forward_backward(scores: np.ndarray, mask: np.ndarray, transitions: np.ndarray, initial: np.ndarray):
    """Probabilities of labels, and the alphas, betas and scales that gave them.

    scores: chains by places by languages; mask: which places of a chain exist.
    """
    chains, places, k = scores.shape
    local = np.exp(scores - scores.max(axis=2, keepdims=True))
    step = np.exp(transitions - transitions.max())
    alphas = np.empty_like(local)
    alpha = local[:, 0] * np.exp(initial - initial.max())
    alphas[:, 0] = alpha / alpha.sum(axis=1, keepdims=True)
    for t in range(1, places):
        alpha = (alphas[:, t - 1] @ step) * local[:, t]
        alphas[:, t] = alpha / alpha.sum(axis=1, keepdims=True)
    betas = np.empty_like(local)
    beta = np.full((chains, k), 1.0 / k)
    betas[:, -1] = beta
    for t in range(places - 2, -1, -1):
        beta = (betas[:, t + 1] * local[:, t + 1]) @ step.T
        beta /= beta.sum(axis=1, keepdims=True)
        betas[:, t] = np.where(mask[:, t + 1, None], beta, 1.0 / k)
    marginals = alphas * betas
    marginals /= marginals.sum(axis=2, keepdims=True)
    return marginals, alphas, betas, local, step


def _train(texts: list[tuple[bytes, int]], languages: list[str], epochs: int, seed: int) -> Model:
    """Learns from (text, language) pairs, on chains made of spans of several texts."""
    k = len(languages)
    data = np.frombuffer(b" ".join(text for text, _ in texts) + b" ", np.uint8)
    sizes = np.array([len(text) + 1 for text, _ in texts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    starts, ends, first = w.find_words(data, offsets)
    hashes = word_hasher().spans(data, starts, ends)
    labels = np.repeat([label for _, label in texts], np.diff(first))
    unique, firsts, word_of, counts = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    lexicon = unique[counts >= 20]
    grams, lexicon_rows = table_rows(k)
    features = word_features(data, starts[firsts], ends[firsts], unique, lexicon, grams, lexicon_rows)
    rows, owners, sizes, lexical = features

    generator = np.random.default_rng(seed)
    weights = np.zeros((grams + lexicon_rows, k))
    transitions, initial = np.eye(k), np.zeros(k)
    squares, transition_squares, initial_squares = np.full_like(weights, 1e-8), np.full((k, k), 1e-8), np.full(k, 1e-8)
    order = np.argsort(owners, kind="stable")
    rows, owners = rows[order], owners[order]
    begin = np.searchsorted(owners, np.arange(len(unique) + 1))
    # Spans of 4 to 40 words; chained in random order they switch language.
    places = np.arange(len(labels))
    for _ in range(epochs):
        cuts = np.sort(np.concatenate([first[:-1], generator.choice(places, max(1, len(places) // 20), replace=False)]))
        cuts = np.unique(np.concatenate([cuts, [0, len(places)]]))
        spans = [places[a:b] for a, b in zip(cuts[:-1], cuts[1:]) if b > a]
        generator.shuffle(spans)
        mixed = np.concatenate(spans)
        mixed = mixed[: len(mixed) // CHAIN * CHAIN].reshape(-1, CHAIN) if len(mixed) >= CHAIN else mixed.reshape(1, -1)
        for at in range(0, len(mixed), 64):
            batch = mixed[at : at + 64]
            local_words, inverse = np.unique(word_of[batch], return_inverse=True)
            inverse = inverse.reshape(batch.shape)
            picked = np.concatenate([np.arange(begin[i], begin[i + 1]) for i in local_words])
            own = np.repeat(np.arange(len(local_words)), begin[local_words + 1] - begin[local_words])
            part = (rows[picked], own, sizes[local_words], lexical[local_words])
            scores = emissions(part, weights, len(local_words))[inverse]
            mask = np.ones(batch.shape, bool)
            marginals, alphas, betas, local, step = forward_backward(scores, mask, transitions, initial)
            gold = np.eye(k)[labels[batch]]
            error = (gold - marginals) / batch.size
            pair = np.einsum("nti,ij,ntj->ntij", alphas[:, :-1], step, betas[:, 1:] * local[:, 1:])
            pair /= np.maximum(pair.sum(axis=(2, 3), keepdims=True), 1e-300)
            seen = np.einsum("nti,ntj->ij", gold[:, :-1], gold[:, 1:])
            transition_step = (seen - pair.sum(axis=(0, 1))) / batch.size
            initial_step = error[:, 0].sum(axis=0)
            word_error = np.zeros((len(local_words), k))
            np.add.at(word_error, inverse.ravel(), error.reshape(-1, k))
            touched, slot = np.unique(part[0], return_inverse=True)
            change = np.stack(
                [
                    np.bincount(slot, (word_error[:, c] / np.sqrt(part[2]))[own], minlength=len(touched))
                    for c in range(k)
                ],
                axis=1,
            )
            known = part[3] >= 0
            for where, value in ((touched, change), (part[3][known], word_error[known])):
                np.add.at(squares, where, value**2)
                np.add.at(weights, where, 0.2 * value / np.sqrt(squares[where]))
            transition_squares += transition_step**2
            transitions = transitions + 0.2 * transition_step / np.sqrt(transition_squares)
            initial_squares += initial_step**2
            initial = initial + 0.2 * initial_step / np.sqrt(initial_squares)
    return Model(languages, weights.astype(np.float32), lexicon, transitions, initial, grams)


def _quotas(counts: dict[str, int], most: int) -> dict[str, int]:
    """How many rows of each language to draw: all of small ones, even shares of the rest.

    About most rows together, but LEAST_OF_LANGUAGE of every language that has them.
    """
    quotas, left = {}, most
    for i, (lang, n) in enumerate(sorted(counts.items(), key=lambda one: (one[1], one[0]))):
        quotas[lang] = min(n, max(LEAST_OF_LANGUAGE, left // (len(counts) - i)))
        left = max(0, left - quotas[lang])
    return quotas


def _drawn_spans(max_chars: int) -> Column:
    """The text, or of a longer one spans drawn evenly over all of it, max_chars characters together.

    Each of its equal parts gives one span at a place drawn by a hash; words cut
    by the ends of a span are left out of it unless it has no blank.
    """
    spans = max(1, max_chars // SPAN_CHARS)
    size = max_chars // spans
    text = F.regexp_replace("text", BLANK_RUN, " ")
    part = F.floor(F.length(text) / spans)

    def span(i: Column) -> Column:
        begin = i * part + F.pmod(F.xxhash64("doc_id", i), F.greatest(part - size + 1, F.lit(1)))
        piece = F.substring(text, (begin + 1).cast("int"), F.lit(size))
        inner = F.regexp_replace(piece, "^[^ ]* | [^ ]*$", "")
        return F.when(F.length(F.btrim(inner)) > 0, inner).otherwise(piece)

    pieces = F.transform(F.sequence(F.lit(0), F.lit(spans - 1)), span)
    return F.when(F.length("text") <= max_chars, F.col("text")).otherwise(F.array_join(pieces, " "))


def fit(docs: DataFrame, max_documents: int = 1500, max_chars: int = 5000, epochs: int = 3, seed: int = 0) -> Model:
    """Learns from a bounded sample of documents with a language and a word.

    About max_documents, shared out evenly over the languages and drawn by a
    hash of doc_id, whatever their length.  Of a text longer than max_chars,
    spans drawn over all of it are used.
    """
    known = docs.filter(F.col("lang").isNotNull() & ~_held_out() & F.col("text").rlike(f"[^{BLANK_RUN[1:-2]}]"))
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Model([], np.zeros((GRAM_ROWS + LEXICON_ROWS, 0), np.float32), np.empty(0, np.uint64), np.zeros((0, 0)), np.zeros(0))
    languages = sorted(counts)
    quotas = _quotas(counts, max_documents)
    # About twice as many rows as are drawn lie below the bound of their language and are sorted.
    bounds = {
        lang: (1 << KEY_BITS) if counts[lang] <= 2 * quotas[lang] else (1 << KEY_BITS) * 2 * quotas[lang] // counts[lang]
        for lang in languages
    }
    limits = docs.sparkSession.createDataFrame(
        [(lang, quotas[lang], bounds[lang]) for lang in languages], "lang string, quota bigint, bound bigint"
    )
    few = known.select("doc_id", "lang", "text", hash_key(F.lit("lang"), F.col("doc_id")).alias("draw"))
    few = few.join(F.broadcast(limits), "lang").filter("draw < bound")
    few = few.select("lang", "quota", "draw", "doc_id", _drawn_spans(max_chars).alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id", "text"))
    drawn_rows = few.withColumn("place", place).filter("place <= quota").select("lang", "text").collect()
    numbers = {lang: i for i, lang in enumerate(languages)}
    texts = [(text.encode(), numbers[lang]) for lang, text in sorted((r.lang, r.text) for r in drawn_rows)]
    if len(languages) == 1:
        return Model(languages, np.zeros((GRAM_ROWS + LEXICON_ROWS, 1), np.float32), np.empty(0, np.uint64), np.zeros((1, 1)), np.zeros(1))
    model = _train(texts, languages, epochs, seed)
    return replace(model, floor=_floor(model, [text for text, _ in texts]))


def _floor(model: Model, texts: list[bytes]) -> float:
    """The least certainty asked for, from that of the texts learned from.

    Where labels contradict one another nothing is certain, and nothing is asked for.
    """
    found = []
    for chunk in w.chunks(pa.array([text.decode() for text in texts])):
        hashes = word_hasher().spans(chunk.data, chunk.starts, chunk.ends)
        sure = certainty(chunk, word_probabilities(chunk, hashes, model))
        found.append(sure[chunk.counts >= LEAST_WORDS])
    known = np.concatenate(found) if found else np.empty(0)
    return LEAST_CERTAINTY * float(np.quantile(known, 0.05)) if len(known) else 0.0


def _held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))


def word_probabilities(chunk: w.Chunk, hashes: np.ndarray, model: Model) -> np.ndarray:
    """Probability of each language for every word, by forward-backward."""
    k, n = len(model.languages), len(hashes)
    if n == 0 or k == 0:
        return np.zeros((n, max(k, 1)))
    unique, firsts, word_of = np.unique(hashes, return_index=True, return_inverse=True)
    order = np.argsort(firsts)
    scores = np.empty((len(unique), k))
    for at in range(0, len(order), 1 << 15):
        part = order[at : at + (1 << 15)]
        own = word_features(
            chunk.data, chunk.starts[firsts[part]], chunk.ends[firsts[part]], unique[part], model.lexicon,
            model.grams, len(model.weights) - model.grams,
        )
        scores[part] = emissions(own, model.weights, len(part))
    counts = chunk.counts
    inside = np.arange(n) - np.repeat(chunk.first[:-1], counts)
    per_doc = -(-counts // CHAIN)
    chain = np.repeat(np.concatenate([[0], np.cumsum(per_doc)])[:-1], counts) + inside // CHAIN
    place = inside % CHAIN
    probability = np.empty((n, k))
    # Chains of one batch are padded to the length of its longest.
    lengths = np.bincount(chain)
    begin = np.concatenate([[0], np.cumsum(lengths)])
    for at in range(0, len(lengths), 2048):
        to = min(at + 2048, len(lengths))
        span = slice(begin[at], begin[to])
        mask = np.zeros((to - at, lengths[at:to].max()), bool)
        mask[chain[span] - at, place[span]] = True
        padded = np.zeros((*mask.shape, k))
        padded[mask] = scores[word_of[span]]
        marginals = forward_backward(padded, mask, model.transitions, model.initial)[0]
        probability[span] = marginals[mask]
    return probability


def _means(chunk: w.Chunk, values: np.ndarray) -> np.ndarray:
    return w.per_text(chunk, values) / np.maximum(chunk.counts, 1)


def text_probabilities(chunk: w.Chunk, hashes: np.ndarray, model: Model) -> np.ndarray:
    """Mean probability of each language over the words of each text."""
    probability = word_probabilities(chunk, hashes, model)
    return np.stack([_means(chunk, column) for column in probability.T], axis=1)


def certainty(chunk: w.Chunk, probability: np.ndarray) -> np.ndarray:
    """How far the labels of the words of each text are from guessing: 0 to 1.

    A text in several languages is as certain as one in a single language.
    """
    guess = 1 / probability.shape[1]
    if guess == 1:
        return np.ones(chunk.texts)
    return np.maximum(_means(chunk, probability.max(axis=1)) - guess, 0) / (1 - guess)


def _changes(chunk: w.Chunk, labels: np.ndarray) -> np.ndarray:
    """Whether a word is labelled otherwise than the one before it in its text."""
    changed = np.zeros(len(labels), bool)
    changed[1:] = labels[1:] != labels[:-1]
    changed[chunk.first[:-1][chunk.counts > 0]] = False
    return changed


def _predict(shared):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, hasher = Model(**shared.value), word_hasher()
        names = np.array([*model.languages, UNDETERMINED], object)
        for batch in batches:
            best, score, sure, switches, counts = [], [], [], [], []
            for chunk in w.chunks(batch.column("text")):
                hashes = hasher.spans(chunk.data, chunk.starts, chunk.ends)
                words = word_probabilities(chunk, hashes, model)
                found = np.stack([_means(chunk, column) for column in words.T], axis=1)
                sure.append(certainty(chunk, words))
                counts.append(chunk.counts)
                switches.append(w.per_text(chunk, _changes(chunk, words.argmax(axis=1))))
                best.append(found.argmax(axis=1) if len(model.languages) else np.full(chunk.texts, -1))
                score.append(found.max(axis=1))
            lettered = np.asarray(batch.column("lettered").to_pylist(), bool)
            which = np.concatenate(best) if best else np.empty(0, int)
            value = np.concatenate(score) if score else np.empty(0)
            which = np.where(lettered, which, -1)
            value = np.clip(np.where(which < 0, 0.0, value), 0.0, 1.0)
            sure = np.where(which < 0, 0.0, np.concatenate(sure)) if sure else np.empty(0)
            switches = np.where(which < 0, 0, np.concatenate(switches)) if switches else np.empty(0, int)
            counts = np.concatenate(counts) if counts else np.empty(0)
            numbers = (value, sure, switches.astype(np.int64), counts.astype(np.int64))
            columns = [pa.array(names[which], pa.string()), *map(pa.array, numbers)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), *columns],
                names=["doc_id", "held_out", "lang_pred", "score", "certainty", "n_switches", "n_words"],
            )

    return predict


SPANS = "array<struct<lang:string,start:bigint,length:bigint>>"


def language_spans(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id and the stretches of words that have the same likeliest language, as (lang, start, length).

    A text without words, or a model without languages, has no spans.  Every
    row counts on its own; columns other than doc_id, text and, for learning,
    lang are not read.
    """
    model = model or fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    kind = pa.struct([("lang", pa.string()), ("start", pa.int64()), ("length", pa.int64())])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, hasher = Model(**shared.value), word_hasher()
        names = np.array(own.languages, object)
        for batch in batches:
            for chunk in w.chunks(batch.column("text")):
                hashes = hasher.spans(chunk.data, chunk.starts, chunk.ends)
                labels = word_probabilities(chunk, hashes, own).argmax(axis=1)
                begins = _changes(chunk, labels)
                begins[chunk.first[:-1][chunk.counts > 0]] = True
                at = np.flatnonzero(begins) if len(names) else np.empty(0, int)
                text = chunk.doc_of_word()[at]
                lengths = np.diff(np.append(at, len(labels))) if len(at) else at
                fields = [pa.array(names[labels[at]], pa.string()), pa.array(at - chunk.first[text]), pa.array(lengths)]
                values = pa.StructArray.from_arrays(fields, fields=list(kind))
                offsets = np.searchsorted(text, np.arange(chunk.texts + 1)).astype(np.int32)
                ids = batch.column("doc_id").slice(chunk.row, chunk.texts)
                spans = pa.ListArray.from_arrays(pa.array(offsets), values)
                yield pa.RecordBatch.from_arrays([ids, spans], names=["doc_id", "spans"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(label, f"doc_id bigint, spans {SPANS}")


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, certainty, n_switches and n_words.

    The certainty is how far the labels of the words are from guessing, and
    n_switches says how often the language changes from a word to the next.
    A text that is null or has no letter is "und" with score 0; a text without
    words has no letter either.  Rows without doc_id are held out.  Texts with
    equal words get equal results, ties go to the language first in the
    alphabet, and without a single learned language all is "und".  Columns
    other than doc_id, text and, for learning, lang are not read.
    """
    model = model or fit(docs)
    # Of bounded size, see table_rows().
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    rows = docs.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        _held_out().alias("held_out"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
    )
    return rows.mapInArrow(_predict(shared), PREDICTED)


def keep_identified(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents whose language could be told, with the columns they came with.

    Decided where the text is read; a document goes if identify() calls it
    "und", or if LEAST_WORDS words or more are labelled with less certainty than
    the model's floor, so that they are hardly words of any language that was
    learned.  A text in several languages is as certain as another.  Where no
    language could be learned, all documents with a letter stay.
    """
    model = model or fit(docs)
    if not model.languages:
        return docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    predict, floor = _predict(shared), model.floor
    lettered = fresh_name(docs, "lettered")
    names = docs.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = batch.column(lettered)
            own = pa.RecordBatch.from_arrays(
                [pa.nulls(len(batch), pa.int64()), batch.column("text").fill_null(""), flags, flags],
                names=["doc_id", "text", "held_out", "lettered"],
            )
            found = next(predict(iter([own])))
            told = found.column("lang_pred").to_numpy(zero_copy_only=False) != UNDETERMINED
            sure = found.column("certainty").to_numpy() >= floor
            few = found.column("n_words").to_numpy() < LEAST_WORDS
            yield batch.filter(pa.array(told & (sure | few))).select(names)

    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.withColumn(lettered, has_letter).mapInArrow(keep, docs.schema)
