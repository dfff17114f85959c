"""Quality rules as a learned decision list.

Counts of every text are made in one pass and stored.  From those of labelled
documents a list of rules is learned by sequential covering: a rule is grown
as a conjunction of thresholds on two thirds of the rows, cut back on the last
third, and what it covers is taken out before the next one.  The list becomes
one Spark conditional expression, so that rules apply where the counts lie.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmeter.llm import words as w
from callmeter.llm.common import drawn, hash_key
from callmeter.sources.stored import stored

WINDOW = 8
SYMBOLS = b"#*$%&|<>"

COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_digits", "n_marks", "n_distinct_words",
]
COUNTED = "doc_id bigint, " + ", ".join(f"{name} bigint" for name in COUNTS)


def _flags(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Where the keys that occur twice or more are."""
    order = np.argsort(keys)
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    found = np.zeros(len(keys), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    return found


def _repeat_words(chunk: w.Chunk, hashes: np.ndarray) -> np.ndarray:
    windows = w.runs_hash(hashes, WINDOW)
    if not len(windows):
        return np.zeros(chunk.texts, np.int64)
    docs = chunk.doc_of_word()
    inside = np.flatnonzero(docs[: len(windows)] == docs[WINDOW - 1 :])
    keys = w.mix(windows[inside] + docs[inside].astype(np.uint64) * np.uint64(w.ODD))
    at = inside[_repeats(keys)]
    change = np.zeros(len(hashes) + WINDOW, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + WINDOW, -1)
    return w.per_text(chunk, np.cumsum(change)[: len(hashes)] > 0)


def _lines(chunk: w.Chunk, hasher: w.Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: lines with a word, and those of them equal to an earlier one."""
    breaks = np.flatnonzero(chunk.data == 10)
    starts = np.sort(np.concatenate([chunk.offsets[:-1], breaks + 1]), kind="stable")
    docs = np.searchsorted(chunk.offsets, starts, "right") - 1
    # A break that ends a text begins no line of the next.
    ends = np.sort(np.concatenate([breaks, chunk.offsets[1:]]), kind="stable")
    full = np.searchsorted(chunk.starts, ends) > np.searchsorted(chunk.starts, starts)
    starts, ends = starts[full], ends[full]
    docs = np.searchsorted(chunk.offsets, starts, "right") - 1
    keys = w.mix(hasher.spans(chunk.data, starts, ends) + docs.astype(np.uint64) * np.uint64(w.ODD))
    _, firsts = np.unique(keys, return_index=True)
    lines = np.bincount(docs, minlength=chunk.texts)
    return lines, lines - np.bincount(docs[firsts], minlength=chunk.texts)


def _distinct(chunk: w.Chunk, hashes: np.ndarray) -> np.ndarray:
    docs = chunk.doc_of_word()
    _, firsts = np.unique(w.mix(hashes + docs.astype(np.uint64) * np.uint64(w.ODD)), return_index=True)
    return np.bincount(docs[firsts], minlength=chunk.texts)


def _count_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = w.Hasher(4)
    symbol, digit = _flags(SYMBOLS), _flags(b"0123456789")
    mark, upper = _flags(b"!?.,;:'\"()[]{}/\\-_+=~^`@"), _flags(bytes(range(65, 91)))
    for batch in batches:
        parts = {name: [] for name in COUNTS}
        for chunk in w.chunks(batch.column("text")):
            data = chunk.data
            hashes = hasher.spans(data, chunk.starts, chunk.ends)
            lines, dup_lines = _lines(chunk, hasher)
            wide = np.zeros(len(data), bool)
            if len(data):
                wide[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
            counts = {
                "n_words": chunk.counts,
                "word_chars": w.per_text_bytes(chunk, ~w.BLANK[data] & ((data & 0xC0) != 0x80)),
                "n_symbols": w.per_text_bytes(chunk, symbol[data]),
                "n_dup_lines": dup_lines,
                "n_repeat_words": _repeat_words(chunk, hashes),
                "n_lines": lines,
                "n_upper": w.per_text_bytes(chunk, upper[data] | wide),
                "n_digits": w.per_text_bytes(chunk, digit[data]),
                "n_marks": w.per_text_bytes(chunk, mark[data]),
                "n_distinct_words": _distinct(chunk, hashes),
            }
            for name, values in counts.items():
                parts[name].append(values.astype(np.int64))
        columns = [np.concatenate(parts[name]) if parts[name] else np.empty(0, np.int64) for name in COUNTS]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *map(pa.array, columns)], names=["doc_id", *COUNTS]
        )


def text_counts(docs: DataFrame) -> DataFrame:
    """The counts of every document, stored.  A null text has no words."""
    return stored(docs.select("doc_id", "text").mapInArrow(_count_texts, COUNTED), "counts")


def _per(count: str, of: str) -> Column:
    return F.col(count) / F.greatest(F.col(of), F.lit(1))


def measures() -> dict[str, Column]:
    """What rules may look at."""
    return {
        "n_words": F.col("n_words").cast("double"),
        "word_length": _per("word_chars", "n_words"),
        "symbol_share": _per("n_symbols", "word_chars"),
        "upper_share": _per("n_upper", "word_chars"),
        "digit_share": _per("n_digits", "word_chars"),
        "mark_share": _per("n_marks", "word_chars"),
        "dup_line_share": _per("n_dup_lines", "n_lines"),
        "repeat_share": _per("n_repeat_words", "n_words"),
        "distinct_share": _per("n_distinct_words", "n_words"),
        "line_words": _per("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    threshold: float

    def holds(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        values = rows[self.measure]
        return values >= self.threshold if self.above else values <= self.threshold

    def column(self) -> Column:
        value = measures()[self.measure]
        return value >= F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)


Rule = tuple[Condition, ...]


def _covered(rule: Rule, rows: dict[str, np.ndarray], n: int) -> np.ndarray:
    found = np.ones(n, bool)
    for condition in rule:
        found &= condition.holds(rows)
    return found


def _candidates(values: np.ndarray) -> np.ndarray:
    """Thresholds halfway between neighbouring quantiles."""
    marks = np.unique(np.quantile(values, np.linspace(0, 1, 65)))
    return (marks[1:] + marks[:-1]) / 2


def _grow(rows: dict[str, np.ndarray], bad: np.ndarray, max_conditions: int) -> Rule:
    """Adds the condition with the best information gain while good rows are covered."""
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < max_conditions:
        p, n = bad[inside].sum(), (~bad[inside]).sum()
        if p == 0 or n == 0:
            break
        best, gain = None, 0.0
        for name, values in rows.items():
            ranked = np.sort(values[inside & bad])
            others = np.sort(values[inside & ~bad])
            for mark in _candidates(values[inside & bad]) if len(ranked) > 1 else []:
                for above in (True, False):
                    side = "left" if above else "right"
                    p1, n1 = np.searchsorted(ranked, mark, side), np.searchsorted(others, mark, side)
                    if above:
                        p1, n1 = len(ranked) - p1, len(others) - n1
                    if p1 and (found := p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p / (p + n)))) > gain:
                        best, gain = Condition(name, above, float(mark)), found
            # The extreme of the good rows separates best where both overlap little.
            for above, mark in ((True, np.nextafter(others[-1], np.inf)), (False, np.nextafter(others[0], -np.inf))):
                side = "left" if above else "right"
                p1 = np.searchsorted(ranked, mark, side)
                p1 = len(ranked) - p1 if above else p1
                if p1 and (found := -p1 * math.log2(p / (p + n))) > gain:
                    best, gain = Condition(name, above, float(mark)), found
        if best is None:
            break
        rule += (best,)
        inside &= best.holds(rows)
    return rule


def _prune(rule: Rule, rows: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The beginning of a rule that separates unseen rows best."""
    best, worth = rule, -np.inf
    for size in range(len(rule), 0, -1):
        found = _covered(rule[:size], rows, len(bad))
        p, n = (found & bad).sum(), (found & ~bad).sum()
        value = (p - n) / (p + n) if p + n else -1.0
        if value >= worth:
            best, worth = rule[:size], value
    return best


def learn_rules(
    rows: dict[str, np.ndarray],
    bad: np.ndarray,
    max_rules: int = 16,
    max_conditions: int = 4,
    min_precision: float = 0.9,
    min_covered: int = 3,
) -> list[Rule]:
    """Rules for bad rows, in the order in which they were found."""
    rules: list[Rule] = []
    part = np.arange(len(bad)) % 3
    left = np.ones(len(bad), bool)
    tried = np.zeros(len(bad), bool)  # covered by rules that were not good enough
    while len(rules) < max_rules:
        grow, prune = left & ~tried & (part > 0), left & (part == 0)
        if (bad & grow).sum() < min_covered:
            break
        grown = _grow({k: v[grow] for k, v in rows.items()}, bad[grow], max_conditions)
        if not grown:
            break
        for rule in (_prune(grown, {k: v[prune] for k, v in rows.items()}, bad[prune]), grown):
            found = _covered(rule, rows, len(bad)) & left
            right, unseen = (found & bad).sum(), found & prune
            if (
                right >= max(min_covered, min_precision * found.sum())
                and (unseen & bad).sum() >= min_precision * unseen.sum()
            ):
                rules.append(rule)
                left &= ~found
                break
        else:
            tried |= _covered(grown, rows, len(bad)) & bad
    return rules


def rule_columns(rules: list[Rule]) -> list[Column]:
    conditions = []
    for rule in rules:
        condition = rule[0].column()
        for other in rule[1:]:
            condition = condition & other.column()
        conditions.append(condition)
    return conditions


def first_rule(rules: list[Rule]) -> Column:
    """Number, from 1, of the first rule that holds; 0 where none does."""
    verdict = None
    for number, condition in enumerate(rule_columns(rules), 1):
        verdict = F.when(condition, number) if verdict is None else verdict.when(condition, number)
    return F.lit(0) if verdict is None else verdict.otherwise(0)


def fit(counts: DataFrame, labels: DataFrame, max_labelled: int = 20_000) -> list[Rule]:
    """Learns from max_labelled rows, drawn evenly by a hash of doc_id."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    key = hash_key(F.lit("quality"), F.col("doc_id"))
    sample = (
        counts.join(drawn(known, key, max_labelled, known.count()), "doc_id")
        .select("doc_id", "quality", *[column.alias(name) for name, column in measures().items()])
        .limit(2 * max_labelled)
        .toPandas()
        .sort_values(["doc_id", "n_words"], kind="stable")
    )
    # Thirds are dealt by the order of the rows, so it must not follow doc_id.
    sample = sample.sample(frac=1.0, random_state=0)
    rows = {name: sample[name].to_numpy(float) for name in measures()}
    return learn_rules(rows, sample["quality"].to_numpy() == 0)


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: counts, base_failed, rule (0: none) and kept.

    A document fails the base rules with fewer than 20 words or with over 30
    of 100 words in repeated windows; then, or if a learned rule holds, it is
    not kept.  A null text has no words and fails.  Rows without doc_id are
    judged and not learned from, of several labels of one doc_id the worst
    counts, and without labels no rule is learned.  Repeated rows are judged
    alike, an empty table gives no rows, other columns are not read.
    """
    counts = text_counts(docs)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    judged = counts.withColumns({"base_failed": failed, "rule": first_rule(fit(counts, labels))})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
