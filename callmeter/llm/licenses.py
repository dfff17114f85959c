"""License scans by ordered signature rules.

The rules are regular expressions over the words of a text, see
license_rules.py.  A text is looked at only if a keyword is among its words, and
a rule is run only in pieces with one of its keywords.  A detection is dropped if another one of
higher priority contains its interval of words, or one of equal priority whose
interval is longer, or the same and whose rule comes first.  So what says
"GNU Lesser General Public License" is not also a title of the GPL.

Texts are scanned in pieces of some hundred words, each with as many words
around it as a rule can match, so the work grows with the length of a text and
no array with its square.  A detection belongs to the piece in which it begins.

Everything is a Spark expression over one row: no shuffle and no join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmeter.llm.common import text_of
from callmeter.llm.license_rules import LONGEST, SIGNATURES, Signature

# Between words, which are runs of letters, digits and everything beyond ASCII.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

PIECE_WORDS = 512

# Phrases looked for in every text, and the labels they give.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Score of a text with a phrase and no better detection.
PHRASE_SCORE = 0.5

PLACE = "struct<label:string,start:int>"
DETECTION = "struct<start:int,end:int,priority:int,order:int,label:string,kind:string,score:double>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda so_far, n: so_far + n)


def _words_in(text: Column) -> Column:
    """Number of words of a text in which each has a space before and one after it."""
    return F.shiftright(F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))), 1)


def _places(words: Column, phrase: str, label: str) -> Column:
    """Where the words of a phrase stand one after the other."""
    parts = phrase.split(" ")
    found = F.filter(
        F.sequence(F.lit(0), F.size(words) - 1),
        lambda i: reduce(lambda a, b: a & b, [F.get(words, i + j) == part for j, part in enumerate(parts)]),
    )
    return F.transform(found, lambda i: F.struct(F.lit(label).alias("label"), i.alias("start")))


def _rule_book(rules: Sequence[Signature]) -> Column:
    """The rules as one constant, grouped by their keywords; written in SQL, which is read at once."""
    by_keywords: dict[tuple[str, ...], list[str]] = {}
    for order, rule in enumerate(rules):
        fields = {
            "priority": str(rule.priority),
            "order": str(order),
            "label": f"r'{rule.label}'",
            "kind": f"r'{rule.kind}'",
            "score": f"{rule.score}D",
            "pattern": f"r'{rule.pattern}'",
        }
        row = ", ".join(f"'{name}', {value}" for name, value in fields.items())
        by_keywords.setdefault(rule.keywords, []).append(f"named_struct({row})")
    quoted = lambda words: ", ".join(f"r'{word}'" for word in words)
    groups = [
        f"named_struct('keywords', array({quoted(keywords)}), 'rules', array({', '.join(rows)}))"
        for keywords, rows in by_keywords.items()
    ]
    return F.expr(f"array({', '.join(groups)})")


def _matches(piece: Column, first: Column, rule: Column) -> Column:
    """Detections of one rule in a piece that begins with word number first."""

    def placed(gaps: Column, hits: Column) -> Column:
        def one(size: Column, i: Column) -> Column:
            start = first + _total(F.slice(gaps, 1, i + 1)) + _total(F.slice(hits, 1, i))
            return F.struct(
                start.alias("start"),
                (start + size).alias("end"),
                *[rule[name].alias(name) for name in ("priority", "order", "label", "kind", "score")],
            )

        return F.transform(hits, one)

    hits = F.transform(F.regexp_extract_all(piece, rule["pattern"], F.lit(0)), _words_in)
    gaps = F.transform(F.split(piece, rule["pattern"], -1), _words_in)
    return _let(hits, lambda hits: F.when(F.size(hits) > 0, _let(gaps, lambda gaps: placed(gaps, hits))).otherwise(_none()))


def _none() -> Column:
    return F.array().cast(f"array<{DETECTION}>")


def _suppresses(strong: Column, weak: Column) -> Column:
    """Whether one detection contains another of lower rank."""
    length = lambda d: d["end"] - d["start"]
    same_rank = (length(strong) > length(weak)) | (
        (length(strong) == length(weak)) & (strong["order"] < weak["order"])
    )
    return (
        (strong["start"] <= weak["start"])
        & (strong["end"] >= weak["end"])
        & ((strong["priority"] > weak["priority"]) | ((strong["priority"] == weak["priority"]) & same_rank))
    )


def _detections(words: Column, book: Column, keywords: Column) -> Column:
    """What is left of the detections of all rules in all pieces of a text."""

    def in_piece(low: Column) -> Column:
        first = F.greatest(low - LONGEST, F.lit(0))
        part = F.slice(words, first + 1, low - first + PIECE_WORDS + LONGEST)

        def found(part: Column) -> Column:
            piece = F.concat(F.lit(" "), F.array_join(part, "  "), F.lit(" "))
            met = lambda known: F.filter(book, lambda group: F.arrays_overlap(known, group["keywords"]))
            groups = _let(F.array_intersect(keywords, part), met)
            rules = F.flatten(F.transform(groups, lambda group: group["rules"]))
            return _let(
                piece, lambda piece: F.flatten(F.transform(rules, lambda rule: _matches(piece, first, rule)))
            )

        def left(all_found: Column) -> Column:
            return F.filter(
                all_found,
                lambda d: (d["start"] >= low)
                & (d["start"] < low + PIECE_WORDS)
                & ~F.exists(all_found, lambda other: _suppresses(other, d)),
            )

        return F.when(F.arrays_overlap(part, keywords), _let(_let(part, found), left)).otherwise(_none())

    pieces = F.sequence(F.lit(0), F.size(words) - 1, F.lit(PIECE_WORDS))
    return F.flatten(F.transform(pieces, in_piece))


def scan_licenses(
    docs: DataFrame,
    rules: Sequence[Signature] = SIGNATURES,
    phrases: Sequence[tuple[str, str]] = PHRASES,
) -> DataFrame:
    """doc_id, n_words, places, detections, labels and score of every document.

    ``places`` holds label and first word of every phrase found, ``detections``
    interval, label, kind and score of what the rules found and suppression
    left, ``labels`` the labels of both, sorted and without repeats.  ``score``
    is the best of them, 0 without any.  A null, empty or blank text has no
    words and none of these.  Every row counts on its own, null and repeated
    doc_ids included; columns beyond doc_id and text are not read.  An empty
    table gives no rows.
    """
    book = _rule_book(rules)
    known = dict.fromkeys([word for rule in rules for word in rule.keywords])
    known |= dict.fromkeys(phrase.split(" ")[-1] for phrase, _ in phrases)
    keywords = F.array(*map(F.lit, known))
    solid = lambda words: F.filter(words, lambda word: word != "")

    def scanned(words: Column) -> Column:
        places = F.flatten(F.array(*[_places(words, phrase, label) for phrase, label in phrases]))
        return F.struct(places.alias("places"), _detections(words, book, keywords).alias("detections"))

    def looked_at(words: Column) -> Column:
        # The words at either end are empty where the text begins or ends with a separator.
        n = F.size(words) - (F.get(words, F.lit(0)) == "").cast("int")
        n = n - ((F.size(words) > 1) & (F.element_at(words, -1) == "")).cast("int")
        return F.struct(n.cast("bigint").alias("n_words"), F.arrays_overlap(words, keywords).alias("suspect"))

    # Lower case of letters beyond ASCII makes no keyword and no separator of what was none.
    rows = docs.select("doc_id", text_of().alias("text"))
    looks = _let(F.split(F.lower("text"), SEPARATORS), looked_at)
    exact = F.split(F.translate("text", ascii_uppercase, ascii_lowercase), SEPARATORS)
    # As the output of a generator the first look is taken once per text.
    found = rows.select("doc_id", "text", F.inline(F.array(looks))).select(
        "doc_id", "n_words", F.when(F.col("suspect"), _let(solid(exact), scanned)).alias("found")
    )
    nothing = {"places": f"array<{PLACE}>", "detections": f"array<{DETECTION}>"}
    columns = [
        F.coalesce(F.col("found")[name].cast(kind), F.array().cast(kind)).alias(name) for name, kind in nothing.items()
    ]
    out = found.select("doc_id", "n_words", *columns)
    labels = F.concat(F.col("places.label"), F.col("detections.label"))
    by_phrase = F.when(F.size("places") > 0, F.lit(PHRASE_SCORE)).otherwise(F.lit(0.0))
    return out.select(
        "*",
        F.sort_array(F.array_distinct(labels)).alias("labels"),
        F.greatest(by_phrase, F.array_max("detections.score")).alias("score"),
    )
