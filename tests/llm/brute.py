"""Plain versions of the corpus operators, and small tables with odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")

# More columns than the operators read, with names that they use inside.
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("row", T.StringType()),
        T.StructField("file_key", T.StringType()),
        T.StructField("file_row", T.StringType()),
        T.StructField("shard", T.StringType()),
        T.StructField("draw", T.StringType()),
        T.StructField("block", T.StringType()),
        T.StructField("lettered", T.StringType()),
    ]
)


def frame(spark, rows):
    """A table of (doc_id, text) or (doc_id, text, lang, source) rows."""
    full = []
    for row in rows:
        doc_id, text, lang, source = (*row, None, None)[:4]
        extra = ("x",) * (len(SCHEMA) - 5)
        full.append((doc_id, text, lang, source, None if text is None else len(text), *extra))
    return spark.createDataFrame(full, SCHEMA)


PASSAGE = " ".join(f"shared{i}" for i in range(60))
LONG = " ".join(f"w{i * i % 977}" for i in range(30_000))

# Null, empty and long texts, ties, copies and odd white space.
ODD_ROWS = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\f\r "),
    (4, "one"),
    (5, "One"),
    (6, "two words"),
    (7, "two\nwords"),
    (8, "a\x1cb\xa0c é ÉÉ 日本語  x"),
    (9, LONG),
    (10, LONG),
    (11, LONG + " tail"),
    (12, f"begin a b c {PASSAGE} d e f"),
    (13, f"other words first {PASSAGE} and last"),
    (14, PASSAGE),
    (15, PASSAGE + " " + PASSAGE),
    (16, "x" * 5000),
    (None, "two words"),
    (None, PASSAGE),
    (None, None),
    (-7, "two words"),
] + [(100 + i, f"copy {PASSAGE} number{i % 3}") for i in range(40)]


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def shingle_set(text, n):
    found = lowered(text)
    if len(found) < n:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(tuple(found[i : i + n]) for i in range(len(found) - n + 1))


def near_duplicates(rows, n, percent=80):
    """Size of the set and least doc_id of the component, for each row in order."""
    sets = [shingle_set(text, n) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for i, one in enumerate(sets):
        for value in one:
            holders.setdefault(value, []).append(i)
    for i, one in enumerate(sets):
        common = Counter()
        for value in one:
            common.update(holders[value])
        for j, both in common.items():
            if 100 * both >= percent * (len(one) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        ids = [v for v in (least.get(find(i)), doc_id) if v is not None]
        least[find(i)] = min(ids) if ids else None
    return [(len(one), least[find(i)]) for i, one in enumerate(sets)]


def without_repeats(rows, n=13):
    """Words, removed words and digest of the rest, for each row in order."""
    rank = lambda doc_id: -math.inf if doc_id is None else doc_id
    first = {}
    for doc_id, text in rows:
        found = words(text)
        for i in range(len(found) - n + 1):
            key = tuple(found[i : i + n])
            first[key] = min(first.get(key, math.inf), rank(doc_id))
    out = []
    for doc_id, text in rows:
        found, gone = words(text), set()
        for i in range(len(found) - n + 1):
            if first[tuple(found[i : i + n])] < rank(doc_id):
                gone.update(range(i, i + n))
        kept = " ".join(word for i, word in enumerate(found) if i not in gone)
        out.append((len(found), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def text_counts(text):
    """Words, their characters, symbols, repeated lines and words in repeated windows."""
    text = text or ""
    found = words(text)
    windows = Counter(tuple(found[i : i + 8]) for i in range(len(found) - 7))
    covered = set()
    for i in range(len(found) - 7):
        if windows[tuple(found[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), repeated, len(covered)


def ordered(rows):
    return sorted(map(repr, rows))


def planted(doc_id, found):
    """The words of a document of which a tenth repeat a part of themselves."""
    if doc_id is None or not found:
        return found
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return found
    g, n = h // 10, len(found)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [word if i < a else found[a + (i - a) % p] for i, word in enumerate(found)]


def runs_of(found, min_words=6, min_repeats=4):
    """Maximal runs (start, length, smallest period), from the definition."""
    out, n = [], len(found)
    for q in range(1, n // min_repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and found[j] == found[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_words, min_repeats * q):
                part = found[i : i + length]
                if next(p for p in range(1, q + 1) if part[p:] == part[:-p]) == q:
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda run: (run[0], run[2]))


def without_runs(found, runs):
    gone = set()
    for start, length, period in runs:
        gone.update(range(start + period, start + length))
    return " ".join(word for i, word in enumerate(found) if i not in gone)
