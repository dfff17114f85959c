"""License scans."""

import random
import re
from re import _constants, _parser

import pytest

import brute
from callmeter.llm import licenses
from callmeter.llm.license_rules import KINDS, LONGEST, SIGNATURES, Signature
from callmeter.llm.queries import licenses_sql
from compare import difference

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {code: code + 32 for code in range(65, 91)}


def sample(tree, draw):
    """A text that an expression matches."""
    out = ""
    for kind, value in tree:
        if kind is _constants.LITERAL:
            out += chr(value)
        elif kind is _constants.IN:
            out += "x" if value[0][0] is _constants.CATEGORY else chr(draw.choice(value)[1])
        elif kind is _constants.SUBPATTERN:
            out += sample(value[3], draw)
        elif kind is _constants.BRANCH:
            out += sample(draw.choice(value[1]), draw)
        else:
            least, most, part = value
            assert kind is _constants.MAX_REPEAT
            times = draw.randint(least, 1 if most is _constants.MAXREPEAT else most)
            out += "".join(sample(part, draw) for _ in range(times))
    return out


def longest(tree):
    """Spaces of the longest match."""
    most = 0
    for kind, value in tree:
        if kind is _constants.LITERAL:
            most += value == 32
        elif kind is _constants.SUBPATTERN:
            most += longest(value[3])
        elif kind is _constants.BRANCH:
            most += max(longest(part) for part in value[1])
        elif kind is _constants.MAX_REPEAT:
            inside = longest(value[2])
            most += inside * value[1] if inside else 0
    return most


def brute_scan(text, rules=SIGNATURES):
    """n_words, places, and detections of a text that is one piece."""
    found = WORD.findall((text or "").translate(UPPER))
    places = []
    for phrase, label in licenses.PHRASES:
        parts = phrase.split()
        places += [(label, i) for i in range(len(found)) if found[i : i + len(parts)] == parts]
    line = " " + "  ".join(found) + " "
    every = []
    for order, rule in enumerate(rules):
        for match in re.finditer(rule.pattern, line):
            start, end = line[: match.start()].count(" ") // 2, line[: match.end()].count(" ") // 2
            every.append((start, end, rule.priority, order, rule.label, rule.kind, rule.score))
    rank = lambda d: (d[2], d[1] - d[0], -d[3])
    left = [d for d in every if not any(e[0] <= d[0] and e[1] >= d[1] and rank(e) > rank(d) for e in every)]
    labels = sorted({label for label, _ in places} | {d[4] for d in left})
    score = max([0.5 if places else 0.0, *[d[6] for d in left]])
    return len(found), sorted(places), sorted(left), labels, score


def as_rows(out):
    return brute.ordered(
        (r.doc_id, r.n_words, sorted(map(tuple, r.places)), sorted(map(tuple, r.detections)), list(r.labels), r.score)
        for r in out
    )


def check(spark, rows):
    out = licenses.scan_licenses(brute.frame(spark, rows)).collect()
    assert as_rows(out) == brute.ordered((doc_id, *brute_scan(text)) for doc_id, text in rows)


def test_rules_are_hundreds_and_well_formed():
    assert len(SIGNATURES) > 200 and len({(s.kind, s.regex) for s in SIGNATURES}) == len(SIGNATURES)
    for rule in SIGNATURES:
        assert rule.kind in KINDS and "," not in rule.label
        assert re.fullmatch(r"[a-z0-9 ()|?{},\[\]\\S+]+", rule.regex) and " ?" not in rule.regex
        assert longest(_parser.parse(rule.regex)) + 1 <= LONGEST


def test_every_match_contains_a_keyword():
    draw = random.Random(4)
    for rule in SIGNATURES:
        for _ in range(60):
            assert set(rule.keywords) & set(sample(_parser.parse(rule.regex), draw).split()), rule


def test_samples_of_all_rules_are_detected(spark):
    draw = random.Random(11)
    rows = []
    for i, rule in enumerate(SIGNATURES):
        texts = [sample(_parser.parse(rule.regex), draw).replace(" ", draw.choice([" ", "-", ".\n", " * "])) for _ in range(2)]
        rows.append((i, "Some words, " + texts[0].title() + "; and more. " + texts[1].upper()))
    check(spark, rows)


def test_scan_of_odd_rows(spark):
    texts = [
        "The MIT License", "mit  LICENSE mit-license", "summit license", "émit license", "MITK license",
        "GNU Lesser General Public License, version 2.1", "Apache License", "apache license.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file",
        "SPDX-License-Identifier: GPL-2.0-or-later", "// SPDX-License-Identifier: MIT OR Apache-2.0",
        "general public license general public license", "İmit license", "license", "©2020 mit license",
    ]
    rows = [row for row in brute.ODD_ROWS if len(row[1] or "") < 5000]
    check(spark, rows + [(500 + i, text) for i, text in enumerate(texts)] + [(500, texts[0]), (None, texts[0])])
    assert licenses.scan_licenses(brute.frame(spark, [])).collect() == []


def test_containment_and_priority(spark):
    rows = [(1, "under the terms of the GNU Lesser General Public License version 2.1")]
    (row,) = licenses.scan_licenses(brute.frame(spark, rows)).collect()
    assert [d.label for d in row.detections] == ["lgpl-2.1"]
    assert list(row.labels) == ["gpl", "lgpl-2.1"]  # the phrase stays
    rules = [Signature("a", "name", "x", "x y z"), Signature("b", "tag", "y", "y"), Signature("c", "name", "z", "y z")]
    (row,) = licenses.scan_licenses(brute.frame(spark, [(1, "x y z")]), rules).collect()
    # c lies in a; a contains b, but b ranks higher.
    assert sorted(d.label for d in row.detections) == ["a", "b"]


@pytest.mark.parametrize("shift", [0, 3, 7])
def test_detections_across_pieces(spark, shift):
    """Long texts give what their parts give, wherever a piece is cut."""
    part = "x Licensed under the Apache License, Version 2.0; GNU Lesser General Public License (LGPL) word "
    text = "pad " * shift + part * 400
    (row,) = licenses.scan_licenses(brute.frame(spark, [(1, text)])).collect()
    n_words, places, left, labels, score = brute_scan(text)
    assert (row.n_words, list(row.labels), row.score) == (n_words, labels, score)
    assert sorted(map(tuple, row.places)) == places and sorted(map(tuple, row.detections)) == left


def test_sql_cuts_the_same_pieces(spark):
    """The query against its SQL where texts have many pieces and many detections."""
    import duckdb

    draw = random.Random(2)
    rows = []
    for i in range(12):
        bits = [sample(_parser.parse(draw.choice(SIGNATURES).regex), draw) for _ in range(150)]
        rows.append((i, " filler ".join(bits)))
    docs = brute.frame(spark, rows).select("doc_id", "text")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    found = licenses.scan_licenses(docs).selectExpr(
        "doc_id", "n_words", "CAST(size(places) AS BIGINT) AS n_base",
        "CAST(array_min(places.start) AS BIGINT) AS first_word", "CAST(array_max(places.start) AS BIGINT) AS last_word",
        "array_join(sort_array(array_distinct(places.label)), ',') AS base_labels",
        "array_join(labels, ',') AS labels", "score",
    )
    assert difference(found, con, licenses_sql(SIGNATURES)) is None
