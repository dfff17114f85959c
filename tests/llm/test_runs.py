"""Periodic runs and whitening."""

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest

import brute
from callmeter.llm import periodic, whitening
from callmeter.llm.queries import QUERIES
from callmeter.llm.words import chunks

SF_DIR = "/root/testdata/sf0.001"


def made_up_texts(seed, n):
    """Word lists over few words, most with a repeated part."""
    draw = random.Random(seed)
    for _ in range(n):
        few, size = draw.choice([1, 2, 3, 5, 30]), draw.choice([0, 1, 5, 6, 8, 30, 120, 300])
        found = [f"w{draw.randrange(few)}" for _ in range(size)]
        for _ in range(draw.randrange(3) if size else 0):
            a = draw.randrange(size)
            p = draw.randrange(1, max(2, (size - a) // 3))
            for i in range(a, min(size, a + p * draw.randrange(3, 9) + draw.randrange(p + 1))):
                found[i] = found[a + (i - a) % p]
        yield found


@pytest.mark.parametrize("rule", [periodic.RunRule(), periodic.RunRule(4, 2), periodic.RunRule(9, 3)])
def test_runs_are_those_of_the_definition(rule):
    texts = list(made_up_texts(rule.min_words, 1500))
    array = pa.array([" \n".join(found) for found in texts])
    seen = 0
    for chunk in chunks(array, 20_000):
        runs, dropped = periodic.find_runs(chunk, rule)
        kept = periodic.joined_words(chunk, ~dropped).to_pylist()
        for i in range(chunk.texts):
            found = texts[chunk.row + i]
            want = brute.runs_of(found, rule.min_words, rule.min_repeats)
            assert [tuple(row[1:]) for row in runs[runs[:, 0] == i].tolist()] == want
            assert kept[i] == brute.without_runs(found, want)
            seen += len(want)
    assert seen > 500


def test_splitting_goes_on_until_it_is_stable():
    # Without the rare x, the second round finds each b too rare, the third each a.
    found = "a a b a x b a b b x a b a a a a a a a a".split()
    numbers = np.unique(found, return_inverse=True)[1]
    at, segment = periodic.split_segments(numbers, np.zeros(len(found), np.int64), periodic.RunRule())
    assert at.tolist() == list(range(12, 20)) and len(set(segment.tolist())) == 1


def check_runs(rows, out):
    want = []
    for doc_id, text in rows:
        found = brute.words(text)
        runs = brute.runs_of(found)
        want.append((doc_id, len(found), runs, brute.without_runs(found, runs)))
    mine = [(r.doc_id, r.n_words, [tuple(run) for run in r.runs], r.collapsed) for r in out]
    assert brute.ordered(mine) == brute.ordered(want)


def test_runs_of_odd_rows(spark):
    long = ("la " * 5000 + "di ") * 4 + " ".join(f"w{i}" for i in range(20_000))
    rows = [row for row in brute.ODD_ROWS if len(row[1] or "") < 20_000]
    rows += [(200, "a b " * 4), (200, "a b " * 4), (201, "a " * 6 + "b"), (202, "é É " * 9), (None, "x " * 7), (203, "x\x1cx " * 6)]
    check_runs(rows, periodic.periodic_runs(brute.frame(spark, rows)).collect())
    (row,) = periodic.periodic_runs(brute.frame(spark, [(1, long)])).collect()
    # Each of the four parts is a run of one word; the four together one of 5,001.
    assert [tuple(run) for run in row.runs] == [(0, 5000, 1), (0, 20004, 5001), (5001, 5000, 1), (10002, 5000, 1), (15003, 5000, 1)]
    assert periodic.periodic_runs(brute.frame(spark, [])).collect() == []


def test_long_text_of_one_word(spark):
    (row,) = periodic.periodic_runs(brute.frame(spark, [(1, "again " * 200_000)])).collect()
    assert [tuple(run) for run in row.runs] == [(0, 200_000, 1)] and row.collapsed == "again"


def test_runs_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    out = {row.doc_id: row for row in QUERIES["op13_periodic_runs"](spark, SF_DIR).collect()}
    assert len(out) == len(docs)
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    found_any = 0
    for doc in docs:
        found = brute.planted(doc.doc_id, brute.words(doc.text))
        if len(found) > 3000:
            continue
        runs = brute.runs_of(found)
        best = min(runs, key=lambda run: (-run[1] / run[2], run[0], run[2]), default=(None,) * 3)
        row = out[doc.doc_id]
        assert row.n_runs == len(runs) and (row.start, row.length, row.period) == best
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert row.runs_sha256 == digest("".join(f"{s},{length},{p}\n" for s, length, p in runs))
        assert row.collapsed_sha256 == digest(brute.without_runs(found, runs))
        found_any += bool(runs)
    assert found_any > 5


VECTORS = "vec_id long, embedding array<double>, component string, entries string, vector string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x", "x") for i, v in rows], VECTORS)


def exact_whitening(rows, most=8):
    """n, deviations by row, eigenvalues and components from the whole covariance."""
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows], np.int64)
    n, sums = len(x), x.sum(axis=0)
    away = n * x - sums
    e, v = np.linalg.eigh((away / n).T @ (away / n) / n)
    return n, np.square(away).sum(axis=1), e[::-1], v[:, ::-1], away / n


def check_whitening(rows, out, most=8, tolerance=1e-9):
    n, deviation, e, v, centred = exact_whitening(rows)
    count = min(most, int((e > 1e-9 * e[0]).sum()))
    assert len(out) == len(rows) * count
    assert {row.n for row in out} == {n} and all(row.identity_error < 1e-9 for row in out)
    want = np.abs(centred @ v[:, :count] / np.sqrt(e[:count]))
    mine = {(row.vec_id, row.component): row for row in out}
    for place, (vec_id, _) in enumerate(rows):
        for j in range(count):
            row = mine[vec_id, j + 1]
            assert row.deviation == deviation[place]
            assert abs(row.whitened) == pytest.approx(want[place, j], abs=tolerance)
            assert row.explained == pytest.approx(e[j] / e.sum(), rel=1e-9)


def test_whitening_query_against_eigenvectors(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    rows = [(r.vec_id, r.embedding) for r in table if r.embedding and all(c is not None and math.isfinite(c) for c in r.embedding)]
    check_whitening(rows, QUERIES["op11_lanczos_whitening"](spark, SF_DIR).collect())


def test_whitening_of_odd_rows(spark):
    draw = np.random.default_rng(3)
    good = [(i, (draw.standard_normal(5) * [9, 4, 2, 1, 0.5]).tolist()) for i in range(60)]
    good += [(100 + i, [1.0, 2.0, 3.0, 4.0, 5.0]) for i in range(30)]
    bad = [(200, None), (201, [1.0, None, 2.0, 3.0, 4.0]), (202, [math.nan] * 5), (203, [math.inf, 1.0, 1.0, 1.0, 1.0])]
    bad += [(204, []), (205, [1.0, 2.0]), (206, [1e300] * 5)]
    check_whitening(good, whitening.whitened_components(vectors(spark, good + bad)).collect())


def test_whitening_of_flat_repeated_and_no_rows(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [0.25, 0.5]) for i in range(9)]):
        assert whitening.whitened_components(vectors(spark, rows)).collect() == []
    # Two of four dimensions say nothing: the rest are two components.
    flat = [(i, [float(i), 7.0, float(i % 3), float(i)]) for i in range(40)]
    check_whitening(flat, whitening.whitened_components(vectors(spark, flat)).collect())
    nameless = whitening.whitened_components(vectors(spark, [(None, [1.0]), (None, [2.0]), (None, [2.0])])).collect()
    assert len(nameless) == 3 and sorted(abs(r.whitened) for r in nameless)[:2] == pytest.approx([0.5**0.5] * 2)


def test_components_of_equal_deviation_are_all_found():
    """A start vector alone spans one direction of an eigenspace; new ones bring the others."""
    draw = np.random.default_rng(1)
    q = np.linalg.qr(draw.standard_normal((50, 12)))[0]
    w = np.linalg.qr(draw.standard_normal((12, 12)))[0]
    sigma = np.array([5.0] * 4 + [3.0] * 3 + [1.0] * 2 + [0.0] * 3)
    x = q * sigma @ w.T
    v, b, steps = whitening.bidiagonalise(lambda e, p: ((x @ p) @ (x @ p), (x @ e.T).T @ (x @ p), x.T @ (x @ p)), 12)
    assert np.allclose(np.linalg.svd(b)[1][: len(sigma)], sigma[: len(b)], atol=1e-12)
    assert np.allclose(v @ v.T, np.eye(len(v)), atol=1e-12) and steps <= 12


def test_sums_of_large_entries_stay_exact(spark):
    rows = [(i, [2.0**39, float(i)]) for i in range(5)]
    (first, *_) = whitening.whitened_components(vectors(spark, rows)).orderBy("vec_id").collect()
    assert first.deviation == exact_whitening(rows)[1][0]
