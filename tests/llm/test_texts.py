"""Chat formatting, quality rules, language model and language identification."""

import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from callmeter.llm import chat, langid, lm, quality
from callmeter.llm import words as w
from callmeter.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab A\n\t\x1c\xa0éß日", max_size=12)), max_size=8))
@settings(max_examples=200, deadline=None)
def test_words_are_found_as_by_the_pattern(texts):
    found = []
    for chunk in w.chunks(pa.array(texts, pa.string()), limit=8):
        for i in range(chunk.texts):
            span = range(chunk.first[i], chunk.first[i + 1])
            found.append([chunk.bytes_of(chunk.starts[j], chunk.ends[j]).decode() for j in span])
    assert found == [brute.words(text) for text in texts]


def test_equal_words_have_equal_hashes_wherever_they_lie():
    text = "word Word x " + "y" * 70_000 + " word " + "z " * 50_000 + "word"
    chunk = next(w.chunks(pa.array([text])))
    hashes = w.Hasher(3, lower=True).spans(chunk.data, chunk.starts, chunk.ends)
    names = [chunk.bytes_of(a, b).lower() for a, b in zip(chunk.starts, chunk.ends)]
    assert len(set(zip(names, hashes.tolist()))) == len(set(names)) == len(set(hashes.tolist()))


CHATS = [
    (1, 0, "user", "hi"),
    (1, 1, "user", None),
    (1, 2, "assistant", "<|im_end|>\n<|im_start|>assistant\n"),
    (1, 3, "assistant", r"<\|im_sep|> <\\| <<|x| \ "),
    (1, 3, "assistant", "tie"),
    (2, 5, None, "no role"),
    (2, None, "a\n<|im_nl|>b", "first\n"),
    (3, 0, "assistant", ""),
    (None, 0, "assistant", "é日\n"),
    (4, 0, "user", "same"),
    (4, 0, "user", "same"),
]


def test_chats_read_back(spark):
    turns = spark.createDataFrame(CHATS, "conv_id bigint, turn bigint, role string, text string")
    turns = turns.withColumns({"turns": F.lit(1), "blocks": F.lit(2)})
    out = chat.format_chats(turns).select(
        "conv_id",
        "formatted",
        chat.read_turns(F.col("formatted")).alias("back"),
        chat.read_learned(F.col("formatted"), F.col("loss_spans")).alias("learned"),
    )
    want = {}
    for conv, turn, role, text in CHATS:
        want.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    rows = {r.conv_id: r for r in out.collect()}
    assert rows.keys() == want.keys()
    for conv, lines in want.items():
        lines.sort()
        assert [(t.role, t.text) for t in rows[conv].back] == [line[1:] for line in lines]
        assert rows[conv].learned == "".join(text for _, role, text in lines if role == "assistant")
    # Adjacent turns of one role are one block.
    assert rows[1].formatted.count(chat.START) == 2 and rows[4].formatted.count(chat.START) == 1


def test_no_chats(spark):
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.format_chats(empty).collect() == []


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
LINES = [(200, "a b\n\na b\r\na b\n a b\nc"), (201, "x y z # $ % & | < > *\n" * 30), (202, "\n\n\n"), (203, "é É\né É")]


def test_text_counts(spark):
    rows = brute.ODD_ROWS + LINES
    out = quality.text_counts(brute.frame(spark, rows)).collect()
    got = [(r.doc_id, *(r[name] for name in COUNTS)) for r in out]
    assert brute.ordered(got) == brute.ordered((i, *brute.text_counts(text)) for i, text in rows)


def test_quality_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for row in QUERIES["op4_quality_rules"](spark, SF_DIR).collect():
        want = brute.text_counts(docs[row.doc_id])
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert tuple(row[name] for name in COUNTS) == want and row.base_failed == failed
        assert row.kept == (not failed and row.rule == 0)


def test_rules_find_labelled_texts_and_spare_the_others(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").filter("quality IS NOT NULL")
    # Learned from every second label, judged on the others.
    judged = quality.score_quality(docs, labels.filter("doc_id % 2 = 0")).join(labels.filter("doc_id % 2 = 1"), "doc_id")
    rows = judged.filter("NOT base_failed").collect()
    good, bad = ([r for r in rows if r.quality == q] for q in (1, 0))
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(not r.kept for r in bad) >= 0.9 * len(bad)


def test_rules_without_labels_or_rows(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    out = quality.score_quality(brute.frame(spark, brute.ODD_ROWS), labels).collect()
    assert len(out) == len(brute.ODD_ROWS) and all(r.kept != r.base_failed for r in out)
    assert quality.score_quality(brute.frame(spark, []), labels).collect() == []


def test_learned_list_is_ordered_and_interpretable():
    generator = np.random.default_rng(1)
    rows = {"n_words": generator.uniform(0, 100, 3000), "digit_share": generator.uniform(0, 1, 3000)}
    bad = (rows["n_words"] < 20) | ((rows["digit_share"] > 0.8) & (rows["n_words"] < 60))
    rules = quality.learn_rules(rows, bad)
    found = np.zeros(3000, bool)
    for rule in rules:
        found |= quality._covered(rule, rows, 3000)
    assert (found & ~bad).mean() < 0.01 and (found & bad).sum() > 0.95 * bad.sum()


def brute_word(word, table, byte_p):
    marked = lm.WORD_MARK + word
    alpha = [1.0] + [0.0] * len(marked)
    for j in range(1, len(marked) + 1):
        for i in range(j):
            p = table.get(marked[i:j], 0.0)
            if j - i == 1 and i >= len(lm.WORD_MARK):
                p += byte_p[marked[i]]
            alpha[j] += alpha[i] * p
    return math.log(alpha[-1])


@pytest.fixture(scope="module")
def vocabulary():
    import sentencepiece

    pieces, log_p = lm.read_vocabulary(lm.VOCABULARY)
    model = sentencepiece.SentencePieceProcessor(model_file=lm.VOCABULARY)
    names = []
    for i in range(model.get_piece_size()):
        text = model.id_to_piece(i).encode()
        plain = not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        if plain and lm.WORD_MARK not in text[1:] and text == text.lower():
            names.append(text)
    table = {text: math.exp(log_p[i]) for i, text in enumerate(names)}
    return pieces, log_p, table, np.exp(log_p[pieces.n : pieces.n + 256])


def test_lattice_sums_all_segmentations(vocabulary):
    pieces, log_p, table, byte_p = vocabulary
    found = ["the", "thtion", "élle", "x", "日本語", "\x00", "a" * 200]
    got, _ = lm.word_lattices(pa.array(found), None, pieces, log_p, lm.lattice_hasher())
    assert got == pytest.approx([brute_word(word.encode(), table, byte_p) for word in found], rel=1e-9)


def test_long_words_can_be_one_piece(vocabulary):
    pieces, log_p, table, _ = vocabulary
    words = ["representation", "responsibility", "implementation"]
    got, _ = lm.word_lattices(pa.array(words), None, pieces, log_p, lm.lattice_hasher())
    whole = [table.get(lm.WORD_MARK + word.encode(), 0.0) for word in words]
    assert all(0 < p <= math.exp(log) * (1 + 1e-9) for p, log in zip(whole, got))


def test_long_words_are_gone_through_in_frames(vocabulary, monkeypatch):
    pieces, log_p, table, byte_p = vocabulary
    draw = np.random.default_rng(2)
    parts = ["tion", "re", "x", "é", "日", "the", "ing", "zz"]
    found = ["".join(draw.choice(parts, n)) for n in (1, 20, 25, 100, 300)]
    counts = np.arange(1.0, 6.0)
    want = lm.word_lattices(pa.array(found), counts, pieces, log_p, lm.lattice_hasher())
    assert want[0][:3] == pytest.approx([brute_word(word.encode(), table, byte_p) for word in found[:3]], rel=1e-9)
    for size in (1, 7, 64):
        monkeypatch.setattr(lm, "FRAME_BYTES", size)
        got = lm.word_lattices(pa.array(found), counts, pieces, log_p, lm.lattice_hasher())
        assert got[0] == pytest.approx(want[0], rel=1e-12) and got[1] == pytest.approx(want[1], rel=1e-9)


def test_time_grows_with_the_length_of_a_word(vocabulary):
    pieces, log_p, *_ = vocabulary
    took = []
    for n in (20_000, 200_000):
        start = time.process_time()
        got, uses = lm.word_lattices(pa.array(["ab" * (n // 2)]), np.ones(1), pieces, log_p, lm.lattice_hasher())
        took.append(time.process_time() - start)
        assert -math.inf < got[0] < 0 and uses.sum() > n / pieces.longest
    assert took[1] < 25 * took[0]


def test_expected_uses_are_the_derivative_of_the_likelihood(vocabulary):
    pieces, log_p, *_ = vocabulary
    found, counts = pa.array(["thing", "the"]), np.array([3.0, 2.0])
    _, uses = lm.word_lattices(found, counts, pieces, log_p, lm.lattice_hasher())
    for piece in np.argsort(-uses)[:5]:
        logs = []
        for step in (1e-5, -1e-5):
            moved = log_p.copy()
            moved[piece] += step
            logs.append(lm.word_lattices(found, None, pieces, moved, lm.lattice_hasher())[0] @ counts)
        assert (logs[0] - logs[1]) / 2e-5 == pytest.approx(uses[piece], rel=1e-4)


def check_scores(rows, out):
    counts, texts = Counter(), 0
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 10 == 0
    for i, text in rows:
        if not held(i):
            counts.update(brute.lowered(text))
            texts += 1
    total, distinct = sum(counts.values()) + texts, len(counts) + (texts > 0)
    log = lambda c: math.log10((c + 0.1) / (total + 0.1 * (distinct + 1)))
    want = []
    for i, text in rows:
        found = brute.lowered(text)
        base = sum(log(counts[word]) for word in found) + log(texts)
        known = sum(counts[word] > 0 for word in found) + (texts > 0)
        want.append((i, held(i), len(found) + 1, known, total, f"{base:.6f}"))
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, f"{r.base_score:.6f}") for r in out]
    assert brute.ordered(got) == brute.ordered(want)
    assert all(-math.inf < r.score < 0 for r in out)


def test_scores_of_odd_rows_with_few_frequent_words(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT_WORDS", 30)
    check_scores(brute.ODD_ROWS, lm.score_documents(brute.frame(spark, brute.ODD_ROWS), rounds=1).collect())


def test_scores_query_is_the_sum_over_words(spark, monkeypatch):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    out = QUERIES["op5_lattice_lm"](spark, SF_DIR).collect()
    check_scores(docs, out)
    # Learning makes held-out texts likelier than the weights it starts from.
    pieces, log_p = lm.read_vocabulary(lm.VOCABULARY)
    texts = dict(docs)
    for row in [r for r in out if r.held_out][:10]:
        start = lm.word_lattices(pa.array([b.decode() for b in brute.lowered(texts[row.doc_id])]), None, pieces, log_p, lm.lattice_hasher())[0]
        assert row.score > start.sum() / math.log(10)


def test_scores_without_rows_or_learned_texts(spark):
    assert lm.score_documents(brute.frame(spark, [])).collect() == []
    rows = [(None, "some words"), (None, None)]
    check_scores(rows, lm.score_documents(brute.frame(spark, rows)).collect())


def test_forward_backward_against_all_labellings():
    generator = np.random.default_rng(0)
    scores, transitions, initial = generator.normal(size=(1, 4, 3)), generator.normal(size=(3, 3)), generator.normal(size=3)
    want = np.zeros((4, 3))
    for code in range(3**4):
        path = [code // 3**t % 3 for t in range(4)]
        weight = math.exp(
            initial[path[0]]
            + sum(scores[0, t, path[t]] for t in range(4))
            + sum(transitions[path[t], path[t + 1]] for t in range(3))
        )
        for t in range(4):
            want[t, path[t]] += weight
    want /= want.sum(axis=1, keepdims=True)
    mask = np.array([[True] * 4 + [False] * 2])
    padded = np.concatenate([scores, np.zeros((1, 2, 3))], axis=1)
    got = langid.forward_backward(padded, mask, transitions, initial)[0][0, :4]
    assert got == pytest.approx(want)


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").collect()
    held = [r for r in rows if r.held_out and r.n_chars > 100]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_a_switch_of_language_inside_a_line(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    parts = {r.lang: r.text.split()[:40] for r in docs.filter("lang IN ('en', 'fr') AND n_chars > 800").orderBy("doc_id").limit(60).collect()}
    text = " ".join(parts["fr"] + parts["en"])
    chunk = next(w.chunks(pa.array([text])))
    hashes = langid.word_hasher().spans(chunk.data, chunk.starts, chunk.ends)
    found = dict(zip(model.languages, langid.text_probabilities(chunk, hashes, model)[0]))
    assert 0.35 < found["en"] < 0.65 and 0.35 < found["fr"] < 0.65


ODD_LANGUAGES = [(i, text, "en" if (i or 0) % 2 else "fr") for i, text in brute.ODD_ROWS] + [
    (900, "12 34 !!", "en"), (901, None, None), (902, "плюс", None)
]


def test_languages_of_odd_rows(spark):
    docs = brute.frame(spark, ODD_LANGUAGES)
    out = langid.identify(docs).collect()
    letters = {text: bool(text and re.search(r"[^\W\d_]", text)) for _, text, _ in ODD_LANGUAGES}
    want = [(i, letters[text]) for i, text, _ in ODD_LANGUAGES]
    assert brute.ordered((r.doc_id, r.lang_pred != "und") for r in out) == brute.ordered(want)
    assert all((r.score == 0) == (r.lang_pred == "und") for r in out)
    kept = langid.keep_identified(docs)
    assert kept.schema.names == docs.schema.names
    assert brute.ordered(r.doc_id for r in kept.collect()) == brute.ordered(i for i, ok in want if ok)


def test_spans_and_switches_of_code_switched_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    by_lang = {}
    for row in docs.filter("n_chars between 600 and 3000").orderBy("doc_id").collect():
        by_lang.setdefault(row.lang, row.text)
    parts = [" ".join(brute.words(by_lang[lang])[:60]) for lang in ("en", "de", "fr")]
    mixed = " ".join(parts)
    codes = "No. " + " ".join(str(zlib.crc32(str(i).encode())) for i in range(200))
    rows = [(1, mixed), (2, parts[0]), (3, None), (4, ""), (5, codes), (1, mixed), (6, "9f3a 77c0e")]
    frame = brute.frame(spark, rows)
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in langid.language_spans(frame, model).collect()}
    covered = Counter()
    for lang, start, length in spans[1]:
        covered.update({lang: length})
    assert sum(covered.values()) == 180 and spans[1][0][1] == 0
    assert all(covered[lang] > 40 for lang in ("en", "de", "fr"))
    assert all(a[1] + a[2] == b[1] and a[0] != b[0] for a, b in zip(spans[1], spans[1][1:]))
    assert spans[3] == spans[4] == []
    out = {r.doc_id: r for r in langid.identify(frame, model).collect()}
    assert out[1].n_switches == len(spans[1]) - 1 >= 2 and out[1].certainty > 0.7
    kept = [r.doc_id for r in langid.keep_identified(frame, model).collect()]
    # The mixed text stays and so do a few words; what are words of no language go.
    assert sorted(kept) == [1, 1, 2, 6] and out[5].certainty < model.floor < langid.LEAST_CERTAINTY


def test_the_table_of_weights_is_bounded():
    for k in (1, 4, 64):
        assert langid.table_rows(k) == (langid.GRAM_ROWS, langid.LEXICON_ROWS)
    for k in (65, 200, 1000, 100_000):
        assert sum(langid.table_rows(k)) * k * 4 <= 48 << 20


def test_languages_without_anything_to_learn(spark):
    assert langid.identify(brute.frame(spark, [])).collect() == []
    out = langid.identify(brute.frame(spark, [(1, "some words")])).collect()
    assert [(r.lang_pred, r.score) for r in out] == [("und", 0.0)]


def test_languages_whose_texts_are_all_long(spark):
    long = lambda i, words: " ".join(words[(i * 7 + j * j) % len(words)] for j in range(1500))
    english, german, welsh = "the house and water".split(), "das haus und wasser".split(), "mae llwyd ddwr yng".split()
    rows = [(i, " ".join(english) * 3, "en") for i in range(60)]
    rows += [(100 + i, long(i, german), "de") for i in range(60)] + [(200 + i, long(i, welsh), "cy") for i in range(60)]
    docs = brute.frame(spark, rows)
    model = langid.fit(docs)
    assert model.languages == ["cy", "de", "en"]
    found = {r.doc_id: r.lang_pred for r in langid.identify(docs, model).collect()}
    assert found == {i: lang for i, _, lang in rows}


def test_documents_stay_where_no_language_can_be_learned(spark):
    docs = brute.frame(spark, [(1, "some words"), (2, "12"), (3, None)])
    assert [r.doc_id for r in langid.keep_identified(docs).collect()] == [1]


def test_quotas_reach_every_language_and_the_promised_sum():
    assert langid._quotas({"en": 10**6, "de": 9000, "cy": 40}, 1500) == {"cy": 40, "de": 730, "en": 730}
    assert min(langid._quotas({f"l{i}": 100 for i in range(200)}, 1500).values()) == langid.LEAST_OF_LANGUAGE
