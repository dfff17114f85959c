"""Exact and near copies, and repeated passages, against brute force."""

import hashlib
import math
import random
from collections import defaultdict

import pytest

import brute
from callmeter.llm import exact, neardup, sharding, superkmer
from callmeter.llm.common import without_rows
from callmeter.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]


def test_exact_copies_of_odd_rows(spark):
    out = exact.deduplicate(brute.frame(spark, brute.ODD_ROWS)).collect()
    groups = defaultdict(list)
    for doc_id, text in brute.ODD_ROWS:
        groups[hashlib.sha256((text or "").encode()).hexdigest()].append(doc_id)
    assert sorted(str(r.doc_id) for r in out) == sorted(str(i) for i, _ in brute.ODD_ROWS)
    for row in out:
        ids = groups[row.text_sha256]
        assert row.group_size == len(ids)
        assert row.keep_id == max((i for i in ids if i is not None), default=None)
        assert not row.kept or row.doc_id == row.keep_id
    kept = [r.text_sha256 for r in out if r.kept]
    assert sorted(kept) == sorted(groups)


def test_exact_repeated_rows_leave_one(spark):
    rows = [(5, "same")] * 50 + [(None, "none")] * 3
    out = exact.deduplicate(brute.frame(spark, rows)).collect()
    assert len(out) == 53 and sorted(r.doc_id or 0 for r in out if r.kept) == [0, 5]


def test_index_takes_a_later_load_for_copies_and_survives_a_second_run(spark, tmp_path):
    path = str(tmp_path / "index")
    first = exact.DigestIndex(spark, "index_before", 4, path)
    old = exact.hashed_rows(exact.in_files(brute.frame(spark, [(1, "a"), (2, "b")])))
    first.add(exact.summary(old), "one")
    # Another session opens the same files.
    again = exact.DigestIndex(spark, "index_after", 4, path)
    new = exact.hashed_rows(exact.in_files(brute.frame(spark, [(9, "b"), (3, "c")])))
    for _ in range(2):
        again.add(exact.summary(new), "two")
    assert again.rows().count() == 3
    found = {r.doc_id: (r.keep_id, r.kept) for r in exact.verdicts(new, exact.summary(new), again, "two").collect()}
    assert found == {9: (2, False), 3: (3, True)}


def test_a_load_that_is_split_in_another_way_finds_its_own_entries(spark, tmp_path):
    docs = [(i % 900, f"text {i % 700} " * 30, None, None) for i in range(3000)]
    brute.frame(spark, docs).repartition(7).write.parquet(str(tmp_path / "docs"))
    index = exact.DigestIndex(spark, "index_split", 4, str(tmp_path / "index"))
    found, before = [], spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "2k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            hashed = exact.hashed_rows(spark.read.parquet(str(tmp_path / "docs")))
            digests = exact.summary(hashed)
            index.add(digests, "one")
            found.append(brute.ordered(exact.verdicts(hashed, digests, index, "one").collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found[0] == found[1] and sum("kept=True" in row for row in found[0]) == 700
    index.forget()


def test_merged_index_has_one_sorted_file_a_bucket(spark, tmp_path):
    index = exact.DigestIndex(spark, "index_loads", 4, str(tmp_path / "index"))
    for load in range(3):
        rows = brute.frame(spark, [(i, f"text {i}") for i in range(100 * load, 100 * load + 150)])
        index.add(exact.summary(exact.hashed_rows(exact.in_files(rows))), f"load {load}")
    merged = index.merged("index_merged", str(tmp_path / "merged"))
    assert brute.ordered(merged.rows().collect()) == brute.ordered(index.rows().collect())
    assert merged.rows().count() == 350 and len(merged.rows().inputFiles()) == 4
    for table in (index, merged):
        table.forget()
    exact.deduplicate(brute.frame(spark, [(1, "a")])).collect()
    assert not [t.name for t in spark.catalog.listTables() if "index" in t.name and not t.isTemporary and t.name.startswith("digest_index")]


@pytest.mark.parametrize("stored", [False, True])
def test_a_column_named_like_the_file_metadata_does_no_harm(spark, tmp_path, stored):
    rows = [(i, text) for i, (_, text) in enumerate(brute.ODD_ROWS[:16])]
    docs = brute.frame(spark, rows).withColumnRenamed("row", "_metadata")
    if stored:
        docs.write.parquet(str(tmp_path / "docs"))
        docs = spark.read.parquet(str(tmp_path / "docs"))
    assert exact.deduplicate(docs).count() == len(rows)
    assert neardup.near_duplicates(docs).count() == len(rows)
    assert superkmer.remove_repeats(docs).count() == len(rows)
    assert sharding.shard_documents(docs, 1000).count() == len(rows)
    in_files = exact.in_files(docs)
    kept = without_rows(in_files, exact.deduplicate(in_files).filter("not kept"))
    assert kept.columns == docs.columns and kept.count() == len({text or "" for _, text in rows})


@pytest.mark.parametrize("n", [2, 5])
def test_near_copies_of_odd_rows(spark, n):
    out = neardup.near_duplicates(brute.frame(spark, brute.ODD_ROWS), neardup.Likeness(words=n)).collect()
    want = [(i, *rest) for (i, _), rest in zip(brute.ODD_ROWS, brute.near_duplicates(brute.ODD_ROWS, n))]
    assert brute.ordered((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute.ordered(want)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_near_copies_query(spark, docs):
    out = QUERIES["op2_minhash_near_dedup"](spark, SF_DIR).collect()
    want = [(i, *rest) for (i, _), rest in zip(docs, brute.near_duplicates(docs, 2))]
    assert brute.ordered((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute.ordered(want)


def test_long_lists_and_many_blocks_give_the_same_components(spark, docs, monkeypatch):
    monkeypatch.setattr(neardup, "LIST_PAIRS", 1)
    monkeypatch.setattr(neardup, "BLOCK_NODES", 4)
    rows = docs + brute.ODD_ROWS[-40:]
    out = neardup.near_duplicates(brute.frame(spark, rows)).collect()
    want = [(i, *rest) for (i, _), rest in zip(rows, brute.near_duplicates(rows, 5))]
    assert brute.ordered((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute.ordered(want)


@pytest.mark.parametrize("others", [0, 25])
def test_copies_of_a_large_group_cost_one_comparison_each(spark, monkeypatch, others):
    """Variants of one template are linked to the first; only what is not is compared with the group."""
    monkeypatch.setattr(neardup, "BLOCK_NODES", 50)
    monkeypatch.setattr(neardup, "STAR_NODES", 16)
    draw, found = random.Random(9), []
    linked = neardup._linked
    monkeypatch.setattr(neardup, "_linked", lambda *args: found.append((args[-1], args[2])) or linked(*args))
    template = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(260):
        own = list(template)
        own[draw.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(own)))
    for i in range(others):  # like one another and some variants, but not like the template
        own = template[: 95 + i // 5] + [f"z{i // 5}y{j}" for j in range(12)]
        rows.append((1000 + i, " ".join(own + [f"e{i}"])))
    out = neardup.near_duplicates(brute.frame(spark, rows)).collect()
    want = [(i, *rest) for (i, _), rest in zip(rows, brute.near_duplicates(rows, 5))]
    assert brute.ordered((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute.ordered(want)
    stars = [dealt for compare, dealt in found if compare is neardup.star_links]
    sent = sum(len(row.units) for dealt in stars for row in dealt.collect())
    assert stars and sent <= (260 + others) * (1 + 2 / 16) + 2


def test_comparisons_of_sets_agree():
    import numpy as np

    draw = random.Random(3)
    sets = [np.array(sorted(draw.sample(range(60), draw.randint(20, 50)))) for _ in range(60)]
    rows = np.arange(100, 160)
    alike = {(i, j) for i in range(60) for j in range(i) if 100 * len(set(sets[i]) & set(sets[j])) >= 60 * len(set(sets[i]) | set(sets[j]))}
    known = rows == 107
    star = neardup.star_links(rows, sets, 60, known)
    assert {b - 100 for _, b in star} == {i for i in range(60) if (max(i, 7), min(i, 7)) in alike}

    def classes(links):
        parent = list(range(60))
        for a, b in links:
            old, new = parent[a], parent[b]
            parent = [new if p == old else p for p in parent]
        return {frozenset(i for i in range(60) if parent[i] == p) for p in parent}

    linked = np.isin(rows, [107, *(b for _, b in star)])
    more = neardup.link_nodes(rows, sets, 60, linked)
    assert classes([(a - 100, b - 100) for a, b in star + more]) == classes(alike)


def test_texts_that_others_extend_are_linked(spark):
    """Sets of 65 to 150 shingles, one inside the other, similar by 0.80 to 0.84."""
    generator, rows = random.Random(7), []
    for pair in range(400):
        size = generator.randint(82, 150)
        part = math.ceil(size * generator.uniform(0.80, 0.83))
        words = [f"w{pair}x{generator.randrange(1 << 40)}" for _ in range(size + 4)]
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join(words[: part + 4]))]
    out = neardup.near_duplicates(brute.frame(spark, rows)).collect()
    want = [(i, *rest) for (i, _), rest in zip(rows, brute.near_duplicates(rows, 5))]
    assert all(component == i - i % 2 for i, _, component in want)
    assert brute.ordered((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute.ordered(want)


def test_one_row_of_a_component_stays(spark):
    rows = [(4, brute.PASSAGE)] * 5 + [(4, brute.PASSAGE + " z"), (2, None), (2, None), (None, brute.PASSAGE)]
    out = neardup.near_duplicates(brute.frame(spark, rows)).collect()
    assert sum(r.stays for r in out) == 3 and sum(r.stays for r in out if r.n_shingles) == 1


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(500, 501)], "low bigint, high bigint")
    found = dict(neardup.components(edges).select("node", "component").collect())
    assert found == {**dict.fromkeys(range(301), 0), 500: 500, 501: 500}


@pytest.mark.parametrize("often", [16, 1])
def test_passages_of_odd_rows(spark, monkeypatch, often):
    monkeypatch.setattr(superkmer, "OFTEN", often)
    out = superkmer.remove_repeats(brute.frame(spark, brute.ODD_ROWS)).collect()
    want = [(i, *rest) for (i, _), rest in zip(brute.ODD_ROWS, brute.without_repeats(brute.ODD_ROWS))]
    assert brute.ordered((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out) == brute.ordered(want)


def test_passages_query(spark, docs):
    out = QUERIES["op10_super_kmers"](spark, SF_DIR).collect()
    want = [(i, *rest) for (i, _), rest in zip(docs, brute.without_repeats(docs))]
    assert brute.ordered((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out) == brute.ordered(want)


def test_a_run_that_many_texts_share_is_no_minimiser(spark, monkeypatch):
    """A third of the texts hold the same three words, of the least hash there is, in different surroundings."""
    import numpy as np
    import pyarrow as pa

    from callmeter.llm import words as w

    draw, hasher = random.Random(5), w.Hasher(10)

    def runs(text):
        chunk = next(w.chunks(pa.array([text])))
        return superkmer.run_order(hasher.spans(chunk.data, chunk.starts, chunk.ends), np.empty(0, np.uint64))

    shared = min((f"s{i} t{i} u{i}" for i in range(3000)), key=lambda text: runs(text)[0])
    rows = []
    for i in range(240):
        found = [f"w{draw.randrange(3000)}" for _ in range(90)]
        for place in range(10, 90, 15) if i % 3 == 0 else []:
            found[place] = shared
        rows.append((i, " ".join(found)))
    rows += [(1000 + i, rows[3 * i][1]) for i in range(10)]

    def strings_of_shared(frequent):
        (chunk,) = w.chunks(pa.array([text for _, text in rows]))
        hashes = hasher.spans(chunk.data, chunk.starts, chunk.ends)
        least = superkmer.super_kmers(hashes, chunk.doc_of_word(), frequent)[2]
        return int((least << np.uint64(1) == runs(shared)[0] << np.uint64(1)).sum())

    assert strings_of_shared(np.empty(0, np.uint64)) > 400
    monkeypatch.setattr(superkmer, "FREQUENT_LEAST", 100)
    frequent = superkmer.frequent_runs(brute.frame(spark, rows))
    assert frequent.tolist() == [runs(shared)[0]]
    assert strings_of_shared(frequent) == 0
    out = superkmer.remove_repeats(brute.frame(spark, rows)).collect()
    want = [(i, *rest) for (i, _), rest in zip(rows, brute.without_repeats(rows))]
    assert brute.ordered((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out) == brute.ordered(want)


@pytest.mark.parametrize("least", [1, 3])
def test_any_order_of_runs_finds_all_passages(spark, docs, monkeypatch, least):
    monkeypatch.setattr(superkmer, "FREQUENT_LEAST", least)
    monkeypatch.setattr(superkmer, "COUNTED_LEAST", 1)
    monkeypatch.setattr(superkmer, "COUNTED_AT_ONCE", 1000)
    rows = docs[:60] + brute.ODD_ROWS
    out = superkmer.remove_repeats(brute.frame(spark, rows)).collect()
    want = [(i, *rest) for (i, _), rest in zip(rows, brute.without_repeats(rows))]
    assert brute.ordered((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out) == brute.ordered(want)


def test_a_super_kmer_goes_to_one_bucket_and_covers_every_window():
    import numpy as np

    hashes = np.random.default_rng(0).integers(0, 1 << 62, 5000).astype(np.uint64)
    docs = np.repeat([0, 1, 2, 3], [12, 13, 975, 4000])
    first, windows, _ = superkmer.super_kmers(hashes, docs)
    covered = [i for a, n in zip(first, windows) for i in range(a, a + n)]
    assert covered == [i for i in range(5000 - 12) if docs[i] == docs[i + 12]]
    assert (docs[first] == docs[first + windows + 11]).all()
