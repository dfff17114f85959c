"""Mixing sources to target weights by temperature.

A source with the share p of all tokens gets a weight in proportion to
p ** exponent.  The exponent is bisected between 0 (equal weights) and 1 (the
shares as they are) until the mixture has the target entropy, or until no
source would be repeated more than the limit allows.  The weights times a token
budget give every source a quota, and the quota is filled by permutations of
the source's blocks: whole passes first, then one that is cut where the quota
ends.

Nothing is summed over all documents of a source in one task: running sums are
taken over blocks, over the documents of the one block that is cut, and, where
many rows have the doc_id of the document that is cut, over ranges of them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callmeter.llm.common import KEY_BITS, PLACE, hash_key, in_files, n_words, placed, text_of
from callmeter.sources.stored import stored

# The exponent is found to one part in STEPS ** ROUNDS.
STEPS = 16
ROUNDS = 3

BLOCK_DOCS = 4096

# Rows of one doc_id are looked at in two to the power of this many ranges.
RANGE_BITS = 12


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, source, tokens and place of every document, stored.

    Tokens are words and one end, so no document is without.  The place tells
    rows apart that have no doc_id or the same; where a table is not in files
    it holds for this one reading.
    """
    tokens = (n_words(text_of()) + 1).alias("n_tokens")
    return stored(with_place(docs, "doc_id", "source", tokens), "tokens")


def with_place(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """Some columns of a table and ``place``, one number for the place of a row in its files."""
    rows = placed(in_files(docs), *columns)
    return rows.withColumn("place", F.xxhash64(*PLACE)).drop(*PLACE)


def _measures(sources: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float]]:
    """Entropy and largest repetition of the mixture, for some exponents at once."""
    grid = F.explode(F.array(*map(F.lit, exponents))).alias("exponent")
    power = F.pow("share", F.col("exponent"))
    rows = (
        sources.select("share", grid)
        .groupBy("exponent")
        .agg(
            F.sum(power).alias("total"),
            F.sum(power * F.log("share")).alias("logs"),
            F.max(F.pow("share", F.col("exponent") - 1)).alias("most"),
            F.min(F.pow("share", F.col("exponent") - 1)).alias("least"),
        )
        .collect()
    )
    return {
        r.exponent: (math.log(r.total) - r.exponent * r.logs / r.total, r.most / r.least) for r in rows
    }


def find_exponent(sources: DataFrame, target_entropy: float, max_repeats: float) -> float:
    """The smallest exponent whose mixture is neither flatter than the target nor over the limit.

    Entropy and repetition both fall as the exponent grows.  target_entropy is
    a share of the entropy of equal weights.  Each round divides the interval
    in STEPS parts with one job over the table of sources.
    """
    n = sources.count()
    target = target_entropy * math.log(n) if n else 0.0
    low, width = 0, STEPS**ROUNDS
    while width > 1 and n > 1:
        width //= STEPS
        marks = [low + i * width for i in range(1, STEPS)]
        found = _measures(sources, [mark / STEPS**ROUNDS for mark in marks])
        flat = [
            mark
            for mark in marks
            if found[mark / STEPS**ROUNDS][0] > target or found[mark / STEPS**ROUNDS][1] > max_repeats
        ]
        low = max([low, *flat])
    return 1.0 if n <= 1 else (low + 1) / STEPS**ROUNDS


def _keys(seed: int, passes: Column) -> tuple[Column, Column, Column]:
    """Keys of a block, of a document in its block and of a row of a document in the permutation of one pass."""
    kinds = {"block": F.col("block"), "doc": _name(), "row": F.col("place")}
    return tuple(hash_key(F.lit(seed), passes, F.lit(kind), of) for kind, of in kinds.items())


def _name() -> Column:
    """What names a document: its doc_id, or else its place."""
    return F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("at "), F.col("place").cast("string")))


def source_plan(
    tokens: DataFrame,
    target_entropy: float,
    max_repeats: float,
    budget: int | None = None,
    seed: int = 0,
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """One row per source: weight, quota, whole passes, and where the last pass is cut.

    Without a budget the smallest one is taken that uses every document once
    at least: the source that is cut most gets exactly one pass.
    """
    per_source = tokens.groupBy("source").agg(
        F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")
    )
    total = tokens.agg(F.sum("n_tokens").alias("total")).first().total or 0
    shares = stored(
        per_source.withColumn("share", F.col("tokens") / F.lit(max(total, 1))), "sources"
    )
    exponent = find_exponent(shares, target_entropy, max_repeats)
    sums = shares.agg(
        F.sum(F.pow("share", F.lit(exponent))).alias("norm"),
        F.min(F.pow("share", F.lit(exponent - 1))).alias("least"),
    ).first()
    growth = F.pow("share", F.lit(exponent - 1))
    if budget is None:
        ratio = growth / F.lit(sums.least or 1.0)
    else:
        ratio = growth * F.lit(budget / max(total, 1) / (sums.norm or 1.0))
    quota = F.round(F.col("tokens") * F.col("ratio")).cast("bigint")
    sources = shares.withColumn("ratio", ratio).select(
        "source",
        "tokens",
        F.lit(exponent).alias("exponent"),
        (F.pow("share", F.lit(exponent)) / F.lit(sums.norm or 1.0)).alias("weight"),
        quota.alias("quota"),
        F.floor(quota / F.col("tokens")).cast("bigint").alias("whole_passes"),
        (quota % F.col("tokens")).alias("rest"),
        F.ceil(F.col("docs") / block_docs).cast("bigint").alias("blocks"),
    )
    sources = stored(sources, "quotas")

    block_key, doc_key, row_key = _keys(seed, F.col("whole_passes") + 1)
    keyed = _placed(tokens, sources).select(
        "source", "n_tokens", "rest", block_key.alias("block_key"), doc_key.alias("doc_key"), row_key.alias("row_key")
    )
    # The last pass is cut in one block, there in one document, and there, if
    # many rows have its doc_id, in one range of them and at last after one row.
    whole = sources.select("source", F.col("rest").alias("room"))
    part = F.shiftright("row_key", KEY_BITS - RANGE_BITS)
    cut_block = _cut(keyed, whole, "cut_block", block_key=F.col("block_key"))
    cut_doc = _cut(_at(keyed, cut_block, block_key="cut_block"), cut_block, "cut_doc", doc_key=F.col("doc_key"))
    in_doc = _at(keyed, cut_block, block_key="cut_block")
    in_doc = stored(_at(in_doc, cut_doc, doc_key="cut_doc"), "cut-document")
    cut_range = _cut(in_doc, cut_doc, "cut_range", range_key=part)
    in_range = _at(in_doc.withColumn("range_key", part), cut_range, range_key="cut_range")
    cut_row = _cut(in_range, cut_range, "first_out", row_key=F.col("row_key"))
    plan = sources
    for cut, name in ((cut_block, "cut_block"), (cut_doc, "cut_doc"), (cut_row, "first_out")):
        found = cut.select(F.col("source").alias("cut_source"), name)
        plan = plan.join(found, F.col("source").eqNullSafe(F.col("cut_source")), "left").drop("cut_source")
    # Rows before the first one that is left out are used.
    return stored(plan.withColumn("cut_row", F.col("first_out") - 1).drop("first_out"), "mixture")


def _at(rows: DataFrame, cuts: DataFrame, **places: str) -> DataFrame:
    """The rows of each source at the place of its cut."""
    named = cuts.select(F.col("source").alias("cut_source"), *places.values())
    same = F.col("source").eqNullSafe(F.col("cut_source"))
    for name, cut in places.items():
        same = same & (F.col(name) == F.col(cut))
    return rows.join(named, same, "left_semi")


def _cut(rows: DataFrame, rooms: DataFrame, name: str, **key: Column) -> DataFrame:
    """For each source the first key at which its rows exceed its room, and the room left for that key.

    Rows are summed by the key before their order is looked at.
    """
    ((key_name, value),) = key.items()
    sums = rows.groupBy("source", value.alias(key_name)).agg(F.sum("n_tokens").alias("tokens"))
    limits = rooms.select(F.col("source").alias("limited"), "room")
    joined = sums.join(limits, F.col("source").eqNullSafe(F.col("limited"))).drop("limited")
    before = F.sum("tokens").over(Window.partitionBy("source").orderBy(key_name)) - F.col("tokens")
    found = (
        joined.withColumn("before", before)
        .filter((F.col("before") <= F.col("room")) & (F.col("before") + F.col("tokens") > F.col("room")))
        .select("source", F.col(key_name).alias(name), (F.col("room") - F.col("before")).alias("room"))
    )
    return stored(found, name.replace("_", "-"))


def _placed(tokens: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents with the quota of their source and their block in it."""
    plan = sources.withColumnRenamed("source", "planned")
    joined = tokens.join(plan, F.col("source").eqNullSafe(F.col("planned"))).drop("planned")
    return joined.withColumn("block", hash_key(F.lit("place"), _name()) % F.col("blocks"))


def _passes(seed: int) -> Column:
    """In how many passes a document is used."""
    block_key, doc_key, row_key = _keys(seed, F.col("whole_passes") + 1)
    in_doc = (doc_key < F.col("cut_doc")) | ((doc_key == F.col("cut_doc")) & (row_key <= F.col("cut_row")))
    first = (block_key < F.col("cut_block")) | ((block_key == F.col("cut_block")) & in_doc)
    return F.col("whole_passes") + F.when(first & (F.col("rest") > 0), 1).otherwise(0)


def mixture(tokens: DataFrame, plan: DataFrame, seed: int = 0) -> DataFrame:
    """One row per use of a document: its pass, its block and its place in the pass.

    The plan has one row per source.  It is broadcast if it is small, which
    Spark checks on the stored table, and otherwise both sides are shuffled
    and the partition of a large source is split.
    """
    used = _placed(tokens, plan).withColumn("passes", _passes(seed)).filter(F.col("passes") > 0)
    block_key, doc_key, _ = _keys(seed, F.col("pass"))
    return used.withColumn("pass", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("passes")))).select(
        "doc_id", "source", "n_tokens", "pass", "block", block_key.alias("block_key"), doc_key.alias("doc_key")
    )


def mixed_documents(docs: DataFrame, plan: DataFrame, seed: int = 0) -> DataFrame:
    """The documents, each as often as the mixture uses it, with the columns they came with.

    Decided per row from the plan, so the texts meet no table but the plan.
    Rows without doc_id, or with the same, are told apart by their places in
    files, so a table with such rows has to be in files when it is counted.
    """
    own = docs.columns
    kept = F.struct(*[F.col(f"`{name}`") for name in own]).alias("document")
    rows = with_place(docs, "doc_id", "source", kept)
    used = _placed(rows, plan).withColumn("passes", _passes(seed)).filter(F.col("passes") > 0)
    return used.select("document", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("passes")))).select("document.*")
