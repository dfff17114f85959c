"""Sharding by extendible hashing.

A shard is a prefix of hash bits.  The directory starts as one bucket; only a
bucket over the byte limit splits, on its next bit, until every shard fits.
The first 60 bits come from doc_id.  Rows of one doc_id, or without one, that
exceed the limit together are told apart by 60 more bits from their row
number, so no number of them ends in one shard.

Buckets are summed once at a depth beyond the one expected, and the splits
are found on these sums; only buckets that are still too large there are
summed again, deeper.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmeter.llm.common import (
    KEY_BITS,
    PLACE,
    fresh_name,
    hash_key,
    in_files,
    numbered,
    place_names,
    placed,
    text_of,
)
from callmeter.sources.stored import stored

DEEPER = 4


def _prefix(depth: Column | int) -> tuple[Column, Column]:
    """The leading bits of the two keys of a row."""
    depth = F.lit(depth) if isinstance(depth, int) else depth
    first = F.least(depth, F.lit(KEY_BITS))
    second = F.greatest(depth - KEY_BITS, F.lit(0))
    return (
        F.call_function("shiftright", F.col("key1"), F.lit(KEY_BITS) - first),
        F.call_function("shiftright", F.col("key2"), F.lit(KEY_BITS) - second),
    )


def sized_rows(docs: DataFrame) -> DataFrame:
    """doc_id, size and the two keys of every document, stored."""
    rows = numbered(placed(docs, "doc_id", "text"), "row")
    return stored(
        rows.select(
            "doc_id",
            "file_key",
            "file_row",
            F.octet_length(text_of()).cast("bigint").alias("n_bytes"),
            hash_key(F.coalesce("doc_id", F.lit(-1))).alias("key1"),
            hash_key(F.lit("row"), F.col("row")).alias("key2"),
        ),
        "sizes",
    )


def _settled(cells: DataFrame, depth: int, from_depth: int, max_bytes: int) -> DataFrame:
    """The shallowest prefix of every cell that fits; null where even the cell is too large."""
    levels = cells.select("*", F.explode(F.sequence(F.lit(from_depth), F.lit(depth))).alias("depth"))
    first, second = _prefix(F.col("depth"))
    levels = levels.withColumns({"p1": first, "p2": second})
    sums = (
        levels.groupBy("depth", "p1", "p2")
        .agg(F.sum("cell_bytes").alias("shard_bytes"), F.sum("cell_rows").alias("shard_rows"))
        .filter((F.col("shard_bytes") <= max_bytes) | (F.col("shard_rows") == 1))
    )
    fits = levels.join(sums, ["depth", "p1", "p2"])
    return fits.groupBy("key1", "key2").agg(
        F.min(F.struct("depth", "p1", "p2", "shard_bytes", "shard_rows")).alias("shard")
    )


def directory(sized: DataFrame, max_bytes: int) -> list[tuple[int, DataFrame]]:
    """For each depth at which rows were summed: the cells settled there, with their shard."""
    total = sized.agg(F.sum("n_bytes").alias("total")).first().total or 0
    expected = max(0, math.ceil(math.log2(max(1, total / max_bytes))))
    depth, from_depth, pending, levels = min(expected + DEEPER, 2 * KEY_BITS), 0, sized, []
    while True:
        first, second = _prefix(depth)
        cells = pending.groupBy(first.alias("cell1"), second.alias("cell2")).agg(
            F.sum("n_bytes").alias("cell_bytes"), F.count(F.lit(1)).alias("cell_rows")
        )
        # A cell stands for its rows with the remaining bits zero.
        whole1 = F.call_function("shiftleft", F.col("cell1"), F.lit(KEY_BITS - min(depth, KEY_BITS)))
        whole2 = F.call_function("shiftleft", F.col("cell2"), F.lit(KEY_BITS - max(depth - KEY_BITS, 0)))
        cells = stored(
            cells.select(whole1.alias("key1"), whole2.alias("key2"), "cell_bytes", "cell_rows"), "cells"
        )
        too_large = cells.filter((F.col("cell_bytes") > max_bytes) & (F.col("cell_rows") > 1))
        settled = stored(_settled(cells, depth, from_depth, max_bytes), "directory")
        levels.append((depth, settled))
        if depth == 2 * KEY_BITS or too_large.isEmpty():
            return levels
        rest = too_large.select(F.col("key1").alias("c1"), F.col("key2").alias("c2"))
        pending = stored(_in_cells(pending, depth).join(rest, ["c1", "c2"], "left_semi").drop("c1", "c2"), "oversized")
        from_depth, depth = depth + 1, min(depth + DEEPER, 2 * KEY_BITS)


def _in_cells(rows: DataFrame, depth: int) -> DataFrame:
    first, second = _prefix(depth)
    return rows.withColumns(
        {
            "c1": F.call_function("shiftleft", first, F.lit(KEY_BITS - min(depth, KEY_BITS))),
            "c2": F.call_function("shiftleft", second, F.lit(KEY_BITS - max(depth - KEY_BITS, 0))),
        }
    )


def _name() -> Column:
    """The bits of a shard as text; empty for the one shard of a small table."""
    shard = F.col("shard")
    first = F.least(shard.depth, F.lit(KEY_BITS))
    second = F.greatest(shard.depth - KEY_BITS, F.lit(0))
    bits = lambda value, n: F.when(n == 0, "").otherwise(F.lpad(F.bin(value), n, "0"))
    return F.concat(bits(shard.p1, first), bits(shard.p2, second))


def shard_documents(docs: DataFrame, max_bytes: int) -> DataFrame:
    """One row per document: doc_id, n_bytes, shard (its bits), depth, shard_bytes, shard_rows.

    The size is that of the text in UTF-8, 0 for null.  A document larger than
    the limit has a shard of its own.  A null doc_id counts as -1.  Other
    columns are not read, and an empty table gives no rows.
    """
    return _sharded(sized_rows(in_files(docs)), max_bytes).select(
        "doc_id", "n_bytes", "shard", "depth", "shard_bytes", "shard_rows"
    )


def _sharded(sized: DataFrame, max_bytes: int) -> DataFrame:
    parts = []
    for depth, settled in directory(sized, max_bytes):
        cells = settled.withColumnsRenamed({"key1": "c1", "key2": "c2"})
        parts.append(_in_cells(sized, depth).join(cells, ["c1", "c2"]))
    return reduce(DataFrame.unionByName, parts).select(
        *sized.columns,
        _name().alias("shard"),
        F.col("shard.depth").alias("depth"),
        F.col("shard.shard_bytes").alias("shard_bytes"),
        F.col("shard.shard_rows").alias("shard_rows"),
    )


def write_shards(docs: DataFrame, path: str, max_bytes: int) -> None:
    """Writes the documents, one folder and file per shard."""
    docs = in_files(docs)
    shard = fresh_name(docs, "shard")
    names = place_names(docs)
    places = _sharded(sized_rows(docs), max_bytes).select(
        *(F.col(own).alias(name) for own, name in zip(PLACE, names)), F.col("shard").alias(shard)
    )
    rows = placed(docs, "*", names=names).join(places, [*names]).drop(*names)
    rows.repartition(F.col(shard)).write.partitionBy(shard).parquet(path)
