"""Best-fit packing of documents into bins of tokens, with conflicts.

Documents are dealt evenly over groups of bounded size, and each group is
packed by one task.  Longest first, a document goes to the bin with the least
room that still holds it.  Bins are ordered by their room: a bitmap over the
amounts of room finds the next larger one that occurs.  A bin carries a bitmap
of the clusters of copies in it, and one of the sources that have had their
share of it; a bin with the document's bit set is passed over and the search
goes on with the next, up to an empty bin.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmeter.llm.common import n_words, numbered, text_of

PACKED = "doc_id bigint, piece bigint, first_token bigint, n_tokens bigint, bin_id bigint, bin_offset bigint"

# Bins are numbered per group.
BIN_BITS = 24


def best_fit(lengths: list[int], sources: list[int], clusters: list[int], capacity: int, per_source: int) -> list[int]:
    """The bin of each item; items come longest first and none is longer than a bin."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set where some bin has room for exactly r tokens
    cluster_bits: list[int] = []
    full_sources: list[int] = []
    from_source: list[Counter] = []
    placed = []
    for length, source, cluster in zip(lengths, sources, clusters):
        source_bit = 1 << source
        cluster_bit = 1 << cluster if cluster >= 0 else 0
        found, room, above = -1, 0, rooms >> length
        while above and found < 0:
            step = (above & -above).bit_length() - 1
            room = length + step
            for bin_id in by_room[room]:
                if not (full_sources[bin_id] & source_bit or cluster_bits[bin_id] & cluster_bit):
                    found = bin_id
                    break
            above &= above - 1
        if found < 0:
            found, room = len(cluster_bits), capacity
            cluster_bits.append(0)
            full_sources.append(0)
            from_source.append(Counter())
        else:
            by_room[room].remove(found)
            if not by_room[room]:
                rooms ^= 1 << room
        cluster_bits[found] |= cluster_bit
        from_source[found][source] += 1
        if from_source[found][source] >= per_source:
            full_sources[found] |= source_bit
        left = room - length
        by_room[left].append(found)
        rooms |= 1 << left
        placed.append(found)
    return placed


def _pack_group(capacity: int, per_source: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n_tokens", "row"], ascending=[False, True], kind="stable")
        group = int(rows["pack_group"].iloc[0]) << BIN_BITS
        whole = rows["n_tokens"] // capacity
        parts = rows.loc[rows.index.repeat(whole)].copy()
        parts["piece"] = parts.groupby(level=0).cumcount()
        parts["first_token"] = parts["piece"] * capacity
        parts["n_tokens"] = capacity
        parts["bin"] = range(len(parts))
        parts["bin_offset"] = 0

        rest = rows.copy()
        rest["piece"] = whole
        rest["first_token"] = whole * capacity
        rest["n_tokens"] = rows["n_tokens"] - whole * capacity
        empty = rest[(rest["n_tokens"] == 0) & (whole == 0)].copy()
        rest = rest[rest["n_tokens"] > 0].sort_values(["n_tokens", "row"], ascending=[False, True], kind="stable")
        # Only clusters met twice in the group can conflict.
        often = rest["cluster"].duplicated(keep=False)
        clusters = pd.Series(-1, index=rest.index)
        clusters[often] = pd.factorize(rest.loc[often, "cluster"])[0]
        sources = pd.factorize(rest["source"], use_na_sentinel=False)[0]
        bins = best_fit(rest["n_tokens"].tolist(), sources.tolist(), clusters.tolist(), capacity, per_source)
        rest["bin"] = [b + len(parts) for b in bins]
        rest["bin_offset"] = rest.groupby("bin")["n_tokens"].cumsum() - rest["n_tokens"]
        empty["bin"] = pd.NA
        empty["bin_offset"] = pd.NA
        out = pd.concat([parts, rest, empty]) if len(empty) else pd.concat([parts, rest])
        return pd.DataFrame(
            {
                "doc_id": out["doc_id"].astype("Int64"),
                "piece": out["piece"].astype("int64"),
                "first_token": out["first_token"].astype("int64"),
                "n_tokens": out["n_tokens"].astype("int64"),
                "bin_id": out["bin"].astype("Int64") + group,
                "bin_offset": out["bin_offset"].astype("Int64"),
            }
        )

    return pack


def pack_documents(
    docs: DataFrame, capacity: int = 2048, per_source: int = 8, group_docs: int = 4096
) -> DataFrame:
    """One row per piece of a document: which tokens of it lie where in which bin.

    Tokens are words.  A document longer than a bin is cut into whole bins and
    a rest; the rest is packed with others.  Two documents of one text never
    share a bin, and of one source at most per_source pieces do; null is a
    source, and a null text is empty.  A document without words has one row
    without a bin.  Repeated rows are documents of their own.  Other columns
    than doc_id, source and text are not read; an empty table gives no rows.
    """
    groups = max(1, -(-docs.count() // group_docs))
    rows = numbered(docs.select("doc_id", "source", "text"), "row").select(
        "doc_id",
        "source",
        "row",
        n_words(text_of()).alias("n_tokens"),
        F.xxhash64(text_of()).alias("cluster"),
        F.pmod(F.xxhash64("row"), F.lit(groups)).alias("pack_group"),
    )
    return rows.groupBy("pack_group").applyInPandas(_pack_group(capacity, per_source), PACKED)
