"""Near-duplicates by bottom-k sketches.

The sketch of a document are the k least hashes, by one hash function, of its
shingles.  Documents with equal shingles are one node.  Nodes that share
retained values are found by inverted lists over the values, and of a node only
as many lists are used, the shortest first, as a pair must have one of in
common if its sketches overlap as much as similar sets' do.  So lists of
frequent values are used by almost no node.

From a list of moderate length come pairs, which the estimate from the sketch
of their union filters.  The members of a longer list are chained, not paired.
Nodes connected so far form a group, and in a group full sets are compared
exactly: a node is counted against all others by an inverted index, until all
nodes not yet counted are connected anyway.  In a large group all nodes are
compared with one of them first, in blocks, which links most copies of one
text at a cost in proportion to their number.  The nodes that are left over, if
any, are compared with the whole group, block by block.  Links are what the
exact comparison found, and components are taken over links.
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
from callmeter.llm.common import in_files, numbered, placed, shuffle_partitions, text_of
from callmeter.sources.stored import stored

# Lists up to this length give pairs, longer ones a chain.
LIST_PAIRS = 64

# Documents and shingles of one block of a group.
BLOCK_NODES = 2048
BLOCK_SHINGLES = 2_000_000

# Nodes of a large group that are compared with its first one in one unit.
STAR_NODES = 256

# Fixed value: flipped, it lets signed values have the order of unsigned hashes.
SIGN = np.uint64(1 << 63)

SKETCHED = "row bigint, file_key bigint, file_row bigint, doc_id bigint, n_shingles bigint, set1 bigint, set2 bigint, sketch array<bigint>"


@dataclass(frozen=True)
class Likeness:
    """Shingle length, smallest similarity in percent, and size of a sketch."""

    words: int = 5
    percent: int = 80
    k: int = 64

    @property
    def least_overlap(self) -> int:
        """Values that the sketches of similar sets share, six standard deviations below the mean."""
        p = self.percent / 100
        return max(1, int(self.k * p - 6 * math.sqrt(self.k * p * (1 - p))))


def shingles(chunk: w.Chunk, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted by text and hash: owners and hashes."""
    docs = chunk.doc_of_word()
    windows = w.runs_hash(hashes, n)
    inside = np.flatnonzero(docs[: len(windows)] == docs[n - 1 :][: len(windows)])
    owners, values = docs[inside], windows[inside]
    counts = chunk.counts
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        # The whole sequence of a short text, with its length.
        whole = [
            w.runs_hash(hashes[chunk.first[i] : chunk.first[i + 1]], int(counts[i]))[0] + np.uint64(counts[i])
            for i in short
        ]
        owners = np.concatenate([owners, short])
        values = np.concatenate([values, np.array(whole, np.uint64)])
    order = np.lexsort((values, owners))
    owners, values = owners[order], values[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    return owners[new], values[new]


def _sketch(n: int, k: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = w.Hasher(2, lower=True)
        for batch in batches:
            out = {name: [] for name in ("size", "set1", "set2", "kept", "ends")}
            done = 0
            for chunk in w.chunks(batch.column("text")):
                hashes = hasher.spans(chunk.data, chunk.starts, chunk.ends)
                owners, values = shingles(chunk, hashes, n)
                first = np.searchsorted(owners, np.arange(chunk.texts + 1))
                sizes = np.diff(first)
                for name, salt in (("set1", 0), ("set2", w.ODD)):
                    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w.mix(values + np.uint64(salt)))])
                    out[name].append((sums[first[1:]] - sums[first[:-1]]).view(np.int64))
                rank = np.arange(len(values)) - np.repeat(first[:-1], sizes)
                out["size"].append(sizes)
                # Spark sorts signed values, and the least of a union must be the least hashes.
                out["kept"].append((values[rank < k] ^ SIGN).view(np.int64))
                out["ends"].append(done + np.cumsum(np.minimum(sizes, k)))
                done += int(np.minimum(sizes, k).sum())
            whole = {name: np.concatenate(parts) if parts else np.empty(0, np.int64) for name, parts in out.items()}
            offsets = pa.array(np.concatenate([[0], whole["ends"]]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in ("row", "file_key", "file_row", "doc_id")),
                    pa.array(whole["size"].astype(np.int64)),
                    pa.array(whole["set1"]),
                    pa.array(whole["set2"]),
                    pa.ListArray.from_arrays(offsets, pa.array(whole["kept"])),
                ],
                names=["row", "file_key", "file_row", "doc_id", "n_shingles", "set1", "set2", "sketch"],
            )

    return sketch


def _full_sets(n: int):
    def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = w.Hasher(2, lower=True)
        for batch in batches:
            for chunk in w.chunks(batch.column("text")):
                owners, values = shingles(chunk, hasher.spans(chunk.data, chunk.starts, chunk.ends), n)
                first = np.searchsorted(owners, np.arange(chunk.texts + 1)).astype(np.int32)
                sets = pa.ListArray.from_arrays(pa.array(first), pa.array(values.view(np.int64)))
                names = [name for name in batch.schema.names if name != "text"]
                columns = [batch.column(name).slice(chunk.row, chunk.texts) for name in names]
                yield pa.RecordBatch.from_arrays([*columns, sets], names=[*names, "shingles"])

    return full_sets


def _candidate_edges(nodes: DataFrame, like: Likeness) -> DataFrame:
    """Pairs of nodes (low, high) whose sets are to be compared, and chains through long lists."""
    values = nodes.select("row", "n_shingles", F.explode("sketch").alias("value"))
    often = values.groupBy("value").agg(F.count(F.lit(1)).alias("nodes")).filter("nodes > 1")
    shared = values.join(often, "value")
    # How many values, the rarest first, a similar node has one of in common.
    retained = F.least(F.col("n_shingles"), F.lit(like.k))
    own = F.ceil(F.col("n_shingles") * like.percent / 100)
    overlap = F.when(F.col("n_shingles") * 100 <= like.k * like.percent, own).otherwise(F.lit(like.least_overlap))
    by_rarity = F.sort_array(F.collect_list(F.struct("nodes", "value")))
    # Values of one node only come first and lead nowhere.
    used = retained - F.least(overlap, retained) + 1 - (retained - F.size("values"))
    prefix = stored(
        shared.groupBy("row", "n_shingles")
        .agg(by_rarity.alias("values"))
        .select("row", "n_shingles", F.explode(F.slice("values", 1, F.greatest(used, F.lit(0)).cast("int"))).alias("one"))
        .select("row", "n_shingles", F.col("one.value").alias("value"), F.col("one.nodes").alias("nodes")),
        "prefix-values",
    )
    lists = prefix.groupBy("value").agg(F.count(F.lit(1)).alias("length"), F.min("row").alias("head"))
    lists = stored(lists.filter("length > 1"), "inverted-lists")
    entries = stored(prefix.join(lists, "value").drop("nodes"), "list-entries")

    chains = entries.filter((F.col("length") > LIST_PAIRS) & (F.col("row") != F.col("head")))
    chains = chains.select(F.col("head").alias("low"), F.col("row").alias("high"))
    short = entries.filter(F.col("length") <= LIST_PAIRS).select("value", "row", "n_shingles")
    other = short.select("value", F.col("row").alias("high"), F.col("n_shingles").alias("high_size"))
    sizes = F.least("n_shingles", "high_size") * 100 >= F.greatest("n_shingles", "high_size") * like.percent
    pairs = (
        short.withColumnRenamed("row", "low")
        .join(other, "value")
        .filter((F.col("low") < F.col("high")) & sizes)
        .select("low", "high")
        .distinct()
    )
    pairs = stored(pairs, "sketch-pairs")
    left = nodes.select(F.col("row").alias("low"), F.col("sketch").alias("a"), F.col("n_shingles").alias("na"))
    right = nodes.select(F.col("row").alias("high"), F.col("sketch").alias("b"), F.col("n_shingles").alias("nb"))
    likely = pairs.join(left, "low").join(right, "high").filter(_likely(like)).select("low", "high")
    return stored(likely.unionByName(chains).distinct(), "candidates")


def _likely(like: Likeness) -> Column:
    """Estimate from the sketch of the union; exact where both sketches are whole sets."""
    union = F.slice(F.sort_array(F.array_union("a", "b")), 1, like.k)
    both = F.size(F.array_intersect(F.array_intersect(union, F.col("a")), F.col("b")))
    share = like.percent / 100
    slack = 5 * math.sqrt(share * (1 - share) / like.k)
    whole = (F.col("na") <= like.k) & (F.col("nb") <= like.k)
    common = F.size(F.array_intersect("a", "b"))
    exact = common * 100 >= (F.col("na") + F.col("nb") - common) * like.percent
    return F.when(whole, exact).otherwise(both >= F.size(union) * (share - slack))


def components(edges: DataFrame) -> DataFrame:
    """Node and component (its least node) of every node that has an edge.

    Every round a node takes the least label around it and then the label of
    its label, so labels travel over doubling distances.  A round is a join and
    a sum, stored; a node with very many edges is one row per task before the
    shuffle, and the join splits its partition.
    """
    pairs = edges.select(F.col("low").alias("node"), F.col("high").alias("other"))
    pairs = stored(pairs.unionByName(pairs.select(F.col("other").alias("node"), F.col("node").alias("other"))), "links")
    labels = stored(pairs.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label")), "labels")
    while True:
        around = pairs.join(labels, "node").groupBy("other").agg(F.min("label").alias("near"))
        nearer = labels.join(around, labels["node"] == around["other"]).select(
            "node", "label", F.least("label", "near").alias("near")
        )
        nearer = stored(nearer, "nearer-labels")
        jump = nearer.select(F.col("node").alias("near"), F.col("near").alias("far"))
        moved = stored(
            nearer.join(jump, "near").select("node", F.col("label").alias("old"), F.least("near", "far").alias("label")),
            "labels",
        )
        labels = moved.select("node", "label")
        if moved.filter("label <> old").isEmpty():
            return labels.withColumnRenamed("label", "component")


def star_links(rows: np.ndarray, sets: list[np.ndarray], percent: int, known: np.ndarray) -> list[tuple[int, int]]:
    """Links between the one known node and those that are similar to it."""
    (middle,) = np.flatnonzero(known)
    sizes = np.array([len(s) for s in sets])
    owners = np.repeat(np.arange(len(rows)), sizes)
    both = np.bincount(owners[np.isin(np.concatenate(sets), sets[middle])], minlength=len(rows))
    similar = both * 100 >= (sizes + sizes[middle] - both) * percent
    return [(int(rows[middle]), int(row)) for row in rows[similar & ~known]]


def link_nodes(
    rows: np.ndarray, sets: list[np.ndarray], percent: int, known: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """Links that connect what is similar among some sets, compared exactly.

    A node is counted against all others through an inverted index.  Done when
    all nodes that were not counted are in one component.  Known nodes are
    linked among themselves already.
    """
    n = len(rows)
    sizes = np.array([len(s) for s in sets])
    owners = np.repeat(np.arange(n), sizes)
    _, value = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(value, kind="stable")
    holders = owners[order]
    begin = np.concatenate([[0], np.cumsum(np.bincount(value))])
    first = np.concatenate([[0], np.cumsum(sizes)])
    # The node with the most common shingles, for its size, stands in the middle.
    common = np.add.reduceat(np.diff(begin)[value].astype(float), first[:-1]) / sizes
    component, open_nodes, links = np.arange(n), np.ones(n, bool), []
    if known is not None and known.any():
        component[known] = np.flatnonzero(known)[0]
    while True:
        labels, counts = np.unique(component[open_nodes], return_counts=True)
        if len(labels) < 2:
            return links
        waiting = np.flatnonzero(open_nodes & (component != labels[counts.argmax()]))
        if counts.max() == 1:
            waiting = np.flatnonzero(open_nodes)
        x = waiting[common[waiting].argmax()]
        open_nodes[x] = False
        own = value[first[x] : first[x + 1]]
        length = begin[own + 1] - begin[own]
        offsets = np.concatenate([[0], np.cumsum(length)])
        index = np.arange(offsets[-1]) + np.repeat(begin[own] - offsets[:-1], length)
        both = np.bincount(holders[index], minlength=n)
        similar = np.flatnonzero(both * 100 >= (sizes + sizes[x] - both) * percent)
        for label in np.unique(component[similar]):
            if label != component[x]:
                y = similar[component[similar] == label][0]
                links.append((int(rows[x]), int(rows[y])))
                component[component == label] = component[x]


def _link_units(compare, percent: int):
    """Links that a comparison finds within the units of a partition, which come in order."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows, sets, known = None, [], [], []
        found: list[tuple[int, int]] = []

        def compared() -> list[tuple[int, int]]:
            return compare(np.array(rows), sets, percent, np.array(known)) if len(rows) > 1 else []

        for batch in batches:
            keys = list(zip(*(batch.column(name).to_pylist() for name in ("unit_group", "unit"))))
            offsets = np.asarray(batch.column("shingles").offsets)
            flat = batch.column("shingles").values.to_numpy()
            members = zip(keys, batch.column("row").to_pylist(), batch.column("known").to_pylist())
            for i, (key, row, is_known) in enumerate(members):
                if key != current and rows:
                    found += compared()
                    rows, sets, known = [], [], []
                current = key
                rows.append(row)
                sets.append(flat[offsets[i] : offsets[i + 1]])
                known.append(is_known)
        found += compared()
        table = np.array(found, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(table.min(axis=1) if len(table) else table[:, 0]), pa.array(table.max(axis=1) if len(table) else table[:, 1])],
            names=["low", "high"],
        )

    return link


def _linked(docs: DataFrame, nodes: DataFrame, dealt: DataFrame, like: Likeness, compare) -> DataFrame:
    """Links that a comparison finds among nodes dealt to the units of their groups, stored.

    dealt has row, unit_group, units and known; a node's set goes to each of its units.
    """
    where = dealt.join(nodes.select("row", "file_key", "file_row"), "row")
    sets = docs.select("file_key", "file_row", "text").join(where, ["file_key", "file_row"])
    sets = sets.select("row", "unit_group", "units", "known", "text").mapInArrow(
        _full_sets(like.words),
        "row bigint, unit_group bigint, units array<bigint>, known boolean, shingles array<bigint>",
    )
    parts = shuffle_partitions(docs.sparkSession)
    in_units = sets.select("row", "unit_group", F.explode("units").alias("unit"), "known", "shingles")
    in_units = in_units.repartition(parts, "unit_group", "unit").sortWithinPartitions("unit_group", "unit")
    return stored(in_units.mapInArrow(_link_units(compare, like.percent), "low bigint, high bigint"), "similar")


def _upto(n: Column) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), n - 1)


def _block(blocks: Column) -> Column:
    """The block of a node, one of so many."""
    return F.pmod(F.xxhash64("row"), blocks)


def _links(docs: DataFrame, nodes: DataFrame, candidates: DataFrame, like: Likeness) -> DataFrame:
    """Exact links inside the groups that the candidates connect."""
    grouped = components(candidates).withColumnsRenamed({"node": "row", "component": "unit_group"})
    sized = grouped.join(nodes.select("row", "n_shingles"), "row")
    nodes_of, size_of = F.count(F.lit(1)), F.sum("n_shingles")
    groups = sized.groupBy("unit_group").agg(
        F.greatest(F.ceil(nodes_of / BLOCK_NODES), F.ceil(size_of / BLOCK_SHINGLES)).alias("blocks"),
        F.greatest(F.ceil(nodes_of / STAR_NODES), F.ceil(size_of / BLOCK_SHINGLES)).alias("star_blocks"),
    )
    grouped = stored(sized.join(groups, "unit_group"), "groups")
    nobody = F.lit(False).alias("known")
    small = grouped.filter("blocks = 1").select(
        "row", "unit_group", F.array(F.lit(0).cast("bigint")).alias("units"), nobody
    )
    links = _linked(docs, nodes, small, like, link_nodes)
    large = grouped.filter("blocks > 1")
    if large.isEmpty():
        return links

    # The node that a group is named after is compared with all others.
    middle = F.col("row") == F.col("unit_group")
    units = F.when(middle, _upto(F.col("star_blocks"))).otherwise(F.array(_block(F.col("star_blocks"))))
    stars = large.select("row", "unit_group", units.alias("units"), middle.alias("known"))
    star = _linked(docs, nodes, stars, like, star_links)
    left = large.filter(~middle).join(star.select(F.col("high").alias("row")), "row", "left_anti")
    left = stored(left.select("row", "unit_group", "n_shingles"), "left-over")
    links = links.unionByName(star)
    if left.isEmpty():
        return links

    # Each block of what is left over meets each block of its group.
    left_of = left.groupBy("unit_group").agg(
        F.greatest(F.ceil(nodes_of / BLOCK_NODES), F.ceil(size_of / BLOCK_SHINGLES)).alias("left_blocks")
    )
    marked = large.join(left_of, "unit_group").join(
        left.select("row", F.lit(True).alias("is_left")), "row", "left"
    )
    as_member = F.transform(_upto(F.col("left_blocks")), lambda i: i * F.col("blocks") + _block(F.col("blocks")))
    as_left = F.transform(_upto(F.col("blocks")), lambda j: _block(F.col("left_blocks")) * F.col("blocks") + j)
    units = F.when(F.col("is_left"), F.array_distinct(F.concat(as_member, as_left))).otherwise(as_member)
    rest = marked.select("row", "unit_group", units.alias("units"), F.col("is_left").isNull().alias("known"))
    return links.unionByName(_linked(docs, nodes, rest, like, link_nodes))


def near_duplicates(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """One row per document: doc_id, its place, n_shingles, component_id, kept, stays.

    component_id is the least doc_id of the documents connected by links, and
    kept says whether it is the document's own.  Rows of one doc_id are
    documents of their own; stays is true for exactly one row of a component.
    A row without doc_id has no say in component_id, which is null where no row
    has one.  A text that is null or has no word is linked with nothing.  An
    empty table gives no rows; columns other than doc_id and text are not read.
    """
    docs = placed(in_files(docs), "doc_id", text_of().alias("text"))
    sketched = stored(
        numbered(docs, "row").mapInArrow(_sketch(like.words, like.k), SKETCHED), "sketches"
    )
    full = sketched.filter("n_shingles > 0")
    same = stored(
        full.groupBy("set1", "set2", "n_shingles").agg(F.min("row").alias("node")), "equal-sets"
    )
    nodes = stored(
        full.join(same.select(F.col("node").alias("row")), "row").select("row", "file_key", "file_row", "n_shingles", "sketch"), "nodes"
    )
    links = _links(docs, nodes, _candidate_edges(nodes, like), like)
    labels = stored(components(links), "components")

    own = ["row", "file_key", "file_row", "doc_id", "n_shingles"]
    member = full.select(*own, "set1", "set2").join(same, ["set1", "set2", "n_shingles"])
    member = stored(
        member.join(labels, "node", "left").select(
            *own, F.coalesce("component", "node").alias("component")
        ),
        "members",
    )
    heads = stored(
        member.groupBy("component").agg(
            F.min("doc_id").alias("component_id"),
            F.coalesce(F.min_by("row", "doc_id"), F.min("row")).alias("head"),
        ),
        "component-heads",
    )
    alone = sketched.filter("n_shingles = 0").select(
        *own, F.col("doc_id").alias("component_id"), F.col("row").alias("head")
    )
    linked = member.join(heads, "component").select(*own, "component_id", "head")
    return linked.unionByName(alone).select(
        "doc_id",
        "file_key",
        "file_row",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        (F.col("row") == F.col("head")).alias("stays"),
    )
