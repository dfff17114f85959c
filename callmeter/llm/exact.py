"""Exact deduplication against a persistent index of digests.

The index is a table of SHA-256 digests, bucketed and sorted by digest.  A
load is reduced to one row per digest before it is shuffled, checked against
the index by a sort-merge anti-join that shuffles the load only, and what is
new is appended.  A text that the index has already is a copy, whatever its
doc_id.  The entries of a load carry its name and the places of their rows in
the files of the load, so one that is run again over these files, after a
failure and however they are split, finds its own entries and gives the same
result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callmeter.llm.common import in_files, placed, shuffle_partitions, text_of
from callmeter.sources.stored import new_folder, stored


class DigestIndex:
    """A bucketed table; with a path it outlives the session's catalog."""

    def __init__(self, spark: SparkSession, table: str, buckets: int, path: str | None = None):
        self.spark, self.table, self.buckets = spark, table, buckets
        location = f"LOCATION '{path}'" if path else ""
        spark.sql(
            f"""
            CREATE TABLE IF NOT EXISTS {table}
              (digest BINARY, keep_id BIGINT, keep_place BIGINT, load_name STRING)
            USING parquet
            CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS {location}
            """
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, digests: DataFrame, load_name: str) -> None:
        """Appends the digests of a load, given as its summary, that the index lacks."""
        new = digests.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        new.select("digest", "keep_id", "keep_place", F.lit(load_name)).write.insertInto(self.table)

    def merged(self, table: str, path: str | None = None) -> DigestIndex:
        """A copy of the index with one sorted file a bucket.

        Every load adds a file to each bucket, and a bucket of several files
        has to be sorted whenever it is met.
        """
        copy = DigestIndex(self.spark, table, self.buckets, path)
        about = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.table}").filter("col_name = 'Location'").first()
        # Read as plain files: of a bucketed table Spark leaves this shuffle out.
        rows = self.spark.read.schema(self.rows().schema).parquet(about.data_type)
        rows.repartition(self.buckets, "digest").write.insertInto(table)
        return copy

    def forget(self) -> None:
        """Takes the table out of the catalog; one with a path keeps its files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def hashed_rows(docs: DataFrame) -> DataFrame:
    """doc_id, place and digest of every row, stored: the texts are read once."""
    digest = F.unhex(F.sha2(text_of(), 256)).alias("digest")
    return stored(placed(docs, "doc_id", digest), "digests")


def _place() -> Column:
    """The place of a row as one number of 64 bits."""
    return F.xxhash64("file_key", "file_row")


def summary(hashed: DataFrame) -> DataFrame:
    """One row per digest of a load: its rows and the one that stays, stored.

    That is the one with the largest doc_id, of several the one whose place
    has the largest number; one without doc_id only where all are.  Stored, because Spark would else check rows instead of digests
    against the index, and all copies of a text in one task.
    """
    # By doc_id first, so that the largest place is one number and not part of a struct.
    by_id = hashed.groupBy("digest", "doc_id").agg(F.max(_place()).alias("place"), F.count(F.lit(1)).alias("rows"))
    best = by_id.groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"),
        F.coalesce(F.max_by("place", "doc_id"), F.max("place")).alias("keep_place"),
        F.sum("rows").alias("rows"),
    )
    return stored(best, "digest-summary")


def verdicts(hashed: DataFrame, digests: DataFrame, index: DigestIndex, *loads: str) -> DataFrame:
    """Every row of some loads, summed up in digests, with the row that stays in its stead.

    The facts of each digest are stored first, so that the join that hands
    them out has plain shuffles on both sides and Spark can split the
    partition of a digest that very many rows have.
    """
    sizes = digests.groupBy("digest").agg(F.sum("rows").alias("group_size"))
    facts = stored(sizes.join(index.rows().hint("merge"), "digest"), "digest-facts")
    stays = (_place() == F.col("keep_place")) & F.col("load_name").isin(*loads)
    return hashed.join(facts, "digest").select(
        "doc_id",
        "file_key",
        "file_row",
        "keep_id",
        "group_size",
        stays.alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, its place, keep_id, group_size, kept, text_sha256.

    A null text counts as empty.  Of equal texts the row with the largest
    doc_id stays; a null doc_id is below all others, and of rows equal in text
    and doc_id exactly one stays.  Columns beyond doc_id and text are not read.
    An empty table gives no rows.

    The table is loaded into a new index in two loads, the upper half of the
    doc_ids first, so that a text met again in the second load is a copy of a
    row with a larger doc_id.
    """
    spark = docs.sparkSession
    hashed = hashed_rows(in_files(docs))
    name = f"digest_index_{uuid.uuid4().hex}"
    index = DigestIndex(spark, name, shuffle_partitions(spark), new_folder(spark, "digest-index"))
    ends = hashed.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    middle = 0 if ends.low is None else (ends.low + ends.high) // 2
    upper = F.coalesce(F.col("doc_id") > middle, F.lit(False))
    first, second = summary(hashed.filter(upper)), summary(hashed.filter(~upper))
    index.add(first, "upper")
    index.add(second, "lower")
    found = verdicts(hashed, first.unionByName(second), index, "upper", "lower")
    # The facts of the digests are stored, so the index of this one run is done with.
    index.forget()
    return found
