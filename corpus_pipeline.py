"""From raw documents to packed training sequences.

Five stages, each the work of one operator.  A stage takes the documents that
the one before has kept, and its result is written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callmeter.llm import exact, langid, mixing, neardup, packing
from callmeter.llm.common import documents, in_files, without_rows
from callmeter.sources.stored import stored

# The mixture is this share of the entropy of equal sources, or repeats a
# source this often at most.  Every document is used once at least.
TARGET_ENTROPY = 0.95
MAX_REPEATS = 2.0


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter and strings of codes go."""
    return langid.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    docs = in_files(docs)
    return without_rows(docs, exact.deduplicate(docs).filter(~F.col("kept")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group connected by a similarity of 0.8 of their five-word shingles."""
    docs = in_files(docs)
    return without_rows(docs, neardup.near_duplicates(docs).filter(~F.col("stays")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture of sources uses it, once at least."""
    plan = mixing.source_plan(mixing.counted(docs), TARGET_ENTROPY, MAX_REPEATS)
    return mixing.mixed_documents(docs, plan)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and the bins they lie in."""
    return packing.pack_documents(docs)


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

# Language identification and packing have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
