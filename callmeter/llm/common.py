"""What several operators share."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callmeter.sources.stored import stored

# The white space that separates words.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"

KEY_BITS = 60


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def n_words(text: Column) -> Column:
    """Number of words of a text that is not null."""
    bare = F.btrim(text, F.lit(BLANKS))
    words = F.size(F.split(bare, BLANK_RUN))
    return F.when(F.length(bare) == 0, F.lit(0)).otherwise(words).cast("bigint")


def hash_key(*parts: Column) -> Column:
    """60 evenly spread bits of some values, the same in every SQL engine that has md5."""
    joined = F.concat_ws(":", *(part.cast("string") for part in parts))
    return F.conv(F.substring(F.md5(joined), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have yet, in any case of its letters."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """Numbers the rows, also those that are equal in every column.

    The numbers depend on how the input is split, so they name a row in what
    is stored with them and not in a table that is read again; see placed().
    """
    return docs.withColumn(name, F.monotonically_increasing_id())


def in_files(docs: DataFrame) -> DataFrame:
    """The table itself if its rows lie in files, else a stored copy of it."""
    try:
        _file_metadata(docs)
    except AnalysisException:
        return stored(docs, "documents")
    return docs


def _file_metadata(docs: DataFrame) -> tuple[Column, Column]:
    """File and number of a row, also where a column of the table hides their usual name."""
    hidden = docs.metadataColumn("_metadata")
    docs.select(hidden["file_path"], hidden["row_index"])
    return hidden["file_path"], hidden["row_index"]


PLACE = ("file_key", "file_row")


def placed(docs: DataFrame, *columns: str | Column, names: tuple[str, str] = PLACE) -> DataFrame:
    """Some columns and the place of every row, its file and its number there.

    Unlike a number given by Spark, the place of a row of a table in files is
    the same whenever and however split the table is read.
    """
    path, row = _file_metadata(docs)
    return docs.select(*columns, F.xxhash64(path).alias(names[0]), row.alias(names[1]))


def without_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of a table in files but those whose places are listed, with the same columns."""
    names = place_names(docs)
    listed = dropped.select(*(F.col(own).alias(name) for own, name in zip(PLACE, names)))
    return placed(docs, "*", names=names).join(listed, [*names], "left_anti").drop(*names)


def place_names(docs: DataFrame) -> tuple[str, str]:
    """Names for the place that none of the table's columns has."""
    return fresh_name(docs, PLACE[0]), fresh_name(docs, PLACE[1])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def drawn(rows: DataFrame, key: Column, most: int, total: int) -> DataFrame:
    """At most so many rows of about total, those with the least hash key.

    Only keys below a bound, which about twice as many rows have, are sorted,
    so no task sends all it would if it were the only one.
    """
    bound = (1 << KEY_BITS) if total <= 2 * most else (1 << KEY_BITS) * 2 * most // total
    name = fresh_name(rows, "draw")
    return rows.withColumn(name, key).filter(F.col(name) < bound).orderBy(name, "doc_id").limit(most).drop(name)


# Rows that go to a Python worker at once, so that long texts need little memory.
ROWS_AT_ONCE = 1000


def bound_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to ROWS_AT_ONCE rows; lower ones stay."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ROWS_AT_ONCE:
        spark.conf.set(name, ROWS_AT_ONCE)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
