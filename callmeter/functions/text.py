"""Text functions of the archive and of the bill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def non_blank(col: Column) -> Column:
    """The text itself, or null when it is empty or only white space."""
    text = col.cast("string")
    # White space has codes up to that of a blank, so the pattern is only
    # needed for texts that begin with one of those.
    return F.when((F.ascii(text) > 32) | text.rlike(r"\S"), text)


# Salts of row keys, two hexadecimal digits.
SALTS = 256


def salted_row_key(user_id: Column, api_id: Column, app_id: Column, add_time: Column) -> Column:
    key = F.concat_ws("_", user_id, api_id.cast("string"), app_id.cast("string"), add_time)
    return F.concat(F.substring(F.md5(key), 1, 2), F.lit("_"), key)


def text_hashes(*cols: Column) -> tuple[Column, Column]:
    """The first and the next 60 bits of the md5 of the joined columns, as BIGINT."""
    digest = F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]))
    first, second = (F.conv(F.substring(digest, start, 15), 16, 10) for start in (1, 16))
    return first.cast("bigint"), second.cast("bigint")


def names_project(in_param: Column, project: Column) -> Column:
    """Whether the JSON parameter's accessProject contains the project name.

    Text that is not JSON, or has no accessProject, names no project.
    """
    named = F.get_json_object(in_param, "$.accessProject")
    return F.coalesce(named.contains(project), F.lit(False))


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have yet, in any case of its letters."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
