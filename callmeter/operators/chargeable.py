"""Which increments are charged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmeter.functions.text import names_project, text_hashes
from callmeter.settings import Settings


def free_by_project(increments: DataFrame) -> DataFrame:
    """Adds ``project_free``: the call was made on behalf of the caller's own project."""
    return increments.withColumn(
        "project_free", names_project(F.col("in_param"), F.col("user_project"))
    )


def with_sequence(increments: DataFrame) -> DataFrame:
    """Adds ``seq_hash`` and ``seq_rest``, which order the increments of a window.

    Together they are 120 bits of a hash of the user, API, application and
    parameter.  With them in place of the parameter, which can be a long text,
    bills are computed from narrow rows of numbers.
    """
    seq_hash, seq_rest = text_hashes(*map(F.col, ("user_id", "api_id", "app_id", "in_param")))
    return increments.withColumns({"seq_hash": seq_hash, "seq_rest": seq_rest})


def chargeable_increments(increments: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Successful calls of charged APIs, by users who pay, outside their own project."""
    return (
        free_by_project(
            increments.filter(
                (F.col("status") == 1)
                & (F.col("api_type") == 1)
                & ~F.col("user_id").isin(*settings.exempt_users)
            )
        )
        .filter(~F.col("project_free"))
        .drop("project_free")
        .transform(with_sequence)
    )
