"""From access records to increments, and from increments to usage statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callmeter.functions.clock import local_day, month_of, window_start
from callmeter.schema import INCREMENT_KEYS
from callmeter.settings import Settings

LOG_VIEW = "accessLog"


def period_buckets(log: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Adds the window, day and month of each record."""
    day = local_day(F.col("add_time_ms"), settings.zone)
    return (
        log.withColumn("window_start", window_start(F.col("add_time_ms"), settings.window_ms))
        .withColumn("access_day", day)
        .withColumn("access_month", month_of(F.col("access_day")))
    )


# What an increment takes from its earliest record.
EARLIEST = ["userLogo", "userProject", "apiType", "chargeType"]


def access_increments(log: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per window, user, API, app, status and parameter.

    Logo, project, API type, charge type and time are those of the earliest
    record of the group; among records of one millisecond, of the one whose
    values sort first.  Records are summed per task before the one shuffle, so
    a group of any size is one row of each task in it.
    """
    grouped = (
        log.select(
            window_start(F.col("add_time_ms"), settings.window_ms).alias("window_start"),
            F.col("userId").alias("user_id"),
            F.col("apiId").alias("api_id"),
            F.col("appId").alias("app_id"),
            "status",
            F.col("inParam").alias("in_param"),
            "accessFlow",
            "dealCount",
            "add_time_ms",
            *EARLIEST,
        )
        .groupBy(*INCREMENT_KEYS)
        .agg(
            F.count(F.lit(1)).alias("call_count"),
            F.sum("accessFlow").alias("sum_flow"),
            F.sum("dealCount").alias("sum_deal"),
            F.min(F.struct("add_time_ms", *EARLIEST)).alias("earliest"),
        )
    )
    return _named(grouped, settings)


def _named(grouped: DataFrame, settings: Settings, *keep: str) -> DataFrame:
    day = local_day(F.col("earliest.add_time_ms"), settings.zone)
    return grouped.select(
        *INCREMENT_KEYS,
        "call_count",
        "sum_flow",
        "sum_deal",
        F.col("earliest.userLogo").alias("user_logo"),
        F.col("earliest.userProject").alias("user_project"),
        F.col("earliest.apiType").alias("api_type"),
        F.col("earliest.chargeType").alias("charge_type"),
        F.col("earliest.add_time_ms").alias("add_time"),
        day.alias("access_day"),
        month_of(day).alias("access_month"),
        *keep,
    )


def merge_increments(increments: DataFrame, *least: str, settings: Settings = Settings()) -> DataFrame:
    """One row for the parts of each increment, as if they had been grouped at once.

    Of the columns ``least`` the smallest value stays.
    """
    own = F.struct(
        F.col("add_time").alias("add_time_ms"),
        F.col("user_logo").alias("userLogo"),
        F.col("user_project").alias("userProject"),
        F.col("api_type").alias("apiType"),
        F.col("charge_type").alias("chargeType"),
    )
    grouped = increments.groupBy(*INCREMENT_KEYS).agg(
        *[F.sum(name).alias(name) for name in ("call_count", "sum_flow", "sum_deal")],
        F.min(own).alias("earliest"),
        *[F.min(name).alias(name) for name in least],
    )
    return _named(grouped, settings, *least)


def register_log(log: DataFrame, name: str = LOG_VIEW) -> None:
    """Opens the log to SQL."""
    log.createOrReplaceTempView(name)


def access_increments_sql(
    spark: SparkSession, settings: Settings = Settings(), name: str = LOG_VIEW
) -> DataFrame:
    """The same increments, asked for in SQL over the registered view."""
    grouped = spark.sql(
        f"""
        SELECT add_time_ms - pmod(add_time_ms, {settings.window_ms}) AS window_start,
               userId AS user_id, apiId AS api_id, appId AS app_id, status, inParam AS in_param,
               count(1) AS call_count, sum(accessFlow) AS sum_flow, sum(dealCount) AS sum_deal,
               min(struct(add_time_ms, userLogo, userProject, apiType, chargeType)) AS earliest
        FROM {name}
        GROUP BY ALL
        """
    )
    return _named(grouped, settings)


def success_measures(increments: DataFrame) -> DataFrame:
    """Failed calls count as calls; flow and deals count for successful ones only."""
    ok = F.col("status") == 1
    return increments.select(
        "*",
        F.col("call_count").alias("access_count"),
        F.when(ok, F.col("call_count")).otherwise(0).alias("success_count"),
        F.when(ok, F.col("sum_flow")).otherwise(0).alias("access_flow"),
        F.when(ok, F.col("sum_deal")).otherwise(0).alias("deal_count"),
    )


def _usage(measures: DataFrame, **dims: str) -> DataFrame:
    return measures.groupBy(*[F.col(source).alias(name) for name, source in dims.items()]).agg(
        *[
            F.sum(measure).alias(measure)
            for measure in ("access_count", "success_count", "access_flow", "deal_count")
        ]
    )


def user_usage(measures: DataFrame) -> DataFrame:
    return _usage(
        measures,
        user_id="user_id",
        user_logo="user_logo",
        user_project="user_project",
        api_id="api_id",
        app_id="app_id",
        access_day="access_day",
    )


def project_usage(measures: DataFrame) -> DataFrame:
    return _usage(
        measures, logo="user_logo", project="user_project", api_id="api_id", access_day="access_day"
    )


def user_access_statistics(increments: DataFrame) -> DataFrame:
    return user_usage(success_measures(increments))


def project_access_statistics(increments: DataFrame) -> DataFrame:
    return project_usage(success_measures(increments))


def window_row_counts(log: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Records in each window."""
    return (
        log.groupBy(window_start(F.col("add_time_ms"), settings.window_ms).alias("window_start"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def preview(log: DataFrame, rows: int = 10) -> DataFrame:
    """The first records in time order, for a look at a batch."""
    return log.orderBy("add_time_ms", "log_id").limit(rows)
