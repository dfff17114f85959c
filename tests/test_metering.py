import pytest
from pyspark.sql import functions as F

from callmeter.functions.clock import epoch_ms, local_day
from callmeter.operators import metering
from callmeter.settings import Settings

LOG = (
    "userId string, userLogo string, userProject string, appId bigint, apiId bigint, apiType int, "
    "inParam string, status int, chargeType int, accessFlow bigint, dealCount bigint, add_time_ms bigint"
)
MIDNIGHT = 1_578_182_400_000  # 2020-01-05 UTC


def log(spark, *rows):
    """rows: (ms after midnight, logo, api type, status, flow, deals)."""
    return spark.createDataFrame(
        [("u", r[1], "p", 1, 1, r[2], "{}", r[3], 1, r[4], r[5], MIDNIGHT + r[0]) for r in rows], LOG
    )


def test_windows_are_sixty_seconds(spark):
    df = metering.access_increments(log(spark, (0, "a", 1, 1, 1, 1), (59_999, "a", 1, 1, 2, 3), (60_000, "a", 1, 1, 4, 5)))
    rows = df.orderBy("window_start").collect()
    assert [(r.window_start - MIDNIGHT, r.call_count, r.sum_flow, r.sum_deal) for r in rows] == [
        (0, 2, 3, 4), (60_000, 1, 4, 5)
    ]


def test_attributes_come_from_the_earliest_record(spark):
    row = metering.access_increments(log(spark, (50, "late", 0, 1, 1, 1), (10, "z", 1, 1, 1, 1), (10, "b", 0, 1, 1, 1))).first()
    assert (row.user_logo, row.api_type, row.add_time) == ("b", 0, MIDNIGHT + 10)


def test_sql_surface_gives_the_same_increments(spark):
    records = log(spark, (0, "a", 1, 1, 1, 1), (1, "b", 1, 0, 2, 3), (70_000, "a", 1, 1, 4, 5))
    metering.register_log(records)
    a = metering.access_increments(records)
    b = metering.access_increments_sql(spark).select(*a.columns)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_failed_calls_count_as_calls_only(spark):
    df = metering.access_increments(log(spark, (0, "a", 1, 1, 5, 6), (1, "a", 1, 0, 7, 8)))
    row = metering.user_access_statistics(df).first()
    assert (row.access_count, row.success_count, row.access_flow, row.deal_count) == (2, 1, 5, 6)
    assert row.access_day == "2020-01-05"


@pytest.mark.parametrize(
    "zone, day",
    [("UTC", "2020-01-05"), ("Asia/Shanghai", "2020-01-05"), ("America/New_York", "2020-01-04")],
)
def test_days_are_cut_in_the_given_zone(spark, zone, day):
    df = spark.createDataFrame([(MIDNIGHT,), (MIDNIGHT - 1,)], "ms bigint")
    days = [r.d for r in df.select(local_day(F.col("ms"), zone).alias("d")).collect()]
    assert days[0] == day
    before = {"UTC": "2020-01-04", "Asia/Shanghai": "2020-01-05", "America/New_York": "2020-01-04"}
    assert days[1] == before[zone]


def test_milliseconds_do_not_depend_on_the_session_zone(spark):
    # 02:30 on this day does not exist in New York, the zone of the test session.
    df = spark.sql("SELECT TIMESTAMP_NTZ'2020-03-08 02:30:00.123999' AS ts")
    assert df.select(epoch_ms(F.col("ts")).alias("ms")).first().ms == 1583634600123


def test_row_counts_per_window(spark):
    df = metering.window_row_counts(log(spark, (0, "a", 1, 1, 1, 1), (5, "a", 1, 1, 1, 1), (60_000, "a", 1, 1, 1, 1)))
    assert sorted(r.row_count for r in df.collect()) == [1, 2]


@pytest.mark.parametrize("sql", [False, True])
def test_records_are_summed_and_filtered_before_the_one_shuffle(spark, sql):
    """Below the exchange there are a partial sum and the filter on a grouping key."""
    rows = log(spark, (0, "a", 1, 1, 1, 1))
    if sql:
        metering.register_log(rows)
    df = metering.access_increments_sql(spark) if sql else metering.access_increments(rows, Settings())
    plan = df.filter("status = 1")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    below = plan[plan.rindex("Exchange hashpartitioning") :]
    assert "partial_sum" in below and "Filter" in below
