"""The lifetime free allowance and the counters that the tiers are applied to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmeter.settings import Settings


def free_allowance_split(totals: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Deals of the month beyond the allowance, before and after each increment.

    Adds ``paid_prev`` and ``paid_new``.  The part of the allowance that was
    used up in earlier months does not count against this month.
    """
    allowance = F.lit(settings.free_allowance)
    nothing = F.lit(0)
    before_month = F.col("prior_deals") - F.col("month_deals")
    earlier_paid = F.greatest(nothing, before_month - allowance)
    over_before = F.greatest(nothing, F.col("prior_deals") - allowance)
    over_after = F.greatest(nothing, F.col("prior_deals") + F.col("sum_deal") - allowance)
    return totals.select(
        "*",
        (over_before - earlier_paid).cast("bigint").alias("paid_prev"),
        (over_after - earlier_paid).cast("bigint").alias("paid_new"),
    )


def charge_counters(split: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The range (counter_prev, counter_new] that the increment covers this month."""
    by_calls = F.col("charge_type") == settings.frequency_type
    by_deals = F.col("charge_type") == settings.number_type
    flow_step = F.col("call_count") if settings.compat else F.col("sum_flow")
    return split.select(
        "*",
        F.when(by_calls, F.col("month_calls"))
        .when(by_deals, F.col("paid_prev"))
        .otherwise(F.col("month_flow"))
        .alias("counter_prev"),
        F.when(by_calls, F.col("month_calls") + F.col("call_count"))
        .when(by_deals, F.col("paid_new"))
        .otherwise(F.col("month_flow") + flow_step)
        .alias("counter_new"),
    )
