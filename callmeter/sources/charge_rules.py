"""The price list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callmeter.functions.money import RATE, fits, unit_rate


def read_rules(spark: SparkSession, url: str, table: str = "charge_rule", **options: str) -> DataFrame:
    """The price list kept in a relational database."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def active_rules(rules: DataFrame) -> DataFrame:
    """Rules in force.  The discount always applies, whatever is_discount says."""
    return rules.filter(F.col("status") == 1).select(
        "id", "spend_type", "unit_price", "is_discount", "discount", "lower_limit", "upper_limit"
    )


def unfit_rules(rules: DataFrame) -> DataFrame:
    """Rules in force whose price or discount has too many digits to be charged exactly."""
    return active_rules(rules).filter(~fits(F.col("unit_price"), F.col("discount")))


def tier_book(rules: DataFrame) -> DataFrame:
    """One row per charge type with its tiers in ascending order.

    An array of tiers lets every increment be priced in place: the join with
    it never multiplies rows, so no grouping shuffle has to follow.  A rule
    that unfit_rules() reports fails the job instead of being rounded.
    """
    price, discount = F.col("unit_price"), F.col("discount")
    unfit = F.concat(F.lit("charge rule with too many digits: "), F.col("id").cast("string"))
    tier = F.struct(
        "lower_limit",
        "upper_limit",
        F.col("id").alias("charge_id"),
        F.when(fits(price, discount), unit_rate(price, discount))
        .otherwise(F.raise_error(unfit).cast(RATE))
        .alias("rate"),
    )
    return (
        active_rules(rules)
        .groupBy(F.col("spend_type").alias("charge_type"))
        .agg(F.sort_array(F.collect_list(tier)).alias("tiers"))
    )
