"""Tier lookup and pricing."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmeter.functions.money import AMOUNT, amount, round_to_even_unit
from callmeter.settings import Settings
from callmeter.sources.charge_rules import tier_book

# In charge_order, one window has room for this many hash values, and one
# micro-batch for all windows of a second or more since 1970.  38 digits leave
# room for eight billion batches, or fewer where windows are shorter.
HASHES_PER_WINDOW = 2**60
SECONDS_PER_BATCH = 10**10


# A price list of up to this many rules, some megabytes, is broadcast.
BROADCAST_RULES = 10_000


def _overlapping(tiers: Column, prev: Column, new: Column) -> Column:
    return F.filter(
        tiers, lambda tier: (tier["lower_limit"] <= new) & (tier["upper_limit"] >= prev + 1)
    )


def _units(tier: Column, prev: Column, new: Column) -> Column:
    """Units of (prev, new] that lie in the tier."""
    return F.least(new, tier["upper_limit"]) - F.greatest(prev, tier["lower_limit"] - 1)


def _compat_units(settings: Settings, tiers: Column, position: Column) -> Column:
    """Units of a tier as the first-generation job counted them.

    A counter starts at the previous total and stands at the upper limit of
    the tier before from then on.
    """
    prev, new = F.col("counter_prev"), F.col("counter_new")
    tier = F.get(tiers, position)
    lower, upper = tier["lower_limit"], tier["upper_limit"]
    counter = F.coalesce(F.get(tiers, position - 1)["upper_limit"], prev)

    by_deals = F.col("charge_type") == settings.number_type
    by_calls = F.col("charge_type") == settings.frequency_type
    filled = new >= upper
    entered_below = F.when(by_deals, counter < lower).otherwise(counter <= lower)
    # A flow tier that is filled was measured from the call counter.
    measured_from = F.when(by_deals | by_calls, counter).otherwise(F.col("month_calls"))
    left_over = F.when(by_deals & (counter >= lower), new - prev).otherwise(new - counter)
    return (
        F.when(filled & entered_below, upper - lower + 1)
        .when(filled, upper - measured_from)
        .otherwise(left_over)
    )


def match_tiers(counters: DataFrame, rules: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Adds ``lines``, the tiers that each increment touches, with units and amount.

    Increments inside the free allowance, and those of a type without tiers,
    have null.  The price list is counted and broadcast if it is short; a long
    one is joined by charge type and salt.
    """
    prev, new = F.col("counter_prev"), F.col("counter_new")
    touched = F.when(~F.col("is_free"), _overlapping(F.col("tiers"), prev, new))

    def line(tier: Column, position: Column) -> Column:
        if settings.compat:
            units = _compat_units(settings, F.col("touched"), position)
        else:
            units = _units(tier, prev, new)
        return F.struct(
            tier["charge_id"].alias("charge_id"),
            tier["lower_limit"].alias("lower_limit"),
            tier["upper_limit"].alias("upper_limit"),
            units.alias("units"),
            amount(units, tier["rate"]).alias("amount"),
        )

    book = tier_book(rules)
    if rules.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES:
        joined = counters.join(F.broadcast(book), "charge_type", "left")
    else:
        # There are few charge types, so a long list is repeated for every
        # salt and the increments of a type are dealt over the salts.
        salts = int(counters.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        book = book.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        salt = F.pmod(F.xxhash64("window_start", "seq_hash"), F.lit(salts)).cast("int")
        joined = counters.withColumn("salt", salt).join(book, ["charge_type", "salt"], "left").drop("salt")
    return (
        joined.withColumn("touched", touched)
        .withColumn("lines", F.transform("touched", line))
        .drop("tiers", "touched")
    )


def tier_lines(matched: DataFrame) -> DataFrame:
    """One row per charged increment and tier; one without tier where none matches."""
    return (
        matched.filter(~F.col("is_free"))
        .select(*[name for name in matched.columns if name != "lines"], F.explode_outer("lines").alias("line"))
        .select("*", "line.*")
        .drop("line")
    )


def increment_charges(
    matched: DataFrame, settings: Settings = Settings(), batch_id: int = 0
) -> DataFrame:
    """Money, rule and paid calls of each increment.

    Money is rounded once per increment.  The rule is that of the highest tier
    touched, 0 when there is none.  ``charge_order`` numbers the increments in
    the order in which they were priced; being a number and not a struct of
    texts, it lets the bills be summed by hash aggregation.
    """
    zero = F.lit(Decimal(0)).cast(AMOUNT)
    total = F.aggregate("lines", zero, lambda so_far, line: (so_far + line["amount"]).cast(AMOUNT))
    window = ((F.col("window_start") / settings.window_ms).cast("bigint")).cast("decimal(18,0)")
    windows_per_batch = max(SECONDS_PER_BATCH, SECONDS_PER_BATCH * 1000 // settings.window_ms)
    first_of_batch = Decimal(batch_id * windows_per_batch * HASHES_PER_WINDOW)
    order = (
        window * F.lit(Decimal(HASHES_PER_WINDOW))
        + F.col("seq_hash").cast("decimal(19,0)")
        + F.lit(first_of_batch)
    )
    last_line = F.get("lines", F.size("lines") - 1)
    return matched.select(
        "*",
        F.coalesce(round_to_even_unit(total), F.lit(0)).cast("double").alias("access_money"),
        F.coalesce(last_line["charge_id"], F.lit(0)).alias("charge_id"),
        F.col("paid_calls").alias("access_count"),
        F.col("sum_flow").alias("access_flow"),
        F.col("sum_deal").alias("deal_count"),
        order.cast("decimal(38,0)").alias("charge_order"),
    ).drop("lines")


def missing_charge_rule(charges: DataFrame) -> DataFrame:
    """Charged increments that no tier covers."""
    return charges.filter(~F.col("is_free") & (F.col("charge_id") == 0))
