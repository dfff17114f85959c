"""Exact money arithmetic."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prices with up to ten decimals times a whole percentage are exact here, and
# so are 18 digits of units times such a rate.
PRICE = "decimal(17,10)"
RATE = "decimal(19,12)"
AMOUNT = "decimal(38,12)"


def fits(unit_price: Column, discount: Column) -> Column:
    """Whether a price and a discount are represented exactly."""
    price = unit_price.try_cast(PRICE)
    rate = (price * discount.try_cast("decimal(5,0)") * F.lit(Decimal("0.01"))).try_cast(RATE)
    return F.coalesce(price.cast("double") == unit_price, F.lit(False)) & rate.isNotNull()


def unit_rate(unit_price: Column, discount: Column) -> Column:
    """Price of one unit after discount; discount is a whole percentage."""
    percent = discount.cast("decimal(5,0)") * F.lit(Decimal("0.01"))
    return (unit_price.cast(PRICE) * percent).cast(RATE)


def amount(units: Column, rate: Column) -> Column:
    return (units.cast("decimal(18,0)") * rate).cast(AMOUNT)


def round_to_even_unit(value: Column) -> Column:
    """Round half up to a whole unit, then raise odd results by one."""
    whole = F.floor(value.cast("decimal(37,12)") + F.lit(Decimal("0.5"))).cast("bigint")
    return whole + F.pmod(whole, F.lit(2))
