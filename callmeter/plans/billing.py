"""From an access log to priced increments."""

from __future__ import annotations

from pyspark.sql import DataFrame

from callmeter.operators.allowance import charge_counters, free_allowance_split
from callmeter.operators.chargeable import chargeable_increments
from callmeter.operators.metering import access_increments
from callmeter.operators.running import running_charge_totals
from callmeter.operators.tiers import increment_charges, match_tiers
from callmeter.settings import Settings
from callmeter.sources.stored import stored


def chargeable_log(log: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The chargeable increments of a log, as a stored table."""
    return stored(chargeable_increments(access_increments(log, settings), settings), "chargeable")


def counted(
    chargeable: DataFrame, settings: Settings = Settings(), earlier: DataFrame | None = None
) -> DataFrame:
    """Chargeable increments with their tier counters."""
    totals = running_charge_totals(chargeable, settings, earlier)
    return charge_counters(free_allowance_split(totals, settings), settings)


def priced(
    chargeable: DataFrame,
    rules: DataFrame,
    settings: Settings = Settings(),
    earlier: DataFrame | None = None,
    batch_id: int = 0,
) -> DataFrame:
    """Chargeable increments with money, rule and paid calls."""
    counters = counted(chargeable, settings, earlier)
    return increment_charges(match_tiers(counters, rules, settings), settings, batch_id)
