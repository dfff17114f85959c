"""Parameters of a metering job."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # Codes of the three charge types.  Any code that is neither the number
    # nor the frequency code is priced by flow.
    number_type: int = 1
    frequency_type: int = 2
    flow_type: int = 3

    # Deals that each charge key may consume free of charge in its lifetime.
    free_allowance: int = 500

    # Users that are metered but never charged.
    exempt_users: tuple[str, ...] = ("-1", "-", "1")

    # Length of one metering window.
    window_ms: int = 60_000

    # A window that a micro-batch leaves open is carried on to the next ones,
    # and booked when records have come that are this much later than its end,
    # or after so many batches.  With 0 batches nothing is carried, and a
    # window that is cut by batches is booked in parts.
    lateness_ms: int = 0
    carry_batches: int = 0

    # Zone in which days and months are cut.
    zone: str = "UTC"

    # Reproduce the billing quirks of the first-generation job: the flow
    # counter advances by calls, a filled flow tier is measured from the call
    # counter, tiers entered exactly at their lower limit cost one unit more,
    # and units in a gap between tiers are billed.
    compat: bool = False

    # A charge key is priced in blocks, not in one task, once it holds more
    # increments than this.
    heavy_key_rows: int = 1_000_000
