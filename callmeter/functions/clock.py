"""Windows, days and months of an epoch-millisecond column.

Nothing here depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000


def epoch_ms(ts: Column) -> Column:
    """Epoch milliseconds of a TIMESTAMP_NTZ column that holds UTC."""
    days = F.unix_date(ts.cast("date")).cast("bigint")
    # The whole-second and millisecond parts are read field by field because a
    # cast of TIMESTAMP_NTZ to TIMESTAMP would go through the session zone.
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60
    millis = F.floor(F.date_part(F.lit("SECOND"), ts) * 1000).cast("bigint")
    return days * DAY_MS + seconds.cast("bigint") * 1000 + millis


def window_start(ms: Column, width_ms: int) -> Column:
    return ms - F.pmod(ms, F.lit(width_ms))


def local_day(ms: Column, zone: str = "UTC") -> Column:
    """``yyyy-MM-dd`` in the given zone."""
    if zone == "UTC":
        whole_days = (ms - F.pmod(ms, F.lit(DAY_MS))) / DAY_MS
        return F.date_from_unix_date(whole_days.cast("int")).cast("string")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = (ms.cast("decimal(18,0)") / 1000).cast("decimal(18,6)")
    utc = epoch + F.make_dt_interval(secs=seconds)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc).cast("date").cast("string")


def month_of(day: Column) -> Column:
    """``yyyy-MM`` of a ``yyyy-MM-dd`` text."""
    return F.substring(day, 1, 7)
