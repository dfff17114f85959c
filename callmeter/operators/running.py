"""What each charge key had consumed before each of its increments.

Four running totals precede every increment: the deals of the key's lifetime,
and the deals, flow and paid calls of the month.  Totals charged earlier enter
as rows that precede all increments, so no lookup join is needed and the
shuffle by charge key is the only one.

A key with more rows than one task should sum is cut into blocks that follow
one another in the order of the key: days, or windows where a day is too large,
or parts of a window, by as many leading bits of ``seq_hash`` as its size
needs, where a window is too large.  Totals of
the blocks are summed first, which takes one row per block, and the sums
inside the blocks are then taken independently of each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from callmeter.functions.clock import DAY_MS, window_start
from callmeter.schema import CHARGE_KEY, CHARGE_ORDER
from callmeter.settings import Settings
from callmeter.sources.stored import stored

KEY_MONTH = [*CHARGE_KEY, "access_month"]

# arrival is 0 for totals charged earlier and 1 for increments.
BLOCK = ["arrival", "block_day", "block_window", "block_hash"]
PLACE = [*KEY_MONTH, *BLOCK]

# Bits of seq_hash.
HASH_BITS = 60


def _before(value: Column | str, window: WindowSpec) -> Column:
    """Sum over the rows that precede the current one."""
    frame = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(frame), F.lit(0))


def _with_earlier(increments: DataFrame, earlier: DataFrame | None) -> DataFrame:
    """Increments together with the earlier totals of the same keys."""
    rows = increments.withColumn("arrival", F.lit(1))
    if earlier is None:
        return rows
    keys = increments.select(*CHARGE_KEY).distinct()
    totals = earlier.join(keys, CHARGE_KEY, "left_semi").select(
        *KEY_MONTH,
        F.col("access_count").alias("call_count"),
        F.col("access_flow").alias("sum_flow"),
        F.col("deal_count").alias("sum_deal"),
        F.lit(-1).cast("bigint").alias("window_start"),
        F.lit(0).cast("bigint").alias("seq_hash"),
        F.lit(0).cast("bigint").alias("seq_rest"),
        F.lit(0).alias("arrival"),
    )
    return rows.unionByName(totals, allowMissingColumns=True)


def _add_consumed(rows: DataFrame, order: list[str], resumed: bool) -> DataFrame:
    """Lifetime deals, and deals and flow of the month, before each row.

    All windows are served by one sort.  Ordering the lifetime by month first
    keeps time order, because a month is a span of windows; the totals charged
    earlier, which may belong to later months, are added as a whole.
    """
    life = Window.partitionBy(*CHARGE_KEY).orderBy("access_month", "arrival", *order)
    month = Window.partitionBy(*KEY_MONTH).orderBy("arrival", *order)
    if resumed:
        is_new = F.col("arrival") == 1
        new_deals = F.when(is_new, F.col("sum_deal")).otherwise(0)
        earlier_deals = F.when(is_new, 0).otherwise(F.col("sum_deal"))
        whole = Window.partitionBy(*CHARGE_KEY)
        prior_deals = _before(new_deals, life) + F.sum(earlier_deals).over(whole)
    else:
        prior_deals = _before("sum_deal", life)
    return rows.select(
        "*",
        prior_deals.alias("prior_deals"),
        _before("sum_deal", month).alias("month_deals"),
        _before("sum_flow", month).alias("month_flow"),
    )


def _add_paid_calls(rows: DataFrame, settings: Settings) -> DataFrame:
    """Calls that count towards the month: none while the allowance lasts."""
    free = F.col("prior_deals") + F.col("sum_deal") <= settings.free_allowance
    return rows.withColumn("is_free", free).withColumn(
        "paid_calls",
        F.when((F.col("arrival") == 1) & F.col("is_free"), 0).otherwise(F.col("call_count")),
    )


def _add_month_calls(rows: DataFrame, order: list[str]) -> DataFrame:
    month = Window.partitionBy(*KEY_MONTH).orderBy("arrival", *order)
    return rows.withColumn("month_calls", _before("paid_calls", month))


def _whole_keys(rows: DataFrame, settings: Settings, resumed: bool) -> DataFrame:
    consumed = _add_paid_calls(_add_consumed(rows, CHARGE_ORDER, resumed), settings)
    return _add_month_calls(consumed, CHARGE_ORDER)


def _with_blocks(rows: DataFrame, limit: int) -> DataFrame:
    """Adds the columns that name the block of each row.

    Each day and each window that is cut holds more than ``limit`` rows, so
    both lists are short beside the rows.  They are stored, so that Spark knows
    their sizes when it chooses the joins.
    """
    size = "block_rows"
    # Days of UTC, whatever zone the bill is made out in: they never overlap.
    rows = rows.withColumn("block_day", window_start(F.col("window_start"), DAY_MS))
    windows = rows.groupBy(*CHARGE_KEY, "block_day", "window_start").agg(
        F.count(F.lit(1)).alias(size)
    )
    days = windows.groupBy(*CHARGE_KEY, "block_day").agg(F.sum(size).alias(size))
    large_days = days.filter(F.col(size) > limit).drop(size).withColumn("by_window", F.lit(True))
    # Twice as many parts as would do if the hash spread the rows perfectly.
    bits = F.ceil(F.log2(F.col(size) / max(limit, 1))).cast("int") + 1
    large_windows = windows.filter(F.col(size) > limit).withColumn("hash_bits", F.least(bits, F.lit(HASH_BITS)))
    large_windows = large_windows.drop(size, "block_day")
    return (
        rows.join(stored(large_days, "large-days"), [*CHARGE_KEY, "block_day"], "left")
        .join(stored(large_windows, "large-windows"), [*CHARGE_KEY, "window_start"], "left")
        .withColumn("block_window", F.when(F.col("by_window"), F.col("window_start")).otherwise(0))
        .withColumn(
            "block_hash",
            F.when(
                F.col("hash_bits").isNotNull(),
                F.call_function("shiftright", F.col("seq_hash"), F.lit(HASH_BITS) - F.col("hash_bits")),
            ).otherwise(0),
        )
        .drop("by_window", "hash_bits")
    )


def _in_blocks(rows: DataFrame, settings: Settings, resumed: bool, limit: int) -> DataFrame:
    """The same totals, with every row shuffled once, by its block."""
    columns = rows.columns
    rows = _with_blocks(rows, limit)
    between = [name for name in BLOCK if name != "arrival"]
    inside = Window.partitionBy(*PLACE).orderBy(*CHARGE_ORDER)

    blocks = rows.groupBy(*PLACE).agg(
        F.sum("sum_deal").alias("sum_deal"), F.sum("sum_flow").alias("sum_flow")
    )
    starts = _add_consumed(blocks, between, resumed).select(
        *PLACE,
        F.col("prior_deals").alias("block_prior_deals"),
        F.col("month_deals").alias("block_month_deals"),
        F.col("month_flow").alias("block_month_flow"),
    )
    deals = _before("sum_deal", inside)
    new_deals = F.when(F.col("arrival") == 1, deals).otherwise(0) if resumed else deals
    consumed = rows.join(starts, PLACE).select(
        *columns,
        *between,
        (F.col("block_prior_deals") + new_deals).alias("prior_deals"),
        (F.col("block_month_deals") + deals).alias("month_deals"),
        (F.col("block_month_flow") + _before("sum_flow", inside)).alias("month_flow"),
    )
    # Which calls were paid is known only now, and is summed over the blocks
    # in turn; the rows are stored so that this does not repeat the work above.
    consumed = stored(
        _add_paid_calls(consumed, settings).withColumn("calls_inside", _before("paid_calls", inside)),
        "heavy",
    )
    paid = consumed.groupBy(*PLACE).agg(F.sum("paid_calls").alias("paid_calls"))
    paid_starts = _add_month_calls(paid, between).select(
        *PLACE, F.col("month_calls").alias("block_month_calls")
    )
    return (
        consumed.join(paid_starts, PLACE)
        .withColumn("month_calls", F.col("block_month_calls") + F.col("calls_inside"))
        .drop("block_month_calls", "calls_inside", *between)
    )


def heavy_keys(rows: DataFrame, settings: Settings) -> DataFrame | None:
    """Charge keys with too many rows for one task, stored, or None."""
    per_key = rows.groupBy(*CHARGE_KEY).agg(F.count(F.lit(1)).alias("key_rows"))
    keys = stored(per_key.filter(F.col("key_rows") > settings.heavy_key_rows).select(*CHARGE_KEY), "heavy-keys")
    return None if keys.isEmpty() else keys


def running_charge_totals(
    increments: DataFrame, settings: Settings = Settings(), earlier: DataFrame | None = None
) -> DataFrame:
    """Adds prior_deals, month_deals, month_flow, month_calls, is_free and paid_calls.

    ``increments`` are chargeable and should be a stored table: their sizes
    per key are measured before the plan is chosen.  ``earlier`` holds totals
    charged before, one or more rows per charge key and month.
    """
    rows = _with_earlier(increments, earlier)
    resumed = earlier is not None
    heavy = heavy_keys(increments, settings)
    if heavy is None:
        totals = _whole_keys(rows, settings, resumed)
    else:
        keys, limit = heavy, settings.heavy_key_rows
        light_rows = rows.join(keys, CHARGE_KEY, "left_anti")
        heavy_rows = rows.join(keys, CHARGE_KEY, "left_semi")
        totals = _whole_keys(light_rows, settings, resumed).unionByName(
            _in_blocks(heavy_rows, settings, resumed, limit)
        )
    return totals.filter(F.col("arrival") == 1).drop("arrival")
