"""Small hand-made increments, and the plainest possible way to price them."""

import math
from fractions import Fraction

from pyspark.sql import functions as F

from callmeter.functions.clock import local_day, month_of
from callmeter.operators.chargeable import with_sequence

COLUMNS = (
    "user_id string, user_logo string, user_project string, api_id bigint, charge_type int, "
    "app_id bigint, in_param string, add_time bigint, call_count bigint, sum_flow bigint, sum_deal bigint"
)

DAY = 86_400_000
JAN_5_2020 = 1_578_182_400_000


def increments(spark, rows):
    """rows: (user, charge_type, day, calls, flow, deals[, app]); one window per row and day."""
    data = [
        (row[0], "logo", "proj", 1, row[1], row[6] if len(row) > 6 else 0, "{}",
         JAN_5_2020 + row[2] * DAY, *row[3:6])
        for row in rows
    ]
    df = spark.createDataFrame(data, COLUMNS)
    return (
        df.withColumn("window_start", F.col("add_time") - F.pmod("add_time", F.lit(60_000)))
        .withColumn("access_day", local_day(F.col("add_time")))
        .withColumn("access_month", month_of(F.col("access_day")))
        .transform(with_sequence)
    )


def rules(spark, *rows):
    """rows: (id, spend_type, unit_price, discount, lower, upper)."""
    data = [(r[0], r[1], float(r[2]), 1, r[3], r[4], r[5], 1) for r in rows]
    return spark.createDataFrame(
        data,
        "id bigint, spend_type int, unit_price double, is_discount int, discount bigint, "
        "lower_limit bigint, upper_limit bigint, status int",
    )


def priced_unit_by_unit(rows, tiers, allowance):
    """Walks through ordered (key, month, type, calls, flow, deals) and bills every unit by itself.

    tiers: type -> [(id, rate, lower, upper)].  Returns (paid calls, money, rule) per row.
    """
    used, calls_so_far, flow_so_far, paid_deals = {}, {}, {}, {}
    result = []
    for key, month, kind, calls, flow, deals in rows:
        before = used.get(key, 0)
        used[key] = before + deals
        place = (key, month)
        free = before + deals <= allowance
        # Deals beyond the allowance, counted one at a time.
        beyond = sum(1 for deal in range(before + 1, before + deals + 1) if deal > allowance)
        start = {
            1: paid_deals.get(place, 0),
            2: calls_so_far.get(place, 0),
        }.get(kind, flow_so_far.get(place, 0))
        size = {1: beyond, 2: calls}.get(kind, flow)
        money, rule = Fraction(0), 0
        if not free:
            for unit in range(start + 1, start + size + 1):
                for rule_id, rate, lower, upper in tiers.get(kind, []):
                    if lower <= unit <= upper:
                        money += Fraction(str(rate))
                        rule = rule_id
            if size == 0:
                # Nothing to bill; the tier that the counter stands inside is noted.
                for rule_id, _, lower, upper in tiers.get(kind, []):
                    if lower <= start < upper:
                        rule = rule_id
        paid_deals[place] = paid_deals.get(place, 0) + beyond
        flow_so_far[place] = flow_so_far.get(place, 0) + flow
        if not free:
            calls_so_far[place] = calls_so_far.get(place, 0) + calls
        whole = math.floor(money + Fraction(1, 2))
        result.append((0 if free else calls, float(whole + whole % 2), rule))
    return result
