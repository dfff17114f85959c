import random
from dataclasses import replace
from decimal import Decimal

import pytest
from billing_rows import increments, priced_unit_by_unit, rules
from pyspark.sql import functions as F

from callmeter.functions.money import round_to_even_unit
from callmeter.operators import rollup, running, tiers
from callmeter.operators.allowance import free_allowance_split
from callmeter.operators.chargeable import chargeable_increments, free_by_project
from callmeter.operators.running import running_charge_totals
from callmeter.plans.billing import counted, priced
from callmeter.settings import Settings
from callmeter.sources.charge_rules import unfit_rules

TEN_FREE = Settings(free_allowance=10)
NONE_FREE = Settings(free_allowance=0)
# Every key counts as heavy.
BLOCKS = dict(heavy_key_rows=0)


def tier_rows(spark):
    return rules(
        spark,
        (1, 1, 0.5, 100, 1, 5), (2, 1, 0.35, 90, 6, 12), (3, 1, 0.25, 75, 13, 10**9),
        (4, 2, 1.5, 100, 1, 3), (5, 2, 1.25, 90, 4, 8), (6, 2, 1.1, 75, 9, 10**9),
        (7, 3, 0.2, 100, 1, 10), (8, 3, 0.15, 90, 11, 30), (9, 3, 0.125, 75, 31, 10**9),
    )


TIERS = {
    1: [(1, 0.5, 1, 5), (2, 0.315, 6, 12), (3, 0.1875, 13, 10**9)],
    2: [(4, 1.5, 1, 3), (5, 1.125, 4, 8), (6, 0.825, 9, 10**9)],
    3: [(7, 0.2, 1, 10), (8, 0.135, 11, 30), (9, 0.09375, 31, 10**9)],
}


def random_rows(seed, count=400):
    rng = random.Random(seed)
    return [
        (
            f"u{rng.choice('aaab')}",
            rng.choice((1, 2, 3)),
            rng.randrange(0, 120),
            rng.randrange(1, 5),
            rng.randrange(0, 20),
            rng.randrange(0, 4),
            rng.randrange(0, 50),
        )
        for _ in range(count)
    ]


def distinct(rows):
    """One row per user, type, day and app, as increments are."""
    return list({(r[0], r[1], r[2], r[6]): r for r in rows}.values())


def bill(df):
    return {
        (r.user_id, r.charge_type, r.window_start, r.app_id): (r.access_count, r.access_money, r.charge_id)
        for r in df.collect()
    }


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("blocks", [False, True])
def test_bill_equals_pricing_unit_by_unit(spark, seed, blocks):
    settings = replace(TEN_FREE, **BLOCKS) if blocks else TEN_FREE
    df = increments(spark, distinct(random_rows(seed)))
    order = ("window_start", "seq_hash", "app_id")
    plain = sorted(df.collect(), key=lambda r: tuple(r[name] for name in order))
    expected = priced_unit_by_unit(
        [
            ((r.user_id, r.charge_type), r.access_month, r.charge_type, r.call_count, r.sum_flow, r.sum_deal)
            for r in plain
        ],
        TIERS,
        allowance=10,
    )
    keys = [(r.user_id, r.charge_type, r.window_start, r.app_id) for r in plain]
    assert bill(priced(df, tier_rows(spark), settings)) == dict(zip(keys, expected))


# Limits at which days, windows, and parts of windows become the blocks.
@pytest.mark.parametrize("rows_per_block", [0, 1, 3, 40])
@pytest.mark.parametrize("negative", [False, True])
def test_blocks_give_the_same_totals_as_whole_keys(spark, negative, rows_per_block):
    rows = distinct(random_rows(3, 600))
    if negative:
        rows = [(*r[:5], r[5] - 2, r[6]) for r in rows]
    df = increments(spark, rows)
    earlier = spark.createDataFrame(
        [("ua", "logo", "proj", 1, 1, "2019-12", 3, 4, 5), ("ua", "logo", "proj", 1, 2, "2020-02", 7, 8, 1),
         ("ub", "logo", "proj", 1, 3, "2020-01", 1, 100, 9), ("zz", "logo", "proj", 1, 3, "2020-01", 1, 1, 1)],
        "user_id string, user_logo string, user_project string, api_id bigint, charge_type int, "
        "access_month string, access_count bigint, access_flow bigint, deal_count bigint",
    )
    whole = running_charge_totals(df, TEN_FREE, earlier)
    settings = replace(TEN_FREE, heavy_key_rows=rows_per_block)
    blocks = running_charge_totals(df, settings, earlier)
    columns = sorted(whole.columns)
    assert sorted(blocks.columns) == columns
    rows_of = lambda d: sorted(map(tuple, d.select(*columns).collect()))
    assert rows_of(blocks) == rows_of(whole)


def test_no_block_of_a_crowded_window_is_over_the_limit(spark):
    df = increments(spark, [("u", 1, 0, 1, 1, 1, app) for app in range(2000)])
    blocks = running._with_blocks(df.withColumn("arrival", F.lit(1)), 20)
    sizes = [r["count"] for r in blocks.groupBy(*running.PLACE).count().collect()]
    assert sum(sizes) == 2000 and max(sizes) <= 40 and sum(size <= 20 for size in sizes) >= 0.95 * len(sizes)


def test_only_large_keys_go_into_blocks(spark):
    rows = [("big", 1, day, 1, 1, 1) for day in range(40)] + [("small", 1, 3, 1, 1, 1)]
    df = increments(spark, rows)
    mixed = running_charge_totals(df, replace(TEN_FREE, heavy_key_rows=5))
    plain = running_charge_totals(df, TEN_FREE)
    columns = plain.columns
    assert sorted(map(tuple, mixed.select(*columns).collect())) == sorted(map(tuple, plain.collect()))
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "LeftAnti" in plan


def split_of(spark, *rows):
    totals = running_charge_totals(increments(spark, rows), TEN_FREE)
    return [
        (r.is_free, r.paid_prev, r.paid_new)
        for r in free_allowance_split(totals, TEN_FREE).orderBy("window_start").collect()
    ]


def test_allowance_is_granted_once_per_lifetime(spark):
    # day 0: 6 of 10 used; day 1: 4 more, still free; day 2: all paid;
    # day 40: a later month, counters start again, no new allowance
    assert split_of(
        spark, ("u", 1, 0, 1, 0, 6), ("u", 1, 1, 1, 0, 4), ("u", 1, 2, 1, 0, 3), ("u", 1, 40, 1, 0, 2)
    ) == [(True, 0, 0), (True, 0, 0), (False, 0, 3), (False, 0, 2)]


def test_straddling_increment_pays_beyond_the_allowance(spark):
    assert split_of(spark, ("u", 1, 0, 1, 0, 8), ("u", 1, 1, 1, 0, 7), ("u", 1, 2, 1, 0, 1)) == [
        (True, 0, 0), (False, 0, 5), (False, 5, 6)
    ]


def test_empty_increment_stays_free_at_the_edge(spark):
    assert split_of(spark, ("u", 1, 0, 1, 0, 10), ("u", 1, 1, 1, 0, 0), ("u", 1, 2, 1, 0, 1)) == [
        (True, 0, 0), (True, 0, 0), (False, 0, 1)
    ]


def test_frequency_counts_paid_calls_and_flow_counts_all(spark):
    rows = [("u", 2, 0, 3, 0, 10), ("u", 2, 1, 4, 0, 1), ("u", 2, 2, 2, 0, 1),
            ("v", 3, 0, 1, 5, 10), ("v", 3, 1, 1, 7, 1)]
    result = counted(increments(spark, rows), TEN_FREE).orderBy("user_id", "window_start")
    assert [(r.counter_prev, r.counter_new) for r in result.collect()] == [
        (0, 3), (0, 4), (4, 6), (0, 5), (5, 12)
    ]


def lines_of(spark, row_list, rule_df, settings=NONE_FREE):
    matched = tiers.match_tiers(counted(increments(spark, row_list), settings), rule_df, settings)
    return [
        (r.charge_id, r.units)
        for r in tiers.tier_lines(matched).orderBy("window_start", "lower_limit").collect()
    ]


def test_one_increment_over_three_tiers(spark):
    assert lines_of(spark, [("u", 2, 0, 12, 0, 1)], tier_rows(spark)) == [(4, 3), (5, 5), (6, 4)]


def test_increment_that_ends_on_a_limit_stays_in_the_tier(spark):
    assert lines_of(spark, [("u", 2, 0, 3, 0, 1), ("u", 2, 1, 5, 0, 1)], tier_rows(spark)) == [(4, 3), (5, 5)]


def test_tiers_apply_in_order_of_their_limits(spark):
    shuffled = rules(spark, (9, 2, 1, 100, 4, 8), (1, 2, 1, 100, 9, 99), (5, 2, 1, 100, 1, 3))
    charges = priced(increments(spark, [("u", 2, 0, 10, 0, 1)]), shuffled, NONE_FREE)
    assert charges.first().charge_id == 1


def test_units_between_tiers_are_not_billed(spark):
    gap = rules(spark, (1, 2, 1, 100, 1, 2), (2, 2, 1, 100, 6, 20))
    assert lines_of(spark, [("u", 2, 0, 8, 0, 1)], gap) == [(1, 2), (2, 3)]


def test_no_rule_is_billed_with_nothing_and_reported(spark):
    charges = priced(increments(spark, [("u", 3, 0, 2, 5, 1)]), rules(spark, (1, 1, 1, 100, 1, 9)), NONE_FREE)
    row = charges.first()
    assert (row.access_count, row.access_flow, row.access_money, row.charge_id) == (2, 5, 0.0, 0)
    assert tiers.missing_charge_rule(charges).count() == 1


def test_small_prices_are_exact(spark):
    tiny = rules(spark, (1, 2, 0.0000004, 50, 1, 10**9))
    matched = tiers.match_tiers(counted(increments(spark, [("u", 2, 0, 7, 0, 1)]), NONE_FREE), tiny, NONE_FREE)
    assert tiers.tier_lines(matched).first().amount == Decimal("0.0000014")
    # Ten million calls at half of it are two units.
    charges = priced(increments(spark, [("u", 2, 0, 10_000_000, 0, 1)]), tiny, NONE_FREE)
    assert charges.first().access_money == 2.0


def test_prices_with_too_many_digits_are_reported_and_not_rounded(spark):
    odd = rules(spark, (1, 2, 1 / 3, 100, 1, 9), (2, 2, 0.25, 100, 10, 99))
    assert [r.id for r in unfit_rules(odd).collect()] == [1]
    with pytest.raises(Exception, match="too many digits: 1"):
        priced(increments(spark, [("u", 2, 0, 4, 0, 1)]), odd, NONE_FREE).collect()


def test_rule_order_of_a_later_batch_is_above_all_windows(spark):
    millis = replace(NONE_FREE, window_ms=1)
    first = priced(increments(spark, [("u", 2, 9000, 1, 0, 1)]), tier_rows(spark), millis, batch_id=0)
    later = priced(increments(spark, [("u", 2, 0, 1, 0, 1)]), tier_rows(spark), millis, batch_id=1)
    assert first.first().charge_order < later.first().charge_order


def test_rule_order_has_room_for_a_billion_batches(spark):
    seconds = replace(NONE_FREE, window_ms=1000)
    rows = increments(spark, [("u", 2, 9000, 1, 0, 1)])
    orders = [priced(rows, tier_rows(spark), seconds, batch_id=n).first().charge_order for n in (0, 10**9, 10**9 + 1)]
    assert None not in orders and orders == sorted(set(orders))


def test_inactive_rules_are_ignored(spark):
    both = rules(spark, (1, 2, 1, 100, 1, 99)).unionAll(
        rules(spark, (2, 2, 50, 100, 1, 99)).withColumn("status", F.lit(0))
    )
    assert lines_of(spark, [("u", 2, 0, 4, 0, 1)], both) == [(1, 4)]


def test_compat_counts_one_unit_more_at_a_lower_limit(spark):
    # The second increment starts with the counter at 4, the lower limit of
    # the second tier, and fills that tier.
    rows = [("u", 2, 0, 4, 0, 1), ("u", 2, 1, 4, 0, 1)]
    fixed = lines_of(spark, rows, tier_rows(spark))
    compat = lines_of(spark, rows, tier_rows(spark), replace(NONE_FREE, compat=True))
    assert fixed == [(4, 3), (5, 1), (5, 4)]
    assert compat == [(4, 3), (5, 1), (5, 5)]


def test_compat_advances_flow_by_calls(spark):
    rows = [("u", 3, 0, 2, 9, 1)]
    assert lines_of(spark, rows, tier_rows(spark)) == [(7, 9)]
    assert lines_of(spark, rows, tier_rows(spark), replace(NONE_FREE, compat=True)) == [(7, 2)]


def test_compat_measures_a_filled_flow_tier_from_the_call_counter(spark):
    # Flow 8 so far, calls 3 so far; four more calls take the counter to 12,
    # over the upper limit 10 of the first tier: 10 - 3 and 12 - 10 units.
    rows = [("u", 3, 0, 3, 8, 1), ("u", 3, 1, 4, 50, 1)]
    compat = lines_of(spark, rows, tier_rows(spark), replace(NONE_FREE, compat=True))
    assert compat == [(7, 3), (7, 7), (8, 2)]


def test_compat_bills_units_between_tiers(spark):
    gap = rules(spark, (1, 2, 1, 100, 1, 2), (2, 2, 1, 100, 6, 20))
    settings = replace(NONE_FREE, compat=True)
    assert lines_of(spark, [("u", 2, 0, 8, 0, 1)], gap, settings) == [(1, 2), (2, 6)]


def test_money_is_rounded_half_up_and_then_to_even(spark):
    values = [("0", 0), ("0.49", 0), ("0.5", 2), ("1.2", 2), ("1.5", 2), ("2.49", 2), ("2.5", 4), ("3", 4)]
    df = spark.createDataFrame([(v,) for v, _ in values], "v string")
    got = df.select(round_to_even_unit(F.col("v").cast("decimal(38,8)")).alias("r")).collect()
    assert [r.r for r in got] == [r for _, r in values]


def test_split_increments_keep_their_units(spark):
    whole = lines_of(spark, [("u", 1, 0, 1, 0, 20)], tier_rows(spark))
    parts = lines_of(spark, [("u", 1, 0, 1, 0, 9), ("u", 1, 1, 1, 0, 11)], tier_rows(spark))
    total = lambda lines: {k: sum(u for i, u in lines if i == k) for k, _ in lines}
    assert total(whole) == total(parts)


def test_bills_agree_with_each_other(spark):
    charges = priced(increments(spark, distinct(random_rows(5))), tier_rows(spark), TEN_FREE)
    names = ["access_count", "access_money", "access_flow", "deal_count"]
    total = lambda df: tuple(df.agg(*[F.sum(n) for n in names]).first())
    tables = [
        rollup.user_charging_day(charges), rollup.user_charging_month(charges),
        rollup.project_charging_day(charges), rollup.project_charging_month(charges),
    ]
    assert len({total(df) for df in tables}) == 1


def measured(spark, **changes):
    row = dict(user_id="7", user_project="proj", status=1, api_type=1, in_param="{}", api_id=1, app_id=1)
    row.update(changes)
    return spark.createDataFrame(
        [tuple(row.values())],
        "user_id string, user_project string, status int, api_type int, in_param string, api_id bigint, app_id bigint",
    )


@pytest.mark.parametrize(
    "in_param, project, free",
    [
        ('{"accessProject":"my proj 1"}', "proj", True),
        ('{"accessProject":"other"}', "proj", False),
        ('{"accessProject":["proj"]}', "proj", True),
        ('{"accessProject":null}', "proj", False),
        ("{}", "proj", False),
        ("userId=1", "proj", False),
        ("", "proj", False),
        ('{"accessProject":"other"}', "", True),
    ],
)
def test_own_project_is_free(spark, in_param, project, free):
    row = free_by_project(measured(spark, in_param=in_param, user_project=project)).first()
    assert row.project_free is free


@pytest.mark.parametrize(
    "changes, kept",
    [
        ({}, 1),
        ({"status": 0}, 0),
        ({"api_type": 0}, 0),
        ({"user_id": "-1"}, 0),
        ({"user_id": "-"}, 0),
        ({"user_id": "1"}, 0),
        ({"in_param": '{"accessProject":"proj"}'}, 0),
    ],
)
def test_what_is_charged(spark, changes, kept):
    assert chargeable_increments(measured(spark, **changes)).count() == kept


def test_allowance_formula_equals_counting_deals(spark):
    rng = random.Random(11)
    cases = [
        (rng.randrange(0, 30), rng.randrange(0, 30), rng.randrange(0, 30)) for _ in range(2000)
    ]
    df = spark.createDataFrame(
        [(b + m, m, d) for b, m, d in cases], "prior_deals bigint, month_deals bigint, sum_deal bigint"
    )
    got = free_allowance_split(df, TEN_FREE).select("paid_prev", "paid_new").collect()

    def beyond(first, count):
        return sum(1 for deal in range(first + 1, first + count + 1) if deal > 10)

    expected = [(beyond(b, m), beyond(b, m) + beyond(b + m, d)) for b, m, d in cases]
    assert [tuple(r) for r in got] == expected


@pytest.mark.parametrize("kind", [1, 2, 3])
def test_tiers_that_cover_everything_bill_every_unit(spark, kind):
    rows = [r for r in distinct(random_rows(7)) if r[1] == kind]
    matched = tiers.match_tiers(counted(increments(spark, rows), TEN_FREE), tier_rows(spark), TEN_FREE)
    sums = (
        tiers.tier_lines(matched)
        .groupBy("user_id", "window_start", "app_id")
        .agg(
            F.sum(F.coalesce("units", F.lit(0))).alias("billed"),
            F.first(F.col("counter_new") - F.col("counter_prev")).alias("used"),
        )
    )
    assert sums.count() > 0
    assert sums.filter("billed <> used").count() == 0


def test_a_bill_in_two_runs_equals_the_bill_in_one(spark):
    df = increments(spark, distinct(random_rows(13)))
    one = priced(df, tier_rows(spark), TEN_FREE)
    early = priced(df.filter("access_month < '2020-03'"), tier_rows(spark), TEN_FREE)
    totals = rollup.charged_totals_month(rollup.user_charging_day(early))
    late = priced(df.filter("access_month >= '2020-03'"), tier_rows(spark), TEN_FREE, totals, batch_id=1)
    assert {**bill(early), **bill(late)} == bill(one)


def test_long_price_lists_are_not_broadcast_by_hand(spark, monkeypatch):
    df = counted(increments(spark, [("u", 2, 0, 12, 0, 1)]), NONE_FREE)
    short = tiers.match_tiers(df, tier_rows(spark), NONE_FREE)
    monkeypatch.setattr(tiers, "BROADCAST_RULES", 2)
    long = tiers.match_tiers(df, tier_rows(spark), NONE_FREE)
    hinted = lambda d: "strategy=broadcast" in d._jdf.queryExecution().analyzed().toString()
    assert hinted(short) and not hinted(long)
    assert short.drop("lines").columns == long.drop("lines").columns
    assert [r.lines for r in short.collect()] == [r.lines for r in long.collect()]
