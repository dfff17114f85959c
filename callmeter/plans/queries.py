"""Every operator as a query over the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callmeter.operators import archive, metering, parse, rollup, tiers
from callmeter.operators.allowance import charge_counters, free_allowance_split
from callmeter.operators.chargeable import free_by_project
from callmeter.operators.running import running_charge_totals
from callmeter.plans.billing import chargeable_log, counted, priced
from callmeter.schema import FIELD_NAMES
from callmeter.settings import Settings
from callmeter.sources.access_log import stream_lines
from callmeter.sources.charge_rules import active_rules
from callmeter.sources.stored import new_folder, shuffles_removed
from callmeter.sources.workload import (
    FINE_RULES,
    billing_log,
    damaged_lines,
    events_log,
    json_lines,
    sample_rules,
)
from callmeter.streaming.jobs import close_windows, start_metering
from callmeter.streaming.ledger import Ledger, archived_records, result_table

SETTINGS = Settings()
COMPAT = replace(SETTINGS, compat=True)

# Month from which the resumed bill is priced on top of earlier totals.
RESUME_MONTH = "1998-07"


def utc_ms(*date: int) -> int:
    return int(datetime(*date, tzinfo=timezone.utc).timestamp()) * 1000


# What names one increment of a bill.
INCREMENT = [
    "window_start",
    "user_id",
    "user_logo",
    "user_project",
    "api_id",
    "charge_type",
    "app_id",
    "in_param",
]


def access_log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = json_lines(billing_log(spark, sf_dir), "log_id")
    return parse.accepted(parse.parse_access_log(lines)).select(
        "log_id", *FIELD_NAMES, "add_time_ms"
    )


def quarantined_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = damaged_lines(billing_log(spark, sf_dir))
    return parse.quarantined(parse.parse_access_log(lines))


def access_log_rowkey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.row_keys(billing_log(spark, sf_dir)).select("log_id", "rowkey", "salt")


def raw_log_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.sparse_rows(billing_log(spark, sf_dir), "log_id")


def raw_log_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.latest_cells(archive.sparse_rows(billing_log(spark, sf_dir), "log_id"), "log_id")


def period_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metering.period_buckets(events_log(spark, sf_dir), SETTINGS).select(
        "log_id", "window_start", "access_day", "access_month"
    )


def batch_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metering.window_row_counts(events_log(spark, sf_dir), SETTINGS)


def batch_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metering.preview(events_log(spark, sf_dir)).select("log_id", *FIELD_NAMES)


def _increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metering.access_increments(billing_log(spark, sf_dir), SETTINGS)


def access_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _increments(spark, sf_dir)


def access_increments_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    metering.register_log(billing_log(spark, sf_dir))
    return metering.access_increments_sql(spark, SETTINGS)


def success_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metering.success_measures(_increments(spark, sf_dir)).select(
        "window_start",
        "user_id",
        "api_id",
        "app_id",
        "status",
        "in_param",
        "access_count",
        "success_count",
        "access_flow",
        "deal_count",
    )


def user_access_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metering.user_access_statistics(_increments(spark, sf_dir))


def project_access_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metering.project_access_statistics(_increments(spark, sf_dir))


def free_by_project_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return free_by_project(_increments(spark, sf_dir)).select(
        *[name for name in INCREMENT if name != "charge_type"], "status", "project_free"
    )


def chargeable_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chargeable_log(billing_log(spark, sf_dir), SETTINGS).select(
        *INCREMENT, "seq_hash", "call_count", "sum_flow", "sum_deal", "access_day", "access_month"
    )


def active_charge_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules in force for the charge types that occur in the log, with their calls."""
    calls = (
        billing_log(spark, sf_dir)
        .groupBy(F.col("chargeType").alias("spend_type"))
        .agg(F.count(F.lit(1)).alias("log_calls"))
    )
    return calls.join(active_rules(sample_rules(spark)), "spend_type")


def running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    chargeable = chargeable_log(billing_log(spark, sf_dir), SETTINGS)
    return running_charge_totals(chargeable, SETTINGS).select(
        *INCREMENT, "prior_deals", "month_deals", "month_flow", "month_calls"
    )


def allowance_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    chargeable = chargeable_log(billing_log(spark, sf_dir), SETTINGS)
    totals = running_charge_totals(chargeable, SETTINGS)
    return free_allowance_split(totals, SETTINGS).select(
        *INCREMENT, "sum_deal", "prior_deals", "month_deals", "is_free", "paid_prev", "paid_new"
    )


def charge_counters_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    chargeable = chargeable_log(billing_log(spark, sf_dir), SETTINGS)
    return counted(chargeable, SETTINGS).select(
        *INCREMENT, "is_free", "counter_prev", "counter_new"
    )


def _matched(
    spark: SparkSession, sf_dir: str, settings: Settings = SETTINGS, spend_types=(1, 2, 3)
) -> DataFrame:
    chargeable = chargeable_log(billing_log(spark, sf_dir), settings)
    return tiers.match_tiers(
        counted(chargeable, settings), sample_rules(spark, spend_types), settings
    )


def tier_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiers.tier_lines(_matched(spark, sf_dir)).select(
        *INCREMENT, "counter_prev", "counter_new", "charge_id", "lower_limit", "upper_limit"
    )


def tier_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiers.tier_lines(_matched(spark, sf_dir)).select(
        *INCREMENT, "charge_id", "units", F.col("amount").cast("double").alias("amount")
    )


def tier_charges_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiers.tier_lines(_matched(spark, sf_dir, COMPAT)).select(
        *INCREMENT, "charge_id", "units", F.col("amount").cast("double").alias("amount")
    )


def fine_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tier charges at prices far below a millionth, to the last digit."""
    chargeable = chargeable_log(billing_log(spark, sf_dir), SETTINGS)
    rules = sample_rules(spark, rules=FINE_RULES)
    lines = tiers.tier_lines(tiers.match_tiers(counted(chargeable, SETTINGS), rules, SETTINGS))
    return lines.select(*INCREMENT, "charge_id", "units", F.col("amount").cast("string").alias("amount"))


def _charges(
    spark: SparkSession, sf_dir: str, settings: Settings = SETTINGS, spend_types=(1, 2, 3)
) -> DataFrame:
    chargeable = chargeable_log(billing_log(spark, sf_dir), settings)
    return priced(chargeable, sample_rules(spark, spend_types), settings)


CHARGE = [*INCREMENT, "is_free", "access_count", "access_flow", "deal_count", "access_money", "charge_id"]


def increment_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _charges(spark, sf_dir).select(*CHARGE)


def increment_charges_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _charges(spark, sf_dir, COMPAT).select(*CHARGE)


def missing_charge_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Charges left without a rule when the price list has none for flow."""
    charges = _charges(spark, sf_dir, spend_types=(1, 2))
    return tiers.missing_charge_rule(charges).select(*INCREMENT, "access_money", "charge_id")


def user_charging_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.user_charging_day(_charges(spark, sf_dir))


def user_charging_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.user_charging_month(_charges(spark, sf_dir))


def project_charging_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.project_charging_day(_charges(spark, sf_dir))


def project_charging_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.project_charging_month(_charges(spark, sf_dir))


def charged_totals_lifetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.charged_totals_lifetime(user_charging_day(spark, sf_dir))


def charged_totals_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.charged_totals_month(user_charging_day(spark, sf_dir))


def resumed_charging_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices the log in two runs, the second on top of the totals of the first."""
    chargeable = chargeable_log(billing_log(spark, sf_dir), SETTINGS)
    rules = sample_rules(spark)
    first = priced(chargeable.filter(F.col("access_month") < RESUME_MONTH), rules, SETTINGS)
    earlier = rollup.charged_totals_month(rollup.user_charging_day(first))
    rest = chargeable.filter(F.col("access_month") >= RESUME_MONTH)
    return rollup.user_charging_month(priced(rest, rules, SETTINGS, earlier, batch_id=1))


# A compressed file is read by one task, so none holds many lines.
LINES_PER_FILE = 100_000


def _streamed(
    spark: SparkSession,
    log: DataFrame,
    cuts: list[int],
    rules: DataFrame | None,
    settings: Settings = SETTINGS,
    checkpoints: tuple[str, ...] = ("checkpoint",),
) -> Ledger:
    """Feeds the log to the streaming job as JSON lines, slice after slice.

    The slices end at the given times.  The job is started anew for each and
    goes on from its checkpoint, or with the next one where several are given.
    The lines are compressed, for those of all slices stay.
    """
    folder = new_folder(spark, "stream")
    ledger = Ledger(f"{folder}/ledger", snapshot_every=2)
    edges = [None, *cuts, None]
    for i, (start, end) in enumerate(zip(edges, edges[1:])):
        part = log
        if start is not None:
            part = part.filter(F.col("add_time_ms") >= start)
        if end is not None:
            part = part.filter(F.col("add_time_ms") < end)
        writer = json_lines(part).write.mode("append")
        with shuffles_removed(spark):
            writer.options(compression="gzip", maxRecordsPerFile=LINES_PER_FILE).text(f"{folder}/lines")
        lines = stream_lines(spark, f"{folder}/lines")
        checkpoint = f"{folder}/{checkpoints[i % len(checkpoints)]}"
        start_metering(lines, ledger, checkpoint, rules, settings, once=True).awaitTermination()
    if settings.carry_batches:
        close_windows(spark, ledger, rules, settings)
    return ledger


def stream_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive kept by the streaming job, with several puts of one row key in one slice.

    All records of a row key lie in one file, or in files that one task wrote
    one after another, in the order of their ids.
    """
    log = archive.row_keys(billing_log(spark, sf_dir, by_row_key=True))
    in_order = log.sortWithinPartitions("rowkey", "log_id")
    ledger = _streamed(spark, in_order, [utc_ms(1997, 6, 10)], rules=None)
    return archived_records(spark, ledger)


# Cuts inside a window of sixty seconds, thirty seconds after it began.
SPLIT_CUTS = (utc_ms(1997, 6, 9) + 30_000, utc_ms(1999, 9, 20) + 30_000)


def stream_charging_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly bills when micro-batches end inside windows, which are carried on until they have ended."""
    carrying = replace(SETTINGS, carry_batches=2)
    ledger = _streamed(spark, billing_log(spark, sf_dir), [*SPLIT_CUTS], sample_rules(spark), carrying)
    return result_table(spark, ledger, "user_charging_month")


def stream_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly bills when the job loses its checkpoint after each slice and finds all files anew."""
    cuts = [utc_ms(1997, 6, 10), utc_ms(1999, 9, 20)]
    lost = ("checkpoint-1", "checkpoint-2", "checkpoint-3")
    ledger = _streamed(spark, billing_log(spark, sf_dir), cuts, sample_rules(spark), checkpoints=lost)
    return result_table(spark, ledger, "user_charging_month")


def stream_charging_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same when windows that a micro-batch cuts are booked in parts."""
    ledger = _streamed(spark, billing_log(spark, sf_dir), [*SPLIT_CUTS], sample_rules(spark))
    return result_table(spark, ledger, "user_charging_month")


def stream_access_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage statistics from the streaming job, fed in slices of ten days."""
    cuts = [utc_ms(2024, 1, 11), utc_ms(2024, 1, 21)]
    ledger = _streamed(spark, events_log(spark, sf_dir), cuts, rules=None)
    return result_table(spark, ledger, "user_access_statistics")


def stream_charging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly bills from the streaming job, fed in slices of some years."""
    cuts = [utc_ms(1997, 6, 10), utc_ms(1999, 9, 20)]
    ledger = _streamed(spark, billing_log(spark, sf_dir), cuts, sample_rules(spark))
    return result_table(spark, ledger, "user_charging_month")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "access_log_parse": access_log_parse,
    "quarantined_records": quarantined_records,
    "access_log_rowkey": access_log_rowkey,
    "raw_log_sparse": raw_log_sparse,
    "raw_log_upsert": raw_log_upsert,
    "period_buckets": period_buckets,
    "batch_row_counts": batch_row_counts,
    "batch_preview": batch_preview,
    "access_increments": access_increments,
    "access_increments_sql": access_increments_sql,
    "success_measures": success_measures,
    "user_access_statistics": user_access_statistics,
    "project_access_statistics": project_access_statistics,
    "free_by_project": free_by_project_query,
    "chargeable_increments": chargeable_increments,
    "active_charge_rules": active_charge_rules,
    "running_charge_totals": running_totals,
    "free_allowance_split": allowance_split,
    "charge_counters": charge_counters_query,
    "tier_matches": tier_matches,
    "tier_charges": tier_charges,
    "tier_charges_compat": tier_charges_compat,
    "fine_prices": fine_prices,
    "increment_charges": increment_charges,
    "increment_charges_compat": increment_charges_compat,
    "missing_charge_rule": missing_charge_rule,
    "user_charging_day": user_charging_day,
    "user_charging_month": user_charging_month,
    "project_charging_day": project_charging_day,
    "project_charging_month": project_charging_month,
    "charged_totals_lifetime": charged_totals_lifetime,
    "charged_totals_month": charged_totals_month,
    "resumed_charging_month": resumed_charging_month,
    "stream_archive": stream_archive,
    "stream_access_stats": stream_access_stats,
    "stream_charging": stream_charging,
    "stream_charging_split": stream_charging_split,
    "stream_charging_parts": stream_charging_parts,
    "stream_resumed": stream_resumed,
}
