"""The same queries as DuckDB SQL over the same tables.

Written apart from the operators: the free allowance by its three cases, tier
lookup as a range join, running totals as plain windows over whole keys.
"""

from __future__ import annotations

from callmeter.schema import ACCESS_FIELDS
from callmeter.sources.workload import FINE_RULES, SAMPLE_RULES

ALLOWANCE = 500

_QUOTED = ", ".join(f'"{name}"' for name, _, _ in ACCESS_FIELDS)

_BILLING_LOG = """
access_log AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   CAST(round(l_extendedprice * 100) AS BIGINT)) AS log_id,
         CASE u WHEN 0 THEN '-1' WHEN 2 THEN '-' ELSE CAST(u AS VARCHAR) END AS "userId",
         'logo_' || (u % 5) AS "userLogo",
         'proj_' || (u % 7) AS "userProject",
         CAST(l_linenumber % 2 AS BIGINT) AS "appId",
         CASE WHEN l_linenumber = 7 THEN '  ' ELSE 'app_' || l_linenumber END AS "appCode",
         CAST(l_partkey % 3 AS BIGINT) AS "apiId",
         '/data/api' || (l_partkey % 3) AS "url",
         CAST(CASE WHEN l_suppkey % 10 = 0 THEN 0 ELSE 1 END AS INTEGER) AS "apiType",
         CASE l_suppkey % 4
           WHEN 0 THEN '{"accessProject":"proj_' || (u % 7) || '"}'
           WHEN 1 THEN '{"accessProject":"other"}'
           WHEN 2 THEN '{}'
           ELSE 'userId=1' END AS "inParam",
         CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS "useTime",
         '10.0.0.' || (l_suppkey % 256) AS "ip",
         CAST(ms AS VARCHAR) AS "addTime",
         CAST(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS INTEGER) AS "status",
         CASE WHEN l_returnflag = 'R' THEN 'failed' ELSE 'success' END AS "message",
         'key_' || o_custkey AS "accessKey",
         CAST(l_partkey % 3 + 1 AS INTEGER) AS "chargeType",
         CAST(floor(l_extendedprice / 1000) AS BIGINT) AS "accessFlow",
         CAST(l_quantity AS BIGINT) AS "dealCount",
         ms AS add_time_ms
  FROM (SELECT *, o_custkey % 12 AS u,
               epoch_ms(date_trunc('week', l_shipdate)) + (l_suppkey % 5) * 20000 AS ms
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
)"""

_EVENTS_LOG = """
access_log AS (
  SELECT CAST(event_id AS VARCHAR) AS log_id,
         CAST(user_id AS VARCHAR) AS "userId",
         'logo_' || (user_id % 5) AS "userLogo",
         'proj_' || (user_id % 7) AS "userProject",
         CAST(user_id % 4 AS BIGINT) AS "appId",
         'app' AS "appCode",
         CAST(1 AS BIGINT) AS "apiId",
         '/data/api1' AS "url",
         CAST(CASE WHEN event_type = 'view' THEN 0 ELSE 1 END AS INTEGER) AS "apiType",
         props AS "inParam",
         '1' AS "useTime",
         '10.0.0.1' AS "ip",
         CAST(epoch_us(ts) // 1000 AS VARCHAR) AS "addTime",
         CAST(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS INTEGER) AS "status",
         'success' AS "message",
         'key' AS "accessKey",
         CAST(user_id % 3 + 1 AS INTEGER) AS "chargeType",
         CAST(floor(value * 10) AS BIGINT) AS "accessFlow",
         CAST(floor(value) AS BIGINT) AS "dealCount",
         epoch_us(ts) // 1000 AS add_time_ms
  FROM events
)"""

_INCREMENTS = """
increments AS (
  SELECT *, strftime(make_timestamp(add_time * 1000), '%Y-%m-%d') AS access_day,
         strftime(make_timestamp(add_time * 1000), '%Y-%m') AS access_month
  FROM (
    SELECT add_time_ms // 60000 * 60000 AS window_start, "userId" AS user_id, "apiId" AS api_id,
           "appId" AS app_id, "status" AS status, "inParam" AS in_param,
           count(*) AS call_count,
           CAST(sum("accessFlow") AS BIGINT) AS sum_flow,
           CAST(sum("dealCount") AS BIGINT) AS sum_deal,
           first("userLogo" ORDER BY add_time_ms, "userLogo", "userProject", "apiType", "chargeType") AS user_logo,
           first("userProject" ORDER BY add_time_ms, "userLogo", "userProject", "apiType", "chargeType") AS user_project,
           first("apiType" ORDER BY add_time_ms, "userLogo", "userProject", "apiType", "chargeType") AS api_type,
           first("chargeType" ORDER BY add_time_ms, "userLogo", "userProject", "apiType", "chargeType") AS charge_type,
           min(add_time_ms) AS add_time
    FROM access_log
    GROUP BY 1, 2, 3, 4, 5, 6)
)"""

_MEASURES = """
measures AS (
  SELECT *, call_count AS access_count,
         CASE WHEN status = 1 THEN call_count ELSE 0 END AS success_count,
         CASE WHEN status = 1 THEN sum_flow ELSE 0 END AS access_flow,
         CASE WHEN status = 1 THEN sum_deal ELSE 0 END AS deal_count
  FROM increments
)"""

_PROJECT_FREE = """
project_free AS (
  SELECT *, CASE WHEN json_valid(in_param)
                 THEN coalesce(contains(json_extract_string(in_param, '$.accessProject'), user_project), false)
                 ELSE false END AS project_free
  FROM increments
)"""

_CHARGEABLE = """
chargeable AS (
  SELECT * EXCLUDE (project_free),
         CAST('0x' || substr(md5(concat_ws('|', user_id, api_id, app_id, in_param)), 1, 15) AS BIGINT) AS seq_hash
  FROM project_free
  WHERE api_type = 1 AND status = 1 AND NOT project_free AND user_id NOT IN ('-1', '-', '1')
)"""

def _rules(rules: tuple) -> str:
    return f"""
charge_rule(id, spend_type, unit_price, is_discount, discount, lower_limit, upper_limit, status) AS (
  SELECT CAST(a AS BIGINT), CAST(b AS INTEGER), CAST(c AS DOUBLE), CAST(d AS INTEGER),
         CAST(e AS BIGINT), CAST(f AS BIGINT), CAST(g AS BIGINT), CAST(h AS INTEGER)
  FROM (VALUES {", ".join(map(str, rules))}) AS t(a, b, c, d, e, f, g, h)
)"""


_RULES = _rules(SAMPLE_RULES)

_KEY = "user_id, user_logo, user_project, api_id, charge_type"
_ORDER = "window_start, seq_hash, app_id, in_param"
_INCREMENT = (
    "window_start, user_id, user_logo, user_project, api_id, charge_type, app_id, in_param"
)


def _prior(value: str, keys: str) -> str:
    return (
        f"CAST(coalesce(sum({value}) OVER (PARTITION BY {keys} ORDER BY {_ORDER} "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)"
    )


_RUNNING = f"""
consumed AS (
  SELECT *, {_prior("sum_deal", _KEY)} AS prior_deals,
         {_prior("sum_deal", _KEY + ", access_month")} AS month_deals,
         {_prior("sum_flow", _KEY + ", access_month")} AS month_flow
  FROM chargeable
),
freed AS (
  SELECT *, prior_deals + sum_deal <= {ALLOWANCE} AS is_free FROM consumed
),
running AS (
  SELECT *, {_prior("CASE WHEN is_free THEN 0 ELSE call_count END", _KEY + ", access_month")} AS month_calls
  FROM freed
)"""

# paid_prev and paid_new case by case.  In the free case nothing is paid yet
# this month, unless deals before the month already exceeded the allowance,
# which cannot be while the increment is free.
_SPLIT = f"""
split AS (
  SELECT *,
         CASE WHEN is_free THEN 0
              WHEN prior_deals > {ALLOWANCE} THEN
                month_deals - CASE WHEN prior_deals - month_deals >= {ALLOWANCE} THEN 0
                                   ELSE {ALLOWANCE} - (prior_deals - month_deals) END
              ELSE 0 END AS paid_prev,
         CASE WHEN is_free THEN 0
              WHEN prior_deals > {ALLOWANCE} THEN
                sum_deal + month_deals - CASE WHEN prior_deals - month_deals >= {ALLOWANCE} THEN 0
                                              ELSE {ALLOWANCE} - (prior_deals - month_deals) END
              ELSE sum_deal - ({ALLOWANCE} - prior_deals) END AS paid_new
  FROM running
)"""


def _counters(flow_step: str) -> str:
    return f"""
counters AS (
  SELECT *,
         CASE charge_type WHEN 2 THEN month_calls WHEN 1 THEN paid_prev ELSE month_flow END AS counter_prev,
         CASE charge_type WHEN 2 THEN month_calls + call_count WHEN 1 THEN paid_new
                          ELSE month_flow + {flow_step} END AS counter_new
  FROM split
)"""


def _lines(spend_types: str = "1, 2, 3") -> str:
    return f"""
touched AS (
  SELECT c.*, r.id AS charge_id, r.lower_limit, r.upper_limit,
         CAST(CAST(r.unit_price AS DECIMAL(17,10)) * CAST(r.discount AS DECIMAL(5,0)) * 0.01 AS DECIMAL(19,12)) AS rate
  FROM counters c LEFT JOIN charge_rule r
    ON r.spend_type = c.charge_type AND r.spend_type IN ({spend_types}) AND r.status = 1
   AND r.lower_limit <= c.counter_new AND r.upper_limit >= c.counter_prev + 1
  WHERE NOT c.is_free
)"""


_UNITS = """
lines AS (
  SELECT *, CAST(CAST(units AS DECIMAL(18,0)) * rate AS DECIMAL(38,12)) AS amount
  FROM (SELECT *, CASE WHEN charge_id IS NOT NULL
                       THEN least(counter_new, upper_limit) - greatest(counter_prev, lower_limit - 1) END AS units
        FROM touched)
)"""

_UNITS_COMPAT = f"""
walked AS (
  SELECT *, lag(upper_limit, 1, counter_prev) OVER (PARTITION BY {_INCREMENT} ORDER BY lower_limit) AS counter
  FROM touched
),
lines AS (
  SELECT *, CAST(CAST(units AS DECIMAL(18,0)) * rate AS DECIMAL(38,12)) AS amount
  FROM (SELECT *,
          CASE WHEN charge_id IS NULL THEN NULL ELSE CASE charge_type
            WHEN 2 THEN
              CASE WHEN counter_new >= upper_limit AND counter <= lower_limit THEN upper_limit - lower_limit + 1
                   WHEN counter_new >= upper_limit THEN upper_limit - counter
                   ELSE counter_new - counter END
            WHEN 1 THEN
              CASE WHEN counter_new >= upper_limit AND counter < lower_limit THEN upper_limit - lower_limit + 1
                   WHEN counter_new >= upper_limit THEN upper_limit - counter
                   ELSE counter_new - counter END
            ELSE
              CASE WHEN counter_new >= upper_limit AND counter <= lower_limit THEN upper_limit - lower_limit + 1
                   WHEN counter_new >= upper_limit THEN upper_limit - month_calls
                   ELSE counter_new - counter END
          END END AS units
        FROM walked)
)"""

_CHARGES = f"""
sums AS (
  SELECT {_INCREMENT}, sum(amount) AS money, coalesce(arg_max(charge_id, lower_limit), 0) AS charge_id
  FROM lines GROUP BY {_INCREMENT}
),
rounded AS (
  SELECT *, CAST(floor(CAST(coalesce(money, 0) AS DECIMAL(37,12)) + 0.5) AS BIGINT) AS whole FROM sums
),
charges AS (
  SELECT c.*, CASE WHEN c.is_free THEN 0 ELSE c.call_count END AS access_count,
         c.sum_flow AS access_flow, c.sum_deal AS deal_count,
         CAST(coalesce(whole + abs(whole % 2), 0) AS DOUBLE) AS access_money,
         coalesce(r.charge_id, 0) AS charge_id,
         CAST(c.window_start // 60000 AS HUGEINT) * 10000000000000000000 + c.seq_hash AS charge_order
  FROM counters c LEFT JOIN rounded r USING ({_INCREMENT})
)"""


def _with(*parts: str, select: str) -> str:
    return "WITH" + ",".join(parts) + "\n" + select


_METERED = (_BILLING_LOG, _INCREMENTS)
_CHARGED = (*_METERED, _PROJECT_FREE, _CHARGEABLE)
_COUNTED = (*_CHARGED, _RUNNING, _SPLIT, _counters("sum_flow"))
_COUNTED_COMPAT = (*_CHARGED, _RUNNING, _SPLIT, _counters("call_count"))
_PRICED = (*_COUNTED, _RULES, _lines(), _UNITS, _CHARGES)
_PRICED_COMPAT = (*_COUNTED_COMPAT, _RULES, _lines(), _UNITS_COMPAT, _CHARGES)

_SUMS = """CAST(sum(access_count) AS BIGINT) AS access_count, arg_max(charge_id, charge_order) AS charge_id,
       sum(access_money) AS access_money, CAST(sum(access_flow) AS BIGINT) AS access_flow,
       CAST(sum(deal_count) AS BIGINT) AS deal_count"""
_TOTALS = """CAST(sum(access_count) AS BIGINT) AS access_count,
       CAST(sum(access_flow) AS BIGINT) AS access_flow, CAST(sum(deal_count) AS BIGINT) AS deal_count"""
_USAGE = """CAST(sum(access_count) AS BIGINT) AS access_count, CAST(sum(success_count) AS BIGINT) AS success_count,
       CAST(sum(access_flow) AS BIGINT) AS access_flow, CAST(sum(deal_count) AS BIGINT) AS deal_count"""

_SPARSE = ", ".join(
    f"CASE WHEN regexp_matches(CAST(\"{name}\" AS VARCHAR), '\\S') THEN CAST(\"{name}\" AS VARCHAR) END AS \"{column}\""
    for name, _, column in ACCESS_FIELDS
)
_ROW_KEY = """substr(md5(k), 1, 2) || '_' || k"""
_KEYED = """
keyed AS (
  SELECT *, concat_ws('_', "userId", "apiId", "appId", "addTime") AS k FROM access_log
)"""
_SPARSE_ROWS = f"""
sparse AS (
  SELECT {_ROW_KEY} AS rowkey, substr(md5(k), 1, 2) AS salt, {_SPARSE}, log_id FROM keyed
)"""
_LATEST = ", ".join(
    f'arg_max("{column}", log_id) FILTER (WHERE "{column}" IS NOT NULL) AS "{column}"'
    for _, _, column in ACCESS_FIELDS
)
_LINE = "to_json({" + ", ".join(f"'{name}': \"{name}\"" for name, _, _ in ACCESS_FIELDS) + "})"

_CHARGE = (
    f"{_INCREMENT}, is_free, access_count, access_flow, deal_count, access_money, charge_id"
)

_EVENT_INCREMENTS = (_EVENTS_LOG, _INCREMENTS)

_USER_USAGE = f"""SELECT user_id, user_logo, user_project, api_id, app_id, access_day, {_USAGE}
FROM measures GROUP BY ALL"""

def _sliced(sql: str, cuts: tuple[int, ...]) -> str:
    """The same bill when increments are cut at some times, also inside a window."""
    slices = " + ".join(f"CAST(add_time_ms >= {cut} AS BIGINT)" for cut in cuts)
    window = "SELECT add_time_ms // 60000 * 60000 AS window_start, \"userId\""
    order = "CAST(c.window_start // 60000 AS HUGEINT)"
    for old, new in (
        (window, window.replace("SELECT", f"SELECT {slices} AS slice,")),
        ("GROUP BY 1, 2, 3, 4, 5, 6)", "GROUP BY 1, 2, 3, 4, 5, 6, 7)"),
        (_ORDER, f"slice, {_ORDER}"),
        (_INCREMENT, f"slice, {_INCREMENT}"),
        (order, f"(CAST(slice AS HUGEINT) * 1000000000 + c.window_start // 60000)"),
    ):
        assert old in sql
        sql = sql.replace(old, new)
    return sql


# Two cuts, each thirty seconds into a window.
_SPLIT_CUTS = (865814430000, 937785630000)

ORACLE_SQL: dict[str, str] = {
    "access_log_parse": _with(
        _BILLING_LOG, select=f"SELECT log_id, {_QUOTED}, add_time_ms FROM access_log"
    ),
    "quarantined_records": _with(
        _BILLING_LOG,
        select=f"""
SELECT CASE kind WHEN 0 THEN substr(line, 1, length(line) - 1)
                 WHEN 1 THEN regexp_replace(line, '"appId":([0-9]+)', '"appId":"x\\1"')
                 WHEN 2 THEN regexp_replace(line, '"dealCount":', '"dealcount":')
                 WHEN 3 THEN regexp_replace(line, '"accessFlow":[0-9]+', '"accessFlow":" "')
                 WHEN 4 THEN line || line WHEN 5 THEN line || ' junk' WHEN 6 THEN line || '] junk'
                 WHEN 7 THEN line || '],[{{"x":1}}' WHEN 8 THEN line || ',' || line
                 ELSE line || '],"x":[{{}}' END AS value,
       CASE kind WHEN 1 THEN 'not a number: appId' WHEN 2 THEN 'missing dealCount'
                 WHEN 3 THEN 'not a number: accessFlow' ELSE 'malformed' END AS reject_reason
FROM (SELECT CAST({_LINE} AS VARCHAR) AS line, "dealCount" % 32 AS kind FROM access_log)
WHERE kind < 10""",
    ),
    "access_log_rowkey": _with(
        _BILLING_LOG,
        _KEYED,
        select=f"SELECT log_id, {_ROW_KEY} AS rowkey, substr(md5(k), 1, 2) AS salt FROM keyed",
    ),
    "raw_log_sparse": _with(_BILLING_LOG, _KEYED, _SPARSE_ROWS, select="SELECT * FROM sparse"),
    "raw_log_upsert": _with(
        _BILLING_LOG,
        _KEYED,
        _SPARSE_ROWS,
        select=f"SELECT rowkey, {_LATEST} FROM sparse GROUP BY rowkey",
    ),
    "period_buckets": _with(
        _EVENTS_LOG,
        select="""SELECT log_id, add_time_ms // 60000 * 60000 AS window_start,
       strftime(make_timestamp(add_time_ms * 1000), '%Y-%m-%d') AS access_day,
       strftime(make_timestamp(add_time_ms * 1000), '%Y-%m') AS access_month
FROM access_log""",
    ),
    "batch_row_counts": _with(
        _EVENTS_LOG,
        select="""SELECT add_time_ms // 60000 * 60000 AS window_start, count(*) AS row_count
FROM access_log GROUP BY 1""",
    ),
    "batch_preview": _with(
        _EVENTS_LOG,
        select=f"SELECT log_id, {_QUOTED} FROM access_log ORDER BY add_time_ms, log_id LIMIT 10",
    ),
    "access_increments": _with(*_METERED, select="SELECT * FROM increments"),
    "access_increments_sql": _with(*_METERED, select="SELECT * FROM increments"),
    "success_measures": _with(
        *_METERED,
        _MEASURES,
        select="""SELECT window_start, user_id, api_id, app_id, status, in_param,
       access_count, success_count, access_flow, deal_count FROM measures""",
    ),
    "user_access_statistics": _with(*_METERED, _MEASURES, select=_USER_USAGE),
    "project_access_statistics": _with(
        *_METERED,
        _MEASURES,
        select=f"""SELECT user_logo AS logo, user_project AS project, api_id, access_day, {_USAGE}
FROM measures GROUP BY ALL""",
    ),
    "free_by_project": _with(
        *_METERED,
        _PROJECT_FREE,
        select="""SELECT window_start, user_id, user_logo, user_project, api_id, app_id, in_param, status,
       project_free FROM project_free""",
    ),
    "chargeable_increments": _with(
        *_CHARGED,
        select=f"""SELECT {_INCREMENT}, seq_hash, call_count, sum_flow, sum_deal, access_day, access_month
FROM chargeable""",
    ),
    "active_charge_rules": _with(
        _BILLING_LOG,
        _RULES,
        select="""SELECT spend_type, log_calls, id, unit_price, is_discount, discount, lower_limit, upper_limit
FROM charge_rule JOIN (SELECT "chargeType" AS spend_type, count(*) AS log_calls FROM access_log GROUP BY 1)
  USING (spend_type)
WHERE status = 1""",
    ),
    "running_charge_totals": _with(
        *_CHARGED,
        _RUNNING,
        select=f"SELECT {_INCREMENT}, prior_deals, month_deals, month_flow, month_calls FROM running",
    ),
    "free_allowance_split": _with(
        *_CHARGED,
        _RUNNING,
        _SPLIT,
        select=f"""SELECT {_INCREMENT}, sum_deal, prior_deals, month_deals, is_free, paid_prev, paid_new
FROM split""",
    ),
    "charge_counters": _with(
        *_COUNTED, select=f"SELECT {_INCREMENT}, is_free, counter_prev, counter_new FROM counters"
    ),
    "tier_matches": _with(
        *_COUNTED,
        _RULES,
        _lines(),
        select=f"""SELECT {_INCREMENT}, counter_prev, counter_new, charge_id, lower_limit, upper_limit
FROM touched""",
    ),
    "tier_charges": _with(
        *_COUNTED,
        _RULES,
        _lines(),
        _UNITS,
        select=f"SELECT {_INCREMENT}, charge_id, units, CAST(amount AS DOUBLE) AS amount FROM lines",
    ),
    "tier_charges_compat": _with(
        *_COUNTED_COMPAT,
        _RULES,
        _lines(),
        _UNITS_COMPAT,
        select=f"SELECT {_INCREMENT}, charge_id, units, CAST(amount AS DOUBLE) AS amount FROM lines",
    ),
    "fine_prices": _with(
        *_COUNTED,
        _rules(FINE_RULES),
        _lines(),
        _UNITS,
        select=f"SELECT {_INCREMENT}, charge_id, units, CAST(amount AS VARCHAR) AS amount FROM lines",
    ),
    "increment_charges": _with(*_PRICED, select=f"SELECT {_CHARGE} FROM charges"),
    "increment_charges_compat": _with(*_PRICED_COMPAT, select=f"SELECT {_CHARGE} FROM charges"),
    "missing_charge_rule": _with(
        *_COUNTED,
        _RULES,
        _lines("1, 2"),
        _UNITS,
        _CHARGES,
        select=f"""SELECT {_INCREMENT}, access_money, charge_id FROM charges
WHERE NOT is_free AND charge_id = 0""",
    ),
    "user_charging_day": _with(
        *_PRICED, select=f"SELECT {_KEY}, access_day, {_SUMS} FROM charges GROUP BY ALL"
    ),
    "user_charging_month": _with(
        *_PRICED, select=f"SELECT {_KEY}, access_month, {_SUMS} FROM charges GROUP BY ALL"
    ),
    "project_charging_day": _with(
        *_PRICED,
        select=f"""SELECT user_logo AS logo, user_project AS project, api_id, charge_type, access_day, {_SUMS}
FROM charges GROUP BY ALL""",
    ),
    "project_charging_month": _with(
        *_PRICED,
        select=f"""SELECT user_logo AS logo, user_project AS project, api_id, charge_type, access_month, {_SUMS}
FROM charges GROUP BY ALL""",
    ),
    "charged_totals_lifetime": _with(
        *_PRICED, select=f"SELECT {_KEY}, {_TOTALS} FROM charges GROUP BY ALL"
    ),
    "charged_totals_month": _with(
        *_PRICED, select=f"SELECT {_KEY}, access_month, {_TOTALS} FROM charges GROUP BY ALL"
    ),
    "resumed_charging_month": _with(
        *_PRICED,
        select=f"""SELECT {_KEY}, access_month, {_SUMS} FROM charges
WHERE access_month >= '1998-07' GROUP BY ALL""",
    ),
    "stream_access_stats": _with(*_EVENT_INCREMENTS, _MEASURES, select=_USER_USAGE),
    "stream_charging": _with(
        *_PRICED, select=f"SELECT {_KEY}, access_month, {_SUMS} FROM charges GROUP BY ALL"
    ),
    "stream_archive": _with(
        _BILLING_LOG,
        _KEYED,
        _SPARSE_ROWS,
        select=f"SELECT rowkey, {_LATEST} FROM sparse GROUP BY rowkey",
    ),
    "stream_resumed": _with(
        *_PRICED, select=f"SELECT {_KEY}, access_month, {_SUMS} FROM charges GROUP BY ALL"
    ),
    "stream_charging_split": _with(
        *_PRICED, select=f"SELECT {_KEY}, access_month, {_SUMS} FROM charges GROUP BY ALL"
    ),
    "stream_charging_parts": _sliced(
        _with(*_PRICED, select=f"SELECT {_KEY}, access_month, {_SUMS} FROM charges GROUP BY ALL"), _SPLIT_CUTS
    ),
}
