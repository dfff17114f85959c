"""Record layouts."""

from __future__ import annotations

from pyspark.sql import types as T

# Field of an access record, its type, its archive column.
ACCESS_FIELDS = (
    ("userId", "string", "user_id"),
    ("userLogo", "string", "user_logo"),
    ("userProject", "string", "user_project"),
    ("appId", "bigint", "app_id"),
    ("appCode", "string", "app_code"),
    ("apiId", "bigint", "api_id"),
    ("url", "string", "url"),
    ("apiType", "int", "api_type"),
    ("inParam", "string", "in_param"),
    ("useTime", "string", "use_time"),
    ("ip", "string", "ip"),
    ("addTime", "string", "add_time"),
    ("status", "int", "status"),
    ("message", "string", "message"),
    ("accessKey", "string", "access_key"),
    ("chargeType", "int", "chargeType"),
    ("accessFlow", "bigint", "accessFlow"),
    ("dealCount", "bigint", "dealCount"),
)

FIELD_NAMES = [name for name, _, _ in ACCESS_FIELDS]

# Every field is read as text first, so that "1" and 1 are both accepted.
RAW_RECORD = T.StructType([T.StructField(name, T.StringType()) for name in FIELD_NAMES])

# Grouping keys of one increment.
INCREMENT_KEYS = ["window_start", "user_id", "api_id", "app_id", "status", "in_param"]

# What the free allowance and the tier counters belong to.
CHARGE_KEY = ["user_id", "user_logo", "user_project", "api_id", "charge_type"]

# Order of the increments of one charge key.  seq_hash spreads a busy window
# evenly; seq_rest tells apart what it does not.
CHARGE_ORDER = ["window_start", "seq_hash", "seq_rest"]

CHARGE_RULE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("spend_type", T.IntegerType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("is_discount", T.IntegerType()),
        T.StructField("discount", T.LongType()),
        T.StructField("lower_limit", T.LongType()),
        T.StructField("upper_limit", T.LongType()),
        T.StructField("status", T.IntegerType()),
    ]
)

# Totals already charged, one row per charge key and month.
CHARGED_TOTALS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("user_logo", T.StringType()),
        T.StructField("user_project", T.StringType()),
        T.StructField("api_id", T.LongType()),
        T.StructField("charge_type", T.IntegerType()),
        T.StructField("access_month", T.StringType()),
        T.StructField("access_count", T.LongType()),
        T.StructField("access_flow", T.LongType()),
        T.StructField("deal_count", T.LongType()),
    ]
)

# Tables of the ledger, without the columns that the names of their folders hold.
LEDGER_TABLES = {
    "archive": T.StructType(
        [T.StructField("rowkey", T.StringType())]
        + [T.StructField(column, T.StringType()) for _, _, column in ACCESS_FIELDS]
        + [T.StructField("log_id", T.StringType()), T.StructField("salt", T.StringType())]
    ),
    "rejected": T.StructType(
        [T.StructField("value", T.StringType()), T.StructField("reject_reason", T.StringType())]
    ),
    "increments": T.StructType(
        [
            T.StructField("window_start", T.LongType()),
            T.StructField("user_id", T.StringType()),
            T.StructField("api_id", T.LongType()),
            T.StructField("app_id", T.LongType()),
            T.StructField("status", T.IntegerType()),
            T.StructField("in_param", T.StringType()),
            T.StructField("call_count", T.LongType()),
            T.StructField("sum_flow", T.LongType()),
            T.StructField("sum_deal", T.LongType()),
            T.StructField("user_logo", T.StringType()),
            T.StructField("user_project", T.StringType()),
            T.StructField("api_type", T.IntegerType()),
            T.StructField("charge_type", T.IntegerType()),
            T.StructField("add_time", T.LongType()),
            T.StructField("access_day", T.StringType()),
            T.StructField("access_month", T.StringType()),
        ]
    ),
    "charges": T.StructType(
        [
            T.StructField("user_id", T.StringType()),
            T.StructField("user_logo", T.StringType()),
            T.StructField("user_project", T.StringType()),
            T.StructField("api_id", T.LongType()),
            T.StructField("charge_type", T.IntegerType()),
            T.StructField("window_start", T.LongType()),
            T.StructField("seq_hash", T.LongType()),
            T.StructField("app_id", T.LongType()),
            T.StructField("access_day", T.StringType()),
            T.StructField("is_free", T.BooleanType()),
            T.StructField("access_count", T.LongType()),
            T.StructField("access_flow", T.LongType()),
            T.StructField("deal_count", T.LongType()),
            T.StructField("access_money", T.DoubleType()),
            T.StructField("charge_id", T.LongType()),
            T.StructField("charge_order", T.DecimalType(38, 0)),
            T.StructField("access_month", T.StringType()),
        ]
    ),
    # What a batch took of each source: a file, whose place is its time, or a partition of a topic.
    "inputs": T.StructType(
        [
            T.StructField("stream", T.StringType()),
            T.StructField("source", T.StringType()),
            T.StructField("low", T.LongType()),
            T.StructField("high", T.LongType()),
        ]
    ),
    # Sums of the batches since the snapshot before.
    "daily_increments": T.StructType(
        [
            T.StructField("user_id", T.StringType()),
            T.StructField("user_logo", T.StringType()),
            T.StructField("user_project", T.StringType()),
            T.StructField("api_id", T.LongType()),
            T.StructField("app_id", T.LongType()),
            T.StructField("access_day", T.StringType()),
            T.StructField("access_count", T.LongType()),
            T.StructField("success_count", T.LongType()),
            T.StructField("access_flow", T.LongType()),
            T.StructField("deal_count", T.LongType()),
        ]
    ),
    "daily_charges": T.StructType(
        [
            T.StructField("user_id", T.StringType()),
            T.StructField("user_logo", T.StringType()),
            T.StructField("user_project", T.StringType()),
            T.StructField("api_id", T.LongType()),
            T.StructField("charge_type", T.IntegerType()),
            T.StructField("access_day", T.StringType()),
            T.StructField("access_month", T.StringType()),
            T.StructField("access_count", T.LongType()),
            T.StructField("charge_id", T.LongType()),
            T.StructField("access_money", T.DoubleType()),
            T.StructField("access_flow", T.LongType()),
            T.StructField("deal_count", T.LongType()),
            T.StructField("charge_order", T.DecimalType(38, 0)),
        ]
    ),
    # Charged totals of the batches of a snapshot, and of the months that it wrote.
    "totals_life": T.StructType(
        [T.StructField("key_hash", T.LongType()), *[f for f in CHARGED_TOTALS.fields if f.name != "access_month"]]
    ),
    "totals_month": T.StructType([T.StructField("key_hash", T.LongType()), *CHARGED_TOTALS.fields]),
}

# Increments of windows that are still open, with the batch that met them first.
LEDGER_TABLES["carry"] = T.StructType(
    [*LEDGER_TABLES["increments"].fields, T.StructField("carried_since", T.LongType())]
)

# Rows of the archive with the last batch of their piece.
ARCHIVE_PIECE = T.StructType([*LEDGER_TABLES["archive"].fields, T.StructField("batch_id", T.LongType())])

# An entry of the ledger, without the state it leaves behind.
ENTRY = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("version", T.LongType()),
        T.StructField("void", T.BooleanType()),
        T.StructField("attempt", T.StringType()),
        T.StructField("stream", T.StringType()),
        T.StructField("stream_batch", T.LongType()),
        T.StructField("tables", T.ArrayType(T.StringType())),
        T.StructField("months", T.ArrayType(T.StringType())),
        T.StructField(
            "sizes",
            T.ArrayType(
                T.StructType([T.StructField("measure", T.StringType()), T.StructField("row_count", T.LongType())])
            ),
        ),
    ]
)
