"""Access logs derived from the benchmark tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callmeter.functions.clock import DAY_MS, epoch_ms
from callmeter.functions.text import salted_row_key
from callmeter.schema import ACCESS_FIELDS, FIELD_NAMES

# The sample price list, in the column order of CHARGE_RULE.
SAMPLE_RULES = (
    (1, 1, 0.35, 1, 100, 1, 60, 1),
    (2, 1, 0.3, 1, 90, 61, 150, 1),
    (3, 1, 0.25, 1, 75, 151, 1000000000, 1),
    (4, 2, 1.5, 1, 100, 1, 3, 1),
    (5, 2, 1.25, 1, 90, 4, 8, 1),
    (6, 2, 1.1, 1, 75, 9, 1000000000, 1),
    (7, 3, 0.2, 1, 100, 1, 100, 1),
    (8, 3, 0.15, 0, 90, 101, 300, 1),
    (9, 3, 0.125, 1, 75, 301, 1000000000, 1),
    (10, 1, 99.0, 1, 100, 1, 1000000000, 0),
)


# The same tiers at prices of up to ten decimals.
FINE_RULES = tuple((*rule[:2], float(f"{rule[2]}e-7"), *rule[3:]) for rule in SAMPLE_RULES)


def sample_rules(
    spark: SparkSession, spend_types: tuple[int, ...] = (1, 2, 3), rules: tuple = SAMPLE_RULES
) -> DataFrame:
    rows = ", ".join(str(rule) for rule in rules if rule[1] in spend_types)
    return spark.sql(
        f"""
        SELECT CAST(id AS BIGINT) AS id, CAST(spend_type AS INT) AS spend_type,
               CAST(unit_price AS DOUBLE) AS unit_price, CAST(is_discount AS INT) AS is_discount,
               CAST(discount AS BIGINT) AS discount, CAST(lower_limit AS BIGINT) AS lower_limit,
               CAST(upper_limit AS BIGINT) AS upper_limit, CAST(status AS INT) AS status
        FROM VALUES {rows}
          AS rule(id, spend_type, unit_price, is_discount, discount, lower_limit, upper_limit, status)
        """
    )


def _spread(table: DataFrame, key: str) -> DataFrame:
    """A table stored in fewer splits than there are cores, spread by a key.

    The tables of a large warehouse have more splits than cores and are left
    as they are; a small one in a single file would be read by a single task.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    if table.rdd.getNumPartitions() >= cores:
        return table
    return table.repartition(cores, key)


def _typed(columns: dict[str, Column]) -> list[Column]:
    return [columns[name].cast(kind).alias(name) for name, kind, _ in ACCESS_FIELDS]


def billing_log(spark: SparkSession, sf_dir: str, by_row_key: bool = False) -> DataFrame:
    """Many months of calls, from lineitem and orders.

    With ``by_row_key`` all calls of a row key lie in one partition.  They are
    dealt out as the few numbers that the columns are made of.
    """
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    lineitem = _spread(lineitem, "l_orderkey")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    joined = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    user = F.col("o_custkey") % 12
    project = F.concat(F.lit("proj_"), user % 7)
    api_id = F.col("l_partkey") % 3
    variant = F.col("l_suppkey") % 4
    day = F.unix_date(F.col("l_shipdate").cast("date")).cast("bigint")
    monday = day - F.pmod(day + 3, F.lit(7))
    add_time_ms = monday * DAY_MS + (F.col("l_suppkey") % 5) * 20_000
    failed = F.col("l_returnflag") == "R"
    columns = {
        "userId": F.when(user == 0, "-1").when(user == 2, "-").otherwise(user.cast("string")),
        "userLogo": F.concat(F.lit("logo_"), user % 5),
        "userProject": project,
        "appId": F.col("l_linenumber") % 2,
        "appCode": F.when(F.col("l_linenumber") == 7, "  ").otherwise(
            F.concat(F.lit("app_"), F.col("l_linenumber"))
        ),
        "apiId": api_id,
        "url": F.concat(F.lit("/data/api"), api_id),
        "apiType": F.when(F.col("l_suppkey") % 10 == 0, 0).otherwise(1),
        "inParam": F.when(variant == 0, F.concat(F.lit('{"accessProject":"'), project, F.lit('"}')))
        .when(variant == 1, '{"accessProject":"other"}')
        .when(variant == 2, "{}")
        .otherwise("userId=1"),
        "useTime": F.col("l_quantity").cast("bigint"),
        "ip": F.concat(F.lit("10.0.0."), F.col("l_suppkey") % 256),
        "addTime": add_time_ms,
        "status": F.when(failed, 0).otherwise(1),
        "message": F.when(failed, "failed").otherwise("success"),
        "accessKey": F.concat(F.lit("key_"), F.col("o_custkey")),
        "chargeType": api_id + 1,
        "accessFlow": F.floor(F.col("l_extendedprice") / 1000),
        "dealCount": F.col("l_quantity"),
    }
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    log_id = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents)
    if by_row_key:
        named = dict(zip(FIELD_NAMES, _typed(columns)))
        joined = joined.repartition(salted_row_key(*[named[name] for name in ("userId", "apiId", "appId", "addTime")]))
    return joined.select(
        *_typed(columns), add_time_ms.alias("add_time_ms"), log_id.alias("log_id")
    )


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One month of calls in time order, from events."""
    user = F.col("user_id")
    kind = F.col("event_type")
    ms = epoch_ms(F.col("ts"))
    columns = {
        "userId": user,
        "userLogo": F.concat(F.lit("logo_"), user % 5),
        "userProject": F.concat(F.lit("proj_"), user % 7),
        "appId": user % 4,
        "appCode": F.lit("app"),
        "apiId": F.lit(1),
        "url": F.lit("/data/api1"),
        "apiType": F.when(kind == "view", 0).otherwise(1),
        "inParam": F.col("props"),
        "useTime": F.lit("1"),
        "ip": F.lit("10.0.0.1"),
        "addTime": ms,
        "status": F.when(kind == "error", 0).otherwise(1),
        "message": F.lit("success"),
        "accessKey": F.lit("key"),
        "chargeType": user % 3 + 1,
        "accessFlow": F.floor(F.col("value") * 10),
        "dealCount": F.floor(F.col("value")),
    }
    events = _spread(spark.read.parquet(f"{sf_dir}/events.parquet"), "event_id")
    return events.select(
        *_typed(columns), ms.alias("add_time_ms"), F.col("event_id").cast("string").alias("log_id")
    )


def json_lines(log: DataFrame, *keep: str) -> DataFrame:
    """The log as one JSON object per line, in a ``value`` column."""
    return log.select(F.to_json(F.struct(*FIELD_NAMES)).alias("value"), *keep)


def damaged_lines(log: DataFrame) -> DataFrame:
    """JSON lines of which some are broken, in one of ten ways."""
    kind = F.col("dealCount") % 32
    line = F.col("line")
    return log.select(
        F.to_json(F.struct(*FIELD_NAMES)).alias("line"), kind.alias("kind"), "log_id"
    ).select(
        F.when(F.col("kind") == 0, F.substring(line, F.lit(1), F.length(line) - 1))
        .when(F.col("kind") == 1, F.regexp_replace(line, '"appId":([0-9]+)', '"appId":"x$1"'))
        .when(F.col("kind") == 2, F.regexp_replace(line, '"dealCount":', '"dealcount":'))
        .when(F.col("kind") == 3, F.regexp_replace(line, '"accessFlow":[0-9]+', '"accessFlow":" "'))
        .when(F.col("kind") == 4, F.concat(line, line))
        .when(F.col("kind") == 5, F.concat(line, F.lit(" junk")))
        .when(F.col("kind") == 6, F.concat(line, F.lit("] junk")))
        .when(F.col("kind") == 7, F.concat(line, F.lit('],[{"x":1}')))
        .when(F.col("kind") == 8, F.concat(line, F.lit(","), line))
        .when(F.col("kind") == 9, F.concat(line, F.lit('],"x":[{}')))
        .otherwise(line)
        .alias("value"),
        "log_id",
    )
