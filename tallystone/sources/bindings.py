"""The given test tables read as ledger tables: ledger and audit columns, file date."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.operators.codes import silver_codes
from tallystone.schemas import CODE_COLUMNS, MONEY, RUN_LOG, SOURCE_COLUMNS
from tallystone.session import unsorted_writes
from tallystone.sources import files
from tallystone.sources.daily_csv import DIALECT
from tallystone.sources.versions import OPEN_DAYS

NOW = datetime(2024, 3, 1, tzinfo=timezone.utc)

# Codes of the two bindings as code, indicator, type.
EVENT_CODES = (
    ("purchase", "DR", "PURCHASE"),
    ("view", "DR", "FEE"),
    ("click", "CR", "PAYMENT"),
    ("signup", "DR", "INTEREST"),
)
LINE_CODES = (("A", "DR", "PURCHASE"), ("N", "CR", "PAYMENT"))

# Account status per market segment; the last two are not valid.
SEGMENT_STATUS = {
    "AUTOMOBILE": "ACTIVE",
    "BUILDING": "SUSPENDED",
    "FURNITURE": "CLOSED",
    "HOUSEHOLD": "PENDING",
    "MACHINERY": "UNKNOWN",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _file(entity: str, day: Column) -> Column:
    return F.concat(F.lit(f"{entity}_"), day.cast("string"), F.lit(".csv"))


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events: no natural nulls or repeats, one invalid channel, one unknown code, and two
    loading runs (first and second half of the month)."""
    day = F.col("ts").cast("date")
    third = F.regexp_extract("props", r'"k": *(\d+)', 1).cast("int") % 3
    return _table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("user_id").cast("string").alias("account_id"),
        day.cast("string").alias("transaction_date"),
        F.col("value").cast(MONEY).alias("amount"),
        F.col("event_type").alias("transaction_code"),
        F.lit(None).cast("string").alias("merchant_name"),
        F.when(third == 0, "ONLINE").when(third == 1, "IN_STORE").otherwise("DRIVE_THRU").alias("channel"),
        F.when(F.dayofmonth(day) <= 15, "run-a").otherwise("run-b").alias("_pipeline_run_id"),
        day.cast("timestamp").alias("_ingested_at"),
        _file("transactions", day).alias("_source_file"),
        day.alias("date"),
    )


def line_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with its order: natural repeats and zero amounts, an unknown code, an
    invalid channel, and a missing channel."""
    line, orders = _table(spark, sf_dir, "lineitem"), _table(spark, sf_dir, "orders")
    day = F.col("l_shipdate").cast("date")
    channel = (
        F.when(F.col("l_suppkey") % 50 == 0, F.lit(None))
        .when(F.col("l_partkey") % 40 == 0, "DRIVE_THRU")
        .when(F.col("l_linestatus") == "F", "IN_STORE")
        .otherwise("ONLINE")
    )
    return line.join(
        orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left"
    ).select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("account_id"),
        day.cast("string").alias("transaction_date"),
        F.col("l_discount").cast(MONEY).alias("amount"),
        F.col("l_returnflag").alias("transaction_code"),
        F.lit(None).cast("string").alias("merchant_name"),
        channel.alias("channel"),
        F.lit("run-a").alias("_pipeline_run_id"),
        day.cast("timestamp").alias("_ingested_at"),
        _file("transactions", day).alias("_source_file"),
        day.alias("date"),
    )


def codes(spark: SparkSession, rows: tuple[tuple[str, str, str], ...]) -> DataFrame:
    """The reference table of a binding, as Silver holds it."""
    values = ", ".join(f"('{c}', '{c}', '{i}', '{t}', true)" for c, i, t in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(CODE_COLUMNS)})").withColumns(
        {
            "_pipeline_run_id": F.lit("run-a"),
            "_ingested_at": F.lit(NOW),
            "_source_file": F.lit("transaction_codes.csv"),
        }
    )


def delivered_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events: the codes in use each day, as if the codes file were loaded again daily."""
    day = F.col("ts").cast("date")
    kind = F.col("transaction_code")
    indicator, type_name = F.lit(None), F.lit(None)
    for code, ind, name in EVENT_CODES:
        indicator = F.when(kind == code, ind).otherwise(indicator)
        type_name = F.when(kind == code, name).otherwise(type_name)
    used = _table(spark, sf_dir, "events").where("event_type != 'error'").select(
        F.col("event_type").alias("transaction_code"), day.alias("date")
    ).distinct()
    return used.select(
        "transaction_code",
        F.concat_ws(" ", "transaction_code", F.col("date").cast("string")).alias("description"),
        indicator.alias("debit_credit_indicator"),
        type_name.alias("transaction_type"),
        F.lit("true").alias("affects_balance"),
        F.lit("run-a").alias("_pipeline_run_id"),
        F.col("date").cast("timestamp").alias("_ingested_at"),
        F.lit("transaction_codes.csv").alias("_source_file"),
        "date",
    )


def customer_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as daily deltas: a first delivery within 30 days, a second one a week later
    for every third account; every tenth account is never delivered."""
    status = F.lit(None)
    for segment, value in SEGMENT_STATUS.items():
        status = F.when(F.col("c_mktsegment") == segment, value).otherwise(status)
    key = F.col("c_custkey")
    versions = F.when(key % 3 == 0, F.array(F.lit(0), F.lit(7))).otherwise(F.array(F.lit(0)))
    delivered = _table(spark, sf_dir, "customer").where(key % 10 != 0).select(
        "*", F.explode(versions).alias("_later")
    )
    day = F.date_add(F.lit("2024-01-01").cast("date"), (key % 30).cast("int") + F.col("_later"))
    balance = F.col("c_acctbal").cast(MONEY) + F.col("_later") * 100
    return delivered.select(
        key.cast("string").alias("account_id"),
        F.col("c_name").alias("customer_name"),
        status.alias("account_status"),
        F.lit("5000.000").alias("credit_limit"),
        balance.cast(MONEY).cast("string").alias("current_balance"),
        F.when(F.col("c_nationkey") != 7, "2020-01-01").alias("open_date"),
        F.lit("1").alias("billing_cycle_start"),
        F.lit("28").alias("billing_cycle_end"),
        F.lit("run-a").alias("_pipeline_run_id"),
        day.cast("timestamp").alias("_ingested_at"),
        _file("accounts", day).alias("_source_file"),
        day.alias("date"),
    )


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as run log entries: one run per customer, one entry per order."""
    status = F.col("o_orderstatus")
    urgency = F.substring("o_orderpriority", 1, 1)
    stamp = F.col("o_orderdate").cast("timestamp")
    rows = F.floor(F.col("o_totalprice")).cast("long")
    return _table(spark, sf_dir, "orders").select(
        F.concat(F.lit("run-"), F.col("o_custkey").cast("string")).alias("run_id"),
        F.lit("HISTORICAL").alias("pipeline_type"),
        F.when(urgency == "1", "bronze_accounts").otherwise("silver_transactions").alias("model_name"),
        F.when(urgency.isin("1", "2"), "BRONZE").when(urgency.isin("3", "4"), "SILVER").otherwise("GOLD").alias("layer"),
        stamp.alias("started_at"),
        stamp.alias("completed_at"),
        F.when(status == "P", "SKIPPED").when((status == "O") & urgency.isin("3", "4"), "FAILED").otherwise("SUCCESS").alias("status"),
        rows.alias("records_processed"),
        rows.alias("records_written"),
        F.col("o_orderkey").alias("records_rejected"),
        F.concat(F.lit("\\app/Bronze/order "), F.col("o_orderkey").cast("string"), F.lit(" "), "o_orderpriority", F.when(urgency == "4", " Key missing").when(urgency == "3", F.repeat(F.lit(" detail"), F.lit(100))).otherwise("")).alias("error_message"),
        F.col("o_orderdate").cast("date").alias("processed_date"),
    ).select(*RUN_LOG.fieldNames())


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as a delivery: one file per order date."""
    return _table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        "o_orderstatus", "o_orderpriority",
    )


def export_daily_csv(rows: DataFrame, entity: str, folder: str, **dialect: str) -> None:
    """Write rows as deliveries ``{entity}_{date}.csv`` (folders of part files), one job for
    all days."""
    spark = rows.sparkSession
    name = F.concat(F.lit(f"{entity}_"), F.col("date").cast("string"), F.lit(".csv"))
    drops = rows.select(*SOURCE_COLUMNS[entity], "date", name.alias("drop")).hint("rebalance", "date").drop("date")
    with unsorted_writes(spark, OPEN_DAYS):
        drops.write.partitionBy("drop").options(**DIALECT | dialect).mode("append").csv(folder)
    for path in files.matching(spark, f"{folder}/drop={entity}_*"):
        files.rename(spark, path, f"{folder}/{path.rsplit('drop=', 1)[1]}")


def export_codes_csv(delivered: DataFrame, folder: str) -> None:
    """Write the newest version of each code as the undated codes delivery."""
    silver_codes(delivered).select(*SOURCE_COLUMNS["transaction_codes"]).coalesce(1).write.options(
        **DIALECT
    ).csv(f"{folder}/transaction_codes.csv")
