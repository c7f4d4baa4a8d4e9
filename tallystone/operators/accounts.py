"""Account state: latest row, first delivery, balance as of a day."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystone.functions import money
from tallystone.operators.latest import latest_by
from tallystone.schemas import ACCOUNT_COLUMNS, AUDIT_COLUMNS


def latest_accounts(bronze_accounts: DataFrame, now: datetime) -> DataFrame:
    """One row per account_id: the most recently ingested, over all deliveries.

    Rows rejected by the quality rules still count; the rules only report them."""
    rows = bronze_accounts.select(*ACCOUNT_COLUMNS, *AUDIT_COLUMNS)
    newest = latest_by(rows, ["account_id"], ["_ingested_at", "_source_file"])
    return newest.select(
        "account_id", "customer_name", "account_status",
        money("credit_limit").alias("credit_limit"),
        money("current_balance").alias("current_balance"),
        "open_date", "billing_cycle_start", "billing_cycle_end",
        "_pipeline_run_id", "_source_file",
        F.col("_ingested_at").alias("_bronze_ingested_at"),
        F.lit(now).alias("_record_valid_from"),
    )


def first_seen(bronze_accounts: DataFrame) -> DataFrame:
    """The first delivery day of each account."""
    return (
        bronze_accounts.where(F.col("account_id").isNotNull())
        .groupBy("account_id")
        .agg(F.min("date").alias("_first_seen"))
    )


def balances_by_day(bronze_accounts: DataFrame) -> DataFrame:
    """One balance per account and delivery day: the last one ingested that day."""
    rows = bronze_accounts.where(F.col("account_id").isNotNull()).select(
        "account_id", "date", "_ingested_at", "_source_file",
        money("current_balance").alias("current_balance"),
    )
    return latest_by(rows, ["account_id", "date"], ["_ingested_at", "_source_file"]).select(
        "account_id", "date", "current_balance"
    )


def closing_balance_asof(weekly: DataFrame, bronze_accounts: DataFrame) -> DataFrame:
    """Attach the balance delivered last on or before week_end_date.

    Where the account was first delivered after that week, its most recent balance is
    used. Accounts never delivered are left out. Weeks and balances are merged on one
    time line per account instead of being paired: an account has at most one entry per
    day on each side, so its group is bounded by the calendar.
    """
    points = weekly.select(
        "account_id",
        F.col("week_end_date").alias("_day"),
        F.lit(1).alias("_kind"),
        F.struct(*weekly.columns).alias("_week"),
        F.lit(None).cast("struct<balance:decimal(18,3)>").alias("_delivered"),
    )
    deliveries = balances_by_day(bronze_accounts).select(
        "account_id",
        F.col("date").alias("_day"),
        F.lit(0).alias("_kind"),
        F.struct(F.col("current_balance").alias("balance")).alias("_delivered"),
    )
    line = Window.partitionBy("account_id").orderBy("_day", "_kind")
    so_far = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    merged = points.unionByName(deliveries, allowMissingColumns=True).select(
        "_kind",
        "_week",
        F.last("_delivered", ignorenulls=True).over(so_far).alias("_as_of"),
        F.last("_delivered", ignorenulls=True).over(whole).alias("_newest"),
    )
    return merged.where((F.col("_kind") == 1) & F.col("_newest").isNotNull()).select(
        "_week.*",
        F.coalesce("_as_of", "_newest").getField("balance").alias("closing_balance"),
    )
