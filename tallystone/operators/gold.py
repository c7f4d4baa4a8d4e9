"""Gold rollups.

Both rollups work on additive facts: a count and a sum. A fact may be a Silver row
(count 1) or a stored cube row that sums up one Silver date, so a daily run re-reads the
dates it changed and merges the rest from the cubes.

The run id is a grouping column of the cube, where the aggregate still runs as a hash
aggregate; its maximum is taken on the few rows that are left.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.functions import week_end, week_start
from tallystone.operators.accounts import closing_balance_asof
from tallystone.operators.skew import lookup
from tallystone.schemas import TOTAL
from tallystone.settings import TRANSACTION_TYPES, Settings


def _resolvable(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("_is_resolvable"))


def daily_cube(silver: DataFrame, *also: str) -> DataFrame:
    """Count and sum per day, code, channel and run."""
    keys = [*also, "transaction_date", "transaction_code", "channel", "_pipeline_run_id"]
    return _resolvable(silver).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_signed_amount").cast(TOTAL).alias("amount")
    )


def weekly_cube(silver: DataFrame, *also: str) -> DataFrame:
    """Count and sum per account, week, code and run."""
    monday = week_start(F.col("transaction_date")).alias("week_start_date")
    keys = [*also, "account_id", monday, "transaction_code", "_pipeline_run_id"]
    return _resolvable(silver).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_signed_amount").cast(TOTAL).alias("amount")
    )


def _typed(cube: DataFrame, codes: DataFrame, cfg: Settings) -> DataFrame:
    types = codes.where(F.col("transaction_code").isNotNull()).select(
        "transaction_code", "transaction_type"
    )
    return lookup(cube, types, ["transaction_code"], cfg)


def _count_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))


def _sum_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("amount"))), F.lit(0)).cast(TOTAL)


def daily_from_cube(cube: DataFrame, codes: DataFrame, now: datetime, cfg: Settings) -> DataFrame:
    kind = F.col("transaction_type")
    by_type = F.struct(
        *[
            F.struct(
                _count_where(kind == t).alias("count"), _sum_where(kind == t).alias("sum")
            ).alias(t)
            for t in TRANSACTION_TYPES
        ]
    )
    return (
        _typed(cube, codes, cfg)
        .groupBy("transaction_date")
        .agg(
            F.sum("n").alias("total_transactions"),
            F.sum("amount").cast(TOTAL).alias("total_signed_amount"),
            _count_where(F.col("channel") == "ONLINE").alias("online_transactions"),
            _count_where(F.col("channel") == "IN_STORE").alias("instore_transactions"),
            by_type.alias("transactions_by_type"),
            F.max("_pipeline_run_id").alias("_pipeline_run_id"),
        )
        .select(
            "transaction_date", "total_transactions", "total_signed_amount",
            "online_transactions", "instore_transactions", "transactions_by_type",
            F.lit(now).alias("_computed_at"),
            "_pipeline_run_id",
            F.col("transaction_date").alias("_source_period_start"),
            F.col("transaction_date").alias("_source_period_end"),
        )
    )


def gold_daily(silver: DataFrame, codes: DataFrame, now: datetime, cfg: Settings) -> DataFrame:
    """One row per transaction_date over resolvable Silver rows."""
    return daily_from_cube(daily_cube(silver), codes, now, cfg)


def type_json(daily: DataFrame) -> DataFrame:
    """transactions_by_type as JSON text."""
    return daily.withColumn("transactions_by_type", F.to_json("transactions_by_type"))


def weekly_rollup(cube: DataFrame, codes: DataFrame, cfg: Settings) -> DataFrame:
    kind = F.col("transaction_type")
    bought = F.col("total_purchases")
    return (
        _typed(cube, codes, cfg)
        .groupBy("account_id", "week_start_date")
        .agg(
            _count_where(kind == "PURCHASE").alias("total_purchases"),
            _sum_where(kind == "PURCHASE").alias("_purchase_sum"),
            _sum_where(kind == "PAYMENT").alias("total_payments"),
            _sum_where(kind == "FEE").alias("total_fees"),
            _sum_where(kind == "INTEREST").alias("total_interest"),
            F.max("_pipeline_run_id").alias("_pipeline_run_id"),
        )
        .select(
            "week_start_date",
            week_end(F.col("week_start_date")).alias("week_end_date"),
            "account_id", "total_purchases",
            F.when(bought > 0, F.col("_purchase_sum").cast("double") / bought).alias(
                "avg_purchase_amount"
            ),
            "total_payments", "total_fees", "total_interest", "_pipeline_run_id",
        )
    )


def weekly_from_cube(
    cube: DataFrame,
    codes: DataFrame,
    accounts: DataFrame,
    now: datetime,
    cfg: Settings,
    bronze_accounts: DataFrame | None = None,
) -> DataFrame:
    rollup = weekly_rollup(cube, codes, cfg)
    if cfg.balance == "as_of":
        if bronze_accounts is None:
            raise ValueError("balance='as_of' needs the delivered account rows")
        closed = closing_balance_asof(rollup, bronze_accounts)
    else:
        latest = accounts.select("account_id", F.col("current_balance").alias("closing_balance"))
        closed = rollup.join(latest, "account_id", "inner")
    return closed.select(
        "week_start_date", "week_end_date", "account_id", "total_purchases",
        "avg_purchase_amount", "total_payments", "total_fees", "total_interest",
        "closing_balance", F.lit(now).alias("_computed_at"), "_pipeline_run_id",
    )


def gold_weekly_account(
    silver: DataFrame,
    codes: DataFrame,
    accounts: DataFrame,
    now: datetime,
    cfg: Settings,
    bronze_accounts: DataFrame | None = None,
) -> DataFrame:
    """One row per account and Monday week over resolvable Silver rows."""
    return weekly_from_cube(weekly_cube(silver), codes, accounts, now, cfg, bronze_accounts)
