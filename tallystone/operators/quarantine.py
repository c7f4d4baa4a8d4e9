"""Quarantine: rejected transactions and accounts in one table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.operators.classify import REASON, SHIELDED
from tallystone.schemas import ACCOUNT_COLUMNS, AUDIT_COLUMNS, TRANSACTION_COLUMNS
from tallystone.settings import NULL_REQUIRED_FIELD, REASONS, Settings

BUSINESS_COLUMNS = TRANSACTION_COLUMNS + [c for c in ACCOUNT_COLUMNS if c != "account_id"]
COLUMNS = BUSINESS_COLUMNS + AUDIT_COLUMNS + [REASON, "_rejected_at", "record_type"]


def first_reason_per_id(rejected: DataFrame, key: str) -> DataFrame:
    """One row per id (null is one id): the first reason by name, ties by content."""
    rest = [c for c in rejected.columns if c not in (key, REASON)]
    best = F.min(F.struct(REASON, *rest)).alias("_best")
    return rejected.groupBy(key).agg(best).select(key, "_best.*").select(*rejected.columns)


def first_reasons(classified: DataFrame, key: str, record_type: str) -> DataFrame:
    """The first reason by name per id, without the rows: one hash aggregate over numbers."""
    names = sorted(REASONS)
    number = F.lit(None).cast("int")
    for i, name in enumerate(names):
        number = F.when(F.col(REASON) == name, i).otherwise(number)
    first = classified.where(F.col(REASON).isNotNull()).groupBy(key).agg(F.min(number).alias("_first"))
    text = F.lit(None).cast("string")
    for i, name in enumerate(names):
        text = F.when(F.col("_first") == i, name).otherwise(text)
    return first.select(key, text.alias(REASON), F.lit(record_type).alias("record_type"))


def rejected_rows(classified: DataFrame, key: str, cfg: Settings) -> DataFrame:
    if cfg.quarantine == "per_id":
        return first_reason_per_id(classified.where(F.col(REASON).isNotNull()), key)
    if key == "account_id":
        return classified.where(F.col(REASON).isNotNull())
    return classified.where(F.col(REASON).isNotNull() | F.col(SHIELDED)).withColumn(
        REASON, F.coalesce(F.col(REASON), F.lit(NULL_REQUIRED_FIELD))
    )


def quarantine_transactions(classified: DataFrame, now: datetime, cfg: Settings) -> DataFrame:
    return _tagged(rejected_rows(classified, "transaction_id", cfg), "TRANSACTION", now)


def quarantine_accounts(classified: DataFrame, now: datetime, cfg: Settings) -> DataFrame:
    return _tagged(rejected_rows(classified, "account_id", cfg), "ACCOUNT", now)


def build_quarantine(
    transactions: DataFrame, accounts: DataFrame, now: datetime, cfg: Settings
) -> DataFrame:
    """Both classified streams in one schema; columns the other side owns are null."""
    both = quarantine_transactions(transactions, now, cfg).unionByName(
        quarantine_accounts(accounts, now, cfg), allowMissingColumns=True
    )
    return both.select(*COLUMNS, SHIELDED, "date")


def _tagged(rejected: DataFrame, record_type: str, now: datetime) -> DataFrame:
    return rejected.withColumns(
        {"_rejected_at": F.lit(now), "record_type": F.lit(record_type)}
    )


def padded(rejected: DataFrame) -> DataFrame:
    """One side with every column of the table but the record type, which names its folder."""
    wanted = [c for c in [*COLUMNS, SHIELDED, "date"] if c != "record_type"]
    return rejected.select(
        *[
            F.col(c) if c in rejected.columns else F.lit(None).cast("string").alias(c)
            for c in wanted
        ]
    )


def quarantined_ids(quarantine: DataFrame) -> DataFrame:
    return (
        quarantine.where(
            (F.col("record_type") == "TRANSACTION") & F.col("transaction_id").isNotNull()
        )
        .groupBy("transaction_id")
        .agg(F.count(F.lit(1)).alias("_quarantined"))
    )
