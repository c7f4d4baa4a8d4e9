"""Promotion of accepted transactions: sign, resolvability, audit columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.functions import blank, money, signed, to_day
from tallystone.operators.classify import REASON, SHIELDED
from tallystone.operators.quarantine import quarantined_ids
from tallystone.operators.skew import COPIES, is_small, lookup, mark
from tallystone.settings import DEBIT, Settings
from tallystone.sources.files import stage


def accepted(classified: DataFrame) -> DataFrame:
    return classified.where(F.col(REASON).isNull() & ~F.col(SHIELDED)).drop(REASON, SHIELDED)


def not_quarantined(bronze: DataFrame, quarantine: DataFrame, cfg: Settings) -> DataFrame:
    """Rows whose id is not in the quarantine table.

    An id of null compares as unknown, so such rows are out, except that the comparison
    with an empty set is true: ``promote_if_clean`` follows that, ``drop`` does not.
    """
    ids = quarantined_ids(quarantine)
    # Copies are those in Bronze: the quarantine may hold one row per id.
    found = bronze.join(ids, "transaction_id", "left_semi").groupBy("transaction_id").agg(F.count(F.lit(1)).alias(COPIES))
    flags = stage(found.withColumn("_quarantined", F.lit(True)), "quarantined")
    kept = mark(bronze, flags, ["transaction_id"], cfg).where(F.col("_quarantined").isNull())
    if cfg.null_ids == "promote_if_clean" and ids.isEmpty():  # no id at all in the quarantine
        return kept.select(*bronze.columns)
    return kept.where(F.col("transaction_id").isNotNull()).select(*bronze.columns)


def promote_transactions(
    rows: DataFrame,
    codes: DataFrame,
    accounts: DataFrame,
    now: datetime,
    cfg: Settings,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Accepted Bronze rows to Silver.

    ``accounts`` has one row per account_id; with ``_first_seen`` when resolvability is
    judged by the row's date. ``keys_from`` may give a cheaper frame to read the account
    keys from, with at least the accounts and dates of ``rows``.
    """
    coded = lookup(
        rows,
        codes.where(F.col("transaction_code").isNotNull()).select(
            "transaction_code", "debit_credit_indicator"
        ),
        ["transaction_code"],
        cfg,
    )
    flagged = flag_resolvable(coded, accounts, cfg, keys_from)
    amount = money("amount")
    return flagged.select(
        "transaction_id", "account_id",
        to_day("transaction_date").alias("transaction_date"),
        amount.alias("amount"),
        "transaction_code", "merchant_name", "channel", "debit_credit_indicator",
        signed(amount, F.col("debit_credit_indicator"), DEBIT).alias("_signed_amount"),
        "_is_resolvable", "_pipeline_run_id",
        F.col("_ingested_at").alias("_bronze_ingested_at"),
        "_source_file",
        F.lit(now).alias("_promoted_at"),
        "date",
    )


def flag_resolvable(
    rows: DataFrame, accounts: DataFrame, cfg: Settings, keys_from: DataFrame | None = None
) -> DataFrame:
    """Add _is_resolvable.

    A small account table is broadcast. Otherwise the few keys that do not resolve are
    worked out on distinct keys, staged, and marked on the rows, so that an account with
    very many rows is never shuffled as such.
    """
    by_day = cfg.resolvable == "as_of_date"
    known = accounts.where(F.col("account_id").isNotNull()).select(
        "account_id", F.col("_first_seen") if by_day else F.lit(True).alias("_first_seen")
    )
    if is_small(known, cfg):
        found = rows.join(F.broadcast(known), "account_id", "left")
        return found.withColumn("_is_resolvable", _seen(by_day)).drop("_first_seen")
    keys = ["account_id", "date"] if by_day else ["account_id"]
    used = (keys_from if keys_from is not None else rows).groupBy(*keys).agg(
        F.count(F.lit(1)).alias(COPIES)
    )
    unknown = stage(
        used.join(known, "account_id", "left")
        .where(~_seen(by_day))
        .select(*keys, COPIES, F.lit(True).alias("_unknown")),
        "unknown-accounts",
    )
    marked = mark(
        rows, unknown, keys, cfg, matchable=~blank("account_id"), spread_by=["transaction_id"]
    )
    is_known = F.col("_unknown").isNull() & F.col("account_id").isNotNull()
    return marked.withColumn("_is_resolvable", is_known).drop("_unknown")


def _seen(by_day: bool) -> Column:
    seen = F.col("_first_seen").isNotNull()
    return seen & (F.col("_first_seen") <= F.col("date")) if by_day else seen


def late_resolved(silver: DataFrame, accounts: DataFrame) -> DataFrame:
    """The accounts of unresolvable Silver rows that have arrived since.

    Only the unresolved rows take part; they are reduced to distinct accounts before they
    meet the account table."""
    waiting = silver.where(~F.col("_is_resolvable"))
    return (
        waiting.groupBy("account_id").agg(F.count(F.lit(1)).alias(COPIES))
        .join(accounts.select("account_id"), "account_id", "left_semi")
        .withColumn("_arrived", F.lit(True))
    )


def resolve_late_accounts(silver: DataFrame, accounts: DataFrame, cfg: Settings) -> DataFrame:
    """Silver with the flag turned on where the account has arrived since."""
    arrived = stage(late_resolved(silver, accounts), "arrived")
    marked = mark(
        silver, arrived, ["account_id"], cfg,
        matchable=~F.col("_is_resolvable"), spread_by=["transaction_id"],
    )
    return marked.withColumn(
        "_is_resolvable", F.col("_is_resolvable") | F.col("_arrived").isNotNull()
    ).drop("_arrived")
