"""Quality rules: at most one rejection reason per row.

Five written rules for transactions and two for accounts are mutually exclusive on a row,
so one pass with one CASE gives what a scan per rule would.

What a row needs to know about the other copies of its id comes from ``id_flags``: one
partial aggregate, kept only for ids that repeat, and staged. When few ids repeat the
staged table is small, Spark broadcasts it, and the rows themselves are never shuffled.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystone.functions import any_blank, any_null, blank, money, normalise_nulls
from tallystone.operators.skew import COPIES, broadcast_limit, estimated_bytes, hot_from, lookup, mark
from tallystone.schemas import ACCOUNT_COLUMNS, TRANSACTION_COLUMNS
from tallystone.settings import (
    DUPLICATE_TRANSACTION_ID,
    INVALID_ACCOUNT_STATUS,
    INVALID_AMOUNT,
    INVALID_CHANNEL,
    INVALID_TRANSACTION_CODE,
    NULL_REQUIRED_FIELD,
    Settings,
)
from tallystone.sources.files import stage

REASON = "_rejection_reason"
SHIELDED = "_shielded"
LANE = "_copy_lane"


def transaction_incomplete() -> Column:
    """A required field is missing. merchant_name is optional."""
    return any_blank(
        ["transaction_id", "account_id", "transaction_date", "transaction_code", "channel"]
    ) | F.col("amount").isNull()


def account_incomplete() -> Column:
    """A required field is missing. customer_name is optional."""
    return any_blank(["account_id", "open_date", "account_status"]) | any_null(
        ["credit_limit", "current_balance", "billing_cycle_start", "billing_cycle_end"]
    )


def id_counts(transactions: DataFrame, *also: str) -> DataFrame:
    """Rows per id, and whether one of them is incomplete. Ids that are blank are left out."""
    return (
        transactions.where(~blank("transaction_id"))
        .groupBy("transaction_id", *also)
        .agg(
            F.count(F.lit(1)).alias(COPIES),
            F.max(transaction_incomplete()).alias("_some_incomplete"),
        )
    )


def id_flags(transactions: DataFrame) -> DataFrame:
    """The ids that occur more than once."""
    return id_counts(transactions).where(F.col(COPIES) > 1)


def known_codes(codes: DataFrame) -> DataFrame:
    return codes.where(F.col("transaction_code").isNotNull()).select(
        "transaction_code", F.lit(True).alias("_known_code")
    )


def classify_transactions(
    transactions: DataFrame, codes: DataFrame, cfg: Settings, flags: DataFrame | None = None
) -> DataFrame:
    """Add the rejection reason (null when there is none) and the shield flag.

    ``flags`` is ``id_flags`` over everything ever received; by default it is taken from
    the given rows. A copy is shielded when another copy of its id is incomplete: the
    later rules pass over it, yet its id is rejected, so it is in no Silver table.
    """
    rows = normalise_nulls(transactions, TRANSACTION_COLUMNS, cfg.null_tokens)
    if flags is None:
        flags = stage(id_flags(rows), "ids")
    if cfg.duplicates == "keep_first":
        cfg = replace(cfg, hot_rows=hot_from(flags, cfg))
    marked = mark(rows, flags, ["transaction_id"], cfg, matchable=~blank("transaction_id"), lane=LANE)
    marked = lookup(marked, known_codes(codes), ["transaction_code"], cfg)

    incomplete = transaction_incomplete()
    amount = money("amount")
    repeats = F.col("_some_incomplete").isNotNull()
    shielded = ~incomplete & F.coalesce("_some_incomplete", F.lit(False))
    bad_amount = amount.isNull() | (amount <= 0)
    if cfg.duplicates == "keep_first":
        return _keep_first(marked, flags, transactions.columns, incomplete, shielded, bad_amount, cfg)
    reason = (
        F.when(incomplete, NULL_REQUIRED_FIELD)
        .when(shielded, F.lit(None))
        .when(bad_amount, INVALID_AMOUNT)
        .when(repeats, DUPLICATE_TRANSACTION_ID)
        .when(F.col("_known_code").isNull(), INVALID_TRANSACTION_CODE)
        .when(~F.col("channel").isin(*cfg.channels), INVALID_CHANNEL)
    )
    return marked.select(
        *transactions.columns, reason.alias(REASON), shielded.alias(SHIELDED)
    )


def _keep_first(
    marked: DataFrame,
    flags: DataFrame,
    columns: list[str],
    incomplete: Column,
    shielded: Column,
    bad_amount: Column,
    cfg: Settings,
) -> DataFrame:
    """The first copy that passes every other rule stays; what follows it is a duplicate.

    Copies are ordered by arrival, file and content; of copies equal in every column one stays.
    Rows shuffled by id to be marked are sorted where they are. Where the flags are broadcast, only the
    copies are brought together. Rows of hot ids are never: they are stored with numbers, and compared
    with the first one of their id, of which there are few.
    """
    other = (
        F.when(incomplete, NULL_REQUIRED_FIELD)
        .when(shielded, F.lit(None))
        .when(bad_amount, INVALID_AMOUNT)
    )
    late = F.when(F.col("_known_code").isNull(), INVALID_TRANSACTION_CODE).when(
        ~F.col("channel").isin(*cfg.channels), INVALID_CHANNEL
    )
    order = ["_ingested_at", "_source_file"]
    order += [c for c in columns if c not in order and c != "transaction_id"]
    base = marked.select(
        *columns,
        LANE,
        F.col("_some_incomplete").isNotNull().alias("_repeats"),
        shielded.alias(SHIELDED),
        other.alias("_early"),
        late.alias("_late"),
    )
    fit = F.col("_early").isNull() & F.col("_late").isNull() & ~F.col(SHIELDED)

    def judged(rows: DataFrame, after: Column) -> DataFrame:
        late_reason = F.when(after, DUPLICATE_TRANSACTION_ID).otherwise(F.col("_late"))
        reason = F.coalesce("_early", F.when(~F.col(SHIELDED), late_reason))
        return rows.select(*columns, reason.alias(REASON), SHIELDED)

    # A row follows the first one that passes if any before it passes.
    before = Window.partitionBy("transaction_id", LANE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = F.coalesce(F.max(fit).over(before), F.lit(False))
    is_hot = (F.col(LANE) > 0) & ~blank("transaction_id")
    if estimated_bytes(flags) <= broadcast_limit(flags.sparkSession):
        alone = ~F.col("_repeats") | blank("transaction_id")
        single = judged(base.where(alone), F.lit(False))
        result = single.unionByName(judged(base.where(~alone & ~is_hot), after))
    else:
        result = judged(base.where(~is_hot), after)
    if flags.where(F.col(COPIES) >= cfg.hot_rows).isEmpty():
        return result
    hot = stage(base.where(is_hot).withColumn("_row", F.monotonically_increasing_id()), "hot-copies")
    rank = F.struct(*order, "_row")
    firsts = hot.where(fit).groupBy("transaction_id").agg(F.min(rank).alias("_first"))
    followed = hot.join(F.broadcast(firsts), "transaction_id", "left")
    return result.unionByName(judged(followed, F.coalesce(rank > F.col("_first"), F.lit(False))))


def repeat_rows(df: DataFrame, times: str, block: int = 100_000) -> DataFrame:
    """Each row ``times`` times. A large count is cut into blocks that spread over tasks."""
    blocks = df.withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.floor((F.col(times) - 1) / block).cast("int")))
    )
    spread = blocks.where("_block > 0").repartition("_block")
    sized = blocks.where("_block = 0").unionByName(spread).withColumn(
        "_in_block", F.least(F.lit(block), F.col(times) - F.col("_block") * block).cast("int")
    )
    return sized.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_in_block")))).drop(
        "_block", "_in_block", "_n"
    )


def classify_accounts(accounts: DataFrame, cfg: Settings) -> DataFrame:
    """Add the rejection reason to every delivered account row."""
    rows = normalise_nulls(accounts, ACCOUNT_COLUMNS, cfg.null_tokens)
    incomplete = account_incomplete()
    bad_status = ~incomplete & ~F.col("account_status").isin(*cfg.account_statuses)
    flags = stage(
        rows.where(~blank("account_id"))
        .groupBy("account_id")
        .agg(
            F.max(incomplete).alias("_some_incomplete"),
            F.count_if(bad_status).alias(COPIES),
        )
        .where(F.col("_some_incomplete") & (F.col(COPIES) > 0)),
        "account-ids",
    )
    marked = mark(rows, flags, ["account_id"], cfg, matchable=bad_status)
    shielded = bad_status & F.coalesce("_some_incomplete", F.lit(False))
    reason = (
        F.when(incomplete, NULL_REQUIRED_FIELD)
        .when(bad_status & ~shielded, INVALID_ACCOUNT_STATUS)
    )
    return marked.select(*accounts.columns, reason.alias(REASON), shielded.alias(SHIELDED))
