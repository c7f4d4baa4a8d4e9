"""Proof that layers agree: counts, totals, references, equality of outputs.

Comparisons are unions with a tag and one aggregate, so both sides are pre-aggregated on
the map side and no row-level join is needed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.functions import week_start
from tallystone.operators.accounts import closing_balance_asof
from tallystone.operators.classify import REASON, SHIELDED
from tallystone.operators.skew import lookup
from tallystone.schemas import TOTAL
from tallystone.settings import Settings
from tallystone.sources.files import stage


def day_counts(rows: DataFrame, columns: list[str] | None = None, *also: Column) -> DataFrame:
    """Rows per date; with columns also an order-free checksum of their content; and other
    aggregates of the same pass."""
    aggregates = [F.count(F.lit(1)).alias("row_count")]
    if columns:
        filled = [F.coalesce(c, F.lit("\0")) for c in sorted(columns)]
        aggregates.append(F.sum(F.xxhash64(*filled).cast("decimal(38,0)")).alias("checksum"))
    return rows.groupBy("date").agg(*aggregates, *also)


def reconcile_loads(source: DataFrame, loaded: DataFrame) -> DataFrame:
    """What to do per date: LOAD (not there yet), KEEP (agrees), RELOAD (differs).

    Both sides come from ``day_counts``. A date that is loaded but has no source any more
    is KEEP: an absent file changes nothing.
    """
    has_checksum = "checksum" in source.columns and "checksum" in loaded.columns
    sides = [
        side.select(
            "date",
            F.lit(tag).alias("side"),
            "row_count",
            (F.col("checksum") if has_checksum else F.lit(None).cast("decimal(38,0)")).alias("checksum"),
        )
        for side, tag in ((source, "source"), (loaded, "loaded"))
    ]
    both = sides[0].unionByName(sides[1]).groupBy("date").agg(
        F.max(F.when(F.col("side") == "source", F.col("row_count"))).alias("source_rows"),
        F.max(F.when(F.col("side") == "loaded", F.col("row_count"))).alias("loaded_rows"),
        F.max(F.when(F.col("side") == "source", F.col("checksum"))).alias("source_sum"),
        F.max(F.when(F.col("side") == "loaded", F.col("checksum"))).alias("loaded_sum"),
    )
    same = (F.col("source_rows") == F.col("loaded_rows")) & F.col("source_sum").eqNullSafe(
        F.col("loaded_sum")
    )
    return both.select(
        "date", "source_rows", "loaded_rows",
        F.when(F.col("loaded_rows").isNull(), "LOAD")
        .when(F.col("source_rows").isNull() | same, "KEEP")
        .otherwise("RELOAD")
        .alias("action"),
    )


def _counts_by_day(tables: dict[str, DataFrame]) -> DataFrame:
    tagged = [
        df.groupBy("date").agg(F.count(F.lit(1)).alias("n")).withColumn("layer", F.lit(name))
        for name, df in tables.items()
    ]
    merged = reduce(DataFrame.unionByName, tagged).groupBy("date")
    return merged.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("layer") == name, F.col("n"))), F.lit(0)).alias(f"{name}_rows")
            for name in tables
        ]
    )


def mass_conservation(bronze: DataFrame, silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Per date: Bronze rows against Silver plus quarantined transactions."""
    counts = _counts_by_day(
        {
            "bronze": bronze,
            "silver": silver,
            "quarantine": quarantine.where(F.col("record_type") == "TRANSACTION"),
        }
    )
    return counts.withColumn(
        "difference", F.col("bronze_rows") - F.col("silver_rows") - F.col("quarantine_rows")
    )


def classified_conservation(classified: DataFrame) -> DataFrame:
    """The same from rows that are judged but not yet written: one pass, three counts."""
    rejected = F.col(REASON).isNotNull() | F.col(SHIELDED)
    counts = classified.groupBy("date").agg(
        F.count(F.lit(1)).alias("bronze_rows"),
        F.count_if(F.col(REASON).isNull() & ~F.col(SHIELDED)).alias("silver_rows"),
        F.count_if(rejected).alias("quarantine_rows"),
    )
    return counts.withColumn(
        "difference", F.col("bronze_rows") - F.col("silver_rows") - F.col("quarantine_rows")
    )


def table_counts(model: str, processed: DataFrame, written: DataFrame) -> DataFrame:
    """Records processed and written of a model, per date; both frames have one row per record
    and its date. Only Silver models reject."""
    tagged = processed.select("date", F.lit(0).alias("side")).unionByName(
        written.select("date", F.lit(1).alias("side"))
    )
    return tagged.groupBy("date").agg(
        F.lit(model).alias("model_name"),
        F.count_if(F.col("side") == 0).alias("records_processed"),
        F.count_if(F.col("side") == 1).alias("records_written"),
    ).select("date", "model_name", "records_processed", "records_written", F.lit(None).cast("long").alias("records_rejected"))


def layer_counts(
    bronze: DataFrame, silver: DataFrame, quarantine: DataFrame
) -> DataFrame:
    """Records processed, written and rejected per Silver transaction model and date; other
    models: ``table_counts``."""
    counts = _counts_by_day(
        {
            "bronze": bronze,
            "silver": silver,
            "quarantine": quarantine.where(F.col("record_type") == "TRANSACTION"),
        }
    )
    line = F.struct
    return counts.select(
        "date",
        F.explode(
            F.array(
                line(
                    F.lit("silver_transactions").alias("model_name"),
                    F.col("bronze_rows").alias("records_processed"),
                    F.col("silver_rows").alias("records_written"),
                    (F.col("bronze_rows") - F.col("silver_rows")).alias("records_rejected"),
                ),
                line(
                    F.lit("silver_quarantine").alias("model_name"),
                    F.col("bronze_rows").alias("records_processed"),
                    F.col("quarantine_rows").alias("records_written"),
                    F.col("quarantine_rows").alias("records_rejected"),
                ),
            )
        ).alias("r"),
    ).select("date", "r.*")


def _tie_out(left: DataFrame, right: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Values of both sides per key, and whether they are the same (null equals null)."""
    sides = left.withColumn("_side", F.lit("gold")).unionByName(
        right.withColumn("_side", F.lit("silver"))
    )
    picked = [
        F.max(F.when(F.col("_side") == side, F.col(v))).alias(f"{side}_{v}")
        for side in ("gold", "silver")
        for v in values
    ]
    rows = [
        F.count_if(F.col("_side") == side).alias(f"{side}_rows") for side in ("gold", "silver")
    ]
    agree = reduce(
        lambda a, b: a & b,
        [F.col(f"gold_{v}").eqNullSafe(F.col(f"silver_{v}")) for v in values],
        (F.col("gold_rows") == 1) & (F.col("silver_rows") == 1),
    )
    return sides.groupBy(*keys).agg(*picked, *rows).withColumn("agrees", agree)


def daily_tie_out(daily: DataFrame, silver: DataFrame) -> DataFrame:
    """Gold daily count and total against the resolvable Silver rows."""
    values = ["total_transactions", "total_signed_amount"]
    direct = silver.where(F.col("_is_resolvable")).groupBy("transaction_date").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum("_signed_amount").cast(TOTAL).alias("total_signed_amount"),
    )
    gold = daily.select(
        "transaction_date", "total_transactions",
        F.col("total_signed_amount").cast(TOTAL).alias("total_signed_amount"),
    )
    return _tie_out(gold, direct, ["transaction_date"], values)


def weekly_tie_out(
    weekly: DataFrame,
    silver: DataFrame,
    codes: DataFrame,
    cfg: Settings,
    accounts: DataFrame,
    bronze_accounts: DataFrame | None = None,
) -> DataFrame:
    """Gold weekly purchases, their average, sums and closing balance against the resolvable
    Silver rows and the account state (``accounts``, or ``bronze_accounts`` for as_of)."""
    sums = {"total_payments": "PAYMENT", "total_fees": "FEE", "total_interest": "INTEREST"}
    values = ["total_purchases", "avg_purchase_amount", *sums, "closing_balance"]
    kind = F.col("transaction_type")
    typed = lookup(
        silver.where(F.col("_is_resolvable")),
        codes.select("transaction_code", "transaction_type"),
        ["transaction_code"],
        cfg,
    )
    direct = typed.groupBy(
        "account_id", week_start(F.col("transaction_date")).alias("week_start_date")
    ).agg(
        F.count_if(kind == "PURCHASE").alias("total_purchases"),
        (
            F.sum(F.when(kind == "PURCHASE", F.col("_signed_amount"))).cast("double")
            / F.nullif(F.count_if(kind == "PURCHASE"), F.lit(0))
        ).alias("avg_purchase_amount"),
        *[
            F.coalesce(F.sum(F.when(kind == t, F.col("_signed_amount"))), F.lit(0)).cast(TOTAL).alias(v)
            for v, t in sums.items()
        ],
    )
    if cfg.balance == "as_of":
        ends = direct.withColumn("week_end_date", F.date_add("week_start_date", 6))
        direct = closing_balance_asof(ends, bronze_accounts).drop("week_end_date")
    else:
        state = accounts.select("account_id", F.col("current_balance").alias("closing_balance"))
        direct = direct.join(state, "account_id", "inner")
    gold = weekly.select(
        "account_id", "week_start_date", "total_purchases", "avg_purchase_amount", "closing_balance",
        *[F.col(v).cast(TOTAL).alias(v) for v in sums],
    )
    return _tie_out(gold, direct, ["account_id", "week_start_date"], values)


def referential_gaps(silver: DataFrame, codes: DataFrame, accounts: DataFrame) -> DataFrame:
    """Values used in Silver that their reference table does not hold, with row counts.

    Rows are first reduced to distinct values; a value that fills a third of the table
    meets the reference as one row."""
    by_code = silver.groupBy(F.col("transaction_code").alias("value")).agg(
        F.count(F.lit(1)).alias("silver_rows")
    )
    by_account = silver.where(F.col("_is_resolvable")).groupBy(
        F.col("account_id").alias("value")
    ).agg(F.count(F.lit(1)).alias("silver_rows"))
    missing_codes = by_code.join(
        codes.select(F.col("transaction_code").alias("value")), "value", "left_anti"
    ).select(F.lit("transaction_code").alias("reference"), "value", "silver_rows")
    missing_accounts = by_account.join(
        accounts.select(F.col("account_id").alias("value")), "value", "left_anti"
    ).select(F.lit("account_id").alias("reference"), "value", "silver_rows")
    return missing_codes.unionByName(missing_accounts)


def equivalence(a: DataFrame, b: DataFrame, ignore: list[str] | None = None) -> DataFrame:
    """Rows of one frame that the other lacks, with how many more there are.

    ``excess`` is positive for rows only (or more often) in ``a``. Empty means the two are
    equal as bags. One aggregate answers both directions.
    """
    skip = set(ignore or ())
    columns = [c for c in a.columns if c not in skip]
    if set(columns) != {c for c in b.columns if c not in skip}:
        raise ValueError("the frames have different columns")
    both = a.select(*columns, F.lit(1).alias("_sign")).unionByName(
        b.select(*columns, F.lit(-1).alias("_sign"))
    )
    return (
        both.groupBy(*columns).agg(F.sum("_sign").alias("excess")).where(F.col("excess") != 0)
    )


def equivalence_by_digest(
    a: DataFrame, b: DataFrame, ignore: list[str] | None = None, by: str = "date", buckets: int = 64
) -> tuple[DataFrame, DataFrame]:
    """(differing buckets, rows that differ): the same as ``equivalence`` for tables that are mostly
    equal, found down a tree of digests.

    Each row has a 64-bit hash of its content. Every value of `by` has a digest of all its rows (how
    many, and two order-free sums), and so has each of its buckets of hashes: partial aggregates that
    move a few numbers per bucket. Only rows of values and buckets whose digests differ are compared
    one by one; equal tables shuffle digests and nothing else.
    """
    skip = set(ignore or ())
    columns = [c for c in a.columns if c not in skip]
    if set(columns) != {c for c in b.columns if c not in skip}:
        raise ValueError("the frames have different columns")
    own = F.xxhash64(*[F.struct(F.col(c).isNull().alias("n"), F.col(c).alias("v")) for c in sorted(columns)])
    other = F.xxhash64(own, F.lit("again"), *sorted(columns))

    def hashed(side: DataFrame) -> DataFrame:
        return side.select(*columns, own.alias("_hash"), other.alias("_other")).withColumn("_bucket", F.pmod("_hash", F.lit(buckets)))

    def digests(side: DataFrame, sign: int) -> DataFrame:
        wide = "decimal(38,0)"
        return hashed(side).groupBy(F.col(by).alias("_by"), "_bucket").agg(
            (F.count(F.lit(1)) * sign).alias("n"),
            (F.sum(F.col("_hash").cast(wide)) * sign).cast(wide).alias("x"),
            (F.sum(F.col("_other").cast(wide)) * sign).cast(wide).alias("y"),
        )

    both = digests(a, 1).unionByName(digests(b, -1)).groupBy("_by", "_bucket")
    differing = both.agg(F.sum("n").alias("n"), F.sum("x").alias("x"), F.sum("y").alias("y"), F.count(F.lit(1)).alias("sides"))
    differing = stage(
        differing.where("n <> 0 or x <> 0 or y <> 0").select(F.col("_by").alias(by), F.col("_bucket").alias("bucket"), "sides"),
        "differing",
    )

    def suspects(side: DataFrame) -> DataFrame:
        rows, found = hashed(side), differing.select(F.col(by).alias("_by"), F.col("bucket").alias("_b"))
        match = F.col(by).eqNullSafe(F.col("_by")) & (F.col("_bucket") == F.col("_b"))
        return rows.join(found, match, "left_semi").select(*columns)

    return differing, equivalence(suspects(a), suspects(b))
