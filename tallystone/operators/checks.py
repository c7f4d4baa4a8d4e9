"""Column expectations: each check is one row with the number of failures."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.settings import CREDIT, DEBIT, REASONS


@dataclass(frozen=True)
class Expect:
    """``kind``: not_null, accepted_values or unique (one or more columns)."""

    kind: str
    columns: tuple[str, ...]
    values: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.kind}:{','.join(self.columns)}"


def not_null(*columns: str) -> list[Expect]:
    return [Expect("not_null", (c,)) for c in columns]


def unique(*columns: str) -> list[Expect]:
    return [Expect("unique", columns)]


def accepted_values(column: str, values: Iterable[str]) -> list[Expect]:
    return [Expect("accepted_values", (column,), tuple(values))]


# The expectations declared on each table.
EXPECTATIONS: dict[str, list[Expect]] = {
    "silver_transaction_codes": [
        *not_null("transaction_code", "debit_credit_indicator", "transaction_type", "_pipeline_run_id"),
        *accepted_values("debit_credit_indicator", (DEBIT, CREDIT)),
    ],
    "silver_accounts": [*not_null("account_id", "_pipeline_run_id"), *unique("account_id")],
    "silver_transactions": [
        *not_null("_signed_amount", "_pipeline_run_id"),
        *unique("transaction_id"),
    ],
    "silver_quarantine": [
        *not_null("_pipeline_run_id", "_rejection_reason"),
        *accepted_values("_rejection_reason", REASONS),
    ],
    "gold_daily_summary": [
        *not_null(
            "transaction_date", "total_transactions", "total_signed_amount",
            "online_transactions", "instore_transactions", "transactions_by_type",
            "_computed_at", "_pipeline_run_id", "_source_period_start", "_source_period_end",
        ),
        *unique("transaction_date"),
    ],
    "gold_weekly_account_summary": [
        *not_null(
            "week_start_date", "week_end_date", "account_id", "total_purchases",
            "avg_purchase_amount", "total_payments", "total_fees", "total_interest",
            "closing_balance", "_computed_at", "_pipeline_run_id",
        ),
        *unique("account_id", "week_start_date"),
    ],
}


def check_table(df: DataFrame, table: str, expectations: list[Expect] | None = None) -> DataFrame:
    """(table_name, check_name, failures).

    not_null and accepted_values count failing rows, all in one aggregate. unique counts
    the repeated keys: rows are first counted per key, with a map-side combine, so a key
    that fills a third of the table reaches one task as one row per input task. A key
    with a null column is not judged. A null value is not judged by accepted_values.
    """
    checks = EXPECTATIONS[table] if expectations is None else expectations
    flat = [c for c in checks if c.kind != "unique"]
    parts = []
    if flat:
        counted = df.agg(*[F.count_if(_fails(c)).alias(c.name) for c in flat])
        parts.append(
            counted.select(
                F.explode(
                    F.array(*[
                        F.struct(F.lit(c.name).alias("check_name"), F.col(f"`{c.name}`").alias("failures"))
                        for c in flat
                    ])
                ).alias("r")
            ).select("r.*")
        )
    for check in checks:
        if check.kind == "unique":
            keys = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in check.columns))
            parts.append(
                df.where(keys).groupBy(*check.columns).count()
                .agg(F.count_if(F.col("count") > 1).alias("failures"))
                .select(F.lit(check.name).alias("check_name"), "failures")
            )
    return reduce(DataFrame.unionByName, parts).select(
        F.lit(table).alias("table_name"), "check_name", "failures"
    )


def _fails(check: Expect) -> Column:
    column = F.col(check.columns[0])
    return column.isNull() if check.kind == "not_null" else ~column.isin(*check.values)


def check_tables(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, (check_table(df, name) for name, df in tables.items()))


def check_accounts_unique(accounts: DataFrame) -> DataFrame:
    """One row: total records, distinct accounts, and whether they agree."""
    per_id = accounts.groupBy("account_id").count()
    return per_id.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_records"),
        F.count("account_id").alias("unique_accounts"),
    ).withColumn("passed", F.col("total_records") == F.col("unique_accounts"))
