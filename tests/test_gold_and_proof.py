"""Rollups at the edges of weeks, and proofs that notice what is wrong."""

from __future__ import annotations

from dataclasses import replace
from datetime import date
from decimal import Decimal

import pytest
from conftest import CODES, NOW
from pyspark.sql import functions as F

from tallystone.operators import checks, lineage, reconcile, runlog
from tallystone.operators.accounts import latest_accounts
from tallystone.operators.gold import gold_daily, gold_weekly_account, type_json
from tallystone.schemas import RUN_LOG, bronze_schema
from tallystone.settings import Settings

CFG = Settings()
SILVER = (
    "transaction_id string, account_id string, transaction_date date, transaction_code string, channel string, "
    "_signed_amount decimal(18,3), _is_resolvable boolean, _pipeline_run_id string, _source_file string, date date"
)


def sale(id, account, day, amount, code="PURCH01", channel="ONLINE", ok=True, run="r1"):
    return (id, account, day, code, channel, Decimal(amount), ok, run, f"transactions_{day}.csv", day)


@pytest.fixture(scope="module")
def codes(spark):
    rows = [(*c, "r", NOW, "f", date(2024, 1, 1)) for c in CODES]
    return spark.createDataFrame(rows, bronze_schema("transaction_codes")).drop("date")


def accounts(spark, rows):
    full = [(a, "n", "ACTIVE", "1", b, "2020-01-01", "1", "2", "r", NOW, f"accounts_{d}.csv", d) for a, b, d in rows]
    return spark.createDataFrame(full, bronze_schema("accounts"))


DAYS = [date(2024, 1, 7), date(2024, 1, 8), date(2023, 12, 31), date(2024, 12, 31)]


def test_weeks_run_from_monday_to_sunday(spark, codes):
    silver = spark.createDataFrame([sale(f"t{i}", "A", d, "5") for i, d in enumerate(DAYS)], SILVER)
    state = latest_accounts(accounts(spark, [("A", "9", DAYS[0])]), NOW)
    rows = gold_weekly_account(silver, codes, state, NOW, CFG).collect()
    assert sorted((r["week_start_date"], r["week_end_date"]) for r in rows) == [
        (date(2023, 12, 25), date(2023, 12, 31)), (date(2024, 1, 1), date(2024, 1, 7)),
        (date(2024, 1, 8), date(2024, 1, 14)), (date(2024, 12, 30), date(2025, 1, 5)),
    ]


def test_no_purchase_means_no_average(spark, codes):
    d = DAYS[0]
    silver = spark.createDataFrame(
        [sale("1", "A", d, "-7", "PAY01"), sale("2", "A", d, "2", "OTHER"), sale("3", "B", d, "4"), sale("4", "A", d, "9", ok=False)],
        SILVER,
    )
    state = latest_accounts(accounts(spark, [("A", "1", d)]), NOW)
    rows = gold_weekly_account(silver, codes, state, NOW, CFG).collect()
    assert [(r["account_id"], r["total_purchases"], r["avg_purchase_amount"], r["total_payments"], r["total_fees"]) for r in rows] == [("A", 0, None, -7, 0)]
    daily = gold_daily(silver, codes, NOW, CFG).collect()[0]
    assert (daily["total_transactions"], daily["total_signed_amount"]) == (3, -1)
    text = type_json(gold_daily(silver, codes, NOW, CFG)).first()["transactions_by_type"]
    assert text.startswith('{"PURCHASE":{"count":1,"sum":4.000},"PAYMENT":{"count":1,"sum":-7.000}')


def test_closing_balance_as_of_the_week(spark, codes):
    d = date(2024, 1, 3)
    weeks = [d, date(2024, 1, 10), date(2024, 1, 24)]
    silver = spark.createDataFrame(
        [sale(f"{a}{i}", a, w, "5") for a in ("A", "B", "C") for i, w in enumerate(weeks)], SILVER
    )
    delivered = accounts(spark, [
        ("A", "1", date(2024, 1, 1)), ("A", "2", date(2024, 1, 7)), ("A", "3", date(2024, 1, 15)),
        ("B", "8", date(2024, 1, 16)), ("A", None, date(2024, 1, 28)),
    ])
    state = latest_accounts(delivered, NOW)
    rows = gold_weekly_account(silver, codes, state, NOW, replace(CFG, balance="as_of"), delivered).collect()
    got = {(r["account_id"], r["week_start_date"].day): r["closing_balance"] for r in rows}
    assert got == {("A", 1): 2, ("A", 8): 2, ("A", 22): None, ("B", 1): 8, ("B", 8): 8, ("B", 22): 8}
    with pytest.raises(ValueError):
        gold_weekly_account(silver, codes, state, NOW, replace(CFG, balance="as_of"))


def test_expectations_count_failures(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), (None, "y"), ("b", None), (None, "x")], "k string, v string")
    wanted = [*checks.not_null("k", "v"), *checks.unique("k"), *checks.unique("k", "v"), *checks.accepted_values("v", ["x"])]
    got = {r["check_name"]: r["failures"] for r in checks.check_table(df, "t", wanted).collect()}
    assert got == {"not_null:k": 2, "not_null:v": 1, "unique:k": 1, "unique:k,v": 1, "accepted_values:v": 1}


def test_accounts_unique_notices_repeats(spark):
    twice = spark.createDataFrame([("a",), ("a",), ("b",)], "account_id string")
    assert not checks.check_accounts_unique(twice).first()["passed"]
    assert checks.check_accounts_unique(twice.distinct()).first()["passed"]


def test_tie_outs_notice_a_wrong_total(spark, codes):
    d = DAYS[0]
    silver = spark.createDataFrame([sale("1", "A", d, "5"), sale("2", "A", DAYS[1], "6")], SILVER)
    daily = gold_daily(silver, codes, NOW, CFG)
    assert reconcile.daily_tie_out(daily, silver).where(~F.col("agrees")).isEmpty()
    off = daily.withColumn("total_signed_amount", F.col("total_signed_amount") + F.when(F.col("transaction_date") == d, 1).otherwise(0))
    assert [r["transaction_date"] for r in reconcile.daily_tie_out(off, silver).where(~F.col("agrees")).collect()] == [d]
    missing = daily.where(F.col("transaction_date") != d)
    assert reconcile.daily_tie_out(missing, silver).where(~F.col("agrees")).count() == 1
    doubled = daily.unionByName(daily)
    assert reconcile.daily_tie_out(doubled, silver).where(~F.col("agrees")).count() == 2


def test_equivalence_counts_copies(spark):
    a = spark.createDataFrame([("x", 1), ("x", 1), ("y", None)], "k string, v int")
    b = spark.createDataFrame([("x", 1), ("y", None), ("z", 2)], "k string, v int")
    assert {(r["k"], r["excess"]) for r in reconcile.equivalence(a, b).collect()} == {("x", 1), ("z", -1)}
    assert reconcile.equivalence(a, a.select("v", "k")).isEmpty()
    with pytest.raises(ValueError):
        reconcile.equivalence(a, b.drop("v"))


def test_referential_gaps(spark, codes):
    silver = spark.createDataFrame([sale("1", "A", DAYS[0], "5"), sale("2", "GONE", DAYS[0], "5", "NEW"), sale("3", "X", DAYS[0], "5", ok=False)], SILVER)
    gaps = reconcile.referential_gaps(silver, codes, latest_accounts(accounts(spark, [("A", "1", DAYS[0])]), NOW))
    assert {tuple(r) for r in gaps.collect()} == {("transaction_code", "NEW", 1), ("account_id", "GONE", 1)}


def log_frame(spark, rows):
    full = [(run, "HISTORICAL", model, layer, NOW, NOW, status, 1, 1, 1, message, None) for run, model, layer, status, message in rows]
    return spark.createDataFrame(full, RUN_LOG)


def test_log_gates(spark):
    log = log_frame(spark, [
        ("good", "m", "GOLD", "SUCCESS", None), ("good", "bronze_accounts", "BRONZE", "SKIPPED", None),
        ("skip", "bronze_transactions", "BRONZE", "SKIPPED", None), ("skip", "m", "GOLD", "SUCCESS", None),
        ("bad", "m", "GOLD", "FAILED", "a Secret"), ("bad", "m", "GOLD", "SUCCESS", None),
    ])
    assert [runlog.check_log_complete(log, r, CFG) for r in ("good", "skip", "bad", "absent")] == [True, False, False, False]
    assert not runlog.check_log_complete(log, "good", replace(CFG, skippable=()))
    assert runlog.check_messages_clean(log, "good", CFG) and not runlog.check_messages_clean(log, "bad", CFG)


def test_lineage_and_run_audit(spark, codes):
    d = DAYS[0]
    silver = spark.createDataFrame([sale("1", "A", d, "5"), sale("2", "A", d, "6", run="r2")], SILVER)
    log = log_frame(spark, [("r1", "bronze_transactions", "BRONZE", "SUCCESS", None), ("r2", "bronze_transactions", "BRONZE", "SKIPPED", None)])
    rows = lineage.lineage_trace(gold_daily(silver, codes, NOW, CFG), silver, silver, log).collect()
    assert {(r["_pipeline_run_id"], r["silver_rows"], r["bronze_rows"], r["has_success_log"]) for r in rows} == {("r1", 1, 1, True), ("r2", 1, 1, False)}
    assert [r["run_id"] for r in lineage.unlogged_runs(silver, log).collect()] == ["r2"]
    assert [r["run_id"] for r in lineage.skipped_run_leaks(silver, log).collect()] == ["r2"]
