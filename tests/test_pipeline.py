"""Whole runs over generated CSV deliveries, against hand-computed results."""

from __future__ import annotations

from dataclasses import replace
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import NOW, day, seed_accounts, seed_transactions, write_csv
from pyspark.sql import functions as F

from tallystone.operators.quarantine import COLUMNS as quarantine_columns
from tallystone.operators.reconcile import equivalence, mass_conservation
from tallystone.plans.pipeline import run_backfill, run_next, run_range
from tallystone.schemas import ACCOUNT_COLUMNS, TRANSACTION_COLUMNS, VOLATILE_COLUMNS
from tallystone.sources.lake import Lake, load_idempotent
from tallystone.streaming.drops import stream_next

DAILY = {  # date: total, then count and sum of purchases, payments, interest
    1: (-30, 2, 170, 1, -200, 0, 0),
    2: (-170, 2, 130, 1, -300, 0, 0),
    3: (-375, 1, 95, 1, -500, 1, 30),
    4: (-160, 2, 240, 1, -400, 0, 0),
    5: (-710, 2, 90, 1, -800, 0, 0),
    6: (-230, 2, 370, 1, -600, 0, 0),
}
WEEKLY = {
    "ACC-001": (4, 132.5, -1000, 0, 30, Decimal("1350.000")),
    "ACC-002": (4, 66.25, -1100, 0, 0, Decimal("480.000")),
    "ACC-003": (3, 100.0, -700, 0, 0, Decimal("1800.000")),
}
TABLES = ["silver/transactions", "silver/quarantine", "silver/accounts", "gold/daily_summary", "gold/weekly_account_summary"]


def daily_rows(lake):
    out = {}
    for r in lake.read("gold/daily_summary").collect():
        t = r["transactions_by_type"]
        assert (r["total_transactions"], r["online_transactions"], r["instore_transactions"]) == (3, 2, 1)
        assert t["FEE"] == (0, 0) and t["REFUND"] == (0, 0)
        out[r["transaction_date"].day] = (
            r["total_signed_amount"], *t["PURCHASE"], *t["PAYMENT"], *t["INTEREST"]
        )
    return out


def weekly_rows(lake):
    rows = lake.read("gold/weekly_account_summary").collect()
    assert {(r["week_start_date"], r["week_end_date"]) for r in rows} == {(day(1), day(7))}
    return {
        r["account_id"]: (
            r["total_purchases"], r["avg_purchase_amount"], r["total_payments"],
            r["total_fees"], r["total_interest"], r["closing_balance"],
        )
        for r in rows
    }


def same(a, b):
    return equivalence(a, b, VOLATILE_COLUMNS).isEmpty()


def test_range_gives_the_expected_layers(spark, loaded):
    lake = Lake(spark, loaded)
    assert lake.get_watermark() == day(6) and lake.get_next_date() == day(7)
    assert [lake.bronze(e).count() for e in ("transactions", "accounts", "transaction_codes")] == [30, 17, 4]
    silver = lake.read("silver/transactions")
    assert silver.count() == 24 and silver.where("_is_resolvable").count() == 18
    quarantine = lake.read("silver/quarantine")
    assert {(r["_rejection_reason"], r["count"]) for r in quarantine.groupBy("_rejection_reason").count().collect()} == {("INVALID_CHANNEL", 6)}
    assert daily_rows(lake) == DAILY
    assert weekly_rows(lake) == WEEKLY
    conserved = mass_conservation(lake.bronze("transactions"), silver, quarantine)
    assert conserved.where("difference != 0").isEmpty() and conserved.count() == 6
    log = lake.run_log()
    assert log.where("status != 'SUCCESS'").isEmpty()
    assert log.where("layer != 'SILVER' and records_rejected is not null").isEmpty()
    rejected = log.where("model_name = 'silver_quarantine'").agg(F.sum("records_rejected")).first()[0]
    assert rejected == 6
    assert log.where("completed_at < started_at").isEmpty()


def test_rerun_changes_nothing(spark, loaded):
    lake = Lake(spark, loaded)
    before = {t: lake.read(t).toPandas() for t in TABLES}
    bronze_runs = {r[0] for r in lake.bronze("transactions").select("_pipeline_run_id").distinct().collect()}
    assert run_range(spark, day(1), day(6), loaded).advanced
    for t in TABLES:
        old = spark.createDataFrame(before[t], lake.read(t).schema)
        assert same(old, lake.read(t)), t
    assert bronze_runs == {r[0] for r in lake.bronze("transactions").select("_pipeline_run_id").distinct().collect()}


def test_days_one_by_one_equal_the_range(spark, loaded, tmp_path):
    stepwise = replace(loaded, lake_dir=str(tmp_path / "stepwise"))
    run_range(spark, day(1), day(4), stepwise)
    for _ in range(2):
        assert run_next(spark, stepwise).advanced
    for t in TABLES:
        assert same(Lake(spark, loaded).read(t), Lake(spark, stepwise).read(t)), t


def test_stream_equals_the_range(spark, loaded, tmp_path):
    streamed = replace(loaded, lake_dir=str(tmp_path / "streamed"))
    results = stream_next(spark, streamed, str(tmp_path / "cp"), files_per_batch=4)
    assert len(results) == 2 and all(r.advanced for r in results)
    assert stream_next(spark, streamed, str(tmp_path / "cp")) == []
    for t in TABLES:
        assert same(Lake(spark, loaded).read(t), Lake(spark, streamed).read(t)), t


def test_no_file_is_a_no_op(spark, loaded, tmp_path):
    with pytest.raises(RuntimeError):
        run_next(spark, replace(loaded, lake_dir=str(tmp_path / "new")))
    lake = Lake(spark, loaded)
    result = run_next(spark, loaded)
    assert not result.advanced and lake.get_watermark() == day(6)
    log = lake.run_log().where(F.col("run_id") == result.run_id)
    assert log.count() == 8
    assert log.where("status != 'SKIPPED' or processed_date is not null").isEmpty()
    assert day(7) not in lake.days("bronze/transactions")


def test_watermark_never_leaves_a_gap_or_goes_back(spark, loaded):
    with pytest.raises(ValueError):
        run_range(spark, day(8), day(9), loaded)
    lake = Lake(spark, loaded)
    assert lake.set_watermark(day(2), "r", NOW) == day(6)
    assert lake.get_watermark() == day(6)


def test_bad_header_fails_its_day_only(spark, seeded, tmp_path):
    source = tmp_path / "source"
    write_csv(source / "transactions_2024-01-02.csv", [*TRANSACTION_COLUMNS[:-1], "chanel"], seed_transactions(2))
    result = run_range(spark, day(1), day(3), seeded)
    lake = Lake(spark, seeded)
    assert not result.advanced and lake.get_watermark() is None
    assert lake.days("bronze/transactions") == [day(1), day(3)] == lake.days("silver/transactions")
    failed = lake.run_log().where("status = 'FAILED'").collect()
    assert [(r["model_name"], r["processed_date"], r["records_processed"]) for r in failed] == [("bronze_transactions", day(2), 5)]
    assert failed[0]["error_message"] == "the header of this transactions delivery has no column channel, unknown column chanel"


def test_columns_in_another_order_are_read_by_name(spark, seeded, tmp_path):
    turned = list(reversed(TRANSACTION_COLUMNS))
    rows = [tuple(reversed(r)) for r in seed_transactions(2)]
    write_csv(tmp_path / "source" / "transactions_2024-01-02.csv", turned, rows)
    assert run_range(spark, day(1), day(6), seeded).advanced
    assert daily_rows(Lake(spark, seeded)) == DAILY


def test_missing_accounts_do_not_hold_back(spark, seeded, tmp_path):
    (tmp_path / "source" / "accounts_2024-01-04.csv").unlink()
    assert run_range(spark, day(1), day(6), seeded).advanced
    assert daily_rows(Lake(spark, seeded)) == DAILY


def test_missing_codes_stop_silver(spark, seeded, tmp_path):
    (tmp_path / "source" / "transaction_codes.csv").unlink()
    result = run_range(spark, day(1), day(1), seeded)
    lake = Lake(spark, seeded)
    assert not result.advanced and not lake.has("silver/transactions")
    failed = lake.run_log().where("status = 'FAILED'").collect()
    assert [(r["model_name"], r["error_message"]) for r in failed] == [
        ("silver_transaction_codes", "there is no transaction code at all")
    ]


def test_load_repairs_only_what_differs(spark, seeded, tmp_path):
    args = (spark, "transactions", day(1), day(7), seeded)
    first = load_idempotent(*args, "r1", NOW).orderBy("date").collect()
    assert [(r["status"], r["records_written"]) for r in first] == [("SUCCESS", 5)] * 6 + [("SKIPPED", None)]
    write_csv(tmp_path / "source" / "transactions_2024-01-03.csv", TRANSACTION_COLUMNS, seed_transactions(3)[:4])
    changed = [list(r) for r in seed_transactions(4)]
    changed[0][3] = "999.00"
    write_csv(tmp_path / "source" / "transactions_2024-01-04.csv", TRANSACTION_COLUMNS, changed)
    load_idempotent(*args, "r2", NOW).count()
    lake = Lake(spark, seeded)
    runs = lambda: {(r["date"].day, r["_pipeline_run_id"], r["count"]) for r in lake.bronze("transactions").groupBy("date", "_pipeline_run_id").count().collect()}
    assert runs() == {(1, "r1", 5), (2, "r1", 5), (3, "r2", 4), (4, "r1", 5), (5, "r1", 5), (6, "r1", 5)}
    checked = replace(seeded, verify="checksum")
    load_idempotent(spark, "transactions", day(1), day(7), checked, "r3", NOW).count()
    assert {r for r in runs() if r[1] == "r3"} == {(4, "r3", 5)}


def test_late_duplicate_takes_back_the_earlier_row(spark, seeded, tmp_path):
    rows = seed_transactions(6)
    rows.append(("T2-1", "ACC-001", "2024-01-06", "85.00", "PURCH01", "Shop", "ONLINE"))
    write_csv(tmp_path / "source" / "transactions_2024-01-06.csv", TRANSACTION_COLUMNS, rows)
    whole = replace(seeded, lake_dir=str(tmp_path / "whole"))
    run_range(spark, day(1), day(6), whole)
    run_range(spark, day(1), day(5), seeded)
    result = run_next(spark, seeded)
    assert result.advanced and result.rewritten == [day(2), day(6)]
    lake = Lake(spark, seeded)
    assert lake.read("silver/transactions").where("transaction_id = 'T2-1'").isEmpty()
    assert lake.read("silver/quarantine").where("_rejection_reason = 'DUPLICATE_TRANSACTION_ID'").count() == 2
    for t in TABLES:
        assert same(lake.read(t), Lake(spark, whole).read(t)), t
    kept = replace(seeded, lake_dir=str(tmp_path / "kept"), retract=False)
    run_range(spark, day(1), day(5), kept)
    assert run_next(spark, kept).rewritten == [day(6)]
    assert Lake(spark, kept).read("silver/transactions").where("transaction_id = 'T2-1'").count() == 1


def test_day_that_loses_all_rows_loses_its_partition(spark, loaded):
    bad = [(f"X{i}", "ACC-001", "2024-01-02", "-1", "PURCH01", None, "ONLINE") for i in range(3)]
    write_csv(Path(loaded.source_dir) / "transactions_2024-01-02.csv", TRANSACTION_COLUMNS, bad)
    run_range(spark, day(2), day(2), loaded)
    lake = Lake(spark, loaded)
    left = [day(i) for i in (1, 3, 4, 5, 6)]
    assert lake.days("silver/transactions") == left
    assert sorted(r["transaction_date"] for r in lake.read("gold/daily_summary").collect()) == left


def test_backfill_resolves_late_accounts(spark, seeded, tmp_path):
    run_range(spark, day(1), day(5), seeded)
    lake = Lake(spark, seeded)
    assert run_backfill(spark, seeded).rewritten == []
    late = [*seed_accounts(6), ("ACC-ORPHAN", "Late", "PENDING", "100.00", "5.00", "2020-01-01", "a", "b")]
    write_csv(tmp_path / "source" / "accounts_2024-01-06.csv", ACCOUNT_COLUMNS, late)
    run_next(spark, seeded)
    assert lake.read("silver/transactions").where("not _is_resolvable").count() == 5
    result = run_backfill(spark, seeded)
    assert result.rewritten == [day(i) for i in range(1, 6)]
    assert lake.read("silver/transactions").where("not _is_resolvable").isEmpty()
    totals = {r[0]: r[1] for r in lake.read("gold/daily_summary").select("transaction_date", "total_transactions").collect()}
    assert totals == {day(i): 4 for i in range(1, 7)}
    table = lake.read("silver/quarantine")
    assert set(quarantine_columns) <= set(table.columns)
    bad = table.where("record_type = 'ACCOUNT'").collect()
    assert [(r["account_id"], r["account_status"], r["_rejection_reason"], r["transaction_id"]) for r in bad] == [
        ("ACC-ORPHAN", "PENDING", "INVALID_ACCOUNT_STATUS", None)
    ]
    assert table.where("record_type = 'TRANSACTION' and transaction_id like 'T%' and customer_name is null").count() == 6


@pytest.mark.parametrize("change", [
    {"hot_rows": 1, "broadcast_rows": 0, "resolvable": "latest"},
    {"hot_rows": 2, "broadcast_rows": 0, "quarantine": "per_id", "balance": "as_of"},
    {"hot_rows": 1, "duplicates": "keep_first"},
])
def test_other_join_paths_and_modes_agree_on_the_seed(spark, seeded, change):
    cfg = replace(seeded, **change)
    assert run_range(spark, day(1), day(6), cfg).advanced
    lake = Lake(spark, cfg)
    assert daily_rows(lake) == DAILY
    assert weekly_rows(lake) == WEEKLY
    assert lake.read("silver/quarantine").count() == 6


def test_rows_shuffled_by_id_give_the_same_lake(spark, loaded, tmp_path):
    """As if the repeated ids were too many to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = replace(loaded, lake_dir=str(tmp_path / "wide"), hot_rows=3)
        assert run_range(spark, day(1), day(6), wide).advanced
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for t in TABLES:
        assert same(Lake(spark, loaded).read(t), Lake(spark, wide).read(t)), t


def test_stream_repeats_a_failed_batch(spark, seeded, tmp_path):
    source = Path(seeded.source_dir)
    codes = (source / "transaction_codes.csv").read_text()
    (source / "transaction_codes.csv").unlink()
    with pytest.raises(Exception, match="transaction"):
        stream_next(spark, seeded, str(tmp_path / "cp"))
    assert Lake(spark, seeded).get_watermark() is None
    (source / "transaction_codes.csv").write_text(codes)
    results = stream_next(spark, seeded, str(tmp_path / "cp"))
    assert results and results[-1].watermark == day(6)
    assert daily_rows(Lake(spark, seeded)) == DAILY


def test_stream_watermark_waits_for_a_missing_day(spark, seeded, tmp_path):
    source, lake = Path(seeded.source_dir), Lake(spark, seeded)
    kept = (source / "transactions_2024-01-02.csv").read_text()
    (source / "transactions_2024-01-02.csv").unlink()
    stream_next(spark, seeded, str(tmp_path / "cp"))
    assert lake.get_watermark() == day(1) and day(3) in lake.days("bronze/transactions")
    (source / "transactions_2024-01-02.csv").write_text(kept)
    (result,) = stream_next(spark, seeded, str(tmp_path / "cp"))
    assert result.days == [day(2)] and lake.get_watermark() == day(6)
    assert daily_rows(lake) == DAILY


def test_stream_loads_accounts_of_days_without_transactions(spark, seeded, tmp_path):
    source = Path(seeded.source_dir)
    new = ("ACC-004", *seed_accounts(6)[0][1:])
    # Accounts alone: before all transactions, inside a gap of theirs, and after them.
    write_csv(source / "accounts_2023-12-20.csv", ACCOUNT_COLUMNS, [("ACC-005", *new[1:])])
    write_csv(source / "accounts_2024-01-08.csv", ACCOUNT_COLUMNS, [new])
    row = seed_transactions(6)[0]
    write_csv(source / "transactions_2024-01-10.csv", TRANSACTION_COLUMNS, [(f"T10-{a}", a, "2024-01-10", *row[3:]) for a in ("ACC-004", "ACC-005")])
    write_csv(source / "accounts_2024-01-12.csv", ACCOUNT_COLUMNS, [("ACC-006", *new[1:])])
    streamed = replace(seeded, lake_dir=str(tmp_path / "streamed"))
    results = stream_next(spark, streamed, str(tmp_path / "cp"))
    assert all(r.advanced for r in results) and Lake(spark, streamed).get_watermark() == day(6)
    ranged = replace(seeded, skippable=("bronze_accounts", "bronze_transactions"))
    assert run_range(spark, day(20).replace(year=2023, month=12), day(12), ranged).advanced
    silver = Lake(spark, streamed).read("silver/transactions").where("date = '2024-01-10'")
    assert [r["_is_resolvable"] for r in silver.collect()] == [True, True]
    for t in TABLES:
        assert same(Lake(spark, seeded).read(t), Lake(spark, streamed).read(t)), t


def test_a_released_duplicate_comes_back_under_the_same_run_id(spark, seeded, tmp_path):
    path = Path(seeded.source_dir) / "transactions_2024-01-02.csv"
    rows = seed_transactions(2)
    write_csv(path, TRANSACTION_COLUMNS, [*rows, seed_transactions(1)[0]])
    assert run_range(spark, day(1), day(6), seeded, run_id="same").advanced
    lake = Lake(spark, seeded)
    assert lake.read("silver/transactions").where("transaction_id = 'T1-1'").isEmpty()
    write_csv(path, TRANSACTION_COLUMNS, rows)
    assert run_range(spark, day(2), day(2), seeded, run_id="same").advanced
    fresh = replace(seeded, lake_dir=str(tmp_path / "fresh"))
    assert run_range(spark, day(1), day(6), fresh).advanced
    for t in TABLES:
        assert same(lake.read(t), Lake(spark, fresh).read(t)), t


def test_a_day_that_turns_all_bad_leaves_no_old_rows(spark, seeded):
    assert run_range(spark, day(1), day(6), seeded, run_id="same").advanced
    bad = [(r[0], r[1], r[2], r[3], "NOPE", *r[5:]) for r in seed_transactions(2)] + [("T2-9", "ACC-001", "2024-01-02", "1.00", "NOPE", None, "ONLINE")]
    write_csv(Path(seeded.source_dir) / "transactions_2024-01-02.csv", TRANSACTION_COLUMNS, bad)
    assert run_range(spark, day(2), day(2), seeded, run_id="same").advanced
    lake = Lake(spark, seeded)
    assert lake.read("silver/transactions").where(F.col("date") == day(2)).isEmpty()
    assert lake.read("silver/quarantine").where("record_type = 'TRANSACTION'").where(F.col("date") == day(2)).count() == 6


def test_a_backfill_outlasts_a_rerun(spark, loaded):
    lake = Lake(spark, loaded)
    late = Path(loaded.source_dir) / "accounts_2024-01-06.csv"
    write_csv(late, ACCOUNT_COLUMNS, [*seed_accounts(6), ("ACC-ORPHAN", *seed_accounts(6)[0][1:])])
    assert run_range(spark, day(6), day(6), loaded).advanced
    run_backfill(spark, loaded)
    before = lake.read("silver/transactions").where("_is_resolvable").count()
    assert run_range(spark, day(1), day(6), loaded).advanced
    assert lake.read("silver/transactions").where("_is_resolvable").count() == before == 24


def test_bad_codes_leave_the_good_table(spark, loaded):
    lake = Lake(spark, loaded)
    write_csv(Path(loaded.source_dir) / "transaction_codes.csv", ["transaction_code", "description", "debit_credit_indicator", "transaction_type", "affects_balance"], [(None, "x", "DR", "PURCHASE", "true")] * 5)
    assert not run_range(spark, day(6), day(6), loaded).advanced
    assert lake.read("silver/transaction_codes").where("transaction_code is null").isEmpty()


def test_account_state_is_merged_or_built_anew(spark, seeded, tmp_path):
    lake = Lake(spark, seeded)
    assert run_range(spark, day(1), day(3), seeded).advanced
    for _ in range(2):
        assert run_next(spark, seeded).advanced
    # The last day again, with other balances: what was merged from it before must go.
    write_csv(Path(seeded.source_dir) / "accounts_2024-01-05.csv", ACCOUNT_COLUMNS, seed_accounts(4)[:2])
    assert run_range(spark, day(5), day(5), seeded).advanced
    fresh = replace(seeded, lake_dir=str(tmp_path / "fresh"))
    assert run_range(spark, day(1), day(5), fresh).advanced
    assert same(lake.read("silver/accounts"), Lake(spark, fresh).read("silver/accounts"))
