"""The registered queries: every operator over the given tables.

Results are rendered for comparison across engines: days as text, money as double, flags
as 0/1, counts as bigint. Columns that hold the clock are left out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.operators import accounts as acc
from tallystone.operators import checks, gold, lineage, reconcile, runlog
from tallystone.operators.classify import REASON, SHIELDED, classify_accounts, classify_transactions
from tallystone.operators.codes import silver_codes
from tallystone.operators.promote import (
    accepted,
    not_quarantined,
    promote_transactions,
    resolve_late_accounts,
)
from tallystone.operators.quarantine import build_quarantine, first_reasons
from tallystone.plans.pipeline import UNRESOLVED, days_that_may_hold, index_ids, run_backfill, run_next, run_range
from tallystone.schemas import TRANSACTION_COLUMNS
from tallystone.settings import TRANSACTION_TYPES, Settings
from tallystone.sources import bindings as b
from tallystone.sources import daily_csv
from tallystone.sources.audit import changed_sources, source_digests
from tallystone.sources.bindings import NOW
from tallystone.sources.files import remove_folder, scratch_path, stage
from tallystone.sources.lake import Lake, load_idempotent, load_plan
from tallystone.sources.versions import VersionedTable
from tallystone.streaming.drops import stream_next

CFG = Settings(resolvable="latest")
Query = Callable[[SparkSession, str], DataFrame]


def _day(column: str) -> Column:
    return F.col(column).cast("string").alias(column)


def _money(column: str) -> Column:
    return F.col(column).cast("double").alias(column)


def _flag(column: str) -> Column:
    return F.col(column).cast("int").alias(column)


def _count(column: str) -> Column:
    return F.col(column).cast("bigint").alias(column)


# Shared parts of the queries


def _classified_events(spark: SparkSession, sf: str) -> DataFrame:
    return classify_transactions(b.event_transactions(spark, sf), b.codes(spark, b.EVENT_CODES), CFG)


def _lines(spark: SparkSession, sf: str, columns: list[str] | None = None) -> DataFrame:
    """The joined lines as a written table: rules read Bronze more than once."""
    return stage(b.line_transactions(spark, sf).select(*columns or ["*"]), "lines")


def _classified_lines(
    spark: SparkSession, sf: str, cfg: Settings = CFG, bronze: DataFrame | None = None
) -> DataFrame:
    bronze = _lines(spark, sf) if bronze is None else bronze
    return classify_transactions(bronze, b.codes(spark, b.LINE_CODES), cfg)


def _silver(spark: SparkSession, sf: str, cfg: Settings = CFG) -> DataFrame:
    """Promoted events against the delivered customers."""
    known = acc.first_seen(b.customer_accounts(spark, sf))
    bronze = b.event_transactions(spark, sf)
    return promote_transactions(
        accepted(_classified_events(spark, sf)), b.codes(spark, b.EVENT_CODES), known, NOW, cfg,
        keys_from=bronze.select("account_id", "date"),
    )


def _accounts(spark: SparkSession, sf: str) -> DataFrame:
    return acc.latest_accounts(b.customer_accounts(spark, sf), NOW)


def _daily(spark: SparkSession, sf: str, silver: DataFrame | None = None) -> DataFrame:
    silver = _silver(spark, sf) if silver is None else silver
    return gold.gold_daily(silver, b.codes(spark, b.EVENT_CODES), NOW, CFG)


def _weekly(spark: SparkSession, sf: str, cfg: Settings = CFG, silver: DataFrame | None = None) -> DataFrame:
    return gold.gold_weekly_account(
        _silver(spark, sf) if silver is None else silver,
        b.codes(spark, b.EVENT_CODES), _accounts(spark, sf), NOW, cfg,
        bronze_accounts=b.customer_accounts(spark, sf),
    )


def _show_daily(daily: DataFrame) -> DataFrame:
    kinds = [
        c
        for t in TRANSACTION_TYPES
        for c in (
            F.col(f"transactions_by_type.{t}.count").alias(f"{t.lower()}_count"),
            F.col(f"transactions_by_type.{t}.sum").cast("double").alias(f"{t.lower()}_sum"),
        )
    ]
    return daily.select(
        _day("transaction_date"), _count("total_transactions"), _money("total_signed_amount"),
        _count("online_transactions"), _count("instore_transactions"), *kinds,
        "_pipeline_run_id", _day("_source_period_start"), _day("_source_period_end"),
    )


def _show_weekly(weekly: DataFrame) -> DataFrame:
    return weekly.select(
        _day("week_start_date"), _day("week_end_date"), "account_id", _count("total_purchases"),
        F.round("avg_purchase_amount", 6).alias("avg_purchase_amount"),
        _money("total_payments"), _money("total_fees"), _money("total_interest"),
        _money("closing_balance"), "_pipeline_run_id",
    )


def _show_silver(silver: DataFrame) -> DataFrame:
    return silver.select(
        "transaction_id", "account_id", _day("transaction_date"), _money("amount"),
        "transaction_code", "merchant_name", "channel", "debit_credit_indicator",
        _money("_signed_amount"), _flag("_is_resolvable"), "_pipeline_run_id", "_source_file",
    )


def _reasons(classified: DataFrame) -> DataFrame:
    return classified.select(
        "transaction_id", "account_id", "transaction_date", _money("amount"), "transaction_code",
        F.coalesce("channel", F.lit("(none)")).alias("channel"),
        F.coalesce(REASON, F.lit("(none)")).alias("reason"),
        F.col(SHIELDED).cast("int").alias("shielded"),
    )


# Classification and quarantine


def txn_reasons(spark: SparkSession, sf: str) -> DataFrame:
    bronze = _lines(spark, sf, TRANSACTION_COLUMNS)
    return _reasons(_classified_lines(spark, sf, bronze=bronze))


def txn_reasons_events(spark: SparkSession, sf: str) -> DataFrame:
    return _reasons(_classified_events(spark, sf))


def txn_reasons_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    return _reasons(_classified_lines(spark, sf, replace(CFG, duplicates="keep_first")))


def reason_counts(spark: SparkSession, sf: str) -> DataFrame:
    reason = F.coalesce(REASON, F.lit("(none)")).alias("reason")
    bronze = _lines(spark, sf, TRANSACTION_COLUMNS)
    return _classified_lines(spark, sf, bronze=bronze).groupBy(reason, F.col(SHIELDED).cast("int").alias("shielded")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def account_reasons(spark: SparkSession, sf: str) -> DataFrame:
    classified = classify_accounts(b.customer_accounts(spark, sf), CFG)
    return classified.select(
        "account_id", _day("date"), "account_status",
        F.coalesce(REASON, F.lit("(none)")).alias("reason"),
        F.col(SHIELDED).cast("int").alias("shielded"),
    )


def _quarantine(
    spark: SparkSession, sf: str, cfg: Settings, bronze: DataFrame | None = None
) -> DataFrame:
    return build_quarantine(
        _classified_lines(spark, sf, bronze=bronze), classify_accounts(b.customer_accounts(spark, sf), cfg), NOW, cfg
    )


def quarantine_unified(spark: SparkSession, sf: str) -> DataFrame:
    """Both sides' ids with their first reason; no content is asked for, so none is carried."""
    lines = first_reasons(_classified_lines(spark, sf), "transaction_id", "TRANSACTION")
    owners = first_reasons(classify_accounts(b.customer_accounts(spark, sf), CFG), "account_id", "ACCOUNT")
    both = lines.unionByName(owners, allowMissingColumns=True)
    return both.select(
        F.coalesce("transaction_id", F.lit("(none)")).alias("transaction_id"),
        F.when(F.col("record_type") == "ACCOUNT", F.col("account_id")).otherwise("(any)").alias("account_id"),
        F.col(REASON).alias("reason"), "record_type",
    )


def quarantine_per_row(spark: SparkSession, sf: str) -> DataFrame:
    return _quarantine(spark, sf, CFG).groupBy("record_type", _day("date"), F.col(REASON).alias("reason")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col(SHIELDED)).alias("shielded_rows"),
    )


# Reference and account state


def latest_accounts(spark: SparkSession, sf: str) -> DataFrame:
    return _accounts(spark, sf).select(
        "account_id", "customer_name", "account_status", _money("credit_limit"),
        _money("current_balance"), F.coalesce("open_date", F.lit("(none)")).alias("open_date"),
        "billing_cycle_start", "billing_cycle_end", "_pipeline_run_id", "_source_file",
    )


def accounts_unique(spark: SparkSession, sf: str) -> DataFrame:
    state = checks.check_accounts_unique(_accounts(spark, sf)).withColumn("source", F.lit("silver"))
    raw = checks.check_accounts_unique(b.customer_accounts(spark, sf)).withColumn("source", F.lit("bronze"))
    return state.unionByName(raw).select(
        "source", _count("total_records"), _count("unique_accounts"), _flag("passed")
    )


def codes_unique(spark: SparkSession, sf: str) -> DataFrame:
    return silver_codes(b.delivered_codes(spark, sf)).drop("_ingested_at")


def codes_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return silver_codes(b.delivered_codes(spark, sf), "distinct").drop("_ingested_at")


# Promotion


def promoted(spark: SparkSession, sf: str) -> DataFrame:
    return _show_silver(_silver(spark, sf))


def promoted_as_of_date(spark: SparkSession, sf: str) -> DataFrame:
    return _show_silver(_silver(spark, sf, replace(CFG, resolvable="as_of_date")))


def promoted_against_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze rows whose id the quarantine table does not hold."""
    bronze = _lines(spark, sf)
    table = _quarantine(spark, sf, replace(CFG, quarantine="per_id"), bronze)
    kept = not_quarantined(bronze, table, CFG)
    return kept.select("transaction_id", "account_id", "transaction_date", _money("amount"), "channel")


def unresolved_by_account(spark: SparkSession, sf: str) -> DataFrame:
    return _silver(spark, sf).where(~F.col("_is_resolvable")).groupBy("account_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("_signed_amount").cast("double").alias("signed_amount"),
    )


def backfill_effect(spark: SparkSession, sf: str) -> DataFrame:
    """Rows promoted by their date, then resolved against everything delivered since."""
    before = stage(_silver(spark, sf, replace(CFG, resolvable="as_of_date")), "before")
    after = resolve_late_accounts(before, _accounts(spark, sf), CFG)
    tagged = before.withColumn("state", F.lit("before")).unionByName(after.withColumn("state", F.lit("after")))
    return tagged.groupBy("state", _day("transaction_date")).agg(
        F.count_if(F.col("_is_resolvable")).alias("resolvable_rows"),
        F.count_if(~F.col("_is_resolvable")).alias("waiting_rows"),
        F.coalesce(F.sum(F.when(F.col("_is_resolvable"), F.col("_signed_amount"))), F.lit(0)).cast("double").alias("signed_amount"),
    )


# Gold


def gold_daily(spark: SparkSession, sf: str) -> DataFrame:
    return _show_daily(_daily(spark, sf))


def gold_daily_json(spark: SparkSession, sf: str) -> DataFrame:
    return gold.type_json(_daily(spark, sf)).select(_day("transaction_date"), "transactions_by_type")


def gold_weekly_account(spark: SparkSession, sf: str) -> DataFrame:
    return _show_weekly(_weekly(spark, sf))


def closing_balance_asof(spark: SparkSession, sf: str) -> DataFrame:
    return _show_weekly(_weekly(spark, sf, replace(CFG, balance="as_of")))


# Proof


def mass_conservation(spark: SparkSession, sf: str) -> DataFrame:
    counts = reconcile.classified_conservation(_classified_lines(spark, sf))
    return counts.select(_day("date"), "bronze_rows", "silver_rows", "quarantine_rows", "difference")


def layer_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The models that judge, build or keep state; Bronze counts are those of the loads."""
    classified = stage(_classified_events(spark, sf), "classified")
    delivered = b.customer_accounts(spark, sf)
    silver = stage(
        promote_transactions(
            accepted(classified), b.codes(spark, b.EVENT_CODES), acc.first_seen(delivered), NOW, CFG
        ),
        "silver",
    )
    rejected = classified.where(F.col(REASON).isNotNull()).withColumn("record_type", F.lit("TRANSACTION"))
    counts = reconcile.layer_counts(b.event_transactions(spark, sf), silver, rejected)
    used = silver.where(F.col("_is_resolvable"))
    monday = F.trunc("transaction_date", "week").alias("date")
    for more in (
        reconcile.table_counts("gold_daily_summary", used, _daily(spark, sf, silver).select(F.col("transaction_date").alias("date"))),
        reconcile.table_counts(
            "gold_weekly_account_summary", used.select(monday),
            _weekly(spark, sf, silver=silver).select(F.col("week_start_date").alias("date")),
        ),
        reconcile.table_counts(
            "silver_accounts", delivered, _accounts(spark, sf).select(F.col("_bronze_ingested_at").cast("date").alias("date"))
        ),
        reconcile.table_counts(
            "silver_transaction_codes", b.delivered_codes(spark, sf),
            silver_codes(b.delivered_codes(spark, sf)).select(F.col("_ingested_at").cast("date").alias("date")),
        ),
    ):
        counts = counts.unionByName(more)
    blank = [F.coalesce(c, F.lit(-1)).alias(c) for c in ("records_written", "records_rejected")]
    return counts.select(_day("date"), "model_name", "records_processed", *blank)


def gold_tieout(spark: SparkSession, sf: str) -> DataFrame:
    silver = stage(_silver(spark, sf), "silver")
    ties = reconcile.daily_tie_out(_daily(spark, sf, silver), silver)
    return ties.select(
        _day("transaction_date"), "gold_total_transactions", "silver_total_transactions",
        _money("gold_total_signed_amount"), _money("silver_total_signed_amount"), _flag("agrees"),
    )


def tieout_faults(spark: SparkSession, sf: str) -> DataFrame:
    """The daily tie-out over a Gold table with known faults: every fifth day counts one row too
    many, every seventh is missing."""
    silver = stage(_silver(spark, sf), "silver")
    day = F.dayofmonth("transaction_date")
    wrong = _daily(spark, sf, silver).where(day % 7 != 0).withColumn(
        "total_transactions", F.col("total_transactions") + F.when(day % 5 == 0, 1).otherwise(0)
    )
    ties = reconcile.daily_tie_out(wrong, silver)
    return ties.select(
        _day("transaction_date"), F.coalesce("gold_total_transactions", F.lit(-1)).alias("gold_total_transactions"),
        "silver_total_transactions", _flag("agrees"),
    )


def weekly_tieout(spark: SparkSession, sf: str) -> DataFrame:
    silver = stage(_silver(spark, sf), "silver")
    ties = reconcile.weekly_tie_out(
        _weekly(spark, sf, silver=silver), silver, b.codes(spark, b.EVENT_CODES), CFG, _accounts(spark, sf)
    )
    values = ("avg_purchase_amount", "total_payments", "total_fees", "total_interest", "closing_balance")
    return ties.select(
        "account_id", _day("week_start_date"), "gold_total_purchases", "silver_total_purchases",
        *[
            F.coalesce(F.round(F.col(f"{side}_{v}").cast("double"), 6), F.lit(-1.0)).alias(f"{side}_{v}")
            for v in values for side in ("gold", "silver")
        ],
        _flag("agrees"),
    )


def expectations(spark: SparkSession, sf: str) -> DataFrame:
    silver = stage(_silver(spark, sf), "silver")
    return checks.check_tables(
        {
            "silver_transaction_codes": silver_codes(b.delivered_codes(spark, sf)),
            "silver_accounts": _accounts(spark, sf),
            "silver_transactions": silver,
            "silver_quarantine": _quarantine(spark, sf, CFG),
            "gold_daily_summary": _daily(spark, sf, silver),
            "gold_weekly_account_summary": _weekly(spark, sf, silver=silver),
        }
    )


def expectations_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """The same checks where they fail: raw rows."""
    wanted = [
        *checks.not_null("transaction_id", "channel"),
        *checks.accepted_values("channel", CFG.channels),
        *checks.unique("transaction_id"),
        *checks.unique("account_id", "transaction_date"),
    ]
    bronze = _lines(spark, sf, ["transaction_id", "account_id", "transaction_date", "channel"])
    return checks.check_table(bronze, "bronze_transactions", wanted)


def referential_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Raw rows against the references they will need."""
    raw = b.event_transactions(spark, sf).withColumn("_is_resolvable", F.lit(True))
    return reconcile.referential_gaps(raw, b.codes(spark, b.EVENT_CODES), _accounts(spark, sf))


def _event_log(spark: SparkSession, sf: str) -> DataFrame:
    return b.order_log(spark, sf).where("status = 'SUCCESS'").select(
        F.lit("run-a").alias("run_id"), F.lit("bronze_transactions").alias("model_name"), "status"
    )


def lineage_weekly(spark: SparkSession, sf: str) -> DataFrame:
    silver = stage(_silver(spark, sf), "silver")
    trace = lineage.lineage_weekly(_weekly(spark, sf, silver=silver), silver, b.event_transactions(spark, sf), _event_log(spark, sf))
    return trace.select(
        "account_id", _day("week_start_date"), "total_purchases", "_pipeline_run_id", "_source_file",
        "silver_rows", _money("silver_amount"), "bronze_rows", _flag("has_success_log"),
    )


def lineage_trace(spark: SparkSession, sf: str) -> DataFrame:
    silver = stage(_silver(spark, sf), "silver")
    traced = lineage.lineage_trace(
        _daily(spark, sf, silver), silver, b.event_transactions(spark, sf), _event_log(spark, sf)
    )
    return traced.select(
        _day("transaction_date"), "total_transactions", "_pipeline_run_id", "_source_file",
        "silver_rows", _money("silver_amount"), "bronze_rows", _flag("has_success_log"),
    )


def run_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Raw rows owned by runs without a SUCCESS entry, and by runs that were all SKIPPED."""
    log = b.order_log(spark, sf)
    rows = b.event_transactions(spark, sf).withColumn(
        "_pipeline_run_id", F.concat(F.lit("run-"), "account_id")
    )
    missing = lineage.unlogged_runs(rows, log).withColumn("finding", F.lit("unlogged"))
    leaks = lineage.skipped_run_leaks(rows, log).withColumn("finding", F.lit("skipped"))
    return missing.unionByName(leaks).select("finding", "run_id", "row_count")


def load_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by day against a partial earlier load: later years missing, some days short."""
    source = b.order_days(spark, sf)
    loaded = source.where(
        (F.col("date") < "2001-01-01")
        & ~((F.col("o_orderstatus") == "P") & (F.dayofmonth("date") == 7))
    )
    plan = reconcile.reconcile_loads(reconcile.day_counts(source), reconcile.day_counts(loaded))
    return _show_plan(plan)


def load_reconcile_checksum(spark: SparkSession, sf: str) -> DataFrame:
    """The same load with a changed value of the same row count on some days."""
    columns = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    source = b.order_days(spark, sf)
    changed = (F.dayofmonth("date") == 9) & (F.col("o_orderpriority") == "5-LOW")
    loaded = source.withColumn(
        "o_orderpriority", F.when(changed, "4-LOW").otherwise(F.col("o_orderpriority"))
    )
    plan = reconcile.reconcile_loads(
        reconcile.day_counts(source, columns), reconcile.day_counts(loaded, columns)
    )
    return _show_plan(plan)


def _show_plan(plan: DataFrame) -> DataFrame:
    return plan.select(
        _day("date"),
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("source_rows", "loaded_rows")],
        "action",
    )


def date_spine_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Days between the first and the last order without a delivery: the SKIPPED days."""
    days = b.order_days(spark, sf).select("date").distinct()
    spine = days.agg(F.min("date").alias("a"), F.max("date").alias("z")).select(
        F.explode(F.sequence("a", "z", F.expr("interval 1 day"))).alias("date")
    )
    return spine.join(days, "date", "left_anti").select(_day("date"))


def incremental_equals_range(spark: SparkSession, sf: str) -> DataFrame:
    """Gold from cubes per day against Gold in one go: rows compared and rows that differ."""
    silver = stage(_silver(spark, sf), "silver")
    codes, state = b.codes(spark, b.EVENT_CODES), _accounts(spark, sf)
    pairs = {
        "gold_daily_summary": (
            _daily(spark, sf, silver),
            gold.daily_from_cube(stage(gold.daily_cube(silver, "date"), "cube"), codes, NOW, CFG),
        ),
        "gold_weekly_account_summary": (
            _weekly(spark, sf, silver=silver),
            gold.weekly_from_cube(stage(gold.weekly_cube(silver, "date"), "cube"), codes, state, NOW, CFG),
        ),
    }
    lines = []
    for name, (whole, by_day) in pairs.items():
        rows = whole.agg(F.count(F.lit(1)).alias("compared")).withColumn("differing", F.lit(0).cast("bigint"))
        diff = reconcile.equivalence(whole, by_day).agg(F.count(F.lit(1)).alias("differing")).withColumn(
            "compared", F.lit(0).cast("bigint")
        )
        lines.append(
            rows.unionByName(diff).agg(F.sum("compared").alias("compared"), F.sum("differing").alias("differing"))
            .select(F.lit(name).alias("table_name"), "compared", "differing")
        )
    return lines[0].unionByName(lines[1])


def equivalence_excess(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads of the order days that do differ: which rows, and how many more."""
    now = b.order_days(spark, sf).select(_day("date"), "o_orderstatus", "o_orderpriority")
    then = now.withColumn(
        "o_orderstatus", F.when(F.col("o_orderstatus") == "P", "F").otherwise(F.col("o_orderstatus"))
    )
    return reconcile.equivalence(now, then)


def equivalence_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """The same two loads, of which one changes the pending orders of the seventh of each month: the rows that differ, found
    by digests, and how many days had to be looked at."""
    now = b.order_days(spark, sf).select(_day("date"), "o_orderkey", "o_orderstatus", "o_orderpriority")
    late = (F.col("o_orderstatus") == "P") & F.col("date").endswith("-07")
    then = now.withColumn("o_orderstatus", F.when(late, "F").otherwise(F.col("o_orderstatus")))
    differing, rows = reconcile.equivalence_by_digest(now, then)
    looked_at = differing.select(F.col("date").alias("day")).distinct().groupBy().agg(F.count(F.lit(1)).alias("days"))
    return rows.select("date", "o_orderkey", "o_orderstatus", "excess").join(F.broadcast(looked_at))


# Run log


def log_gate(spark: SparkSession, sf: str) -> DataFrame:
    return runlog.log_gate(b.order_log(spark, sf), CFG).select(
        "run_id", "total", "success_count", "excused_count", _flag("complete")
    )


def log_sanitize(spark: SparkSession, sf: str) -> DataFrame:
    return runlog.run_log_rows(b.order_log(spark, sf)).select(
        "run_id", "model_name", "layer", "status", "records_written",
        F.coalesce("records_rejected", F.lit(-1)).alias("records_rejected"),
        F.coalesce("error_message", F.lit("(none)")).alias("error_message"),
        _day("processed_date"),
    )


def messages_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Forbidden words left per run, in the raw and in the constrained log."""
    raw = b.order_log(spark, sf)
    tagged = runlog.unclean_messages(raw, CFG).withColumn("state", F.lit("raw")).unionByName(
        runlog.unclean_messages(runlog.run_log_rows(raw), CFG).withColumn("state", F.lit("constrained"))
    )
    return tagged.groupBy("state", "run_id").agg(F.count(F.lit(1)).alias("unclean"))


# Whole runs over deliveries that Spark writes from the given tables


def _delivered(spark: SparkSession, sf: str, balance: str = "latest", with_codes: bool = True) -> Settings:
    folder = scratch_path(spark, "run")
    cfg = Settings(source_dir=f"{folder}/source", lake_dir=f"{folder}/lake", balance=balance)
    b.export_daily_csv(b.event_transactions(spark, sf), "transactions", cfg.source_dir)
    b.export_daily_csv(b.customer_accounts(spark, sf), "accounts", cfg.source_dir)
    if with_codes:
        b.export_codes_csv(b.delivered_codes(spark, sf), cfg.source_dir)
    return cfg


def _finished(result) -> None:
    if not result.advanced:
        raise RuntimeError("; ".join(result.reasons))


def _first_and_last(spark: SparkSession, cfg: Settings, *entities: str) -> tuple[date, date]:
    days = [d for e in entities for d in daily_csv.delivered_days(spark, e, cfg)]
    return min(days), max(days)


def csv_ingest(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "ingest")
    cfg = replace(CFG, source_dir=folder)
    b.export_daily_csv(b.event_transactions(spark, sf), "transactions", folder)
    rows = daily_csv.ingest_daily_csv(
        spark, "transactions", *_first_and_last(spark, cfg, "transactions"), cfg, "run-a", NOW
    )
    return rows.select(
        "transaction_id", "account_id", "transaction_date", "amount", "transaction_code",
        F.coalesce("merchant_name", F.lit("(none)")).alias("merchant_name"), "channel",
        "_pipeline_run_id", "_source_file", _day("date"),
    )


def csv_ragged(spark: SparkSession, sf: str) -> DataFrame:
    """Deliveries of which those of every seventh day have rows with a field too many: those
    days fail and write nothing, wherever the rows stand; the others load."""
    folder = scratch_path(spark, "ragged")
    cfg = replace(CFG, source_dir=f"{folder}/source", lake_dir=f"{folder}/lake")
    events = b.event_transactions(spark, sf)
    odd = F.dayofmonth("date") % 7 == 3
    b.export_daily_csv(events.where(~odd), "transactions", cfg.source_dir)
    loose = F.when(F.col("transaction_id").cast("long") % 100 == 0, "Shop, Inc")
    b.export_daily_csv(events.where(odd).withColumn("merchant_name", loose), "transactions", cfg.source_dir, quote="")
    span = _first_and_last(spark, cfg, "transactions")
    done = load_idempotent(spark, "transactions", *span, cfg, "run-a", NOW).where("status != 'SKIPPED'")
    held = Lake(spark, cfg).bronze("transactions").groupBy("date").agg(F.count(F.lit(1)).alias("held"))
    return done.join(held, "date", "left").select(
        _day("date"), "status", "records_processed",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("records_written", "held")],
    )


def csv_load_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Deliveries against rows already held, the way a repeated load compares them."""
    folder = scratch_path(spark, "plan")
    cfg = replace(CFG, source_dir=folder, verify="checksum")
    held = b.event_transactions(spark, sf).withColumn("amount", F.col("amount").cast("string"))
    b.export_daily_csv(held, "transactions", folder)
    again = daily_csv.ingest_daily_csv(
        spark, "transactions", *_first_and_last(spark, cfg, "transactions"), cfg, "run-b", NOW
    )
    return _show_plan(load_plan(again, held, "transactions", cfg))


def range_run(spark: SparkSession, sf: str) -> DataFrame:
    """All days of all deliveries; days with accounts only have no transactions to wait for."""
    cfg = replace(_delivered(spark, sf), skippable=("bronze_accounts", "bronze_transactions"))
    span = _first_and_last(spark, cfg, "transactions", "accounts")
    _finished(run_range(spark, *span, cfg, run_id="run-a", now=NOW))
    return _show_daily(Lake(spark, cfg).read("gold/daily_summary"))


def incremental_run(spark: SparkSession, sf: str) -> DataFrame:
    """All days but the last by a range, the last one on its own, then the accounts that came
    after it."""
    cfg = replace(_delivered(spark, sf, balance="as_of"), skippable=("bronze_accounts", "bronze_transactions"))
    first, last = _first_and_last(spark, cfg, "transactions")
    _finished(run_range(spark, first, last - timedelta(days=1), cfg, run_id="run-a", now=NOW))
    _finished(run_next(spark, cfg, run_id="run-b", now=NOW))
    end = _first_and_last(spark, cfg, "transactions", "accounts")[1]
    if end > last:
        _finished(run_range(spark, last + timedelta(days=1), end, cfg, run_id="run-c", now=NOW))
    return _show_weekly(Lake(spark, cfg).read("gold/weekly_account_summary")).drop("_pipeline_run_id")


def days_opened(spark: SparkSession, sf: str) -> DataFrame:
    """The last day repeats ids of two other days: the days that its load opens, by the index of
    ids, and how many of its ids they hold."""
    cfg = _delivered(spark, sf)
    first, last = _first_and_last(spark, cfg, "transactions")
    events = b.event_transactions(spark, sf)
    key = F.col("transaction_id").cast("long")
    repeated = events.where(((F.col("date") == first) & (key % 3 == 0)) | ((F.dayofmonth("date") == 9) & (key % 5 == 0)))
    end = events.where(F.col("date") == last).unionByName(repeated.withColumn("date", F.lit(last)))
    remove_folder(spark, f"{cfg.source_dir}/transactions_{last.isoformat()}.csv")
    b.export_daily_csv(end, "transactions", cfg.source_dir)
    load_idempotent(spark, "transactions", first, last, cfg, "run-a", NOW).count()
    lake = Lake(spark, cfg)
    index_ids(lake, "run-a")
    ids = lake.bronze("transactions", [last])
    opened = days_that_may_hold(lake, ids, [d for d in lake.days("bronze/transactions") if d != last])
    held = lake.bronze("transactions", opened).join(ids.select("transaction_id").distinct(), "transaction_id", "left_semi")
    return held.groupBy("date").agg(F.count(F.lit(1)).alias("shared_ids")).select(_day("date"), "shared_ids")


def weekly_view_run(spark: SparkSession, sf: str) -> DataFrame:
    """All days but the last by a range, then the last one, which brings no accounts: which run
    wrote each week of the weekly summary."""
    cfg = replace(_delivered(spark, sf, balance="as_of"), skippable=("bronze_accounts", "bronze_transactions"))
    first, last = _first_and_last(spark, cfg, "transactions")
    remove_folder(spark, f"{cfg.source_dir}/accounts_{last.isoformat()}.csv")
    _finished(run_range(spark, first, last - timedelta(days=1), cfg, run_id="run-a", now=NOW))
    _finished(run_next(spark, cfg, run_id="run-b", now=NOW))
    weeks = Lake(spark, cfg).read("gold/weekly_account_summary")
    return weeks.groupBy("week_start_date", "_written_run_id").agg(
        F.count(F.lit(1)).alias("accounts"), F.sum("total_purchases").cast("bigint").alias("purchases")
    ).select(_day("week_start_date"), F.col("_written_run_id").alias("written_by"), "accounts", "purchases")


def versioned_reader(spark: SparkSession, sf: str) -> DataFrame:
    """The order days as a versioned table, of which some days are replaced and some emptied: what
    a reader sees that began before, and one that begins after."""
    orders = b.order_days(spark, sf).where("date >= '1998-01-01'")
    table = VersionedTable(spark, f"{scratch_path(spark, 'versions')}/orders")
    days = [r["date"] for r in orders.select("date").distinct().collect()]
    table.replace_days(orders, days, "run-a")
    old = table.frame()
    table.replace_days(orders.where("o_orderstatus = 'F'"), [d for d in days if d.day % 7 == 3], "run-b")
    sides = old.withColumn("seen", F.lit("before")).unionByName(table.frame().withColumn("seen", F.lit("after")))
    return sides.groupBy("date").agg(
        F.count_if(F.col("seen") == "before").alias("before_rows"), F.count_if(F.col("seen") == "after").alias("after_rows")
    ).select(_day("date"), "before_rows", "after_rows")


def source_audit(spark: SparkSession, sf: str) -> DataFrame:
    """All source files before and after a load, which leaves them alone, and after changes that
    were planted: rows of one day lost, another day gone, a new one come. One row per day and step."""
    cfg = _delivered(spark, sf)
    span = _first_and_last(spark, cfg, "transactions")
    before = stage(source_digests(spark, cfg), "digests")
    load_idempotent(spark, "transactions", *span, cfg, "run-a", NOW).count()
    loaded = stage(changed_sources(before, source_digests(spark, cfg)), "audit")
    events = b.event_transactions(spark, sf)
    for day in (span[0], span[1]):
        remove_folder(spark, f"{cfg.source_dir}/transactions_{day.isoformat()}.csv")
    b.export_daily_csv(events.where((F.col("date") == span[0]) & (F.col("transaction_id").cast("long") % 2 == 0)), "transactions", cfg.source_dir)
    new = events.where(F.col("date") == span[0]).withColumn("date", F.lit(span[1] + timedelta(days=90)))
    b.export_daily_csv(new, "transactions", cfg.source_dir)
    planted = changed_sources(before, source_digests(spark, cfg))
    steps = loaded.withColumn("step", F.lit("load")).unionByName(planted.withColumn("step", F.lit("planted")))
    day = F.regexp_extract("file", r"/transactions_(\d{4}-\d{2}-\d{2})\.csv", 1).alias("date")
    # A day's part files have new names when it is written anew.
    seen = F.collect_set("finding")
    finding = F.when(F.size(seen) == 1, seen[0]).otherwise("CHANGED")
    return steps.select("step", day, "finding").where("date != ''").groupBy("step", "date").agg(finding.alias("finding"))


def stream_gap_run(spark: SparkSession, sf: str) -> DataFrame:
    """A stream over deliveries of which one day has a header and no rows: Silver rows by day, and
    where the watermark is, as a range run leaves it."""
    cfg = _delivered(spark, sf)
    first, last = _first_and_last(spark, cfg, "transactions")
    bare = first + timedelta(days=3)
    remove_folder(spark, f"{cfg.source_dir}/transactions_{bare.isoformat()}.csv")
    header = spark.createDataFrame([], ", ".join(f"{c} string" for c in TRANSACTION_COLUMNS))
    header.coalesce(1).write.options(**daily_csv.DIALECT).csv(f"{cfg.source_dir}/transactions_{bare.isoformat()}.csv")
    for result in stream_next(spark, cfg, f"{cfg.lake_dir}/pipeline/stream"):
        _finished(result)
    lake = Lake(spark, cfg)
    rows = lake.read("silver/transactions").groupBy("date").agg(F.count(F.lit(1)).alias("silver_rows"))
    return rows.select(_day("date"), "silver_rows", F.lit(lake.get_watermark().isoformat()).alias("watermark"))


def unresolved_index(spark: SparkSession, sf: str) -> DataFrame:
    """After a load: by day the accounts that do not resolve, as the index has them for a backfill."""
    cfg = _delivered(spark, sf)
    _finished(run_range(spark, *_first_and_last(spark, cfg, "transactions"), cfg, run_id="run-a", now=NOW))
    return Lake(spark, cfg).read(UNRESOLVED).select(_day("date"), "account_id", "waiting_rows")


def _silver_of(spark: SparkSession, cfg: Settings) -> DataFrame:
    return _show_silver(Lake(spark, cfg).read("silver/transactions")).drop("_pipeline_run_id")


def stream_run(spark: SparkSession, sf: str) -> DataFrame:
    cfg = _delivered(spark, sf)
    for result in stream_next(spark, cfg, f"{cfg.lake_dir}/pipeline/stream"):
        _finished(result)
    return _silver_of(spark, cfg)


def stream_retry_run(spark: SparkSession, sf: str) -> DataFrame:
    """The codes arrive after the first call of the stream, which fails and is made up for."""
    cfg = _delivered(spark, sf, with_codes=False)
    try:
        stream_next(spark, cfg, f"{cfg.lake_dir}/pipeline/stream")
    except StreamingQueryException:
        b.export_codes_csv(b.delivered_codes(spark, sf), cfg.source_dir)
    for result in stream_next(spark, cfg, f"{cfg.lake_dir}/pipeline/stream"):
        _finished(result)
    return _silver_of(spark, cfg)


def reload_run(spark: SparkSession, sf: str) -> DataFrame:
    """The last day repeats ids of the first one; delivered again without them, under the same
    run id, it releases them."""
    cfg = _delivered(spark, sf)
    first, last = _first_and_last(spark, cfg, "transactions")
    events = b.event_transactions(spark, sf)
    end = events.where(F.col("date") == last)
    again = events.where((F.col("date") == first) & (F.col("transaction_id").cast("long") % 3 == 0))
    name = f"{cfg.source_dir}/transactions_{last.isoformat()}.csv"
    remove_folder(spark, name)
    b.export_daily_csv(end.unionByName(again.withColumn("date", F.lit(last))), "transactions", cfg.source_dir)
    _finished(run_range(spark, first, last, cfg, run_id="run-a", now=NOW))
    remove_folder(spark, name)
    b.export_daily_csv(end, "transactions", cfg.source_dir)
    _finished(run_range(spark, last, last, cfg, run_id="run-a", now=NOW))
    return _silver_of(spark, cfg)


def backfill_run(spark: SparkSession, sf: str) -> DataFrame:
    """A load, a backfill of the accounts that came later, and the load of all days again."""
    cfg = _delivered(spark, sf)
    span = _first_and_last(spark, cfg, "transactions")
    _finished(run_range(spark, *span, cfg, run_id="run-a", now=NOW))
    run_backfill(spark, cfg, run_id="run-b", now=NOW)
    _finished(run_range(spark, *span, cfg, run_id="run-c", now=NOW))
    return _silver_of(spark, cfg)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        txn_reasons, txn_reasons_events, txn_reasons_keep_first, reason_counts, account_reasons,
        quarantine_unified, quarantine_per_row, latest_accounts, accounts_unique, codes_unique,
        codes_distinct, promoted, promoted_as_of_date, promoted_against_quarantine,
        unresolved_by_account, backfill_effect, gold_daily, gold_daily_json, gold_weekly_account,
        closing_balance_asof, mass_conservation, layer_counts, gold_tieout, weekly_tieout,
        expectations, expectations_bronze, referential_gaps, lineage_trace, lineage_weekly, tieout_faults, run_audit,
        load_reconcile, load_reconcile_checksum, date_spine_gaps, incremental_equals_range,
        equivalence_excess, log_gate, log_sanitize, messages_clean, csv_ingest, csv_load_plan,
        csv_ragged, range_run, incremental_run, stream_run, stream_retry_run, reload_run, backfill_run,
        days_opened, weekly_view_run, versioned_reader, source_audit, stream_gap_run,
        equivalence_buckets, unresolved_index,
    )
}
