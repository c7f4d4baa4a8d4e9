"""Runs over the whole lake: a range of days, the next day, a late-account backfill.

All three share one set-based core. A range is not a loop over days: each stage is one
Spark job over all its days. The driver holds the run id, the days and counts per day.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.functions import blank
from tallystone.operators.accounts import first_seen, latest_accounts
from tallystone.operators.checks import check_accounts_unique
from tallystone.operators.classify import (
    classify_accounts,
    classify_transactions,
    id_counts,
    id_flags,
)
from tallystone.operators.codes import require_codes, silver_codes
from tallystone.operators.gold import daily_cube, daily_from_cube, weekly_cube
from tallystone.operators.latest import latest_by
from tallystone.operators.promote import (
    accepted,
    promote_transactions,
    resolve_late_accounts,
)
from tallystone.operators.quarantine import padded, quarantine_accounts, quarantine_transactions
from tallystone.operators.runlog import check_log_complete, check_messages_clean
from tallystone.operators.skew import COPIES, broadcast_limit
from tallystone.plans.weekly_view import KNOWN, refresh_weekly
from tallystone.schemas import LOAD_RESULT
from tallystone.session import sized_shuffles
from tallystone.settings import Settings
from tallystone.sources import daily_csv
from tallystone.sources.files import size_of, stage, stage_sized, staged_for_now
from tallystone.sources.lake import RESOLVED, WRITER, ConcurrentRun, Lake, load_days
from tallystone.sources.versions import WHOLE

# The models of a run, in log order.
NO_OP_MODELS = (
    ("bronze_transaction_codes", "BRONZE"),
    ("bronze_accounts", "BRONZE"),
    ("bronze_transactions", "BRONZE"),
    ("silver_transaction_codes", "SILVER"),
    ("silver_accounts", "SILVER"),
    ("silver_transactions", "SILVER"),
    ("silver_quarantine", "SILVER"),
    ("gold_aggregation", "GOLD"),
)

# Which days, from which writes, the account state holds: one row per day.
MERGED_DAYS = "pipeline/account_days"
MERGED_SCHEMA = "date date, made_of string"
# By day, the fingerprints of its transaction ids in ascending order.
ID_INDEX = "pipeline/transaction_ids"
FINGERPRINT = "fingerprint"
# By day, the accounts of Silver rows that do not resolve.
UNRESOLVED = "pipeline/unresolved_accounts"
UNRESOLVED_SCHEMA = "account_id string, waiting_rows long, date date"


@dataclass
class RunResult:
    run_id: str
    advanced: bool = False
    watermark: date | None = None
    days: list[date] = field(default_factory=list)
    rewritten: list[date] = field(default_factory=list)
    reasons: list[str] = field(default_factory=list)


def _message(error: Exception) -> str:
    """All an error says; its type, if it says nothing."""
    return str(error).strip() or type(error).__name__


class _Run:
    """One invocation: its id, its clock and the log entries it still has to append."""

    def __init__(self, spark: SparkSession, cfg: Settings, kind: str, run_id: str | None, now: datetime | None):
        self.spark, self.cfg, self.kind = spark, cfg, kind
        self.run_id = run_id or str(uuid.uuid4())
        self.now = now or datetime.now(timezone.utc)
        self.lake = Lake(spark, cfg)
        self.began_after = self.lake.commit_number()
        self.pending: list[dict] = []

    def log(self, model: str, layer: str, status: str, **values: Any) -> None:
        stamp = datetime.now(timezone.utc)
        self.pending.append(
            {
                "run_id": self.run_id, "pipeline_type": self.kind, "model_name": model,
                "layer": layer, "status": status, "started_at": stamp, "completed_at": stamp,
                **values,
            }
        )

    def step(self, model: str, layer: str, day: date | None, work: Callable[[], Iterable[dict]]) -> None:
        """Run one model and log what it reports; log a failure and raise it."""
        began = datetime.now(timezone.utc)
        try:
            for values in work():
                self.log(model, layer, "SUCCESS", **{"started_at": began, "processed_date": day, **values})
        except Exception as error:
            self.log(
                model, layer, "FAILED", started_at=began, processed_date=day,
                error_message=_message(error),
            )
            self.flush()
            raise

    def flush(self) -> None:
        if self.pending:
            self.lake.append_run_log(self.pending)
            self.pending = []


def run_range(
    spark: SparkSession,
    start: date,
    end: date,
    cfg: Settings,
    *,
    force: bool = False,
    run_id: str | None = None,
    now: datetime | None = None,
) -> RunResult:
    """Load a range of days through all layers, then move the watermark to its end.

    Refuses a range that would leave unprocessed days behind the watermark, unless forced.
    """
    if start > end:
        raise ValueError("start must not be after end")
    run = _Run(spark, cfg, "HISTORICAL", run_id, now)
    watermark = run.lake.get_watermark()
    if watermark and start > watermark + timedelta(days=1) and not force:
        raise ValueError(f"days after {watermark} and before {start} are not processed yet")
    return _process(run, start, end)


def run_next(
    spark: SparkSession, cfg: Settings, *, run_id: str | None = None, now: datetime | None = None
) -> RunResult:
    """Load the day after the watermark. Without its file: log SKIPPED, change nothing."""
    run = _Run(spark, cfg, "INCREMENTAL", run_id, now)
    day = run.lake.get_next_date()
    if day is None:
        raise RuntimeError("no watermark: load a range first")
    if not daily_csv.find_deliveries(spark, "transactions", day, day, cfg):
        for model, layer in NO_OP_MODELS:
            run.log(model, layer, "SKIPPED")
        run.flush()
        return RunResult(run.run_id, watermark=run.lake.get_watermark(), reasons=["no source file"])
    return _process(run, day, day)


def unbroken(days: Iterable[date]) -> list[tuple[date, date]]:
    """The days as ranges without a gap."""
    spans: list[tuple[date, date]] = []
    for d in sorted(set(days)):
        if spans and d == spans[-1][1] + timedelta(days=1):
            spans[-1] = (spans[-1][0], d)
        else:
            spans.append((d, d))
    return spans


def run_days(
    spark: SparkSession, start: date, end: date, cfg: Settings, *, run_id: str | None = None, now: datetime | None = None
) -> RunResult:
    """Load a range wherever it lies. Days that are missing before it hold the watermark back
    until they have come; it then moves over all days loaded since."""
    return _process(_Run(spark, cfg, "INCREMENTAL", run_id, now), start, end, over_gaps=False)


def _process(run: _Run, start: date, end: date, over_gaps: bool = True) -> RunResult:
    result = RunResult(run.run_id, watermark=run.lake.get_watermark())
    loads = {
        entity: _load_bronze(run, entity, start, end)
        for entity in ("transaction_codes", "accounts", "transactions")
    }
    codes_ok = all(r["status"] != "FAILED" for r in loads["transaction_codes"].values())
    all_days = sorted(loads["transactions"])
    result.days = [
        d for d in all_days
        if codes_ok
        and loads["transactions"][d]["status"] == "SUCCESS"
        and loads["accounts"][d]["status"] != "FAILED"
    ]
    excused = "bronze_transactions" in run.cfg.skippable
    if any(
        d not in result.days and not (excused and loads["transactions"][d]["status"] == "SKIPPED")
        for d in all_days
    ):
        result.reasons.append("some days were not loaded")
    accounts_came = any(r["status"] == "SUCCESS" for r in loads["accounts"].values())
    no_rows_came = all(r["status"] == "SKIPPED" for r in loads["transactions"].values())
    if result.days or (no_rows_came and accounts_came and codes_ok):
        try:
            size = size_of(run.spark, run.lake.path("bronze"))
            with staged_for_now(run.spark), sized_shuffles(run.spark, size):
                _silver_and_gold(run, result, end, loads)
        except Exception as error:
            result.reasons.append(f"{type(error).__name__} in Silver or Gold: {_message(error)}")
    run.flush()
    _gates(run, result, end if over_gaps else _reached(run.lake))
    return result


def _reached(lake: Lake) -> date | None:
    """The last day of the unbroken run of loaded days that starts at the watermark; none as
    long as only accounts have come."""
    watermark = lake.get_watermark()
    for first, last in unbroken(lake.known_days("bronze/transactions")):
        if watermark is None or first <= watermark + timedelta(days=1) <= last + timedelta(days=1):
            return last
    return watermark


def _load_bronze(run: _Run, entity: str, start: date, end: date) -> dict[date, dict]:
    began = datetime.now(timezone.utc)
    last = start if entity == "transaction_codes" else end
    span = [start + timedelta(days=i) for i in range((last - start).days + 1)]
    rows: dict[date, dict] = {day: {"status": "SKIPPED"} for day in span}
    try:
        for result in load_days(run.spark, entity, start, end, run.cfg, run.run_id, run.now):
            rows[result[0]] = dict(zip(LOAD_RESULT.fieldNames(), result))
    except Exception as error:
        failed = {"status": "FAILED", "error_message": _message(error)}
        rows = dict.fromkeys(span, failed)
    for day, r in rows.items():
        run.log(
            f"bronze_{entity}", "BRONZE", r["status"], started_at=began,
            records_processed=r.get("records_processed"),
            records_written=r.get("records_written"),
            error_message=r.get("error_message"),
            processed_date=None if r["status"] == "SKIPPED" else day,
        )
    return rows


def _silver_and_gold(run: _Run, result: RunResult, end: date, loads: dict[str, dict[date, dict]]) -> None:
    lake, cfg, now = run.lake, run.cfg, run.now

    def promote_codes() -> list[dict]:
        codes = silver_codes(lake.bronze("transaction_codes"))
        require_codes(codes)
        written = lake.replace_table(codes, "silver/transaction_codes", run.run_id)
        return [{"records_processed": written, "records_written": written}]

    def promote_accounts() -> list[dict]:
        written = merge_accounts(lake, run.run_id, now)
        delivered = sum(r.get("records_written") or 0 for r in loads["accounts"].values())
        return [{"records_processed": delivered, "records_written": written}]

    run.step("silver_transaction_codes", "SILVER", end, promote_codes)
    run.step("silver_accounts", "SILVER", end, promote_accounts)
    if not result.days:  # only accounts came: no row to judge, but balances may have changed
        refresh_gold(run, [], end)
        return

    codes = lake.read("silver/transaction_codes").drop(WRITER)
    index_ids(lake, run.run_id)
    scope, flags, narrow = rewrite_scope(lake, result.days, cfg)
    result.rewritten = sorted(scope)
    bronze = lake.bronze("transactions", scope)
    classified = classify_transactions(bronze, codes, cfg, flags)
    if not narrow:
        # The rows had to be shuffled by id: do that once, and bring days back together.
        classified = stage(classified.hint("rebalance", "date"), "classified")

    def per_day(written: dict[date, int], quarantine: bool) -> list[dict]:
        lines = []
        for day in result.days:
            rows = loads["transactions"][day]["records_written"] or 0
            rejected = written[day] if quarantine else rows - written[day]
            lines.append(
                {
                    "processed_date": day, "records_processed": rows,
                    "records_written": written[day], "records_rejected": rejected,
                }
            )
        return lines

    def promote() -> list[dict]:
        accounts = (
            known_since(lake)
            if cfg.resolvable == "as_of_date"
            else lake.read("silver/accounts").select("account_id")
        )
        silver = promote_transactions(
            accepted(classified), codes, accounts, now, cfg, keys_from=bronze.select("account_id", "date")
        )
        return per_day(lake.replace_days(silver, "silver/transactions", scope, run.run_id), False)

    def quarantine() -> list[dict]:
        rejected = padded(quarantine_transactions(classified, now, cfg))
        written = lake.replace_days(rejected, "silver/quarantine/record_type=TRANSACTION", scope, run.run_id)
        # Account rows are judged one by one, or by id: then all days take part.
        table = "silver/quarantine/record_type=ACCOUNT"
        stale = lake.outdated(table, "bronze/accounts")
        if stale and cfg.quarantine == "per_id":
            stale = lake.day_writes("bronze/accounts")
        if stale:
            delivered = lake.bronze("accounts", stale)
            bad = padded(quarantine_accounts(classify_accounts(delivered, cfg), now, cfg))
            lake.replace_days(bad, table, stale, run.run_id, of=stale)
        return per_day(written, True)

    run.step("silver_transactions", "SILVER", None, promote)
    run.step("silver_quarantine", "SILVER", None, quarantine)
    index_unresolved(lake, run.run_id)
    refresh_gold(run, scope, end)


def merge_accounts(lake: Lake, run_id: str, now: datetime) -> int:
    """Bring the latest account state, and the day each account was first seen, up to date;
    returns the rows of the state.

    The state remembers of which writes of which days it is made. New days are merged into it, so
    a daily run reads the day's deltas and the state; when a day it holds comes from another write
    now, the state is built anew from all deltas. A merge that is cut off is simply repeated.
    """
    files = {d: w for d, w in lake.day_writes("bronze/accounts").items() if w}
    held = {r["date"]: r["made_of"] for r in lake.read(MERGED_DAYS, MERGED_SCHEMA).collect()} if lake.has("silver/accounts") else {}
    if held and all(files.get(d) == names for d, names in held.items()):
        new = sorted(set(files) - set(held))
        if not new:
            return lake.table("silver/accounts").parts()[WHOLE]["rows"]
        delta = lake.bronze("accounts", new)
        state = lake.read("silver/accounts").drop(WRITER).unionByName(latest_accounts(delta, now))
        newest = latest_by(state, ["account_id"], ["_bronze_ingested_at", "_source_file"])
        seen = lake.read(KNOWN).drop(WRITER).unionByName(first_seen(delta))
        seen = seen.groupBy("account_id").agg(F.min("_first_seen").alias("_first_seen"))
    else:
        newest, seen = latest_accounts(lake.bronze("accounts"), now), first_seen(lake.bronze("accounts"))
    rows = lake.replace_table(newest, "silver/accounts", run_id)
    lake.replace_table(seen, KNOWN, run_id)
    lake.replace_table(lake.spark.createDataFrame(sorted(files.items()), MERGED_SCHEMA).coalesce(1), MERGED_DAYS, run_id)
    return rows


def known_since(lake: Lake) -> DataFrame:
    """The day since which each account resolves rows: its first delivery, or any day once a
    backfill has resolved its earlier rows."""
    delivered = lake.read(KNOWN, "account_id string, _first_seen date").select("account_id", "_first_seen")
    if not lake.has(RESOLVED):
        return delivered
    always = lake.read(RESOLVED).select("account_id", F.lit("0001-01-01").cast("date").alias("_first_seen"))
    return delivered.unionByName(always).groupBy("account_id").agg(F.min("_first_seen").alias("_first_seen"))


def fingerprints(rows: DataFrame) -> DataFrame:
    """The fingerprints of the ids of rows, each once (and once a day where rows have days)."""
    days = [c for c in ("date",) if c in rows.columns]
    return rows.where(~blank("transaction_id")).select(F.xxhash64("transaction_id").alias(FINGERPRINT), *days).distinct()


def index_ids(lake: Lake, run_id: str) -> None:
    """Bring the index of ids up to date: days whose Bronze rows come from another write now.

    A day's fingerprints lie in ascending order, eight bytes for an id of any length, so that a
    search reads little and skips what its filter excludes.
    """
    stale = lake.outdated(ID_INDEX, "bronze/transactions")
    if stale:
        ids = fingerprints(lake.bronze("transactions", stale).select("transaction_id", "date"))
        ids = ids.hint("rebalance", "date").sortWithinPartitions("date", FINGERPRINT)
        lake.replace_days(ids, ID_INDEX, stale, run_id, of=stale)


def index_unresolved(lake: Lake, run_id: str) -> None:
    """Bring the index of accounts that do not resolve up to date: Silver days that come from
    another write now, each with its accounts and their rows."""
    stale = lake.outdated(UNRESOLVED, "silver/transactions")
    if stale:
        waiting = lake.read("silver/transactions", days=stale).where(~F.col("_is_resolvable"))
        counts = waiting.groupBy("account_id", "date").agg(F.count(F.lit(1)).alias("waiting_rows"))
        lake.replace_days(counts, UNRESOLVED, stale, run_id, of=stale)


def days_that_may_hold(lake: Lake, ids: DataFrame, days: Iterable[date]) -> list[date]:
    """Which of the days the index gives for any of the ids (rows with a transaction_id). Equal
    fingerprints of different ids are the only way a day is named in vain."""
    asked = fingerprints(ids.select("transaction_id"))
    index = lake.read(ID_INDEX, f"{FINGERPRINT} long, date date", days)
    return sorted(r["date"] for r in index.join(asked, FINGERPRINT, "left_semi").select("date").distinct().collect())


def rewrite_scope(lake: Lake, days: list[date], cfg: Settings) -> tuple[list[date], DataFrame, bool]:
    """The Silver days to write, the id flags that hold for them, and whether the flags are
    small enough to be broadcast.

    An id that also occurs on a day outside the run changes that day too, and so does an id
    that the run's days held before and no longer hold: a copy elsewhere may be the only one
    now. Which other days hold such ids is asked of the index; only those are opened, and reduced
    to one row per id and day before the shuffle.
    """
    others = sorted(set(lake.days("bronze/transactions")) - set(days))
    if others and (cfg.duplicates == "keep_first" or cfg.quarantine == "per_id"):
        return _sized(sorted({*days, *others}), id_flags(lake.bronze("transactions")))
    here = lake.bronze("transactions", days)
    if not others:
        return _sized(days, id_flags(here))
    counts = id_counts(here)
    asked = counts.select("transaction_id")
    for table in ("silver/transactions", "silver/quarantine/record_type=TRANSACTION"):
        if lake.has(table):
            before = lake.read(table, days=days).where(~blank("transaction_id"))
            asked = asked.unionByName(before.select("transaction_id"))
    asked = stage(asked.distinct(), "ids-asked")
    # Only days that the index names are opened, and scanned for these ids only.
    likely = days_that_may_hold(lake, asked, others)
    if not likely:
        return _sized(days, counts.where(F.col(COPIES) > 1))
    found = lake.bronze("transactions", likely).join(asked, "transaction_id", "left_semi")
    elsewhere = stage(id_counts(found, "date"), "ids-elsewhere")
    touched = [r["date"] for r in elsewhere.select("date").distinct().collect()]
    if not touched:
        return _sized(days, counts.where(F.col(COPIES) > 1))
    if cfg.retract:
        scope = sorted({*days, *touched})
        # All copies of the ids on the days to be written, wherever the copies are.
        on_scope = stage(lake.bronze("transactions", scope).select("transaction_id").distinct(), "ids-on-scope")
        copies = {*scope, *days_that_may_hold(lake, on_scope, set(others) - set(scope))}
        return _sized(scope, id_flags(lake.bronze("transactions", copies).join(on_scope, "transaction_id", "left_semi")))
    merged = (
        counts.unionByName(elsewhere.drop("date"))
        .groupBy("transaction_id")
        .agg(F.sum(COPIES).alias(COPIES), F.max("_some_incomplete").alias("_some_incomplete"))
        .where(F.col(COPIES) > 1)
    )
    return _sized(days, merged)


def _sized(scope: list[date], flags: DataFrame) -> tuple[list[date], DataFrame, bool]:
    staged, size = stage_sized(flags, "ids")
    return scope, staged, size <= broadcast_limit(flags.sparkSession)


def refresh_gold(run: _Run, scope: list[date], day: date) -> None:
    """Sum up the rewritten Silver days, rebuild the daily table from its cube, and rewrite the weeks
    that changed."""
    lake, cfg, now = run.lake, run.cfg, run.now
    if not lake.has("silver/transactions"):
        return
    silver = lake.read("silver/transactions", days=scope)
    codes = lake.read("silver/transaction_codes").drop(WRITER)

    def daily() -> list[dict]:
        used = lake.replace_days(daily_cube(silver, "date"), "gold/daily_cube", scope, run.run_id)
        if not sum(used.values()) and not lake.days("gold/daily_cube"):
            return [{"records_written": 0}]
        rows = lake.replace_table(
            daily_from_cube(lake.read("gold/daily_cube"), codes, now, cfg), "gold/daily_summary", run.run_id
        )
        return [{"records_written": rows}]

    def weekly() -> list[dict]:
        cube = weekly_cube(silver, "date").hint("rebalance", "date")
        used = lake.replace_days(cube, "gold/weekly_cube", scope, run.run_id)
        if not sum(used.values()) and not lake.days("gold/weekly_cube"):
            return [{"records_written": 0}]
        return [{"records_written": refresh_weekly(lake, codes, run.run_id, now, cfg)}]

    run.step("gold_daily_summary", "GOLD", day, daily)
    run.step("gold_weekly_account_summary", "GOLD", day, weekly)


def _gates(run: _Run, result: RunResult, end: date | None) -> None:
    """The watermark moves last, and only when every gate passes; a gate that cannot be
    evaluated has not passed. Of runs that overlap, the first to end moves it; the others do not,
    and say so."""
    log = run.lake.run_log()
    gates = {
        "the run log is not complete": lambda: check_log_complete(log, run.run_id, run.cfg),
        "accounts are not unique": lambda: check_accounts_unique(
            run.lake.read("silver/accounts")
        ).first()["passed"],
        "a message is not clean": lambda: check_messages_clean(log, run.run_id, run.cfg),
    }
    for reason, gate in gates.items():
        try:
            passed = gate()
        except Exception:
            passed = False
        if not passed:
            result.reasons.append(reason)
    if not result.reasons:
        if end is not None:
            try:
                result.watermark = run.lake.set_watermark(end, run.run_id, datetime.now(timezone.utc), run.began_after)
            except ConcurrentRun as lost:
                result.reasons.append(str(lost))
                run.log("watermark", "CONTROL", "FAILED", error_message=str(lost))
                run.flush()
                return
        result.advanced = True


def run_backfill(
    spark: SparkSession, cfg: Settings, *, run_id: str | None = None, now: datetime | None = None
) -> RunResult:
    """Turn on the flag of rows whose account has arrived since, and refresh their days."""
    run = _Run(spark, cfg, "BACKFILL", run_id, now)
    result = RunResult(run.run_id, watermark=run.lake.get_watermark())
    size = size_of(spark, run.lake.path("silver"))
    with staged_for_now(spark), sized_shuffles(spark, size):
        _backfill(run, result)
    run.flush()
    return result


def _backfill(run: _Run, result: RunResult) -> None:
    lake, cfg = run.lake, run.cfg
    accounts = lake.read("silver/accounts").select("account_id")
    index_unresolved(lake, run.run_id)
    # The index tells which days wait for an account that has arrived: no other day is opened.
    waiting = lake.read(UNRESOLVED, UNRESOLVED_SCHEMA)
    arrived = stage(waiting.select("account_id").distinct().join(accounts, "account_id", "left_semi"), "arrived")
    touched = waiting.join(arrived, "account_id", "left_semi").select("date").distinct()
    result.rewritten = sorted(r["date"] for r in touched.collect())
    if not result.rewritten:
        run.log("silver_transactions", "SILVER", "SKIPPED")
        return

    def resolve() -> list[dict]:
        # First the lasting part: a backfill that is cut off is simply run again.
        owned = arrived.withColumn(WRITER, F.lit(run.run_id))
        owned.write.mode("append").parquet(lake.path(RESOLVED))
        days = lake.read("silver/transactions", days=result.rewritten).drop(WRITER)
        changed = stage(resolve_late_accounts(days, accounts, cfg), "resolved")
        counts = lake.replace_days(changed, "silver/transactions", result.rewritten, run.run_id)
        index_unresolved(lake, run.run_id)
        return [
            {"processed_date": d, "records_processed": n, "records_written": n, "records_rejected": 0}
            for d, n in counts.items()
        ]

    run.step("silver_transactions", "SILVER", None, resolve)
    refresh_gold(run, result.rewritten, max(result.rewritten))
