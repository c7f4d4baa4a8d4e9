"""Parquet tables of the lake: versioned, and by day where they grow by day."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystone.operators.reconcile import day_counts, reconcile_loads
from tallystone.operators.runlog import run_log_rows
from tallystone.schemas import CONTROL, LOAD_RESULT, RUN_LOG, SOURCE_COLUMNS, bronze_schema
from tallystone.settings import Settings
from tallystone.sources import daily_csv, files
from tallystone.sources.daily_csv import OVER_LONG
from tallystone.sources.split_csv import LOOSE
from tallystone.sources.versions import NumberedFiles, VersionedTable, day_parts

WRITER = "_written_run_id"
# Accounts whose earlier rows a backfill has resolved.
RESOLVED = "silver/resolved_accounts"
#: Tables that only grow, row by row, are plain Parquet folders.
APPENDED = ("pipeline/run_log", RESOLVED)


class ConcurrentRun(RuntimeError):
    """Another run has committed since this one began."""


class Lake:
    """The tables of one lake. All but the appended ones are versioned (``versions``): a reader
    sees a table as it was before or after a change, never between."""

    def __init__(self, spark: SparkSession, cfg: Settings):
        self.spark, self.cfg = spark, cfg

    def path(self, table: str) -> str:
        return f"{self.cfg.lake_dir}/{table}"

    def table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, self.path(name))

    def has(self, table: str) -> bool:
        if table in APPENDED:
            return files.exists(self.spark, self.path(table))
        return self.table(table).exists()

    def read(self, table: str, schema: T.StructType | str | None = None, days: Iterable[date] | None = None) -> DataFrame:
        """The table, or some of its days; an empty frame when it does not exist yet and a schema
        is given. A folder of tables named ``column=value`` is read as one, with that column."""
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        if table in APPENDED:
            if not self.has(table):
                return self.spark.createDataFrame([], schema)
            reader = self.spark.read if schema is None else self.spark.read.schema(schema)
            return reader.parquet(self.path(table))
        _, state = self.table(table).manifests.newest()
        if not state and schema is None:
            parts = None
            for folder in files.matching(self.spark, f"{self.path(table)}/*=*"):
                name = folder.rsplit("/", 1)[1]
                if self.has(f"{table}/{name}"):
                    column, value = name.split("=", 1)
                    part = self.read(f"{table}/{name}", days=days).withColumn(column, F.lit(value))
                    parts = part if parts is None else parts.unionByName(part)
            if parts is not None:
                return parts
        return self.table(table).frame(days, schema, state)

    def bronze(self, entity: str, days: Iterable[date] | None = None) -> DataFrame:
        return self.read(f"bronze/{entity}", bronze_schema(entity), days)

    def replace_table(self, df: DataFrame, table: str, run_id: str) -> int:
        """Replace a whole table; returns its rows."""
        return self.table(table).replace(df.withColumn(WRITER, F.lit(run_id)), run_id)

    def replace_days(
        self, df: DataFrame, table: str, days: Iterable[date], run_id: str,
        of: dict[date, str] | None = None, shown: bool = True,
    ) -> dict[date, int]:
        """Replace the given days of a table and return the rows now in each, as counted by the
        write. Days that receive no rows hold none from then on. With shown=False readers don't see
        the column date."""
        days = sorted(set(days))
        if not days:
            return {}
        owned = df.withColumn(WRITER, F.lit(run_id))
        return self.table(table).replace_days(owned, days, run_id, of, shown)

    def day_writes(self, table: str) -> dict[date, str]:
        """The write that each day of a table comes from; a write's name is never used twice. A
        day that is known but has no rows comes from nothing, the empty name."""
        parts = self.table(table).parts()
        return {date.fromisoformat(d): x["write"] or "" for d, x in sorted(parts.items()) if d}

    def outdated(self, table: str, source: str) -> dict[date, str]:
        """Days of the source, with their writes, that a table made from it day by day does not
        hold as they are now."""
        made = {d: x["of"] for d, x in self.table(table).parts().items()}
        return {d: w for d, w in self.day_writes(source).items() if made.get(d.isoformat()) != w}

    def days(self, table: str) -> list[date]:
        """The days a table has rows of."""
        return [d for d, write in self.day_writes(table).items() if write]

    def known_days(self, table: str) -> list[date]:
        """The days a table has been given, with or without rows."""
        return list(self.day_writes(table))

    # Run log: append only.

    def append_run_log(self, entries: list[dict]) -> None:
        rows = self.spark.createDataFrame(
            [tuple(e.get(c) for c in RUN_LOG.fieldNames()) for e in entries], RUN_LOG
        )
        run_log_rows(rows).coalesce(1).write.mode("append").parquet(self.path("pipeline/run_log"))

    def run_log(self) -> DataFrame:
        return self.read("pipeline/run_log", RUN_LOG)

    # Watermark: numbered commits, each made once. Of two runs that began at the same commit
    # only the first to end moves it.

    def _commits(self) -> NumberedFiles:
        return NumberedFiles(self.spark, self.path("pipeline/control"))

    def commit_number(self) -> int:
        return self._commits().newest()[0]

    def control(self) -> DataFrame:
        number, held = self._commits().newest()
        rows = []
        if number:
            rows = [(date.fromisoformat(held["last_processed_date"]), datetime.fromisoformat(held["updated_at"]), held["updated_by_run_id"])]
        return self.spark.createDataFrame(rows, CONTROL)

    def get_watermark(self) -> date | None:
        number, held = self._commits().newest()
        return date.fromisoformat(held["last_processed_date"]) if number else None

    def set_watermark(self, day: date, run_id: str, now: datetime, after: int | None = None) -> date:
        """Never moves backwards. With `after`, only if no other run has committed since that
        commit; else ConcurrentRun is raised and nothing changes."""
        while True:
            number, held = self._commits().newest()
            if after is not None and number != after:
                raise ConcurrentRun(f"run {held['updated_by_run_id']} has moved the watermark meanwhile")
            moved = max(day, date.fromisoformat(held["last_processed_date"])) if number else day
            content = {"last_processed_date": moved.isoformat(), "updated_at": now.isoformat(), "updated_by_run_id": run_id}
            if self._commits().publish(number + 1, content):
                return moved

    def get_next_date(self) -> date | None:
        watermark = self.get_watermark()
        return watermark + timedelta(days=1) if watermark else None


def date_spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    """Every day from start to end, both included, ascending."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias("date")
    )


def load_plan(source: DataFrame, loaded: DataFrame, entity: str, cfg: Settings) -> DataFrame:
    """Which dates to load: see ``reconcile_loads``."""
    columns = SOURCE_COLUMNS[entity] if cfg.verify == "checksum" else None
    return reconcile_loads(day_counts(source, columns), day_counts(loaded, columns))


def load_idempotent(
    spark: SparkSession, entity: str, start: date, end: date, cfg: Settings, run_id: str, now: datetime
) -> DataFrame:
    """Bring the deliveries of a range into Bronze; one result row per day.

    A day already loaded is compared with its source and only rewritten when they differ.
    A day that is not loaded yet is parsed once: written unseen, audited there and published. A day
    with a wrong header or an over-long row is FAILED and changes nothing; a day without a file is
    SKIPPED.
    """
    done = spark.createDataFrame(load_days(spark, entity, start, end, cfg, run_id, now), LOAD_RESULT)
    if entity == "transaction_codes":
        end = start
    return date_spine(spark, start, end).join(done, "date", "left").withColumn(
        "status", F.coalesce("status", F.lit("SKIPPED"))
    )


def load_days(
    spark: SparkSession, entity: str, start: date, end: date, cfg: Settings, run_id: str, now: datetime
) -> list[tuple]:
    """The work of ``load_idempotent``; result tuples for the days that have a file."""
    lake = Lake(spark, cfg)
    table = f"bronze/{entity}"
    checked = daily_csv.check_headers(
        spark, entity, daily_csv.find_deliveries(spark, entity, start, end, cfg), cfg
    )
    bad = [d for d in checked if d.error]
    bad_rows = daily_csv.count_rows(spark, entity, bad)
    good = [d for d in checked if not d.error]
    kept: dict[date, int] = {}
    written: dict[date, int] = {}
    too_long: dict[date, int] = {}
    for whole in (False, True):  # files with loose quotes are read again, in one piece
        done = _load_good(lake, entity, good, cfg, run_id, now, whole)
        for found, more in zip((kept, written, too_long), done, strict=False):
            found |= more
        good = [d for d in good if d.day in done[3]]
        if not good:
            break
    message = f"a row of this {entity} delivery has more fields than its header"
    results = [(day, "SUCCESS", n, n, None) for day, n in {**kept, **written}.items()]
    results += [(d.day, "FAILED", bad_rows.get(d.day, 0), None, d.error) for d in bad]
    return results + [(day, "FAILED", n, None, message) for day, n in too_long.items()]


def _load_good(
    lake: Lake, entity: str, good: list[daily_csv.Delivery], cfg: Settings, run_id: str, now: datetime, whole: bool
) -> tuple[dict[date, int], dict[date, int], dict[date, int], set[date]]:
    """Rows by day of the deliveries that were kept, written and refused, and days with loose quotes,
    of which nothing was done."""
    spark, table = lake.spark, f"bronze/{entity}"
    present = set(lake.days(table))
    kept: dict[date, int] = {}
    too_long: dict[date, int] = {}
    loose: set[date] = set()
    findings = [F.max(c).alias(c) for c in (OVER_LONG, LOOSE)]
    again = [d for d in good if d.day in present]
    if again:  # compared first, so that a day that agrees is not written
        columns = SOURCE_COLUMNS[entity] if cfg.verify == "checksum" else None
        source = day_counts(daily_csv.read_audited(spark, entity, again, cfg, whole), columns, *findings).collect()
        loose = {r["date"] for r in source if r[LOOSE]}
        too_long = {r["date"]: r["row_count"] for r in source if r[OVER_LONG] and not r[LOOSE]}
        counts = spark.createDataFrame([r for r in source if not (r[OVER_LONG] or r[LOOSE])], _count_schema(columns))
        plan = reconcile_loads(counts, day_counts(lake.bronze(entity, [d.day for d in again]), columns))
        kept = {
            r["date"]: r["loaded_rows"]
            for r in plan.where("action = 'KEEP' and source_rows is not null").collect()
        }
    todo = [d for d in good if d.day not in kept and d.day not in too_long and d.day not in loose]
    written: dict[date, int] = {}
    if todo:
        # Parsed once, into folders that nobody sees; audited there; then the good days are published.
        rows = daily_csv.read_audited(spark, entity, todo, cfg, whole)
        rows = daily_csv.add_audit_columns(rows, entity, run_id, now, OVER_LONG, LOOSE).withColumn(WRITER, F.lit(run_id))
        store = lake.table(table)
        write = store.write(rows, by_day=True)
        audit = store.staged(write, rows.schema).groupBy("date").agg(F.count(F.lit(1)).alias("n"), *findings)
        found = {r["date"]: r for r in audit.collect()}
        loose |= {day for day, r in found.items() if r[LOOSE]}
        refused = {day: r["n"] for day, r in found.items() if r[OVER_LONG] and not r[LOOSE]}
        too_long |= refused
        written = {d.day: found[d.day]["n"] if d.day in found else 0 for d in todo if d.day not in refused and d.day not in loose}
        if written:
            store.publish(day_parts(write, written), bronze_schema(entity).add(WRITER, "string"), run_id)
        store.discard(write, [d.isoformat() for d in found if d in refused or d in loose])
    return kept, written, too_long, loose


def _count_schema(columns: list[str] | None) -> str:
    return f"date date, row_count long{', checksum decimal(38,0)' if columns else ''}, {OVER_LONG} boolean, {LOOSE} boolean"
