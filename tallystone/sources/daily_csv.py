"""Daily CSV deliveries: ``{entity}_{YYYY-MM-DD}.csv`` and ``transaction_codes.csv``.

A delivery is one file, or a folder of that name with part files. All accepted deliveries
of a date range are read by one scan per column order, so a range is one job, and a day
with very many rows is split over tasks like any other data.
"""

from __future__ import annotations

import csv
import re
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.schemas import SOURCE_COLUMNS, bronze_schema, text_schema
from tallystone.settings import Settings
from tallystone.sources import files
from tallystone.sources.split_csv import LOOSE, read_split

DAY = r"\d{4}-\d{2}-\d{2}"

# The text of a row whose width is not the header's.
RAW = "_raw_row"
OVER_LONG = "_over_long"

# A quote inside a quoted value is doubled; a backslash is an ordinary character.
DIALECT = {"header": True, "quote": '"', "escape": '"'}


@dataclass(frozen=True)
class Delivery:
    day: date
    path: str
    columns: tuple[str, ...] = ()
    error: str | None = None


def find_deliveries(
    spark: SparkSession, entity: str, start: date, end: date, cfg: Settings
) -> list[Delivery]:
    """The deliveries of a range: one listing, one entry per day at most. The undated
    codes file counts as delivered on the first day."""
    if entity == "transaction_codes":
        found = files.matching(spark, f"{cfg.source_dir}/{entity}.csv")
        return [Delivery(start, path) for path in found]
    deliveries = []
    for path in files.matching(spark, f"{cfg.source_dir}/{entity}_*.csv"):
        hit = re.search(rf"/{entity}_({DAY})\.csv$", path)
        if hit:
            try:
                day = date.fromisoformat(hit.group(1))
            except ValueError:
                continue
            if start <= day <= end:
                deliveries.append(Delivery(day, path))
    return deliveries


def delivered_days(spark: SparkSession, entity: str, cfg: Settings) -> list[date]:
    """All days for which a delivery of the entity lies in the source folder."""
    return sorted(d.day for d in find_deliveries(spark, entity, date.min, date.max, cfg))


def header_error(entity: str, columns: tuple[str, ...]) -> str | None:
    """None when the header has exactly the expected names, in any order."""
    names = SOURCE_COLUMNS[entity]
    if sorted(columns) == sorted(names):
        return None
    seen = Counter(columns)
    problems = [f"no column {c}" for c in names if c not in seen]
    problems += [f"unknown column {c}" for c in seen if c not in names]
    problems += [f"column {c} is there {n} times" for c, n in seen.items() if n > 1]
    return f"the header of this {entity} delivery has " + ", ".join(problems)


def check_headers(
    spark: SparkSession, entity: str, deliveries: list[Delivery], cfg: Settings
) -> list[Delivery]:
    """Compare the names in the first line of each delivery.

    Only the first bytes of each file are read, through the file system and by threads, so
    a delivery costs no Spark job.
    """

    def check(d: Delivery) -> Delivery:
        line = files.first_line(spark, d.path)
        columns = tuple(next(csv.reader([line], doublequote=True), []))
        return Delivery(d.day, d.path, columns, header_error(entity, columns))

    if not deliveries:
        return []
    with ThreadPoolExecutor(max_workers=32) as pool:
        return list(pool.map(check, deliveries))


def read_audited(
    spark: SparkSession, entity: str, deliveries: list[Delivery], cfg: Settings, whole: bool = False
) -> DataFrame:
    """All-text rows of checked deliveries with ``_source_file`` and ``date``, and two findings:
    whether a row has more fields than its header, and whether its quotes are loose.

    The header of every part file is compared again while it is read, so a folder whose
    parts disagree fails instead of being read by position. The parser keeps the text of rows whose
    width is not the header's; of those, the commas outside quotes are counted. A short row is not an
    error: what it lacks is null. Files with line breaks in values are split between records
    (``split_csv``); days with loose quotes must be read again in one piece, with whole=True.
    """
    rows = _parsed(spark, entity, deliveries, cfg, (RAW,), whole)
    bare = F.regexp_replace(F.col(RAW), '"(?:[^"]|"")*"', "")
    commas = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit("")))
    # Spark refuses a query of the kept text alone, so a parsed column takes part.
    parsed = F.length(F.concat_ws("", *SOURCE_COLUMNS[entity])) >= 0
    long = F.coalesce(F.when(F.col(RAW).isNotNull(), (commas >= len(SOURCE_COLUMNS[entity])) & parsed), F.lit(False))
    return rows.withColumn(OVER_LONG, long).drop(RAW)


def _parsed(
    spark: SparkSession, entity: str, deliveries: list[Delivery], cfg: Settings, also: tuple[str, ...],
    whole: bool = False,
) -> DataFrame:
    expected = [*SOURCE_COLUMNS[entity], *also]
    by_order: dict[tuple[str, ...], list[Delivery]] = {}
    for d in deliveries:
        by_order.setdefault(d.columns, []).append(d)
    result = None
    for columns, group in sorted(by_order.items()):
        if cfg.multiline_csv and not whole:
            raw = read_split(spark, [d.path for d in group], list(columns), DIALECT, RAW)
        else:
            raw = (
                spark.read.schema(text_schema([*columns, *also]))
                .options(**DIALECT, multiLine=cfg.multiline_csv, enforceSchema=False)
                .options(columnNameOfCorruptRecord=RAW, columnPruning=False)
                .csv([d.path for d in group])
                .withColumns({"path": F.col("_metadata.file_path"), LOOSE: F.lit(False)})
            )
        path = F.col("path")
        if entity == "transaction_codes":
            name, day = F.lit(f"{entity}.csv"), F.lit(group[0].day)
        else:
            name, day = _name_and_day(path, entity)
        part = raw.select(*expected, name.alias("_source_file"), day.alias("date"), LOOSE)
        result = part if result is None else result.unionByName(part)
    if result is None:
        schema = text_schema([*expected, "_source_file"]).add("date", "date").add(LOOSE, "boolean")
        return spark.createDataFrame([], schema)
    return result


def _name_and_day(path: Column, entity: str) -> tuple[Column, Column]:
    """The delivery a file belongs to: its folder's name or its own. A pattern is searched for in each
    row's path only where neither is a delivery's name."""
    head, own = len(entity) + 1, F.substring_index(path, "/", -1)
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)

    def day_of(name: Column) -> Column:
        fits = name.startswith(f"{entity}_") & name.endswith(".csv") & (F.length(name) == head + len("2024-01-01.csv"))
        return F.when(fits, F.substring(name, head + 1, len("2024-01-01")).try_cast("date"))

    found = F.regexp_extract(path, rf"({entity}_{DAY}\.csv)", 1)
    searched = F.regexp_extract(path, rf"{entity}_({DAY})\.csv", 1).cast("date")
    name = F.when(day_of(folder).isNotNull(), folder).when(day_of(own).isNotNull(), own).otherwise(found)
    return name, F.coalesce(day_of(folder), day_of(own), searched)


def count_rows(spark: SparkSession, entity: str, deliveries: list[Delivery]) -> dict[date, int]:
    """Data lines per delivery, whatever its columns are."""
    if not deliveries:
        return {}
    lines = (
        spark.read.schema("_line string").options(**DIALECT).csv([d.path for d in deliveries])
        .select(F.regexp_extract(F.col("_metadata.file_path"), rf"{entity}_({DAY})\.csv", 1).alias("d"))
    )
    return {
        date.fromisoformat(r["d"]) if r["d"] else deliveries[0].day: r["count"]
        for r in lines.groupBy("d").count().collect()
    }


def add_audit_columns(rows: DataFrame, entity: str, run_id: str, now: datetime, *also: str) -> DataFrame:
    audited = rows.withColumns(
        {"_pipeline_run_id": F.lit(run_id), "_ingested_at": F.lit(now)}
    )
    return audited.select(*bronze_schema(entity).fieldNames(), *also)


def ingest_daily_csv(
    spark: SparkSession, entity: str, start: date, end: date, cfg: Settings, run_id: str, now: datetime
) -> DataFrame:
    """Bronze rows of every well-formed delivery of the range; no table is written. The
    deliveries are parsed once, into the shared folder, and audited there."""
    checked = check_headers(spark, entity, find_deliveries(spark, entity, start, end, cfg), cfg)
    good = [d for d in checked if d.error is None]
    rows = files.stage(read_audited(spark, entity, good, cfg), "deliveries")
    if cfg.multiline_csv:
        loose = {r["date"] for r in rows.where(F.col(LOOSE)).select("date").distinct().collect()}
        again = read_audited(spark, entity, [d for d in good if d.day in loose], cfg, whole=True)
        rows = files.stage(rows.where(~F.col("date").isin(sorted(loose))).unionByName(again), "deliveries")
    bad = [r["date"] for r in rows.where(F.col(OVER_LONG)).select("date").distinct().collect()]
    return add_audit_columns(rows.where(~F.col("date").isin(bad)), entity, run_id, now)
