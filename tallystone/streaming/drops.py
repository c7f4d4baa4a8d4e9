"""The same loads driven by a stream of arriving files.

The stream only notices files and remembers, in its checkpoint, which it has seen; which days
are loaded, with or without rows, is known to the tables of the lake. Each batch hands its days
to the range run, which may be repeated safely. A batch that does
not pass every gate raises, so that the checkpoint keeps it open and the next call repeats it.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallystone.plans.pipeline import RunResult, run_days, unbroken
from tallystone.settings import Settings
from tallystone.sources.daily_csv import DAY, delivered_days
from tallystone.sources.lake import Lake


def arriving_days(
    spark: SparkSession, cfg: Settings, files_per_batch: int | None = None, entity: str = "transactions"
) -> DataFrame:
    """One row per newly arrived file of an entity: the day in its name.

    A stream of file metadata: no file is opened, and one without rows arrives like any other."""
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(f"{cfg.source_dir}/{entity}_*.csv").select(
        F.regexp_extract("path", rf"{entity}_({DAY})\.csv", 1).try_cast("date").alias("day")
    )


def _with_accounts(spark: SparkSession, cfg: Settings, days: list[date]) -> tuple[list[date], set[date]]:
    """The days to load, with earlier ones whose accounts lie there but are not loaded yet; and
    those of them that have no transactions."""
    held = set(Lake(spark, cfg).known_days("bronze/accounts"))
    waiting = {d for d in delivered_days(spark, "accounts", cfg) if d not in held and d <= max(days)}
    every = sorted({*days, *waiting})
    return every, set(every) - set(delivered_days(spark, "transactions", cfg))


def stream_next(
    spark: SparkSession, cfg: Settings, checkpoint: str, files_per_batch: int | None = None
) -> list[RunResult]:
    """Load everything that arrived since the last call, then stop.

    Only days that arrived are processed, and the watermark never passes a day without
    transactions. A day of accounts only is loaded too: rows of later days may need them."""
    results: list[RunResult] = []

    def load(batch: DataFrame, batch_id: int) -> None:
        # As many rows as days arrived.
        days = [r["day"] for r in batch.where("day is not null").select("day").distinct().collect()]
        if not days:
            return
        days, bare = _with_accounts(batch.sparkSession, cfg, days)
        excused = replace(cfg, skippable=(*cfg.skippable, "bronze_transactions"))
        for first, last in unbroken(days):
            settings = excused if any(first <= d <= last for d in bare) else cfg
            result = run_days(batch.sparkSession, first, last, settings)
            if not result.advanced:
                raise RuntimeError("; ".join(result.reasons))
            results.append(result)

    arriving = arriving_days(spark, cfg, files_per_batch).unionByName(
        arriving_days(spark, cfg, files_per_batch, "accounts")
    )
    query: StreamingQuery = (
        arriving.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return results
