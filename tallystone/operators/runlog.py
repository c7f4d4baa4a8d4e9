"""The run log: constraints on its rows and the gates that read it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.functions import contains_any, scrub_paths
from tallystone.schemas import RUN_LOG
from tallystone.settings import Settings


def run_log_rows(entries: DataFrame) -> DataFrame:
    """Apply the field rules: rejected counts belong to Silver only, a SUCCESS has no
    message, other messages are kept whole but carry no path separators."""
    ok = F.col("status") == "SUCCESS"
    return entries.withColumns(
        {
            "records_rejected": F.when(F.col("layer") == "SILVER", F.col("records_rejected")),
            "error_message": F.when(F.coalesce(~ok, F.lit(True)), scrub_paths(F.col("error_message"))),
        }
    ).select(*RUN_LOG.fieldNames())


def log_gate(run_log: DataFrame, cfg: Settings) -> DataFrame:
    """Per run: entries, successes, and whether the run is complete.

    Complete means every entry is SUCCESS, leaving aside SKIPPED entries of models that
    may be skipped, and that there is at least one entry."""
    excused = (F.col("status") == "SKIPPED") & F.col("model_name").isin(*cfg.skippable) \
        if cfg.skippable else F.lit(False)
    return run_log.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "SUCCESS").alias("success_count"),
        F.count_if(excused).alias("excused_count"),
    ).withColumn(
        "complete",
        (F.col("success_count") > 0)
        & (F.col("total") == F.col("success_count") + F.col("excused_count")),
    )


def check_log_complete(run_log: DataFrame, run_id: str, cfg: Settings) -> bool:
    """No entry at all, or an unreadable log, is a failure."""
    row = log_gate(run_log.where(F.col("run_id") == run_id), cfg).first()
    return bool(row and row["complete"])


def unclean_messages(run_log: DataFrame, cfg: Settings) -> DataFrame:
    """Entries whose message contains a forbidden substring, in any letter case."""
    return run_log.where(
        F.col("error_message").isNotNull() & contains_any(F.col("error_message"), cfg.forbidden)
    )


def check_messages_clean(run_log: DataFrame, run_id: str, cfg: Settings) -> bool:
    return unclean_messages(run_log.where(F.col("run_id") == run_id), cfg).isEmpty()
