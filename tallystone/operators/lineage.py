"""Lineage: from Gold numbers back to Silver, Bronze, the source file and the run log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.functions import week_start

def lineage_trace(
    daily: DataFrame, silver: DataFrame, bronze: DataFrame, run_log: DataFrame
) -> DataFrame:
    """One row per Gold date, Bronze run and source file.

    Shows how many Silver rows of that run and file make up the number, how many Bronze
    rows they were taken from, and whether the run has a SUCCESS entry for its Bronze
    load. Everything is counted per key before it is joined.
    """
    by_file = silver.where(F.col("_is_resolvable")).groupBy(
        "transaction_date", "_pipeline_run_id", "_source_file"
    ).agg(
        F.count(F.lit(1)).alias("silver_rows"),
        F.sum("_signed_amount").alias("silver_amount"),
    )
    loaded = bronze.groupBy("_pipeline_run_id", "_source_file").agg(
        F.count(F.lit(1)).alias("bronze_rows")
    )
    logged = run_log.where(F.col("model_name") == "bronze_transactions").groupBy(
        F.col("run_id").alias("_pipeline_run_id")
    ).agg(F.count_if(F.col("status") == "SUCCESS").alias("log_successes"))
    gold = daily.select("transaction_date", "total_transactions")
    return (
        gold.join(by_file, "transaction_date", "left")
        .join(loaded, ["_pipeline_run_id", "_source_file"], "left")
        .join(logged, "_pipeline_run_id", "left")
        .select(
            "transaction_date", "total_transactions", "_pipeline_run_id", "_source_file",
            "silver_rows", "silver_amount",
            F.coalesce("bronze_rows", F.lit(0)).alias("bronze_rows"),
            (F.coalesce("log_successes", F.lit(0)) > 0).alias("has_success_log"),
        )
    )


def lineage_weekly(
    weekly: DataFrame, silver: DataFrame, bronze: DataFrame, run_log: DataFrame
) -> DataFrame:
    """One row per account, week, Bronze run and source file: which Silver rows make up the
    week, how many Bronze rows the file has, and whether its load is logged as a success."""
    keys = ["account_id", "week_start_date"]
    by_file = silver.where(F.col("_is_resolvable")).groupBy(
        "account_id", week_start(F.col("transaction_date")).alias("week_start_date"),
        "_pipeline_run_id", "_source_file",
    ).agg(F.count(F.lit(1)).alias("silver_rows"), F.sum("_signed_amount").alias("silver_amount"))
    loaded = bronze.groupBy("_pipeline_run_id", "_source_file").agg(
        F.count(F.lit(1)).alias("bronze_rows")
    )
    logged = run_log.where(F.col("model_name") == "bronze_transactions").groupBy(
        F.col("run_id").alias("_pipeline_run_id")
    ).agg(F.count_if(F.col("status") == "SUCCESS").alias("log_successes"))
    return (
        weekly.select(*keys, "total_purchases").join(by_file, keys, "left")
        .join(loaded, ["_pipeline_run_id", "_source_file"], "left")
        .join(logged, "_pipeline_run_id", "left")
        .select(
            *keys, "total_purchases", "_pipeline_run_id", "_source_file", "silver_rows", "silver_amount",
            F.coalesce("bronze_rows", F.lit(0)).alias("bronze_rows"),
            (F.coalesce("log_successes", F.lit(0)) > 0).alias("has_success_log"),
        )
    )


def unlogged_runs(rows: DataFrame, run_log: DataFrame) -> DataFrame:
    """Run ids in a table without a SUCCESS entry in the log, with their row counts."""
    used = rows.groupBy(F.col("_pipeline_run_id").alias("run_id")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    good = run_log.where(F.col("status") == "SUCCESS").select("run_id").distinct()
    return used.join(good, "run_id", "left_anti")


def skipped_run_leaks(rows: DataFrame, run_log: DataFrame) -> DataFrame:
    """Run ids whose every log entry is SKIPPED and that yet own rows. Must be empty."""
    skipped = (
        run_log.groupBy("run_id")
        .agg(F.count_if(F.col("status") != "SKIPPED").alias("others"))
        .where("others = 0")
        .select("run_id")
    )
    used = rows.groupBy(F.col("_pipeline_run_id").alias("run_id")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    return used.join(skipped, "run_id", "left_semi")
