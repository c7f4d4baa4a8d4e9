"""Table schemas. Raw tables hold text exactly as received; types start in Silver."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 3)
TOTAL = T.DecimalType(38, 3)

TRANSACTION_COLUMNS = [
    "transaction_id", "account_id", "transaction_date", "amount",
    "transaction_code", "merchant_name", "channel",
]
ACCOUNT_COLUMNS = [
    "account_id", "customer_name", "account_status", "credit_limit",
    "current_balance", "open_date", "billing_cycle_start", "billing_cycle_end",
]
CODE_COLUMNS = [
    "transaction_code", "description", "debit_credit_indicator",
    "transaction_type", "affects_balance",
]
SOURCE_COLUMNS = {
    "transactions": TRANSACTION_COLUMNS,
    "accounts": ACCOUNT_COLUMNS,
    "transaction_codes": CODE_COLUMNS,
}
AUDIT_COLUMNS = ["_pipeline_run_id", "_ingested_at", "_source_file"]

# Columns that differ between two otherwise equal runs.
VOLATILE_COLUMNS = [
    "_pipeline_run_id", "_ingested_at", "_bronze_ingested_at", "_record_valid_from",
    "_promoted_at", "_rejected_at", "_computed_at", "_written_run_id",
]


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def bronze_schema(entity: str) -> T.StructType:
    schema = text_schema(SOURCE_COLUMNS[entity])
    schema.add("_pipeline_run_id", T.StringType())
    schema.add("_ingested_at", T.TimestampType())
    schema.add("_source_file", T.StringType())
    schema.add("date", T.DateType())
    return schema


RUN_LOG = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("pipeline_type", T.StringType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("layer", T.StringType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("completed_at", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("records_processed", T.LongType()),
    T.StructField("records_written", T.LongType()),
    T.StructField("records_rejected", T.LongType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("processed_date", T.DateType()),
])

CONTROL = T.StructType([
    T.StructField("last_processed_date", T.DateType()),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField("updated_by_run_id", T.StringType()),
])

LOAD_RESULT = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("status", T.StringType()),
    T.StructField("records_processed", T.LongType()),
    T.StructField("records_written", T.LongType()),
    T.StructField("error_message", T.StringType()),
])
