"""Transaction codes: the reference table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.operators.latest import latest_by
from tallystone.schemas import AUDIT_COLUMNS, CODE_COLUMNS


def silver_codes(bronze_codes: DataFrame, mode: str = "latest") -> DataFrame:
    """``latest``: one row per code, from its most recent load.
    ``distinct``: all distinct rows, audit columns included."""
    rows = bronze_codes.select(*CODE_COLUMNS, *AUDIT_COLUMNS)
    if mode == "distinct":
        return rows.distinct()
    return latest_by(rows, ["transaction_code"], ["_ingested_at", "_source_file"])


def require_codes(codes: DataFrame) -> int:
    """Refuse to go on without a populated table that has one row per code."""
    row = codes.agg(
        F.count(F.lit(1)).alias("n"),
        F.count("transaction_code").alias("filled"),
        F.countDistinct("transaction_code").alias("codes"),
    ).first()
    if row["n"] == 0:
        raise ValueError("there is no transaction code at all")
    if row["filled"] != row["n"]:
        raise ValueError("Silver transaction_codes holds a null code")
    if row["codes"] != row["n"]:
        raise ValueError("Silver transaction_codes repeats a code")
    return row["n"]
