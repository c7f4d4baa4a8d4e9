"""Run settings and the fixed value domains of the ledger."""

from __future__ import annotations

from dataclasses import dataclass

# Domains and names the results depend on.
CHANNELS = ("ONLINE", "IN_STORE")
ACCOUNT_STATUSES = ("ACTIVE", "SUSPENDED", "CLOSED")
DEBIT, CREDIT = "DR", "CR"
TRANSACTION_TYPES = ("PURCHASE", "PAYMENT", "FEE", "INTEREST", "REFUND")

NULL_REQUIRED_FIELD = "NULL_REQUIRED_FIELD"
INVALID_AMOUNT = "INVALID_AMOUNT"
DUPLICATE_TRANSACTION_ID = "DUPLICATE_TRANSACTION_ID"
INVALID_TRANSACTION_CODE = "INVALID_TRANSACTION_CODE"
INVALID_CHANNEL = "INVALID_CHANNEL"
INVALID_ACCOUNT_STATUS = "INVALID_ACCOUNT_STATUS"
REASONS = (
    NULL_REQUIRED_FIELD,
    INVALID_AMOUNT,
    DUPLICATE_TRANSACTION_ID,
    INVALID_TRANSACTION_CODE,
    INVALID_CHANNEL,
    INVALID_ACCOUNT_STATUS,
)

# Substrings that must not appear in a logged error message.
FORBIDDEN_IN_MESSAGES = (
    "/", "\\", ".parquet", ".csv", "/app", "/home", "password", "secret", "key",
)

# Text a dataframe CSV reader commonly takes as null (opt-in).
COMMON_NULL_TOKENS = (
    "NA", "N/A", "n/a", "NaN", "nan", "-nan", "-NaN", "NULL", "null", "None",
    "<NA>", "#N/A", "#NA", "#N/A N/A", "1.#IND", "1.#QNAN", "-1.#IND", "-1.#QNAN",
)


@dataclass(frozen=True)
class Settings:
    """Everything a run may vary. Defaults follow the ledger's written rules.

    duplicates   ``reject_all``: every copy of a repeated id is rejected;
                 ``keep_first``: the first otherwise valid copy is kept.
    quarantine   ``per_row`` keeps every rejected row (conserves row counts);
                 ``per_id`` keeps one row per id, its first reason by name.
    resolvable   ``as_of_date``: the account must have been delivered on or before
                 the row's file date; ``latest``: it exists now.
    balance      ``latest`` or ``as_of`` the end of the week.
    null_ids     ``drop`` rows without an id, or ``promote_if_clean``: let them
                 through when no other id is quarantined (three-valued NOT IN).
    verify       how a loaded partition is compared with its source file:
                 ``row_count`` or ``checksum``.
    multiline_csv  allow line breaks inside quoted values; such files are split between records,
                 or read in one piece where quotes stand inside unquoted values.
    retract      rewrite earlier Silver dates when a later file repeats their ids.
    skippable    log models whose SKIPPED status does not hold back the watermark.
    hot_rows     a key with this many rows is joined by broadcast and its rows are
                 spread; by default what exceeds the even share of a shuffle partition,
                 so that fewer keys than partitions can qualify.
    broadcast_*  a lookup table is broadcast only when measured below both bounds.
    """

    source_dir: str = ""
    lake_dir: str = ""
    channels: tuple[str, ...] = CHANNELS
    account_statuses: tuple[str, ...] = ACCOUNT_STATUSES
    duplicates: str = "reject_all"
    quarantine: str = "per_row"
    resolvable: str = "as_of_date"
    balance: str = "latest"
    null_ids: str = "drop"
    null_tokens: tuple[str, ...] = ()
    verify: str = "row_count"
    retract: bool = True
    multiline_csv: bool = False
    skippable: tuple[str, ...] = ("bronze_accounts",)
    forbidden: tuple[str, ...] = FORBIDDEN_IN_MESSAGES
    hot_rows: int | None = None
    broadcast_rows: int = 200_000
    broadcast_bytes: int = 32 * 1024 * 1024

    def __post_init__(self) -> None:
        allowed = {
            "duplicates": ("reject_all", "keep_first"),
            "quarantine": ("per_row", "per_id"),
            "resolvable": ("as_of_date", "latest"),
            "balance": ("latest", "as_of"),
            "null_ids": ("drop", "promote_if_clean"),
            "verify": ("row_count", "checksum"),
        }
        for name, values in allowed.items():
            if getattr(self, name) not in values:
                raise ValueError(f"{name} must be one of {values}")
