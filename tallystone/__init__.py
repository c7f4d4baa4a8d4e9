"""Daily ledger extracts to audited, validated and summarised Spark tables."""

from tallystone.settings import Settings

__all__ = ["Settings"]
