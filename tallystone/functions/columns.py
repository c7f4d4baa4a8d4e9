"""Scalar expressions shared by the operators. All stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.schemas import MONEY


def fold(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def blank(column: str) -> Column:
    """Null or empty. Never null itself, so it can be negated safely."""
    return F.col(column).isNull() | F.coalesce(F.col(column) == "", F.lit(False))


def any_blank(columns: Iterable[str]) -> Column:
    return fold(blank(c) for c in columns)


def any_null(columns: Iterable[str]) -> Column:
    return fold(F.col(c).isNull() for c in columns)


def normalise_nulls(df: DataFrame, columns: Iterable[str], tokens: tuple[str, ...]) -> DataFrame:
    """Turn the given tokens into null; without tokens the frame is unchanged."""
    if not tokens:
        return df
    return df.withColumns(
        {c: F.when(~F.col(c).isin(*tokens), F.col(c)) for c in columns}
    )


def money(column: str | Column) -> Column:
    """DECIMAL(18,3), null when the text is no number."""
    column = F.col(column) if isinstance(column, str) else column
    return column.try_cast(MONEY)


def signed(amount: Column, indicator: Column, positive: str) -> Column:
    """+amount for the positive indicator; -amount for any other, null included."""
    return F.when(indicator == positive, amount).otherwise(-amount)


def to_day(column: str) -> Column:
    return F.col(column).try_cast("date")


def week_start(day: Column) -> Column:
    """Monday of the week."""
    return F.trunc(day, "week")


def week_end(monday: Column) -> Column:
    return F.date_add(monday, 6)


def scrub_paths(message: Column) -> Column:
    return F.translate(message, "/\\", "")


def contains_any(text: Column, words: Iterable[str]) -> Column:
    """Case-insensitive: does the text contain any of the words?"""
    low = F.lower(text)
    return fold(low.contains(w.lower()) for w in words)
