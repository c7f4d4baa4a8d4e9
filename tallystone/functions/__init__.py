from tallystone.functions.columns import (
    any_blank,
    any_null,
    blank,
    contains_any,
    fold,
    money,
    normalise_nulls,
    scrub_paths,
    signed,
    to_day,
    week_end,
    week_start,
)

__all__ = [
    "any_blank", "any_null", "blank", "contains_any", "fold", "money",
    "normalise_nulls", "scrub_paths", "signed", "to_day", "week_end",
    "week_start",
]
