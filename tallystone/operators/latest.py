"""The newest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The greatest row per key by ``order``; ties are settled by the other columns.

    One aggregate with a map-side combine: a task sends at most one row per key, however
    often the key repeats.
    """
    rest = [c for c in rows.columns if c not in keys and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("_best")
    picked = rows.groupBy(*keys).agg(best)
    return picked.select(
        *[F.col(c) if c in keys else F.col("_best").getField(c).alias(c) for c in rows.columns]
    )
