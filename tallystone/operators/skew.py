"""Lookups that hold up when one key owns a third of the rows.

Only sides with a bound are broadcast: a lookup table measured below the limits, or the hot
keys. A key is hot when its rows exceed the even share of a shuffle partition, so there are
fewer hot keys than partitions, whatever the size of the data. Rows of a hot key,
and rows that cannot match, get a join key of their own so that they spread over all
tasks instead of meeting in one.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystone.session import INITIAL_PARTITIONS
from tallystone.settings import Settings
from tallystone.sources.files import stage

COPIES = "_copies"


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows and approximate bytes, from one aggregate over the frame."""
    text = [F.octet_length(f.name) for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    width = sum((F.coalesce(t, F.lit(0)) for t in text), F.lit(16 * len(df.columns)))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("long")).alias("b")).first()
    return row["n"], row["b"] or 0


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate, the one Spark itself goes by when it picks a join."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_limit(spark: SparkSession) -> int:
    """Up to what size Spark itself broadcasts a table in this session; below 0 for never."""
    number, unit = re.fullmatch(r"(-?\d+)\s*([a-z]*)", spark.conf.get("spark.sql.autoBroadcastJoinThreshold").lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit.removesuffix("b") or " ")


def is_small(df: DataFrame, cfg: Settings) -> bool:
    """Below both bounds, or so small by estimate that counting is not worth a job."""
    if estimated_bytes(df) <= cfg.broadcast_bytes // 16:
        return cfg.broadcast_rows > 0
    rows, size = measure(df)
    return rows <= cfg.broadcast_rows and size <= cfg.broadcast_bytes


def hot_from(flags: DataFrame, cfg: Settings) -> int:
    """The number of rows from which a key is hot."""
    if cfg.hot_rows is not None:
        return cfg.hot_rows
    conf = flags.sparkSession.conf
    partitions = int(conf.get(INITIAL_PARTITIONS, None) or conf.get("spark.sql.shuffle.partitions"))
    total = flags.agg(F.sum(COPIES)).first()[0] or 0
    return max(2, total // partitions + 1)


def mark(
    rows: DataFrame,
    flags: DataFrame,
    keys: list[str],
    cfg: Settings,
    matchable: Column | None = None,
    spread_by: list[str] | None = None,
    lane: str | None = None,
) -> DataFrame:
    """LEFT JOIN ``rows`` to ``flags``, which is unique on ``keys``.

    ``flags`` carries COPIES, the number of rows per key, and the columns to attach.
    ``matchable`` is false on rows known to have no partner.

    A repeated task must give a row the same lane again. By default the lane is the row's
    place in its input, so ``rows`` has to come from a scan without a shuffle in between;
    after a shuffle, name columns that tell the rows apart in ``spread_by``. With ``lane``, the rows
    keep their lane under that name: above 0 for rows of hot keys and rows that cannot match.
    """
    payload = [c for c in flags.columns if c not in keys and c != COPIES]
    packed = F.struct(*payload)
    is_hot = F.col(COPIES) >= hot_from(flags, cfg)
    # Always 0, but no constant: a constant would be folded out of the join keys.
    shared_lane = F.least(F.col(COPIES), F.lit(0)).cast("long")
    hot = flags.where(is_hot).select(*keys, packed.alias("_hot"))
    rest = flags.where(~is_hot).select(
        *keys, shared_lane.alias("_lane"), packed.alias("_rest")
    )
    alone = F.col("_hot").isNotNull()
    for key in keys:
        alone = alone | F.col(key).isNull()
    if matchable is not None:
        alone = alone | ~matchable
    place = F.pmod(F.xxhash64(*spread_by), F.lit(1 << 40)) if spread_by else F.monotonically_increasing_id()
    own_lane = place + 1
    joined = (
        rows.join(F.broadcast(hot), keys, "left")
        .withColumn("_lane", F.when(alone, own_lane).otherwise(F.lit(0)))
        .join(rest, [*keys, "_lane"], "left")
    )
    found = F.coalesce("_hot", "_rest")
    return joined.select(
        *rows.columns, *[found.getField(c).alias(c) for c in payload],
        *([F.col("_lane").alias(lane)] if lane else []),
    )


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], cfg: Settings) -> DataFrame:
    """LEFT JOIN ``rows`` to a table that is unique on ``keys``."""
    if is_small(table, cfg):
        return rows.join(F.broadcast(table), keys, "left")
    rows = stage(rows, "rows")
    used = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(COPIES))
    return mark(rows, table.join(used, keys, "inner"), keys, cfg)
