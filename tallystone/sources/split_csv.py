"""Rows of CSV files whose quoted values may hold line breaks, read by many tasks.

A file is read as lines, in byte ranges like any other text. Whether a line begins inside a quoted value
follows from the quotes before it: their parity within the range, and the parity of all ranges before,
which is a prefix sum over one row per range. Most lines are records by themselves and go on as they
are; only lines of records with breaks are brought together, by the place where their record begins,
also where it spans ranges. Each record is then parsed as text.

Quotes must follow RFC 4180: only around whole values, doubled inside. A record that does not is
marked LOOSE: parity says nothing about such a file, and whoever reads it takes the reader that
goes through it in one piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallystone.sources.files import stage

LOOSE = "_loose_quotes"
_STRICT = r'^(?:"(?:[^"]|"")*"|[^",]*)(?:,(?:"(?:[^"]|"")*"|[^",]*))*$'


def _quotes(value: str) -> Column:
    return F.length(value) - F.length(F.replace(F.col(value), F.lit('"'), F.lit("")))


def records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, first, record): the records of the files, each with whether it is its file's first."""
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value",
    )
    lines = lines.withColumn("quotes", _quotes("value"))
    returns = F.endswith(F.min_by("value", "at"), F.lit("\r")) & (F.col("block") == 0)
    blocks = stage(lines.groupBy("path", "block").agg((F.sum("quotes") % 2).alias("odd"), returns.alias("returns")), "csv-blocks")
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    open_at = blocks.select(
        "path", "block", (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2).alias("open"),
        F.max("returns").over(Window.partitionBy("path")).alias("returns"),
    )

    within = Window.partitionBy("path", "block").orderBy("at")
    before = F.coalesce(F.sum("quotes").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lines = lines.withColumn("before", before).join(open_at, ["path", "block"])
    lines = lines.withColumn("inside", (F.col("before") + F.col("open")) % 2 == 1)
    lines = lines.withColumn("goes_on", (F.col("before") + F.col("open") + F.col("quotes")) % 2 == 1)
    alone = ~F.col("inside") & ~F.col("goes_on")
    head = (F.col("block") == 0) & (F.col("at") == F.min("at").over(within))
    lines = lines.withColumn("first", head)
    whole = lines.where(alone).select("path", "first", "returns", F.col("value").alias("record"))

    # Lines of longer records: each belongs to the last line at or before it that opened one.
    parts = lines.where(~alone)
    opens = F.when(~F.col("inside"), F.struct("block", "at", "first"))
    here = F.last(opens, ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    parts = parts.withColumn("start", here)
    last_of_block = stage(parts.groupBy("path", "block").agg(F.max("start").alias("start")), "csv-opens")
    all_blocks = blocks.join(last_of_block, ["path", "block"], "left")
    carried = all_blocks.select("path", "block", F.last("start", ignorenulls=True).over(earlier).alias("carried"))
    parts = parts.join(carried, ["path", "block"]).withColumn("start", F.coalesce("start", "carried"))
    long = parts.groupBy("path", "returns", "start").agg(F.sort_array(F.collect_list(F.struct("block", "at", "value"))).alias("lines"))
    long = long.select("path", F.col("start.first").alias("first"), "returns", F.array_join("lines.value", "\n").alias("record"))
    found = whole.unionAll(long)
    # In a file whose lines end with carriage returns, breaks inside values lose theirs too.
    bare = F.regexp_replace(F.replace(F.col("record"), F.lit("\r\n"), F.lit("\n")), "\r$", "")
    return found.select("path", "first", F.when(F.col("returns"), bare).otherwise(F.col("record")).alias("record"))


def read_split(spark: SparkSession, paths: list[str], columns: list[str], dialect: dict, raw: str) -> DataFrame:
    """The columns as text, `raw` (the text of a record whose width is not the header's), `path`, LOOSE.

    Every file's first record must be the header."""
    text = F.when(F.col("first"), F.regexp_replace("record", "^\ufeff", "")).otherwise(F.col("record"))
    schema = ", ".join(f"`{c}` string" for c in [*columns, raw])
    options = {k: str(v) for k, v in dialect.items() if k != "header"} | {"multiLine": "true", "columnNameOfCorruptRecord": raw}
    rows = records(spark, paths).withColumn("record", text).where("record != ''")
    loose = F.contains("record", F.lit('"')) & ~F.rlike("record", F.lit(_STRICT))
    parsed = rows.select("path", "first", loose.alias(LOOSE), F.from_csv("record", schema, options).alias("r"))
    named = F.concat_ws("\0", *[F.col(f"r.`{c}`") for c in columns]) == "\0".join(columns)
    checked = F.when(~F.col("first"), True).when(named, False).otherwise(
        F.raise_error(F.lit("a part file has another header than its delivery")).cast("boolean")
    )
    return parsed.where(checked).select(*[F.col(f"r.`{c}`").alias(c) for c in columns], F.col(f"r.`{raw}`").alias(raw), "path", LOOSE)
