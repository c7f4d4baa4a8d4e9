"""Proof that deliveries stay as they came: digests of all source files, before and after.

A file's digest is its length, its lines, and the sum of 64-bit hashes of its lines, so that a changed,
added or lost line shows; lines that only changed places show by the time the file was written. Files
are read line by line by as many tasks as their size asks for, and summed up to one row per file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.settings import Settings
from tallystone.sources import files

UNCHANGED, CHANGED, MISSING, NEW = "UNCHANGED", "CHANGED", "MISSING", "NEW"


def source_digests(spark: SparkSession, cfg: Settings) -> DataFrame:
    """(file, bytes, written, lines, content) of every file below the source folder."""
    zero = F.lit(0).cast("decimal(38,0)").alias("content")
    # Listed through the file system: Spark's readers pass over files without a byte.
    listed = spark.createDataFrame(files.below(spark, cfg.source_dir), "file string, bytes long, written long")
    listed = listed.select("file", "bytes", "written", F.lit(0).cast("long").alias("lines"), zero)
    # Only line feeds end a line; all else, carriage returns too, is its content.
    path = F.try_url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    read = spark.read.options(recursiveFileLookup=True, lineSep="\n").text(cfg.source_dir).select(
        F.regexp_replace(path, "^[a-zA-Z0-9+.-]+:(//[^/]*)?/+", "/").alias("file"), F.lit(None).cast("long").alias("bytes"),
        F.lit(None).cast("long").alias("written"), F.lit(1).cast("long").alias("lines"),
        F.xxhash64("value").cast("decimal(38,0)").alias("content"),
    )
    return listed.unionAll(read).groupBy("file").agg(
        F.max("bytes").alias("bytes"), F.max("written").alias("written"),
        F.sum("lines").alias("lines"), F.sum("content").alias("content"),
    )


def changed_sources(before: DataFrame, after: DataFrame) -> DataFrame:
    """(file, finding) of every file of either side; null equals null."""
    tagged = before.withColumn("_side", F.lit(0)).unionByName(after.withColumn("_side", F.lit(1)))
    state = F.struct("bytes", "written", "lines", "content")
    both = tagged.groupBy("file").agg(
        F.max(F.when(F.col("_side") == 0, state)).alias("was"), F.max(F.when(F.col("_side") == 1, state)).alias("is")
    )
    finding = (
        F.when(F.col("was").isNull(), NEW).when(F.col("is").isNull(), MISSING)
        .when(F.col("was").eqNullSafe(F.col("is")), UNCHANGED).otherwise(CHANGED)
    )
    return both.select("file", finding.alias("finding"))
