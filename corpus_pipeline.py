"""From raw documents to a mixed training order, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again before the next one. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallystone.llm.common import read, ship
from tallystone.llm.decontaminate import drop_contaminated
from tallystone.llm.exact_dedup import drop_copies
from tallystone.llm.mixing import with_places
from tallystone.llm.near_join import drop_near_copies
from tallystone.llm.toxicity import drop_toxic
from tallystone.sources.files import scratch_path, staged_for_now


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models do not reject."""
    return drop_toxic(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    ship(spark)
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar texts."""
    ship(spark)
    return drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each with its place in the mix of sources; columns of documents that are named
    like those of the mix give way."""
    ship(spark)
    return with_places(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
]

#: The scores of the first stage are not a matter of SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        # Of what a stage writes on its way only its result is kept.
        target = scratch_path(spark, f"pipeline-{name}")
        with staged_for_now(spark):
            step(spark, docs, sf_dir).write.parquet(target)
        docs = spark.read.parquet(target)
    return STAGES[-1][1](spark, docs, sf_dir)
