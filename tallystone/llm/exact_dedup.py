"""Exact dedup by deterministic block naming.

A text without white space is cut into blocks of fixed size. Equal blocks are brought together
by sorting and get one integer name; then the names of adjacent pairs are named the same way,
level by level, until each document has one name. Two documents have the same name at the same
level exactly if their texts are equal: names are given to equal values, never to digests, so
nothing can collide.

Names are the smallest occurrence number of a value. Occurrence numbers are stored with the
rows before they are used, so a repeated task sees the same ones. Within a batch of rows equal
blocks are merged before anything is shuffled, which is what a large group of copies needs; the
text itself is shuffled once, in blocks, and all other steps move integers.

Defined cases: null counts as empty; empty texts equal one another; a repeated id is a row of
its own; among equal texts the row with most code points, then smallest id (null last), then
first stored stays; an empty table gives an empty table; further columns are carried along.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallystone.llm.common import lean, packed, read, stage, text_of, with_columns_of

BLOCK_BYTES = 4096
SPACES = b" \t\n\x0b\x0c\r"
#: Bytes of distinct blocks that a task remembers at once.
REMEMBERED = 8 << 20


def _numbered(text_column: str, block_bytes: int):
    """Adds to each row its number, code points, digest and, for each block, the first equal one among
    those that the task remembers."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        number, seen, held = TaskContext.get().partitionId() << 36, {}, 0
        for batch in batches:
            rids, shas, reps = [], [], []
            for text in text_of(batch.column(0), text_column):
                flat = text.translate(None, SPACES)
                rids.append(number)
                shas.append(hashlib.sha256(flat).hexdigest())
                mine = []
                for at in range(0, max(len(flat), 1), block_bytes):
                    block = flat[at : at + block_bytes]
                    first = seen.get(block)
                    if first is None:
                        if held > REMEMBERED:
                            seen, held = {}, 0
                        seen[block] = first = number
                        held += len(block)
                    mine.append(first)
                    number += 1
                reps.append(mine)
            points = pc.fill_null(pc.utf8_length(pc.struct_field(batch.column(0), text_column)), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rids, pa.int64()), points.cast(pa.int64()), pa.array(shas, pa.string()), pa.array(reps, pa.list_(pa.int64()))],
                names=["row", "rid", "points", "sha", "reps"],
            )

    return run


def _first_blocks(block_bytes: int):
    """The blocks of each row that are the first of their kind, as far as their task remembered."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            names, blocks, held = [], [], 0
            for rid, reps, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_of(batch.column(2)), strict=True):
                flat = None
                for i, rep in enumerate(reps):
                    if rep == rid + i:
                        flat = text.translate(None, SPACES) if flat is None else flat
                        names.append(rep)
                        blocks.append(flat[i * block_bytes : (i + 1) * block_bytes])
                        held += block_bytes
                if held > REMEMBERED:
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(blocks, pa.binary())], names=["rep", "block"])
                    names, blocks, held = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(blocks, pa.binary())], names=["rep", "block"])

    return run


def name_documents(docs: DataFrame, text_column: str = "text", block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(rows, names): rows (row, rid, points, sha, reps) stored; names (rid, level, name), equal for equal texts."""
    rows = packed(docs).mapInArrow(
        lean(_numbered(text_column, block_bytes)),
        with_columns_of(docs, ("rid", "long"), ("points", "long"), ("sha", "string"), ("reps", "array<long>")),
    )
    rows = stage(rows, "named-rows")
    # Level 0: sorting brings equal blocks of different batches together.
    blocks = rows.select("rid", "reps", F.col(f"row.`{text_column}`").alias("text")).mapInArrow(lean(_first_blocks(block_bytes)), "rep long, block binary")
    renamed = blocks.select("rep", F.first("rep").over(Window.partitionBy("block").orderBy("rep")).alias("name")).where("name <> rep")
    found = rows.select("rid", F.size("reps").alias("n"), F.posexplode("reps").alias("pos", "rep"))
    now = stage(found.join(renamed, "rep", "left").select("rid", "n", "pos", F.coalesce("name", "rep").alias("name")), "names-0")
    longest = now.agg(F.max("n")).first()[0] or 1
    done = [now.where("n = 1").select("rid", F.lit(0).alias("level"), "name")]
    level = 0
    while longest > 1:
        # Level k: name adjacent pairs; the last one of an odd row pairs with -1, which is no name.
        side = F.pmod("pos", F.lit(2))
        pairs = (
            now.where("n > 1")
            .groupBy("rid", "n", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
            .agg(F.max(F.when(side == 0, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(side == 1, F.col("name"))), F.lit(-1)).alias("b"))
            .withColumn("own", F.col("rid") + F.col("pos").cast("long") * F.lit(2 << level))
        )
        level += 1
        # Stored, so that the join has two plain shuffles and Spark can split the one of a common pair.
        shared = stage(pairs.groupBy("a", "b").agg(F.min("own").alias("name"), F.count("*").alias("times")).where("times > 1"), f"shared-{level}")
        longest = (longest + 1) // 2
        now = stage(
            pairs.join(shared, ["a", "b"], "left").select("rid", F.ceil(F.col("n") / 2).cast("int").alias("n"), "pos", F.coalesce("name", "own").alias("name")),
            f"names-{level}",
        )
        done.append(now.where("n = 1").select("rid", F.lit(level).alias("level"), "name"))
    names = done[0]
    for more in done[1:]:
        names = names.unionAll(more)
    return rows, names


def _judged(rows: DataFrame, names: DataFrame, id_column: str) -> DataFrame:
    """Each row's number, id, digest, its group's size and the row that stays."""
    facts = rows.select("rid", F.col(f"row.`{id_column}`").alias("id"), "points", "sha").join(names, "rid")
    best = F.min(F.struct((-F.col("points")).alias("fewer"), F.col("id").isNull().alias("without"), F.col("id").alias("id"), F.col("rid").alias("rid")))
    # Stored, so that the join has two plain shuffles and Spark can split the one of a large group.
    groups = stage(facts.groupBy("level", "name").agg(best.alias("best"), F.count("*").alias("group_size")), "groups")
    return facts.join(groups, ["level", "name"]).select("rid", "id", "sha", "group_size", F.col("best.id").alias("keep_id"), (F.col("best.rid") == F.col("rid")).alias("kept"))


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of docs: its id, the id that stays, group size, whether it stays, digest of the text."""
    rows, names = name_documents(docs.select(id_column, text_column), text_column, block_bytes)
    judged = _judged(rows, names, id_column)
    return judged.select(F.col("id").alias(id_column), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs that stay, with the columns of docs."""
    rows, names = name_documents(docs, text_column, block_bytes)
    gone = stage(_judged(rows, names, id_column).where("not kept").select("rid"), "copies")
    return rows.join(gone, "rid", "left_anti").select("row.*")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read(spark, sf_dir, "documents", "doc_id", "text"))


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS flat
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY flat) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(flat) AS text_sha256
FROM d WINDOW w AS (PARTITION BY flat ORDER BY points DESC, doc_id NULLS LAST)
"""
