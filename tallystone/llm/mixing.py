"""Mixing sources to target weights by Pfair scheduling.

The rows of each source are numbered by id and cut into blocks of block_rows. With integer
weights q of sum Q, block k of a source is released at slot floor(k*Q/q) and due by
ceil((k+1)*Q/q). Earliest deadline first among released blocks (ties: source by name) meets
every deadline, so after any number of slots each source has had its share to within less than
one block. After Q slots all shares are exact and the pattern repeats: it is worked out once,
over Q slots, and a block's slot follows from its number.

A source that runs out leaves its slots empty and the others close up, so every row gets a
position and the others keep their proportions; on_target tells the part, in whole patterns,
for which no source has run out. The final position is a closed form of slot and source sizes:
nothing is sorted as a whole.

Only DataFrame functions are used. Rows are numbered by one range partitioning of their keys by source,
id and two hashes of the content: Spark samples its bounds, so that a source with a third of all rows,
one far-off id, null ids or many equal ids are spread like all else. A key's place in the source
follows from the keys before it in its partition and the partitions before; rows meet their places
by one join. The pattern has as many
entries as the sum of the weights, which the weight levels bound per source; it does not grow with
the rows.

Defined cases: a null source is a source of its own; null ids come first; ids may have any type that
sorts; rows with equal ids stand in the order of a hash of their content; sources without a given weight
weigh 1; an empty table gives an empty one. with_places gives its columns their names even where docs
have such columns: those give way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallystone.llm.common import packed, read, stage

BLOCK_ROWS = 16
LEVELS = 20


def _pattern(plan: DataFrame) -> DataFrame:
    """(s, k, slot, before): the slot of block k of source number s, and each source's blocks before it."""
    weights = plan.agg(F.expr("transform(array_sort(collect_list(struct(s, q))), x -> x.q)").alias("q"), F.sum("q").cast("int").alias("total"))
    picked = """
      array_min(filter(
        transform(q, (w, i) -> struct(((state.taken[i] + 1L) * total + w - 1) div w as due, i as i, (state.taken[i] * 1L * total) div w as release)),
        x -> x.release <= t)).i"""
    fold = f"""
      aggregate(
        sequence(0, total - 1),
        struct(transform(q, w -> 0) as taken, cast(array() as array<int>) as slots),
        (state, t) -> element_at(transform(array({picked}), p -> struct(
          transform(state.taken, (n, i) -> if(i = p, n + 1, n)) as taken,
          concat(state.slots, array(p)) as slots)), 1),
        state -> state.slots)"""
    slots = weights.where("total > 0").select(F.size("q").alias("n"), F.expr(fold).alias("slots"))
    each = slots.select("n", "slots", F.posexplode("slots").alias("slot", "s"))
    counts = F.expr("transform(sequence(0, n - 1), u -> size(filter(slice(slots, 1, slot), x -> x = u)))")
    return each.select("slot", "s", counts.alias("before")).withColumn("k", F.element_at("before", F.col("s") + 1)).select("s", "k", "slot", "before")


def mixed(docs: DataFrame, weights: dict[str, int] | None = None, source_column: str = "source", id_column: str = "doc_id", block_rows: int = BLOCK_ROWS, levels: int = LEVELS, rows_per_range: int | None = None) -> DataFrame:
    """(row, block, slot, release, deadline, position, on_target) for each row of docs.

    Without weights a source weighs 1 + (levels - 1) * sqrt(rows / most rows), rounded down: large
    sources lead, by less than their size.
    """
    spark = docs.sparkSession
    rows = packed(docs).select(
        "row",
        F.coalesce(F.concat(F.lit("s"), F.col(f"row.`{source_column}`")), F.lit("n")).alias("key"),
        F.col(f"row.`{id_column}`").alias("id"),
    )
    sizes = rows.groupBy("key").agg(F.count("*").alias("n"))
    everything = Window.partitionBy(F.lit(1))  # sources, not rows
    if weights is None:
        weight = F.floor(1 + (levels - 1) * F.sqrt(F.col("n") / F.max("n").over(everything))).cast("int")
    else:
        given = F.create_map(*[x for k, v in weights.items() for x in (F.lit("s" + k), F.lit(int(v)))]) if weights else F.lit(None)
        weight = F.coalesce(given[F.col("key")] if weights else F.lit(None).cast("int"), F.lit(1))
    plan = stage(
        sizes.withColumn("q", weight)
        .withColumn("s", F.row_number().over(everything.orderBy("key")) - 1)
        .withColumn("blocks", F.ceil(F.col("n") / block_rows)),
        "mix-plan",
    )
    all_sources = plan.agg(
        F.expr("transform(array_sort(collect_list(struct(s, q, blocks, n))), x -> struct(x.q as q, x.blocks as blocks, x.n as n))").alias("sources"),
        F.sum("q").alias("total"),
        F.min(F.floor(F.col("blocks") / F.col("q"))).alias("whole"),
    )
    pattern = stage(_pattern(plan).withColumn("one", F.lit(1)).join(all_sources.withColumn("one", F.lit(1)), "one").drop("one"), "mix-pattern")

    # A row's key, two hashes of its content, goes for the row: only keys are sorted as a whole, by
    # source, id and hash over range partitions. Rows that are equal in all columns share a key.
    keyed = rows.join(plan.select("key", "s", "q"), "key").select(
        "row", "id", "s", "q", F.xxhash64("row").alias("own"), F.xxhash64("row", F.lit(7)).alias("own2")
    )
    keys = keyed.groupBy("own", "own2").agg(F.min("s").alias("s"), F.min("id").alias("id"), F.count("*").alias("n"))
    order = [F.col("s"), F.col("id").asc_nulls_first(), F.col("own"), F.col("own2")]
    parts = []
    if rows_per_range is not None:
        parts = [max(1, -(-(plan.agg(F.sum("n")).first()[0] or 0) // rows_per_range))]
    sorted_keys = keys.repartitionByRange(*parts, *order).sortWithinPartitions(*order)
    near = stage(sorted_keys.select("s", "own", "own2", "n", F.monotonically_increasing_id().alias("number")), "mix-keys")
    near = near.withColumn("part", F.shiftright("number", 33))
    before = Window.partitionBy("s", "part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("s").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = near.groupBy("s", "part").agg(F.sum("n").alias("n"))
    offsets = stage(counts.select("s", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")), "mix-offsets")
    places = near.join(offsets, ["s", "part"]).select("own", "own2", (F.col("offset") + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("first"))
    places = stage(places, "mix-places")
    same = F.row_number().over(Window.partitionBy("own", "own2").orderBy("s"))
    numbered = keyed.drop("id").join(places, ["own", "own2"]).withColumn("at", F.col("first") + same - 1)
    numbered = numbered.withColumn("block", F.floor(F.col("at") / block_rows)).withColumn("k", (F.col("block") % F.col("q")).cast("int"))

    cycle = F.floor(F.col("block") / F.col("q"))
    out = numbered.join(pattern, ["s", "k"]).withColumn("cycle", cycle)
    before = F.expr(f"aggregate(zip_with(before, sources, (b, u) -> least(u.n, {int(block_rows)}L * least(u.blocks, cycle * u.q + b))), 0L, (a, x) -> a + x)")
    return out.select(
        "row",
        "block",
        (F.col("cycle") * F.col("total") + F.col("slot")).alias("slot"),
        F.floor(F.col("block") * F.col("total") / F.col("q")).alias("release"),
        F.ceil((F.col("block") + 1) * F.col("total") / F.col("q")).alias("deadline"),
        (before + F.col("at") % block_rows).alias("position"),
        (F.col("cycle") < F.col("whole")).alias("on_target"),
    )


MIX_COLUMNS = ("block", "slot", "release", "deadline", "position", "on_target")


def with_places(docs: DataFrame, **options) -> DataFrame:
    """The columns of docs that are not named like those of the mix, then those."""
    own = [f"row.`{c}`" for c in docs.columns if c.lower() not in MIX_COLUMNS]
    return mixed(docs, **options).select(*[F.col(c) for c in own], *MIX_COLUMNS)


def op7_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_places(read(spark, sf_dir, "documents", "doc_id", "source"))


OP7_SQL = f"""
WITH RECURSIVE sizes AS (
  SELECT coalesce('s' || source, 'n') AS key, count(*) AS n FROM documents GROUP BY 1),
plan AS (
  SELECT key, n, floor(1 + {LEVELS - 1} * sqrt(n / max(n) OVER ()))::BIGINT AS q,
         row_number() OVER (ORDER BY key) AS s, ceil(n / {BLOCK_ROWS})::BIGINT AS blocks
  FROM sizes),
lists AS (SELECT list(q ORDER BY s) AS qs, sum(q)::BIGINT AS total, min(blocks // q) AS whole FROM plan),
steps AS (
  SELECT 0::BIGINT AS t, list_transform(qs, lambda x: 0::BIGINT) AS taken, 0::BIGINT AS s, 0::BIGINT AS k FROM lists
  UNION ALL
  SELECT t + 1, list_transform(range(1, len(qs) + 1), lambda i: taken[i] + CASE WHEN i = p THEN 1 ELSE 0 END), p, taken[p]
  FROM (
    SELECT t, taken, qs,
      list_min(list_filter(
        list_transform(range(1, len(qs) + 1), lambda i: {{'due': ((taken[i] + 1) * total + qs[i] - 1) // qs[i], 'i': i, 'release': (taken[i] * total) // qs[i]}}),
        lambda x: x.release <= t)).i AS p
    FROM steps, lists WHERE t < total)),
pattern AS (SELECT s, k, t - 1 AS slot FROM steps WHERE t > 0),
numbered AS (
  SELECT d.doc_id, d.source, p.s, p.q, row_number() OVER (PARTITION BY p.s ORDER BY d.doc_id NULLS FIRST) - 1 AS nth
  FROM documents d JOIN plan p ON p.key = coalesce('s' || d.source, 'n')),
placed AS (
  SELECT doc_id, source, n.s, n.q, nth, nth // {BLOCK_ROWS} AS block, (nth // {BLOCK_ROWS}) // n.q AS cycle, p.slot
  FROM numbered n JOIN pattern p ON p.s = n.s AND p.k = (nth // {BLOCK_ROWS}) % n.q)
SELECT doc_id, source, block, cycle * total + slot AS slot, (block * total) // q AS release,
       ((block + 1) * total + q - 1) // q AS deadline,
       row_number() OVER (ORDER BY cycle * total + slot, nth) - 1 AS position,
       cycle < whole AS on_target
FROM placed, lists
"""
