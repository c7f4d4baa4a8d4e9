"""Similarity self-join on word shingles: MinHash LSH forest, then exact verification.

1. Every document becomes the set of its five-word shingles (64-bit numbers), a digest of that
   set, and a MinHash signature. The signature's values, eight bits each, fill `trees` keys of
   eight values: one sorted prefix trie per tree. Documents with equal sets are one class from
   here on; copies are never paired.
2. A trie's keys are numbers, so a prefix is a shift. The matched prefix starts at its full
   length and is shortened until a pair at exactly the threshold shares a prefix in some tree
   with at least the target recall. That follows from the threshold and the number of trees, so it
   is the same for all documents and all trees. Documents that share a prefix are joined to its
   smallest member; the connected components of these candidate edges hold every link found.
3. Exact verification takes place inside components, over the real shingle sets of their texts.
   A component is cut into chunks of bounded size and each pair of chunks is one small piece of
   work, which counts the links of its documents and reports a spanning forest of them. So all
   links within a component count, whether or not their documents share a prefix, and no list
   of pairs is ever made.
4. The components of the spanning links are the classes.

Defined cases: null is empty; documents without words have no shingle and no link, and each is
a class of its own; documents of one to four words are one shingle; a repeated id is a document
of its own; an empty table gives an empty one; other columns are carried along.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.llm.common import components, lean, mix, packed, read, stage, text_of, with_columns_of, word_hashes

WORDS = 5
THRESHOLD = 0.8
TREES = 40
DEPTH = 8
TARGET_RECALL = 0.99999
#: Shingles and documents of a chunk of a component, on average; a larger document is a chunk of its own.
CHUNK_SHINGLES, CHUNK_DOCUMENTS = 60_000, 500
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct numbers of the text's shingles; all words, if they are fewer than one shingle's."""
    h = word_hashes(text)
    if not len(h):
        return h
    size = min(words, len(h))
    n = len(h) - size + 1
    with np.errstate(over="ignore"):
        out = h[:n].copy()
        for i in range(1, size):
            out *= _STEP
            out += h[i : i + n]
        return np.unique(mix(out + np.uint64(size)))


def _multipliers(count: int) -> np.ndarray:
    return mix(np.arange(1, 2 * count + 1, dtype=np.uint64)).astype(np.uint32).reshape(2, count) | np.uint32(1)


def signature_keys(found: np.ndarray, multipliers: np.ndarray, trees: int) -> np.ndarray:
    """A key per tree: its MinHash values, eight bits each, the first in the highest bits."""
    low, high = found.astype(np.uint32), (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(multipliers.shape[1], 0xFFFFFFFF, np.uint32)
    with np.errstate(over="ignore"):
        for at in range(0, len(found), 256):
            x = low[at : at + 256, None] * multipliers[0]
            x ^= x >> np.uint32(15)
            x += high[at : at + 256, None] * multipliers[1]
            np.minimum(least, x.min(axis=0), out=least)
    values = (mix(least.astype(np.uint64)) & np.uint64(255)).reshape(trees, -1)
    keys = np.zeros(trees, np.uint64)
    for i in range(values.shape[1]):
        keys = (keys << np.uint64(8)) | values[:, i]
    return keys.view(np.int64)


def prefix_length(threshold: float, trees: int, depth: int, target: float) -> int:
    """The longest prefix at which a pair at the threshold meets in some tree with the target recall."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < target:
        depth -= 1
    return depth


def _signed(text_column: str, words: int, trees: int, depth: int):
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        multipliers = _multipliers(trees * depth)
        for batch in batches:
            rids, digests, sizes, keys = [], [], [], []
            for text in text_of(batch.column(0), text_column):
                found = shingles(text, words)
                rids.append(number)
                number += 1
                sizes.append(len(found))
                digests.append(hashlib.sha256(found.tobytes()).digest()[:16] if len(found) else None)
                keys.append(signature_keys(found, multipliers, trees).tolist() if len(found) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rids, pa.int64()), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                names=["row", "rid", "digest", "size", "keys"],
            )

    return run


def _with_shingles(words: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            n = batch.num_columns - 1
            step = 256
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                sets = [shingles(t, words).tobytes() for t in text_of(part.column(n))]
                yield pa.RecordBatch.from_arrays([*part.columns[:n], pa.array(sets, pa.binary())], names=[*part.schema.names[:n], "shingles"])

    return run


def _overlaps(sets: list[np.ndarray], split: int) -> np.ndarray:
    """Sizes of the intersections of the first `split` sets with all sets."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    first = np.concatenate([[True], flat[1:] != flat[:-1]])
    column = np.cumsum(first) - 1
    shared = np.bincount(column) > 1
    keep = shared[column]
    owner, column = owner[keep], (np.cumsum(shared) - 1)[column[keep]]
    out = np.zeros((split, len(sets)), np.float32)
    width = 4096
    bounds = np.searchsorted(column, np.arange(0, int(shared.sum()) + width, width))
    for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        grid = np.zeros((len(sets), width), np.float32)
        grid[owner[a:b], column[a:b] - k * width] = 1
        out += grid[:split] @ grid.T
    return out


def _chunk_links(threshold: float):
    """For sorted (comp, i, j) pieces: per document its links, weighted by copies, and a root it is linked to."""

    def piece(rows, within):
        rids = np.array([r[0] for r in rows], np.int64)
        copies = np.array([r[1] for r in rows], np.int64)
        first = np.array([r[2] for r in rows], bool)
        sets = [np.frombuffer(r[3], np.uint64) for r in rows]
        order = np.argsort(~first, kind="stable")
        rids, copies, first, sets = rids[order], copies[order], first[order], [sets[i] for i in order]
        split = int(first.sum())
        sizes = np.array([len(s) for s in sets], np.float64)
        both = _overlaps(sets, split)
        # Of two chunks the pairs across count (none if one is empty); of one chunk with itself all pairs.
        linked = np.zeros((len(sets), len(sets)), bool)
        near = both >= threshold * (sizes[:split, None] + sizes[None, :] - both) - 1e-6
        linked[:split] = near
        if not within:
            linked[:split, :split] = False
        linked |= linked.T
        np.fill_diagonal(linked, False)
        links = linked @ copies
        root = np.arange(len(sets))
        while True:  # smallest label among linked documents, until nothing changes
            least = np.where(linked, root[None, :], len(sets)).min(axis=1)
            new = np.minimum(root, least)
            new = new[new]
            if (new == root).all():
                break
            root = new
        return [(int(a), int(n), int(b)) for a, n, b in zip(rids, links, rids[root], strict=True) if n]

    def run(batches):
        import pyarrow as pa

        def rows():
            for batch in batches:
                yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)

        out = []

        def batch_of(found):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["rid", "links", "root"])

        for (_, i, j), members in groupby(rows(), key=lambda r: r[:3]):
            out += piece([r[3:] for r in members], i == j)
            if len(out) > 20_000:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    return run


def linked_rows(docs: DataFrame, text_column: str = "text", id_column: str = "doc_id", words: int = WORDS, threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, target: float = TARGET_RECALL, chunk: int = CHUNK_SHINGLES) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): rows (row, rid, ...) stored; classes (rid, root, links, first) of the linked and copied ones.

    root names a class; first is the rid of the row that stands for the class: most shingles,
    then smallest id, then first stored.
    """
    schema = with_columns_of(docs, ("rid", "long"), ("digest", "binary"), ("size", "long"), ("keys", "array<long>"))
    rows = stage(packed(docs).mapInArrow(lean(_signed(text_column, words, trees, depth)), schema), "signed-rows")
    seen = rows.where("size > 0")
    # One representative per distinct set: its smallest rid.
    sets = stage(seen.groupBy("digest").agg(F.min("rid").alias("rep"), F.count("*").alias("copies"), F.min("size").alias("size")), "sets")
    shift = 8 * (depth - prefix_length(threshold, trees, depth, target))
    tries = (
        seen.join(sets.select(F.col("rep").alias("rid")), "rid", "left_semi")
        .select("rid", F.posexplode("keys").alias("tree", "key"))
        .select("rid", "tree", F.shiftrightunsigned("key", shift).alias("prefix"))
    )
    # Stored, as below, so that the join has two plain shuffles and Spark can split a large one.
    shared = stage(tries.groupBy("tree", "prefix").agg(F.min("rid").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n"), "shared")
    edges = tries.join(shared, ["tree", "prefix"]).select("a", F.col("rid").alias("b"))
    near = components(edges, "candidates")
    members = near.select(F.col("id").alias("rep"), F.col("root").alias("comp")).join(sets, "rep")
    members = stage(members.select("rep", "comp", "copies", "size"), "members")
    weight = members.groupBy("comp").agg(F.greatest(F.ceil(F.sum("size") / chunk), F.ceil(F.count("*") / CHUNK_DOCUMENTS)).cast("int").alias("chunks"))
    texts = rows.select("rid", F.col(f"row.`{text_column}`").alias("text"))
    # Candidates may be a large share of all documents: shuffled at any size, never broadcast.
    facts = members.join(weight, "comp").join(texts.hint("merge"), members["rep"] == texts["rid"])
    facts = facts.select("comp", "rep", "copies", "chunks", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int").alias("own"), "text")
    sized = facts.mapInArrow(lean(_with_shingles(words)), "comp long, rep long, copies long, chunks int, own int, shingles binary")
    pieces = sized.select("*", F.explode(F.expr("sequence(0, chunks - 1)")).alias("other")).select(
        "comp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "rep", "copies", (F.col("own") <= F.col("other")).alias("first"), "shingles"
    )
    pieces = pieces.repartition(F.col("comp"), F.col("i"), F.col("j")).sortWithinPartitions("comp", "i", "j")
    links = stage(pieces.mapInArrow(lean(_chunk_links(threshold)), "rid long, links long, root long"), "links")
    joined = components(links.select(F.col("rid").alias("a"), F.col("root").alias("b")), "classes")
    degree = links.groupBy("rid").agg(F.sum("links").alias("links"))
    of_sets = (
        sets.join(joined.withColumnRenamed("id", "rep"), "rep", "left")
        .join(degree.withColumnRenamed("rid", "rep"), "rep", "left")
        .where("root is not null or copies > 1")
        .select("digest", F.coalesce("root", "rep").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    )
    grouped = stage(seen.select("rid", "digest", "size", F.col(f"row.`{id_column}`").alias("id")).join(of_sets, "digest"), "grouped")
    best = F.min(F.struct((-F.col("size")).alias("fewer"), F.col("id").isNull().alias("without"), "id", "rid"))
    heads = stage(grouped.groupBy("root").agg(best.alias("best"), F.min("id").alias("class_id")), "heads")
    classes = grouped.join(heads, "root").select("rid", "id", "class_id", "links", (F.col("best.rid") == F.col("rid")).alias("first"))
    return rows, classes


def near_classes(docs: DataFrame, text_column: str = "text", id_column: str = "doc_id", **options) -> DataFrame:
    """One row per row of docs: its id, class_id (smallest id of its class) and n_links (other documents at or above the threshold, copies included)."""
    rows, classes = linked_rows(docs.select(id_column, text_column), text_column, id_column, **options)
    own = rows.select("rid", F.col(f"row.`{id_column}`").alias(id_column))
    return own.join(classes.select("rid", "class_id", "links"), "rid", "left").select(
        id_column, F.coalesce("class_id", id_column).alias("class_id"), F.coalesce("links", F.lit(0)).alias("n_links")
    )


def drop_near_copies(docs: DataFrame, text_column: str = "text", id_column: str = "doc_id", **options) -> DataFrame:
    """The rows of docs that have no near copy, and one row of each class."""
    rows, classes = linked_rows(docs, text_column, id_column, **options)
    gone = stage(classes.where("not first").select("rid"), "near-copies")
    return rows.join(gone, "rid", "left_anti").select("row.*")


def op4_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(read(spark, sf_dir, "documents", "doc_id", "text"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OP4_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + {WORDS - 1}), ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {WORDS - 1}, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE c >= {THRESHOLD} * (x.n + y.n - c) - 1e-6),
reach AS (SELECT a AS doc_id, a AS other FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
cls AS (SELECT doc_id, min(other) AS class_id FROM reach GROUP BY doc_id),
deg AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(n_links, 0)::BIGINT AS n_links
FROM documents LEFT JOIN cls USING (doc_id) LEFT JOIN deg USING (doc_id)
"""
