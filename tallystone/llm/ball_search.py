"""Ranked lexical search: the documents with the highest integer scores for each query.

A document is a sparse vector of integer impacts, one per term that any query asks for; a query is a
vector of integer weights; the score is their inner product. Every task packs its documents into ball
trees. A ball has a centroid and a radius, and by Cauchy and Schwarz no document inside scores more than
<query, centroid> + |query| * radius. Balls are visited best bound first, and the search of a tree ends
when the best bound left is below the score that the query's k-th hit has reached in this task. At the
leaves documents are scored exactly, in 64-bit integers.

Two things make the bounds useful. Terms are scaled by the square roots of their weights, so that rare
words count in the geometry as they do in the score. And the radius is kept by group of terms (Cauchy
and Schwarz holds for each group, and the sum over the groups bounds the product): the most common
terms are groups alone, the others are dealt out by the query that asks for them first. A German
document then adds nothing to the radius that an English query sees. Rounding is safe: radii and bounds
are widened by more than floating-point sums can lose, and only a bound below the k-th score cuts.

Three passes: terms, counted and stored per document (the text is read once); document frequencies of
the queries' terms; trees. Only each task's k best per query are shuffled.

What bounds memory: queries go through the driver in blocks of at most max_query_bytes of text, each
block a search of its own; trees of at most TREE documents and ENTRIES terms; texts in pieces.

Defined cases: terms are maximal runs of 0-9, a-z (A-Z lower-cased) and non-ASCII characters. Null or
termless documents are not counted and never found, termless queries find nothing, rows that repeat
a query id are one query together, a null query id is an id, repeated documents are documents of their
own, equal scores go by ascending document id (null last), empty tables give empty results, other
columns don't matter.
"""

from __future__ import annotations

import heapq
import math
from bisect import insort
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tallystone.llm.common import WORD_TABLE, lean, packed, read, stage, text_of, with_columns_of
from tallystone.llm.words import pieces

K = 20
LEAF, TREE, ENTRIES = 32, 4096, 1 << 21
MAX_QUERY_BYTES = 4 << 20
#: Groups of terms: the most common ones alone, the others dealt out by their first query.
ALONE, OWN = 256, 128
#: More than a sum of some million rounded numbers can be off, in relation to its size.
SLACK = 1e-8


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Integer impact of each occurrence count tf in a document of n terms."""
    length = 100 - 25 + (25 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 12 * length)


class Queries:
    """A block of queries: integer weights, scaled vectors, and the groups of their terms."""

    def __init__(self, terms: list[Counter], vocabulary: dict[bytes, int], df: np.ndarray, n_docs: int):
        size = len(vocabulary)
        w = np.array([weight(n_docs, int(x)) for x in df], np.int64) if size else np.empty(0, np.int64)
        self.scale = np.sqrt(w.astype(np.float64))
        self.group = np.full(size, -1, np.int64)
        common = np.argsort(-df, kind="stable")[:ALONE]
        self.group[common] = np.arange(len(common))
        self.ids, self.weights = [], []
        for i, found in enumerate(terms):
            ids = np.array(sorted(vocabulary[t] for t in found), np.int64)
            by = {vocabulary[t]: c for t, c in found.items()}
            counts = np.array([by[x] for x in ids.tolist()], np.int64)
            fresh = ids[self.group[ids] < 0] if len(ids) else ids
            self.group[fresh] = ALONE + i % OWN
            self.ids.append(ids)
            self.weights.append(counts * w[ids] if len(ids) else counts)
        self.counts = [np.divide(x, np.maximum(w[i], 1)) for i, x in zip(self.ids, self.weights, strict=True)]

    def __len__(self) -> int:
        return len(self.ids)

    def scaled(self, i: int) -> np.ndarray:
        return self.counts[i] * self.scale[self.ids[i]]


class Best:
    """The k best (score, id) of one query so far; of equal scores the smaller id is better, null last."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    @property
    def least(self) -> int:
        """What a document must score to matter."""
        return -self.rows[-1][0] if len(self.rows) == self.k else 1

    def add(self, score: int, key) -> None:
        insort(self.rows, (-score, key is None, 0 if key is None else key))
        del self.rows[self.k :]


class BallTree:
    """Balls around the documents [lo, hi) of one chunk, halved down to leaves."""

    def __init__(self, starts: np.ndarray, terms: np.ndarray, impact: np.ndarray, queries: Queries, leaf: int = LEAF):
        self.queries, self.leaf = queries, leaf
        self.group, self.groups = queries.group, ALONE + OWN
        x = impact * queries.scale[terms]
        order = np.arange(len(starts) - 1)
        self._dense = np.zeros(len(queries.scale))
        self.balls: list[tuple] = []
        self.order = order
        self._grow(starts, terms, x)
        # In the order of the leaves, so that a leaf is a slice.
        lengths = np.diff(starts)[self.order]
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        take = np.arange(self.starts[-1]) + np.repeat(starts[:-1][self.order] - self.starts[:-1], lengths)
        self.terms, self.impact = terms[take], impact[take]

    def _grow(self, starts, terms, x) -> None:
        """Nodes in self.balls: (lo, hi, centroid ids, centroid values, radius by group, children)."""
        todo = [(0, len(self.order), None, 0)]
        while todo:
            lo, hi, parent, side = todo.pop()
            docs = self.order[lo:hi]
            lengths = starts[docs + 1] - starts[docs]
            first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            at = np.arange(lengths.sum()) + np.repeat(starts[docs] - first, lengths)
            of, val = terms[at], x[at]
            row = np.repeat(np.arange(hi - lo), lengths)
            dense = self._dense
            np.add.at(dense, of, val / (hi - lo)) if len(of) < 4096 else dense.__iadd__(np.bincount(of, val, len(dense)) / (hi - lo))
            ids = np.flatnonzero(dense)
            center = dense[ids].copy()
            by = row * self.groups + self.group[of]
            size = (hi - lo) * self.groups
            squares = np.bincount(by, val * val, size).reshape(-1, self.groups)
            dots = np.bincount(by, val * dense[of], size).reshape(-1, self.groups)
            own = np.bincount(self.group[ids], center * center, self.groups)
            off = squares - 2 * dots + own
            radius = np.sqrt(np.maximum(off + SLACK * (squares + own), 0).max(axis=0))
            dense[ids] = 0
            node = len(self.balls)
            self.balls.append([lo, hi, ids, center, radius, None])
            if parent is not None:
                self.balls[parent][5][side] = node
            if hi - lo <= self.leaf:
                continue
            # Along the line from one outlying document to the one farthest from it, cut in the middle.
            far = int(off.sum(axis=1).argmax())
            for sign in (1.0, -1.0):
                mine = slice(first[far], first[far] + lengths[far])
                dense[of[mine]] += sign * val[mine]
                if sign > 0:
                    gap = squares.sum(axis=1) - 2 * np.bincount(row, val * dense[of], hi - lo)
                    far = int(gap.argmax())
            along = np.bincount(row, val * dense[of], hi - lo)
            dense[:] = 0
            self.order[lo:hi] = docs[np.argsort(along, kind="stable")]
            middle = (lo + hi) // 2
            self.balls[node][5] = [None, None]
            todo += [(lo, middle, node, 0), (middle, hi, node, 1)]

    def search(self, i: int, best: Best, keys: list) -> int:
        """Bring the query's hits among this tree's documents into best; returns the documents scored."""
        ids, scored = self.queries.ids[i], 0
        if not len(ids) or not len(self.order):
            return 0
        q = self._dense
        q[ids] = self.queries.scaled(i)
        by_group = np.sqrt(np.bincount(self.group[ids], q[ids] ** 2, self.groups))
        weights = np.zeros(len(q), np.int64)
        weights[ids] = self.queries.weights[i]

        def bound(node: int) -> float:
            _, _, of, center, radius, _ = self.balls[node]
            return (float(q[of] @ center) + float(by_group @ radius)) * (1 + SLACK) + 1

        heap = [(-bound(0), 0)]
        while heap and -heap[0][0] >= best.least:
            node = heapq.heappop(heap)[1]
            lo, hi, _, _, _, children = self.balls[node]
            if children:
                for child in children:
                    limit = bound(child)
                    if limit >= best.least:
                        heapq.heappush(heap, (-limit, child))
                continue
            a, b = self.starts[lo], self.starts[hi]
            scores = np.add.reduceat(weights[self.terms[a:b]] * self.impact[a:b], self.starts[lo:hi] - a)
            scored += hi - lo
            for j in np.flatnonzero(scores >= best.least).tolist():
                if scores[j] >= best.least:
                    best.add(int(scores[j]), keys[self.order[lo + j]])
        q[ids] = 0
        return scored


def term_counts(text: bytes, vocabulary: dict[bytes, int]) -> tuple[int, dict[int, int]]:
    """All terms of a text, with repeats, and the counts of those in the vocabulary."""
    n, found = 0, {}
    for piece in pieces(text.translate(WORD_TABLE), b" "):
        counts = Counter(piece.split())
        n += counts.total()
        for word in counts.keys() & vocabulary.keys():
            key = vocabulary[word]
            found[key] = found.get(key, 0) + counts[word]
    return n, found


def _vectors(docs: DataFrame, text_column: str, shared) -> DataFrame:
    """(row, n, terms, tfs) of the documents with a term; terms are places in the vocabulary."""

    def run(batches):
        import pyarrow as pa

        vocabulary = shared.value
        for batch in batches:
            keep, sizes, terms, tfs = [], [], [], []
            for i, text in enumerate(text_of(batch.column(0), text_column)):
                n, found = term_counts(text, vocabulary)
                if n:
                    keep.append(i)
                    sizes.append(n)
                    terms.append(sorted(found))
                    tfs.append([found[t] for t in terms[-1]])
            rows = batch.column(0)
            rows = pa.StructArray.from_arrays([rows.field(0)], fields=[rows.type.field(0)])
            yield pa.RecordBatch.from_arrays(
                [rows.take(pa.array(keep, pa.int64())), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                names=["row", "n", "terms", "tfs"],
            )

    key = docs.select([c for c in docs.columns if c != text_column][0])
    return packed(docs).mapInArrow(lean(run), with_columns_of(key, ("n", "long"), ("terms", "array<int>"), ("tfs", "array<long>")))


def _chunks(batches):
    """(keys, starts, terms, tfs, n) of at most TREE documents and about ENTRIES terms each."""
    for batch in batches:
        lists = batch.column(2)
        starts = lists.offsets.to_numpy().astype(np.int64)
        terms, tfs = lists.values.to_numpy().astype(np.int64), batch.column(3).values.to_numpy()
        n = batch.column(1).to_numpy()
        key, lo = batch.column(0).field(0), 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + ENTRIES, "right")) - 1)
            hi = min(hi, lo + TREE, batch.num_rows)
            own = np.flatnonzero(np.diff(starts[lo : hi + 1])) + lo
            if len(own):
                a, b = starts[lo], starts[hi]
                yield key.take(own).to_pylist(), np.append(starts[own], b) - a, terms[a:b], tfs[a:b], n[own]
            lo = hi


def _search_block(docs: DataFrame, text_column: str, block: list[tuple[object, bytes]], item_field: StructField, k: int) -> DataFrame:
    spark = docs.sparkSession
    context = spark.sparkContext
    by_item: dict[object, Counter] = {}
    for item, text in block:
        by_item.setdefault(item, Counter()).update(text.translate(WORD_TABLE).split())
    items, terms = list(by_item), list(by_item.values())
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*terms)))}
    shared = context.broadcast(vocabulary)
    vectors = stage(_vectors(docs, text_column, shared), "search-vectors")
    shared.destroy()
    n_docs, n_terms = vectors.agg(F.count("*"), F.sum("n")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for t, count in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row a term of the block
        df[t] = count
    asked = context.broadcast((Queries(terms, vocabulary, df, n_docs), n_docs, n_terms or 1))
    key_field = vectors.schema["row"].dataType.fields[0]

    def run(batches):
        import pyarrow as pa

        queries, n_docs, n_terms = asked.value
        best, kind = [Best(k) for _ in range(len(queries))], None
        for batch in batches:
            kind = batch.column(0).type.field(0)
            for keys, starts, terms, tfs, n in _chunks([batch]):
                tree = BallTree(starts, terms, impacts(tfs, np.repeat(n, np.diff(starts)), n_docs, n_terms), queries)
                for i in range(len(queries)):
                    tree.search(i, best[i], keys)
        rows = [(i, -s, None if null else key) for i, b in enumerate(best) for s, null, key in b.rows]
        if rows:
            found, scores, keys = zip(*rows, strict=True)
            ids = pa.StructArray.from_arrays([pa.array(keys, kind.type)], fields=[kind])
            yield pa.RecordBatch.from_arrays([ids, pa.array(found, pa.int32()), pa.array(scores, pa.int64())], names=["row", "item", "score"])

    hits = vectors.mapInArrow(lean(run), StructType([vectors.schema["row"], StructField("item", IntegerType()), StructField("score", LongType())]))
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.expr(f"row.`{key_field.name}`").asc_nulls_last())
    ranked = hits.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    names = spark.createDataFrame(list(enumerate(items)), StructType([StructField("item", IntegerType()), StructField("name", item_field.dataType)]))
    out = stage(ranked.join(F.broadcast(names), "item").select(F.col("name").alias(item_field.name), "rank", F.col("row.*"), "score"), "search-hits")
    asked.destroy()
    return out


def search(docs: DataFrame, queries: DataFrame, k: int = K, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text", max_query_bytes: int = MAX_QUERY_BYTES) -> DataFrame:
    """(item id, rank, document id, score): the k best documents of each query, best first."""
    spark = docs.sparkSession
    asked = queries.select(F.col(f"`{item_column}`").alias("item"), F.coalesce(F.col(f"`{item_text}`"), F.lit("")).alias("text"))
    field = StructField(item_column, asked.schema["item"].dataType)
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * total // max_query_bytes)) if total > max_query_bytes else 1
    found = None
    for b in range(blocks):
        rows = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b)
        block = [(r["item"], r["text"].encode()) for r in rows.toLocalIterator()]
        if block:
            part = _search_block(docs.select(f"`{id_column}`", f"`{text_column}`"), text_column, block, field, k)
            found = part if found is None else found.unionAll(part)
    if found is None:
        kind = docs.schema[id_column]
        found = spark.createDataFrame([], StructType([field, StructField("rank", IntegerType()), StructField(id_column, kind.dataType), StructField("score", LongType())]))
    return found


def op11_ball_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS w FROM documents),
size AS (SELECT rid, doc_id, len(w)::BIGINT AS n FROM d WHERE len(w) > 0),
total AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS nt FROM size),
tf AS (SELECT rid, t, count(*)::BIGINT AS tf FROM (SELECT rid, unnest(w) AS t FROM d) GROUP BY ALL),
asked AS (SELECT item_id, t, count(*)::BIGINT AS times FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark) GROUP BY ALL),
weights AS (SELECT t, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY t, nd),
scores AS (
  SELECT item_id, rid, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * nd) // nt))))::BIGINT AS score
  FROM asked JOIN tf USING (t) JOIN weights USING (t) JOIN size USING (rid), total GROUP BY ALL)
SELECT item_id, rank, doc_id, score
FROM (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM scores WHERE score > 0)
WHERE rank <= {K}
"""
