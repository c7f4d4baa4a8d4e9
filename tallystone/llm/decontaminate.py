"""Benchmark decontamination.

The benchmark's word windows become a hash set that is broadcast; each document is scanned
window by window in its own task, every hash hit is verified word for word, and what is hit is
reported or removed. Documents are never shuffled.

The broadcast is bounded: a benchmark of more than max_slice_bytes of text is split by item into
slices of at most that size, and the documents pass through one scan per slice in the same tasks.

Words: A-Z lower-cased, then runs of 0-9, a-z and non-ASCII characters. A window is ten
consecutive words of an item; an item of one to nine words is one window. Defined cases: null or
wordless texts are clean, null or wordless items match nothing, items that repeat an id count
once, a null item id is the empty string, empty tables give empty or clean results, other
columns are carried along.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.llm.common import WORD_TABLE, lean, mix, packed, read, text_of, with_columns_of, word_hashes

WINDOW = 10
MAX_SLICE_BYTES = 16 << 20
_FILTER_BITS = 20
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


def _window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """One number per window of that many words."""
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out = words[:n].copy()
        for i in range(1, length):
            out *= _STEP
            out += words[i : i + n]
    return mix(out)


class _Windows:
    """The benchmark's windows by length: a bit filter, and for each hash the words and items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        exact: dict[int, dict[int, dict[bytes, set[str]]]] = defaultdict(lambda: defaultdict(lambda: defaultdict(set)))
        for item, text in items:
            words = text.translate(WORD_TABLE).split()
            length = min(window, len(words))
            if length:
                for i, h in enumerate(_window_hashes(word_hashes(text), length).tolist()):
                    exact[length][h][b" ".join(words[i : i + length])].add(item)
        self.exact = {n: {h: dict(found) for h, found in by.items()} for n, by in exact.items()}
        self.filters = {}
        for n, by in self.exact.items():
            self.filters[n] = np.zeros(1 << _FILTER_BITS, bool)
            self.filters[n][np.fromiter(by, np.uint64, len(by)) >> np.uint64(64 - _FILTER_BITS)] = True

    def scan(self, text: bytes, words: np.ndarray) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of hit words (first, end), merged, and the items they come from."""
        starts, items, split = [], set(), None
        for n, passes in self.filters.items():
            hashes = _window_hashes(words, n)
            for i in np.flatnonzero(passes[hashes >> np.uint64(64 - _FILTER_BITS)]).tolist():
                found = self.exact[n].get(int(hashes[i]))
                if found:
                    split = text.translate(WORD_TABLE).split() if split is None else split
                    of = found.get(b" ".join(split[i : i + n]))
                    if of:
                        starts.append((i, i + n))
                        items |= of
        return merged(starts), items


_built: list[tuple[list, int, _Windows]] = []


def _windows_of(shared, window: int) -> _Windows:
    """The windows of a broadcast benchmark, built once in each worker."""
    items = shared.value
    if not _built or _built[0][0] is not items or _built[0][1] != window:
        _built[:] = [(items, window, _Windows(items, window))]
    return _built[0][2]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def without_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    if not spans:
        return text
    inside = np.frombuffer(text.translate(WORD_TABLE), np.uint8) != 32
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    out, at = [], 0
    for first, end in spans:
        out.append(text[at : starts[first]])
        at = int(ends[end - 1])
    return b"".join([*out, text[at:]])


def _slices(benchmark: DataFrame, item_column: str, text_column: str, max_bytes: int):
    """The items, as lists of at most max_bytes of text (or a single item)."""
    size = F.octet_length(F.coalesce(F.col(text_column), F.lit("")))
    total = benchmark.agg(F.sum(size)).first()[0] or 0
    parts = max(1, 2 * -(-total // max_bytes)) if total > max_bytes else 1
    for k in range(parts):
        rows = benchmark.where(F.pmod(F.xxhash64(item_column, text_column), F.lit(parts)) == k)
        held, used = [], 0
        for item, text in rows.select(F.coalesce(F.col(item_column).cast("string"), F.lit("")), text_column).toLocalIterator():
            raw = (text or "").encode()
            if held and used + len(raw) > max_bytes:
                yield held
                held, used = [], 0
            held.append((item, raw))
            used += len(raw)
        if held:
            yield held


def scan(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id", window: int = WINDOW, max_slice_bytes: int = MAX_SLICE_BYTES) -> DataFrame:
    """(row, n_words, spans, items): hit word spans, merged, and sorted ids of the items found."""
    context = docs.sparkSession.sparkContext
    schema = with_columns_of(docs, ("n_words", "long"), ("spans", "array<struct<first:int,end:int>>"), ("items", "array<string>"))

    def scanner(shared, more: bool):
        def run(batches):
            import pyarrow as pa

            windows = _windows_of(shared, window)
            for batch in batches:
                counts, spans, items = [], [], []
                before = [[(x["first"], x["end"]) for x in r] for r in batch.column(2).to_pylist()] if more else None
                earlier = batch.column(3).to_pylist() if more else None
                for i, text in enumerate(text_of(batch.column(0), text_column)):
                    words = word_hashes(text)
                    found, of = windows.scan(text, words)
                    if more:
                        found, of = merged(found + before[i]), of | set(earlier[i])
                    counts.append(len(words))
                    spans.append([{"first": a, "end": b} for a, b in found])
                    items.append(sorted(of))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(counts, pa.int64()),
                        pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))),
                        pa.array(items, pa.list_(pa.string())),
                    ],
                    names=["row", "n_words", "spans", "items"],
                )

        return run

    out, more = packed(docs), False
    for held in _slices(benchmark, item_column, text_column, max_slice_bytes):
        out, more = out.mapInArrow(lean(scanner(context.broadcast(held), more)), schema), True
    return out if more else out.mapInArrow(lean(scanner(context.broadcast([]), False)), schema)


def report(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """Per document: its words, hit words, items found and whether it is contaminated."""
    found = scan(docs.select(id_column, text_column), benchmark, text_column, **options)
    n_hit = F.expr("aggregate(spans, 0L, (n, s) -> n + (s.end - s.first))")
    return found.select(
        F.col(f"row.`{id_column}`").alias(id_column),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """The clean rows of docs."""
    return scan(docs, benchmark, text_column, **options).where(F.size("spans") == 0).select("row.*")


def cut_contaminated(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """All rows of docs, with the hit words cut from the text."""
    found = scan(docs, benchmark, text_column, **options)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            spans = [[(x["first"], x["end"]) for x in r] for r in batch.column(2).to_pylist()]
            texts = [without_words(t, s).decode() for t, s in zip(text_of(batch.column(0), text_column), spans, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "cut"])

    cut = found.mapInArrow(lean(run), with_columns_of(docs, ("cut", "string")))
    null = F.col(f"row.`{text_column}`").isNull()
    return cut.select(*[(F.when(~null, F.col("cut")) if c == text_column else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP10_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(len(w), {WINDOW}) AS n, array_to_string(list_slice(w, i, i + least(len(w), {WINDOW}) - 1), ' ') AS k
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW}, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS i FROM d, lens)),
hits AS (SELECT doc_id, n, i, item FROM dw JOIN bw USING (n, k)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""
