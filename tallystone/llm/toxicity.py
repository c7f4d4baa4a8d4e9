"""Toxicity by class-conditional Kneser-Ney models.

Two models of the letters of words, one learnt from toxic and one from ordinary documents. The
probability of a byte after its context (up to five bytes, from the word's start) is an
interpolated Kneser-Ney estimate: at the longest context the class has counts of its own, less a
discount, and below it both classes share one model with continuation counts. So what is rare in
one class falls back on what both know and is no evidence, and a form never seen is judged by the
stem it shares with seen ones.

A word's evidence is the difference of its log-likelihoods. A document is judged by its
length-normalised difference, as a whole and in its most toxic passages of the lengths in
`passages`; a logistic function of these makes the score. It is fitted crosswise: the sample's halves are
judged by models that have counted the other half only.

The classifier is fitted on about `sample` labelled documents, toxic and ordinary ones (all, if
there are fewer), chosen by a hash of the id; this bounds the tables that are broadcast. Counting is a Spark aggregation. Scoring is
one scan without a shuffle, over whole texts.

Defined cases: null is empty; a text without words has no evidence: zero in all features;
without labelled rows of both classes every score is 0; of repeated or contradicting labels the
toxic one counts, null labels and ids don't; other columns are carried along.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.llm.common import WORD_TABLE, about, fold, lean, packed, read, text_of, with_columns_of

#: Labelled toxic and ordinary documents to learn from.
SAMPLE = (2_500, 5_000)
THRESHOLD = 0.7
PASSAGES = (1, 4, 16)
ORDER = 6
#: What is taken off the counts of the shared model, and of a class's own: so grams seen once, or
#: at most twice in a class, leave nothing to keep but their contexts' share for the backoff.
DISCOUNT, OWN_DISCOUNT = 1.0, 2.0
_BYTES = np.uint64((1 << 56) - 1)
#: Words whose evidence a task remembers.
_CACHE = 300_000


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_TABLE).split()


def grams_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each byte of each word (closed by a blank): word number, the packed last 8 bytes, bytes of history.

    History starts with the blank before the word; the byte itself is the lowest of the packed ones.
    """
    joined = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    blank = joined == 32
    packed_bytes = np.zeros(len(joined), np.uint64)
    for back in range(ORDER):
        packed_bytes[back:] |= joined[: len(joined) - back].astype(np.uint64) << np.uint64(8 * back)
    last = np.where(blank, np.arange(len(joined)), 0)
    last = np.maximum.accumulate(last)
    history = np.empty(len(joined), np.int64)
    history[1:] = np.arange(1, len(joined)) - last[:-1]
    history[0] = 0
    number = np.cumsum(blank) - 1
    number = np.where(blank, number - 1, number)
    return number[1:], packed_bytes[1:], np.minimum(history[1:], ORDER - 1)


def key_of(packed_bytes: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """The last `length` bytes with their number in the top byte."""
    length = np.asarray(length, np.uint64)
    mask = (np.uint64(1) << (length * np.uint64(8))) - np.uint64(1)
    return (packed_bytes & mask) | (length << np.uint64(56))


class _Table:
    """Sorted keys with a column of values per class, and the value of keys that are missing."""

    def __init__(self, keys: np.ndarray, values: list[np.ndarray], missing: float):
        self.keys, self.values, self.missing = keys, np.array(values, np.float32), missing

    def of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full((len(self.values), len(keys)), self.missing, np.float32)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[:, at], np.float32(self.missing))


def _context(keys: np.ndarray) -> np.ndarray:
    """Keys without their last byte; the number in the top byte is kept."""
    return ((keys & _BYTES) >> np.uint64(8)) | (keys & ~_BYTES)


def _discounted(keys: np.ndarray, columns: list[np.ndarray], discount: float) -> tuple[_Table, _Table]:
    """What each key keeps of its context's mass after the discount, and what each context gives to the backoff."""
    contexts, of = np.unique(_context(keys), return_inverse=True)
    kept, left = [], []
    for c in columns:
        total = np.maximum(np.bincount(of, c, len(contexts)), 1e-9)
        kept.append(np.maximum(c - discount, 0) / total[of])
        left.append(np.where(total > 0.5, 1 - np.bincount(of, kept[-1], len(contexts)), 1))
    # What a missing key stands for need not be kept; rare grams are most of all.
    some, given = np.any(kept, axis=0), np.any(np.array(left) < 1, axis=0)
    return _Table(keys[some], [k[some] for k in kept], 0), _Table(contexts[given], [x[given] for x in left], 1)


class Model:
    """Shared Kneser-Ney tables of packed grams, and the two classes' own tables above them."""

    def __init__(self, keys: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray, order: int = ORDER, discount: float = DISCOUNT, own_discount: float = OWN_DISCOUNT):
        by_key = np.argsort(keys)
        keys, toxic, ordinary = keys[by_key], toxic[by_key], ordinary[by_key]
        lengths = (keys >> np.uint64(56)).astype(int)
        grams = keys & _BYTES
        # A gram from the start of a word has no longer context: its own count is the count to use.
        whole = (lengths == order) | ((grams >> (np.uint64(8) * (lengths - 1).astype(np.uint64))) == 32)
        self.shared = []
        for n in range(1, order + 1):
            mine = lengths == n
            count = np.where(whole[mine], toxic[mine] + ordinary[mine], 0).astype(float)
            if n < order:  # continuation counts: how many different longer grams end like this
                mask = (np.uint64(1) << np.uint64(8 * n)) - np.uint64(1)
                ends, times = np.unique(grams[lengths == n + 1] & mask, return_counts=True)
                at = np.searchsorted(grams[mine], ends)
                count[at] += np.where(whole[mine][at], 0, times)
            self.shared.append(_discounted(keys[mine], [count], discount))
        self.own = _discounted(keys[whole], [toxic[whole].astype(float), ordinary[whole].astype(float)], own_discount)

    def evidence(self, words: list[bytes]) -> np.ndarray:
        """log p(word | toxic) - log p(word | ordinary), for each word."""
        if not words:
            return np.zeros(0)
        number, packed_bytes, history = grams_of(words)
        p = np.full(len(number), 1 / 256)
        for n, (kept, left) in enumerate(self.shared, 1):
            on = history >= n - 1
            mine = key_of(packed_bytes[on], n)
            p[on] = kept.of(mine)[0] + left.of(_context(mine))[0] * p[on]
        kept, left = self.own
        mine = key_of(packed_bytes, history + 1)
        toxic, ordinary = kept.of(mine) + left.of(_context(mine)) * p
        return np.bincount(number, np.log(toxic + 1e-12) - np.log(ordinary + 1e-12), len(words))


class Scorer:
    """Features of documents, with the evidence of words already met kept at hand."""

    def __init__(self, model: Model, passages: tuple[int, ...]):
        self.model, self.passages, self.known = model, passages, {}

    def features(self, texts: list[bytes]) -> np.ndarray:
        split = [words_of(t) for t in texts]
        new: set[bytes] = set()
        for words in split:
            new.update(words)
        if len(self.known) > _CACHE:
            self.known = {}
        new.difference_update(self.known)
        fresh = sorted(new)
        for at in range(0, len(fresh), 20_000):
            part = fresh[at : at + 20_000]
            self.known.update(zip(part, self.model.evidence(part).tolist(), strict=True))
        out = np.zeros((len(texts), 1 + len(self.passages)))
        get = self.known.__getitem__
        for i, words in enumerate(split):
            if words:
                sums = np.concatenate([[0.0], np.cumsum(np.fromiter(map(get, words), float, len(words)))])
                out[i, 0] = sums[-1] / len(words)
                for k, size in enumerate(self.passages, 1):
                    size = min(size, len(words))
                    out[i, k] = (sums[size:] - sums[:-size]).max() / size
        return out


def _batches_of_texts(column, name: str):
    """Texts by some hundred at a time, so that few are held in more than one form."""
    import pyarrow.compute as pc

    if name:
        column = pc.struct_field(column, name)
    for at in range(0, len(column), 128):
        yield text_of(pc.utf8_lower(column.slice(at, 128)))


def _sampled(docs: DataFrame, labels: DataFrame, sample: tuple[int, int], divisor: int, held: int, id_column: str, text_column: str) -> tuple[DataFrame, dict[int, int]]:
    """(text, is_toxic, half) of the labelled rows to learn from, and how many of each label there are."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold("doc_id", divisor) != held))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("at", F.xxhash64("doc_id", F.lit(6)))
    totals = {int(r["toxic"]): r["n"] for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for value in (0, 1):
        part = usable.where((F.col("toxic") == value) & about(F.col("at"), sample[1 - value], totals.get(value, 0)))
        chosen = part if chosen is None else chosen.unionAll(part)
    chosen = chosen.select(F.col("doc_id").alias("chosen_id"), F.col("toxic").alias("is_toxic"), F.pmod(F.shiftright("at", 50), F.lit(2)).cast("int").alias("half"))
    # About as many rows as the sample's two numbers, of three small columns, however many labels there are.
    texts = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    return texts.join(F.broadcast(chosen), F.col("id") == F.col("chosen_id")).select("text", "is_toxic", "half"), totals


def _word_counts(batches):
    from collections import Counter

    import pyarrow as pa

    for batch in batches:
        counts, at = [Counter() for _ in range(4)], 0
        kind = [2 * h + t for t, h in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
        for texts in _batches_of_texts(batch.column(0), ""):
            for text in texts:
                counts[kind[at]].update(words_of(text))
                at += 1
        for k, found in enumerate(counts):
            n = pa.array(found.values(), pa.int64())
            none = pa.array(np.zeros(len(n), np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.binary()), pa.array(np.full(len(n), k // 2, np.int32)), n if k % 2 else none, none if k % 2 else n],
                names=["word", "half", "toxic", "ordinary"],
            )


def _gram_counts(batches):
    import pyarrow as pa

    for batch in batches:
        words, half = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        for h in (0, 1):
            mine = np.flatnonzero(half == h)
            if not len(mine):
                continue
            weights = [batch.column(c).to_numpy()[mine].astype(float) for c in (2, 3)]
            number, packed_bytes, history = grams_of([words[i] for i in mine.tolist()])
            for n in range(1, ORDER + 1):
                on = history >= n - 1
                keys, of = np.unique(key_of(packed_bytes[on], n), return_inverse=True)
                sums = [np.bincount(of, w[number[on]], len(keys)).astype(np.int64) for w in weights]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(np.full(len(keys), h, np.int32)), *map(pa.array, sums)], names=["gram", "half", "toxic", "ordinary"]
                )


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression by Newton steps, slightly held back; (means, scales, weights)."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hold = 1e-2 * np.eye(len(w))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + hold, z.T @ (p - y) + hold @ w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return mean, scale, w


def learn(docs: DataFrame, labels: DataFrame, sample: tuple[int, int] = SAMPLE, divisor: int = 3, held: int = 1, passages: tuple[int, ...] = PASSAGES, id_column: str = "doc_id", text_column: str = "text"):
    """(model, fit) as a broadcast value, or None without labelled rows of both classes."""
    spark = docs.sparkSession
    rows, totals = _sampled(docs, labels, sample, divisor, held, id_column, text_column)
    sums = [F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")]
    words = rows.select("text", "is_toxic", "half").mapInArrow(lean(_word_counts), "word binary, half int, toxic long, ordinary long").groupBy("word", "half").agg(*sums)
    found = words.mapInArrow(lean(_gram_counts), "gram long, half int, toxic long, ordinary long").groupBy("gram", "half").agg(*sums).toArrow()
    grams = found["gram"].to_numpy().view(np.uint64)
    counts = np.array([found[c].to_numpy() for c in ("toxic", "ordinary")])
    halves = [found["half"].to_numpy() == h for h in (0, 1)]
    del found
    if not all(counts[c, h].any() for c in (0, 1) for h in halves):
        return None
    crosswise = spark.sparkContext.broadcast([Model(grams[h], *counts[:, h]) for h in reversed(halves)])
    every, of = np.unique(grams, return_inverse=True)
    counts = [np.bincount(of, c, len(every)) for c in counts]
    del grams, of
    model = Model(every, *counts)

    def measure(batches):
        import pyarrow as pa

        scorers = [Scorer(m, passages) for m in crosswise.value]
        for batch in batches:
            half, at = batch.column(2).to_pylist(), 0
            x = np.zeros((batch.num_rows, 1 + len(passages)))
            for texts in _batches_of_texts(batch.column(0), ""):
                for h in (0, 1):
                    mine = [i for i in range(len(texts)) if half[at + i] == h]
                    x[[at + i for i in mine]] = scorers[h].features([texts[i] for i in mine])
                at += len(texts)
            yield pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.list_(pa.float64())), batch.column(1).cast(pa.int32())], names=["x", "y"])

    seen = rows.mapInArrow(lean(measure), "x array<double>, y int").toPandas()
    crosswise.destroy()
    y = seen["y"].to_numpy(float)
    mean, scale, w = _fit(np.stack(seen["x"].to_list()), y)
    # The classes are drawn by different shares; the intercept goes back to their real proportion.
    w[-1] += np.log(totals[1] / totals[0]) - np.log(y.sum() / (len(y) - y.sum()))
    return spark.sparkContext.broadcast(model), (mean, scale, w)


def scored(docs: DataFrame, learnt, passages: tuple[int, ...] = PASSAGES, text_column: str = "text") -> DataFrame:
    """(row, score) for each row of docs."""

    def run(batches):
        import pyarrow as pa

        scorer = Scorer(learnt[0].value, passages) if learnt else None
        for batch in batches:
            scores = [np.zeros(0)]
            for texts in _batches_of_texts(batch.column(0), text_column):
                if learnt:
                    mean, scale, w = learnt[1]
                    z = (scorer.features(texts) - mean) / scale @ w[:-1] + w[-1]
                    scores.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
                else:
                    scores.append(np.zeros(len(texts)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(scores))], names=["row", "score"])

    return packed(docs).mapInArrow(lean(run), with_columns_of(docs, ("score", "double")))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of docs that the classifier does not reject."""
    return scored(docs, learn(docs, labels, **options)).where(F.col("score") < threshold).select("row.*")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    learnt = learn(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))
    return scored(docs, learnt).select(
        "row.doc_id",
        (fold("row.doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
