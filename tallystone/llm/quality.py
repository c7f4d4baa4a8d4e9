"""Quality by a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover the whole document. Each byte has
a learnt vector; learnt filters slide over each chunk and their largest response in the chunk is
kept. The chunks' responses, weighted by their bytes, average to one row of features, which a
logistic unit turns into one probability. A document of any length is worked off some hundred
chunks at a time.

The network is fitted in numpy (Adam, a fixed seed) on about `sample` labelled documents per
class (all, if there are fewer), chosen by a hash of the id, each with its whole text. That bounds
what the driver holds by the sample's texts; a step works off some hundred chunks at a time. The
classes are drawn evenly, and the intercept is then moved to their real proportion. Scoring is one
scan without a shuffle.

Defined cases: null is empty; an empty text is one empty chunk; without labelled rows of both
classes every score is the share of label 1 (0.5 without any); of repeated labels the lowest
counts, null labels and ids don't; other columns are carried along.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.llm.common import about, fold, lean, packed, read, text_of, with_columns_of

SAMPLE = 1500
THRESHOLD = 0.7
CHUNK, WIDTH, STRIDE = 512, 8, 2
VECTOR, FILTERS = 8, 16
#: Passes over the sample, but as many steps at least.
EPOCHS, STEPS, BATCH, RATE = 6, 400, 32, 0.01
#: Chunks worked off at once.
_AT_ONCE = 128


def chunks_of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(chunks, weights): rows of CHUNK bytes and the WIDTH that follow, and each row's share of the bytes."""
    count = max(1, -(-len(text) // CHUNK))
    flat = np.zeros(count * CHUNK + WIDTH, np.uint8)
    flat[: len(text)] = np.frombuffer(text, np.uint8)
    rows = np.lib.stride_tricks.sliding_window_view(flat, CHUNK + WIDTH)[::CHUNK]
    weights = np.full(count, CHUNK, float)
    weights[-1] = max(len(text) - (count - 1) * CHUNK, 1)
    return rows, weights / weights.sum()


@dataclass
class Network:
    vectors: np.ndarray
    filters: np.ndarray
    shift: np.ndarray
    out: np.ndarray
    constant: np.ndarray

    @classmethod
    def fresh(cls, seed: int = 5) -> Network:
        rng = np.random.default_rng(seed)
        return cls(
            rng.normal(0, 0.5, (256, VECTOR)).astype(np.float32),
            rng.normal(0, 1 / np.sqrt(WIDTH * VECTOR), (WIDTH * VECTOR, FILTERS)).astype(np.float32),
            np.zeros(FILTERS, np.float32),
            rng.normal(0, 0.1, FILTERS).astype(np.float32),
            np.zeros(1, np.float32),
        )

    def parts(self) -> list[np.ndarray]:
        return [self.vectors, self.filters, self.shift, self.out, self.constant]

    def pooled(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Largest response of each filter in each chunk, where it was, and the windows."""
        given = self.vectors[chunks].reshape(len(chunks), -1)
        windows = np.lib.stride_tricks.sliding_window_view(given, WIDTH * VECTOR, axis=1)[:, :: STRIDE * VECTOR]
        responses = np.ascontiguousarray(windows).reshape(-1, WIDTH * VECTOR) @ self.filters
        responses = responses.reshape(len(chunks), -1, FILTERS)
        at = responses.argmax(axis=1)
        return np.take_along_axis(responses, at[:, None], 1)[:, 0] + self.shift, at, windows

    def features(self, chunks: np.ndarray) -> np.ndarray:
        return np.concatenate([np.maximum(self.pooled(chunks[i : i + _AT_ONCE])[0], 0) for i in range(0, len(chunks), _AT_ONCE)])

    def score(self, texts: list[bytes]) -> np.ndarray:
        """The probability of label 1 of each text."""
        logits = np.zeros(len(texts))
        rows, owners, weights, held = [], [], [], 0

        def work():
            found = self.features(np.concatenate(rows)) @ self.out
            np.add.at(logits, np.concatenate(owners), found * np.concatenate(weights))

        for i, text in enumerate(texts):
            mine, share = chunks_of(text)
            for at in range(0, len(mine), _AT_ONCE):
                part = mine[at : at + _AT_ONCE]
                rows.append(part)
                owners.append(np.full(len(part), i))
                weights.append(share[at : at + _AT_ONCE])
                held += len(part)
                if held >= _AT_ONCE:
                    work()
                    rows, owners, weights, held = [], [], [], 0
        if rows:
            work()
        return 1 / (1 + np.exp(-np.clip(logits + self.constant[0], -30, 30)))

    def gradient(self, chunks: np.ndarray, owner: np.ndarray, share: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        parts = [slice(i, i + _AT_ONCE) for i in range(0, len(chunks), _AT_ONCE)]
        features, pooled = np.zeros((len(y), FILTERS), np.float32), None
        for s in parts:
            pooled = self.pooled(chunks[s])
            np.add.at(features, owner[s], np.maximum(pooled[0], 0) * share[s, None])
        p = 1 / (1 + np.exp(-np.clip(features @ self.out + self.constant[0], -30, 30)))
        wrong = ((p - y) / len(y)).astype(np.float32)
        d_vectors, d_filters, d_shift = np.zeros_like(self.vectors), np.zeros_like(self.filters), np.zeros_like(self.shift)
        for s in parts:  # again part by part: what a part needs is not held for all
            best, at, windows = pooled if len(parts) == 1 else self.pooled(chunks[s])
            back = (wrong[owner[s]] * share[s])[:, None] * self.out * (best > 0)
            won = np.take_along_axis(windows, at[:, :, None], 1)
            d_filters += np.einsum("bfk,bf->kf", won, back)
            d_shift += back.sum(axis=0)
            to_bytes = back[:, :, None, None] * self.filters.T.reshape(FILTERS, WIDTH, VECTOR)
            mine = chunks[s]
            bytes_won = mine[np.arange(len(mine))[:, None, None], (at * STRIDE)[:, :, None] + np.arange(WIDTH)]
            np.add.at(d_vectors, bytes_won.ravel(), to_bytes.reshape(-1, VECTOR))
        return [d_vectors, d_filters, d_shift, features.T @ wrong, np.array([wrong.sum()])]


def fit(texts: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, seed: int = 5) -> Network:
    """Adam over documents given as (chunks, shares)."""
    net, rng = Network.fresh(seed), np.random.default_rng(seed)
    first = [np.zeros_like(p, dtype=np.float64) for p in net.parts()]
    second = [np.zeros_like(p, dtype=np.float64) for p in net.parts()]
    t, epochs = 0, max(EPOCHS, -(-STEPS * BATCH // len(texts)))
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            mine = order[at : at + BATCH]
            chunks = np.concatenate([texts[i][0] for i in mine])
            share = np.concatenate([texts[i][1] for i in mine]).astype(np.float32)
            owner = np.repeat(np.arange(len(mine)), [len(texts[i][1]) for i in mine])
            t += 1
            rate = RATE * (1 - epoch / epochs)
            for p, g, m, v in zip(net.parts(), net.gradient(chunks, owner, share, y[mine]), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return net


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, divisor: int = 4, held: int = 2, id_column: str = "doc_id", text_column: str = "text") -> Network:
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (fold("doc_id", divisor) != held))
    usable = usable.groupBy("doc_id").agg(F.min("quality").alias("y")).withColumn("at", F.xxhash64("doc_id", F.lit(5)))
    totals = {int(r["y"]): r["n"] for r in usable.groupBy("y").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for value in (0, 1):
        part = usable.where((F.col("y") == value) & about(F.col("at"), sample, totals.get(value, 0)))
        chosen = part if chosen is None else chosen.unionAll(part)
    # About 2 * sample rows of two small columns, however many labels there are.
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text")).join(
        F.broadcast(chosen.select(F.col("doc_id").alias("chosen_id"), "y", "at")), F.col("id") == F.col("chosen_id")
    )

    found = rows.select("text", "y", "at").toPandas().sort_values("at")
    y = found["y"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        net = Network.fresh()
        net.out[:] = 0
        net.constant[0] = 0 if not len(y) else 30 * (2 * y[0] - 1)
        return net
    texts = [chunks_of((t or "").encode()) for t in found["text"]]
    net = fit(texts, y)
    net.constant += np.float32(np.log(totals[1] / totals[0]) - np.log(y.sum() / (len(y) - y.sum())))
    return net


def scored(docs: DataFrame, net: Network, text_column: str = "text") -> DataFrame:
    """(row, score) for each row of docs."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            scores = [net.score(text_of(batch.column(0).slice(at, 128), text_column)) for at in range(0, batch.num_rows, 128)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([*scores, np.zeros(0)]))], names=["row", "score"])

    return packed(docs).mapInArrow(lean(run), with_columns_of(docs, ("score", "double")))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    net = learn(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))
    return scored(docs, net).select(
        "row.doc_id",
        (fold("row.doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
